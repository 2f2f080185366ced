"""Secret scans: format rules, and automata inferred from the credentials that the rules find.

Three rules give the base spans of a text: assignments, access keys and long hexadecimal runs. Their
values are labelled credentials. For each kind a prefix tree of such values is merged, state by
state, wherever two states have statistically compatible endings and continuations, into a
probabilistic automaton; one more automaton comes from ordinary tokens. Every token of a text that
no base span touches is then a candidate and scored by its likelihood under each automaton. It is
added as ``like_<kind>`` if

- its likelihood per character is one that the credentials of the kind reach themselves, all but
  the lowest REJECTED share of those that were held back from the inference, and
- the kind explains it at least exp(LEAST_EVIDENCE) times better than the ordinary tokens do.

Values and ordinary tokens for the inference are the EXAMPLES smallest by hash of all distinct ones
in the corpus, at most LONGEST_EXAMPLE characters long, so the fit is bounded at any size; the
scan reads every text whole. A kind with fewer than LEAST_EXAMPLES distinct values has no automaton.

Defined cases: a span covers a whole match, keyword included, in code points, end exclusive; a match
of a rule that fails its length takes its characters with it; a null text is an empty one and has
no spans; rows that repeat are rows of their own; a null doc_id keeps its row; an empty table gives
no rows; other columns are ignored; a token of any length is scored as a whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchtrail.llm.common import short_lived, written

# The rules, and how long a match of each must be.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{16,}")
LEAST_VALUE, LEAST_ACCESS = 12, 18

ORDINARY = "ordinary"
_TOKEN_CHARACTERS = "A-Za-z0-9+/_.=-"
LEAST_TOKEN = 12
_TOKEN = re.compile(f"(?<![{_TOKEN_CHARACTERS}])[{_TOKEN_CHARACTERS}]{{{LEAST_TOKEN},}}")

EXAMPLES = 2_000
LONGEST_EXAMPLE = 256
LEAST_EXAMPLES = 20
# Confidence of the test that two states behave alike.
ALPHA = 0.05
REJECTED = 0.01
# Log of the odds that a token is no credential before anything is known about it.
LEAST_EVIDENCE = math.log(1_000)

_SYMBOLS = 128
# Hashes are counted in classes of magnitude, so many for each factor of two.
_STEPS_PER_DOUBLING = 64


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of every match of a rule, by start and kind."""
    found = [
        ("assign", m.start(), m.end(), m.group(2))
        for m in _ASSIGN.finditer(text)
        if len(m.group(2)) >= LEAST_VALUE
    ]
    found += [
        ("access", m.start(), m.end(), m.group())
        for m in _ACCESS.finditer(text)
        if m.end() - m.start() >= LEAST_ACCESS
    ]
    found += [("hex", m.start(), m.end(), m.group()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))


def candidates(text: str, base: list[tuple[str, int, int, str]]) -> list[tuple[int, int]]:
    """Start and end of every token that no base span touches."""
    # Spans of one kind don't overlap, so their ends grow with their starts.
    out, edges = [], [(s, e) for _, s, e, _ in base]
    ends = np.maximum.accumulate([e for _, e in edges]) if edges else np.zeros(0, np.int64)
    starts = [s for s, _ in edges]
    for match in _TOKEN.finditer(text):
        start, end = match.span()
        # Spans that begin before the token ends; one of them reaches into it or none does.
        before = int(np.searchsorted(starts, end, "left")) if starts else 0
        if before == 0 or ends[before - 1] <= start:
            out.append((start, end))
    return out


class Automaton:
    """A probabilistic automaton: log probabilities of symbols and ends, and where symbols lead.

    The last state is that of words the examples do not allow: it knows only how often each symbol
    occurs, and no word leaves it.
    """

    def __init__(self, log_symbol: np.ndarray, log_end: np.ndarray, after: np.ndarray):
        self.log_symbol, self.log_end, self.after = log_symbol, log_end, after

    def log_likelihoods(self, words: list[bytes]) -> np.ndarray:
        """Log probability of each word; all words advance by one symbol at a time."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        starts = np.zeros(len(words), np.int64)
        np.cumsum(lengths[:-1], out=starts[1:])
        data = np.frombuffer(b"".join(words), np.uint8)
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words))
        descending = -lengths[order]
        for n in range(int(lengths.max()) if len(words) else 0):
            # Words longer than n are a prefix of the order.
            left = order[: np.searchsorted(descending, -n, "left")]
            symbols = data[starts[left] + n]
            total[left] += self.log_symbol[state[left], symbols]
            state[left] = self.after[state[left], symbols]
        return total + self.log_end[state]


def infer(words: Iterable[bytes], alpha: float = ALPHA) -> Automaton:
    """Merge the prefix tree of ``words`` into an automaton.

    States that are kept take in, one after the other, the most visited state that hangs below them
    if both behave alike: ends and symbols differ by less than a Hoeffding bound, and so do the
    states that equal symbols lead to. A state that is like no other is kept.
    """
    passed, ends, counts, after = _prefix_tree(words)
    reach = math.sqrt(0.5 * math.log(2 / alpha))

    def alike(one: int, other: int) -> bool:
        pairs = [(one, other)]
        while pairs:
            a, b = pairs.pop()
            bound = reach * (1 / math.sqrt(passed[a]) + 1 / math.sqrt(passed[b]))
            if bound < 1:
                if abs(ends[a] / passed[a] - ends[b] / passed[b]) > bound:
                    return False
                for symbol in counts[a].keys() | counts[b].keys():
                    share = counts[a].get(symbol, 0) / passed[a]
                    if abs(share - counts[b].get(symbol, 0) / passed[b]) > bound:
                        return False
            pairs += [(after[a][s], after[b][s]) for s in after[b] if s in after[a]]
        return True

    def take_in(one: int, other: int) -> None:
        pairs = [(one, other)]
        while pairs:
            a, b = pairs.pop()
            passed[a] += passed[b]
            ends[a] += ends[b]
            for symbol, n in counts[b].items():
                counts[a][symbol] = counts[a].get(symbol, 0) + n
                if symbol in after[a]:
                    pairs.append((after[a][symbol], after[b][symbol]))
                else:
                    after[a][symbol] = after[b][symbol]

    kept, is_kept = [0], {0}
    while True:
        below = [
            (-passed[child], a, symbol)
            for a in kept
            for symbol, child in after[a].items()
            if child not in is_kept
        ]
        if not below:
            break
        _, parent, symbol = min(below)
        state = after[parent][symbol]
        like = next((a for a in kept if alike(a, state)), None)
        if like is None:
            kept.append(state)
            is_kept.add(state)
        else:
            after[parent][symbol] = like
            take_in(like, state)
    return _tables(kept, passed, ends, counts, after)


def _prefix_tree(words: Iterable[bytes]):
    passed, ends, counts, after = [0], [0], [{}], [{}]
    for word in words:
        state = 0
        passed[0] += 1
        for symbol in word:
            counts[state][symbol] = counts[state].get(symbol, 0) + 1
            if symbol not in after[state]:
                after[state][symbol] = len(passed)
                passed.append(0)
                ends.append(0)
                counts.append({})
                after.append({})
            state = after[state][symbol]
            passed[state] += 1
        ends[state] += 1
    return passed, ends, counts, after


def _tables(kept, passed, ends, counts, after) -> Automaton:
    # Every symbol keeps a small chance, so that one odd character does not rule a word out.
    place = {state: n for n, state in enumerate(kept)}
    overall = np.ones(_SYMBOLS)
    for state in kept:
        for symbol, n in counts[state].items():
            overall[symbol] += n
    stops = 1 + sum(ends[state] for state in kept)
    whole = overall.sum() + stops
    log_symbol = np.tile(overall / whole, (len(kept) + 1, 1))
    log_end = np.full(len(kept) + 1, stops / whole)
    targets = np.full((len(kept) + 1, _SYMBOLS), len(kept), np.int64)
    for state, n in place.items():
        log_end[n] = (ends[state] + log_end[n]) / (passed[state] + 1)
        log_symbol[n] /= passed[state] + 1
        for symbol, count in counts[state].items():
            log_symbol[n, symbol] += count / (passed[state] + 1)
            targets[n, symbol] = place[after[state][symbol]]
    return Automaton(np.log(log_symbol), np.log(log_end), targets)


class Model:
    """The automaton of each learned kind with its least likelihood, and that of ordinary tokens."""

    def __init__(self, kinds: dict[str, tuple[Automaton, float]], ordinary: Automaton):
        self.kinds, self.ordinary = kinds, ordinary

    def kinds_of(self, words: list[bytes]) -> list[str | None]:
        """The kind that explains each token best, or None; ties go to the kind listed first."""
        if not words or not self.kinds:
            return [None] * len(words)
        plain = self.ordinary.log_likelihoods(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        best, chosen = np.full(len(words), -np.inf), np.full(len(words), -1)
        for n, (automaton, least) in enumerate(self.kinds.values()):
            likelihood = automaton.log_likelihoods(words)
            evidence = likelihood - plain
            fits = (likelihood / sizes >= least) & (evidence >= LEAST_EVIDENCE) & (evidence > best)
            best[fits], chosen[fits] = evidence[fits], n
        names = [f"like_{kind}" for kind in self.kinds]
        return [names[n] if n >= 0 else None for n in chosen]


def _hash(value: str) -> int:
    digest = hashlib.blake2b(value.encode(), digest_size=8).digest()
    return int.from_bytes(digest, "big", signed=True)


class _Smallest:
    """The distinct values of smallest hash, as many as are asked for."""

    def __init__(self, most: int):
        self.most, self.kept, self.limit = most, {}, 2**63

    def add(self, value: str) -> None:
        if len(value) > LONGEST_EXAMPLE or value in self.kept:
            return
        hashed = _hash(value)
        if hashed < self.limit:
            self.kept[value] = hashed
            if len(self.kept) >= 2 * self.most:
                self.cut()

    def cut(self) -> None:
        ranked = sorted(self.kept.items(), key=lambda item: (item[1], item[0]))[: self.most]
        self.kept = dict(ranked)
        if len(ranked) == self.most:
            self.limit = ranked[-1][1] + 1


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def examples(docs: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """(kind, value) of the ``most`` distinct values of smallest hash per kind, ordinary included."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {kind: _Smallest(most) for kind in (*KINDS, ORDINARY)}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                for kind, _, _, value in base:
                    found[kind].add(value)
                for start, end in candidates(text, base):
                    found[ORDINARY].add(text[start:end])
        for kind, values in found.items():
            values.cut()
            rows = {
                "kind": pa.array([kind] * len(values.kept), pa.string()),
                "value": pa.array(list(values.kept), pa.string()),
                "hashed": pa.array(list(values.kept.values()), pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(rows)

    gathered = _texts(docs).select("text").mapInArrow(
        smallest, "kind string, value string, hashed long"
    )
    distinct = written(
        gathered.groupBy("kind", "value").agg(F.first("hashed").alias("hashed")), "values"
    )
    # Every task sends its smallest, so most of them are not among the smallest of all. Counts by
    # the magnitude of the hash tell where those end, before one task ranks what is left.
    step = F.floor(F.log2(F.col("hashed").cast("double") + 2.0**63 + 1) * _STEPS_PER_DOUBLING)
    distinct = distinct.withColumn("step", step)
    up_to = Window.partitionBy("kind").orderBy("step")
    last_steps = (
        distinct.groupBy("kind", "step")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(up_to) - F.col("n"))
        .where(F.col("before") < most)
        .groupBy("kind")
        .agg(F.max("step").alias("step"))
    )
    near = F.lit(False)
    for row in last_steps.collect():  # one a kind
        near |= (F.col("kind") == row.kind) & (F.col("step") <= row.step)
    ranked = Window.partitionBy("kind").orderBy("hashed", "value")
    return (
        distinct.where(near)
        .withColumn("place", F.row_number().over(ranked))
        .where(F.col("place") <= most)
        .select("kind", "value", "place")
    )


def fit(docs: DataFrame, most: int = EXAMPLES) -> Model | None:
    """Infer the automata, one task per kind; None where there is nothing to learn from."""

    def learned(found: pd.DataFrame) -> pd.DataFrame:
        kind = found["kind"].iloc[0]
        values = [value.encode() for value in found.sort_values("place")["value"]]
        if len(values) < LEAST_EXAMPLES and kind != ORDINARY:
            return pd.DataFrame({"kind": [kind], "least": [0.0], "states": [0], "table": [b""]})
        held = values[1::2] or values
        automaton = infer(values[::2])
        scores = automaton.log_likelihoods(held) / (np.array([len(v) for v in held]) + 1)
        table = np.hstack([automaton.log_symbol, automaton.log_end[:, None], automaton.after])
        return pd.DataFrame(
            {
                "kind": [kind],
                "least": [float(np.quantile(scores, REJECTED))],
                "states": [len(table)],
                "table": [table.astype("<f8").tobytes()],
            }
        )

    # At most ``most`` values a kind, so neither a group nor what comes back grows with the corpus.
    with short_lived(docs.sparkSession):
        rows = {
            row.kind: row
            for row in examples(docs, most)
            .groupBy("kind")
            .applyInPandas(learned, "kind string, least double, states int, table binary")
            .collect()
            if row.states
        }
    kinds = {
        kind: (_automaton(rows[kind]), rows[kind].least) for kind in KINDS if kind in rows
    }
    if not kinds:
        return None
    ordinary = _automaton(rows[ORDINARY]) if ORDINARY in rows else infer([])
    return Model(kinds, ordinary)


def _automaton(row) -> Automaton:
    table = np.frombuffer(row.table, "<f8").reshape(row.states, -1)
    after = table[:, _SYMBOLS + 1 :].astype(np.int64)
    return Automaton(table[:, :_SYMBOLS].copy(), table[:, _SYMBOLS].copy(), after)


_SCANNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        *((f"n_{kind}", pa.int64()) for kind in KINDS),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
        ("n_added", pa.int64()),
    ]
)
_RESULT = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string,"
    " n_added long"
)


def scan(docs: DataFrame, model: Model | None) -> DataFrame:
    """Spans of every text: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added."""
    order = {kind: n for n, kind in enumerate((*KINDS, *(f"like_{kind}" for kind in KINDS)))}

    def written(spans: list[tuple[str, int, int]]) -> str:
        return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            base = [base_spans(text) for text in texts]
            where, words = [], []
            if model is not None:
                for n, text in enumerate(texts):
                    for start, end in candidates(text, base[n]):
                        where.append((n, start, end))
                        words.append(text[start:end].encode())
            added: dict[int, list[tuple[str, int, int]]] = {}
            for (n, start, end), kind in zip(
                where, model.kinds_of(words) if model else [], strict=True
            ):
                if kind is not None:
                    added.setdefault(n, []).append((kind, start, end))
            rows = []
            for n, found in enumerate(base):
                plain = [span[:3] for span in found]
                every = sorted(plain + added.get(n, []), key=lambda s: (s[1], order[s[0]]))
                rows.append(
                    (
                        *(sum(s[0] == kind for s in plain) for kind in KINDS),
                        hashlib.sha256(written(plain).encode()).hexdigest(),
                        written(every),
                        len(every) - len(plain),
                    )
                )
            columns = [batch.column("doc_id").cast(pa.int64()), *map(list, zip(*rows))]
            if rows:
                arrays = [
                    pa.array(column, kind.type) if isinstance(column, list) else column
                    for column, kind in zip(columns, _SCANNED, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=_SCANNED)

    return _texts(docs).mapInArrow(scanned, _RESULT)


def find_secrets(docs: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """Learn the formats from the documents at hand and scan all of them."""
    return scan(docs, fit(docs, most))
