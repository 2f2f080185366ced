"""Byte-level BPE by merge replay over a block of texts, and the way back to bytes.

A block is a bounded number of whole texts inside one task. Its distinct words form the corpus of
the replay: an inverted index maps each token pair, by the rank of its merge, to the positions
where it stands. Ranks are taken in ascending order; a merge touches the listed positions and
their two neighbours, nothing else. Words never interact, so the ids of a word do not depend on
the block it is met in and tasks need not exchange words.

Defined cases: a null or empty text has no ids, and the digests are those of the empty string; a
word of any length is one entry of the index; repeated rows give repeated results; an empty table
gives no rows; other columns of the input are ignored unless named in ``keep``.
"""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from touchtrail.llm.common import gathered

# Characters of text in one block of the replay, and words whose ids a task remembers.
BLOCK_CHARS = 6_000_000
KEPT_WORDS = 200_000

_RIGHT_BITS = 20
_NO_PAIR = 2**62


class Vocabulary:
    """Ranks of byte strings, and every pair of known strings whose join is known as well."""

    def __init__(self, ranks: dict[bytes, int]):
        self.first = np.array([ranks[bytes([value])] for value in range(256)], np.int64)
        joined = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    joined.append((left << _RIGHT_BITS | right, rank))
        joined.sort()
        self.pairs = np.array([pair for pair, _ in joined] + [_NO_PAIR], np.int64)
        self.joins = np.array([rank for _, rank in joined] + [-1], np.int64)
        # Tokens that have a merge of smaller rank than their own with some neighbour.
        sides = (self.pairs[:-1] >> _RIGHT_BITS, self.pairs[:-1] & (1 << _RIGHT_BITS) - 1)
        self.inverted = {
            token for side in sides for token in side[self.joins[:-1] < side].tolist()
        }
        by_rank = sorted((rank, token) for token, rank in ranks.items())
        lengths = np.zeros(by_rank[-1][0] + 2, np.int64)
        for rank, token in by_rank:
            lengths[rank + 1] = len(token)
        self.bytes_at = np.cumsum(lengths)
        self.bytes = np.frombuffer(b"".join(token for _, token in by_rank), np.uint8)

    @classmethod
    def parse(cls, lines: Iterable[bytes]) -> Vocabulary:
        """A rank file: a base64 token and its rank in each line."""
        split = (line.split() for line in lines if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in split})

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the join of two tokens, -1 where it is unknown."""
        pair = left << _RIGHT_BITS | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.joins[at], -1)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        return gathered(self.bytes, self.bytes_at, ids).tobytes()


def replay_merges(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, joined, and the offset of each word in them.

    The words are merged together in rank order. A place is the first byte of a token; the index
    holds, by the rank of its merge, the places where a pair begins. All places of a rank merge at
    once, left to right where they overlap. A few tokens have a merge of smaller rank than their
    own; when such a token is made, each word makes one and then waits for the smaller rank.
    """
    lengths = np.array([len(word) for word in words], np.int64)
    ends = np.cumsum(lengths)
    token = vocabulary.first[np.frombuffer(b"".join(words), np.uint8)]
    size = len(token)
    word_of = np.repeat(np.arange(len(words)), lengths)
    after = np.arange(1, size + 1)
    before = np.arange(-1, size - 1)
    filled = lengths > 0
    after[ends[filled] - 1] = -1
    before[(ends - lengths)[filled]] = -1

    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def put(rank: int, places: np.ndarray) -> None:
        if rank in index:
            index[rank].append(places)
        else:
            index[rank] = [places]
            heappush(waiting, rank)

    def note(left: np.ndarray) -> None:
        right = after[left]
        left, right = left[right >= 0], right[right >= 0]
        ranks = vocabulary.join(token[left], token[right])
        left, ranks = left[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        left, ranks = left[order], ranks[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                put(int(ranks[start]), left[start:end])

    note(np.arange(size))
    while waiting:
        rank = heappop(waiting)
        places = index.pop(rank)
        left = places[0] if len(places) == 1 else np.unique(np.concatenate(places))
        # A place is stale once another merge has taken it or its neighbour.
        right = after[left]
        live = (token[left] >= 0) & (right >= 0)
        left, right = left[live], right[live]
        live = vocabulary.join(token[left], token[right]) == rank
        left, right = left[live], right[live]
        if not len(left):
            continue
        if (left[1:] == right[:-1]).any():
            free = _without_overlap(left.tolist(), right.tolist())
            left, right = left[free], right[free]
        if rank in vocabulary.inverted:
            of_word = word_of[left]
            leading = np.ones(len(left), bool)
            leading[1:] = of_word[1:] != of_word[:-1]
            if not leading.all():
                put(rank, left[~leading])
                left, right = left[leading], right[leading]
        token[left] = rank
        token[right] = -1
        beyond = after[right]
        after[left] = beyond
        inner = beyond >= 0
        before[beyond[inner]] = left[inner]
        previous = before[left]
        note(np.unique(np.concatenate((left[inner], previous[previous >= 0]))))
    alive = token >= 0
    count = np.zeros(size + 1, np.int64)
    np.cumsum(alive, out=count[1:])
    return token[alive], np.concatenate(([0], count[ends]))


def _without_overlap(left: list[int], right: list[int]) -> list[int]:
    """Which places merge when each one taken bars the place of its right neighbour."""
    free, barred = [], -1
    for n, (here, there) in enumerate(zip(left, right)):
        if here != barred:
            free.append(n)
            barred = there
    return free


class Splitter:
    """Finds the words of a text by a pattern with letter and number classes.

    Texts of characters below U+0250, on which the standard library and the pattern's own
    language agree, go through the standard library with the classes written out; all other texts
    through the full classes. Both give the same words.
    """

    _END = 0x250

    def __init__(self, pattern: str):
        self.full = regex.compile(pattern)
        characters = [chr(code) for code in range(self._END)]
        space = regex.compile(r"\s")
        agreed = [c for c in characters if bool(space.match(c)) == bool(re.match(r"\s", c))]
        self.other = re.compile(f"[^{''.join(map(re.escape, agreed))}]")
        plain = pattern
        for name in (r"\p{L}", r"\p{N}"):
            members = "".join(re.escape(c) for c in characters if regex.match(name, c))
            # Inside a class the members stand bare, elsewhere they are a class of their own.
            parts = plain.split(name)
            plain = parts[0]
            for part in parts[1:]:
                inside = plain.rfind("[") > plain.rfind("]")
                plain += (members if inside else f"[{members}]") + part
        self.plain = re.compile(plain) if r"\p{" not in plain else self.full

    def __call__(self, text: str) -> list[str]:
        return (self.full if self.other.search(text) else self.plain).findall(text)


class Encoder:
    """Encodes blocks of texts; remembers the ids of words up to a fixed number."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, kept_words: int = KEPT_WORDS):
        self.vocabulary = vocabulary
        self.split = Splitter(pattern)
        self.kept_words = kept_words
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.decimals: list[str] = []
        self.ids = np.zeros(0, np.int32)
        self.offsets = np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """Ids of each text, as numbers and as decimals joined by spaces, block by block."""
        block, chars = [], 0
        for text in texts:
            block.append(text)
            chars += len(text)
            if chars >= BLOCK_CHARS:
                yield from self._encode_block(block)
                block, chars = [], 0
        yield from self._encode_block(block)

    def _encode_block(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        if len(self.known) > self.kept_words:
            self._forget()
        known = self.known
        # Each distinct word gets the next number when it is first met; a text becomes numbers.
        new: dict[str, int] = defaultdict(lambda: len(known) + len(new))
        split = []
        for text in texts:
            numbers = [known[w] if w in known else new[w] for w in self.split(text)]
            split.append(np.array(numbers, np.int32))
        if new:
            self._learn(list(new))
            known.update(new)
        decimals = self.decimals
        for numbers in split:
            yield (
                gathered(self.ids, self.offsets, numbers),
                " ".join([decimals[n] for n in numbers.tolist()]),
            )

    def _learn(self, words: list[str]) -> None:
        ids, offsets = replay_merges([word.encode() for word in words], self.vocabulary)
        values, cuts = ids.tolist(), offsets.tolist()
        text_of = _decimal_texts(len(self.vocabulary.bytes_at))
        self.decimals += [
            " ".join([text_of[v] for v in values[start:end]]) for start, end in zip(cuts, cuts[1:])
        ]
        self.offsets = np.concatenate((self.offsets, offsets[1:] + self.offsets[-1]))
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))


@lru_cache(maxsize=1)
def _decimal_texts(count: int) -> list[str]:
    return [str(number) for number in range(count)]


@lru_cache(maxsize=1)
def _vocabulary(file_name: str) -> Vocabulary:
    with open(SparkFiles.get(file_name), "rb") as lines:
        return Vocabulary.parse(lines)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about a block of text each, so that results leave as they are made."""
    sizes = pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes) // BLOCK_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(batch)]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def encode_texts(
    table: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    with_ids: bool = True,
) -> DataFrame:
    """Per row: the kept columns, n_tokens, digests of the ids and of the decoded bytes, the ids.

    ``ids_sha256`` is taken over the decimal ids joined by one space. ``with_ids`` False leaves
    the ids themselves out. The rank file has a fixed size and travels with the job.
    """
    spark = table.sparkSession
    spark.sparkContext.addFile(ranks_path)
    file_name = ranks_path.rsplit("/", 1)[-1]
    kept = [table.schema[name] for name in keep]
    fields = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
    if with_ids:
        fields.append(StructField("ids", ArrayType(IntegerType(), False)))
    names = [*keep, *(f.name for f in fields)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The words that a task remembers go with it; an idle worker holds the vocabulary only.
        encoder = Encoder(_vocabulary(file_name), pattern)
        for batch in chain.from_iterable(map(_parts, batches)):
            texts = batch.column(len(keep)).to_pylist()
            counts, of_ids, of_bytes, all_ids, ends = [], [], [], [], [0]
            for ids, decimals in encoder.encode(texts):
                counts.append(len(ids))
                of_ids.append(sha256(decimals.encode()).hexdigest())
                of_bytes.append(sha256(encoder.vocabulary.decode(ids)).hexdigest())
                if with_ids:
                    all_ids.append(pa.array(ids))
                    ends.append(ends[-1] + len(ids))
            columns = [batch.column(n) for n in range(len(keep))]
            columns += [pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_bytes)]
            if with_ids:
                flat = pa.concat_arrays(all_ids) if all_ids else pa.array([], pa.int32())
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))
            yield pa.RecordBatch.from_arrays(columns, names)
        pa.default_memory_pool().release_unused()

    chosen = table.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    return chosen.mapInArrow(encode, StructType([*kept, *fields]))
