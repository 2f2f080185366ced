"""Quality of a text by regularised quadratic discriminant analysis.

Statistics of the whole text (lengths, shares of kinds of characters, repetition of words, pairs
and lines) are brought to comparable scales by logarithms and logits. Each class has a Gaussian
over them whose covariance is shrunk towards the pooled one and towards its own diagonal. A score
is the logistic of the difference of both log densities and priors; the Mahalanobis distances come
from Cholesky factors that are computed once and sent along.

Class moments are sums over all labelled rows, reduced by Spark; labels, language, source and id
never enter a score.

Defined cases: a null or empty text has the statistics of the empty string and is scored by them;
without labelled rows of both classes the score is the share of label 1 among them, or 0.5 without
any; rows without doc_id are scored but not learned from; repeated rows give repeated results; a
document labelled twice counts twice; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import mixed, text_blocks, word_hashes, word_spans, written

# Weight of the pooled covariance in that of a class, and of the diagonal in the result.
POOLED = 0.2
DIAGONAL = 0.2
# Added to every variance, in units of the transformed statistics.
FLOOR = 1e-2
# Log-density differences are divided by this, as the statistics are not independent draws.
TEMPERATURE = 2.0

STATISTICS = (
    "words bytes_per_word letters capitals digits marks blanks wide odd_ends distinct_words "
    "same_as_before distinct_pairs top_word bytes_per_line distinct_lines lone_marks"
).split()

_KIND = np.zeros((5, 256), bool)
_KIND[0, [*range(65, 91), *range(97, 123), *range(128, 256)]] = True  # letters
_KIND[1, range(65, 91)] = True  # capitals
_KIND[2, range(48, 58)] = True  # digits
_KIND[3, [n for n in range(33, 127) if not chr(n).isalnum()]] = True  # marks
_KIND[4, [9, 10, 11, 12, 13, 32]] = True  # blanks


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Smoothed logit of a share."""
    part = np.minimum(part, whole)
    return np.log((part + 0.5) / (whole - part + 0.5))


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text."""
    out = []
    for _, offsets, data in text_blocks(texts):
        count = len(offsets) - 1
        size = np.diff(offsets)
        text_of = np.repeat(np.arange(count), size)
        kinds = [np.bincount(text_of, kind[data], count) for kind in _KIND]
        letters, capitals, digits, marks, blanks = kinds
        wide = np.bincount(text_of, data >= 192, count)
        starts, ends, owner = word_spans(offsets, data, ~_KIND[4][data])
        words = np.bincount(owner, minlength=count)
        hashes = word_hashes(data, starts, ends)
        last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
        # Sentence marks are common ends of words; other marks are odd.
        odd = _KIND[3][last] & ~np.isin(last, np.frombuffer(b".,;:?!'\")", np.uint8))
        lone = (ends - starts == 1) & _KIND[3][last]
        same = np.zeros(len(words_of := hashes), bool)
        same[1:] = (words_of[1:] == words_of[:-1]) & (owner[1:] == owner[:-1])
        pairs = mixed(hashes[:-1] * np.uint64(3) + hashes[1:])
        pair_owner = owner[:-1][inside := owner[:-1] == owner[1:]] if len(owner) else owner
        pairs = pairs[inside] if len(owner) else pairs
        distinct, top = _repeats(owner, hashes, count)
        distinct_pairs, _ = _repeats(pair_owner, pairs, count)
        line_starts, line_ends, line_owner = word_spans(offsets, data, data != 10)
        lines = np.bincount(line_owner, minlength=count)
        distinct_lines, _ = _repeats(line_owner, word_hashes(data, line_starts, line_ends), count)
        out.append(
            np.stack(
                (
                    np.log1p(words),
                    np.log1p((size - blanks) / np.maximum(words, 1)),
                    _share(letters, size),
                    _share(capitals, letters),
                    _share(digits, size),
                    _share(marks, size),
                    _share(blanks, size),
                    _share(wide, letters),
                    _share(np.bincount(owner, odd, count), words),
                    _share(distinct, words),
                    _share(np.bincount(owner, same, count), words),
                    _share(distinct_pairs, np.maximum(words - 1, 0)),
                    _share(top, words),
                    np.log1p(size / np.maximum(lines, 1)),
                    _share(distinct_lines, lines),
                    _share(np.bincount(owner, lone, count), words),
                ),
                axis=1,
            )
        )
    return np.concatenate(out) if out else np.zeros((0, len(STATISTICS)))


def _repeats(owner: np.ndarray, values: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the number of distinct values, and how often the most frequent one occurs."""
    if not len(values):
        return np.zeros(count), np.zeros(count)
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    edge = np.ones(len(values), bool)
    edge[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(edge)
    runs = np.diff(np.append(at, len(values)))
    top = np.zeros(count)
    np.maximum.at(top, owner[at], runs)
    return np.bincount(owner[at], minlength=count), top


@dataclass(frozen=True)
class Model:
    """Means, inverse Cholesky factors, log determinants and log priors of the classes 0 and 1."""

    means: np.ndarray
    whiten: np.ndarray
    offsets: np.ndarray
    constant: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.means):
            return np.full(len(rows), self.constant)
        log_density = [
            offset - 0.5 * (((rows - mean) @ whiten.T) ** 2).sum(axis=1)
            for mean, whiten, offset in zip(self.means, self.whiten, self.offsets)
        ]
        margin = np.clip((log_density[1] - log_density[0]) / TEMPERATURE, -40, 40)
        return 1 / (1 + np.exp(-margin))


def fit(moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Model:
    """From the count, sum and sum of outer products of each class."""
    nothing = np.zeros((0, 0))
    counts = {label: n for label, (n, _, _) in moments.items() if n}
    if len(counts) < 2:
        share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
        return Model(nothing, nothing, nothing, share)
    means, scatter = [], []
    for label in (0, 1):
        n, total, outer = moments[label]
        mean = total / n
        means.append(mean)
        scatter.append(outer - n * np.outer(mean, mean))
    every = sum(counts.values())
    pooled = (scatter[0] + scatter[1]) / every
    whiten, offsets = [], []
    for label in (0, 1):
        own = (1 - POOLED) * scatter[label] / counts[label] + POOLED * pooled
        own = (1 - DIAGONAL) * own + DIAGONAL * np.diag(np.diag(own)) + FLOOR * np.eye(len(own))
        factor = np.linalg.cholesky(own)
        whiten.append(np.linalg.inv(factor))
        offsets.append(np.log(counts[label] / every) - np.log(np.diag(factor)).sum())
    return Model(np.array(means), np.array(whiten), np.array(offsets), 0.5)


def _held_out() -> Column:
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    return F.coalesce(rest == 1, F.lit(True))


def _moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Class moments of (quality, stats): partial sums per batch, added up by Spark."""
    width = len(STATISTICS) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width, width))
        for batch in batches:
            label = batch.column(0).to_numpy()
            values = np.stack(batch.column(1).to_numpy(zero_copy_only=False)) if len(label) else []
            for n in (0, 1):
                if (label == n).any():
                    own = np.insert(values[label == n], 0, 1, axis=1)
                    total[n] += own.T @ own
        label, cell = np.divmod(np.arange(total.size), width * width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(label), pa.array(cell), pa.array(total.ravel())], ["label", "cell", "value"]
        )

    parts = rows.mapInArrow(sums, "label long, cell long, value double")
    found = {0: np.zeros(width * width), 1: np.zeros(width * width)}
    for row in parts.groupBy("label", "cell").agg(F.sum("value").alias("value")).collect():
        found[row["label"]][row["cell"]] = row["value"]
    out = {}
    for label, flat in found.items():
        square = flat.reshape(width, width)
        out[label] = (square[0, 0], square[0, 1:], square[1:, 1:])
    return out


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(statistics(batch.column(1)).ravel())
            ends = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, values)], ["doc_id", "stats"]
            )

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    measured = written(texts.mapInArrow(measure, "doc_id long, stats array<double>"), "statistics")
    learned = labels.where("quality in (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    )
    learned = learned.where(~_held_out())
    model = fit(_moments(measured.join(learned, "doc_id").select("quality", "stats")))
    sent = documents.sparkSession.sparkContext.broadcast(model)  # two small matrices

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy().reshape(len(batch), len(STATISTICS))
            scores = sent.value.score(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    judged = measured.mapInArrow(judge, "doc_id long, score double, predicted int")
    return judged.withColumn("held_out", _held_out()).select(
        "doc_id", "held_out", "score", "predicted"
    )
