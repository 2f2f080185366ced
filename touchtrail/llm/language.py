"""Language of a text by a string kernel, Nyström landmarks and ridge regression.

Texts are lower-cased, everything but letters becomes a blank, and segments of fixed length are
compared by the runs of one to three characters that occur in them (present or not). Runs are hashed
into 4,096 slots, in which about 6 % of a segment's distinct runs fall together. The kernel of
two segments is the number of common slots over the geometric mean of their numbers. A sample of
the labelled segments are landmarks; kernel values against them are the features of one ridge
regression per language, and a batch of segments is scored by two matrix products. The scores of a
text are the mean over its segments, weighted by length.

The fit uses at most about SAMPLE_DOCUMENTS labelled texts per language, chosen by a hash of their
id, and SAMPLE_SEGMENTS evenly spaced segments of each; prediction covers whole texts.

Defined cases: a null text or one without a letter is ``und`` with score 0; so is every text where
no labelled text exists; rows without doc_id are predicted, never learned from; repeated rows give
repeated results; an empty table gives no rows; other columns are ignored by ``predict`` and pass
through ``with_language``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

SAMPLE_DOCUMENTS = 400
SAMPLE_SEGMENTS = 4
LANDMARKS = 128
SEGMENT = 1_000
LONGEST_RUN = 3
HASH_BITS = 12
RIDGE = 1e-3
UNKNOWN = "und"
# Segments in one matrix product.
BATCH = 512

_RUN_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(code).isalpha() for code in range(0x110000)])


@dataclass(frozen=True)
class Model:
    languages: list[str]
    landmarks: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray

    def score(self, present: np.ndarray) -> np.ndarray:
        """Scores (segments x languages) of presence rows."""
        return _kernel(present, self.landmarks, self.sizes) @ self.weights


def _kernel(present: np.ndarray, landmarks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    own = np.maximum(present.sum(axis=1), 1)
    return (present @ landmarks.T) / np.sqrt(own[:, None] * sizes[None, :])


def segments(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of segments with letters: text of each, its number of letters, its presence row."""
    owners: list[np.ndarray] = []
    codes: list[np.ndarray] = []
    waiting = 0
    for n, text in enumerate(texts):
        if not text:
            continue
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        count = -(-len(points) // SEGMENT)
        codes.append(points)
        owners.append(np.stack((np.full(count, n), _lengths(len(points), count))))
        waiting += count
        if waiting >= BATCH:
            yield from _present(owners, codes)
            owners, codes, waiting = [], [], 0
    if codes:
        yield from _present(owners, codes)


def _lengths(size: int, count: int) -> np.ndarray:
    out = np.full(count, SEGMENT)
    out[-1] = size - SEGMENT * (count - 1)
    return out


def _present(
    owners: list[np.ndarray], codes: list[np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    owner, lengths = np.concatenate(owners, axis=1)
    points = np.concatenate(codes)
    ends = np.cumsum(lengths)
    for start in range(0, len(owner), BATCH):
        chosen = slice(start, start + BATCH)
        begin = int(ends[start] - lengths[start])
        part = points[begin : int(ends[chosen][-1])]
        letter = _letters()[part]
        clean = np.where(letter, part, 32).astype(np.uint64)
        size = lengths[chosen]
        segment = np.repeat(np.arange(len(size)), size)
        present = np.zeros((len(size), 1 << HASH_BITS), np.float32)
        run = np.zeros(len(clean), np.uint64)
        for width in range(1, LONGEST_RUN + 1):
            run = run[: len(clean) - width + 1] * _RUN_BASE + clean[width - 1 :] + np.uint64(width)
            if not len(run):
                break
            mixed = run * _MIX
            slot = (mixed ^ (mixed >> np.uint64(32))) * _MIX >> np.uint64(64 - HASH_BITS)
            first, last = segment[: len(run)], segment[width - 1 :]
            inside = first == last
            present[first[inside], slot[inside].astype(np.int64)] = 1
        letters = np.bincount(segment, letter, len(size))
        has = letters > 0
        yield owner[chosen][has], letters[has], present[has]


def _held_out() -> Column:
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    return F.coalesce(rest == 0, F.lit(True))


def fit(documents: DataFrame) -> Model | None:
    """The model of the labelled documents that are not held out; None where there are none."""
    labelled = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~_held_out())
    counts = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().collect()}
    if not counts:
        return None
    shares = [
        (F.lit(name), F.lit(min(1.0, SAMPLE_DOCUMENTS / count))) for name, count in counts.items()
    ]
    share = F.create_map(*chain.from_iterable(shares))[F.col("lang")]
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = batch.column(0).to_pylist()
            parts = [_spread(text) for text in batch.column(1).to_pylist()]
            for owner, _, present in segments(parts):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([languages[n] for n in owner.tolist()]),
                        pa.array([np.packbits(row > 0).tobytes() for row in present], pa.binary()),
                    ],
                    ["lang", "present"],
                )

    sample = labelled.where(draw < share).select("lang", F.col("text").cast("string"))
    found = sorted(map(tuple, sample.mapInArrow(rows, "lang string, present binary").collect()))
    if not found:
        return None
    languages = sorted({name for name, _ in found})
    packed = np.frombuffer(b"".join(bits for _, bits in found), np.uint8).reshape(len(found), -1)
    present = np.unpackbits(packed, axis=1).astype(np.float32)
    label = np.array([languages.index(name) for name, _ in found])
    per_language = max(1, LANDMARKS // len(languages))
    picked = []
    for n in range(len(languages)):
        own = np.flatnonzero(label == n)
        step = np.linspace(0, len(own) - 1, min(per_language, len(own)))
        picked.append(own[np.unique(step.astype(int))])
    landmarks = present[np.concatenate(picked)]
    sizes = np.maximum(landmarks.sum(axis=1), 1)
    features = _kernel(present, landmarks, sizes).astype(np.float64)
    # Every language weighs the same, whatever its share of the sample.
    weight = (1 / np.bincount(label, minlength=len(languages)))[label][:, None]
    target = (label[:, None] == np.arange(len(languages))).astype(np.float64)
    among = _kernel(landmarks, landmarks, sizes).astype(np.float64)
    gram = features.T @ (weight * features) + RIDGE * (among + 1e-6 * np.eye(len(among)))
    weights = np.linalg.solve(gram, features.T @ (weight * target))
    return Model(languages, landmarks, sizes, weights)


def _spread(text: str | None) -> str:
    """Evenly spaced segments of a text, all of it if it is short."""
    count = -(-len(text or "") // SEGMENT)
    if count <= SAMPLE_SEGMENTS:
        return text or ""
    chosen = {int(n) for n in np.linspace(0, count - 1, SAMPLE_SEGMENTS)}
    return "".join(text[n * SEGMENT : (n + 1) * SEGMENT] for n in sorted(chosen))


def classify(texts: list[str | None], model: Model | None) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    names, best = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if model is None:
        return names, best
    total = np.zeros((len(texts), len(model.languages)))
    letters = np.zeros(len(texts))
    for owner, weight, present in segments(texts):
        np.add.at(total, owner, model.score(present) * weight[:, None])
        np.add.at(letters, owner, weight)
    found = letters > 0
    mean = total[found] / letters[found][:, None]
    top = mean.argmax(axis=1)
    for n, language in zip(np.flatnonzero(found).tolist(), top.tolist()):
        names[n] = model.languages[language]
    best[found] = np.clip(mean.max(axis=1), 0, 1)
    return names, best


def with_language(documents: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """All columns of the documents, then lang_pred and score; equal names are replaced."""
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(model)  # LANDMARKS rows, whatever the input
    base = documents.drop("lang_pred", "score")
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]

    def predict_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text)).to_pylist()
            names, best = classify(texts, sent.value)
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(best)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lang_pred", "score"])

    return base.mapInArrow(predict_batches, StructType([*base.schema.fields, *added]))


def predict(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    held = StructField("held_out", BooleanType())
    out = with_language(texts, fit(documents)).withColumn(held.name, _held_out())
    return out.select("doc_id", "held_out", "lang_pred", "score")
