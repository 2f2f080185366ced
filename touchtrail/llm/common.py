"""Reading, written intermediate tables, word hashes and connected components."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchtrail.session import scratch_dir

# Bytes of text whose hashes are computed at once; a longer text is a block of its own. The arrays of
# a block take about a hundred times its bytes, in every task that an executor runs.
BLOCK_BYTES = 250_000

_rng = np.random.Generator(np.random.PCG64(20240131))
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xC2B2AE3D27D4EB4F)


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where the driver has it, if it isn't installed.

    On a cluster the package is installed or sent along with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (path, root)))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# Folders of the tables written in each open ``short_lived`` block, the innermost last.
_blocks: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=())


def written(table: DataFrame, label: str, lasting: bool = False) -> DataFrame:
    """The table written below the shared scratch folder and read back: its lineage ends here.

    In a ``short_lived`` block the table goes at the end of the block; a lasting one belongs to the
    block around it, or stays where there is none.
    """
    spark = table.sparkSession
    path = scratch_dir(spark, label)
    blocks = _blocks.get()[: -1 if lasting else None]
    if blocks:
        blocks[-1].append(path)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


@contextmanager
def short_lived(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are removed at the end, also after an error.

    What leaves the block must not read them, so it is written as ``lasting``.
    """
    paths: list[str] = []
    token = _blocks.set((*_blocks.get(), paths))
    try:
        yield
    finally:
        _blocks.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (the finalizer of MurmurHash3)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def gathered(values: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``values[offsets[n]:offsets[n + 1]]`` of each n in ``which``, joined."""
    starts = offsets[which]
    lengths = offsets[which + 1] - starts
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts - ends + lengths, lengths)]


def text_blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of whole texts: index of the first text, offsets of its texts, their bytes.

    A null text is an empty one.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    data = texts.buffers()[2]
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        ends = offsets[first : last + 1]
        yield first, ends - ends[0], every[ends[0] : ends[-1]]
        first = last


def word_spans(
    offsets: np.ndarray, data: np.ndarray, in_word: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of word bytes, and the text it is in; runs end with their text."""
    size = len(data)
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    before = np.zeros(size, bool)
    before[1:] = in_word[:-1]
    starts = np.flatnonzero(in_word & (~before | edge[:-1]))
    after = np.zeros(size, bool)
    after[:-1] = in_word[1:]
    ends = np.flatnonzero(in_word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are disjoint and in order."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    at = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=at[1:])
    within = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
    codes = _BYTE_CODE[data[within + np.repeat(starts, lengths)]]
    codes *= powers(_BASE, int(lengths.max()))[within]
    return mixed(np.add.reduceat(codes, at) + lengths.astype(np.uint64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` words in a row, without regard to texts."""
    count = max(0, len(words) - width + 1)
    out = np.zeros(count, np.uint64)
    for n, factor in enumerate(powers(_WORD_BASE, width)):
        out += words[n : n + count] * factor
    return mixed(out)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; bytes of other characters stay."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); nodes of one component share a root.

    Randomised contraction: each round, every node moves to the first of itself and its
    neighbours, and links are relabelled, until none is left. Rounds alternate between the plain
    order of nodes, which folds a star around its smallest node at once, and a hashed order, which
    folds long chains in a logarithmic number of rounds. Each round is written, so a lost executor
    costs that round; no node's neighbours meet in one task, as the minimum is taken before the
    shuffle. Only the result outlasts the rounds.
    """
    with short_lived(links.sparkSession):
        return written(_contracted(links, label), label, lasting=True)


def _contracted(links: DataFrame, label: str) -> DataFrame:
    both = links.where("a <> b").select("a", "b")
    edges = written(both.union(both.select("b", "a")).distinct(), label)
    moves = []
    while not edges.isEmpty():
        n = len(moves)
        order = F.lit(0) if n % 2 == 0 else F.xxhash64(F.lit(n), "b")
        own = F.lit(0) if n % 2 == 0 else F.xxhash64(F.lit(n), "a")
        nearest = edges.groupBy("a").agg(F.min(F.struct(order.alias("h"), "b")).alias("best"))
        here = F.struct(own.alias("h"), F.col("a").alias("b"))
        move = written(
            nearest.select("a", F.least("best", here)["b"].alias("to")), label
        )
        moves.append(move)
        left = edges.join(move, "a").select(F.col("to").alias("x"), "b")
        right = move.select(F.col("a").alias("b"), F.col("to").alias("y"))
        folded = left.join(right, "b").where("x <> y").select(
            F.col("x").alias("a"), F.col("y").alias("b")
        )
        edges = written(folded.distinct(), label)
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = moves[-1].select(F.col("a").alias("node"), F.col("to").alias("root"))
    for move in reversed(moves[:-1]):
        later = roots.select(F.col("node").alias("to"), "root")
        roots = move.join(later, "to", "left").select(
            F.col("a").alias("node"), F.coalesce("root", "to").alias("root")
        )
    return roots
