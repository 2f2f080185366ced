"""Near-duplicate documents by min-max hashing, links confirmed on full shingle sets.

Each permutation is evaluated once per shingle and gives two signature values, the smallest and
the largest image of the set. Bands of three minima or three maxima put similar sets into common
buckets: at a Jaccard similarity of 0.75 a pair shares none of 32 bands with a probability of
3e-8.

Texts with equal sets are one class from the start, so a group of copies counts as one member
everywhere. A bucket is never expanded into rows of pairs. First its members are compared with a
leader; before the sets of such a pair are fetched, its signatures estimate the similarity, and a
pair with a true similarity of 0.75 has an estimate below 0.4 with a probability of less than 1e-7.
Buckets whose members are still apart form families, connected over common members. A family is cut
into blocks of bounded size, each member goes to the blocks once per partner block, and a task
compares two blocks on full sets: pairs that share a band and are not joined yet. It reports one
link per join.

Defined cases: a null, empty or blank text has an empty set and is linked with nothing; a text of
fewer words than a shingle has one shingle, all its words; repeated rows give repeated results; a
null doc_id takes part in no link; an empty table gives no rows; other columns are ignored. A doc_id
stands for one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import (
    components,
    gathered,
    lowered,
    mixed,
    short_lived,
    text_blocks,
    window_hashes,
    word_hashes,
    word_spans,
    written,
)

SHINGLE_WORDS = 5
# Links have 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
PERMUTATIONS = 48
BAND_VALUES = 3
# Pairs whose signatures agree in a smaller share of values are not looked at more closely.
LEAST_ESTIMATE = 0.4
# Members of a block of a family, and bytes of their sets.
BLOCK_MEMBERS = 1_024
BLOCK_BYTES = 12_000_000

_rng = np.random.Generator(np.random.PCG64(6))
_FLIP = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_STRIDE = _rng.integers(0, 2**62, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False


def shingle_sets(texts: pa.Array, width: int = SHINGLE_WORDS) -> Iterator[tuple[int, list]]:
    """Blocks of texts: index of the first one and the sorted distinct shingles of each."""
    for first, offsets, data in text_blocks(texts):
        data = lowered(data)
        starts, ends, owner = word_spans(offsets, data, _IN_WORD[data])
        words = word_hashes(data, starts, ends)
        bounds = np.searchsorted(owner, np.arange(len(offsets)))
        windows = window_hashes(words, width)
        sets = []
        for begin, end in zip(bounds, bounds[1:]):
            count = end - begin
            if count >= width:
                sets.append(np.unique(windows[begin : end - width + 1]))
            elif count:
                whole = window_hashes(words[begin:end], int(count))
                sets.append(mixed(whole + np.uint64(count)))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield first, sets


def min_max_signature(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Minima and maxima (sets x permutations); every set has a shingle."""
    every = np.concatenate(sets)
    at = np.zeros(len(sets), np.int64)
    np.cumsum([len(s) for s in sets[:-1]], out=at[1:])
    low = np.empty((len(sets), PERMUTATIONS), np.uint64)
    high = np.empty_like(low)
    for n in range(PERMUTATIONS):
        image = (every ^ _FLIP[n]) * _STRIDE[n]
        low[:, n] = np.minimum.reduceat(image, at)
        high[:, n] = np.maximum.reduceat(image, at)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Bucket keys: one per three minima and one per three maxima; the band is part of its key."""
    keys = []
    for side, values in enumerate((low, high)):
        for start in range(0, PERMUTATIONS, BAND_VALUES):
            key = np.full(len(values), np.uint64(2 * start + side + 1))
            for n in range(start, start + BAND_VALUES):
                key = mixed(key ^ values[:, n]) + values[:, n]
            keys.append(mixed(key))
    return np.stack(keys, axis=1).view(np.int64)


def _brief(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The signature in two bytes per value, enough to see whether values agree."""
    return mixed(np.concatenate((low, high), axis=1)).astype(np.uint16)


def _node(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bands = 2 * PERMUTATIONS // BAND_VALUES
    for batch in batches:
        for first, sets in shingle_sets(batch.column(1)):
            ids = batch.column(0).slice(first, len(sets))
            full = [s for s in sets if len(s)]
            low, high = min_max_signature(full) if full else (None, None)
            keys = iter(band_keys(low, high) if full else ())
            rows = [next(keys) if len(s) else None for s in sets]
            brief = iter(_brief(low, high) if full else ())
            sketches = [next(brief).tobytes() if len(s) else None for s in sets]
            flat = np.concatenate([r for r in rows if r is not None] or [np.zeros(0, np.int64)])
            ends = np.cumsum([0, *(0 if r is None else bands for r in rows)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "n_shingles", "node", "bands", "sketch"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, sets in shingle_sets(batch.column(1)):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, len(sets)),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["node", "shingles"],
            )


def similar(left: np.ndarray, right: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """Whether two sorted sets have 100 * intersection >= threshold * union."""
    small, large = sorted((left, right), key=len)
    if 100 * len(small) < threshold * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum())
    return 100 * common >= threshold * (len(left) + len(right) - common)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = (batch.column("of_a"), batch.column("of_b"))
        keep = [
            similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
            for x, y in zip(*sides)
        ]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sides = (
            np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint16).reshape(
                batch.num_rows, -1
            )
            for name in ("of_a", "of_b")
        )
        agree = np.equal(*sides).mean(axis=1)
        yield batch.select(["a", "b"]).filter(pa.array(agree >= LEAST_ESTIMATE))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id reachable over links, ``kept`` marks that document. The
    result is a written table; what led to it is removed.
    """
    with short_lived(documents.sparkSession):
        return written(_judged(documents), "near-duplicates", lasting=True)


def _judged(documents: DataFrame) -> DataFrame:
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    signed = written(
        texts.mapInArrow(
            _signatures,
            "doc_id long, n_shingles long, node binary, bands array<long>, sketch binary",
        ),
        "signatures",
    )
    # One member per distinct set; the document with the smallest id stands for it from here on.
    own = signed.where("node is not null and doc_id is not null")
    classes = own.groupBy("node").agg(
        F.min("doc_id").alias("id"),
        *(F.first(name).alias(name) for name in ("n_shingles", "sketch", "bands")),
    )
    classes = written(classes, "classes")
    members = classes.select("id", F.explode("bands").alias("band"))
    shared = (
        members.groupBy("band")
        .agg(F.count("*").alias("size"), F.min("id").alias("leader"))
        .where("size > 1")
    )
    buckets = members.join(shared.drop("size"), "band").withColumnRenamed("id", "node")
    maps = _root_maps(texts, classes, written(buckets, "buckets"))

    ids = classes.select(F.col("node").alias("shingle_set"), F.col("id").alias("node"))
    rooted = _with_root(ids, maps)
    of_root = rooted.groupBy("root").agg(F.min("node").alias("component_id"))
    named = rooted.join(of_root, "root").select(F.col("shingle_set").alias("node"), "component_id")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        signed.select("doc_id", "n_shingles", "node")
        .join(named, "node", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            (F.col("doc_id") == component).alias("kept"),
        )
    )


def _with_root(table: DataFrame, maps: list[DataFrame]) -> DataFrame:
    """The table with the root of its ``node``: each map moves the roots of the one before it."""
    table = table.withColumn("root", F.col("node"))
    for move in maps:
        to = move.select(F.col("node").alias("root"), F.col("root").alias("to"))
        table = table.join(to, "root", "left").withColumn("root", F.coalesce("to", "root"))
        table = table.drop("to")
    return table


def _root_maps(texts: DataFrame, classes: DataFrame, buckets: DataFrame) -> list[DataFrame]:
    """Maps from nodes to roots that join all that the members of any bucket have in links."""
    nodes = buckets.select(F.col("node").alias("id")).distinct()
    chosen = written(
        classes.join(nodes, "id", "left_semi").select(
            F.col("id").alias("node"), "n_shingles", "sketch", "bands"
        ),
        "sketches",
    )
    sets = written(
        texts.join(chosen.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").mapInArrow(
            _sets, "node long, shingles binary"
        ),
        "shingle-sets",
    )

    def sided(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
        of_a = table.select(F.col("node").alias("a"), F.col(column).alias("of_a"))
        of_b = table.select(F.col("node").alias("b"), F.col(column).alias("of_b"))
        return pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "of_a", "of_b")

    pairs = buckets.where("node <> leader").select(
        F.col("leader").alias("a"), F.col("node").alias("b")
    )
    likely = sided(pairs.distinct(), chosen, "sketch").mapInArrow(_estimate, "a long, b long")
    links = sided(likely, sets, "shingles").mapInArrow(_confirm, "a long, b long")
    maps = [components(written(links, "links"))]

    # Buckets with members of several roots, without their leader, which has met everyone.
    labelled = _with_root(buckets.where("node <> leader").select("band", "node"), maps)
    several = (
        labelled.groupBy("band")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("node").alias("a"))
        .where("low <> high")
        .select("band", "a")
    )
    apart = written(labelled.join(several, "band").select("a", F.col("node").alias("b")), "apart")
    families = components(apart).select("node", F.col("root").alias("family"))
    whole = written(
        _with_root(families, maps).join(chosen.select("node", "bands"), "node").join(sets, "node"),
        "families",
    )
    blocks = whole.groupBy("family").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK_MEMBERS),
            F.ceil(F.sum(F.length("shingles")) / BLOCK_BYTES),
        )
        .cast("int")
        .alias("blocks")
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    dealt = (
        whole.join(blocks, "family")
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("blocks", "other")
    )
    joins = written(_block_pairs(dealt).applyInArrow(_join_blocks, "a long, b long"), "joins")
    ends = _with_root(joins.select(F.col("a").alias("node"), "b"), maps)
    ends = ends.select(F.col("root").alias("a"), F.col("b").alias("node"))
    ends = _with_root(ends, maps).select("a", F.col("root").alias("b"))
    return [*maps, components(ends)]


def _block_pairs(dealt: DataFrame):
    """Each pair of blocks in a task of its own.

    The rows come from joins by family, which Spark would take for good enough, and all blocks of a
    family would meet in one task; so they are dealt anew.
    """
    pair = ("family", "low", "high")
    return dealt.repartition(*pair).groupBy(*pair)


def _join_blocks(table: pa.Table) -> pa.Table:
    """Links between two blocks of a family, or within one, that join what was apart."""
    node, block = table.column("node").to_numpy(), table.column("block").to_numpy()
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    bands = np.array(table.column("bands").to_pylist(), np.int64)
    raw = table.column("shingles").to_pylist()
    sizes = np.array([len(text) // 8 for text in raw])
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    known, ids = np.unique(np.frombuffer(b"".join(raw), np.uint64), return_inverse=True)
    # A label per root; labels change as links are found.
    label = table.column("root").to_numpy().copy()
    present = np.zeros(len(known), bool)
    first, second = [], []
    for x in np.flatnonzero(block == low).tolist():
        partner = (block == high) & (label != label[x])
        if low == high:
            partner[: x + 1] = False
        at = np.flatnonzero(partner)
        alike = 100 * np.minimum(sizes[at], sizes[x]) >= THRESHOLD * np.maximum(sizes[at], sizes[x])
        at = at[alike]
        at = at[(bands[at] == bands[x]).any(axis=1)]
        if not len(at):
            continue
        own = ids[offsets[x] : offsets[x + 1]]
        present[own] = True
        starts = np.concatenate(([0], np.cumsum(sizes[at])[:-1]))
        common = np.add.reduceat(present[gathered(ids, offsets, at)].astype(np.int32), starts)
        present[own] = False
        for y in at[100 * common >= THRESHOLD * (sizes[at] + sizes[x] - common)].tolist():
            if label[y] != label[x]:
                label[label == label[y]] = label[x]
                first.append(node[x])
                second.append(node[y])
    return pa.table({"a": pa.array(first, pa.int64()), "b": pa.array(second, pa.int64())})
