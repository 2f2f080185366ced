"""Hard negatives: threshold joins over an inverted index cut by norms, with falling thresholds.

An anchor looks for rows in windows: its positives are the best rows of its label, and for each
positive the negatives are the best rows of other labels whose score lies in a range below the
positive's. Both are one search: find, per window, the first ``want`` rows of fitting label and score.

Rows are dealt into blocks of at most ROWS and anchors into chunks of at most ANCHORS, by a running
number, so equal vectors, labels and ids spread evenly. Every chunk meets every block in a task of
its own. A task keeps an inverted index over its rows: dimensions in order of the mass they carry,
grouped; the tail of a row is left out from the first group on where the norm of the tail times
that of any anchor's tail cannot reach the threshold. Scores are accumulated group by group, pairs
whose partial score plus the product of remaining norms stays below the anchor's threshold go, and
what is left is completed with the tails. Thresholds start high and fall until all windows of an
anchor are full, or the lower end of its windows is reached.

The first block is searched before the others: the score of a full window there is a floor
for the same window everywhere else, since a row below it cannot be among the first.

Defined cases: rows with a null vec_id, label or vector, or with a null or non-finite component
take no part; rows that repeat are rows of their own, but a row of the anchor's own vec_id is
never its positive; rows of equal id and score are interchangeable; vectors of different length
never meet, an empty one scores 0 against its like; an empty table gives no rows; other columns are
ignored. Scores are exact; one of 2^62 or more is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchtrail.llm.common import short_lived, written

POSITIVES, NEGATIVES = 5, 10
ANCHOR_STEP = 100
# Share of the positive's score that a negative reaches at least and at most, in hundredths.
LEAST_SHARE, MOST_SHARE = 30, 90
SCALE = 256

ROWS, ANCHORS = 8_192, 8_192
# Anchors of a chunk whose scores are held at once.
_SLICE = 512
# Dimensions that are accumulated between two prunings.
_GROUP = 16
# Thresholds as shares of the highest score a window can hold; below them, its lower end.
_RUNGS = (0.9, 0.75, 0.6, 0.45, 0.3, 0.15)
# Products below this are exact in doubles; windows are open up to the largest score.
_EXACT, _MOST_SCORE = 2.0**53, 2**62
_PAIRS = 65_536

_HIT = "anchor long, window int, found_id long, score long"


def _prepared(vectors: DataFrame) -> DataFrame:
    """(number, vec_id, label, vector) of the rows that take part, components scaled and floored."""
    sound = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("long"),
        F.col("embedding").cast("array<double>"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False)))

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            flat = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE)
            ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
            parts = np.split(flat, ends[:-1]) if len(ends) else []
            vector = pa.array([part.tobytes() for part in parts], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), vector],
                names=["vec_id", "label", "vector"],
            )

    placed = rows.select("vec_id", moved.alias("label"), "embedding")
    return placed.mapInArrow(scaled, "vec_id long, label long, vector binary").withColumn(
        "number", F.monotonically_increasing_id()
    )


def _matrix(vectors: pd.Series, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), size)


class Index:
    """The rows of one block, ready to be searched."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.ids, self.labels = ids, labels
        # The dimensions that carry most come first, so that the tails are short.
        self.order = np.argsort(-(rows**2).sum(axis=0), kind="stable")
        self.rows = np.ascontiguousarray(rows[:, self.order])
        self.edges = [*range(0, rows.shape[1], _GROUP), rows.shape[1]]
        self.tails = _tails(self.rows, self.edges)

    def scores_from(
        self, queries: np.ndarray, tails: np.ndarray, least: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs (query, row, score) with a score of at least ``least`` of the query."""
        groups = len(self.edges) - 1
        limit = least - 1e-9 * np.abs(least) - 1e-6
        # From group g on, a row is left out if no query could reach its threshold with the rest.
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(limit[:, None] > 0, limit[:, None] / tails, -np.inf).min(axis=0)
        short = self.tails < needed
        depth = np.where(short.any(axis=1), short.argmax(axis=1), groups)
        # By falling depth: the postings of a group are the first rows.
        rows = np.argsort(-depth, kind="stable")
        rows = rows[: np.count_nonzero((depth > 0) | (needed[0] <= 0))]
        partial = np.zeros((len(queries), len(rows)))
        alive = np.ones(partial.shape, bool)
        for g in range(groups):
            here = slice(self.edges[g], self.edges[g + 1])
            posted = np.count_nonzero(depth[rows] > g)
            if not posted:
                break
            partial[:, :posted] += queries[:, here] @ self.rows[rows[:posted], here].T
            rest = tails[:, g + 1, None] * self.tails[rows[:posted], g + 1]
            alive[:, :posted] &= partial[:, :posted] + rest >= limit[:, None]
            left = alive.any(axis=0)
            rows, partial, alive = rows[left], partial[:, left], alive[:, left]
        query, place = np.nonzero(alive)
        row, score = rows[place], partial[query, place]
        for first in range(0, len(row), _PAIRS):
            q, r = query[first : first + _PAIRS], row[first : first + _PAIRS]
            done = np.asarray(self.edges)[depth[r]]
            if (done < self.edges[-1]).any():
                tail = np.arange(self.edges[-1]) >= done[:, None]
                score[first : first + _PAIRS] += (queries[q] * self.rows[r] * tail).sum(axis=1)
        reached = score >= least[query]
        return query[reached], row[reached], score[reached]

    def all_scores(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every pair, in whole numbers of any size."""
        products = _whole(queries).dot(_whole(self.rows).T)
        if products.size and max(abs(products.max()), abs(products.min())) >= _MOST_SCORE:
            raise OverflowError("a score is larger than the result can hold")
        query, row = np.divmod(np.arange(products.size), products.shape[1])
        return query, row, products.ravel()


def _tails(rows: np.ndarray, edges: list[int]) -> np.ndarray:
    """Norm of each row from each edge on."""
    return np.stack([np.linalg.norm(rows[:, at:], axis=1) for at in edges], axis=1)


def _whole(rows: np.ndarray) -> np.ndarray:
    out = np.empty(rows.shape, object)
    out.ravel()[:] = [int(x) for x in rows.ravel()]
    return out


class Anchor:
    """An anchor with its open windows: number, vec_id, label, (window, low, high) and same label."""

    def __init__(self, row, same: bool):
        self.number, self.vec_id, self.label, self.same = row.number, row.vec_id, row.label, same
        self.windows = [(w["window"], w["low"], w["high"]) for w in row.windows]
        self.low = min((low for _, low, _ in self.windows), default=0)
        self.high = max((high for _, _, high in self.windows), default=0)

    def picked(self, ids, labels, scores, want: int) -> dict[int, np.ndarray]:
        """Places of the first rows of each window; the input is in order already."""
        fits = (labels == self.label) == self.same
        if self.same:
            fits &= ids != self.vec_id
        return {
            window: np.flatnonzero(fits & (scores >= low) & (scores <= high))[:want]
            for window, low, high in self.windows
        }


def search_block(
    index: Index, queries: np.ndarray, anchors: list[Anchor], want: int
) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, window, found id, score) of the first rows of each window within a block."""
    queries = queries[:, index.order]
    tails = _tails(queries, index.edges)
    most = tails[:, 0] * (index.tails[:, 0].max() if len(index.rows) else 0)
    exact = bool((most < _EXACT).all())
    top = np.array([min(a.high, m) for a, m in zip(anchors, most, strict=True)], float)
    bottom = np.array([a.low for a in anchors], float)
    open_anchors = np.arange(len(anchors))
    for rung in (*_RUNGS, None):
        least = bottom if rung is None else np.maximum(top * rung, bottom)
        still = []
        for first in range(0, len(open_anchors), _SLICE):
            some = open_anchors[first : first + _SLICE]
            if exact:
                query, row, score = index.scores_from(queries[some], tails[some], least[some])
            else:
                query, row, score = index.all_scores(queries[some])
            order = np.lexsort((index.ids[row], -score, query))
            query, row, score = query[order], row[order], score[order]
            edges = np.searchsorted(query, np.arange(len(some) + 1))
            for n, which in enumerate(some):
                anchor, here = anchors[which], slice(edges[n], edges[n + 1])
                found = anchor.picked(
                    index.ids[row[here]], index.labels[row[here]], score[here], want
                )
                last = not exact or least[which] <= bottom[which]
                if not last and any(len(places) < want for places in found.values()):
                    still.append(which)
                    continue
                for window, places in found.items():
                    for place in places + edges[n]:
                        yield anchor.number, window, index.ids[row[place]], int(score[place])
        open_anchors = np.array(still, int)
        if not len(open_anchors):
            return


def _search(anchors: DataFrame, rows: DataFrame, want: int, same: bool) -> DataFrame:
    """Hits of every (chunk of anchors, block of rows) that share the columns chunk and block."""

    def tile(anchor_rows: pd.DataFrame, row_rows: pd.DataFrame) -> pd.DataFrame:
        hits = []
        for size in set(anchor_rows["vector"].map(len)) & set(row_rows["vector"].map(len)):
            mine = row_rows[row_rows["vector"].map(len) == size]
            theirs = anchor_rows[anchor_rows["vector"].map(len) == size]
            index = Index(
                _matrix(mine["vector"], size // 8),
                mine["vec_id"].to_numpy(),
                mine["label"].to_numpy(),
            )
            who = [Anchor(row, same) for row in theirs.itertuples()]
            hits += search_block(index, _matrix(theirs["vector"], size // 8), who, want)
        return pd.DataFrame(hits, columns=["anchor", "window", "found_id", "score"])

    return (
        anchors.groupBy("block", "chunk")
        .cogroup(rows.groupBy("block", "chunk"))
        .applyInPandas(tile, _HIT)
    )


def _first(hits: DataFrame, want: int) -> DataFrame:
    ranked = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "found_id")
    return hits.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= want)


def _best(anchors: DataFrame, rows: DataFrame, blocks: int, want: int, same: bool) -> DataFrame:
    """The first ``want`` hits of every window, ranked over all blocks."""
    start = anchors.withColumn("block", F.lit(0).cast("long"))
    seeds = written(_search(start, rows.where("block = 0"), want, same), "seeds")
    if blocks == 1:
        return _first(seeds, want)
    # A window that the first block fills needs nothing below its last hit from any other block.
    floors = (
        _first(seeds, want)
        .where(F.col("rank") == want)
        .groupBy("anchor")
        .agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("floors"))
    )
    raised = F.transform(
        "windows",
        lambda w: F.struct(
            w["window"].alias("window"),
            F.greatest(w["low"], F.try_element_at("floors", w["window"])).alias("low"),
            w["high"].alias("high"),
        ),
    )
    elsewhere = (
        anchors.join(floors, F.col("number") == F.col("anchor"), "left")
        .select("number", "vec_id", "label", "vector", "chunk", raised.alias("windows"))
        .withColumn(
            "block", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(blocks - 1).cast("long")))
        )
    )
    others = _search(elsewhere, rows.where("block > 0"), want, same)
    return _first(seeds.unionByName(others), want)


def mine(
    vectors: DataFrame,
    anchor_step: int = ANCHOR_STEP,
    rows_per_block: int = ROWS,
    anchors_per_chunk: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    with short_lived(vectors.sparkSession):
        # Written once: the running numbers must not change when a task is run again.
        table = written(_prepared(vectors), "vectors")
        is_anchor = F.col("vec_id") % anchor_step == 0
        counted = table.agg(
            F.count("*").alias("rows"), F.count_if(is_anchor).alias("anchors")
        ).first()
        blocks = max(1, -(-counted["rows"] // rows_per_block))
        chunks = max(1, -(-counted["anchors"] // anchors_per_chunk))
        # Running numbers of rows of one file follow each other, so blocks are of equal size.
        rows = table.select(
            "vec_id",
            "label",
            "vector",
            F.pmod("number", F.lit(blocks)).alias("block"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"),
        )
        # Named anew, so that Spark tells them from the rows they come from.
        anchors = table.where(is_anchor).select(
            *(F.col(c).alias(c) for c in ("number", "vec_id", "label", "vector")),
            F.pmod(F.xxhash64("number"), F.lit(chunks)).alias("chunk"),
        )
        whole = F.struct(
            F.lit(0).alias("window"),
            F.lit(-_MOST_SCORE).cast("long").alias("low"),
            F.lit(_MOST_SCORE).cast("long").alias("high"),
        )
        positives = written(
            _best(anchors.withColumn("windows", F.array(whole)), rows, blocks, POSITIVES, True),
            "positives",
        )
        # 30 p <= 100 n <= 90 p in whole numbers; where p is negative, no n fits.
        score = F.col("score").cast("decimal(38,0)")
        windows = F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("rank").cast("int").alias("window"),
                    F.ceil(score * LEAST_SHARE / 100).cast("long").alias("low"),
                    F.floor(score * MOST_SHARE / 100).cast("long").alias("high"),
                )
            )
        )
        wanted = positives.where("score >= 0").groupBy("anchor").agg(windows.alias("windows"))
        looking = anchors.join(wanted, F.col("number") == F.col("anchor")).drop("anchor")
        negatives = _best(looking, rows, blocks, NEGATIVES, False).select(
            "anchor",
            "window",
            F.col("rank").cast("int").alias("rank"),
            F.col("found_id").alias("negative_id"),
            F.col("score").alias("negative_score"),
        )
        named = positives.select(
            "anchor",
            F.col("rank").cast("int").alias("window"),
            F.col("found_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ).join(
            anchors.select(F.col("number").alias("anchor"), F.col("vec_id").alias("anchor_id")),
            "anchor",
        )
        result = negatives.join(named, ["anchor", "window"]).select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        )
        return written(result, "hard-negatives", lasting=True)
