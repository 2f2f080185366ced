"""Near-duplicate vectors: spherical k-means cells and blocked cosine products.

Equal vectors are one member with a weight. Members belong to the cell of their nearest centroid.
A member also visits every other cell whose border with its own is so close that a link could
cross it: if x lives in cell c and y in d, and |x - y| <= r, then x.(c - d) + y.(d - c) <=
r |c - d| with both terms non-negative, so one of them is at most half of that. A member visits d
if its own term is, hence every link is met in a cell, and no link is lost to the cells.

Cells of many members are cut into blocks by a hash, and blocks are multiplied pair by pair, so a
group of any size is spread over tasks. A block reports link weights and one edge per joined
member, not its pairs.

The centroids are fitted on at most about SAMPLE vectors; their number grows with the input up to
MOST_CELLS, which bounds what is sent to tasks.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component link
with nothing; vectors of different length are never compared; repeated rows count as vectors of
their own; a null vec_id keeps its row and is linked like any other, but never names a component;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import components, written

THRESHOLD = 0.95
SAMPLE = 20_000
MEMBERS_PER_CELL = 512
MOST_CELLS = 4_096
ROUNDS = 8
BLOCK = 2_048

# Half of the longest chord between linked members; a little more, for rounding.
_HALF_CHORD = np.sqrt(2 - 2 * THRESHOLD) / 2 + 1e-9

_BLOCK_ROWS = (
    "size int, cell int, row int, column int, side int, member binary, weight long, home boolean,"
    " vector binary"
)
# A member of a block stands in its rows, its columns, or both.
_ROW, _COLUMN = 1, 2


def spherical_k_means(rows: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit rows. Starts from rows spread evenly over the sample."""
    start = np.linspace(0, len(rows) - 1, min(cells, len(rows))).astype(int)
    centroids = rows[np.unique(start)]
    for _ in range(rounds):
        nearest = (rows @ centroids.T).argmax(axis=1)
        order = np.argsort(nearest, kind="stable")
        at = np.flatnonzero(np.diff(nearest[order], prepend=-1))
        sums = np.add.reduceat(rows[order], at, axis=0)
        lengths = np.linalg.norm(sums, axis=1)
        # A cell that lost all members, or whose members cancel out, is given up.
        centroids = sums[lengths > 0] / lengths[lengths > 0][:, None]
    return centroids


def _visits(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each row, and which cells it has to be compared in, home included."""
    near = rows @ centroids.T
    home = near.argmax(axis=1)
    between = 2 - 2 * (centroids @ centroids.T)
    reach = np.sqrt(np.maximum(between, 0)) * _HALF_CHORD
    own = near[np.arange(len(rows)), home]
    visits = own[:, None] - near <= reach[home]
    visits[np.arange(len(rows)), home] = True
    return home, visits


def _unit(vectors: list[bytes], kind: np.dtype) -> np.ndarray:
    rows = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def _members(kind: np.dtype):
    """vec_id and the bytes of its vector, null where it links with nothing.

    The sign of a zero component does not matter.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = []
            for vector in batch.column(1):
                values = vector.values
                row = None
                if values is not None and len(values) and not values.null_count:
                    row = values.to_numpy(zero_copy_only=False).astype(kind) + kind.type(0)
                    length = np.linalg.norm(row.astype(np.float64))
                    if not np.isfinite(length) or length == 0:
                        row = None
                vectors.append(None if row is None else row.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(vectors, pa.binary())], ["vec_id", "vector"]
            )

    return rows


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    spark = embeddings.sparkSession
    element = embeddings.schema["embedding"].dataType.elementType.simpleString()
    kind = np.dtype(np.float32 if element == "float" else np.float64)
    rows = written(
        embeddings.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<float>" if element == "float" else "array<double>"),
        )
        .mapInArrow(_members(kind), "vec_id long, vector binary")
        .withColumn("member", F.unhex(F.md5("vector"))),
        "vectors",
    )
    members = written(
        rows.where("vector is not null")
        .groupBy("member")
        .agg(
            F.count("*").alias("weight"),
            F.min("vec_id").alias("first_id"),
            F.first("vector").alias("vector"),
        ),
        "members",
    )
    sent = spark.sparkContext.broadcast(_centroids(members, kind))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, _, home, visits in _placed(batch, sent.value, kind):
                residents = np.bincount(home, minlength=visits.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(visits.shape[1], size, np.int32)),
                        pa.array(np.arange(visits.shape[1], dtype=np.int32)),
                        pa.array(residents),
                        pa.array(visits.sum(axis=0)),
                    ],
                    ["size", "cell", "residents", "everyone"],
                )

    chosen = members.select("member", "weight", "vector")
    counts = (
        chosen.mapInArrow(count, "size int, cell int, residents long, everyone long")
        .groupBy("size", "cell")
        .agg(F.sum("residents").alias("residents"), F.sum("everyone").alias("everyone"))
        .where("residents > 0")
    )
    # One row per cell, MOST_CELLS for each length that has cells; all other lengths have one cell
    # and are few, or their vectors are.
    grid = {
        (row["size"], row["cell"]): (-(-row["residents"] // BLOCK), -(-row["everyone"] // BLOCK))
        for row in counts.collect()
    }
    sent_grid = spark.sparkContext.broadcast(grid)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, chosen, home, visits in _placed(batch, sent.value, kind):
                names = batch.column("member").take(pa.array(chosen)).to_pylist()
                taken, cells, places, sides, homes = [], [], [], [], []
                for n, cell in zip(*(axis.tolist() for axis in np.nonzero(visits))):
                    if (size, cell) not in sent_grid.value:
                        continue
                    height, width = sent_grid.value[size, cell]
                    number = int.from_bytes(names[n][:8], "little")
                    row, column = number % height, (number >> 32) % width
                    at_home = bool(home[n] == cell)
                    own = {(other, column): _COLUMN for other in range(height)}
                    if at_home:
                        for other in range(width):
                            own[row, other] = own.get((row, other), 0) | _ROW
                    taken += [int(chosen[n])] * len(own)
                    cells += [cell] * len(own)
                    homes += [at_home] * len(own)
                    places += own.keys()
                    sides += own.values()
                if not taken:
                    continue
                where = np.array(places, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(taken), size, np.int32)),
                        pa.array(cells, pa.int32()),
                        pa.array(where[:, 0]),
                        pa.array(where[:, 1]),
                        pa.array(sides, pa.int32()),
                        *(batch.column(name).take(pa.array(taken)) for name in ("member", "weight")),
                        pa.array(homes),
                        batch.column("vector").take(pa.array(taken)),
                    ],
                    ["size", "cell", "row", "column", "side", "member", "weight", "home", "vector"],
                )

    def multiply(block: pa.Table) -> pa.Table:
        return _linked(block, sent.value, kind)

    found = written(
        chosen.mapInArrow(deal, _BLOCK_ROWS)
        .groupBy("size", "cell", "row", "column")
        .applyInArrow(multiply, "a binary, b binary, links long"),
        "links",
    )
    links = found.groupBy(F.col("a").alias("member")).agg(F.sum("links").alias("links"))
    roots = components(found.select("a", "b")).withColumnRenamed("node", "member")
    grouped = members.select("member", "weight", "first_id").join(roots, "member", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "member"))
    named = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_member = (
        grouped.join(named, "root")
        .join(links, "member", "left")
        .select(
            "member",
            "component_id",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return (
        rows.select("vec_id", "member")
        .join(per_member, "member", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            (F.col("vec_id") == component).alias("kept"),
        )
    )


def _placed(
    batch: pa.RecordBatch, centroids: dict[int, np.ndarray], kind: np.dtype
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per length of vectors, a thousand at a time: their rows, home cells and visited cells."""
    vectors = batch.column("vector").to_pylist()
    length = np.array([len(v) for v in vectors])
    for size in np.unique(length).tolist():
        of_size = np.flatnonzero(length == size)
        for start in range(0, len(of_size), 1024):
            chosen = of_size[start : start + 1024]
            if size in centroids:
                home, visits = _visits(_unit([vectors[n] for n in chosen], kind), centroids[size])
            else:
                home, visits = np.zeros(len(chosen), int), np.ones((len(chosen), 1), bool)
            yield size, chosen, home, visits


def _centroids(members: DataFrame, kind: np.dtype) -> dict[int, np.ndarray]:
    """Centroids by the number of bytes of a vector, from a sample chosen by a hash."""
    sizes = members.groupBy(F.length("vector").alias("size")).count()
    # Lengths that few vectors have need no cells of their own.
    counts = {
        row["size"]: row["count"] for row in sizes.orderBy(F.desc("count")).limit(16).collect()
    }
    total = sum(counts.values())
    if not total:
        return {}
    share = min(1.0, SAMPLE / total)
    drawn = members.where(F.pmod(F.xxhash64("member"), F.lit(1_000_003)) < share * 1_000_003)
    sample: dict[int, list[bytes]] = {}
    for row in drawn.select("vector").collect():  # about SAMPLE rows
        sample.setdefault(len(row["vector"]), []).append(bytes(row["vector"]))
    out = {}
    for size, vectors in sample.items():
        cells = min(MOST_CELLS, counts.get(size, 0) // MEMBERS_PER_CELL)
        if cells > 1:
            out[size] = spherical_k_means(_unit(sorted(vectors), kind), cells)
    return out


def _linked(block: pa.Table, centroids: dict[int, np.ndarray], kind: np.dtype) -> pa.Table:
    """Links of a block: their weight per member, and an edge for each member that they join."""
    side = block.column("side").to_numpy()
    member = block.column("member").to_pylist()
    weight = block.column("weight").to_numpy()
    home = block.column("home").to_numpy(zero_copy_only=False)
    cell, size = block.column("cell")[0].as_py(), block.column("size")[0].as_py()
    unit = _unit(block.column("vector").to_pylist(), kind)
    left, right = np.flatnonzero(side & _ROW), np.flatnonzero(side & _COLUMN)
    empty = pa.table(
        {"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary()), "links": pa.array([], pa.int64())}
    )
    if not len(left) or not len(right):
        return empty
    linked = unit[left] @ unit[right].T >= THRESHOLD
    position = {member[n]: i for i, n in enumerate(right.tolist())}
    for i, n in enumerate(left.tolist()):
        if member[n] in position:
            linked[i, position[member[n]]] = False
    rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(rows):
        return empty
    left, right, linked = left[rows], right[columns], linked[np.ix_(rows, columns)]
    table = centroids.get(size)
    resident = home[right]
    counted = linked.copy()
    if table is not None and not resident.all():
        # A link that two cells see is counted in the smaller one.
        _, seen = _visits(unit[left], table)
        of_right = (unit[right] @ table.T).argmax(axis=1)
        counted &= resident[None, :] | ~seen[:, of_right] | (of_right > cell)[None, :]
    of_left = counted @ weight[right]
    # Residents are rows as well; visitors get their share here.
    of_right = weight[left] @ (counted & ~resident[None, :])
    label = _joined(linked)
    names = [*left.tolist(), *right.tolist()]
    first = {}
    for n, own in zip(names, label.tolist()):
        first.setdefault(own, member[n])
    return pa.table(
        {
            "a": pa.array([member[n] for n in names], pa.binary()),
            "b": pa.array([first[own] for own in label.tolist()], pa.binary()),
            "links": pa.array(np.concatenate((of_left, of_right)).astype(np.int64)),
        }
    )


def _joined(linked: np.ndarray) -> np.ndarray:
    """A common label for the rows and columns that links join."""
    height, width = linked.shape
    label = np.arange(height + width)
    far = height + width
    while True:
        before = label.copy()
        rows = np.where(linked, label[None, height:], far).min(axis=1)
        label[:height] = np.minimum(label[:height], rows)
        columns = np.where(linked, label[:height, None], far).min(axis=0)
        label[height:] = np.minimum(label[height:], columns)
        label = label[label]
        if (label == before).all():
            return label
