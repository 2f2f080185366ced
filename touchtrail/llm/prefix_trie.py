"""Conversation prefix trie: adaptive radix trees over turn ids, built in parts.

A turn id is the first 16 bytes of a SHA-256 over role and text, so a conversation is a key of
fixed-width symbols. A tree keeps the bytes of its keys: nodes grow through layouts of 4, 16, 48 and
256 children, and bytes without a fork are one compressed path. Only depths that lie on a whole turn
are nodes of the trie; those inside compressed paths count.

No key, group or task grows with the corpus:

- Turns get their places from a sort by range with running numbers inside a partition, so the turns
  of one long conversation are spread; what a partition has to add is one number for a
  conversation that goes on from the partition before.
- Keys are cut into bands of BAND turns. Equal keys of a band are one key with a count. Only
  conversations that share a whole band with another one are continued in the next; what a
  conversation has for itself needs no tree and is written row by row. Sums of a subtree are carried
  back up band by band.
- A band's keys are dealt by prefix. A prefix with more than a LEAST_GROUP of keys, or more than one
  in MOST_GROUPS of all, is taken apart: the turns that all its keys share are a chain, and below
  its end each next turn is a prefix of its own. There are at most MOST_GROUPS such prefixes at a
  time, which is the bound of what is broadcast. Every other prefix is one tree, whole in its task.
- The ids that end at one node are sorted by range, joined in pieces, and the pieces are hashed as a
  stream.

Defined cases: a conversation is rebuilt from the first h turns of conversation c - c % 5 (sign of
the remainder as in SQL) and its own turns after its first h, with h = crc32(c) % SHARED_TURNS; turns
are ordered by turn, null first, equal ones by their turn id; null role or text is empty; rows
without a conv_id belong to no conversation and go; rows that repeat are turns of their own; texts
of any length are read whole; an empty table gives no rows, not even a root; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import short_lived, written

TURN_BYTES = 16
FAMILY, SHARED_TURNS = 5, 9
BAND = 512
LEAST_GROUP, MOST_GROUPS = 512, 10_000
_IDS_PER_PIECE = 4_096
_NODES_PER_BATCH = 10_000

NODE_COLUMNS = (
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


class _Sorted:
    """A layout of few children: their bytes in order, and the children beside them."""

    most = 4

    def __init__(self, items=()):
        self.bytes = bytearray(byte for byte, _ in items)
        self.slots = [child for _, child in items]

    def __len__(self) -> int:
        return len(self.slots)

    def get(self, byte: int):
        place = self.bytes.find(byte)
        return self.slots[place] if place >= 0 else None

    def add(self, byte: int, child) -> None:
        place = bisect_left(self.bytes, byte)
        self.bytes.insert(place, byte)
        self.slots.insert(place, child)

    def items(self):
        return list(zip(self.bytes, self.slots, strict=True))


class _Sorted16(_Sorted):
    most = 16


class _Indexed:
    """A layout with a place for every byte that leads to one of 48 slots."""

    most = 48

    def __init__(self, items=()):
        self.place, self.slots = bytearray(256), []
        for byte, child in items:
            self.add(byte, child)

    def __len__(self) -> int:
        return len(self.slots)

    def get(self, byte: int):
        place = self.place[byte]
        return self.slots[place - 1] if place else None

    def add(self, byte: int, child) -> None:
        self.slots.append(child)
        self.place[byte] = len(self.slots)

    def items(self):
        return [(byte, self.slots[n - 1]) for byte, n in enumerate(self.place) if n]


class _Direct:
    """A layout with a slot for every byte."""

    most = 256

    def __init__(self, items=()):
        self.slots, self.filled = [None] * 256, 0
        for byte, child in items:
            self.add(byte, child)

    def __len__(self) -> int:
        return self.filled

    def get(self, byte: int):
        return self.slots[byte]

    def add(self, byte: int, child) -> None:
        self.slots[byte] = child
        self.filled += 1

    def items(self):
        return [(byte, child) for byte, child in enumerate(self.slots) if child is not None]


_LARGER = {_Sorted: _Sorted16, _Sorted16: _Indexed, _Indexed: _Direct}


class _Node:
    __slots__ = ("path", "leaf", "children")

    def __init__(self, path: bytes, leaf=None):
        self.path, self.leaf, self.children = path, leaf, _Sorted()

    def add(self, byte: int, child: _Node) -> None:
        if len(self.children) == self.children.most:
            self.children = _LARGER[type(self.children)](self.children.items())
        self.children.add(byte, child)


class RadixTree:
    """An adaptive radix tree over byte strings; each key holds one leaf."""

    def __init__(self):
        self.root = _Node(b"")

    def insert(self, key: bytes, leaf) -> None:
        node, at = self.root, 0
        while True:
            common = _common(node.path, key, at)
            if common < len(node.path):
                lower = _Node(node.path[common + 1 :], node.leaf)
                lower.children = node.children
                fork = node.path[common]
                node.path, node.leaf, node.children = node.path[:common], None, _Sorted()
                node.add(fork, lower)
            at += common
            if at == len(key):
                node.leaf = leaf
                return
            child = node.children.get(key[at])
            if child is None:
                node.add(key[at], _Node(key[at + 1 :], leaf))
                return
            node, at = child, at + 1

    def aligned(self, width: int = TURN_BYTES) -> Iterator[tuple[int, int, object]]:
        """(depth, place of the parent, leaf or None) at every multiple of ``width`` bytes.

        Parents come before their children; the place counts what was returned so far.
        """
        count = 0
        stack = [(self.root, 0, -1)]
        while stack:
            node, start, parent = stack.pop()
            end = start + len(node.path)
            for at in range(-(-start // width) * width, end + 1, width):
                yield at // width, parent, node.leaf if at == end else None
                parent = count
                count += 1
            stack += [(child, end + 1, parent) for _, child in node.children.items()]


def _common(path: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``path`` and ``key`` from ``at`` on."""
    if key.startswith(path, at):
        return len(path)
    low, high = 0, min(len(path), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if path[:middle] == key[at : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _sha(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, TURN_BYTES)


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, turn_id, bytes) of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        _sha(marked).alias("turn_id"),
        F.octet_length(text).cast("long").alias("bytes"),
        # Rows that repeat can be told apart, so that a range may end between them.
        F.monotonically_increasing_id().alias("number"),
    )
    order = ("conv_id", F.asc_nulls_first("turn"), "turn_id", "number")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, reached = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_numpy()
            starts = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1 if last is None else last))
            offset = np.zeros(len(ids), np.int64)
            offset[starts] = np.diff(starts, prepend=-reached)
            places = np.arange(reached, reached + len(ids)) - np.cumsum(offset) + 1
            last, reached = int(ids[-1]), int(places[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array(np.full(len(ids), part, np.int32)),
                    pa.array(places),
                    batch.column("turn_id"),
                    batch.column("bytes"),
                ],
                names=["conv_id", "part", "place", "turn_id", "bytes"],
            )

    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    table = written(
        sorted_rows.mapInArrow(
            numbered, "conv_id long, part int, place long, turn_id binary, bytes long"
        ),
        "turns",
    )
    # A conversation in several parts runs over the ends of parts; there are no more of these
    # than parts, so this table is small however many conversations there are.
    runs = table.groupBy("conv_id", "part").agg(F.max("place").alias("n"))
    parts = runs.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("runs"))
    offsets = parts.where(F.size("runs") > 1).select(
        "conv_id",
        F.inline(
            F.transform(
                "runs",
                lambda run: F.struct(
                    run["part"].alias("part"),
                    F.aggregate(
                        F.filter("runs", lambda r: r["part"] < run["part"]),
                        F.lit(0).cast("long"),
                        lambda total, r: total + r["n"],
                    ).alias("before"),
                ),
            )
        ),
    )
    return table.join(F.broadcast(offsets), ["conv_id", "part"], "left").select(
        "conv_id",
        (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"),
        "turn_id",
        "bytes",
    )


def _bands(conversations: DataFrame, band: int) -> DataFrame:
    """(conv_id, band, total, key, sizes) of every rebuilt conversation, in bands of its turns."""
    turns = _turns(conversations)
    h = (F.crc32(F.col("conv_id").cast("string")) % SHARED_TURNS).cast("int")
    lengths = turns.groupBy("conv_id").agg(F.max("place").alias("length"))
    heads = (
        turns.where((F.col("place") < SHARED_TURNS) & (F.col("conv_id") % FAMILY == 0))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "turn_id", "bytes"))).alias("head"))
    )
    # h is 0 to 8, and slice() gives an empty array for a length of 0.
    taken = F.slice(
        F.coalesce("head", F.array().cast("array<struct<place:bigint,turn_id:binary,bytes:bigint>>")),
        F.lit(1),
        F.col("h"),
    )
    convs = (
        lengths.select(
            "conv_id",
            "length",
            h.alias("h"),
            (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
        )
        .join(heads, "base", "left")
        .withColumn("head", taken)
        .withColumn(
            "total",
            F.size("head").cast("long") + F.greatest(F.col("length") - F.col("h"), F.lit(0)),
        )
    )
    convs = written(convs, "conversations")
    shared = convs.select("conv_id", "total", F.inline("head"))
    # A long conversation meets its own row once per stretch, not in one key.
    stretch = (F.floor((F.col("place") - 1) / band)).alias("stretch")
    own = turns.select("conv_id", stretch, "place", "turn_id", "bytes").join(
        convs.where("length > h").select(
            "conv_id",
            "total",
            "h",
            (F.size("head") - F.col("h")).alias("moved"),
            F.explode(
                F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / band))
            ).alias("stretch"),
        ),
        ["conv_id", "stretch"],
    )
    own = own.where("place > h").select(
        "conv_id", "total", (F.col("place") + F.col("moved")).alias("place"), "turn_id", "bytes"
    )
    in_order = F.sort_array(F.collect_list(F.struct("place", "turn_id", "bytes")))
    cut = (
        shared.unionByName(own)
        .groupBy("conv_id", F.floor((F.col("place") - 1) / band).cast("int").alias("band"), "total")
        .agg(in_order.alias("turns"))
        .select(
            "conv_id",
            "band",
            "total",
            F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["turn_id"])), "")).alias("key"),
            F.col("turns.bytes").alias("sizes"),
        )
    )
    turnless = convs.where("total = 0").select(
        "conv_id",
        F.lit(0).alias("band"),
        "total",
        F.lit(b"").alias("key"),
        F.array().cast("array<bigint>").alias("sizes"),
    )
    return cut.unionByName(turnless)


def _ends(members: DataFrame) -> DataFrame:
    """(end_id, ends_sha256) of the conversations that end at each end_id."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids = None, []

        def piece():
            return pa.RecordBatch.from_pydict(
                {
                    "end_id": pa.array([here], pa.binary()),
                    "first": pa.array([ids[0]], pa.int64()),
                    "text": pa.array([",".join(map(str, ids))], pa.string()),
                }
            )

        for batch in batches:
            out = []
            for end_id, conv_id in zip(
                batch.column("end_id").to_pylist(), batch.column("conv_id").to_pylist(), strict=True
            ):
                if ids and (end_id != here or len(ids) == _IDS_PER_PIECE):
                    out.append(piece())
                    ids = []
                here = end_id
                ids.append(conv_id)
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if ids:
            yield piece()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, digest = None, None

        def rows(found):
            return pa.RecordBatch.from_pydict(
                {
                    "end_id": pa.array([e for e, _ in found], pa.binary()),
                    "ends_sha256": pa.array([d for _, d in found], pa.string()),
                }
            )

        for batch in batches:
            out = []
            for end_id, text in zip(
                batch.column("end_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                if end_id == here:
                    digest.update(b"," + text.encode())
                    continue
                if digest is not None:
                    out.append((here, digest.hexdigest()))
                here, digest = end_id, hashlib.sha256(text.encode())
            yield rows(out)
        if digest is not None:
            yield rows([(here, digest.hexdigest())])

    in_pieces = (
        members.repartitionByRange("end_id", "conv_id")
        .sortWithinPartitions("end_id", "conv_id")
        .mapInArrow(pieces, "end_id binary, first long, text string")
    )
    return (
        in_pieces.repartition("end_id")
        .sortWithinPartitions("end_id", "first")
        .mapInArrow(hashed, "end_id binary, ends_sha256 string")
    )


# A key of a band with what it stands for; cut, gid, under and above say which tree it is in.
_NODE_ROWS = (
    "root binary, under binary, top boolean, conv_id long, depth long, parent_conv_id long,"
    " n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
_NODE_SCHEMA = pa.schema(
    [
        ("root", pa.binary()),
        ("under", pa.binary()),
        ("top", pa.bool_()),
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()),
    ]
)


def tree_nodes(keys: list[dict]) -> Iterator[tuple]:
    """The nodes of one prefix from its own depth down, as rows of _NODE_ROWS."""
    tree, cut = RadixTree(), keys[0]["cut"]
    for key in keys:
        tree.insert(key["key"][cut * TURN_BYTES :], key)
    shape = list(tree.aligned())
    size = len(shape)
    members, least = [0] * size, [None] * size
    children, leaves, saved, sample = [0] * size, [0] * size, [0] * size, [None] * size
    for n in range(size - 1, -1, -1):
        depth, parent, leaf = shape[n]
        if leaf is not None:
            members[n] += leaf["n"]
            least[n] = leaf["least"] if least[n] is None else min(least[n], leaf["least"])
            children[n] += leaf["hang_children"]
            leaves[n] += leaf["hang_leaves"]
            saved[n] += leaf["hang_saved"]
            sample[n] = leaf["sizes"]
        if children[n] == 0:
            leaves[n] = 1
        if cut + depth > 0:
            saved[n] += (members[n] - 1) * sample[n][cut + depth - 1]
        if parent >= 0:
            members[parent] += members[n]
            least[parent] = least[n] if least[parent] is None else min(least[parent], least[n])
            children[parent] += 1
            leaves[parent] += leaves[n]
            saved[parent] += saved[n]
            sample[parent] = sample[n]
    any_key = keys[0]
    if cut == 0 and any_key["root_least"] is not None:
        least[0] = any_key["root_least"]
    for n, (depth, parent, leaf) in enumerate(shape):
        yield (
            any_key["root"],
            any_key["under"],
            n == 0,
            least[n],
            cut + depth,
            any_key["above"] if parent < 0 else least[parent],
            members[n],
            children[n],
            leaves[n],
            saved[n],
            _NO_ENDS if leaf is None else leaf["ends_sha256"],
        )


def _in_trees(keys: DataFrame) -> DataFrame:
    """The trees of all prefixes, each whole in one task; a task holds one at a time."""

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        rows: list[tuple] = []

        def batch_of(found):
            columns = [
                pa.array(column, field.type)
                for column, field in zip(zip(*found), _NODE_SCHEMA, strict=True)
            ]
            return pa.RecordBatch.from_arrays(columns, schema=_NODE_SCHEMA)

        for batch in batches:
            for key in batch.to_pylist():
                if group and key["gid"] != group[0]["gid"]:
                    rows += tree_nodes(group)
                    group = []
                    if len(rows) >= _NODES_PER_BATCH:
                        yield batch_of(rows)
                        rows = []
                group.append(key)
        if group:
            rows += tree_nodes(group)
        if rows:
            yield batch_of(rows)

    return keys.repartition("gid").sortWithinPartitions("gid").mapInArrow(grown, _NODE_ROWS)


def _shared_turns(one: Column, other: Column) -> Column:
    """How many leading turns two keys have in common."""
    whole = F.least(F.octet_length(one), F.octet_length(other)) / TURN_BYTES
    at = F.sequence(F.lit(0), F.greatest(whole.cast("int") - 1, F.lit(0)))
    differs = F.filter(
        at,
        lambda n: ~one.substr(n * TURN_BYTES + 1, F.lit(TURN_BYTES)).eqNullSafe(
            other.substr(n * TURN_BYTES + 1, F.lit(TURN_BYTES))
        ),
    )
    return F.coalesce(F.array_min(differs), whole.cast("int"))


def _gid(cut: Column | str) -> Column:
    cut = F.col(cut) if isinstance(cut, str) else cut
    return _sha("root", F.col("key").substr(F.lit(1), cut * TURN_BYTES))


def _nodes(keys: DataFrame, least_group: int) -> DataFrame:
    """The nodes of one band, its roots (depth 0) included, as rows of _NODE_ROWS."""
    keys = written(
        keys.select(
            "*",
            F.lit(0).alias("cut"),
            F.lit(None).cast("binary").alias("under"),
            F.lit(None).cast("long").alias("above"),
            _gid(F.lit(0)).alias("gid"),
        ),
        "keys",
    )
    limit = max(least_group, keys.count() // MOST_GROUPS)
    whole, chains, left = [], [], keys
    while True:
        groups = left.groupBy("gid").agg(
            F.count("*").alias("keys"),
            F.sum("n").alias("n"),
            F.min("least").alias("least"),
            F.min("root_least").alias("root_least"),
            F.min("key").alias("first"),
            F.max("key").alias("last"),
        )
        facts = left.groupBy("gid").agg(
            F.min("root").alias("root"),
            F.min("cut").alias("start"),
            F.min("under").alias("under"),
            F.min("above").alias("above"),
        )
        hot = groups.where(F.col("keys") > limit).join(facts, "gid")
        end = _shared_turns(F.col("first"), F.col("last"))
        hot = hot.select(
            "gid",
            "root",
            "start",
            "under",
            "above",
            "n",
            "least",
            "root_least",
            end.alias("end"),
            F.col("first").alias("key"),
        ).withColumn("hot_id", _sha("root", F.col("key").substr(F.lit(1), F.col("end") * TURN_BYTES), F.lit(b"hot")))
        hot = written(hot.drop("key"), "chains")
        if hot.isEmpty():
            whole.append(left)
            break
        # Each holds more than one in MOST_GROUPS of all keys, so there are fewer than that.
        told = F.broadcast(
            hot.select(
                "gid",
                "hot_id",
                "end",
                F.when(F.col("end") == 0, F.coalesce("root_least", "least"))
                .otherwise(F.col("least"))
                .alias("next_above"),
            )
        )
        judged = written(left.join(told, "gid", "left"), "keys")
        whole.append(judged.where("hot_id IS NULL").select(*keys.columns))
        turns = F.octet_length("key") / TURN_BYTES
        in_hot = judged.where("hot_id IS NOT NULL")
        # All keys of a chain have the sizes of its turns; one of them may end where it ends.
        at_end = in_hot.where(turns == F.col("end")).select(
            "hot_id", "hang_children", "hang_leaves", "hang_saved", "ends_sha256"
        )
        sizes = in_hot.groupBy("hot_id").agg(
            F.min(F.slice("sizes", F.lit(1), F.col("end"))).alias("sizes")
        )
        chains.append(hot.join(sizes, "hot_id").join(at_end, "hot_id", "left"))
        left = in_hot.where(turns > F.col("end")).select(
            *(c for c in keys.columns if c not in ("cut", "under", "above", "gid")),
            (F.col("end") + 1).alias("cut"),
            F.col("hot_id").alias("under"),
            F.col("next_above").alias("above"),
            _gid(F.col("end") + 1).alias("gid"),
        )
    dealt = whole[0]
    for more in whole[1:]:
        dealt = dealt.unionByName(more)
    nodes = written(_in_trees(dealt), "nodes")
    tops = nodes.where("top")
    for chain in reversed(chains):
        below = tops.where("under IS NOT NULL").groupBy(F.col("under").alias("hot_id")).agg(
            F.count("*").alias("children"),
            F.sum("n_leaves").alias("leaves"),
            F.sum("saved_tokens").alias("saved"),
        )
        grown = written(_chain_nodes(chain.join(below, "hot_id")), "nodes")
        nodes = nodes.unionByName(grown)
        tops = tops.unionByName(grown.where("top"))
    return nodes


def _chain_nodes(chains: DataFrame) -> DataFrame:
    """One row per depth of each chain, from its start to the node where it forks."""
    none = F.lit(0).cast("long")
    to_end = F.aggregate(
        F.slice("sizes", F.greatest("depth", F.lit(1)), F.col("end") - F.greatest("depth", F.lit(1)) + 1),
        none,
        lambda total, size: total + size,
    )
    at_end = F.col("depth") == F.col("end")
    at_root = F.col("depth") == 0
    return chains.select("*", F.explode(F.sequence("start", "end")).alias("depth")).select(
        "root",
        "under",
        (F.col("depth") == F.col("start")).alias("top"),
        F.when(at_root, F.coalesce("root_least", "least")).otherwise(F.col("least")).alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") == F.col("start"), F.col("above"))
        .when(F.col("depth") == 1, F.coalesce("root_least", "least"))
        .otherwise(F.col("least"))
        .alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(at_end, F.col("children") + F.coalesce("hang_children", none))
        .otherwise(1)
        .alias("n_children"),
        (F.col("leaves") + F.coalesce("hang_leaves", none)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("hang_saved", none) + (F.col("n") - 1) * to_end).alias(
            "saved_tokens"
        ),
        F.when(at_end, F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
        .otherwise(F.lit(_NO_ENDS))
        .alias("ends_sha256"),
    )


def _distinct_keys(members: DataFrame, reached: int) -> DataFrame:
    """Equal keys below one root as one row; ``reached``: turns up to the end of the band."""
    keys = members.groupBy("root", "root_least", "end_id", "key", "sizes").agg(
        F.count("*").alias("n"),
        F.min("conv_id").alias("least"),
        F.max("total").alias("total"),
        F.count_if(F.col("total") <= reached).alias("enders"),
        F.min(F.when(F.col("total") <= reached, F.col("conv_id"))).alias("first_ender"),
    )
    ended = members.where(F.col("total") <= reached).select("end_id", "conv_id")
    several = _ends(ended)
    one = F.sha2(F.col("first_ender").cast("string"), 256)
    return keys.join(several, "end_id", "left").withColumn(
        "ends_sha256",
        F.when(F.col("enders") > 1, F.col("ends_sha256"))
        .when(F.col("enders") == 1, one)
        .otherwise(F.lit(_NO_ENDS)),
    )


def _tails(alone: DataFrame, pieces: DataFrame, first_band: int, band: int) -> DataFrame:
    """Nodes of conversations that have the rest of their turns to themselves."""
    last = F.floor((F.col("total") - 1) / band).cast("int")
    theirs = alone.select(
        F.col("least").alias("conv_id"),
        F.explode(F.sequence(F.lit(first_band), last)).alias("band"),
    )
    rows = pieces.join(theirs, ["conv_id", "band"]).select(
        "conv_id", "total", (F.col("band").cast("long") * band).alias("before"), F.posexplode("sizes")
    )
    depth = F.col("before") + F.col("pos") + 1
    ends = F.when(depth == F.col("total"), F.sha2(F.col("conv_id").cast("string"), 256))
    return rows.select(
        "conv_id",
        depth.alias("depth"),
        F.col("conv_id").alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when(depth < F.col("total"), 1).otherwise(0).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.coalesce(ends, F.lit(_NO_ENDS)).alias("ends_sha256"),
    )


def prefix_nodes(
    conversations: DataFrame, band: int = BAND, least_group: int = LEAST_GROUP
) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations; see the module for the columns."""
    with short_lived(conversations.sparkSession):
        pieces = written(_bands(conversations, band), "bands")
        longest = pieces.agg(F.max("total")).first()[0]
        if longest is None:
            return written(
                pieces.sparkSession.createDataFrame([], _NODE_ROWS).select(*NODE_COLUMNS),
                "trie",
                lasting=True,
            )
        members = pieces.where("band = 0").withColumns(
            {"root": F.lit(b""), "root_least": F.lit(None).cast("long")}
        )
        by_band, number = [], 0
        while True:
            members = written(
                members.select(
                    "conv_id", "total", "key", "sizes", "root", "root_least",
                    _sha("root", "key").alias("end_id"),
                ),
                "members",
            )
            reached = (number + 1) * band
            keys = written(_distinct_keys(members, reached), "distinct")
            by_band.append(keys)
            if longest <= reached:
                break
            # The next band has those who share this one whole with somebody.
            shared = keys.where((F.col("n") > 1) & (F.col("total") > reached)).select(
                F.col("end_id").alias("next_root"), F.col("least").alias("next_least")
            )
            going = members.where(F.col("total") > reached).join(
                shared, F.col("end_id") == F.col("next_root")
            )
            number += 1
            members = pieces.where(F.col("band") == number).join(
                going.select(
                    "conv_id",
                    F.col("next_root").alias("root"),
                    F.col("next_least").alias("root_least"),
                ),
                "conv_id",
            )
            if members.isEmpty():
                break
        # From the last band up: what hangs below the end of a key is known when its band's turn comes.
        hanging, out = None, []
        for number in range(len(by_band) - 1, -1, -1):
            keys, reached = by_band[number], (number + 1) * band
            goes_on = F.col("total") > reached
            alone = goes_on & (F.col("n") == 1)
            if hanging is not None:
                keys = keys.join(hanging, "end_id", "left")
            hang = {
                "hang_children": F.when(alone, 1),
                "hang_leaves": F.when(alone, 1),
                "hang_saved": F.when(alone, 0),
            }
            for name, own in hang.items():
                beneath = [F.col(f"{name}_below")] if hanging is not None else []
                hang[name] = F.coalesce(own, *beneath, F.lit(0)).cast("long")
            nodes = _nodes(keys.withColumns(hang).drop("end_id", "enders", "first_ender"), least_group)
            hanging = nodes.where("depth = 0").select(
                F.col("root").alias("end_id"),
                F.col("n_children").alias("hang_children_below"),
                F.col("n_leaves").alias("hang_leaves_below"),
                F.col("saved_tokens").alias("hang_saved_below"),
            )
            shown = nodes if number == 0 else nodes.where("depth > 0")
            out.append(
                shown.withColumn("depth", F.col("depth") + number * band).select(*NODE_COLUMNS)
            )
            if longest > reached:
                out.append(_tails(by_band[number].where(alone), pieces, number + 1, band))
        result = out[0]
        for more in out[1:]:
            result = result.unionByName(more)
        return written(result, "trie", lasting=True)
