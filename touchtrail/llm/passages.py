"""Removal of byte passages that occur earlier in the collection.

A byte goes when it is covered by a string of 100 bytes that also starts earlier: in a document of
smaller id, or further left in the same document.

1. Anchors. Every window of 100 bytes picks the smallest of its 40-byte grams in a hashed order,
   the leftmost among equals. Neighbouring windows with the same pick form a piece. Equal windows
   pick the same gram at the same distance, so they lie in pieces of the same anchor, and a piece
   whose anchor occurs once cannot hold a repeated window.
2. Copies of whole pieces. Of pieces with equal anchor and equal bytes only the first one matters
   further on; all windows of the others start later.
3. Columns. Pieces of one anchor that differ are compared by their suffixes. They are gathered in
   blocks and trimmed to windows of which another piece has at least the middle part. The
   Burrows-Wheeler transform and the common prefixes of a block's collection are then built column
   by column: each round inserts one symbol per piece, places the new suffixes by the
   ranks of their symbols, and derives the new common prefixes from range minima of the old ones.
   Suffixes that share 100 bytes are neighbours; all but the earliest one are removed windows.
   An anchor with more pieces than a block takes is dealt over several blocks, which pass on the
   first window of each class; classes then meet by a 128-bit hash.

Blocks have a fixed size, so the arrays that the rounds run through are held in memory; between the
steps the collection lies in written tables.

Defined cases: a null text is an empty one; a text below 100 bytes loses nothing; a repeated row
(same doc_id and text) is no earlier copy of itself, so both rows give the same result; a row
without doc_id is kept whole and takes part in no match; an empty table gives no rows; other
columns pass through ``remove_passages`` and are ignored by ``passage_digests``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    LongType,
    StringType,
    StructField,
    StructType,
)

from touchtrail.llm.common import _BASE, _BYTE_CODE, mixed, powers, short_lived, written

WINDOW = 100
GRAM = 40
# Bytes hashed at once, small enough for the processor's cache; windows may span two of them.
CHUNK = 1 << 16
# Bytes of pieces in one block of columns, and pieces of one anchor that it takes.
BLOCK = 300_000
BLOCK_PIECES = 2_000

# Windows that are looked at together when a piece is trimmed.
CORE_STEP = 16

_PLACE = np.uint64(2 * CHUNK - 1)
_STEPS = powers(np.uint64(0x9E3779B97F4A7C15), 8)[1:]


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 2**64))
    size = 2 * CHUNK
    return powers(_BASE, size), powers(inverse, size)


def _grams(codes: np.ndarray) -> np.ndarray:
    """Hash of every GRAM codes in a row, from hashes of 1, 2, 4 ... codes."""
    count, left, step, at = max(0, len(codes) - GRAM + 1), GRAM, 1, 0
    out = np.zeros(count, np.uint64)
    for factor in _STEPS:
        if left & step:
            out = out * _STEPS[-1] + codes[at : at + count]
            at += step
            left -= step
        if not left:
            break
        codes = codes[:-step] * factor + codes[step:]
        step *= 2
    return mixed(out)


def _least_place(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest gram among every ``width`` in a row."""
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    have = 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        rest = width - have
        least = np.minimum(least[:-rest], least[rest:])
    return (least & _PLACE).astype(np.int64)


def pieces(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Pieces of texts laid end to end: start, windows, anchor and its distance from the start,
    hash of the bytes, text.

    Texts are cut into chunks; a piece never spans two texts or two chunks.
    """
    power, inverse = _tables()
    start, size = 0, len(data)
    while start + WINDOW <= size:
        part = data[start : start + CHUNK + WINDOW - 1]
        codes = _BYTE_CODE[part]
        grams = _grams(codes)
        places = _least_place(grams, WINDOW - GRAM + 1)
        count = len(places)
        first = int(np.searchsorted(offsets, start, "right")) - 1
        last = int(np.searchsorted(offsets, start + count, "left"))
        ends = offsets[first + 1 : last + 1]
        lengths = np.diff(np.clip(offsets[first : last + 1] - start, 0, count))
        owner = np.repeat(np.arange(first, last), lengths)
        whole = np.arange(start, start + count) + WINDOW <= np.repeat(ends, lengths)
        edge = np.ones(count, bool)
        edge[1:] = (places[1:] != places[:-1]) | (owner[1:] != owner[:-1])
        begins = np.flatnonzero(edge & whole)
        closing = np.ones(count, bool)
        closing[:-1] = edge[1:] | ~whole[1:]
        windows = np.flatnonzero(closing & whole) + 1 - begins
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(codes * power[: len(part)], out=total[1:])
        content = (total[begins + windows + WINDOW - 1] - total[begins]) * inverse[begins]
        content = mixed(content + windows.astype(np.uint64))
        at = places[begins]
        yield begins + start, windows, grams[at], at - begins, content, owner[begins]
        start += CHUNK


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    data = texts.buffers()[2]
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], every[offsets[0] : offsets[-1]]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of the pieces of a batch of texts, and the number of their pieces."""
    for batch in batches:
        found = [piece[2] for piece in pieces(*_flat(batch.column(0)))]
        if found:
            anchor, count = np.unique(np.concatenate(found), return_counts=True)
            columns = [pa.array(anchor.view(np.int64)), pa.array(count.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "n"])


_PIECE = "doc_id long, lo long, windows int, anchor long, gram int, content long"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of each text. A repeat of a piece in the same batch is marked by windows < 0."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        offsets, data = _flat(batch.column(1))
        found = list(pieces(offsets, data))
        if not found:
            continue
        at, windows, anchor, gram, content, owner = map(np.concatenate, zip(*found))
        doc, lo = ids[owner], at - offsets[owner]
        order = np.lexsort((lo, doc, content, anchor))
        again = np.zeros(len(order), bool)
        one, two = order[:-1], order[1:]
        again[two] = (anchor[one] == anchor[two]) & (content[one] == content[two])
        # A repeated row gives the same piece twice; that is no earlier place.
        same = np.zeros(len(order), bool)
        same[two] = again[two] & (doc[one] == doc[two]) & (lo[one] == lo[two])
        keep = ~same
        columns = (
            doc,
            lo,
            np.where(again, -windows, windows).astype(np.int32),
            anchor.view(np.int64),
            gram.astype(np.int32),
            content.view(np.int64),
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(column[keep]) for column in columns],
            ["doc_id", "lo", "windows", "anchor", "gram", "content"],
        )


def column_index(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted suffixes of a collection of byte strings: string, length, common prefix with the one
    before. Strings are UTF-8, whose bytes stay below 0xF5.

    State: for every suffix inserted so far, in sorted order, the symbol before it (0 at the start
    of its string) and its common prefix with its neighbour; and the places of these symbols,
    grouped by symbol. A round inserts, for each string, the suffix that is one symbol longer. Its
    rank among all suffixes is the rank of its symbol among the grouped places. A last walk along
    these ranks tells which suffix stands at which place.
    """
    count = len(offsets) - 1
    symbols = data + np.uint8(1)
    common = np.zeros(count, np.int32)
    before = np.zeros(count, np.uint8)
    active = np.flatnonzero(np.diff(offsets) > 0)
    before[active] = symbols[offsets[active + 1] - 1]
    grouped = np.argsort(before, kind="stable")[count - len(active) :].astype(np.int32)
    ends = np.cumsum(np.bincount(before[active], minlength=256))
    rank = np.empty(count, np.int64)
    rank[grouped] = np.arange(len(grouped))
    rank = rank[active]
    rounds = 0
    while len(active):
        rounds += 1
        # Common prefixes change at the new suffixes and at their right neighbours: one more than
        # the least common prefix between the two places of the symbol.
        touched = np.union1d(rank, rank + 1)
        touched = touched[touched < len(grouped)]
        left, right = grouped[touched - 1], grouped[touched]
        related = np.flatnonzero((touched > 0) & (before[left] == before[right]))
        least = np.zeros(len(touched), np.int32)
        if len(related):
            low, high = left[related] + 1, right[related] + 1
            order = np.argsort(low)
            pairs = np.stack((low[order], high[order]), axis=1).ravel()
            minima = np.minimum.reduceat(np.append(common, np.int32(0)), pairs)[::2]
            least[related[order]] = minima + 1
        # The empty suffixes come first, then all others in the order of their symbols.
        places = count + rank
        old = np.ones(len(before) + len(active), bool)
        old[places] = False
        longer = offsets[active + 1] - rounds - 1
        going = longer >= offsets[active]
        follows = np.where(going, symbols[np.maximum(longer, 0)], np.uint8(0))
        before = _grown(old, places, before, follows)
        common = _grown(old, places, common, 0)
        common[count + touched] = least

        moved = np.flatnonzero(old).astype(np.int32)
        grouped = np.take(moved, grouped)
        active, places, follows = active[going], places[going], follows[going]
        order = np.lexsort((places, follows))
        sorted_places, sorted_follows = places[order], follows[order]
        cuts = np.flatnonzero(np.diff(sorted_follows, prepend=-1, append=-1))
        slots = np.empty(len(order), np.int64)
        for start, end in zip(cuts.tolist(), cuts[1:].tolist()):
            symbol = int(sorted_follows[start])
            base = int(ends[symbol - 1])
            own = grouped[base : int(ends[symbol])]
            slots[start:end] = base + np.searchsorted(own, sorted_places[start:end])
        grouped = np.insert(grouped, slots, sorted_places)
        rank = np.empty(len(order), np.int64)
        rank[order] = slots + np.arange(len(order))
        ends += np.cumsum(np.bincount(follows, minlength=256))
    return *_owners(np.diff(offsets), grouped, len(before)), common


def _owners(sizes: np.ndarray, grouped: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """String and length of the suffix at each place, from the empty suffixes to the whole strings."""
    count = len(sizes)
    string, length = np.zeros(total, np.int32), np.zeros(total, np.int32)
    string[:count] = np.arange(count)
    longer = np.zeros(total, np.int64)
    longer[grouped] = np.arange(count, total)
    active = place = np.flatnonzero(sizes > 0)
    rounds = 0
    while len(active):
        rounds += 1
        place = longer[place]
        string[place], length[place] = active, rounds
        going = sizes[active] > rounds
        active, place = active[going], place[going]
    return string, length


def _grown(old: np.ndarray, places: np.ndarray, values: np.ndarray, added) -> np.ndarray:
    out = np.empty(len(old), values.dtype)
    out[old] = values
    out[places] = added
    return out


def _columns(block: pa.Table) -> pa.Table:
    """Removed windows of a block's pieces as spans; of a dealt block also its first windows."""
    dealt = block.column("dealt")[0].as_py()
    doc, lo = block.column("doc_id").to_numpy(), block.column("lo").to_numpy()
    texts = block.column("bytes").to_pylist()
    copies = []
    if not dealt:
        anchors, grams = block.column("anchor").to_pylist(), block.column("gram").to_pylist()
        trimmed = _trimmed(texts, anchors, grams)
        texts = [text[start:end] for text, (start, end) in zip(texts, trimmed)]
        lo = lo + np.array([start for start, _ in trimmed])
        # What is left of two pieces may be equal; then the first one stands for both.
        first_of: dict[bytes, int] = {}
        chosen = []
        for n in np.lexsort((lo, doc)).tolist():
            if texts[n]:
                first = first_of.setdefault(texts[n], n)
                if first == n:
                    chosen.append(n)
                elif (doc[n], lo[n]) != (doc[first], lo[first]):
                    copies.append((doc[n], lo[n], lo[n] + len(texts[n])))
        doc, lo, texts = doc[chosen], lo[chosen], [texts[n] for n in chosen]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(text) for text in texts], out=offsets[1:])
    data = np.frombuffer(b"".join(texts), np.uint8)
    string, length, common = column_index(data, offsets)
    window = length >= WINDOW
    group = np.cumsum(common < WINDOW)[window]
    string, length = string[window], length[window]
    start = lo[string] + (offsets[1:] - offsets[:-1])[string] - length
    order = np.lexsort((start, doc[string], group))
    string, start, group = string[order], start[order], group[order]
    owner = doc[string]
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    # A repeated row has the same window at the same place.
    lead = np.flatnonzero(first)[np.cumsum(first) - 1]
    again = (owner != owner[lead]) | (start != start[lead])
    out = [_spans(owner[again], start[again], WINDOW)]
    if copies:
        columns = dict(zip(("doc_id", "lo", "hi"), np.array(copies, np.int64).T))
        out.append(pa.table({**columns, "key": pa.nulls(len(copies), pa.binary())}))
    if dealt:
        at = offsets[string[first]] + start[first] - lo[string[first]]
        view = memoryview(data)
        keys = [blake2b(view[n : n + WINDOW], digest_size=16).digest() for n in at.tolist()]
        out.append(
            pa.table(
                {
                    "doc_id": owner[first],
                    "lo": start[first],
                    "hi": start[first] + WINDOW,
                    "key": pa.array(keys, pa.binary()),
                }
            )
        )
    return pa.concat_tables(out)


def _trimmed(texts: list[bytes], anchors: list[int], grams: list[int]) -> list[tuple[int, int]]:
    """The part of each piece whose windows another piece of its anchor may have as well.

    Windows that start within one step of each other share a core around the gram. Where no other
    piece has that core at the gram, none of these windows occurs in another piece.
    """
    reach = WINDOW - GRAM
    cores: dict[tuple, int] = {}
    found = []
    for text, anchor, gram in zip(texts, anchors, grams):
        own = []
        for distance in range(0, reach + 1, CORE_STEP):
            nearest = min(distance + CORE_STEP - 1, reach)
            # Starts gram - nearest to gram - distance; all of them hold this core.
            low, high = gram - distance, gram - nearest + WINDOW
            first, last = max(gram - nearest, 0), min(low, len(text) - WINDOW)
            if first <= last:
                core = (anchor, distance, text[max(low, 0) : high])
                cores[core] = cores.get(core, 0) + 1
                own.append((core, first, last))
        found.append(own)
    parts = []
    for own in found:
        shared = [(first, last) for core, first, last in own if cores[core] > 1]
        if shared:
            parts.append((min(f for f, _ in shared), max(last for _, last in shared) + WINDOW))
        else:
            parts.append((0, 0))
    return parts


def _spans(doc: np.ndarray, lo: np.ndarray, width: int) -> pa.Table:
    """Runs of neighbouring starts as spans (doc_id, lo, hi); key is null."""
    order = np.lexsort((lo, doc))
    doc, lo = doc[order], lo[order]
    edge = np.ones(len(doc), bool)
    edge[1:] = (doc[1:] != doc[:-1]) | (lo[1:] > lo[:-1] + 1)
    begins = np.flatnonzero(edge)
    last = np.append(begins[1:], len(doc))[: len(begins)] - 1
    return pa.table(
        {
            "doc_id": pa.array(doc[begins], pa.int64()),
            "lo": pa.array(lo[begins], pa.int64()),
            "hi": pa.array(lo[last] + width, pa.int64()),
            "key": pa.nulls(len(begins), pa.binary()),
        }
    )


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each wanted piece, with the number of pieces that its anchor has."""
    for batch in batches:
        rows = zip(batch.column("doc_id").to_pylist(), batch.column("wanted"), batch.column("text"))
        doc, lo, anchor, gram, content, count, cut = [], [], [], [], [], [], []
        for doc_id, wanted, text in rows:
            data = (text.as_py() or "").encode()
            for piece in wanted.as_py():
                doc.append(doc_id)
                lo.append(piece["lo"])
                anchor.append(piece["anchor"])
                gram.append(piece["gram"])
                content.append(piece["content"])
                count.append(piece["n"])
                cut.append(data[piece["lo"] : piece["lo"] + piece["windows"] + WINDOW - 1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc, pa.int64()),
                pa.array(lo, pa.int64()),
                pa.array(anchor, pa.int64()),
                pa.array(gram, pa.int32()),
                pa.array(content, pa.int64()),
                pa.array(count, pa.int64()),
                pa.array(cut, pa.binary()),
            ],
            ["doc_id", "lo", "anchor", "gram", "content", "n", "bytes"],
        )


def repeated_spans(documents: DataFrame) -> DataFrame:
    """(doc_id, lo, hi): byte spans that cover exactly the windows that occur earlier.

    Spans of a document may overlap. The result is a written table; what led to it is removed.
    """
    with short_lived(documents.sparkSession):
        return written(_found_spans(documents), "spans", lasting=True)


def _found_spans(documents: DataFrame) -> DataFrame:
    texts = documents.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    texts = texts.where(F.octet_length("text") >= WINDOW)
    place = F.struct("doc_id", "lo", "windows", "gram")
    width = F.abs("windows") + F.lit(WINDOW - 1)
    # The candidates are the largest table; they go before the bytes of pieces are gathered.
    with short_lived(documents.sparkSession):
        counts = texts.select("text").mapInArrow(_anchors, "anchor long, n long")
        counts = counts.groupBy("anchor").agg(F.sum("n").alias("n"))
        # Written, as a join can be split where an anchor is frequent unless it continues the grouping.
        shared = written(counts.where("n > 1").select("anchor"), "shared-anchors")
        found = texts.mapInArrow(_pieces, _PIECE)
        candidates = written(found.join(shared, "anchor", "left_semi"), "pieces")
        firsts = written(
            candidates.where("windows > 0")
            .groupBy("anchor", "content")
            .agg(F.min(place).alias("first"))
            .select("anchor", "content", "first.*"),
            "first-pieces",
            lasting=True,
        )
        earlier = firsts.select(
            "anchor", "content", F.col("doc_id").alias("d"), F.col("lo").alias("l")
        )
        later = written(
            candidates.join(earlier, ["anchor", "content"])
            .where("windows < 0 or doc_id <> d or lo <> l")
            .select("doc_id", "lo", (F.col("lo") + width).alias("hi")),
            "later-pieces",
            lasting=True,
        )

    several = (
        firsts.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(width).alias("size"))
    ).where("n > 1")
    several = written(several, "anchors")
    total = several.agg(F.sum("size")).first()[0] or 0
    blocks = int(total // BLOCK) + 1
    piece = F.struct("lo", "windows", "anchor", "gram", "content", "n")
    wanted = (
        firsts.join(several.select("anchor", "n"), "anchor")
        .groupBy("doc_id")
        .agg(F.collect_list(piece).alias("wanted"))
    )
    cut = wanted.join(texts, "doc_id").mapInArrow(
        _cut_out, "doc_id long, lo long, anchor long, gram int, content long, n long, bytes binary"
    )
    deal = F.ceil(F.col("n") / BLOCK_PIECES)
    salt = F.pmod(F.xxhash64("content"), deal)
    placed = cut.select(
        "doc_id",
        "lo",
        "anchor",
        "gram",
        "bytes",
        (deal > 1).alias("dealt"),
        F.when(deal > 1, F.xxhash64("anchor", salt))
        .otherwise(F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
        .alias("block"),
    )
    compared = written(
        placed.groupBy("dealt", "block").applyInArrow(
            _columns, "doc_id long, lo long, hi long, key binary"
        ),
        "columns",
    )
    own = compared.where("key is null").select("doc_id", "lo", "hi")
    leads = compared.where("key is not null")
    least = leads.groupBy("key").agg(
        F.min(F.struct("doc_id", "lo")).alias("first"), F.count("*").alias("n")
    )
    across = (
        leads.join(least.where("n > 1"), "key")
        .where("doc_id <> first.doc_id or lo <> first.lo")
        .select("doc_id", "lo", "hi")
    )
    return later.unionByName(own).unionByName(across)


def _removed(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Each row with its remaining bytes and the numbers of bytes, removed bytes and runs."""
    for batch in batches:
        kept, sizes, gone, runs = [], [], [], []
        for value, spans in zip(batch.column(text), batch.column("_spans")):
            data = (value.as_py() or "").encode()
            parts, at, lost, count = [], 0, 0, 0
            end = -1
            for lo, hi in sorted((s["lo"], s["hi"]) for s in spans.as_py() or ()):
                if lo > end:
                    count += 1
                    parts.append(data[at:lo])
                at = end = max(end, hi)
            parts.append(data[at:])
            rest = b"".join(parts)
            lost = len(data) - len(rest)
            kept.append(rest)
            sizes.append(len(data))
            gone.append(lost)
            runs.append(count)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(n) for n, name in enumerate(batch.schema.names) if name != "_spans"),
                pa.array(kept, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(gone, pa.int64()),
                pa.array(runs, pa.int64()),
            ],
            [n for n in batch.schema.names if n != "_spans"]
            + ["_kept", "n_bytes", "n_removed", "n_spans"],
        )


def _with_rest(documents: DataFrame, text: str, finish, fields: list[StructField]) -> DataFrame:
    spans = repeated_spans(documents)
    of_doc = spans.groupBy("doc_id").agg(
        F.collect_set(F.struct("lo", "hi")).alias("_spans")
    )
    joined = documents.join(of_doc, "doc_id", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(finish, _removed(batches, text))

    return joined.mapInArrow(cut, StructType(fields))


def passage_digests(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the remaining bytes."""

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes = [sha256(rest).hexdigest() for rest in batch.column("_kept").to_pylist()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans"]
        columns = [batch.column(name) for name in names]
        return pa.RecordBatch.from_arrays([*columns, pa.array(hashes)], [*names, "kept_sha256"])

    fields = [StructField(n, LongType()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")]
    fields.append(StructField("kept_sha256", StringType()))
    chosen = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return _with_rest(chosen, "text", digest, fields)


def remove_passages(documents: DataFrame) -> DataFrame:
    """The documents with the remaining text; a character that lost a byte goes as a whole.

    ``n_chars``, where present, counts the code points of the remaining text.
    """
    names = documents.columns
    fields = [documents.schema[name] for name in names]

    def rewrite(batch: pa.RecordBatch) -> pa.RecordBatch:
        rests = [rest.decode("utf-8", "ignore") for rest in batch.column("_kept").to_pylist()]
        changed = batch.column("n_removed").to_numpy() > 0
        columns = []
        for name, field in zip(names, fields):
            old = batch.column(batch.schema.names.index(name))
            if name == "text":
                # A null text stays null: nothing was removed from it.
                new = pa.array(rests, pa.string()).cast(old.type)
                columns.append(pc.if_else(pa.array(changed), new, old))
            elif name == "n_chars":
                new = pa.array([len(rest) for rest in rests]).cast(old.type)
                columns.append(pc.if_else(pa.array(changed), new, old))
            else:
                columns.append(old)
        return pa.RecordBatch.from_arrays(columns, names)

    return _with_rest(documents, "text", rewrite, fields)
