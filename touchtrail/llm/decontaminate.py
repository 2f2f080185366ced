"""Documents that hold benchmark items, also with other numbers, names or units in them.

Words are runs of letters, digits and combining marks of any script, lower-cased character by
character. Every five words in a row give two windows: the plain one, and, where at least two words
are literal and one is not, a template in which numbers, names and units are typed placeholders.
A name is a capitalised word; where a sentence begins, only if the text has the same word
capitalised within a sentence as well, since there every word is capitalised. Windows are joined by their
hash. An item is held if three quarters of its windows are found, as they are or as templates.
Where the literal windows are not enough, the slots must be consistent: the values that one value of
the item turns into are counted over the matched windows, and three quarters of the slots must agree
with the most frequent one. An item with fewer than LEAST_EVIDENCE words that are neither names nor
units says too little as a template and is looked for by its plain windows only.

Items with many or compound slots are found by a second reading, in which a slot is one placeholder
however many words it has: a number with separators or decimals (signs do not count), a run of
names, a unit such as square feet or miles per hour. Its windows are five words or
placeholders, and more where needed for two literal words; those without them at the end of an item
are left out. An item is also held if three quarters of these windows are found with consistent
slots. The reading is done with names as placeholders and with names as words, since case tells
nothing in a copy all in capitals or small letters; other names in such a copy cost the windows
that they stand in.

A document may hold several variants of an item, so windows and slots are judged per occurrence as
well as over the whole document; one that passes is enough. An occurrence is all matches of equal
distance between their places in document and item, or of distances within a band of half the
item's length, so that words may have been added or left out in between; bands overlap by half.

Items that differ in the values of their slots only, with equal values in the same places, are one
class, judged once: a variant of one is a variant of all. A document that holds such a variant is
reported with the smallest item of the class, and one that holds items word by word, with these
items; ``item_classes`` tells which items a class has. In a class of several texts slots have to be
consistent also where the literal windows are enough, as these may come from several of its items.

A bitmap of fixed size over the hashes of the benchmark keeps most document windows out of the
join; it drops none that the join would find.

Defined cases: a null or empty text holds nothing; an item of fewer than five words is one window of
all its words and is looked for as such; an item without words is never held; items with equal texts
are one class; rows without an id are left out of the search and kept by ``without_leaks``;
repeated rows and other columns do not matter; texts of any length are read whole; an empty table on
either side gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import (
    _WORD_BASE,
    mixed,
    powers,
    text_blocks,
    window_hashes,
    word_hashes,
    word_spans,
    written,
)

WIDTH = 5
LEAST_LITERALS = 2
# Words of an item other than names and units, for templates of it to be looked for.
LEAST_EVIDENCE = 6
LEAST_SHARE = 0.75
BITMAP_BITS = 1 << 24
# Words taken for units of measure.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles g kg mg gram grams kilogram kilograms "
    "pound pounds ounce ounces lb oz ton tons l ml liter liters litre litres gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degree degrees meter meters metre metres"
).split()

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_NUMBER, _NAME, _UNIT = (np.uint64(n) for n in (0xA11CE5, 0xB0B5, 0xC0FFEE))
_KINDS = np.array([0, _NUMBER, _UNIT, _NAME], np.uint64)
_SEPARATORS = np.zeros(256, bool)
_SEPARATORS[[ord(c) for c in ".,:/"]] = True
_VIEWS = ("plain", "template", "typed", "caseless")
_SHARED_BUCKET = 4096 * 8


def _hashes_of(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = word_spans(np.array([0, len(data)]), data, _IN_WORD[data])
    return np.sort(word_hashes(data, starts, ends))


_UNIT_HASHES = _hashes_of(UNITS)
_OF_UNIT = _hashes_of("square cubic fluid nautical".split())
_PER = _hashes_of(["per"])
_BACK = np.uint64(pow(int(_WORD_BASE), -1, 1 << 64))


# What the characters are, by code point; those past the end are ideographs.
_POINTS = 0x20000
# Characters that end a sentence, or open one within another.
_SENTENCE_MARKS = ".!?:;\u2026\n\r\"\u201c\u201d\u201e\u00ab\u00bb()[]\u00bf\u00a1\u3002\uff01\uff1f"


def _character_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower case of every character, and whether it is part of a word, a capital, a sentence mark.

    Lower case is one character for one, so places in a text stay what they are.
    """
    lower = np.arange(_POINTS + 1, dtype=np.uint32)
    in_word, capital = (np.zeros(_POINTS + 1, bool) for _ in range(2))
    for point in range(_POINTS):
        character = chr(point)
        small = character.lower()
        if len(small) == 1:
            lower[point] = ord(small)
        in_word[point] = character.isalnum() or unicodedata.category(character)[0] == "M"
        capital[point] = character.isupper() or character.istitle()
    in_word[_POINTS] = True
    mark = np.zeros(_POINTS + 1, bool)
    mark[[ord(character) for character in _SENTENCE_MARKS]] = True
    return lower, in_word, capital, mark


_LOWER, _OF_WORD, _CAPITAL, _MARK = _character_tables()


class _Words:
    """The words of a block of texts: where they are, their hashes, and which are slots."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray):
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
        known = np.minimum(points, _POINTS)
        small = np.where(known < _POINTS, _LOWER[known], points)
        self.data = np.frombuffer(small.tobytes().decode("utf-32-le").encode("utf-8"), np.uint8)
        # A character may have another number of bytes in lower case.
        sizes = 1 + (small >= 0x80).astype(np.int64) + (small >= 0x800) + (small >= 0x10000)
        at = np.concatenate(([0], np.cumsum(sizes)))
        before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        self.texts = len(offsets) - 1
        spans = word_spans(at[before[offsets]], self.data, np.repeat(_OF_WORD[known], sizes))
        self.starts, self.ends, self.owner = spans
        if not len(self.starts):
            return
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        digits = (self.data >= 48) & (self.data <= 57)
        edges = np.stack((self.starts, self.ends), 1).ravel()[:-1]
        self.number = np.add.reduceat(digits.astype(np.int32), edges)[::2] == self.ends - self.starts
        place = np.minimum(np.searchsorted(_UNIT_HASHES, self.hashes), len(_UNIT_HASHES) - 1)
        self.unit = _UNIT_HASHES[place] == self.hashes
        point_of = np.repeat(np.arange(len(points)), sizes)
        first, last = point_of[self.starts], point_of[self.ends - 1]
        self.name = self._names(_CAPITAL[known[first]], np.cumsum(_MARK[known]), first, last)
        self.together = self.owner[1:] == self.owner[:-1]
        counts = np.bincount(self.owner, minlength=self.texts)
        self.counts, self.begin = counts, np.cumsum(counts) - counts

    def _names(
        self, capital: np.ndarray, marks: np.ndarray, first: np.ndarray, last: np.ndarray
    ) -> np.ndarray:
        """Capitalised words, at the start of a sentence only those that occur within one too."""
        opens = np.ones(len(first), bool)
        opens[1:] = (self.owner[1:] != self.owner[:-1]) | (marks[first[1:]] > marks[last[:-1]])
        word_of_text = mixed(self.hashes + mixed(self.owner.astype(np.uint64) + np.uint64(1)))
        within = np.unique(word_of_text[capital & ~opens])
        at = np.minimum(np.searchsorted(within, word_of_text), max(len(within) - 1, 0))
        seen = within[at] == word_of_text if len(within) else np.zeros(len(first), bool)
        return capital & (~opens | seen) & ~self.number

    def kinds(self) -> np.ndarray:
        """0 for literal words, 1 for numbers, 2 for units with the words that belong to them, 3 names."""
        before_unit = np.append(self.unit[1:] & self.together, False)
        after_unit = np.append(False, self.unit[:-1] & self.together)
        part = before_unit & (self.hashes[:, None] == _OF_UNIT).any(1)
        part |= before_unit & after_unit & (self.hashes == _PER)
        return np.where(self.number, 1, np.where(self.unit | part, 2, np.where(self.name, 3, 0)))

    def continued(self, kinds: np.ndarray) -> np.ndarray:
        """Whether a word goes on with the slot of the word before it."""
        joined = np.zeros(len(kinds), bool)
        joined[1:] = (kinds[1:] > 0) & (kinds[1:] == kinds[:-1]) & self.together
        if len(kinds) > 1:
            one_mark = (self.starts[1:] - self.ends[:-1] == 1) & _SEPARATORS[self.data[self.ends[:-1]]]
            joined[1:] &= (kinds[1:] != 1) | one_mark
        return joined


def _windows(
    texts: pa.Array, widths: tuple[int, ...], whole: bool, typed: tuple[int, ...]
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, tuple]]:
    """Per block and width: view, hashes, first words, texts, and what slot values are read from.

    ``whole``: widths below WIDTH only where they are all the words of the text. ``typed``: what
    widths below and beyond WIDTH windows with placeholders may have, if it is not ``whole``.
    """
    for block, offsets, data in text_blocks(texts):
        read = _Words(offsets, data)
        if not len(read.starts):
            continue
        words, owner = read.hashes, read.owner
        slot = read.number | read.unit | read.name
        template = np.where(
            read.number, _NUMBER, np.where(read.unit, _UNIT, np.where(read.name, _NAME, words))
        )
        of_word = read.counts[owner]
        for width in widths:
            size = len(words) - width + 1
            if size <= 0:
                continue
            inside = owner[:size] == owner[width - 1 :]
            if whole and width < WIDTH:
                inside &= of_word[:size] == width
            filled = np.cumsum(np.concatenate(([0], slot)))
            slots = filled[width : width + size] - filled[:size]
            usable = inside & (slots > 0) & (width - slots >= min(LEAST_LITERALS, width))
            for view, values, chosen in ((0, words, inside), (1, template, usable)):
                first = np.flatnonzero(chosen)
                keys = mixed(window_hashes(values, width)[first] + np.uint64(view * 8 + width))
                spans = (read.data, read.starts, read.ends)
                source = (*spans, slot, np.broadcast_to(width, size), read.begin)
                yield block, view, keys, first, owner[first], source
        kinds = read.kinds()
        for view in (2, 3):
            for hashes, first, of_text, source in _typed_windows(read, kinds, whole, typed):
                yield block, view, mixed(hashes + np.uint64(view * 8)), first, of_text, source
            kinds = np.where(kinds == 3, 0, kinds)


def _typed_windows(
    read: _Words, kinds: np.ndarray, whole: bool, typed: tuple[int, ...]
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, tuple]]:
    """Hashes, first tokens, texts, and what slot values are read from; kinds are those of words.

    A token is a literal word or a placeholder for a run of words.
    """
    words, owner, texts = read.hashes, read.owner, read.texts
    data, starts, ends = read.data, read.starts, read.ends
    joined = read.continued(kinds)
    head = np.flatnonzero(~joined)
    last = np.append(head[1:], len(words)) - 1
    slot, of_text, size = kinds[head] > 0, owner[head], len(head)
    tokens = np.where(slot, _KINDS[kinds[head]], words[head])
    counts = np.bincount(of_text, minlength=texts)
    begin = np.cumsum(counts) - counts
    end, at = (begin + counts)[of_text], np.arange(size)
    # The window from a token on ends with its fifth token or its second literal word.
    literals = np.append(np.flatnonzero(~slot), size)
    before = np.concatenate(([0], np.cumsum(~slot)))
    reach = literals[np.minimum(before[:-1] + LEAST_LITERALS - 1, len(literals) - 1)] + 1
    until = np.maximum(at + WIDTH, reach)
    fits = until <= end
    if not whole:
        fits &= until - at <= max(typed, default=WIDTH)
    choices = [(until, fits)]
    short = [end] if whole else [at + width for width in typed if width < WIDTH]
    for until in short:
        fits = (until <= end) & (until - at < WIDTH)
        if whole:
            fits &= at == begin[of_text]
        enough = before[np.minimum(until, size)] - before[:-1]
        choices.append((until, fits & (enough >= LEAST_LITERALS) & (enough < until - at)))
    # Hashes of windows of any width, from sums of all tokens before.
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(tokens * powers(_WORD_BASE, size), out=sums[1:])
    back = powers(_BACK, size)
    for until, fits in choices:
        first = np.flatnonzero(fits)
        hashes = mixed((sums[until[first]] - sums[first]) * back[first])
        source = (data, starts[head], ends[last], slot, until - at, begin)
        yield hashes, first, of_text[first], source


def _slot_values(first: int, source: tuple) -> list[tuple[int, str]]:
    """Token and value of each slot of a window."""
    data, starts, ends, slot, widths, _ = source
    return [
        (n, data[starts[n] : ends[n]].tobytes().decode("utf-8", "replace"))
        for n in range(first, first + widths[first])
        if slot[n]
    ]


def _window_rows(
    table: DataFrame,
    key: str,
    widths: tuple[int, ...],
    whole: bool,
    bitmap: bytes | None,
    typed: tuple[int, ...] = (),
) -> DataFrame:
    """(key, view, hash, place, width, slots) of all windows, or of those that the bitmap holds.

    The slots of a document's window are their values. Those of an item are the places where their
    values were first seen, which is the same for all items of a class.
    """
    sent = table.sparkSession.sparkContext.broadcast(bitmap)  # BITMAP_BITS at most

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if sent.value is None else np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            every = _windows(batch.column(1), widths, whole, typed)
            seen: dict[tuple[int, int, str], int] = {}
            for block, view, keys, first, owner, source in every:
                if bits is not None:
                    place = (keys % np.uint64(BITMAP_BITS)).astype(np.int64)
                    held = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
                    keys, first, owner = keys[held], first[held], owner[held]
                if len(keys):
                    slots: list[list[str]] = [[]] * len(keys)
                    if view and whole:
                        begin = source[-1]
                        slots = [
                            [
                                str(seen.setdefault((view, block + text, value), n - begin[text]))
                                for n, value in _slot_values(at, source)
                            ]
                            for at, text in zip(first.tolist(), owner.tolist(), strict=True)
                        ]
                    elif view:
                        slots = [[v for _, v in _slot_values(at, source)] for at in first.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[block + owner]),
                            pa.array([_VIEWS[view]] * len(keys)),
                            pa.array(keys.view(np.int64)),
                            pa.array((first - source[-1][owner]).astype(np.int64)),
                            pa.array(source[-2][first].astype(np.int64)),
                            pa.array(slots, pa.list_(pa.string())),
                        ],
                        [key, "view", "hash", "place", "width", "slots"],
                    )

    return _texts(table, key).mapInArrow(
        rows, f"{key} long, view string, hash long, place long, width long, slots array<string>"
    )


def _texts(table: DataFrame, key: str) -> DataFrame:
    return table.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias(key), F.col("text").cast("string").alias("text")
    )


def item_classes(benchmark: DataFrame) -> DataFrame:
    """(item_id, class_id, class_items, class_texts, evidence) of all items with words.

    ``class_id`` is the smallest item of the class, ``class_texts`` the number of its different
    word sequences, ``evidence`` the number of words other than names and units.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for block, offsets, data in text_blocks(batch.column(1)):
                read = _Words(offsets, data)
                if not len(read.starts):
                    continue
                kinds = read.kinds()
                plain = np.where(read.number, 1, np.where(read.unit, 2, np.where(read.name, 3, 0)))
                joined = read.continued(kinds)
                out = []
                for text in np.flatnonzero(read.counts).tolist():
                    first, seen = int(read.begin[text]), {}
                    shape, said, evidence = blake2b(digest_size=16), blake2b(digest_size=16), 0
                    for n in range(first, first + int(read.counts[text])):
                        word = read.data[read.starts[n] : read.ends[n]].tobytes()
                        slot = f"{plain[n]}:{seen.setdefault(word, n - first)}".encode()
                        part = slot if plain[n] else b"0:" + word
                        shape.update(b"%d%d%s " % (kinds[n], joined[n], part))
                        said.update(word + b" ")
                        evidence += plain[n] in (0, 1)
                    out.append((int(ids[block + text]), shape.digest(), said.digest(), int(evidence)))
                columns = [pa.array(column) for column in zip(*out)]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "shape", "said", "evidence"])

    found = _texts(benchmark, "item_id").mapInArrow(
        keys, "item_id long, shape binary, said binary, evidence long"
    )
    # An id stands for one text, as a document's does; of several, one is taken.
    found = found.groupBy("item_id").agg(F.min(F.struct("shape", "said", "evidence")).alias("f"))
    found = found.select("item_id", "f.*")
    sizes = found.groupBy("shape").agg(
        F.min("item_id").alias("class_id"),
        F.count("*").alias("class_items"),
        F.countDistinct("said").alias("class_texts"),
    )
    return found.join(sizes, "shape").select(
        "item_id", "class_id", "class_items", "class_texts", "evidence"
    )


def _bitmap(windows: DataFrame) -> bytes:
    """One bit per residue of the hashes, put together from partial bitmaps of 4096 bytes."""
    # A hash is unsigned where it is made, so the residue is taken of its low bits.
    place = F.col("hash").bitwiseAND(F.lit(BITMAP_BITS - 1)) + 1
    parts = (
        windows.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    out = bytearray(BITMAP_BITS // 8)
    for row in parts.collect():
        start = (row["bucket"] - 1) * _SHARED_BUCKET // 8
        out[start : start + len(row["bits"])] = row["bits"]
    return bytes(out)


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item, or class of items, that it holds.

    doc_id, item_id (of a class that no item of is held word by word, the smallest), matched and all
    windows of the item, their share, whether literal windows were enough (view plain) or templates
    were needed, the share of consistent slots (1 for the plain view of a class of one text), class_id
    and class_items. Matched and all windows are those of the reading that passes, the one by single
    words if both do. The figures are those of the whole document if it passes as a whole, else of
    the best occurrence.
    """
    every = tuple(range(1, WIDTH + 1))
    classes = written(item_classes(benchmark), "classes")
    reading = F.when(F.col("view").isin("plain", "template"), "words").otherwise(F.col("view"))
    enough_said = (F.col("view") == "plain") | (F.col("evidence") >= LEAST_EVIDENCE)
    by_item = written(
        _window_rows(benchmark, "item_id", every, True, None)
        .join(classes, "item_id")
        .where(enough_said)
        .select(
            "item_id",
            "class_id",
            "class_items",
            "class_texts",
            "view",
            reading.alias("reading"),
            "hash",
            F.col("place").alias("at"),
            "width",
            F.col("slots").alias("item_slots"),
        ),
        "items",
    )
    items = by_item.drop("item_id").distinct()
    bitmap = _bitmap(items)
    # Short windows are looked for only if some item is that short.
    of_width = items.select("reading", "width").distinct().collect()
    widths = sorted({r.width for r in of_width if r.reading == "words" and r.width < WIDTH})
    # At most the words of the longest item.
    typed = tuple(sorted({r.width for r in of_width if r.reading != "words"}))
    found = _window_rows(documents, "doc_id", (*widths, WIDTH), False, bitmap, typed).drop("width")
    sizes = (
        items.where("view <> 'template'")
        .groupBy("class_id", "reading")
        .agg(F.countDistinct("at").alias("item_windows"))
    )
    items = items.drop("width").distinct().join(sizes, ["class_id", "reading"])
    lines = written(found.join(items, ["view", "hash"]), "hits")

    distance, step = F.col("place") - F.col("at"), F.greatest(F.lit(1), F.expr("item_windows div 4"))
    band = F.floor(distance / step)
    scopes = (("whole", F.lit(0)), ("line", distance), ("band", band), ("band", band - 1))
    hits = lines.withColumn(
        "scope",
        F.explode(
            F.array(
                *(F.struct(F.lit(n).alias("kind"), at.cast("long").alias("n")) for n, at in scopes)
            )
        ),
    )
    one = ["doc_id", "class_id", "reading", "scope"]
    facts = ["item_windows", "class_items", "class_texts"]
    # Several windows of a document may match one window of the item; that is one match.
    matched = (
        hits.groupBy(*one, *facts, "at")
        .agg(F.max((F.col("view") == "plain").cast("long")).alias("literal"))
        .groupBy(*one, *facts)
        .agg(F.count("*").alias("matched"), F.sum("literal").alias("literal"))
    )
    enough = matched.where(F.col("matched") >= LEAST_SHARE * F.col("item_windows"))
    turned = (
        hits.where("view <> 'plain'")
        .select(*one, F.explode(F.arrays_zip("item_slots", "slots")).alias("slot"))
        .groupBy(*one, F.col("slot.item_slots").alias("old"), "slot.slots")
        .agg(F.count("*").alias("n"))
        .groupBy(*one, "old")
        .agg(F.max("n").alias("top"), F.sum("n").alias("n"))
        .groupBy(*one)
        .agg((F.sum("top") / F.sum("n")).alias("agreeing"))
    )
    literal = F.col("literal") >= LEAST_SHARE * F.col("item_windows")
    agreeing = F.coalesce("agreeing", F.lit(1.0))
    consistency = F.when(literal & (F.col("class_texts") == 1), 1.0).otherwise(agreeing)
    best = F.struct(
        literal.alias("literal"),
        (F.col("reading") == "words").alias("words"),
        (F.col("scope.kind") == "whole").alias("whole"),
        "matched",
        "consistency",
        "item_windows",
        "class_items",
    )
    held = (
        enough.join(turned, one, "left")
        .withColumn("consistency", consistency)
        .where(F.col("consistency") >= LEAST_SHARE)
        .groupBy("doc_id", "class_id")
        .agg(F.max(best).alias("best"))
    )
    return (
        held.join(_word_by_word(lines, by_item), ["doc_id", "class_id"], "left")
        .select(
            "doc_id",
            F.coalesce("item_id", "class_id").alias("item_id"),
            "best.matched",
            "best.item_windows",
            (F.col("best.matched") / F.col("best.item_windows")).alias("share"),
            F.when(F.col("best.literal"), "plain").otherwise("template").alias("view"),
            "best.consistency",
            "class_id",
            "best.class_items",
        )
    )


def _word_by_word(lines: DataFrame, by_item: DataFrame) -> DataFrame:
    """(doc_id, class_id, item_id): items of classes of several texts that a document holds as they are.

    All windows of such an item lie on one line, a place of the document each, so the line as a
    whole is compared by a hash and not with every item of the class.
    """

    def as_one(rows: DataFrame, *key: str) -> DataFrame:
        in_order = F.sort_array(F.collect_set(F.struct("at", "hash")))
        return (
            rows.where("view = 'plain' AND class_texts > 1")
            .groupBy(*key)
            .agg(F.sha2(F.to_json(in_order), 256).alias("whole"))
        )

    placed = lines.withColumn("distance", F.col("place") - F.col("at"))
    of_items = as_one(by_item, "class_id", "item_id").groupBy("class_id", "whole").agg(
        F.min("item_id").alias("item_id")
    )
    return (
        as_one(placed, "doc_id", "class_id", "distance")
        .join(of_items, ["class_id", "whole"])
        .select("doc_id", "class_id", "item_id")
        .distinct()
    )


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    held = leaks(documents, benchmark).select("doc_id").distinct()
    return documents.join(held, "doc_id", "left_anti").select(*documents.columns)
