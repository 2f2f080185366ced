"""The append-only landing table that micro-batches write to.

Layout below the folder of the table::

    _contract.json                                      columns and types
    _deliveries/<feed>/<first>-<last>.json              one entry for what has landed
    feed=<feed>/first=<n>/last=<n>/load_date=<day>/     rows of a delivery, or of a pack of them

A delivery counts once its entry is written, which is the last step; rows without an entry are
never read. So readers see a micro-batch whole or not at all, and one that is replayed after its
entry was written does nothing. Compaction packs consecutive deliveries of a feed; the entry of the
pack takes the place of theirs in one step, because entries inside a larger one do not count.

An entry also holds what reports need without reading rows: rows per minute of load time, and first
and last event time of each file.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta, timezone
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchtrail import schemas
from touchtrail.functions.columns import day_spans, utc_day
from touchtrail.sources import files

DELIVERY_COLUMNS = ("feed", "first", "last", "load_date")
# As stored: the columns of the table, and what its folders are named by.
STORED = T.StructType(
    schemas.LANDING_EVENTS.fields
    + [
        T.StructField("feed", T.StringType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("load_date", T.DateType()),
    ]
)
_ENTRY = (
    "feed string, first long, last long, rows long, last_loaded long, bytes long,"
    " minutes array<struct<minute:long,rows:long>>, files array<struct<name:string,bytes:long,"
    "rows:long,timed:long,first_ts:long,last_ts:long>>, complete boolean"
)
MICROS_PER_MINUTE = 60_000_000

PACK_BYTES = 4 << 30
FILE_BYTES = 256 << 20
LEAST_IN_PACK = 8


class ContractError(ValueError):
    """A folder that is not a landing table, or one of other columns."""


def create_landing(spark: SparkSession, path: str) -> None:
    """Create the landing table unless it is there; rows already landed stay.

    A folder that holds anything else, or a table of other columns, is refused.
    """
    root = path.rstrip("/")
    contract = schemas.LANDING_EVENTS.json()
    if files.read_text(spark, f"{root}/_contract.json") is None and files.names(spark, root):
        raise ContractError(f"{root} holds files, but no landing table")
    if not files.write_new(spark, f"{root}/_contract.json", contract):
        check_contract(spark, root)
    files.make_folder(spark, f"{root}/_deliveries")


def check_contract(spark: SparkSession, path: str) -> None:
    """Raise unless the table's stored columns and types are those of this library."""
    root = path.rstrip("/")
    text = files.read_text(spark, f"{root}/_contract.json")
    if text is None:
        raise ContractError(f"no landing table at {root}; create it first")
    stored = {f.name: f.dataType.simpleString() for f in T.StructType.fromJson(json.loads(text))}
    wanted = {f.name: f.dataType.simpleString() for f in schemas.LANDING_EVENTS}
    if stored != wanted:
        differences = [
            f"{name}: {stored.get(name, 'missing')} instead of {wanted.get(name, 'nothing')}"
            for name in sorted(stored.keys() | wanted.keys())
            if stored.get(name) != wanted.get(name)
        ]
        raise ContractError(f"the landing table at {root} differs: " + "; ".join(differences))


def deliveries(spark: SparkSession, path: str) -> DataFrame:
    """The entries that count: one row per delivery, or per pack of deliveries.

    An entry that another one of its feed contains has been packed; one that is cut off was being
    written when its writer ended. Neither counts.
    """
    check_contract(spark, path)
    entries = (
        spark.read.schema(_ENTRY)
        .option("recursiveFileLookup", "true")
        .json(f"{path.rstrip('/')}/_deliveries")
        .where("complete")
    )
    wider_first = Window.partitionBy("feed").orderBy("first", F.desc("last"))
    before = wider_first.rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("last").over(before), F.lit(-1))
    return entries.withColumn("reached", reached).where("last > reached").drop("reached")


def read_landing(
    spark: SparkSession, path: str, event_days: Sequence[date | None] | None = None
) -> DataFrame:
    """Raw landed rows, duplicates included.

    ``event_days`` leaves the files out that hold no event of these UTC days (None: no time), and
    of the others the rows of other days.
    """
    wanted = F.lit(True) if event_days is None else _may_hold(event_days)
    found = (
        deliveries(spark, path)
        .select("feed", "first", "last", F.explode("files").alias("file"))
        .where(wanted)
        .select("feed", "first", "last", "file.name")
    )
    if event_days is None:
        # Folders are enough where everything is read.
        found = found.select("feed", "first", "last", F.lit("").alias("name")).distinct()
    rows = _rows(spark, path, [_place(path, *entry) for entry in found.collect()])
    if event_days is not None:
        rows = rows.where(in_days(F.col("event_ts"), event_days))
    return rows


def read_latest(spark: SparkSession, path: str, n: int) -> DataFrame:
    """Rows of the files that can hold any of the ``n`` latest events; the others are not opened.

    Files are taken by their first event time, the latest ones first, until they hold ``n`` events: no
    event before the last of these first times can be among the n latest, and only files that
    reach that time are opened. Rows without a time come after all others, so with fewer than n
    timed rows everything is read.
    """
    entries = deliveries(spark, path).select("feed", "first", "last", F.inline("files"))
    per_file = entries.select("feed", "first", "last", "name", "timed", "first_ts", "last_ts").collect()
    held, least = 0, None
    timed = [f for f in per_file if f.first_ts is not None]
    for file in sorted(timed, key=lambda f: f.first_ts, reverse=True):
        held += file.timed
        if held >= n:
            least = file.first_ts
            break
    if least is None:
        return read_landing(spark, path)
    opened = [f for f in timed if f.last_ts >= least]
    places = [_place(path, f.feed, f["first"], f["last"], f.name) for f in opened]
    return _rows(spark, path, places).where(F.col("event_ts") >= _instant(least))


def _rows(spark: SparkSession, path: str, places: list[str]) -> DataFrame:
    if not places:
        return spark.createDataFrame([], schemas.LANDING_EVENTS)
    reader = spark.read.schema(STORED).option("basePath", path.rstrip("/"))
    return reader.parquet(*sorted(places)).select(*schemas.LANDING_COLUMNS)


def load_minutes(spark: SparkSession, path: str) -> DataFrame:
    """(inserted_at, rows): landed rows per minute of load time, from the entries alone."""
    return deliveries(spark, path).select(F.inline("minutes")).select(
        F.timestamp_micros("minute").alias("inserted_at"), "rows"
    )


def last_loads(spark: SparkSession, path: str) -> DataFrame:
    """(inserted_at): the last load time of each delivery, from the entries alone."""
    return deliveries(spark, path).select(F.timestamp_micros("last_loaded").alias("inserted_at"))


def streamed_events(landing: DataFrame) -> DataFrame:
    """The nine columns staging takes; the landing id and load time stay behind."""
    return landing.select(*schemas.FLAT_COLUMNS)


def append_delivery(rows: DataFrame, path: str, feed: str, delivery: int) -> bool:
    """Land one micro-batch. False if it has landed before, alone or in a pack since."""
    spark, root = rows.sparkSession, path.rstrip("/")
    check_contract(spark, root)
    if _landed(spark, root, feed, delivery):
        return False
    _store(rows, root, feed, delivery, delivery)
    return True


def _landed(spark: SparkSession, root: str, feed: str, delivery: int) -> bool:
    for name in files.names(spark, f"{root}/_deliveries/{feed}"):
        if not name.endswith(".json") or name.startswith("."):
            continue
        first, last = map(int, name.removesuffix(".json").split("-"))
        if first <= delivery <= last and _complete(spark, f"{root}/_deliveries/{feed}/{name}"):
            return True
    return False


def _complete(spark: SparkSession, entry: str) -> bool:
    try:
        return json.loads(files.read_text(spark, entry) or "{}").get("complete", False)
    except json.JSONDecodeError:
        return False


def _store(rows: DataFrame, root: str, feed: str, first: int, last: int) -> None:
    spark = rows.sparkSession
    folder = _place(root, feed, first, last)
    rows.select(*schemas.LANDING_COLUMNS, utc_day("inserted_at").alias("load_date")).write.mode(
        "overwrite"
    ).partitionBy("load_date").parquet(folder)
    entry = {"feed": feed, "first": first, "last": last, **_facts(spark, folder)}
    # ``complete`` comes last: an entry that was cut off does not have it.
    text = json.dumps({**entry, "complete": True}) + "\n"
    files.write_over(spark, f"{root}/_deliveries/{feed}/{first}-{last}.json", text)


def _facts(spark: SparkSession, folder: str) -> dict:
    """Rows per minute and the span of event times per file of what was just written."""
    stored = spark.read.schema(STORED).parquet(folder)
    loaded, at = F.unix_micros("inserted_at"), F.unix_micros("event_ts")
    facts = (
        stored.select(
            F.col("_metadata.file_path").alias("name"),
            F.col("_metadata.file_size").alias("bytes"),
            (loaded - F.pmod(loaded, F.lit(MICROS_PER_MINUTE))).alias("minute"),
            loaded.alias("loaded"),
            at.alias("at"),
        )
        .groupingSets([[F.col("name"), F.col("bytes")], [F.col("minute")]], "name", "bytes", "minute")
        .agg(
            F.grouping("minute").alias("is_file"),
            F.count("*").alias("rows"),
            F.count("at").alias("timed"),
            F.min("at").alias("first_ts"),
            F.max("at").alias("last_ts"),
            F.max("loaded").alias("last_loaded"),
        )
        .collect()
    )
    # The result is as large as the list of files and minutes, which is what the entry holds.
    per_file = sorted((f for f in facts if f.is_file), key=lambda f: f.name)
    per_minute = sorted((f for f in facts if not f.is_file and f.minute is not None), key=lambda f: f.minute)
    loads = [f.last_loaded for f in per_file if f.last_loaded is not None]
    return {
        "rows": sum(f.rows for f in per_file),
        "last_loaded": max(loads, default=None),
        "bytes": sum(f.bytes for f in per_file),
        "minutes": [{"minute": f.minute, "rows": f.rows} for f in per_minute],
        "files": [
            {
                "name": "/".join(f.name.split("/")[-2:]),
                "bytes": f.bytes,
                "rows": f.rows,
                "timed": f.timed,
                "first_ts": f.first_ts,
                "last_ts": f.last_ts,
            }
            for f in per_file
        ],
    }


def compact(
    spark: SparkSession,
    path: str,
    pack_bytes: int = PACK_BYTES,
    file_bytes: int = FILE_BYTES,
    least: int = LEAST_IN_PACK,
) -> int:
    """Pack small consecutive deliveries; the number of packs written.

    At least ``least`` of them, of like size, go into one pack, and at most as many as ``pack_bytes``
    takes. The last delivery of a feed is left alone, as it is the one that a stream may still be
    writing. A pack has as many files as its bytes need, at least one a load date, in order of the
    event time. What was packed stays on disk for readers that are at it, until ``clean``.
    """
    root = path.rstrip("/")
    entries = deliveries(spark, root).select("feed", "first", "last", "bytes")
    packs = 0
    ordered = sorted(entries.collect(), key=lambda e: (e.feed, e["first"]))
    for feed, of_feed in groupby(ordered, key=lambda e: e.feed):
        for pack in _packs(list(of_feed)[:-1], pack_bytes, least):
            places = [_place(root, feed, e["first"], e["last"]) for e in pack]
            rows = spark.read.schema(STORED).option("basePath", root).parquet(*places)
            parts = max(1, -(-sum(e.bytes for e in pack) // file_bytes))
            in_order = rows.repartitionByRange(
                parts, "load_date", "event_ts"
            ).sortWithinPartitions("load_date", "event_ts")
            _store(in_order, root, feed, pack[0]["first"], pack[-1]["last"])
            packs += 1
    return packs


def _packs(entries: list, pack_bytes: int, least: int) -> Iterable[list]:
    """Runs of consecutive entries that fit together and are of like size."""
    run, held = [], 0
    for entry in entries:
        if run and held + entry.bytes > pack_bytes:
            yield from _of_like_size(run, least)
            run, held = [], 0
        run.append(entry)
        held += entry.bytes
    yield from _of_like_size(run, least)


def _of_like_size(run: list, least: int) -> Iterable[list]:
    """The run, or what lies on both sides of an entry that is larger than all others together.

    So what is written again ends up in a pack of twice its size at least, and a row is packed as
    many times as its pack has doubled, not once a run.
    """
    if len(run) < least:
        return
    largest = max(range(len(run)), key=lambda n: run[n].bytes)
    if 2 * run[largest].bytes <= sum(e.bytes for e in run):
        yield run
    else:
        yield from _of_like_size(run[:largest], least)
        yield from _of_like_size(run[largest + 1 :], least)


def clean(spark: SparkSession, path: str, older_than: timedelta = timedelta(hours=1)) -> int:
    """Remove deliveries that were packed longer ago than ``older_than``; how many there were."""
    root = path.rstrip("/")
    limit = (time.time() - older_than.total_seconds()) * 1000
    counting: dict[str, list[tuple[int, int]]] = {}
    for e in deliveries(spark, root).select("feed", "first", "last").collect():
        counting.setdefault(e.feed, []).append((e["first"], e["last"]))
    removed = 0
    for feed, spans in counting.items():
        folder = f"{root}/_deliveries/{feed}"
        for name in files.names(spark, folder):
            if not name.endswith(".json") or name.startswith("."):
                continue
            first, last = map(int, name.removesuffix(".json").split("-"))
            pack = next((s for s in spans if s[0] <= first and last <= s[1] and s != (first, last)), None)
            if pack and files.written_at(spark, f"{folder}/{pack[0]}-{pack[1]}.json") <= limit:
                # The entry goes last, so that a removal that was cut off is taken up again.
                files.remove(spark, _place(root, feed, first, last))
                files.remove(spark, f"{folder}/{name}")
                removed += 1
    return removed


def read_delivery(spark: SparkSession, path: str, feed: str, delivery: int) -> DataFrame:
    """The rows of one delivery, or of the pack that it has become part of."""
    holds = (F.col("feed") == feed) & F.lit(delivery).between(F.col("first"), F.col("last"))
    found = deliveries(spark, path).where(holds & (F.col("rows") > 0)).select("feed", "first", "last")
    return _rows(spark, path, [_place(path, *entry) for entry in found.collect()])


def touched_days(rows: DataFrame) -> list[date | None]:
    """The UTC days that events of ``rows`` are on, None for events without a time."""
    days = rows.select(utc_day("event_ts").alias("day")).distinct().collect()
    return sorted((r.day for r in days), key=lambda d: (d is not None, d))


def in_days(event_ts: Column, days: Sequence[date | None]) -> Column:
    """Whether a time is on one of the days, as ranges that reach the file reader."""
    wanted = F.lit(False)
    for start, end in day_spans(days):
        wanted |= (event_ts >= _instant(start)) & (event_ts < _instant(end))
    return wanted | event_ts.isNull() if None in days else wanted


def _may_hold(days: Sequence[date | None]) -> Column:
    """Whether a file's span of event times reaches into one of the days."""
    wanted = F.lit(False)
    for start, end in day_spans(days):
        wanted |= (F.col("file.last_ts") >= start) & (F.col("file.first_ts") < end)
    return wanted | (F.col("file.timed") < F.col("file.rows")) if None in days else wanted


def _instant(micros: int) -> Column:
    return F.lit(datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros))


def _place(root: str, feed: str, first: int, last: int, name: str = "") -> str:
    place = f"{root.rstrip('/')}/feed={feed}/first={first}/last={last}"
    return f"{place}/{name}" if name else place
