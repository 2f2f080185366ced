"""Every operator as a query over the given tables, whole tables throughout."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchtrail.functions.columns import channel_group, utc_day
from touchtrail.operators import credit, journey, quality, reports, staging
from touchtrail.params import FIRST_CLICK, Params
from touchtrail.plans import pipeline
from touchtrail.schemas import FLAT_EVENTS
from touchtrail.session import configure, scratch_dir
from touchtrail.sources import given_events as given
from touchtrail.sources import landing as landings
from touchtrail.sources.batch import read_nested_events
from touchtrail.sources.landing import create_landing, read_landing, streamed_events
from touchtrail.streaming import ingest, refresh

PARAMS = Params()
# Half an hour after the end of the given events' last day.
NOW = datetime(2024, 1, 31, 0, 30, tzinfo=timezone.utc)

# Micro-batches that the events are landed in, days mixed.
LATE_BATCHES = 4
# Micro-batches of the job that publishes the marts after each one.
REFRESH_BATCHES = 3
# Deliveries of the written landing table: six days each, some of them late.
DELIVERY_DAYS, DELIVERY_ORDER = 6, (1, 0, 3, 2, 4)
# A cell this small is cut into tiles even in the given events.
SMALL_CELL = 2
# The closed range of days that the shards are read for.
FIRST_DAY, LAST_DAY = date(2024, 1, 5), date(2024, 1, 14)

Query = Callable[[SparkSession, str], DataFrame]


def _web(spark: SparkSession, sf_dir: str, name_streamed_users: bool = False) -> DataFrame:
    return given.web_events(given.read_events(configure(spark), sf_dir), name_streamed_users)


def _staged(spark: SparkSession, sf_dir: str, name_streamed_users: bool = False) -> DataFrame:
    web = _web(spark, sf_dir, name_streamed_users)
    return staging.stage_events(
        given.batch_part(web), streamed_events(given.landed_part(web))
    )


def _journey(
    spark: SparkSession, sf_dir: str, name_streamed_users: bool = False
) -> tuple[DataFrame, DataFrame]:
    staged = _staged(spark, sf_dir, name_streamed_users)
    return (
        journey.conversions(staged, PARAMS.conversion_event),
        journey.touchpoints(staged),
    )


def _marts(spark: SparkSession, sf_dir: str, name_streamed_users: bool = False) -> DataFrame:
    return credit.attribute(
        *_journey(spark, sf_dir, name_streamed_users), PARAMS.lookback_days
    )


def _conversions_and_marts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The conversions and the published marts, as a check of the credit step needs them."""
    convs, touches = _journey(spark, sf_dir)
    path = scratch_dir(spark, "marts")
    credit.attribute(convs, touches, PARAMS.lookback_days).write.parquet(path)
    return convs, spark.read.parquet(path)


def flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.flatten_events(given.as_nested(_web(spark, sf_dir)))


def nested_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events written as an export of day shards, and all shards read back."""
    return staging.flatten_events(read_nested_events(spark, _export(spark, sf_dir)))


def nested_shards_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of a range of days; the others are not opened."""
    root = _export(spark, sf_dir)
    return staging.flatten_events(read_nested_events(spark, root, FIRST_DAY, LAST_DAY))


def _export(spark: SparkSession, sf_dir: str) -> str:
    nested = given.as_nested(_web(spark, sf_dir))
    root = scratch_dir(spark, "export")
    given.write_shards(nested, root)
    return root


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir)


def touchpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _journey(spark, sf_dir)[1]


def channel_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    medium = F.col("medium")
    web = _web(spark, sf_dir)
    return web.groupBy(medium, channel_group(medium).alias("channel")).agg(
        F.count("*").alias("events")
    )


def conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _journey(spark, sf_dir)[0]


def _written_journey(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Conversions and touchpoints as stored tables, for steps that read them more than once."""
    path = scratch_dir(spark, "journey")
    out = []
    for name, table in zip(("conversions", "touchpoints"), _journey(spark, sf_dir), strict=True):
        table.write.parquet(f"{path}/{name}")
        out.append(spark.read.schema(table.schema).parquet(f"{path}/{name}"))
    return out[0], out[1]


def conversion_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journey.conversion_paths(*_written_journey(spark, sf_dir), PARAMS.lookback_days)


def conversion_paths_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journey.conversion_paths(*_written_journey(spark, sf_dir), 1)


def conversion_paths_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paths with cells of users and slices cut into tiles, as a heavy user's are."""
    convs, touches = _written_journey(spark, sf_dir)
    return journey.conversion_paths(
        convs, touches, PARAMS.lookback_days, most_in_cell=SMALL_CELL
    )


def first_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credit.first_click(*_journey(spark, sf_dir), PARAMS.lookback_days)


def first_click_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credit.first_click(*_journey(spark, sf_dir), 1)


def last_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credit.last_click(*_journey(spark, sf_dir), PARAMS.lookback_days)


def last_click_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credit.last_click(*_journey(spark, sf_dir), 1)


def unattributed_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credit.unattributed(*_journey(spark, sf_dir), 1)


def model_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.model_totals(_marts(spark, sf_dir))


def channel_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.channel_breakdown(_marts(spark, sf_dir))


def channel_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.channel_comparison(_marts(spark, sf_dir))


def daily_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = _marts(spark, sf_dir, name_streamed_users=True)
    return reports.daily_conversions(marts, PARAMS.report_days, PARAMS.stream_pattern)


def live_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.live_events(given.as_landed(_web(spark, sf_dir)), PARAMS.live_rows)


def _landing_table(spark: SparkSession, sf_dir: str) -> str:
    """All events written as a landing table of several deliveries, the older days not always first."""
    path = f"{scratch_dir(spark, 'landing')}/events"
    create_landing(spark, path)
    landed = given.as_landed(_web(spark, sf_dir))
    group = F.floor(F.datediff("event_date", F.lit("2024-01-01").cast("date")) / DELIVERY_DAYS)
    last = len(DELIVERY_ORDER) - 1
    for number, wanted in enumerate(DELIVERY_ORDER):
        # Days outside the expected month belong to the outer groups.
        part = landed.where(F.greatest(F.lit(0), F.least(group, F.lit(last))) == wanted)
        landings.append_delivery(part, path, "given", number)
    return path


def live_events_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest events of a written landing table; files that cannot hold any stay closed."""
    path = _landing_table(spark, sf_dir)
    return reports.live_events(landings.read_latest(spark, path, PARAMS.live_rows), PARAMS.live_rows)


def freshness_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness from the entries of the landing table, without its rows."""
    loads = landings.last_loads(spark, _landing_table(spark, sf_dir))
    return reports.freshness(loads, NOW, PARAMS.warn_minutes, PARAMS.error_minutes)


def row_count_trend_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per hour of load time from the entries of the landing table, without its rows."""
    return reports.row_count_trend(landings.load_minutes(spark, _landing_table(spark, sf_dir)))


def landing_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table after deliveries were packed, one replayed, and the packed ones removed."""
    path = _landing_table(spark, sf_dir)
    landings.compact(spark, path, least=2)
    landings.append_delivery(given.as_landed(_web(spark, sf_dir)), path, "given", 1)
    landings.clean(spark, path, timedelta(0))
    return read_landing(spark, path)


def streamed_user_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = _marts(spark, sf_dir, name_streamed_users=True)
    return reports.streamed_user_credit(marts, PARAMS.stream_pattern)


def dedupe_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    web = _web(spark, sf_dir, name_streamed_users=True)
    landing = given.landed_part(web)
    staged = staging.stage_events(given.batch_part(web), streamed_events(landing))
    return reports.dedupe_proof(landing, staged, PARAMS.stream_pattern)


def path_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credit.path_lengths(*_journey(spark, sf_dir), PARAMS.lookback_days)


def event_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.event_profile(_staged(spark, sf_dir))


def revenue_reconciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: the three totals and whether they agree."""
    return quality.reconciliation(*_conversions_and_marts(spark, sf_dir))


def strict_reconciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions checked one by one: over both marts, and with one mart left out."""
    convs, marts = _conversions_and_marts(spark, sf_dir)
    whole = quality.strict_reconciles(convs, marts)
    broken = quality.strict_reconciles(
        convs, marts.where(F.col("attribution_model") == FIRST_CLICK)
    )
    return quality.violation_count(whole, "marts", "revenue", "strict").unionByName(
        quality.violation_count(broken, "one_mart", "revenue", "strict")
    )


def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared not-null tests of staging and the nullable columns, with rows that fail."""
    staged = _staged(spark, sf_dir)
    return quality.column_tests(staged, "staged_events", staged.columns, [])


def unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unique test on the staged key, and on a column that is not unique."""
    staged = _staged(spark, sf_dir)
    return quality.column_tests(staged, "staged_events", [], ["event_id", "user_pseudo_id"])


def duplicate_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate parameter keys in the nested events, and in a copy whose parameters repeat."""
    nested = given.as_nested(_web(spark, sf_dir))
    doubled = nested.withColumn("event_params", F.concat("event_params", "event_params"))
    once = quality.violation_count(
        quality.duplicate_params(nested), "nested_events", "event_params", "duplicate_keys"
    )
    return once.unionByName(
        quality.violation_count(
            quality.duplicate_params(doubled), "doubled_params", "event_params", "duplicate_keys"
        )
    )


def landing_event_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = _web(spark, sf_dir).select(*ingest.SENT_EVENTS.fieldNames())
    return ingest.arriving_rows(sent).select(
        "event_id", "event_ts", "event_date", "event_name", "user_pseudo_id"
    )


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = given.as_landed(_web(spark, sf_dir))
    return reports.freshness(landing, NOW, PARAMS.warn_minutes, PARAMS.error_minutes)


def row_count_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.row_count_trend(given.as_landed(_web(spark, sf_dir)))


def _event_stream(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The part files of a folder as a stream of sent events."""
    raw = ingest.read_stream(
        configure(spark),
        folder,
        given.GIVEN_EVENTS,
        "parquet",
        max_files_per_trigger,
        path_glob="*.parquet",
    )
    return given.web_events(raw).select(*ingest.SENT_EVENTS.fieldNames())


def _event_files(spark: SparkSession, sf_dir: str, folder: str, files: int | None = None) -> str:
    """The events table, a file or a folder of any layout, as a folder that a stream can read.

    ``files``: how many files the rows are dealt over, else as the table is read.
    """
    path = f"{folder}/sent"
    events = given.read_events(configure(spark), sf_dir)
    (events.repartition(files) if files else events).write.parquet(path)
    return path


def _ingest_twice(spark: SparkSession, sf_dir: str) -> str:
    """The events table landed, and delivered once more under a fresh checkpoint; the landing table."""
    folder = scratch_dir(spark, "ingest")
    create_landing(spark, f"{folder}/landing")
    sent = _event_files(spark, sf_dir, folder)
    for delivery in ("first", "again"):
        stream = _event_stream(spark, sent)
        ingest.ingest_available(stream, f"{folder}/landing", f"{folder}/checkpoint-{delivery}")
    return f"{folder}/landing"


def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table after both deliveries; the load time is left out."""
    return read_landing(spark, _ingest_twice(spark, sf_dir)).drop("inserted_at")


def ingest_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging over the landing table that took every event twice."""
    landed = streamed_events(read_landing(spark, _ingest_twice(spark, sf_dir)))
    no_batch = spark.createDataFrame([], FLAT_EVENTS)
    return staging.stage_events(no_batch, landed)


def ingest_load_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per feed: rows, moments of loading, and whether these lie in this run and name the folders."""
    began = spark.range(1).select(F.current_timestamp()).first()[0]
    stored = spark.read.schema(landings.STORED).parquet(_ingest_twice(spark, sf_dir))
    in_run = F.col("inserted_at").between(F.lit(began), F.current_timestamp())
    return (
        stored.groupBy("feed")
        .agg(
            F.count("*").alias("landed"),
            F.countDistinct("inserted_at").alias("load_times"),
            F.count_if(F.coalesce(in_run, F.lit(False))).alias("loaded_in_run"),
            F.count_if(utc_day("inserted_at") == F.col("load_date")).alias("stored_by_day"),
        )
        .drop("feed")
    )


def _sent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines; every tenth is cut off, and of another tenth the time is no time."""
    k = F.col("event_id") % 10
    at = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    sound = F.concat(
        F.lit('{"event_name":"'), "event_type", F.lit('","user_pseudo_id":"u'),
        F.col("user_id").cast("string"), F.lit('","event_ts":"'),
        F.when(k == 7, F.lit("no time")).otherwise(at), F.lit('"}'),
    )
    line = F.when(k == 3, F.substring(sound, 1, 40)).otherwise(sound)
    return given.read_events(configure(spark), sf_dir).select(line.alias("value"))


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines sent with every fifth of them malformed: what landed, and the text of what did not."""
    folder = scratch_dir(spark, "rejects")
    create_landing(spark, f"{folder}/landing")
    _sent_lines(spark, sf_dir).write.text(f"{folder}/sent")
    stream = ingest.read_stream(spark, f"{folder}/sent", path_glob="*.txt")
    ingest.ingest_available(
        stream, f"{folder}/landing", f"{folder}/checkpoint", f"{folder}/rejects"
    )
    landed = read_landing(spark, f"{folder}/landing").select(
        F.lit("landed").alias("fate"), "event_id", F.lit(None).cast("string").alias("line")
    )
    rejected = ingest.read_rejects(spark, f"{folder}/rejects").select(
        F.lit("rejected").alias("fate"), F.lit(None).cast("string").alias("event_id"), "line"
    )
    return landed.unionByName(rejected)


def stream_first_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming pre-filter in front of the landing table, every event being sent twice."""
    folder = scratch_dir(spark, "first-deliveries")
    create_landing(spark, f"{folder}/landing")
    doubled = _event_stream(spark, _event_files(spark, sf_dir, folder)).select(
        "*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")
    )
    stream = ingest.first_deliveries(doubled).drop("copy")
    ingest.ingest_available(stream, f"{folder}/landing", f"{folder}/checkpoint")
    return read_landing(spark, f"{folder}/landing").drop("inserted_at")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pre-filter over many micro-batches, with events of all days in each and copies."""
    folder = scratch_dir(spark, "late-rows")
    create_landing(spark, f"{folder}/landing")
    # As many files a batch as there are cores, so that no task takes a batch alone.
    cores = spark.sparkContext.defaultParallelism
    sent = _event_files(spark, sf_dir, folder, LATE_BATCHES * cores)
    doubled = _event_stream(spark, sent, max_files_per_trigger=cores).select(
        "*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")
    )
    stream = ingest.first_deliveries(doubled).drop("copy")
    ingest.ingest_available(stream, f"{folder}/landing", f"{folder}/checkpoint")
    return read_landing(spark, f"{folder}/landing").drop("inserted_at")


def restaged_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging by day: all days of the export first, then the days that landed rows are on."""
    web = _web(spark, sf_dir)
    nested, landed = given.as_nested(given.batch_part(web)), given.landed_part(web)
    path = pipeline.staged_path(scratch_dir(spark, "staging"))
    pipeline.restage(spark, nested, landed.where("false"), path)
    pipeline.restage(spark, nested, landed, path, landings.touched_days(landed))
    return pipeline.read_staged(spark, path)


def _rebuilt(spark: SparkSession, sf_dir: str, tested: bool = False) -> str:
    web = _web(spark, sf_dir)
    out = scratch_dir(spark, "rebuild")
    nested = given.as_nested(given.batch_part(web))
    pipeline.rebuild(spark, nested, given.landed_part(web), out, PARAMS, tested=tested)
    return out


def rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full refresh from nested and landed events; the marts as readers of the build find them."""
    return pipeline.current_tables(spark, _rebuilt(spark, sf_dir)).marts


def rebuild_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full refresh with all declared tests, as they are stored with the build."""
    return pipeline.test_results(spark, _rebuilt(spark, sf_dir, tested=True))


def stream_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed events sent in micro-batches, marts published after each; those of the last one."""
    folder = scratch_dir(spark, "stream-rebuild")
    create_landing(spark, f"{folder}/landing")
    web = _web(spark, sf_dir)
    given.as_nested(given.batch_part(web)).write.parquet(f"{folder}/export/events_all")
    sent = given.landed_part(web).select(*ingest.SENT_EVENTS.fieldNames())
    # As many files a batch as there are cores, so that no task takes a batch alone.
    cores = spark.sparkContext.defaultParallelism
    sent.repartition(REFRESH_BATCHES * cores, "event_ts").write.parquet(f"{folder}/sent")
    # Rows arrive with whole seconds, so the export's copies have them as well.
    stream = ingest.read_stream(
        spark, f"{folder}/sent", ingest.SENT_EVENTS, "parquet", cores, path_glob="*.parquet"
    )
    refresh.start_refresh(
        stream,
        lambda s: read_nested_events(s, f"{folder}/export"),
        f"{folder}/landing",
        f"{folder}/out",
        f"{folder}/checkpoint",
        PARAMS,
    ).awaitTermination()
    return pipeline.current_tables(spark, f"{folder}/out").marts


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        flatten_events,
        nested_shards,
        nested_shards_range,
        staged_events,
        touchpoints,
        channel_grouping,
        conversions,
        conversion_paths,
        conversion_paths_1d,
        conversion_paths_cut,
        first_click,
        first_click_1d,
        last_click,
        last_click_1d,
        unattributed_1d,
        model_totals,
        channel_breakdown,
        channel_comparison,
        daily_conversions,
        live_events,
        live_events_landed,
        streamed_user_credit,
        dedupe_proof,
        path_lengths,
        event_profile,
        revenue_reconciles,
        strict_reconciles,
        not_null_violations,
        unique_violations,
        duplicate_params,
        landing_event_id,
        freshness,
        row_count_trend,
        freshness_landed,
        row_count_trend_landed,
        landing_compacted,
        ingest_stream,
        ingest_staged,
        ingest_load_times,
        ingest_rejects,
        stream_first_deliveries,
        stream_late_rows,
        restaged_days,
        rebuild,
        rebuild_tests,
        stream_rebuild,
    )
}
