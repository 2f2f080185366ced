"""The generic ``events`` table (event_id, ts, user_id, event_type, value, props) as web events.

The table has no sessions and no campaign data; both are derived from the number in ``props``
by fixed rules, for every row.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchtrail.functions.columns import landing_key_id, utc_day
from touchtrail.schemas import FLAT_COLUMNS, LANDING_COLUMNS

GIVEN_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# The medium for each value of k % 12.
MEDIUMS = (
    None, "cpc", "organic", "paid_social", "email", "referral",
    "(none)", "affiliate", "ppc", "CPC", "organic", None,
)

# The batch export ends where EXPORT_END says; landing starts before that, so the days
# between are delivered by both.
LANDING_START = datetime(2024, 1, 20, tzinfo=timezone.utc)
EXPORT_END = datetime(2024, 1, 24, tzinfo=timezone.utc)
REDELIVERED = "redelivered"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(GIVEN_EVENTS).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def web_events(events: DataFrame, name_streamed_users: bool = False) -> DataFrame:
    """Flat web events of the whole table; every tenth user can get a streamed user's name."""
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    if name_streamed_users:
        streamed = F.concat(F.lit("stream_user_"), F.col("user_id").cast("string"))
        user = F.when(F.col("user_id") % 10 == 0, streamed).otherwise(user)
    medium = F.lit(None).cast("string")
    for rest, name in enumerate(MEDIUMS):
        if name is not None:
            medium = F.when(F.col("k") % 12 == rest, name).otherwise(medium)
    # props is always {"k": n}; a pattern costs a fraction of parsing the JSON.
    k = F.regexp_extract("props", r'"k": *(\d+)', 1).cast("int").alias("k")
    # The file's timestamps carry no zone; they are read as UTC.
    ts = F.col("ts").cast("timestamp").alias("event_ts")
    parsed = events.select("*", k, ts)
    days = F.datediff(utc_day("event_ts"), F.lit("2024-01-01").cast("date"))
    return parsed.select(
        utc_day("event_ts").alias("event_date"),
        "event_ts",
        F.col("event_type").alias("event_name"),
        user.alias("user_pseudo_id"),
        F.when(F.col("k") % 10 != 7, F.floor(days / 2)).alias("ga_session_id"),
        F.when(F.col("k") % 8 != 0, F.concat(F.lit("src"), F.col("k") % 5)).alias("source"),
        medium.alias("medium"),
        F.when(F.col("k") % 3 == 0, F.concat(F.lit("camp"), F.col("k") % 4)).alias("campaign"),
        F.when(
            (F.col("event_type") == "purchase") & (F.col("k") % 11 != 0), F.col("value")
        ).alias("purchase_revenue"),
    )


def batch_part(web: DataFrame) -> DataFrame:
    """What the batch export holds: all events up to its end."""
    return web.where(F.col("event_ts") < F.lit(EXPORT_END)).select(*FLAT_COLUMNS)


def landed_part(web: DataFrame) -> DataFrame:
    """What the landing table holds; rows the export has too are marked by their campaign."""
    again = F.when(F.col("event_ts") < F.lit(EXPORT_END), REDELIVERED)
    return as_landed(
        web.where(F.col("event_ts") >= F.lit(LANDING_START)).withColumn(
            "campaign", again.otherwise(F.col("campaign"))
        )
    )


def as_landed(web: DataFrame) -> DataFrame:
    """Landing columns; a row counts as loaded in the second of its event."""
    return web.withColumns(
        {"event_id": landing_key_id(), "inserted_at": F.date_trunc("second", "event_ts")}
    ).select(*LANDING_COLUMNS)


def as_nested(web: DataFrame) -> DataFrame:
    """The flat events in the nested layout of the batch export.

    Events of a source with a campaign keep source and medium as parameters, the others only
    have them as traffic source. NULL values are left out of the parameters.
    """
    own = F.col("campaign").isNotNull()
    text = [
        _param("source", F.when(own, F.col("source")), F.lit(None)),
        _param("medium", F.when(own, F.col("medium")), F.lit(None)),
        _param("campaign", F.col("campaign"), F.lit(None)),
        _param("ga_session_id", F.lit(None), F.col("ga_session_id")),
    ]
    return web.select(
        F.date_format("event_date", "yyyyMMdd").alias("event_date"),
        F.unix_micros("event_ts").alias("event_timestamp"),
        "event_name",
        "user_pseudo_id",
        F.array_compact(F.array(*text)).alias("event_params"),
        F.struct("source", "medium").alias("traffic_source"),
        F.struct("purchase_revenue").alias("ecommerce"),
    )


def _param(key: str, string_value: Column, int_value: Column) -> Column:
    value = F.struct(
        string_value.cast("string").alias("string_value"),
        int_value.cast("bigint").alias("int_value"),
    )
    known = string_value.isNotNull() | int_value.isNotNull()
    return F.when(known, F.struct(F.lit(key).alias("key"), value.alias("value")))


def write_shards(nested: DataFrame, root: str) -> None:
    """Nested events as an exporter would leave them: one folder ``events_YYYYMMDD`` per day.

    For the registered queries only. The partition folders get their names after the write; the day
    stays a column of the files.
    """
    spark = nested.sparkSession
    nested.withColumn("day", F.col("event_date")).write.partitionBy("day").parquet(root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in files.globStatus(path(f"{root}/day=*")):
        source = folder.getPath()
        day = source.getName().removeprefix("day=")
        if not files.rename(source, path(source.getParent(), f"events_{day}")):
            raise OSError(f"no shard for {day} below {root}")
