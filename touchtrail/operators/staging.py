"""Nested and landed events to one clean event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchtrail.functions.columns import event_key_id, param_int, param_string, utc_day
from touchtrail.schemas import FLAT_COLUMNS

EVENT_KEY = ("user_pseudo_id", "event_name", "event_ts")


def flatten_events(nested: DataFrame) -> DataFrame:
    """One flat row per nested event.

    Source and medium fall back to the user's traffic source; campaign does not.
    A malformed day raises (ANSI mode).
    """
    return nested.select(
        F.to_date("event_date", "yyyyMMdd").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_ts"),
        "event_name",
        "user_pseudo_id",
        param_int("ga_session_id").alias("ga_session_id"),
        F.coalesce(param_string("source"), "traffic_source.source").alias("source"),
        F.coalesce(param_string("medium"), "traffic_source.medium").alias("medium"),
        param_string("campaign").alias("campaign"),
        F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
    )


def stage_events(batch: DataFrame, streamed: DataFrame) -> DataFrame:
    """Both sources stacked, one row per (user, event name, timestamp).

    Of several copies the batch row wins, then the larger revenue, then the smallest of the
    remaining columns. The order is total over the row, so every evaluation of this plan, also
    one after a lost executor, keeps the same copy.

    The rank-1 filter makes Spark drop surplus copies before the shuffle as well as after it:
    a task sends one row per key however many copies it read. The key holds the timestamp,
    so a heavy user is spread over all partitions.
    """
    stacked = _from_origin(batch, 0).unionByName(_from_origin(streamed, 1))
    # The time leads the sort: as a number it decides nearly every comparison by itself.
    copies = Window.partitionBy("event_ts", "user_pseudo_id", "event_name").orderBy(
        "origin",
        F.desc_nulls_last("purchase_revenue"),
        *(
            F.asc_nulls_last(c)
            for c in ("ga_session_id", "source", "medium", "campaign", "event_date")
        ),
    )
    survivors = stacked.withColumn("copy", F.row_number().over(copies)).where("copy = 1")
    return survivors.select(event_key_id().alias("event_id"), *FLAT_COLUMNS)


def with_day(staged: DataFrame) -> DataFrame:
    """Staged events with the UTC day of their time, which is what they are stored by.

    All copies of an event share its time, so whichever copy survives, it stays on the same day. The
    event date that a source gives need not be that day.
    """
    return staged.withColumn("event_day", utc_day("event_ts"))


def _from_origin(events: DataFrame, origin: int) -> DataFrame:
    return events.select(*FLAT_COLUMNS, F.lit(origin).alias("origin"))
