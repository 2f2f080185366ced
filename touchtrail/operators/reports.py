"""Report queries over the marts, the landing table and the staged events.

Each one reduces its input with a partial aggregate (or a top-k) before anything is shuffled.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchtrail.functions.columns import money, utc_day
from touchtrail.params import MODELS


def model_totals(marts: DataFrame) -> DataFrame:
    """Conversions and revenue per model."""
    return marts.groupBy("attribution_model").agg(
        F.count("*").alias("conversions"), money(F.col("revenue")).alias("revenue")
    )


def channel_breakdown(marts: DataFrame) -> DataFrame:
    """Conversions per model and channel."""
    return marts.groupBy("attribution_model", "channel").agg(F.count("*").alias("conversions"))


def channel_comparison(marts: DataFrame) -> DataFrame:
    """Conversions per channel with the models side by side."""
    return marts.groupBy("channel").agg(
        *(F.count_if(F.col("attribution_model") == model).alias(model) for model in MODELS)
    )


def daily_conversions(
    marts: DataFrame, days: int = 14, exclude: str = "stream_user%"
) -> DataFrame:
    """Conversions per UTC day and model, from ``days`` before the last day up to that day.

    The last day is that of users not matching ``exclude``, but all users are counted.
    """
    per_day = marts.groupBy(
        utc_day("conversion_ts").alias("day"), "attribution_model"
    ).agg(
        F.count("*").alias("conversions"),
        F.max(~F.col("user_pseudo_id").like(exclude)).alias("has_batch"),
    )
    # The last day comes from the daily counts, two rows a day, so the marts are read once.
    last_day = F.max(F.when(F.col("has_batch"), F.col("day"))).over(Window.partitionBy())
    return (
        per_day.withColumn("last_day", last_day)
        .where(F.col("day").between(F.date_sub("last_day", days), F.col("last_day")))
        .select("day", "attribution_model", "conversions")
        .orderBy("day", "attribution_model")
    )


def live_events(landing: DataFrame, n: int = 25) -> DataFrame:
    """The latest landed events, duplicates included; equal times by landing id."""
    return (
        landing.orderBy(F.desc("event_ts"), F.asc("event_id"))
        .limit(n)
        .select("event_ts", "event_name", "user_pseudo_id", "source", "medium", "purchase_revenue")
    )


def streamed_user_credit(marts: DataFrame, pattern: str = "stream_user%") -> DataFrame:
    """Credit of the streamed users, model by model. ``_`` in the pattern is a wildcard."""
    return (
        marts.where(F.col("user_pseudo_id").like(pattern))
        .select("attribution_model", "user_pseudo_id", "channel", "revenue", "conversion_ts")
        .orderBy("user_pseudo_id", "attribution_model")
    )


def dedupe_proof(landing: DataFrame, staged: DataFrame, pattern: str = "stream_user%") -> DataFrame:
    """Landed rows next to the staged rows of the streamed users."""
    raw = landing.agg(F.count("*").alias("raw_rows"), F.lit(0).alias("staged_rows"))
    kept = staged.where(F.col("user_pseudo_id").like(pattern)).agg(
        F.lit(0).alias("raw_rows"), F.count("*").alias("staged_rows")
    )
    return raw.unionByName(kept).agg(
        F.sum("raw_rows").alias("raw_rows"), F.sum("staged_rows").alias("staged_rows")
    )


def event_profile(staged: DataFrame) -> DataFrame:
    """Events per event name."""
    return staged.groupBy("event_name").agg(F.count("*").alias("events"))


def freshness(
    landing: DataFrame, now: datetime, warn_minutes: int = 15, error_minutes: int = 60
) -> DataFrame:
    """Age of the last landed row at ``now`` and its verdict; an empty table is an error."""
    age = (F.unix_micros(F.lit(now)) - F.unix_micros("last_inserted_at")) / 60_000_000
    return landing.agg(F.max("inserted_at").alias("last_inserted_at")).select(
        "last_inserted_at",
        F.round(age, 2).alias("age_minutes"),
        F.when(age.isNull() | (age > error_minutes), "error")
        .when(age > warn_minutes, "warn")
        .otherwise("pass")
        .alias("status"),
    )


def row_count_trend(landing: DataFrame, width: str = "1 hour") -> DataFrame:
    """Landed rows per window of load time.

    Takes rows, or rows per minute of load time with their number in ``rows``, as the entries of the
    landing table hold them; windows of whole minutes then come out the same.
    """
    landed = F.sum("rows") if "rows" in landing.columns else F.count("*")
    return (
        landing.groupBy(F.window("inserted_at", width).alias("w"))
        .agg(landed.alias("landed"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "landed")
    )
