"""Nested batch export: one folder per day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchtrail import schemas
from touchtrail.functions.columns import day_spans
from touchtrail.sources import files


def read_nested_events(
    spark: SparkSession,
    root: str,
    first_day: date | None = None,
    last_day: date | None = None,
) -> DataFrame:
    """All day shards ``events_YYYYMMDD`` below ``root``, or those of a closed range of days.

    Days outside the range are never listed or opened. Days without a shard are skipped; a range
    without any gives no events.
    """
    if (first_day is None) != (last_day is None):
        raise ValueError("give both ends of the day range or none")
    shards = "events_*"
    if first_day is not None:
        span = (last_day - first_day).days + 1
        if span < 1:
            raise ValueError("the day range is empty")
        days = (first_day + timedelta(days=n) for n in range(span))
        shards = "events_{" + ",".join(f"{day:%Y%m%d}" for day in days) + "}"
    if first_day is not None and not files.any_match(spark, f"{root.rstrip('/')}/{shards}"):
        return spark.createDataFrame([], schemas.NESTED_EVENTS)
    return spark.read.schema(schemas.NESTED_EVENTS).parquet(f"{root.rstrip('/')}/{shards}")


def of_days(nested: DataFrame, event_days: Sequence[date | None]) -> DataFrame:
    """Events whose time is on one of these UTC days (None: no time).

    The condition is on the stored number, so the reader skips what its statistics rule out. Shards
    are named by the exporter's own day, which need not be the UTC day, so they are not chosen by name.
    """
    at, wanted = F.col("event_timestamp"), F.lit(False)
    for start, end in day_spans(event_days):
        wanted |= (at >= start) & (at < end)
    return nested.where(wanted | at.isNull() if None in event_days else wanted)
