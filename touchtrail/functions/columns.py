"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND

# The fallback labels and the channel rules.
DIRECT_SOURCE = "(direct)"
NO_MEDIUM = "(none)"
PAID_MEDIUMS = ("cpc", "ppc", "paidsearch")
UNATTRIBUTED = "Unattributed"


def _param_index(key: str) -> Column:
    # array_position is 0 when the key is absent, so the index becomes -1 and get() gives NULL.
    # Unlike a higher-order filter() it stays inside generated code and lets the Parquet reader
    # prune the array's structs to the fields named here. The first of two equal keys wins.
    return (F.array_position(F.col("event_params.key"), key) - 1).cast("int")


def param_string(key: str) -> Column:
    """Text value of one event parameter, NULL when the event does not carry it."""
    return F.get(F.col("event_params.value.string_value"), _param_index(key))


def param_int(key: str) -> Column:
    """Integer value of one event parameter, NULL when the event does not carry it."""
    return F.get(F.col("event_params.value.int_value"), _param_index(key))


def event_key_id(user: str = "user_pseudo_id", name: str = "event_name", ts: str = "event_ts") -> Column:
    """md5 over the dedupe key; NULL when any part is NULL."""
    return F.md5(
        F.concat(F.col(user), F.lit("|"), F.col(name), F.lit("|"), F.unix_micros(ts).cast("string"))
    )


def touchpoint_key_id() -> Column:
    """md5 over (user, session); a session number alone is unique per user only."""
    return F.md5(
        F.concat(F.col("user_pseudo_id"), F.lit("|"), F.col("ga_session_id").cast("string"))
    )


def landing_key_id(user: str = "user_pseudo_id", name: str = "event_name", ts: str = "event_ts") -> Column:
    """sha256 over user, event and UTC time text at second precision; NULL when any part is NULL."""
    seconds = F.unix_seconds(ts)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))
    of_day = F.pmod(seconds, F.lit(86400))
    parts = (F.floor(of_day / 3600), F.floor(of_day / 60) % 60, of_day % 60)
    text = F.concat(day.cast("string"), F.lit(" "), F.format_string("%02d:%02d:%02d", *parts))
    return F.sha2(F.concat(F.col(user), F.lit("|"), F.col(name), F.lit("|"), text), 256)


def channel_group(medium: Column) -> Column:
    """Channel of a raw medium: case-sensitive, first matching rule wins."""
    return (
        F.when(medium.isin(*PAID_MEDIUMS), "Paid Search")
        .when(medium == "organic", "Organic Search")
        .when(medium.like("%social%"), "Social")
        .when(medium == "email", "Email")
        .when(medium == "referral", "Referral")
        .when(medium.isNull() | (medium == NO_MEDIUM), "Direct")
        .otherwise("Other")
    )


def utc_day(ts: str | Column) -> Column:
    """UTC calendar day of a timestamp, whatever the session's zone is."""
    micros = F.unix_micros(ts)
    start = micros - F.pmod(micros, F.lit(MICROS_PER_DAY))
    return F.date_from_unix_date((start / MICROS_PER_DAY).cast("int"))


def day_spans(days: Sequence[date | None]) -> list[tuple[int, int]]:
    """The days as spans of microseconds, neighbouring days joined; ends exclusive."""
    spans: list[tuple[int, int]] = []
    for day in sorted({d for d in days if d is not None}):
        start = (day - date(1970, 1, 1)).days * MICROS_PER_DAY
        if spans and spans[-1][1] == start:
            spans[-1] = (spans[-1][0], start + MICROS_PER_DAY)
        else:
            spans.append((start, start + MICROS_PER_DAY))
    return spans


def money(amount: Column) -> Column:
    """Total rounded to cents, half away from zero."""
    return F.round(F.sum(amount), 2)
