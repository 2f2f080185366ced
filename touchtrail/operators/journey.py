"""Touchpoints, conversions and the paths between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchtrail.functions.columns import (
    DIRECT_SOURCE,
    MICROS_PER_DAY,
    NO_MEDIUM,
    channel_group,
    touchpoint_key_id,
)
from touchtrail.schemas import CONVERSION_COLUMNS, TOUCH_COLUMNS

# A lookback is cut into this many slices for the path join, so that the rows of one heavy
# user spread over many join keys; each conversion then looks into one slice more than that.
SLICES_PER_LOOKBACK = 4
# Touches, and probes, of one user and slice that may meet under one join key.
MOST_IN_CELL = 2_000


def touchpoints(staged: DataFrame) -> DataFrame:
    """One row per (user, session), at the time of its first event.

    Source, medium and campaign are each the first non-null value of the session, so they may
    come from three different events. Two events of a user at one instant differ in name,
    which settles the order between them.
    """
    sessions = (
        staged.where(F.col("ga_session_id").isNotNull())
        .groupBy("user_pseudo_id", "ga_session_id")
        .agg(
            F.min("event_ts").alias("touchpoint_ts"),
            *(_first_known(c).alias(c) for c in ("source", "medium", "campaign")),
        )
    )
    # One select: the channel rules read the raw medium, not the one with the fallback label.
    return sessions.select(
        touchpoint_key_id().alias("touchpoint_id"),
        "user_pseudo_id",
        "ga_session_id",
        "touchpoint_ts",
        F.coalesce("source", F.lit(DIRECT_SOURCE)).alias("source"),
        F.coalesce("medium", F.lit(NO_MEDIUM)).alias("medium"),
        "campaign",
        channel_group(F.col("medium")).alias("channel"),
    )


def _first_known(column: str) -> Column:
    # min over a struct combines before the shuffle and ignores the NULL structs.
    dated = F.struct("event_ts", "event_name", column)
    return F.min(F.when(F.col(column).isNotNull(), dated))[column]


def conversions(staged: DataFrame, conversion_event: str = "purchase") -> DataFrame:
    """One row per conversion event; a missing revenue counts as 0."""
    return staged.where(F.col("event_name") == conversion_event).select(
        F.col("event_id").alias("conversion_id"),
        "user_pseudo_id",
        F.col("event_ts").alias("conversion_ts"),
        F.coalesce("purchase_revenue", F.lit(0.0)).alias("revenue"),
    )


def lookback_micros(lookback_days: int) -> int:
    """The lookback as an exact number of microseconds; a day is always 24 hours."""
    return lookback_days * MICROS_PER_DAY


def conversion_paths(
    conversions: DataFrame,
    touchpoints: DataFrame,
    lookback_days: int = 30,
    slices_per_lookback: int = SLICES_PER_LOOKBACK,
    most_in_cell: int = MOST_IN_CELL,
) -> DataFrame:
    """Every (conversion, touchpoint) pair of one user within the lookback, both ends included.

    The result is the fan-out itself, so it grows with touchpoints per conversion. Credit and
    path lengths are computed without it (see ``credit``). The join key is (user, time slice):
    a touchpoint lies in one slice and a conversion probes all slices its lookback reaches.

    A cell of user and slice that holds more than ``most_in_cell`` touches or probes is cut into
    tiles: its touches into parts and its probes into parts, and every part of the one meets every
    part of the other under a key of its own. So no key has more than about most_in_cell squared
    pairs, whatever a single user does. The cells to cut come from counts per cell, of which there are
    at most one per ``most_in_cell`` rows.
    """
    lookback = lookback_micros(lookback_days)
    width = max(lookback // slices_per_lookback, 1)
    at = F.unix_micros("conversion_ts")
    probes = conversions.select(
        *CONVERSION_COLUMNS,
        F.explode(F.sequence(_slice(at - lookback, width), _slice(at, width))).alias("slice"),
    )
    touches = touchpoints.select(
        F.col("user_pseudo_id").alias("touch_user"),
        _slice(F.unix_micros("touchpoint_ts"), width).alias("touch_slice"),
        *TOUCH_COLUMNS,
    )
    cut = _heavy_cells(probes, touches, most_in_cell)
    probes = _tiled(probes, cut, "user_pseudo_id", "slice", "probe", "touch", CONVERSION_COLUMNS)
    touches = _tiled(touches, cut, "touch_user", "touch_slice", "touch", "probe", TOUCH_COLUMNS)
    gap = F.unix_micros("conversion_ts") - F.unix_micros("touchpoint_ts")
    return probes.alias("p").join(
        touches.alias("t"),
        (F.col("user_pseudo_id") == F.col("touch_user"))
        & (F.col("slice") == F.col("touch_slice"))
        & (F.col("p.touch_part") == F.col("t.touch_part"))
        & (F.col("p.probe_part") == F.col("t.probe_part"))
        & gap.between(0, lookback),
    ).select(*CONVERSION_COLUMNS, *TOUCH_COLUMNS)


def _heavy_cells(probes: DataFrame, touches: DataFrame, most_in_cell: int) -> DataFrame:
    """(cell_user, cell_slice, touch_parts, probe_parts) of the cells that need cutting."""
    both = probes.select(
        F.col("user_pseudo_id").alias("cell_user"),
        F.col("slice").alias("cell_slice"),
        F.lit(1).alias("probe"),
        F.lit(0).alias("touch"),
    ).unionByName(
        touches.select(
            F.col("touch_user").alias("cell_user"),
            F.col("touch_slice").alias("cell_slice"),
            F.lit(0).alias("probe"),
            F.lit(1).alias("touch"),
        )
    )
    counts = both.groupBy("cell_user", "cell_slice").agg(
        F.sum("probe").alias("probes"), F.sum("touch").alias("touches")
    )
    # A cell without the other side has no pairs and joins nothing, wherever its rows are.
    paired = (F.col("probes") > 0) & (F.col("touches") > 0)
    return counts.where(paired & (F.greatest("probes", "touches") > most_in_cell)).select(
        "cell_user",
        "cell_slice",
        F.ceil(F.col("touches") / most_in_cell).alias("touch_parts"),
        F.ceil(F.col("probes") / most_in_cell).alias("probe_parts"),
    )


def _tiled(
    rows: DataFrame,
    cut: DataFrame,
    user: str,
    at: str,
    own: str,
    other: str,
    columns: Sequence[str],
) -> DataFrame:
    """Rows with their own part of a heavy cell, once for each part of the other side."""
    parts = {side: F.coalesce(F.col(f"{side}_parts"), F.lit(1).cast("bigint")) for side in (own, other)}
    numbers = F.sequence(F.lit(0).cast("bigint"), parts[other] - 1)
    in_cell = (F.col(user) == F.col("cell_user")) & (F.col(at) == F.col("cell_slice"))
    return rows.join(cut, in_cell, "left").select(
        user,
        at,
        *(c for c in columns if c != user),
        F.pmod(F.xxhash64(*columns), parts[own]).alias(f"{own}_part"),
        F.explode(numbers).alias(f"{other}_part"),
    )


def _slice(at: Column, width: int) -> Column:
    return F.floor((at - F.pmod(at, F.lit(width))) / width)
