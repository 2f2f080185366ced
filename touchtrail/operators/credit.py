"""First- and last-touch credit, and path lengths, without building the paths.

A conversion needs two touches of its user only: the first one at or after the start of its
lookback, and the last one at or before itself. Both are found by ordered scans of touches and
probes on one time line, so the work stays linear in touches plus conversions even for a user
with a third of all rows. Three steps bound what a single task can be handed:

1. touches of one user at one instant are reduced to the smallest and the largest (combined
   before the shuffle);
2. the time line of a user is cut into fixed slices and each slice is scanned on its own:
   it holds at most one touch per microsecond;
3. a scan over one row per slice of a user carries the nearest touch across slice borders.

Conversions without a user or a time can match nothing. They go along in slices of their own, spread
by a hash, and stay out of the third step, so the conversions are read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchtrail.functions.columns import MICROS_PER_SECOND, UNATTRIBUTED
from touchtrail.operators.journey import lookback_micros
from touchtrail.params import FIRST_CLICK, LAST_CLICK, MODELS, SLICE_SECONDS
from touchtrail.schemas import CONVERSION_COLUMNS, TOUCH, TOUCH_COLUMNS

_USER = "user_pseudo_id"
# Without a user or a time nothing can match.
_KNOWN_CONVERSION = "user_pseudo_id IS NOT NULL AND conversion_ts IS NOT NULL"
_KNOWN_TOUCH = "user_pseudo_id IS NOT NULL AND touchpoint_ts IS NOT NULL"
_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
_BEFORE_HERE = (Window.unboundedPreceding, -1)


def attribute(
    conversions: DataFrame,
    touchpoints: DataFrame,
    lookback_days: int = 30,
    models: Sequence[str] = MODELS,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """The credit marts of ``models``, stacked: one row per conversion and model.

    Equal timestamps are settled by the touchpoint id, smallest for first and largest for last
    click. A conversion without a touch in its lookback gets an ``Unattributed`` row; that
    includes conversions without a user. A model that isn't asked for costs no window.
    """
    lookback = lookback_micros(lookback_days)
    at = F.unix_micros("conversion_ts")
    looks = {FIRST_CLICK: at - lookback, LAST_CLICK: at}
    as_probe = F.struct(*CONVERSION_COLUMNS, "model").alias("probe")
    looking = F.array(*(F.struct(F.lit(m).alias("model"), looks[m].alias("at")) for m in models))
    probes = conversions.select(*CONVERSION_COLUMNS, F.inline(looking))
    marks = _marks(touchpoints, models)
    line = _line(marks, probes.select(_USER, "at", as_probe), slice_seconds)

    # First click looks ahead from the start of its lookback, last click looks behind itself.
    ways = {
        FIRST_CLICK: (F.desc, F.min_by),
        LAST_CLICK: (F.asc, F.max_by),
    }
    is_mark, is_probe = F.col("mark").isNotNull(), F.col("probe").isNotNull()
    mark_at = F.when(is_mark, F.col("at"))
    with_user = F.col("probe.user_pseudo_id").isNotNull() & F.col("at").isNotNull()
    in_slice, slices = Window.partitionBy("slice", _USER), Window.partitionBy(_USER)
    here, edge, carry = [], [], []
    for model in models:
        mark, (order, outermost) = f"mark.{model}", ways[model]
        # Touches sort before probes at the same instant in both directions: both ends count.
        passed = in_slice.orderBy(order("at"), is_probe).rowsBetween(*_TO_HERE)
        here.append(F.last(mark, ignorenulls=True).over(passed).alias(f"{model}_here"))
        edge.append(outermost(mark, mark_at).alias(f"{model}_edge"))
        passed = slices.orderBy(order("slice")).rowsBetween(*_BEFORE_HERE)
        last_edge = F.last(f"{model}_edge", ignorenulls=True).over(passed)
        carry.append(last_edge.alias(f"{model}_carried"))
    scanned = line.select(_USER, "slice", "probe", *here).where(is_probe)
    # ``known`` is asked after the aggregation, so that both readers share the shuffle of the line.
    edges = line.groupBy("slice", _USER).agg(
        *edge, F.max(is_probe).alias("probed"), F.max(is_mark | with_user).alias("known")
    )
    carried = edges.where("known").select(_USER, "slice", "probed", *carry).where("probed")

    nearest = F.coalesce(
        *(
            F.when(
                F.col("probe.model") == model, F.coalesce(f"{model}_here", f"{model}_carried")
            )
            for model in models
        )
    )
    gap = F.unix_micros("probe.conversion_ts") - F.unix_micros("touch.touchpoint_ts")
    found = (
        scanned.join(carried.drop("probed"), ["slice", _USER], "left")
        .select("probe", nearest.alias("touch"))
        .select(
            "probe.*",
            F.when(F.expr("probe.user_pseudo_id IS NOT NULL") & gap.between(0, lookback), F.col("touch"))
            .alias("touch"),
        )
    )
    return found.select(
        *CONVERSION_COLUMNS,
        *(F.col(f"touch.{c}").alias(c) for c in TOUCH_COLUMNS[:-1]),
        F.coalesce("touch.channel", F.lit(UNATTRIBUTED)).alias("channel"),
        F.col("model").alias("attribution_model"),
    )


def first_click(conversions: DataFrame, touchpoints: DataFrame, lookback_days: int = 30) -> DataFrame:
    """All credit to the earliest touch in the lookback."""
    return attribute(conversions, touchpoints, lookback_days, [FIRST_CLICK])


def last_click(conversions: DataFrame, touchpoints: DataFrame, lookback_days: int = 30) -> DataFrame:
    """All credit to the latest touch in the lookback."""
    return attribute(conversions, touchpoints, lookback_days, [LAST_CLICK])


def unattributed(conversions: DataFrame, touchpoints: DataFrame, lookback_days: int = 30) -> DataFrame:
    """Conversions that have no touch in the lookback."""
    credited = last_click(conversions, touchpoints, lookback_days)
    return credited.where(F.col("touchpoint_id").isNull()).select(*CONVERSION_COLUMNS)


def path_lengths(
    conversions: DataFrame,
    touchpoints: DataFrame,
    lookback_days: int = 30,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Touches in the lookback of each conversion that has any.

    Counts up to the conversion minus counts before the lookback, from running totals; no
    pair of conversion and touch is ever formed.
    """
    lookback = lookback_micros(lookback_days)
    marks = (
        touchpoints.where(_KNOWN_TOUCH)
        .groupBy(F.unix_micros("touchpoint_ts").alias("at"), _USER)
        .agg(F.count("*").alias("mark"))
    )
    # A conversion adds what was counted up to itself and takes off what came before its lookback.
    at = F.unix_micros("conversion_ts")
    looks = ((-1, at - lookback), (1, at))
    looking = F.array(*(F.struct(F.lit(n).alias("sign"), t.alias("at")) for n, t in looks))
    probes = conversions.where(_KNOWN_CONVERSION).select(*CONVERSION_COLUMNS, F.inline(looking))
    as_probe = F.struct("conversion_id", "sign").alias("probe")
    line = _line(marks, probes.select(_USER, "at", as_probe), slice_seconds)

    # At one instant: lookback starts, then touches, then conversions.
    turn = F.coalesce("probe.sign", F.lit(0))
    upward = Window.partitionBy("slice", _USER).orderBy("at", turn).rowsBetween(*_TO_HERE)
    scanned = line.select(
        _USER, "slice", "probe", F.sum("mark").over(upward).alias("here")
    ).where("probe IS NOT NULL")
    totals = line.groupBy("slice", _USER).agg(
        F.sum("mark").alias("touches"), F.max(F.col("probe").isNotNull()).alias("probed")
    )
    earlier = Window.partitionBy(_USER).orderBy("slice").rowsBetween(*_BEFORE_HERE)
    carried = totals.select(
        _USER, "slice", "probed", F.sum("touches").over(earlier).alias("before")
    ).where("probed")
    reached = F.coalesce("here", F.lit(0)) + F.coalesce("before", F.lit(0))
    return (
        scanned.join(carried.drop("probed"), ["slice", _USER], "left")
        .groupBy(F.col("probe.conversion_id").alias("conversion_id"))
        .agg(F.sum(F.col("probe.sign") * reached).alias("touches"))
        .where("touches > 0")
    )


def _marks(touchpoints: DataFrame, models: Sequence[str]) -> DataFrame:
    """The touch of each model for each user and instant that has any: smallest or largest id."""
    touch = F.struct(*(F.col(c).cast(TOUCH[c].dataType).alias(c) for c in TOUCH_COLUMNS))
    of_model = {FIRST_CLICK: F.min(touch), LAST_CLICK: F.max(touch)}
    return (
        touchpoints.where(_KNOWN_TOUCH)
        .groupBy(F.unix_micros("touchpoint_ts").alias("at"), _USER)
        .agg(F.struct(*(of_model[m].alias(m) for m in models)).alias("mark"))
    )


def _line(marks: DataFrame, probes: DataFrame, slice_seconds: int) -> DataFrame:
    """Marks and probes on one time line, partitioned by user and slice.

    The scan of a slice and its summary both read all five columns, so they share this one
    shuffle. The slice of a probe without user or time is a hash, and its user is empty here: a key
    without nulls gets no filter of its own in one of the two readers.
    """
    known = F.col(_USER).isNotNull() & F.col("at").isNotNull()
    width = slice_seconds * MICROS_PER_SECOND
    by_time = F.col("at") - F.pmod("at", F.lit(width))
    return (
        marks.unionByName(probes, allowMissingColumns=True)
        .withColumn("slice", F.when(known, by_time).otherwise(F.xxhash64("probe")))
        .withColumn(_USER, F.coalesce(_USER, F.lit("")))
        .repartition("slice", _USER)
    )
