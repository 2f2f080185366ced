import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from build import at, conversions, naive, ordered, rows_of, touches
from pyspark.sql import functions as F

from touchtrail.operators import credit, journey
from touchtrail.schemas import TOUCH_COLUMNS

MICRO = timedelta(microseconds=1)


def by_rank(convs, marks, days):
    """The plain definition over collected rows: all pairs, ranked both ways, and the rest."""
    lookback = timedelta(days=days)
    marks = [m.asDict() for m in marks.collect()]
    mart, pairs = [], []
    for c in convs.collect():
        near = [
            m
            for m in marks
            if None not in (c.user_pseudo_id, c.conversion_ts)
            and m["user_pseudo_id"] == c.user_pseudo_id
            and timedelta(0) <= c.conversion_ts - m["touchpoint_ts"] <= lookback
        ]
        near.sort(key=lambda m: (m["touchpoint_ts"], m["touchpoint_id"]))
        pairs += [(*c, *(m[k] for k in TOUCH_COLUMNS)) for m in near]
        for model, place in (("first_click", 0), ("last_click", -1)):
            touch = (
                tuple(near[place][k] for k in TOUCH_COLUMNS)
                if near
                else (None,) * 5 + ("Unattributed",)
            )
            mart.append((*c, *touch, model))
    return ordered(mart), ordered(pairs)


def random_tables(spark, seed, users, n, span, instants):
    rng = random.Random(seed)

    def when():
        return at(seconds=rng.choice(instants) if instants else rng.uniform(0, span))

    def who():
        return rng.choice(users)

    taken = set()
    convs = []
    for i in range(n):
        user, ts = who(), when()
        if (user, ts) not in taken:
            taken.add((user, ts))
            cid = None if user is None else f"c{i}"
            convs.append(
                {"conversion_id": cid, "user_pseudo_id": user, "conversion_ts": ts, "revenue": float(i)}
            )
    marks = [
        {
            "touchpoint_id": None if (user := who()) is None else f"t{i:04d}",
            "user_pseudo_id": user,
            "touchpoint_ts": when(),
            "ga_session_id": i,
            "source": f"s{i}",
            "campaign": rng.choice([None, "x"]),
            "channel": rng.choice(["Email", "Direct"]),
        }
        for i in range(n)
    ]
    rng.shuffle(marks)
    return conversions(spark, convs), touches(spark, marks)


DAY = 86_400
CASES = {
    "spread": (1, ["a", "b", "c", None], 150, 20 * DAY, None),
    "one heavy user": (2, ["a"] * 9 + ["b"], 250, 5 * DAY, None),
    "few instants": (3, ["a", "a", "b", None], 120, 0, [0, 1, 59, 60, 61, DAY, DAY + 1, 3 * DAY]),
    "lookback edges": (4, ["a", "b"], 120, 0, [k * DAY for k in range(-3, 6)]),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize(("days", "slice_seconds"), [(2, 60), (30, 7 * DAY)])
def test_equals_ranking_all_pairs(spark, case, days, slice_seconds):
    convs, marks = random_tables(spark, *CASES[case])
    want, pairs = by_rank(convs, marks, days)
    assert rows_of(credit.attribute(convs, marks, days, slice_seconds=slice_seconds)) == want
    assert rows_of(journey.conversion_paths(convs, marks, days)) == pairs
    lengths = Counter(pair[0] for pair in pairs)
    got = credit.path_lengths(convs, marks, days, slice_seconds)
    assert {r.conversion_id: r.touches for r in got.collect()} == lengths
    alone = rows_of(credit.unattributed(convs, marks, days))
    assert alone == [row[:4] for row in want if row[9] == "Unattributed" and row[10] == "last_click"]


def test_invariants(spark):
    convs, marks = random_tables(spark, 9, ["a", "b", "c", None], 200, 10 * DAY, None)
    before = None
    for days in (1, 3, 1000):
        mart = credit.attribute(convs, marks, days).cache()
        assert mart.count() == 2 * convs.count()
        total = F.sum(F.col("revenue").cast("decimal(38,6)"))
        expected = convs.agg(total).first()[0]
        assert [r[1] for r in mart.groupBy("attribution_model").agg(total).collect()] == [expected] * 2
        window = F.expr(f"touchpoint_ts BETWEEN conversion_ts - INTERVAL {days} DAYS AND conversion_ts")
        assert mart.where("touchpoint_id IS NOT NULL").where(~window).count() == 0
        one = mart.where("attribution_model = 'first_click'").alias("f")
        two = mart.where("attribution_model = 'last_click'").alias("l")
        late = one.join(two, "conversion_id").where("f.touchpoint_ts > l.touchpoint_ts")
        assert late.count() == 0
        alone = mart.where("channel = 'Unattributed'").count()
        assert before is None or alone <= before
        before = alone
    assert rows_of(mart) == rows_of(
        credit.attribute(convs.repartition(7), marks.repartition(3), days)
    )


def test_ties_take_smallest_id_first_and_largest_id_last(spark):
    convs = conversions(spark, [{"conversion_id": "c", "conversion_ts": at(days=1)}])
    ids = ["b", "a", "d", "c"]
    marks = touches(spark, [{"touchpoint_id": i, "touchpoint_ts": at(), "source": i} for i in ids])
    assert rows_of(
        credit.attribute(convs, marks), "attribution_model", "touchpoint_id", "source"
    ) == [("first_click", "a", "a"), ("last_click", "d", "d")]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
@pytest.mark.parametrize(
    ("offset", "credited"),
    [
        (timedelta(days=30), True),
        (timedelta(days=30) + MICRO, False),
        (timedelta(0), True),
        (-MICRO, False),
    ],
)
def test_lookback_ends(spark, in_zone, zone, offset, credited):
    in_zone(zone)
    moment = datetime(2021, 3, 28, 12, tzinfo=timezone.utc)
    mart = credit.attribute(
        conversions(spark, [{"conversion_id": "c", "conversion_ts": moment}]),
        touches(spark, [{"touchpoint_id": "t", "touchpoint_ts": moment - offset}]),
    )
    assert {r.touchpoint_id for r in mart.collect()} == ({"t"} if credited else {None})


def test_unattributed_rows(spark):
    convs = conversions(
        spark,
        [
            {"conversion_id": "late", "conversion_ts": at(days=31), "revenue": 3.0},
            {"conversion_id": None, "conversion_ts": at(), "user_pseudo_id": None},
            {"conversion_id": None, "conversion_ts": at(days=1), "user_pseudo_id": None},
            {"conversion_id": "no time", "conversion_ts": None},
        ],
    )
    marks = touches(
        spark,
        [
            {"touchpoint_id": "t", "touchpoint_ts": at()},
            {"touchpoint_id": None, "touchpoint_ts": at(), "user_pseudo_id": None},
            {"touchpoint_id": "x", "touchpoint_ts": None},
        ],
    )
    got = rows_of(credit.first_click(convs, marks))
    nothing = (None,) * 5 + ("Unattributed", "first_click")
    assert got == [
        ("late", "u", naive(at(days=31)), 3.0, *nothing),
        ("no time", "u", None, 1.0, *nothing),
        (None, None, naive(at()), 1.0, *nothing),
        (None, None, naive(at(days=1)), 1.0, *nothing),
    ]


def test_one_user_at_one_instant_with_many_sessions(spark):
    """A third of all touches share user and time; they reduce to two before any scan."""
    marks = spark.range(30_000).select(
        F.format_string("t%05d", "id").alias("touchpoint_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("user_pseudo_id"),
        F.col("id").alias("ga_session_id"),
        F.lit(at()).alias("touchpoint_ts"),
        F.lit("s").alias("source"),
        F.lit("m").alias("medium"),
        F.lit(None).cast("string").alias("campaign"),
        F.lit("Other").alias("channel"),
    )
    convs = conversions(
        spark, [{"conversion_id": "c", "user_pseudo_id": "hot", "conversion_ts": at(days=1)}]
    )
    assert rows_of(credit.attribute(convs, marks), "attribution_model", "touchpoint_id") == [
        ("first_click", "t00000"),
        ("last_click", "t29997"),
    ]
    assert rows_of(credit.path_lengths(convs, marks)) == [("c", 10_000)]
