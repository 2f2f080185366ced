import random
from datetime import datetime, timedelta, timezone

import pytest
from build import at, conversions, flat, naive, rows_of, staged, touches
from pyspark.sql import functions as F

from touchtrail.operators import journey
from touchtrail.operators.staging import stage_events


def test_each_column_takes_its_own_first_value(spark):
    events = staged(
        spark,
        [
            {"event_ts": at(), "ga_session_id": 1, "event_name": "session_start"},
            {"event_ts": at(minutes=1), "ga_session_id": 1, "medium": "email"},
            {"event_ts": at(minutes=2), "ga_session_id": 1, "source": "s2", "medium": "cpc"},
            {"event_ts": at(minutes=3), "ga_session_id": 1, "source": "s3", "campaign": "c3"},
            {"event_ts": at(), "ga_session_id": None, "source": "none"},
            {"event_ts": at(), "ga_session_id": 1, "user_pseudo_id": "v"},
            {"event_ts": at(hours=9), "ga_session_id": 2, "event_name": "purchase"},
        ],
    )
    got = rows_of(
        journey.touchpoints(events),
        "user_pseudo_id", "ga_session_id", "touchpoint_ts", "source", "medium", "campaign", "channel",
    )
    assert got == [
        ("u", 1, naive(at()), "s2", "email", "c3", "Email"),
        ("u", 2, naive(at(hours=9)), "(direct)", "(none)", None, "Direct"),
        ("v", 1, naive(at()), "(direct)", "(none)", None, "Direct"),
    ]


def test_two_events_at_one_instant_are_ordered_by_name(spark):
    rows = [
        {"event_ts": at(), "ga_session_id": 1, "event_name": "session_start", "source": "late"},
        {"event_ts": at(), "ga_session_id": 1, "event_name": "page_view", "source": "early"},
    ]
    for order in (rows, rows[::-1]):
        assert journey.touchpoints(staged(spark, order)).first()["source"] == "early"


def test_channels(spark):
    expected = {
        "cpc": "Paid Search",
        "ppc": "Paid Search",
        "paidsearch": "Paid Search",
        "CPC": "Other",
        "organic": "Organic Search",
        "paid_social": "Social",
        "social": "Social",
        "Social": "Other",
        "email": "Email",
        "referral": "Referral",
        "(none)": "Direct",
        None: "Direct",
        "": "Other",
        "affiliate": "Other",
    }
    events = staged(
        spark,
        [
            {"event_ts": at(), "ga_session_id": i, "medium": medium}
            for i, medium in enumerate(expected)
        ],
    )
    got = {r.ga_session_id: r.channel for r in journey.touchpoints(events).collect()}
    assert got == dict(enumerate(expected.values()))


def test_conversions(spark):
    events = stage_events(
        flat(
            spark,
            [
                {"event_ts": at(), "event_name": "purchase", "purchase_revenue": 4.0},
                {"event_ts": at(hours=1), "event_name": "purchase"},
                {"event_ts": at(hours=2), "event_name": "Purchase", "purchase_revenue": 4.0},
                {"event_ts": at(hours=3), "event_name": "signup"},
                {"event_ts": at(), "event_name": "purchase", "user_pseudo_id": None},
            ],
        ),
        flat(spark, []),
    )
    got = rows_of(journey.conversions(events), "user_pseudo_id", "conversion_ts", "revenue")
    assert got == [
        ("u", naive(at()), 4.0),
        ("u", naive(at(hours=1)), 0.0),
        (None, naive(at()), 0.0),
    ]
    assert journey.conversions(events).where("conversion_id IS NULL").count() == 1
    assert journey.conversions(events, "signup").count() == 1
    ids = {r.event_id for r in events.collect()}
    assert {r.conversion_id for r in journey.conversions(events).collect()} <= ids


MICRO = timedelta(microseconds=1)


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_lookback_ends_are_inclusive_also_across_a_clock_change(spark, in_zone, zone):
    in_zone(zone)
    moment = datetime(2021, 3, 28, 12, tzinfo=timezone.utc)
    month = timedelta(days=30)
    marks = {
        "start": moment - month,
        "too early": moment - month - MICRO,
        "same": moment,
        "too late": moment + MICRO,
        "between": moment - timedelta(days=7),
    }
    found = journey.conversion_paths(
        conversions(spark, [{"conversion_id": "c", "conversion_ts": moment}]),
        touches(spark, [{"touchpoint_id": k, "touchpoint_ts": v} for k, v in marks.items()]),
    )
    assert {r.touchpoint_id for r in found.collect()} == {"start", "same", "between"}


def test_paths_need_equal_known_users(spark):
    found = journey.conversion_paths(
        conversions(
            spark,
            [
                {"conversion_id": "c", "conversion_ts": at()},
                {"conversion_id": None, "conversion_ts": at(), "user_pseudo_id": None},
            ],
        ),
        touches(
            spark,
            [
                {"touchpoint_id": "v", "touchpoint_ts": at(), "user_pseudo_id": "v"},
                {"touchpoint_id": None, "touchpoint_ts": at(), "user_pseudo_id": None},
            ],
        ),
    )
    assert found.count() == 0


def _hot_user(spark, draw, rows=900):
    """Touches and conversions of which one user has a third."""
    who = lambda n: "hot" if n % 3 == 0 else f"u{draw.randrange(200)}"
    marks = [
        {"touchpoint_id": f"t{n}", "user_pseudo_id": who(n), "touchpoint_ts": at(minutes=draw.randrange(50_000))}
        for n in range(rows)
    ]
    convs = [
        {"conversion_id": f"c{n}", "user_pseudo_id": who(n), "conversion_ts": at(minutes=draw.randrange(50_000))}
        for n in range(rows)
    ]
    return convs, marks


def test_tiles_of_a_hot_user_give_all_paths_once(spark):
    convs, marks = _hot_user(spark, random.Random(7))
    tables = conversions(spark, convs), touches(spark, marks)
    reach = timedelta(days=3)
    plain = sorted(
        (c["conversion_id"], t["touchpoint_id"])
        for c in convs
        for t in marks
        if c["user_pseudo_id"] == t["user_pseudo_id"]
        and c["conversion_ts"] - reach <= t["touchpoint_ts"] <= c["conversion_ts"]
    )
    for most in (1, 7, 2_000):
        paths = journey.conversion_paths(*tables, 3, most_in_cell=most)
        assert rows_of(paths, "conversion_id", "touchpoint_id") == plain


def test_no_task_of_the_path_join_makes_far_more_rows_than_another(spark):
    convs, marks = _hot_user(spark, random.Random(8), rows=3_000)
    tables = conversions(spark, convs), touches(spark, marks)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8",
                "spark.sql.autoBroadcastJoinThreshold": "10000"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)

        def shares(most):
            paths = journey.conversion_paths(*tables, 30, most_in_cell=most)
            per_task = paths.groupBy(F.spark_partition_id()).count().collect()
            return sorted(r["count"] for r in per_task)

        cut, whole = shares(25), shares(10**9)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(cut) == sum(whole)
    assert len(cut) == 8 and cut[-1] <= 3 * cut[4]
    assert whole[-1] > 3 * whole[len(whole) // 2], "a hot user weighs on one task if nothing is cut"


def test_only_cells_with_pairs_are_cut(spark):
    marks = [{"touchpoint_id": f"t{n}", "touchpoint_ts": at(seconds=n)} for n in range(30)]
    convs = [{"conversion_id": f"c{n}", "user_pseudo_id": "other", "conversion_ts": at(days=1)} for n in range(30)]
    text = journey.conversion_paths(conversions(spark, convs), touches(spark, marks), most_in_cell=5)
    assert text.count() == 0
