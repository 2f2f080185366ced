from datetime import date, timedelta

import pytest
from build import at, landing, marts, naive, rows_of, staged

from touchtrail.operators import reports

BOTH = ("first_click", "last_click")


def test_totals_breakdown_and_comparison(spark):
    table = marts(
        spark,
        [
            {"attribution_model": "first_click", "channel": "Email", "revenue": 1.005},
            {"attribution_model": "first_click", "channel": "Email", "revenue": 2.0},
            {"attribution_model": "last_click", "channel": "Direct", "revenue": 1.0},
            {"attribution_model": "last_click", "channel": "Email", "revenue": 2.25},
        ],
    )
    assert rows_of(reports.model_totals(table)) == [
        ("first_click", 2, 3.01),
        ("last_click", 2, 3.25),
    ]
    assert rows_of(reports.channel_breakdown(table)) == [
        ("first_click", "Email", 2),
        ("last_click", "Direct", 1),
        ("last_click", "Email", 1),
    ]
    assert rows_of(reports.channel_comparison(table)) == [("Direct", 0, 1), ("Email", 2, 1)]


def _daily(spark, rows):
    return marts(spark, [{**row, "attribution_model": m} for row in rows for m in BOTH])


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_daily_window_has_fifteen_days_and_ends_with_the_batch_users(spark, in_zone, zone):
    in_zone(zone)
    last = at(days=40, hours=23, minutes=59)
    table = _daily(
        spark,
        [
            {"conversion_ts": last},
            {"conversion_ts": last - timedelta(days=14, hours=23)},
            {"conversion_ts": last - timedelta(days=15)},
            {"conversion_ts": last + timedelta(days=3), "user_pseudo_id": "stream_user_1"},
            {"conversion_ts": last - timedelta(days=2), "user_pseudo_id": "stream_user_1"},
            {"conversion_ts": last + timedelta(days=5), "user_pseudo_id": None},
        ],
    )
    day = date(2021, 1, 1) + timedelta(days=40)
    want = [
        (day - timedelta(days=n), model, 1) for n in (14, 2, 0) for model in BOTH
    ]
    got = [tuple(r) for r in reports.daily_conversions(table).collect()]
    assert got == want


def test_daily_without_batch_users_is_empty(spark):
    table = _daily(spark, [{"conversion_ts": at(), "user_pseudo_id": "stream_user_1"}])
    assert reports.daily_conversions(table).count() == 0


def test_pattern_underscore_is_a_wildcard(spark):
    users = ["stream_user_1", "streamXuser_1", "Stream_user_1", None]
    table = marts(
        spark,
        [{"user_pseudo_id": u, "attribution_model": m} for u in users for m in BOTH],
    )
    got = [r.user_pseudo_id for r in reports.streamed_user_credit(table).collect()]
    assert got == ["streamXuser_1"] * 2 + ["stream_user_1"] * 2


def test_live_events_are_the_latest_with_duplicates(spark):
    table = landing(
        spark,
        [{"event_id": f"e{i:02d}", "event_ts": at(seconds=i // 2)} for i in range(60)] * 2
        + [{"event_id": "no time"}],
    )
    got = [r.event_ts for r in reports.live_events(table).collect()]
    assert len(got) == 25
    assert got[0] == naive(at(seconds=29)) and got == sorted(got, reverse=True)
    assert reports.live_events(table, 3).count() == 3


def test_dedupe_proof_and_profile(spark):
    raw = landing(spark, [{"event_ts": at(), "user_pseudo_id": "stream_user_1"}] * 3)
    kept = staged(
        spark,
        [
            {"event_ts": at(), "user_pseudo_id": "stream_user_1"},
            {"event_ts": at(), "user_pseudo_id": "other", "event_name": "click"},
        ],
    )
    assert rows_of(reports.dedupe_proof(raw, kept)) == [(3, 1)]
    assert rows_of(reports.dedupe_proof(raw.limit(0), kept.limit(0))) == [(0, 0)]
    assert rows_of(reports.event_profile(kept)) == [("click", 1), ("page_view", 1)]


@pytest.mark.parametrize(
    ("minutes", "status"), [(15, "pass"), (15.5, "warn"), (60, "warn"), (60.5, "error")]
)
def test_freshness(spark, minutes, status):
    table = landing(spark, [{"inserted_at": at()}, {"inserted_at": at(hours=-9)}])
    got = reports.freshness(table, at(minutes=minutes)).first()
    assert (got.last_inserted_at, got.age_minutes, got.status) == (naive(at()), minutes, status)


def test_an_empty_landing_table_is_stale(spark):
    got = reports.freshness(landing(spark, []), at()).first()
    assert (got.last_inserted_at, got.status) == (None, "error")


def test_row_count_trend(spark):
    table = landing(spark, [{"inserted_at": at(minutes=m)} for m in (0, 59, 60, 200)])
    got = rows_of(reports.row_count_trend(table), "window_start", "landed")
    assert got == [
        (naive(at()), 2),
        (naive(at(hours=1)), 1),
        (naive(at(hours=3)), 1),
    ]
