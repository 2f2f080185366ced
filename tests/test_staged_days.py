"""Staging by day: only the days that events arrived for are written, and nothing is lost."""

import random
from datetime import timedelta

import pytest
from build import T0, at, landing, nested, param, rows_of

from touchtrail.operators import staging
from touchtrail.plans import pipeline, publish
from touchtrail.sources.batch import of_days
from touchtrail.sources.landing import streamed_events, touched_days

DAYS = 6


def _moment(draw):
    return at(days=draw.randrange(DAYS), hours=draw.choice([0, 12, 23]), minutes=draw.choice([0, 59]))


def _export(spark, draw, n):
    rows = []
    for _ in range(n):
        moment = _moment(draw)
        # The exporter's own day may be the one before or after.
        own = moment + timedelta(days=draw.choice([-1, 0, 0, 1]))
        rows.append(
            {
                "event_date": f"{own:%Y%m%d}",
                "event_timestamp": int(moment.timestamp() * 1_000_000),
                "user_pseudo_id": draw.choice("abc"),
                "event_params": [param("ga_session_id", number=draw.randrange(3))],
            }
        )
    return nested(spark, rows)


def _landed(spark, draw, n):
    return landing(
        spark,
        [
            {
                "event_ts": draw.choice([_moment(draw)] * 9 + [None]),
                "event_date": T0.date() + timedelta(days=draw.randrange(DAYS)),
                "user_pseudo_id": draw.choice("abcd"),
                "campaign": draw.choice(["x", None]),
                "purchase_revenue": draw.choice([None, 1.0, 2.0]),
            }
            for _ in range(n)
        ],
    )


def _whole(export, landed):
    return staging.stage_events(staging.flatten_events(export), streamed_events(landed))


def _files(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


@pytest.mark.parametrize("seed", [1, 2])
def test_restaged_days_equal_staging_everything(spark, tmp_path, seed):
    draw = random.Random(seed)
    export, landed, path = _export(spark, draw, 60), _landed(spark, draw, 20), str(tmp_path / "s")
    pipeline.restage(spark, export, landed, path)
    assert rows_of(pipeline.read_staged(spark, path)) == rows_of(_whole(export, landed))
    for n in (1, 7):
        before = _files(tmp_path / "s")
        fresh = _landed(spark, draw, n)
        landed = landed.unionByName(fresh)
        days = touched_days(fresh)
        # Copies in the new rows change what survives; other days' files are the very same.
        pipeline.restage(spark, export, landed, path, days)
        assert rows_of(pipeline.read_staged(spark, path)) == rows_of(_whole(export, landed))
        named = {f"event_day={d or '__HIVE_DEFAULT_PARTITION__'}" for d in days}
        after = _files(tmp_path / "s")
        untouched = {p: t for p, t in before.items() if p.parent.name not in named}
        assert untouched == {p: t for p, t in after.items() if p.parent.name not in named}
        assert {p.parent.name for p in after.keys() - before.keys()} <= named
    pipeline.restage(spark, export, landed, path, [])
    assert rows_of(pipeline.read_staged(spark, path)) == rows_of(_whole(export, landed))


def test_unfinished_staging_starts_from_all_days(spark, tmp_path):
    draw = random.Random(3)
    export, landed, path = _export(spark, draw, 30), _landed(spark, draw, 10), str(tmp_path / "s")
    pipeline.restage(spark, export, landed, path, [T0.date()])
    assert rows_of(pipeline.read_staged(spark, path)) == rows_of(_whole(export, landed))
    assert pipeline.is_staged(spark, path)


def test_days_are_partitions_and_reach_the_readers(spark, tmp_path):
    draw = random.Random(4)
    export, landed, path = _export(spark, draw, 80), _landed(spark, draw, 20), str(tmp_path / "s")
    pipeline.restage(spark, export, landed, path)
    first, last = T0.date() + timedelta(days=1), T0.date() + timedelta(days=2)
    some = pipeline.read_staged(spark, path, first, last)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_day" in plan and "event_day#" in plan
    want = pipeline.read_staged(spark, path).where(
        f"event_ts >= '{first}' AND event_ts < '{last + timedelta(days=1)}'"
    )
    assert some.count() > 0 and rows_of(some) == rows_of(want)
    assert len({f.split("event_day=")[1][:10] for f in some.inputFiles() if "event_day=" in f}) >= 2
    # The export is asked for the days by a number that its files have statistics of.
    export.write.parquet(str(tmp_path / "export"))
    stored = spark.read.schema(export.schema).parquet(str(tmp_path / "export"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = of_days(stored, [first, last])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(event_timestamp" in text and "LessThan(event_timestamp" in text


def test_refresh_publishes_marts_over_restaged_days(spark, tmp_path):
    draw = random.Random(5)
    export, landed, out = _export(spark, draw, 40), _landed(spark, draw, 10), str(tmp_path / "out")
    pipeline.refresh(spark, export, landed, out, None)
    buy = landing(
        spark,
        [
            {"event_ts": at(days=2, hours=5), "user_pseudo_id": "a", "event_name": "purchase",
             "ga_session_id": 1, "purchase_revenue": 7.0},
        ],
    )
    landed = landed.unionByName(buy)
    pipeline.refresh(spark, export, landed, out, touched_days(buy), tested=True)
    whole = pipeline.rebuild(spark, export, landed, str(tmp_path / "other"))
    now = pipeline.current_tables(spark, out)
    for name in ("staged", "touchpoints", "conversions", "marts"):
        assert rows_of(getattr(now, name)) == rows_of(getattr(whole, name))
    assert len(publish.commits(spark, out)) == 2
    assert pipeline.test_results(spark, out).where("test_name = 'strict'").first().failures == 0
