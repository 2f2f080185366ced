from datetime import date

import pytest
from build import at, landing, nested, param, rows_of

from touchtrail import Params
from touchtrail.__main__ import main
from touchtrail.operators import journey, quality
from touchtrail.plans import pipeline, publish
from touchtrail.session import scratch_dir
from touchtrail.sources import given_events as given
from touchtrail.sources.batch import read_nested_events
from touchtrail.sources.landing import read_landing
from touchtrail.streaming import ingest

SF = "/root/testdata/sf0.01"


def _write_shards(spark, root, days):
    for n, day in enumerate(days):
        rows = [
            {
                "event_date": day,
                "event_timestamp": 1_600_000_000_000_000 + n,
                "event_params": [param("ga_session_id", number=n)],
            }
        ]
        nested(spark, rows).write.parquet(f"{root}/events_{day}")


def test_day_shards(spark, tmp_path):
    days = ["20201130", "20201201", "20201203"]
    _write_shards(spark, str(tmp_path), days)
    everything = read_nested_events(spark, str(tmp_path))
    assert sorted(r.event_date for r in everything.collect()) == days
    some = read_nested_events(spark, str(tmp_path), date(2020, 12, 1), date(2020, 12, 4))
    assert sorted(r.event_date for r in some.collect()) == days[1:]
    assert len(some.inputFiles()) < len(everything.inputFiles())
    with pytest.raises(ValueError):
        read_nested_events(spark, str(tmp_path), date(2020, 12, 1))


def test_a_range_without_shards_has_no_events(spark, tmp_path):
    _write_shards(spark, str(tmp_path), ["20201130"])
    empty = read_nested_events(spark, str(tmp_path), date(2021, 1, 1), date(2021, 1, 31))
    assert empty.count() == 0 and empty.columns == read_nested_events(spark, str(tmp_path)).columns


def test_both_parts_of_the_given_events_overlap(spark):
    web = given.web_events(given.read_events(spark, SF))
    batch, landed = given.batch_part(web), given.landed_part(web)
    assert batch.count() and landed.count()
    assert batch.join(landed, ["user_pseudo_id", "event_name", "event_ts"]).count() > 0


def test_rebuild_twice_equals_the_lazy_plan_and_passes_its_tests(spark, tmp_path):
    web = given.web_events(given.read_events(spark, SF))
    landed = given.landed_part(web)
    batch = given.batch_part(web)
    lazy = pipeline.build(batch, landed)
    for _ in range(2):
        built = pipeline.rebuild(spark, given.as_nested(batch), landed, str(tmp_path / "out"))
    for name in ("staged", "touchpoints", "conversions", "marts"):
        assert rows_of(getattr(built, name)) == rows_of(getattr(lazy, name).select(*getattr(built, name).columns))
    for tables in (built, pipeline.read_build(spark, publish.current(spark, str(tmp_path / "out")))):
        results = pipeline.run_tests(tables, nested=given.as_nested(batch)).collect()
        assert len(results) == 20
        assert {r.failures for r in results} == {0}
    assert quality.strict_reconciles(built.conversions, built.marts).count() == 0


def test_counts_of_the_given_events(spark):
    web = given.web_events(given.read_events(spark, SF))
    t = pipeline.build(given.batch_part(web), given.landed_part(web))
    assert t.staged.count() == 10_000
    assert t.touchpoints.count() == 2_214
    assert t.conversions.count() == 1_981
    for days, pairs in ((30, 15_425), (7, 6_533), (1, 1_444)):
        assert journey.conversion_paths(t.conversions, t.touchpoints, days).count() == pairs


def test_copies_marked_as_redelivered_lose(spark):
    web = given.web_events(given.read_events(spark, SF))
    landed = given.landed_part(web)
    assert landed.where(landed.campaign == given.REDELIVERED).count() > 0
    staged = pipeline.build(given.batch_part(web), landed).staged
    assert staged.where(staged.campaign == given.REDELIVERED).count() == 0


def test_a_streamed_purchase_reaches_the_marts(spark):
    sessions = [("email", 1, 0), ("(none)", 2, 60)]
    rows = [
        {
            "event_ts": at(minutes=m),
            "event_name": name,
            "user_pseudo_id": "stream_user_1",
            "ga_session_id": session,
            "medium": medium,
            "purchase_revenue": 20.0 if name == "purchase" else None,
        }
        for medium, session, m in sessions
        for name in (("page_view",) if session == 1 else ("page_view", "purchase"))
    ]
    batch = given.batch_part(given.web_events(given.read_events(spark, SF)))
    for copies in (1, 2):
        t = pipeline.build(batch, landing(spark, rows * copies))
        own = t.marts.where("user_pseudo_id = 'stream_user_1'")
        assert rows_of(own, "attribution_model", "channel", "revenue") == [
            ("first_click", "Email", 20.0),
            ("last_click", "Direct", 20.0),
        ]


def test_parameters_change_the_conversion_and_the_lookback(spark):
    web = given.web_events(given.read_events(spark, SF))
    params = Params(conversion_event="signup", lookback_days=1)
    t = pipeline.build(given.batch_part(web), given.landed_part(web), params)
    signups = web.where("event_name = 'signup'").count()
    assert t.conversions.count() == signups
    assert t.marts.count() == 2 * signups


def test_scratch_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two
    if base:
        assert one.startswith(base)


def test_jobs_from_the_command_line(spark, tmp_path):
    web = given.web_events(given.read_events(spark, SF))
    given.as_nested(given.batch_part(web)).write.parquet(f"{tmp_path}/export/events_20240101")
    sent = given.landed_part(web).select(*ingest.SENT_EVENTS.fieldNames())
    sent.write.json(f"{tmp_path}/inbox")
    landing_dir, out = f"{tmp_path}/landing", f"{tmp_path}/out"
    assert main(["create-landing", "--landing", landing_dir]) == 0
    for checkpoint in ("a", "b"):
        arguments = ["--inbox", f"{tmp_path}/inbox", "--checkpoint", f"{tmp_path}/{checkpoint}"]
        assert main(["ingest", "--landing", landing_dir, *arguments]) == 0
    assert main(["rebuild", "--events", f"{tmp_path}/export", "--landing", landing_dir, "--out", out]) == 0
    assert read_landing(spark, landing_dir).count() == 2 * sent.count()
    tables = pipeline.current_tables(spark, out)
    pipeline.register_views(tables)
    totals = "SELECT count(*) AS n, round(sum(revenue), 2) AS revenue FROM "
    both = {spark.sql(totals + view).first() for view in ("first_click", "last_click", "conversions")}
    assert len(both) == 1


def test_path_tests_do_not_build_the_paths(spark):
    web = given.web_events(given.read_events(spark, SF))
    t = pipeline.build(given.batch_part(web), given.landed_part(web))
    paths = journey.conversion_paths(t.conversions, t.touchpoints)
    for column in pipeline.PATH_NOT_NULLS:
        text = quality.not_null(paths, column)._jdf.queryExecution().optimizedPlan().toString()
        join, filtered = text.index("Join Inner"), text.index("isnull(md5")
        assert join < filtered
