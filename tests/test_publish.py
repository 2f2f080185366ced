"""Published builds: one switch, failing steps, tests before the switch, replays."""

import json
from datetime import timedelta

import pytest
from build import at, landing, nested, rows_of
from pyspark.sql import functions as F

from touchtrail import Params
from touchtrail.operators import credit, journey, quality
from touchtrail.plans import pipeline, publish
from touchtrail.sources import files
from touchtrail.sources import given_events as given

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sources(spark):
    web = given.web_events(given.read_events(spark, SF))
    return given.as_nested(given.batch_part(web)), given.landed_part(web)


def _file_scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_a_failing_step_leaves_readers_on_the_whole_old_build(spark, sources, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    with pytest.raises(publish.NoBuildError):
        pipeline.current_tables(spark, out)
    pipeline.rebuild(spark, *sources, out)
    before = publish.current(spark, out)
    names = ("staged", "touchpoints", "conversions", "marts")
    old = {name: rows_of(getattr(pipeline.current_tables(spark, out), name)) for name in names}

    more = landing(spark, [{"event_ts": at(), "event_name": "purchase", "user_pseudo_id": "new"}])
    changed = sources[1].unionByName(more)
    for step in (journey, "touchpoints"), (journey, "conversions"), (credit, "attribute"):
        with monkeypatch.context() as broken:

            def fail(*args, _real=getattr(*step), **kwargs):
                table = _real(*args, **kwargs)
                return table.withColumn(table.columns[0], F.raise_error(F.lit("lost")).cast("string"))

            broken.setattr(*step, fail)
            with pytest.raises(Exception, match="lost"):
                pipeline.rebuild(spark, sources[0], changed, out)
        now = pipeline.current_tables(spark, out)
        assert publish.current(spark, out) == before
        assert {name: rows_of(getattr(now, name)) for name in names} == old

    held = pipeline.current_tables(spark, out)
    pipeline.rebuild(spark, sources[0], changed, out)
    assert pipeline.current_tables(spark, out).conversions.count() == len(old["conversions"]) + 1
    # Who opened the old build goes on reading it.
    assert rows_of(held.marts) == old["marts"]


def test_a_commit_is_one_new_file(spark, tmp_path):
    out = str(tmp_path)
    assert publish.commits(spark, out) == []
    assert publish.commit(spark, out, "a") == 1
    assert publish.commit(spark, out, "b") == 2
    assert publish.commit(spark, out, "a") == 1, "a replayed commit changes nothing"
    assert publish.current(spark, out).endswith("/builds/b")
    # A writer that ended while it wrote: neither does it count nor does it block the next one.
    assert files.write_new(spark, f"{out}/_commits/{3:020d}", "c")
    assert publish.current(spark, out).endswith("/builds/b")
    assert publish.commit(spark, out, "d") == 4
    # The number is taken by one writer only.
    assert not files.write_new(spark, f"{out}/_commits/{4:020d}", "e\n")
    assert publish.roll_back(spark, out).endswith("/builds/b")
    assert publish.current(spark, out).endswith("/builds/b")


def test_expired_builds_go_and_running_ones_stay(spark, tmp_path):
    out = str(tmp_path)
    for build in "abcd":
        files.write_over(spark, f"{publish.build_path(out, build)}/x", "x")
        publish.commit(spark, out, build)
    files.write_over(spark, f"{publish.build_path(out, 'running')}/x", "x")
    assert sorted(publish.expire(spark, out, keep=2)) == ["a", "b"]
    assert files.names(spark, f"{out}/builds") == ["c", "d", "running"]
    assert publish.current(spark, out).endswith("/builds/d")
    assert publish.expire(spark, out, keep=1, abandoned_after=timedelta(0)) == ["c", "running"]
    with pytest.raises(ValueError):
        publish.expire(spark, out, keep=0)


def test_builds_that_fail_their_tests_are_not_published(spark, sources, tmp_path):
    out = str(tmp_path / "out")
    pipeline.rebuild(spark, *sources, out, require_passing=True)
    before = publish.current(spark, out)
    # A purchase without a user has no conversion id.
    bad = landing(spark, [{"event_ts": at(), "event_name": "purchase", "user_pseudo_id": None}])
    with pytest.raises(pipeline.FailedTests, match="conversions.conversion_id not_null"):
        pipeline.rebuild(spark, sources[0], sources[1].unionByName(bad), out, require_passing=True)
    assert publish.current(spark, out) == before
    # Published all the same if that is not asked for; the results say what fails.
    pipeline.rebuild(spark, sources[0], sources[1].unionByName(bad), out, tested=True)
    failed = pipeline.test_results(spark, out).where("failures > 0")
    assert rows_of(failed, "table_name", "column_name", "failures") == sorted(
        [
            ("conversions", "conversion_id", 1),
            ("first_click", "conversion_id", 1),
            ("last_click", "conversion_id", 1),
            ("staged_events", "event_id", 1),
            ("staged_events", "user_pseudo_id", 1),
        ]
    )


def test_a_published_build_id_is_not_built_again(spark, sources, tmp_path):
    out = str(tmp_path / "out")
    first = pipeline.rebuild(spark, *sources, out, build_id="q-1")
    nothing = sources[1].where("false")
    again = pipeline.rebuild(spark, sources[0], nothing, out, build_id="q-1")
    assert rows_of(again.marts) == rows_of(first.marts)
    assert [build for _, build in publish.commits(spark, out)] == ["q-1"]


def test_observed_counts_equal_counting_and_spare_scans(spark, sources, tmp_path):
    out = str(tmp_path / "out")
    odd = landing(
        spark,
        [
            {"event_ts": at(), "event_name": "purchase", "user_pseudo_id": None},
            {"event_ts": None, "event_name": "purchase", "user_pseudo_id": "u"},
            {"event_ts": at(), "event_name": None, "user_pseudo_id": "u", "ga_session_id": 1},
            {"event_ts": at(), "user_pseudo_id": None, "ga_session_id": 1},
            {"event_ts": at(hours=1), "event_name": "purchase", "purchase_revenue": float("nan")},
            {"event_ts": at(hours=2), "event_name": "purchase", "purchase_revenue": 0.1},
        ],
    )
    built = pipeline.rebuild(spark, sources[0], sources[1].unionByName(odd), out)
    plain = pipeline.read_build(spark, publish.current(spark, out))
    results = pipeline.run_tests(built, nested=sources[0])
    counted = pipeline.run_tests(plain, nested=sources[0])
    kept = "test_name <> 'reconciles'"
    assert rows_of(results.where(kept)) == rows_of(counted.where(kept))
    assert results.where("failures > 0").count() >= 5
    # Float totals with NaN differ from themselves; exact ones leave it to the strict test.
    assert results.where("test_name = 'strict' AND failures > 0").count() == 1
    of_sound = pipeline.rebuild(spark, *sources, out)
    spared = _file_scans(pipeline.run_tests(of_sound, nested=sources[0]))
    assert spared <= 8 < _file_scans(pipeline.run_tests(plain, nested=sources[0]))


def test_exact_totals_find_a_lost_cent(spark, sources, tmp_path):
    built = pipeline.rebuild(spark, *sources, str(tmp_path / "out"))
    seen = {k: dict(v) for k, v in built.observed.items()}
    seen["marts"]["last_click.revenue"] -= type(seen["marts"]["last_click.revenue"])("0.01")
    wrong = pipeline.Tables(built.staged, built.touchpoints, built.conversions, built.marts, seen)
    totals = pipeline.run_tests(wrong).where("test_name = 'reconciles'").first()
    assert totals.failures == 1


def test_repeated_parameter_keys_fail_the_build(spark, tmp_path):
    twice = nested(spark, [{"event_params": [("source", ("a", None)), ("source", ("b", None))]}])
    nothing = landing(spark, [])
    with pytest.raises(pipeline.FailedTests, match="duplicate_keys"):
        pipeline.rebuild(spark, twice, nothing, str(tmp_path / "out"), Params(), require_passing=True)
    assert quality.duplicate_params(twice).count() == 1
    assert json.loads(json.dumps(publish.commits(spark, str(tmp_path / "out")))) == []
