"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from touchtrail.operators import credit, journey, reports, staging
from touchtrail.plans import pipeline
from touchtrail.plans.catalog import QUERIES
from touchtrail.sources import given_events as given
from touchtrail.sources.batch import read_nested_events

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    text = plan(df)
    return text[: text.index("Initial Plan")]


@pytest.fixture(scope="module")
def tables(spark):
    web = given.web_events(given.read_events(spark, SF))
    return pipeline.build(given.batch_part(web), given.landed_part(web))


# Queries whose plan is more than the reading of a table that they wrote.
LAZY = sorted(
    set(QUERIES)
    - {
        "ingest_stream", "ingest_staged", "ingest_load_times", "ingest_rejects", "landing_compacted",
        "live_events_landed", "freshness_landed", "row_count_trend_landed", "stream_first_deliveries",
        "stream_late_rows", "stream_rebuild", "restaged_days", "rebuild", "rebuild_tests",
        "revenue_reconciles", "strict_reconciles",
    }
)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python_in_the_plans(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "ArrowEval"):
        assert bad not in text


def test_copies_are_dropped_before_the_shuffle(tables):
    text = plan(tables.staged)
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_conversion_filter_reaches_the_scan(spark, tables):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(tables.conversions)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(re.findall(r"PushedFilters: [^\n]*EqualTo\(event_type,purchase\)", text)) == 2


def test_nested_scan_reads_used_fields_only(spark, tmp_path):
    web = given.web_events(given.read_events(spark, SF))
    given.as_nested(web).withColumn("unused", F.lit("x")).write.parquet(f"{tmp_path}/events_20240101")
    flat = staging.flatten_events(read_nested_events(spark, str(tmp_path)))
    schema = re.search(r"ReadSchema: (\S+)", plan(flat.select("event_ts", "campaign"))).group(1)
    assert "event_params" in schema and "string_value" in schema
    assert not re.search("int_value|traffic_source|ecommerce|user_pseudo_id|unused", schema)


def test_days_of_an_export_do_nothing_to_the_path_of_each_event(spark, tmp_path):
    web = given.web_events(given.read_events(spark, SF))
    shard = str(tmp_path / "events_all")
    given.as_nested(given.batch_part(web)).repartition(3).write.parquet(shard)
    found = pipeline._days_by_file(spark, [shard])
    assert "regexp_replace" not in plan(found)
    rows = found.collect()
    assert len({r.path for r in rows}) == 3 and len({r.day for r in rows}) == 23
    _, facts = pipeline.export_changes(spark, spark.read.parquet(shard), str(tmp_path / "staged"))
    (fact,) = facts.values()
    assert sorted(fact["days"]) == [f"2024-01-{day:02d}" for day in range(1, 24)]


def test_top_k(tables, spark):
    web = given.web_events(given.read_events(spark, SF))
    assert "TakeOrderedAndProject" in plan(reports.live_events(given.as_landed(web)))


def test_credit_shuffles_the_touches_once_per_step(spark, tables, tmp_path):
    tables.touchpoints.write.parquet(f"{tmp_path}/t")
    tables.conversions.write.parquet(f"{tmp_path}/c")
    t, c = (spark.read.parquet(f"{tmp_path}/{n}") for n in "tc")
    text = final_plan(credit.attribute(c, t))
    assert text.count("ReusedExchange") == 1
    # By user and instant, by user and slice, by user; the carried edges go back by join.
    assert text.count("Exchange hashpartitioning") - text.count("ReusedExchange") <= 4


def test_one_model_has_half_the_windows_and_each_table_is_read_once(tables):
    both, first, last = (
        final_plan(credit.attribute(tables.conversions, tables.touchpoints, models=models))
        for models in (["first_click", "last_click"], ["first_click"], ["last_click"])
    )
    of_staging = plan(tables.conversions).count("Window [") + plan(tables.touchpoints).count("Window [")
    assert both.count("Window [") == of_staging + 4
    assert first.count("Window [") == last.count("Window [") == of_staging + 2
    # Conversions and touches each read the export and the landing table.
    assert [text.count("FileScan") for text in (both, first, last)] == [4, 4, 4]


def test_day_range_opens_its_shards_only(spark):
    files = [len(QUERIES[n](spark, SF).inputFiles()) for n in ("nested_shards", "nested_shards_range")]
    days = given.web_events(given.read_events(spark, SF)).select("event_date").distinct().count()
    assert files[0] >= days > 10 and files[1] < files[0]


def test_paths_join_on_user_and_slice(tables):
    text = plan(journey.conversion_paths(tables.conversions, tables.touchpoints))
    assert re.search(
        r"Join \[user_pseudo_id#\d+, slice#\d+L, touch_part#\d+L, probe_part#\d+L\]", text
    )
