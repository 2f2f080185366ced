"""From sources to marts: as one lazy plan, or as a build that writes every table and is published."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchtrail.functions.columns import utc_day
from touchtrail.operators import credit, journey, quality, staging
from touchtrail.params import MODELS, Params
from touchtrail.plans import publish
from touchtrail.schemas import (
    CONVERSIONS,
    MARTS,
    NESTED_EVENTS,
    STAGED_EVENTS,
    STORED_STAGED_EVENTS,
    TOUCHPOINTS,
)
from touchtrail.sources import files
from touchtrail.sources.batch import of_days
from touchtrail.sources.landing import in_days, streamed_events

# Declared column tests: table, not-null columns, unique columns.
STAGED_TESTS = (["event_id", "event_ts", "user_pseudo_id", "event_name"], ["event_id"])
TOUCHPOINT_TESTS = (["touchpoint_id"], ["touchpoint_id"])
CONVERSION_TESTS = (["conversion_id"], ["conversion_id"])
PATH_NOT_NULLS = ["conversion_id", "touchpoint_id"]
MART_TESTS = (["conversion_id", "channel"], ["conversion_id"])

# The tables of a build by name: columns, and what they are partitioned by.
_STORED = {
    "staged": (STORED_STAGED_EVENTS, "event_day"),
    "touchpoints": (TOUCHPOINTS, None),
    "conversions": (CONVERSIONS, None),
    "marts": (MARTS, "attribution_model"),
}

# What is noted of the export's shards beside the staged events.
_EXPORT = "_export.json"


class FailedTests(RuntimeError):
    """A build was not published, because declared tests failed on it."""


@dataclass(frozen=True)
class Tables:
    """The tables of one build.

    ``observed`` has what was measured while the tables were written: per table and name a count or
    a total. It is empty for tables that were not written by this build.
    """

    staged: DataFrame
    touchpoints: DataFrame
    conversions: DataFrame
    marts: DataFrame
    observed: Mapping[str, Mapping[str, object]] = field(default_factory=dict)


def build(flat: DataFrame, landing: DataFrame, params: Params = Params()) -> Tables:
    """All tables as lazy plans.

    Staging is deterministic, so consumers agree although each one evaluates it anew with the
    columns it needs; the conversion filter reaches the scan through the dedupe.
    """
    staged = staging.stage_events(flat, streamed_events(landing))
    touchpoints = journey.touchpoints(staged)
    conversions = journey.conversions(staged, params.conversion_event)
    marts = credit.attribute(
        conversions, touchpoints, params.lookback_days, slice_seconds=params.slice_seconds
    )
    return Tables(staged, touchpoints, conversions, marts)


def rebuild(
    spark: SparkSession,
    nested: DataFrame,
    landing: DataFrame,
    out: str,
    params: Params = Params(),
    build_id: str | None = None,
    tested: bool = False,
    require_passing: bool = False,
) -> Tables:
    """Full refresh: a new build below ``out`` with every table, published at the end.

    Every table is written, and read back by the next step. Staging, which has the most consumers and
    the one large shuffle, runs once. A lost executor costs the running step only. Readers stay on
    the build before until this one is complete; if a step fails, they stay there.

    ``tested`` runs the declared tests and stores their results with the build; with
    ``require_passing`` a build that fails any is not published and FailedTests is raised. A
    ``build_id`` that is published already is not built again.
    """
    build_id = build_id or publish.new_build()
    if publish.is_committed(spark, out, build_id):
        return read_build(spark, publish.build_path(out, build_id))
    path = publish.build_path(out, build_id)
    flat = staging.flatten_events(nested)
    staged, seen = _write(
        staging.with_day(staging.stage_events(flat, streamed_events(landing))),
        path,
        "staged",
        _null_counts(STAGED_TESTS[0]),
    )
    return _published(
        spark, staged, nested, out, build_id, params, tested, require_passing, {"staged": seen}
    )


def refresh(
    spark: SparkSession,
    nested: DataFrame,
    landing: DataFrame,
    out: str,
    days: Sequence[date | None] | None,
    params: Params = Params(),
    build_id: str | None = None,
    tested: bool = False,
    require_passing: bool = False,
) -> Tables:
    """As ``rebuild``, with staging kept at ``<out>/staged`` and only its ``days`` written anew.

    ``days`` are the UTC days that events have arrived for since the last refresh, landed (see
    ``landing.touched_days``) or exported (see ``export_changes``), None for all. The first refresh writes all days anyway. Staging is
    as fresh as the sources, while the marts change with each published build.
    """
    build_id = build_id or publish.new_build()
    path = publish.build_path(out, build_id)
    if publish.is_committed(spark, out, build_id):
        return read_build(spark, path, staged_path(out))
    # Restaging is repeatable: a refresh that ended halfway starts here again.
    restage(spark, nested, landing, staged_path(out), days)
    staged = read_staged(spark, staged_path(out))
    return _published(spark, staged, nested, out, build_id, params, tested, require_passing, {})


def staged_path(out: str) -> str:
    return f"{out.rstrip('/')}/staged"


def restage(
    spark: SparkSession,
    nested: DataFrame,
    landing: DataFrame,
    path: str,
    days: Sequence[date | None] | None = None,
) -> None:
    """Write the staged events of some UTC days anew; the other days' files stay as they are.

    All copies of an event share its time and so its day, which is why the days can be staged one by
    one. Without ``days``, or where staging never was complete, all are written, for which ``landing``
    has to hold all rows.
    """
    done = f"{path}/_complete"
    if days is None or not is_staged(spark, path):
        days = None
        files.remove(spark, done)
        flat, streamed = staging.flatten_events(nested), streamed_events(landing)
    else:
        if not days:
            return
        flat = staging.flatten_events(of_days(nested, days))
        streamed = streamed_events(landing).where(in_days(F.col("event_ts"), days))
    staged = staging.with_day(staging.stage_events(flat, streamed))
    seen = Observation()
    rows = _by_day(staged.select(*STORED_STAGED_EVENTS.fieldNames())).observe(
        seen,
        F.collect_set("event_day").alias("days"),
        F.count_if(F.col("event_day").isNull()).alias("without"),
    )
    writer = rows.write.mode("overwrite")
    if days is not None:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("event_day").parquet(path)
    for day in days or ():
        # A day whose last event has gone from the sources is not overwritten by any row.
        if day is None and not seen.get["without"]:
            files.remove(spark, f"{path}/event_day=__HIVE_DEFAULT_PARTITION__")
        elif day is not None and day not in seen.get["days"]:
            files.remove(spark, f"{path}/event_day={day.isoformat()}")
    files.write_over(spark, done, "\n")


def is_staged(spark: SparkSession, path: str) -> bool:
    """Whether all days have been staged there, so that single days can be staged anew."""
    return files.exists(spark, f"{path}/_complete")


def export_changes(
    spark: SparkSession, nested: DataFrame, path: str
) -> tuple[list[date | None], dict[str, dict]]:
    """Days of the shards that are new, changed or gone since staging, and what to note of all shards.

    A shard is a folder of the export. It is known by the names of its files, which no writer uses
    twice, and what was noted of it holds the days of its events, so those of a shard that
    was exported again are found although its old files are gone. Only new files are read.
    """
    text = files.read_text(spark, f"{path}/{_EXPORT}") if is_staged(spark, path) else None
    noted = json.loads(text) if text else {}
    now: dict[str, list[str]] = {}
    for file in nested.inputFiles():
        folder, name = _shard_of(file)
        now.setdefault(folder, []).append(name)
    digests = {
        folder: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()
        for folder, names in now.items()
    }
    fresh = [f for f, digest in digests.items() if noted.get(f, {}).get("files") != digest]
    days: dict[str, dict[str | None, None]] = {}
    if fresh:
        # At most one row per file and day that its events are on.
        for row in _days_by_file(spark, fresh).collect():
            folder, _ = _shard_of(row.path)
            if folder not in digests:
                raise RuntimeError(f"rows of a shard that was not listed: {folder}")
            days.setdefault(folder, {})[row.day and row.day.isoformat()] = None
    facts = {
        folder: {"files": digest, "days": list(days.get(folder, ()))}
        if folder in fresh
        else noted[folder]
        for folder, digest in digests.items()
    }
    changed = [facts[f] for f in fresh] + [
        noted[f] for f in noted if f in fresh or f not in digests
    ]
    found = {day for fact in changed for day in fact["days"]}
    return sorted(
        (day and date.fromisoformat(day) for day in found), key=lambda d: (d is not None, d)
    ), facts


def _shard_of(file: str) -> tuple[str, str]:
    """Folder and name of a file of the export."""
    # A local path is file:///x in the list of files and file:/x in a row's own data.
    folder, _, name = re.sub("^file:/+", "file:/", file).rpartition("/")
    return folder, name


def _days_by_file(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """(path, day), once each; nothing is done to the path of every event, which takes most of the time."""
    rows = spark.read.schema(NESTED_EVENTS).parquet(*sorted(folders))
    day = utc_day(F.timestamp_micros("event_timestamp"))
    return rows.select(F.col("_metadata.file_path").alias("path"), day.alias("day")).distinct()


def note_export(spark: SparkSession, path: str, facts: dict[str, dict]) -> None:
    """Note which shards are staged; to be called once they are."""
    files.write_over(spark, f"{path}/{_EXPORT}", json.dumps(facts, sort_keys=True))


def read_staged(
    spark: SparkSession, path: str, first_day: date | None = None, last_day: date | None = None
) -> DataFrame:
    """Stored staged events, all or those of a closed range of UTC days; other days are not read."""
    stored = spark.read.schema(STORED_STAGED_EVENTS).parquet(path)
    for day, is_first in ((first_day, True), (last_day, False)):
        if day is not None:
            at = F.col("event_day")
            stored = stored.where(at >= F.lit(day) if is_first else at <= F.lit(day))
    return stored.select(*STAGED_EVENTS.fieldNames())


def read_build(spark: SparkSession, path: str, staged_at: str | None = None) -> Tables:
    """The tables of the build in a folder."""
    tables = {
        name: spark.read.schema(schema).parquet(f"{path}/{name}").select(*schema.fieldNames())
        for name, (schema, _) in _STORED.items()
        if name != "staged"
    }
    return Tables(read_staged(spark, staged_at or f"{path}/staged"), **tables)


def current_tables(spark: SparkSession, out: str) -> Tables:
    """The tables of the published build. What this returns does not change with the next build."""
    path = publish.current(spark, out)
    own = f"{path}/staged"
    return read_build(spark, path, own if files.exists(spark, own) else staged_path(out))


def test_results(spark: SparkSession, out: str) -> DataFrame:
    """The stored test results of the published build."""
    return spark.read.parquet(f"{publish.current(spark, out)}/test_results")


def _published(
    spark: SparkSession,
    staged: DataFrame,
    nested: DataFrame,
    out: str,
    build_id: str,
    params: Params,
    tested: bool,
    require_passing: bool,
    observed: dict[str, Mapping[str, object]],
) -> Tables:
    """Everything behind staging, the tests, and the switch to this build."""
    path = publish.build_path(out, build_id)
    touchpoints, observed["touchpoints"] = _write(
        journey.touchpoints(staged), path, "touchpoints", _null_counts(TOUCHPOINT_TESTS[0])
    )
    revenue = F.col("revenue")
    conversions, observed["conversions"] = _write(
        journey.conversions(staged, params.conversion_event),
        path,
        "conversions",
        {**_null_counts(CONVERSION_TESTS[0]), "revenue": _exact_total(revenue)},
    )
    per_model: dict[str, Column] = {}
    for model in MODELS:
        of_model = F.col("attribution_model") == model
        per_model |= {
            f"{model}.{column}": F.count_if(of_model & F.col(column).isNull())
            for column in MART_TESTS[0]
        }
        per_model[f"{model}.revenue"] = _exact_total(F.when(of_model, revenue))
    marts, observed["marts"] = _write(
        credit.attribute(
            conversions, touchpoints, params.lookback_days, slice_seconds=params.slice_seconds
        ),
        path,
        "marts",
        per_model,
    )
    tables = Tables(staged, touchpoints, conversions, marts, observed)
    if tested or require_passing:
        results = run_tests(tables, params, nested)
        results.write.mode("overwrite").parquet(f"{path}/test_results")
        if require_passing:
            failed = spark.read.schema(results.schema).parquet(f"{path}/test_results").where("failures > 0")
            names = [f"{r.table_name}.{r.column_name} {r.test_name}" for r in failed.collect()]
            if names:
                raise FailedTests("not published: " + ", ".join(sorted(names)))
    publish.commit(spark, out, build_id)
    return tables


def _null_counts(columns: Sequence[str]) -> dict[str, Column]:
    return {c: F.count_if(F.col(c).isNull()) for c in columns}


def _exact_total(revenue: Column) -> Column:
    # In decimals, so that the order of the rows does not matter; no total with NaN or infinity.
    return F.sum(revenue.try_cast("decimal(38,6)"))


def _write(
    table: DataFrame, path: str, name: str, measures: Mapping[str, Column]
) -> tuple[DataFrame, dict[str, object]]:
    """Write a table of the build; it read back, and the measures taken on the way.

    The measures sit right above the write, behind the last shuffle, where a task that runs again
    is counted once.
    """
    spark = table.sparkSession
    schema, partition = _STORED[name]
    rows = table.select(*schema.fieldNames())
    if partition == "event_day":
        rows = _by_day(rows)
    seen = Observation()
    writer = rows.observe(seen, *(m.alias(n) for n, m in measures.items())).write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(partition)
    writer.parquet(f"{path}/{name}")
    stored = spark.read.schema(schema).parquet(f"{path}/{name}")
    if name == "staged":
        stored = stored.select(*STAGED_EVENTS.fieldNames())
    return stored, seen.get


def _by_day(staged: DataFrame) -> DataFrame:
    """Rows of a day together, in as many parts as their size asks for."""
    return staged.hint("rebalance", "event_day")


def run_tests(
    tables: Tables, params: Params = Params(), nested: DataFrame | None = None
) -> DataFrame:
    """One row per declared test with its number of failures; 0 is a pass.

    What was counted while a table was written is not counted again. ``nested`` adds the test for
    repeated parameter keys.
    """
    seen = tables.observed
    results = []
    for name, table, (not_nulls, uniques) in (
        ("staged", tables.staged, STAGED_TESTS),
        ("touchpoints", tables.touchpoints, TOUCHPOINT_TESTS),
        ("conversions", tables.conversions, CONVERSION_TESTS),
    ):
        label = "staged_events" if name == "staged" else name
        if name in seen:
            results += [_known(tables, label, c, "not_null", seen[name][c]) for c in not_nulls]
            not_nulls = []
        results.append(quality.column_tests(table, label, not_nulls, uniques))
    by_model = ("attribution_model", MODELS)
    if "marts" in seen:
        results += [
            _known(tables, model, c, "not_null", seen["marts"][f"{model}.{c}"])
            for model in MODELS
            for c in MART_TESTS[0]
        ]
    else:
        results += [quality.not_null_by(tables.marts, *by_model, MART_TESTS[0])]
    results += [quality.unique_by(tables.marts, *by_model, c) for c in MART_TESTS[1]]
    results += _path_tests(tables, params)
    results.append(_totals_test(tables))
    # Totals also agree on empty marts; this one fails then.
    results.append(
        quality.violation_count(
            quality.strict_reconciles(tables.conversions, tables.marts), "marts", "revenue", "strict"
        )
    )
    if nested is not None:
        results.append(
            quality.violation_count(
                quality.duplicate_params(nested), "nested_events", "event_params", "duplicate_keys"
            )
        )
    return reduce(DataFrame.unionByName, results)


def _known(tables: Tables, table: str, column: str, test: str, failures: object) -> DataFrame:
    return quality.known_count(tables.marts.sparkSession, table, column, test, int(failures))


def _path_tests(tables: Tables, params: Params) -> list[DataFrame]:
    """Not-null tests of the paths, which take their ids from conversions and touchpoints.

    Where the table that an id comes from has none missing, no path has. Else one filter per test:
    it moves below the join, so the paths are not built to be counted.
    """
    out = []
    for column, source in zip(PATH_NOT_NULLS, ("conversions", "touchpoints"), strict=True):
        if tables.observed.get(source, {}).get(column) == 0:
            out.append(_known(tables, "conversion_paths", column, "not_null", 0))
            continue
        paths = journey.conversion_paths(
            tables.conversions, tables.touchpoints, params.lookback_days
        )
        missing = quality.not_null(paths, column)
        out.append(quality.violation_count(missing, "conversion_paths", column, "not_null"))
    return out


def _totals_test(tables: Tables) -> DataFrame:
    """Whether the totals agree to the cent: exact ones where they were taken on the way."""
    seen = tables.observed
    if "conversions" not in seen or "marts" not in seen:
        differing = quality.revenue_reconciles(tables.conversions, tables.marts)
        return quality.violation_count(differing, "marts", "revenue", "reconciles")
    totals = [seen["conversions"]["revenue"], *(seen["marts"][f"{m}.revenue"] for m in MODELS)]
    cents = [None if t is None else round(t, 2) for t in totals]
    differs = any(c is not None and cents[0] is not None and c != cents[0] for c in cents[1:])
    return _known(tables, "marts", "revenue", "reconciles", differs)


def register_views(tables: Tables, prefix: str = "") -> None:
    """Temporary views over a build, so that reports can be written in SQL as well."""
    tables.staged.createOrReplaceTempView(f"{prefix}staged_events")
    tables.touchpoints.createOrReplaceTempView(f"{prefix}touchpoints")
    tables.conversions.createOrReplaceTempView(f"{prefix}conversions")
    for model in MODELS:
        mart = tables.marts.where(tables.marts.attribution_model == model)
        mart.createOrReplaceTempView(f"{prefix}{model}")
