"""Data tests. A test is a DataFrame of violations: no rows means it passed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchtrail.functions.columns import money
from touchtrail.params import FIRST_CLICK, LAST_CLICK

USED_PARAMS = ("ga_session_id", "source", "medium", "campaign")
_TOTALS = ("conversions", FIRST_CLICK, LAST_CLICK)


def not_null(table: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return table.where(F.col(column).isNull())


def unique(table: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    return (
        table.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("occurrences"))
        .where("occurrences > 1")
    )


def column_tests(
    table: DataFrame, name: str, not_nulls: Sequence[str], uniques: Sequence[str]
) -> DataFrame:
    """Failures per declared column test. All not-null tests share one pass over the table."""
    results: list[DataFrame] = []
    if not_nulls:
        counts = table.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in not_nulls))
        rows = F.array(*(_verdict(name, c, "not_null", F.col(c)) for c in not_nulls))
        results.append(counts.select(F.inline(rows)))
    results += [violation_count(unique(table, c), name, c, "unique") for c in uniques]
    return reduce(DataFrame.unionByName, results)


def violation_count(violations: DataFrame, table: str, column: str, test: str) -> DataFrame:
    """The result row of one test."""
    failures = violations.agg(F.count("*").alias("failures"))
    return failures.select(_verdict(table, column, test, F.col("failures")).alias("v")).select("v.*")


def known_count(
    spark: SparkSession, table: str, column: str, test: str, failures: int
) -> DataFrame:
    """The result row of a test whose failures have been counted already."""
    row = spark.range(1).select(F.lit(failures).cast("bigint").alias("n"))
    return row.select(_verdict(table, column, test, F.col("n")).alias("v")).select("v.*")


def not_null_by(
    table: DataFrame, group: str, values: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Failures of the not-null tests for each value of a column, in one pass over the table."""
    cases = [(v, c) for v in values for c in columns]
    counts = table.agg(
        *(
            F.count_if((F.col(group) == v) & F.col(c).isNull()).alias(f"n{n}")
            for n, (v, c) in enumerate(cases)
        )
    )
    rows = (_verdict(v, c, "not_null", F.col(f"n{n}")) for n, (v, c) in enumerate(cases))
    return counts.select(F.inline(F.array(*rows)))


def unique_by(table: DataFrame, group: str, values: Sequence[str], column: str) -> DataFrame:
    """Failures of the unique test for each value of a column, in one pass over the table."""
    repeated = (
        table.where(F.col(column).isNotNull())
        .groupBy(group, column)
        .agg(F.count("*").alias("occurrences"))
        .where("occurrences > 1")
    )
    counts = repeated.agg(
        *(F.count_if(F.col(group) == v).alias(f"n{n}") for n, v in enumerate(values))
    )
    rows = (_verdict(v, column, "unique", F.col(f"n{n}")) for n, v in enumerate(values))
    return counts.select(F.inline(F.array(*rows)))


def _verdict(table: str, column: str, test: str, failures: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(test).alias("test_name"),
        failures.alias("failures"),
    )


def reconciliation(conversions: DataFrame, marts: DataFrame) -> DataFrame:
    """One row: revenue of the conversions and of each mart to the cent, and if they agree.

    A missing total compares as unknown, which counts as agreement: empty marts pass. See
    ``strict_reconciles`` for the test that has no such gap.
    """
    stacked = _labelled(conversions, marts, "revenue")
    totals = stacked.agg(
        *(money(F.when(F.col("label") == t, F.col("revenue"))).alias(t) for t in _TOTALS)
    )
    differs = reduce(Column.__or__, (_differs(F.col(t)) for t in _TOTALS[1:]))
    return totals.withColumn("reconciles", ~F.coalesce(differs, F.lit(False)))


def revenue_reconciles(conversions: DataFrame, marts: DataFrame) -> DataFrame:
    """The totals if one mart's differs from that of the conversions."""
    return reconciliation(conversions, marts).where("NOT reconciles").drop("reconciles")


def _differs(total: Column) -> Column:
    # NaN differs from everything, itself included; Spark alone would call two NaNs equal.
    base = F.col("conversions")
    both = total.isNotNull() & base.isNotNull()
    return (total != base) | (both & (F.isnan(total) | F.isnan(base)))


def strict_reconciles(conversions: DataFrame, marts: DataFrame) -> DataFrame:
    """Conversions that do not have exactly one row of equal revenue in each mart.

    Catches what equal totals hide: empty marts, lost zero-revenue rows, errors that cancel. A
    revenue that is not finite is a violation of its own.
    """
    key = ("conversion_id", "user_pseudo_id", "conversion_ts")
    exact = F.col("revenue").cast("decimal(38,6)")
    per_key = _labelled(conversions, marts, *key, "revenue").groupBy(*key).agg(
        *(F.count_if(F.col("label") == t).alias(f"{t}_rows") for t in _TOTALS),
        *(F.sum(F.when(F.col("label") == t, exact)).alias(f"{t}_revenue") for t in _TOTALS),
        F.count_if(F.isnan("revenue") | (F.abs("revenue") == float("inf"))).alias("not_finite"),
    )
    sound = [F.col("conversions_rows") == 1, F.col("not_finite") == 0]
    for t in _TOTALS[1:]:
        sound += [
            F.col(f"{t}_rows") == 1,
            F.col(f"{t}_revenue").eqNullSafe(F.col("conversions_revenue")),
        ]
    return per_key.where(~reduce(Column.__and__, sound))


def _labelled(conversions: DataFrame, marts: DataFrame, *columns: str) -> DataFrame:
    return conversions.select(*columns, F.lit("conversions").alias("label")).unionByName(
        marts.select(*columns, F.col("attribution_model").alias("label"))
    )


def duplicate_params(nested: DataFrame, keys: Sequence[str] = USED_PARAMS) -> DataFrame:
    """Nested events that carry one of the used parameter keys more than once."""
    repeated = (
        F.size(F.array_remove(F.col("event_params.key"), k)) < F.size("event_params") - 1
        for k in keys
    )
    return nested.where(reduce(Column.__or__, repeated))
