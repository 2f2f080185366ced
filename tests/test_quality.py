import pytest
from build import at, conversions, marts, nested, param, rows_of, staged

from touchtrail.operators import quality

BOTH = ("first_click", "last_click")


def _pair(spark, convs, lost=(), changes=None):
    """Conversions and both marts; ``lost`` and ``changes`` break the last-click mart."""
    rows = [
        {"conversion_id": f"c{i}", "conversion_ts": at(hours=i), "revenue": r}
        for i, r in enumerate(convs)
    ]
    credited = [{**row, "attribution_model": "first_click"} for row in rows]
    for i, row in enumerate(rows):
        if i not in lost:
            revenue = (changes or {}).get(i, row["revenue"])
            credited.append({**row, "revenue": revenue, "attribution_model": "last_click"})
    return conversions(spark, rows), marts(spark, credited)


@pytest.mark.parametrize(
    ("convs", "lost", "changes", "faithful", "strict"),
    [
        ([1.1, 2.2, 0.0], (), None, 0, 0),
        ([1.1, 2.2, 0.0], (1,), None, 1, 1),
        ([1.1, 2.2, 0.0], (2,), None, 0, 1),
        ([1.0, 2.0], (), {0: 2.0, 1: 1.0}, 0, 2),
        ([1.0, float("nan")], (), None, 1, None),
    ],
)
def test_reconciliation(spark, convs, lost, changes, faithful, strict):
    tables = _pair(spark, convs, lost, changes)
    assert quality.revenue_reconciles(*tables).count() == faithful
    assert quality.reconciliation(*tables).first()["reconciles"] == (faithful == 0)
    if strict is not None:
        assert quality.strict_reconciles(*tables).count() == strict


def test_empty_marts_pass_the_totals_but_not_the_strict_test(spark):
    convs, credited = _pair(spark, [1.0])
    assert quality.revenue_reconciles(convs, credited.limit(0)).count() == 0
    assert quality.strict_reconciles(convs, credited.limit(0)).count() == 1


def test_column_tests(spark):
    table = staged(
        spark,
        [{"event_id": "a"}, {"event_id": "a"}, {"event_id": "b"}, {"event_id": None}] * 2
        + [{"event_id": None, "event_name": None}, {"event_id": "c"}],
    )
    assert quality.not_null(table, "event_id").count() == 3
    assert rows_of(quality.unique(table, "event_id")) == [("a", 4), ("b", 2)]
    assert rows_of(quality.column_tests(table, "t", ["event_id", "event_name"], ["event_id"])) == [
        ("t", "event_id", "not_null", 3),
        ("t", "event_id", "unique", 2),
        ("t", "event_name", "not_null", 1),
    ]


def test_duplicate_params(spark):
    table = nested(
        spark,
        [
            {"event_name": "ok", "event_params": [param("source", "a"), param("x"), param("x")]},
            {"event_name": "two", "event_params": [param("medium", "a"), param("medium", "b")]},
            {"event_name": "empty", "event_params": []},
            {"event_name": "null", "event_params": None},
        ],
    )
    assert rows_of(quality.duplicate_params(table), "event_name") == [("two",)]
