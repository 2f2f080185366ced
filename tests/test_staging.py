import random

import pytest
from build import at, flat, naive, nested, ordered, param, rows_of
from pyspark.sql import functions as F

from touchtrail.operators.staging import flatten_events, stage_events


def test_params_and_fallbacks(spark):
    src = ("ts_source", "ts_medium")
    df = nested(
        spark,
        [
            {"event_name": "absent", "event_params": [param("x", "1")], "traffic_source": src},
            {"event_name": "empty", "event_params": [], "traffic_source": src},
            {"event_name": "null", "event_params": None, "traffic_source": src},
            {
                "event_name": "twice",
                "event_params": [param("source", "a"), param("source", "b")],
                "traffic_source": src,
            },
            {
                "event_name": "null value",
                "event_params": [param("source"), param("medium"), param("ga_session_id")],
                "traffic_source": src,
            },
            {"event_name": "nothing", "event_params": [param(None, "x")], "traffic_source": None},
            {
                "event_name": "full",
                "event_params": [
                    param("ga_session_id", number=7),
                    param("source", "s"),
                    param("medium", "m"),
                    param("campaign", "c"),
                ],
                "traffic_source": src,
                "ecommerce": (9.5,),
            },
        ],
    )
    got = rows_of(
        flatten_events(df),
        "event_name", "ga_session_id", "source", "medium", "campaign", "purchase_revenue",
    )
    assert got == ordered(
        [
            ("absent", None, "ts_source", "ts_medium", None, None),
            ("empty", None, "ts_source", "ts_medium", None, None),
            ("null", None, "ts_source", "ts_medium", None, None),
            ("twice", None, "a", "ts_medium", None, None),
            ("null value", None, "ts_source", "ts_medium", None, None),
            ("nothing", None, None, None, None, None),
            ("full", 7, "s", "m", "c", 9.5),
        ]
    )


def test_malformed_day_raises(spark):
    with pytest.raises(Exception, match="CANNOT_PARSE|DateTimeException|could not be parsed"):
        flatten_events(nested(spark, [{"event_date": "2020-1101"}])).collect()


def test_batch_copy_wins_then_larger_revenue(spark):
    batch = flat(
        spark,
        [
            {"event_ts": at(), "event_name": "purchase", "purchase_revenue": 1.0, "source": "b"},
            {"event_ts": at(hours=1), "event_name": "purchase", "purchase_revenue": None},
            {"event_ts": at(hours=1), "event_name": "purchase", "purchase_revenue": 5.0},
            {"event_ts": at(hours=1), "event_name": "purchase", "purchase_revenue": 7.0},
        ],
    )
    streamed = flat(
        spark,
        [
            {"event_ts": at(), "event_name": "purchase", "purchase_revenue": 99.0, "source": "a"},
            {"event_ts": at(hours=2), "ga_session_id": 2, "source": "x"},
            {"event_ts": at(hours=2), "ga_session_id": 1, "source": "y"},
            {"event_ts": at(hours=2), "ga_session_id": 1, "source": None},
        ],
    )
    got = rows_of(
        stage_events(batch, streamed), "event_ts", "purchase_revenue", "ga_session_id", "source"
    )
    assert got == [
        (naive(at()), 1.0, None, "b"),
        (naive(at(hours=1)), 7.0, None, None),
        (naive(at(hours=2)), None, 1, "y"),
    ]


def test_null_user_copies_collapse_and_get_no_id(spark):
    batch = flat(
        spark,
        [
            {"event_ts": at(), "user_pseudo_id": None},
            {"event_ts": at(), "user_pseudo_id": None},
            {"event_ts": at(), "event_name": "click"},
            {"event_ts": at()},
        ],
    )
    got = stage_events(batch, batch.limit(0))
    assert got.count() == 3
    assert got.where("event_id IS NULL").count() == 1
    assert got.where("event_id IS NOT NULL").select("event_id").distinct().count() == 2


def test_input_order_and_repeated_delivery_do_not_matter(spark):
    rng = random.Random(3)
    rows = [
        {
            "event_ts": at(minutes=rng.randrange(5)),
            "event_name": rng.choice(["click", "purchase"]),
            "user_pseudo_id": rng.choice(["u", "v", None]),
            "ga_session_id": rng.choice([1, 2, None]),
            "source": rng.choice(["a", "b", None]),
            "purchase_revenue": rng.choice([1.0, 2.0, None]),
        }
        for _ in range(200)
    ]
    half = rows[:100], rows[100:]
    first = stage_events(flat(spark, half[0]), flat(spark, half[1]))
    shuffled = [rng.sample(part, len(part)) for part in half]
    second = stage_events(
        flat(spark, shuffled[0]).repartition(7), flat(spark, shuffled[1] * 2).repartition(3)
    )
    assert rows_of(first) == rows_of(second)


def test_a_group_of_copies_with_a_third_of_the_rows(spark):
    many = spark.range(30_000).select(
        F.lit(None).cast("date").alias("event_date"),
        F.when(F.col("id") % 3 == 0, F.lit(at())).otherwise(
            F.timestamp_micros(F.col("id"))
        ).alias("event_ts"),
        F.lit("click").alias("event_name"),
        F.lit("u").alias("user_pseudo_id"),
        F.lit(1).cast("long").alias("ga_session_id"),
        F.col("id").cast("string").alias("source"),
        F.lit(None).cast("string").alias("medium"),
        F.lit(None).cast("string").alias("campaign"),
        F.lit(None).cast("double").alias("purchase_revenue"),
    )
    got = stage_events(many, many)
    assert got.count() == 20_001
    assert got.where(F.col("event_ts") == F.lit(at())).first()["source"] == "0"
