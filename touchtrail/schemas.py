"""Explicit schemas; nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql import types as T

_PARAM_VALUE = T.StructType(
    [T.StructField("string_value", T.StringType()), T.StructField("int_value", T.LongType())]
)

# Nested web-analytics export: only the fields that are used.
NESTED_EVENTS = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField(
            "event_params",
            T.ArrayType(
                T.StructType(
                    [T.StructField("key", T.StringType()), T.StructField("value", _PARAM_VALUE)]
                )
            ),
        ),
        T.StructField(
            "traffic_source",
            T.StructType(
                [T.StructField("source", T.StringType()), T.StructField("medium", T.StringType())]
            ),
        ),
        T.StructField(
            "ecommerce", T.StructType([T.StructField("purchase_revenue", T.DoubleType())])
        ),
    ]
)

FLAT_EVENTS = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("ga_session_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("medium", T.StringType()),
        T.StructField("campaign", T.StringType()),
        T.StructField("purchase_revenue", T.DoubleType()),
    ]
)
FLAT_COLUMNS = FLAT_EVENTS.fieldNames()

LANDING_EVENTS = T.StructType(
    [T.StructField("event_id", T.StringType())]
    + FLAT_EVENTS.fields
    + [T.StructField("inserted_at", T.TimestampType())]
)
LANDING_COLUMNS = LANDING_EVENTS.fieldNames()

STAGED_EVENTS = T.StructType([T.StructField("event_id", T.StringType())] + FLAT_EVENTS.fields)

# As stored: partitioned by the UTC day of the event time.
STORED_STAGED_EVENTS = T.StructType(
    STAGED_EVENTS.fields + [T.StructField("event_day", T.DateType())]
)

TOUCH_FIELDS = [
    T.StructField("touchpoint_id", T.StringType()),
    T.StructField("touchpoint_ts", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("medium", T.StringType()),
    T.StructField("campaign", T.StringType()),
    T.StructField("channel", T.StringType()),
]
TOUCH = T.StructType(TOUCH_FIELDS)
TOUCH_COLUMNS = TOUCH.fieldNames()

TOUCHPOINTS = T.StructType(
    [
        T.StructField("touchpoint_id", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("ga_session_id", T.LongType()),
    ]
    + TOUCH_FIELDS[1:]
)

CONVERSIONS = T.StructType(
    [
        T.StructField("conversion_id", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("conversion_ts", T.TimestampType()),
        T.StructField("revenue", T.DoubleType()),
    ]
)
CONVERSION_COLUMNS = CONVERSIONS.fieldNames()

PATHS = T.StructType(CONVERSIONS.fields + TOUCH_FIELDS)
MARTS = T.StructType(PATHS.fields + [T.StructField("attribution_model", T.StringType())])
