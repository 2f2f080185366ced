"""Small tables for the tests."""

from datetime import datetime, timedelta, timezone

from touchtrail import schemas

T0 = datetime(2021, 1, 1, tzinfo=timezone.utc)


def at(**delta):
    return T0 + timedelta(**delta)


def naive(ts):
    return ts.replace(tzinfo=None)


def _table(spark, schema, rows, defaults):
    filled = [tuple({**defaults, **row}.get(c) for c in schema.fieldNames()) for row in rows]
    return spark.createDataFrame(filled, schema)


def flat(spark, rows):
    defaults = {"event_date": T0.date(), "event_name": "page_view", "user_pseudo_id": "u"}
    return _table(spark, schemas.FLAT_EVENTS, rows, defaults)


def staged(spark, rows):
    defaults = {"event_date": T0.date(), "event_name": "page_view", "user_pseudo_id": "u"}
    return _table(spark, schemas.STAGED_EVENTS, rows, defaults)


def landing(spark, rows):
    defaults = {"event_date": T0.date(), "event_name": "page_view", "user_pseudo_id": "u"}
    return _table(spark, schemas.LANDING_EVENTS, rows, defaults)


def nested(spark, rows):
    defaults = {
        "event_date": "20210101",
        "event_timestamp": int(T0.timestamp() * 1_000_000),
        "event_name": "page_view",
        "user_pseudo_id": "u",
    }
    return _table(spark, schemas.NESTED_EVENTS, rows, defaults)


def param(key, text=None, number=None):
    return (key, (text, number))


def touches(spark, rows):
    defaults = {
        "user_pseudo_id": "u",
        "ga_session_id": 1,
        "source": "s",
        "medium": "m",
        "channel": "Other",
    }
    return _table(spark, schemas.TOUCHPOINTS, rows, defaults)


def conversions(spark, rows):
    defaults = {"user_pseudo_id": "u", "revenue": 1.0}
    return _table(spark, schemas.CONVERSIONS, rows, defaults)


def marts(spark, rows):
    defaults = {"user_pseudo_id": "u", "revenue": 1.0, "channel": "Other"}
    return _table(spark, schemas.MARTS, rows, defaults)


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return ordered(tuple(r) for r in picked.collect())
