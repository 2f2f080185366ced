"""The same results in DuckDB SQL, written in the plain shape: joins, ranks, anti joins."""

from __future__ import annotations

_EVENT_COLUMNS = (
    "event_date, event_ts, event_name, user_pseudo_id, ga_session_id,"
    " source, medium, campaign, purchase_revenue"
)
_PLAIN_USER = "'u' || user_id"
_NAMED_USER = "CASE WHEN user_id % 10 = 0 THEN 'stream_user_' || user_id ELSE 'u' || user_id END"
_LANDING_ID = (
    "sha256(user_pseudo_id || '|' || event_name || '|' || strftime(event_ts, '%Y-%m-%d %H:%M:%S'))"
)
_EVENT_ID = "md5(user_pseudo_id || '|' || event_name || '|' || epoch_us(event_ts))"


def _web(user: str) -> str:
    return f"""WITH parsed AS (
    SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events
), web AS (
    SELECT CAST(ts AS DATE) AS event_date,
        CAST(ts AS TIMESTAMP) AS event_ts,
        event_type AS event_name,
        {user} AS user_pseudo_id,
        CASE WHEN k % 10 <> 7
            THEN CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 2 AS BIGINT)
        END AS ga_session_id,
        CASE WHEN k % 8 <> 0 THEN 'src' || (k % 5) END AS source,
        CASE k % 12 WHEN 1 THEN 'cpc' WHEN 2 THEN 'organic' WHEN 3 THEN 'paid_social'
            WHEN 4 THEN 'email' WHEN 5 THEN 'referral' WHEN 6 THEN '(none)'
            WHEN 7 THEN 'affiliate' WHEN 8 THEN 'ppc' WHEN 9 THEN 'CPC' WHEN 10 THEN 'organic'
        END AS medium,
        CASE WHEN k % 3 = 0 THEN 'camp' || (k % 4) END AS campaign,
        CASE WHEN event_type = 'purchase' AND k % 11 <> 0 THEN value END AS purchase_revenue
    FROM parsed
), landed AS (
    SELECT * REPLACE (CASE WHEN event_ts < TIMESTAMP '2024-01-24' THEN 'redelivered'
            ELSE campaign END AS campaign),
        {_LANDING_ID} AS event_id,
        date_trunc('second', event_ts) AS inserted_at
    FROM web WHERE event_ts >= TIMESTAMP '2024-01-20'
)"""


def _staged(user: str = _PLAIN_USER, landed: str = "landed") -> str:
    return f"""{_web(user)}, in_seconds AS (
    SELECT * REPLACE (date_trunc('second', event_ts) AS event_ts) FROM landed
), stacked AS (
    SELECT {_EVENT_COLUMNS}, 0 AS origin FROM web WHERE event_ts < TIMESTAMP '2024-01-24'
    UNION ALL
    SELECT {_EVENT_COLUMNS}, 1 AS origin FROM {landed}
), {_deduped("stacked")}"""


def _deduped(source: str) -> str:
    return f"""staged AS (
    SELECT {_EVENT_ID} AS event_id, {_EVENT_COLUMNS}
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY user_pseudo_id, event_name, event_ts
            ORDER BY origin, purchase_revenue DESC NULLS LAST, ga_session_id NULLS LAST,
                source NULLS LAST, medium NULLS LAST, campaign NULLS LAST, event_date NULLS LAST
        ) AS copy FROM {source}
    ) WHERE copy = 1
)"""


def _journey(days: int, user: str = _PLAIN_USER, landed: str = "landed") -> str:
    return f"""{_staged(user, landed)}, sessions AS (
    SELECT user_pseudo_id, ga_session_id, min(event_ts) AS touchpoint_ts,
        first(source ORDER BY event_ts, event_name) FILTER (WHERE source IS NOT NULL) AS source,
        first(medium ORDER BY event_ts, event_name) FILTER (WHERE medium IS NOT NULL) AS medium,
        first(campaign ORDER BY event_ts, event_name)
            FILTER (WHERE campaign IS NOT NULL) AS campaign
    FROM staged WHERE ga_session_id IS NOT NULL GROUP BY user_pseudo_id, ga_session_id
), touchpoints AS (
    SELECT md5(user_pseudo_id || '|' || ga_session_id) AS touchpoint_id,
        user_pseudo_id, ga_session_id, touchpoint_ts,
        coalesce(sessions.source, '(direct)') AS source,
        coalesce(sessions.medium, '(none)') AS medium,
        campaign, {_channel("sessions.medium")} AS channel
    FROM sessions
), conversions AS (
    SELECT event_id AS conversion_id, user_pseudo_id, event_ts AS conversion_ts,
        coalesce(purchase_revenue, 0) AS revenue
    FROM staged WHERE event_name = 'purchase'
), paths AS (
    SELECT c.*, t.touchpoint_id, t.touchpoint_ts, t.source, t.medium, t.campaign, t.channel
    FROM conversions c JOIN touchpoints t ON c.user_pseudo_id = t.user_pseudo_id
        AND t.touchpoint_ts <= c.conversion_ts
        AND t.touchpoint_ts >= c.conversion_ts - INTERVAL {days} DAY
), first_click AS ({_mart("first_click", "ASC")}
), last_click AS ({_mart("last_click", "DESC")}
), marts AS (SELECT * FROM first_click UNION ALL SELECT * FROM last_click)"""


# The channel rules and labels, the models, the fallback labels.
def _channel(medium: str) -> str:
    return f"""CASE WHEN {medium} IN ('cpc', 'ppc', 'paidsearch') THEN 'Paid Search'
            WHEN {medium} = 'organic' THEN 'Organic Search'
            WHEN {medium} LIKE '%social%' THEN 'Social'
            WHEN {medium} = 'email' THEN 'Email'
            WHEN {medium} = 'referral' THEN 'Referral'
            WHEN {medium} IS NULL OR {medium} = '(none)' THEN 'Direct'
            ELSE 'Other' END"""


def _mart(model: str, direction: str) -> str:
    return f"""
    SELECT * EXCLUDE (place), '{model}' AS attribution_model FROM (
        SELECT *, row_number() OVER (PARTITION BY conversion_id
            ORDER BY touchpoint_ts {direction}, touchpoint_id {direction}) AS place
        FROM paths
    ) WHERE place = 1
    UNION ALL
    SELECT c.*, NULL, NULL, NULL, NULL, NULL, 'Unattributed', '{model}'
    FROM conversions c WHERE NOT EXISTS (
        SELECT 1 FROM paths p WHERE p.conversion_id = c.conversion_id)"""


def _test_rows(tests: list[tuple[str, str, list[str], list[str]]]) -> str:
    rows = []
    for name, source, not_nulls, uniques in tests:
        rows += [
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, 'not_null' AS test_name,"
            f" count(*) AS failures FROM {source} WHERE {c} IS NULL"
            for c in not_nulls
        ]
        rows += [
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, 'unique' AS test_name,"
            f" count(*) AS failures FROM (SELECT {c} FROM {source} WHERE {c} IS NOT NULL"
            f" GROUP BY {c} HAVING count(*) > 1)"
            for c in uniques
        ]
    return "\nUNION ALL ".join(rows)


_TOTALS = """SELECT
    (SELECT round(sum(revenue), 2) FROM conversions) AS conversions,
    (SELECT round(sum(revenue), 2) FROM first_click) AS first_click,
    (SELECT round(sum(revenue), 2) FROM last_click) AS last_click"""

_ARRIVED = f"""arrived AS (
    SELECT {_LANDING_ID} AS event_id, event_date, date_trunc('second', event_ts) AS event_ts,
        event_name, user_pseudo_id, ga_session_id, source, medium, campaign, purchase_revenue
    FROM web
)"""

# The parameters that an event carries in the nested layout.
_PARAM_KEYS = """SELECT event_ts, list_filter([
    CASE WHEN campaign IS NOT NULL AND source IS NOT NULL THEN 'source' END,
    CASE WHEN campaign IS NOT NULL AND medium IS NOT NULL THEN 'medium' END,
    CASE WHEN campaign IS NOT NULL THEN 'campaign' END,
    CASE WHEN ga_session_id IS NOT NULL THEN 'ga_session_id' END
], lambda key: key IS NOT NULL) AS keys FROM web"""

_REBUILD_TESTS = [
    (
        "staged_events",
        "staged",
        ["event_id", "event_ts", "user_pseudo_id", "event_name"],
        ["event_id"],
    ),
    ("touchpoints", "touchpoints", ["touchpoint_id"], ["touchpoint_id"]),
    ("conversions", "conversions", ["conversion_id"], ["conversion_id"]),
    ("conversion_paths", "paths", ["conversion_id", "touchpoint_id"], []),
    ("first_click", "first_click", ["conversion_id", "channel"], ["conversion_id"]),
    ("last_click", "last_click", ["conversion_id", "channel"], ["conversion_id"]),
]


def oracle_queries() -> dict[str, str]:
    web, staged = _web(_PLAIN_USER), _staged()
    month, day = _journey(30), _journey(1)
    named = _journey(30, _NAMED_USER)
    live = f"""{web} SELECT event_ts, event_name, user_pseudo_id, source, medium,
            purchase_revenue FROM web
            ORDER BY event_ts DESC NULLS LAST, {_LANDING_ID} NULLS FIRST LIMIT 25"""
    fresh = f"""{web}, last_row AS (
            SELECT max(date_trunc('second', event_ts)) AS last_inserted_at FROM web
        ), aged AS (
            SELECT last_inserted_at, (epoch_us(TIMESTAMP '2024-01-31 00:30:00')
                - epoch_us(last_inserted_at)) / 60000000.0 AS age FROM last_row
        ) SELECT last_inserted_at, CAST(round(age, 2) AS DOUBLE) AS age_minutes,
            CASE WHEN age IS NULL OR age > 60 THEN 'error' WHEN age > 15 THEN 'warn'
                ELSE 'pass' END AS status FROM aged"""
    trend = f"""{web} SELECT date_trunc('hour', event_ts) AS window_start,
            date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS window_end, count(*) AS landed
            FROM web GROUP BY 1, 2"""
    staged_columns = ["event_id", *_EVENT_COLUMNS.split(", ")]
    return {
        "flatten_events": f"{web} SELECT {_EVENT_COLUMNS} FROM web",
        "nested_shards": f"{web} SELECT {_EVENT_COLUMNS} FROM web",
        "nested_shards_range": f"""{web} SELECT {_EVENT_COLUMNS} FROM web
            WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-14'""",
        "staged_events": f"{staged} SELECT * FROM staged",
        "touchpoints": f"{month} SELECT * FROM touchpoints",
        "channel_grouping": f"""{web} SELECT medium, {_channel("medium")} AS channel,
            count(*) AS events FROM web GROUP BY ALL""",
        "conversions": f"{month} SELECT * FROM conversions",
        "conversion_paths": f"{month} SELECT * FROM paths",
        "conversion_paths_1d": f"{day} SELECT * FROM paths",
        "conversion_paths_cut": f"{month} SELECT * FROM paths",
        "first_click": f"{month} SELECT * FROM first_click",
        "first_click_1d": f"{day} SELECT * FROM first_click",
        "last_click": f"{month} SELECT * FROM last_click",
        "last_click_1d": f"{day} SELECT * FROM last_click",
        "unattributed_1d": f"""{day} SELECT * FROM conversions c WHERE NOT EXISTS (
            SELECT 1 FROM paths p WHERE p.conversion_id = c.conversion_id)""",
        "model_totals": f"""{month} SELECT attribution_model, count(*) AS conversions,
            round(sum(revenue), 2) AS revenue FROM marts GROUP BY attribution_model""",
        "channel_breakdown": f"""{month} SELECT attribution_model, channel,
            count(*) AS conversions FROM marts GROUP BY attribution_model, channel""",
        "channel_comparison": f"""{month} SELECT channel,
            count(*) FILTER (WHERE attribution_model = 'first_click') AS first_click,
            count(*) FILTER (WHERE attribution_model = 'last_click') AS last_click
            FROM marts GROUP BY channel""",
        "daily_conversions": f"""{named}, last_day AS (
            SELECT max(CAST(conversion_ts AS DATE)) AS d FROM marts
            WHERE user_pseudo_id NOT LIKE 'stream_user%'
        ) SELECT CAST(conversion_ts AS DATE) AS day, attribution_model, count(*) AS conversions
            FROM marts, last_day
            WHERE CAST(conversion_ts AS DATE) BETWEEN d - 14 AND d
            GROUP BY 1, 2 ORDER BY 1, 2""",
        "live_events": live,
        "live_events_landed": live,
        "streamed_user_credit": f"""{named} SELECT attribution_model, user_pseudo_id, channel,
            revenue, conversion_ts FROM marts WHERE user_pseudo_id LIKE 'stream_user%'
            ORDER BY user_pseudo_id, attribution_model""",
        "dedupe_proof": f"""{_staged(_NAMED_USER)} SELECT
            (SELECT count(*) FROM landed) AS raw_rows,
            (SELECT count(*) FROM staged WHERE user_pseudo_id LIKE 'stream_user%')
                AS staged_rows""",
        "path_lengths": f"""{month} SELECT conversion_id, count(*) AS touches FROM paths
            GROUP BY conversion_id""",
        "event_profile": f"""{staged} SELECT event_name, count(*) AS events FROM staged
            GROUP BY event_name""",
        "revenue_reconciles": f"""{month}, totals AS ({_TOTALS}) SELECT *,
            NOT coalesce(first_click <> conversions OR last_click <> conversions, false)
                AS reconciles FROM totals""",
        "strict_reconciles": f"""{month}, matched AS (
            SELECT (SELECT count(*) FROM first_click f
                    WHERE f.conversion_id = c.conversion_id AND f.revenue = c.revenue) AS firsts,
                (SELECT count(*) FROM last_click l
                    WHERE l.conversion_id = c.conversion_id AND l.revenue = c.revenue) AS lasts
            FROM conversions c
        ) SELECT 'marts' AS table_name, 'revenue' AS column_name, 'strict' AS test_name,
            count(*) AS failures FROM matched WHERE firsts <> 1 OR lasts <> 1
        UNION ALL SELECT 'one_mart', 'revenue', 'strict', count(*) FROM conversions""",
        "not_null_violations": staged
        + " "
        + _test_rows([("staged_events", "staged", staged_columns, [])]),
        "unique_violations": staged
        + " "
        + _test_rows([("staged_events", "staged", [], ["event_id", "user_pseudo_id"])]),
        "duplicate_params": f"""{web} SELECT 'nested_events' AS table_name,
            'event_params' AS column_name, 'duplicate_keys' AS test_name,
            count(*) AS failures FROM ({_PARAM_KEYS}) t WHERE len(list_distinct(keys)) < len(keys)
        UNION ALL SELECT 'doubled_params', 'event_params', 'duplicate_keys', count(*) FROM web
            WHERE ga_session_id IS NOT NULL OR campaign IS NOT NULL""",
        "landing_event_id": f"""{web}, {_ARRIVED} SELECT event_id, event_ts, event_date,
            event_name, user_pseudo_id FROM arrived""",
        "freshness": fresh,
        "freshness_landed": fresh,
        "row_count_trend": trend,
        "row_count_trend_landed": trend,
        "landing_compacted": f"""{web} SELECT {_LANDING_ID} AS event_id, {_EVENT_COLUMNS},
            date_trunc('second', event_ts) AS inserted_at FROM web""",
        "ingest_stream": f"""{web}, {_ARRIVED}
            SELECT * FROM arrived UNION ALL SELECT * FROM arrived""",
        "ingest_staged": f"""{web}, {_ARRIVED}, twice AS (
            SELECT *, 1 AS origin FROM arrived UNION ALL SELECT *, 1 AS origin FROM arrived
        ), {_deduped("twice")} SELECT * FROM staged""",
        "ingest_load_times": f"""{web} SELECT count(*) AS landed, CAST(1 AS BIGINT) AS load_times,
            count(*) AS loaded_in_run, count(*) AS stored_by_day
            FROM web, (VALUES (1), (2)) feeds(feed) GROUP BY feed""",
        "ingest_rejects": f"""{web}, sent AS (
            SELECT event_id % 10 AS k, ts, event_type AS event_name,
                'u' || user_id AS user_pseudo_id, ts AS event_ts,
                '{{"event_name":"' || event_type || '","user_pseudo_id":"u' || user_id
                    || '","event_ts":"' || CASE WHEN event_id % 10 = 7 THEN 'no time'
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END || '"}}' AS line
            FROM events
        ) SELECT CASE WHEN k IN (3, 7) THEN 'rejected' ELSE 'landed' END AS fate,
            CASE WHEN k NOT IN (3, 7) THEN {_LANDING_ID} END AS event_id,
            CASE k WHEN 3 THEN line[:40] WHEN 7 THEN line END AS line FROM sent""",
        "stream_first_deliveries": f"{web}, {_ARRIVED} SELECT * FROM arrived",
        "stream_late_rows": f"{web}, {_ARRIVED} SELECT * FROM arrived",
        "restaged_days": f"{staged} SELECT * FROM staged",
        "rebuild": f"{month} SELECT * FROM marts",
        "stream_rebuild": f"{_journey(30, landed='in_seconds')} SELECT * FROM marts",
        "rebuild_tests": f"""{month} {_test_rows(_REBUILD_TESTS)}
        UNION ALL SELECT 'marts', 'revenue', 'reconciles', count(*) FROM ({_TOTALS}) t
            WHERE first_click <> conversions OR last_click <> conversions
        UNION ALL SELECT 'marts', 'revenue', 'strict', count(*) FROM (
            SELECT c.conversion_id FROM conversions c LEFT JOIN marts m
            ON m.conversion_id = c.conversion_id AND m.revenue IS NOT DISTINCT FROM c.revenue
            GROUP BY c.conversion_id HAVING count(m.conversion_id) <> 2) t
        UNION ALL SELECT 'nested_events', 'event_params', 'duplicate_keys', count(*)
            FROM ({_PARAM_KEYS}) t WHERE event_ts < TIMESTAMP '2024-01-24'
            AND len(list_distinct(keys)) < len(keys)""",
    }
