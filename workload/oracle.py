"""DuckDB SQL with the same result as each registered query.

Dates and times are ISO text and decimals are doubles on both sides, see
``workload.inputs.portable``. Averages of doubles are rounded to 6 digits.
"""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%S'"
STAMP = "'%Y-%m-%d %H:%M:%S.%f'"
K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def _text(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR)"


def _time(expression: str) -> str:
    return f"strftime({expression}, {STAMP})"


def _cents(total: str, count: str) -> str:
    """total / count rounded half-up to two digits, from integers only."""
    return f"CASE WHEN {count} > 0 THEN CAST((200 * {total} + {count}) // (2 * {count}) AS DOUBLE) / 100 END"


DAILY = """
SELECT CAST(ts AS DATE) AS day, avg(value) AS mean, min(value) AS low, max(value) AS high,
       count(*) AS n
FROM events GROUP BY 1
"""

TRIMMED = """
inside AS (SELECT ts, value FROM events WHERE event_type = 'view'),
bounds AS (SELECT quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM inside),
kept AS (SELECT inside.* FROM inside, bounds WHERE value >= lo AND value <= hi)
"""


def _extremes(limit: int = 5, source: str = "daily", day: str = "day", mean: str = "mean") -> str:
    parts = []
    for kind, direction in (("hot", "DESC"), ("cold", "ASC")):
        parts.append(
            f"(SELECT {_text(day)} AS date, round({mean}, 6) AS temperature, '{kind}' AS type, "
            f"CAST(row_number() OVER (ORDER BY {mean} {direction}, {day}) AS INTEGER) AS rank "
            f"FROM {source} ORDER BY {mean} {direction}, {day} LIMIT {limit})"
        )
    return " UNION ALL ".join(parts)


KEYED = f"""
SELECT CASE WHEN event_type <> 'signup' THEN 'log_' || user_id END AS id,
       CASE WHEN {K} < 50 THEN 'Room Admin' END AS room,
       date_trunc('hour', ts) AS noted_date, value,
       CASE WHEN event_type <> 'error' THEN ' ' || event_type || '_sensor' END AS out_in,
       event_id
FROM events
"""
FULL_ID = "coalesce('device_' || left(string_split(id, '_')[-1], 10), 'room_' || left(room, 10), 'default_' || event_id)"
INCREMENTAL_ID = "coalesce('dev_' || left(string_split(id, '_')[-1], 15), 'row_' || event_id)"
PLACE = "coalesce(left(trim(out_in), 10), 'unknown')"

MERGE = """
target AS (SELECT event_id, ts, user_id, value FROM events WHERE ts < TIMESTAMP '2024-01-21'),
source AS (SELECT event_id, ts, user_id, value + 1 AS value FROM events
           WHERE ts >= TIMESTAMP '2024-01-15')
"""

SESSIONS = f"""
SELECT event_id, 'user_' || user_id AS user_id, ts AS start_time, event_type,
       CAST(floor(value) AS BIGINT) AS seconds,
       CASE WHEN event_type <> 'error' THEN
         ['/p' || (({K} * i) % 7) FOR i IN range(1, {K} % 4 + 1)] END AS pages,
       CASE WHEN event_type <> 'signup' THEN
         [event_type || i FOR i IN range(1, {K} % 3 + 2)] END AS actions
FROM events
"""


def _activity(where: str = "", grain: str = "page") -> str:
    weight = "greatest(coalesce(len(pages), 0), 1)" if grain == "page" else "1"
    return f"""
    WITH sessions AS ({SESSIONS}),
    picked AS (SELECT CAST(start_time AS DATE) AS day, * FROM sessions {where}),
    visits AS (SELECT day, user_id, unnest(pages) AS page FROM picked),
    pages AS (SELECT day, user_id, count(DISTINCT page) AS n FROM visits GROUP BY 1, 2),
    totals AS (
      SELECT day, user_id, sum({weight}) AS sessions, sum(seconds * {weight}) AS total,
             sum(coalesce(len(actions), 0) * {weight}) AS actions
      FROM picked GROUP BY 1, 2)
    SELECT {_text('t.day')} AS activity_date, t.user_id,
           CAST(t.sessions AS BIGINT) AS sessions_count,
           {_cents('CAST(t.total AS BIGINT)', 'CAST(t.sessions AS BIGINT)')}
             AS avg_session_duration_seconds,
           CAST(t.actions AS BIGINT) AS total_actions,
           CAST(coalesce(p.n, 0) AS BIGINT) AS unique_pages_visited
    FROM totals t LEFT JOIN pages p USING (day, user_id)
    """


def _support(source: str, run_date: str) -> str:
    hours = _cents("CAST(total AS BIGINT)", "(3600 * n)")
    return f"""
    SELECT '{run_date}' AS snapshot_date, issue_type, status,
           CAST(tickets AS BIGINT) AS tickets_count, {hours} AS avg_resolution_time_hours,
           CAST(opened AS BIGINT) AS open_tickets_count
    FROM (SELECT issue_type, status, count(*) AS tickets, count(seconds) AS n,
                 sum(seconds) AS total,
                 sum(CASE WHEN status IN ('open', 'in_progress') THEN 1 ELSE 0 END) AS opened
          FROM ({source}) WHERE CAST(created_at AS DATE) <= DATE '{run_date}' GROUP BY 1, 2)
    """


TICKETS = """
SELECT o_orderdate AS created_at, o_orderpriority AS issue_type,
       CASE o_orderstatus WHEN 'F' THEN 'resolved' WHEN 'P' THEN 'in_progress' ELSE 'open' END AS status,
       CASE WHEN o_orderstatus = 'F'
            THEN CAST(date_diff('second', o_orderdate, shipped) AS BIGINT) END AS seconds
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1)
  ON l_orderkey = o_orderkey
"""
# Ticket documents: two orders share a ticket, the lower order is first.
TICKET_ROWS = """
SELECT DISTINCT ON (o_orderkey // 2) o_orderkey // 2 AS pair, o_orderkey, o_custkey,
       CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'resolved' ELSE 'closed' END
            WHEN 'P' THEN 'in_progress' ELSE 'open' END AS status,
       o_orderpriority AS issue_type, o_orderdate AS created_at,
       CAST(floor(o_totalprice) AS BIGINT) AS seconds_open
FROM orders ORDER BY o_orderkey // 2, o_orderkey
"""

PETS = f"""
SELECT event_id, event_type AS species, {K} AS k, unnest(
         CASE event_type WHEN 'purchase' THEN ['a', 'b'] WHEN 'error' THEN [] ELSE ['a'] END) AS letter
FROM events
"""
# JSON text of one food: <b>"e-acute, a number and a closing tag after a backslash.
PET_FOOD = r"""'"<b>\"\u00e9' || i || '\\</b>"'"""

FOODS = """
SELECT * FROM (
  SELECT p_name || ' ' AS food_name,
         CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS manufacturer,
         CAST(p_size AS VARCHAR) AS serving_size,
         CAST(p_partkey % 700 AS INTEGER) AS calories_total,
         CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey % 90 AS INTEGER) END AS calories_fat,
         CAST(p_retailprice AS VARCHAR) AS total_fat, '1' AS saturated_fat, '5' AS cholesterol,
         '210' AS sodium, '2' AS carb, '0' AS fiber, '1' AS protein,
         CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_partkey % 50 AS VARCHAR) ELSE '0' END AS vitamin_a,
         '0' AS vitamin_c, '8' AS calcium, CAST(p_partkey % 11 AS VARCHAR) AS iron
  FROM part)
UNION ALL
SELECT 'extra', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '0', '0', '0', '0'
FROM part WHERE p_partkey % 5 = 0
"""

EVENT_LOGS = f"""
SELECT DISTINCT ON (event_id // 2) 'evt_' || (event_id // 2) AS event_id,
       {_time("date_trunc('second', ts) + INTERVAL 210 MINUTE")} AS timestamp,
       event_type, props AS details
FROM events e ORDER BY e.event_id // 2, e.event_id
"""

CSV_ROWS = f"""
SELECT event_id, user_id, date_trunc('minute', ts) AS noted_date,
       CASE WHEN {K} <> 89 THEN value END AS temperature, event_type
FROM events WHERE {K} <> 97
"""


def _incremental_batch(name: str, days: int, add: int) -> str:
    return f"""
    {name} AS (
      SELECT DISTINCT ON (noted_date, device_id)
             noted_date, value + {add} AS temperature, location, device_id, '{name}' AS batch_id
      FROM (SELECT noted_date, value, {PLACE} AS location, {INCREMENTAL_ID} AS device_id, event_id
            FROM keyed
            WHERE noted_date >= (SELECT max(noted_date) FROM keyed) - INTERVAL {days} DAY)
      ORDER BY noted_date, device_id, event_id DESC)"""


INCREMENTAL = f"""
keyed AS ({KEYED}), {_incremental_batch('inc_1', 3, 0)}, {_incremental_batch('inc_2', 7, 1)},
{_incremental_batch('inc_3', 3, 0)}
"""

STATUS_ROWS = f"""
SELECT user_id, max(ts) FILTER ({K} < 3) AS newest,
       count(*) FILTER (ts >= TIMESTAMP '2024-01-30') AS in_window,
       count(*) FILTER (ts >= TIMESTAMP '2024-01-30' AND event_type <> 'signup') AS valid,
       count(*) FILTER (ts >= TIMESTAMP '2024-01-30' AND event_type = 'error') AS errors
FROM events GROUP BY 1
"""

SQL: dict[str, str] = {
    "daily_temperature_summary": f"""
        SELECT {_text('day')} AS date, round(mean, 6) AS avg_temp, low AS min_temp,
               high AS max_temp, n AS record_count FROM ({DAILY})""",
    "percentile_trim_daily": f"""
        WITH {TRIMMED}
        SELECT {_text('CAST(ts AS DATE)')} AS noted_date, round(avg(value), 6) AS temp
        FROM kept GROUP BY 1""",
    "percentile_trim_report": f"""
        WITH {TRIMMED}
        SELECT round(any_value(lo), 6) AS lower_percentile, round(any_value(hi), 6) AS upper_percentile,
               count(*) AS rows_before,
               count(*) FILTER (value >= lo AND value <= hi) AS rows_after,
               min(value) AS min_before, max(value) AS max_before,
               min(value) FILTER (value >= lo AND value <= hi) AS min_after,
               max(value) FILTER (value >= lo AND value <= hi) AS max_after
        FROM inside, bounds""",
    "temperature_extreme_days": f"WITH daily AS ({DAILY}) {_extremes()}",
    "hottest_days": f"""
        SELECT {_text('day')} AS noted_date, round(mean, 6) AS temp
        FROM (SELECT day, mean FROM ({DAILY}) ORDER BY mean DESC, day LIMIT 5)""",
    "coldest_days": f"""
        SELECT {_text('day')} AS noted_date, round(mean, 6) AS temp
        FROM (SELECT day, mean FROM ({DAILY}) ORDER BY mean, day LIMIT 5)""",
    "cold_days_report": f"""
        SELECT {_text('day')} AS date, round(mean, 6) AS temperature
        FROM (SELECT day, mean FROM ({DAILY}) ORDER BY mean, day LIMIT 5)""",
    "text_summary_report": f"""
        WITH {TRIMMED},
        daily AS (SELECT CAST(ts AS DATE) AS day, avg(value) AS mean FROM kept GROUP BY 1),
        lines AS (
          SELECT 1 AS line_no, '=== РЕЗУЛЬТАТЫ ОБРАБОТКИ ТЕМПЕРАТУРНЫХ ДАННЫХ ===' AS line
          UNION ALL SELECT 2, ''
          UNION ALL SELECT 3, 'Всего записей после очистки: ' || (SELECT count(*) FROM kept)
          UNION ALL SELECT 4, '5-й процентиль: ' || format('{{:.2f}}', lo) || '°C' FROM bounds
          UNION ALL SELECT 5, '95-й процентиль: ' || format('{{:.2f}}', hi) || '°C' FROM bounds
          UNION ALL SELECT 6, ''
          UNION ALL SELECT 7, '5 САМЫХ ЖАРКИХ ДНЕЙ:'
          UNION ALL SELECT 13, ''
          UNION ALL SELECT 14, '5 САМЫХ ХОЛОДНЫХ ДНЕЙ:'
          UNION ALL SELECT 7 + place, day || ': ' || format('{{:.2f}}', mean) || '°C'
            FROM (SELECT *, row_number() OVER (ORDER BY mean DESC, day) AS place FROM daily) WHERE place <= 5
          UNION ALL SELECT 14 + place, day || ': ' || format('{{:.2f}}', mean) || '°C'
            FROM (SELECT *, row_number() OVER (ORDER BY mean, day) AS place FROM daily) WHERE place <= 5)
        SELECT CAST(line_no AS INTEGER) AS line_no, line FROM lines""",
    "temperature_stats": f"""
        SELECT count(*) AS total_records, count(DISTINCT CAST(ts AS DATE)) AS total_days,
               {_time('min(ts)')} AS first_date, {_time('max(ts)')} AS last_date,
               round(avg(value), 6) AS avg_temp, min(value) AS min_temp, max(value) AS max_temp
        FROM events""",
    "temperature_load_stats": f"""
        SELECT {_time('min(ts)')} AS first_date, {_time('max(ts)')} AS last_date,
               count(DISTINCT user_id) AS device_count, round(avg(value), 6) AS avg_temperature
        FROM events""",
    "reading_date_range": f"""
        SELECT {_time('min(ts)')} AS first_date, {_time('max(ts)')} AS last_date FROM events""",
    "formatted_stats": """
        SELECT format('{:.1f}', avg(value)) AS avg_1, format('{:.2f}', avg(value)) AS avg_2,
               format('{:.2f}', min(value)) AS min_2, format('{:.2f}', max(value)) AS max_2
        FROM events""",
    "last_n_days_rows": f"""
        SELECT {_time('ts')} AS noted_date, value AS temp, user_id, event_id FROM events
        WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
    "last_n_days_capped": f"""
        SELECT {_text('CAST(ts AS DATE)')} AS load_date, count(*) AS records FROM events
        WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1""",
    "batch_rows_per_day": f"""
        SELECT {_text('day')} AS load_date, n AS records
        FROM (SELECT day, n FROM ({DAILY}) ORDER BY day DESC LIMIT 5)""",
    "batch_temperature_stats": """
        SELECT round(avg(value), 6) AS avg_temp, min(value) AS min_temp, max(value) AS max_temp
        FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'""",
    "batch_day_span": f"""
        SELECT count(DISTINCT CAST(ts AS DATE)) AS days,
               {_text('min(CAST(ts AS DATE))')} AS first_day, {_text('max(CAST(ts AS DATE))')} AS last_day
        FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
    "first_distinct_values": """
        SELECT CAST(o_custkey AS VARCHAR) AS value
        FROM (SELECT o_custkey, min(o_orderkey) AS first FROM orders GROUP BY 1 ORDER BY 2 LIMIT 10)""",
    "null_column_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count "
        "FROM documents LEFT JOIN labels USING (doc_id)"
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
    "standardised_headers": "SELECT r_regionkey AS region_key, r_name AS name_text FROM region",
    "device_ids_full": f"SELECT event_id, {FULL_ID} AS device_id FROM ({KEYED})",
    "device_ids_incremental": f"SELECT event_id, {INCREMENTAL_ID} AS device_id FROM ({KEYED})",
    "customer_device_ids": """
        SELECT c_custkey, 'device_' || left(string_split(c_name, '#')[-1], 10) AS full_id,
               'dev_' || left(string_split(c_name, '#')[-1], 15) AS incremental_id
        FROM customer""",
    "locations": f"SELECT event_id, {PLACE} AS location FROM ({KEYED})",
    "keep_first_event": f"""
        SELECT * REPLACE ({_time('ts')} AS ts)
        FROM (SELECT DISTINCT ON (user_id) * FROM events ORDER BY user_id, event_id)""",
    "keep_last_event": f"""
        SELECT * REPLACE ({_time('ts')} AS ts, {_text('day')} AS day)
        FROM (SELECT DISTINCT ON (day, user_id) *
              FROM (SELECT *, CAST(ts AS DATE) AS day FROM events)
              ORDER BY day, user_id, event_id DESC)""",
    "duplicate_line_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "duplicate_line_key_count": """
        SELECT count(*) AS duplicate_keys
        FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
    "load_quality_check": """
        SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(DISTINCT CAST(hour AS DATE)) AS days,
               count(DISTINCT user_id) AS devices, count(*) FILTER (n > 1) AS duplicate_keys
        FROM (SELECT date_trunc('hour', ts) AS hour, user_id, count(*) AS n FROM events GROUP BY 1, 2)""",
    "upsert_events": f"""
        WITH {MERGE}
        SELECT event_id, {_time('ts')} AS ts, user_id, round(value, 6) AS value FROM (
          SELECT * FROM target WHERE event_id NOT IN (SELECT event_id FROM source)
          UNION ALL SELECT * FROM source)""",
    "upsert_events_keeping_columns": f"""
        WITH {MERGE}
        SELECT coalesce(s.event_id, t.event_id) AS event_id, {_time('coalesce(s.ts, t.ts)')} AS ts,
               coalesce(t.user_id, -s.user_id) AS user_id, round(coalesce(s.value, t.value), 6) AS value
        FROM target t FULL JOIN source s ON t.event_id = s.event_id""",
    "insert_ignore_events": f"""
        WITH {MERGE}
        SELECT event_id, {_time('ts')} AS ts, user_id, round(value, 6) AS value FROM (
          SELECT * FROM target
          UNION ALL SELECT * FROM source WHERE event_id NOT IN (SELECT event_id FROM target))""",
    "key_probe": f"""
        WITH {MERGE}
        SELECT CASE WHEN event_id IN (SELECT event_id FROM target) THEN 'update' ELSE 'insert' END AS action,
               count(*) AS records FROM source GROUP BY 1""",
    "seeded_event_sample": f"""
        SELECT * REPLACE ({_time('ts')} AS ts)
        FROM (SELECT * FROM events ORDER BY md5('42|' || event_id), event_id LIMIT 1000)""",
    "user_activity_mart": _activity(),
    "user_activity_mart_day": _activity("WHERE CAST(start_time AS DATE) = DATE '2024-01-10'"),
    "user_activity_by_session": _activity(grain="session"),
    "support_efficiency_mart": _support(TICKETS, "1999-06-30"),
    "ticket_message_count": """
        SELECT conv_id, turn, role,
               CAST(CASE WHEN role <> 'system' THEN len(string_split(text, '. ')) ELSE 0 END AS INTEGER)
                 AS messages_count
        FROM conversations""",
    "flatten_json": f"""
        SELECT letter || event_id AS name, species,
               CASE WHEN k % 3 <> 0 THEN CAST(k + 1900 AS INTEGER) END AS birth_year,
               'https://example.org/' || event_id AS photo,
               CASE WHEN k % 4 <> 0 THEN '[' || array_to_string(
                 [{PET_FOOD} FOR i IN range(1, k % 4 + 1)], ', ') || ']' END AS fav_foods
        FROM ({PETS})""",
    "flatten_xml": FOODS,
    "flatten_xml_files": FOODS,
    "flatten_xml_nested": FOODS,
    "json_text_columns": f"""
        SELECT event_id,
               CASE WHEN len(pages) > 0 THEN '["' || array_to_string(pages, '", "') || '"]' END AS pages_json,
               '{{"type":"' || event_type || '","os":null}}' AS device_json
        FROM ({SESSIONS})""",
    "replicate_user_sessions": f"""
        WITH sessions AS ({SESSIONS}),
        firsts AS (SELECT DISTINCT ON (event_id // 3) * FROM sessions ORDER BY event_id // 3, event_id)
        SELECT 'sess_' || (event_id // 3) AS session_id, user_id,
               {_time("date_trunc('second', start_time) - INTERVAL 2 HOUR")} AS start_time,
               {_time("date_trunc('second', start_time) + to_seconds(seconds) - INTERVAL 2 HOUR")} AS end_time,
               CAST(seconds AS INTEGER) AS session_duration_seconds,
               CASE WHEN len(pages) = 0 THEN '[]' ELSE '["' || array_to_string(pages, '","') || '"]' END
                 AS pages_visited,
               '{{"type":"' || event_type || '","os":"Linux","browser":null}}' AS device,
               '["' || array_to_string(actions, '","') || '"]' AS actions
        FROM firsts""",
    "replicate_event_logs": EVENT_LOGS,
    "replicate_from_json_files": EVENT_LOGS,
    "replicate_streamed_files": EVENT_LOGS,
    "inserted_first_of_repeated_keys": """
        SELECT event_id // 2 AS pair, event_id, user_id FROM events
        WHERE event_id % 10 = 1 OR (event_id % 2 = 0 AND event_id % 10 <> 0)
           OR (event_id % 10 = 0 AND event_id + 1 NOT IN (SELECT event_id FROM events))""",
    "loose_headers_and_aliases": f"""
        SELECT event_id AS id, {_time('ts')} AS noted_date, event_type AS out_in FROM events""",
    "nan_values_as_null": """
        SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN value END AS value FROM events""",
    "shortened_error_texts": """
        SELECT event_id, left(repeat(coalesce(props, ''), 60), 500) AS error_message FROM events""",
    "stamped_and_keyed_rows": """
        SELECT user_id % 10 AS user_group, count(*) AS rows, count(*) AS stamped, 1 AS known_tables
        FROM events GROUP BY 1""",
    "csv_quoted_cells": """
        SELECT event_id, 'kind "' || event_type || '", user ' || user_id AS note FROM events""",
    "replicate_support_tickets": f"""
        SELECT 'ticket_' || pair AS ticket_id, 'user_' || o_custkey AS user_id, status, issue_type,
               CASE WHEN o_orderkey % 5 <> 0 THEN '[' || array_to_string(
                 ['{{"sender":"' || CASE WHEN i % 2 = 1 THEN 'user' ELSE 'support' END ||
                   '","message":"message ' || i || '","timestamp":"' ||
                   strftime(created_at, {ISO}) || '+00:00"}}' FOR i IN range(1, o_orderkey % 3 + 2)], ',') || ']' END AS messages,
               {_time('created_at')} AS created_at,
               {_time('created_at + to_seconds(seconds_open)')} AS updated_at,
               CASE WHEN status IN ('resolved', 'closed') THEN CAST(seconds_open AS DOUBLE) END
                 AS resolution_time_seconds,
               CAST(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 3 + 1 ELSE 0 END AS INTEGER)
                 AS messages_count
        FROM ({TICKET_ROWS})""",
    "replicate_user_recommendations": f"""
        SELECT 'user_' || o_custkey AS user_id,
               '["' || array_to_string(['prod_' || ((o_orderkey * i) % 500)
                 FOR i IN range(1, o_orderkey % 4 + 2)], '","') || '"]' AS recommended_products,
               {_time('o_orderdate')} AS last_updated
        FROM (SELECT DISTINCT ON (o_custkey) * FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey)""",
    "replicate_moderation_queue": f"""
        SELECT 'rev_' || (doc_id // 2) AS review_id, source AS user_id, lang AS product_id,
               md5(text) AS review_text, CAST(n_chars % 5 + 1 AS INTEGER) AS rating,
               CASE quality WHEN 1 THEN 'approved' WHEN 0 THEN 'rejected' ELSE 'pending' END
                 AS moderation_status,
               CASE WHEN toxic = 1 THEN '["toxicity_suspected"]' ELSE '[]' END AS flags,
               {_time("TIMESTAMP '2024-01-01' + to_seconds(doc_id)")} AS submitted_at
        FROM (SELECT DISTINCT ON (doc_id // 2) * FROM documents LEFT JOIN labels USING (doc_id)
              ORDER BY doc_id // 2, doc_id)""",
    "csv_scan_prepared": f"""
        SELECT {_time('noted_date')} AS noted_date, temperature,
               CASE event_type WHEN 'view' THEN 'In' WHEN 'error' THEN 'unknown' ELSE 'Out' END AS location,
               'device_' || user_id AS device_id, 'full_1' AS batch_id
        FROM ({CSV_ROWS})""",
    "temperature_processing": f"""
        WITH inside AS (SELECT noted_date, temperature AS value FROM ({CSV_ROWS})
                        WHERE event_type = 'view' AND temperature IS NOT NULL),
        bounds AS (SELECT quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM inside),
        daily AS (SELECT CAST(noted_date AS DATE) AS day, avg(value) AS mean, count(*) AS n
                  FROM inside, bounds WHERE value >= lo AND value <= hi GROUP BY 1)
        SELECT {_text('day')} AS date, round(mean, 6) AS temperature, 'day' AS type,
               CAST(n AS BIGINT) AS record_count FROM daily
        UNION ALL SELECT date, temperature, type, CAST(rank AS BIGINT) FROM ({_extremes()})""",
    "full_load_table": f"""
        SELECT {_time('noted_date')} AS noted_date, value AS temperature, {PLACE} AS location,
               {FULL_ID} AS device_id, 'full_2' AS batch_id FROM ({KEYED})""",
    "incremental_load_table": f"""
        WITH {INCREMENTAL}
        SELECT * REPLACE ({_time('noted_date')} AS noted_date, round(temperature, 6) AS temperature)
        FROM (SELECT * FROM inc_3 UNION ALL
              SELECT * FROM inc_2 WHERE (noted_date, device_id) NOT IN
                (SELECT (noted_date, device_id) FROM inc_3))""",
    "load_history_of_runs": f"""
        WITH {INCREMENTAL}
        SELECT 'full' AS load_type, 'full_1' AS batch_id, CAST(count(*) AS BIGINT) AS records_loaded,
               'success' AS load_status FROM keyed
        UNION ALL SELECT 'incremental', 'inc_1', count(*), 'success' FROM inc_1
        UNION ALL SELECT 'incremental', 'inc_2', count(*), 'success' FROM inc_2""",
    "load_history_latest": f"""
        SELECT 'incremental' AS load_type, 'b_' || day AS batch_id,
               {_time('CAST(day AS TIMESTAMP)')} AS created_at,
               {_time('CAST(day AS TIMESTAMP) + INTERVAL 1 HOUR')} AS end_date,
               CAST(n AS BIGINT) AS records_loaded,
               CASE WHEN errors > 0 THEN 'partial' ELSE 'success' END AS load_status
        FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n,
                     count(*) FILTER (event_type = 'error') AS errors
              FROM events WHERE day(ts) % 2 = 0 GROUP BY 1 ORDER BY 1 DESC LIMIT 3)""",
    "load_outcomes": f"""
        SELECT user_id, CASE WHEN newest IS NULL THEN 'failed_no_date' WHEN in_window = 0 THEN 'no_data'
                             WHEN valid = 0 THEN 'no_valid_data' WHEN errors > 0 THEN 'partial'
                             ELSE 'success' END AS status
        FROM ({STATUS_ROWS})""",
    "replaced_slice": _activity("WHERE CAST(start_time AS DATE) = DATE '2024-01-10'"),
    "marts_of_run_date": _support(
        f"SELECT created_at, issue_type, status, CASE WHEN status IN ('resolved', 'closed') "
        f"THEN seconds_open END AS seconds FROM ({TICKET_ROWS})",
        "1998-12-31",
    ),
    "appended_twice": f"""
        SELECT species, 2 * count(*) AS pets, 2 * count(CASE WHEN k % 4 <> 0 THEN 1 END) AS with_foods
        FROM ({PETS}) GROUP BY 1""",
    "inserted_missing_rows": f"""
        WITH {MERGE}
        SELECT {_text('CAST(ts AS DATE)')} AS date, round(avg(value), 6) AS avg_temp,
               min(value) AS min_temp, max(value) AS max_temp, count(*) AS record_count
        FROM (SELECT * FROM target UNION ALL
              SELECT * FROM source WHERE event_id NOT IN (SELECT event_id FROM target))
        GROUP BY 1""",
}

SQL["replicated_collections_upserted"] = " UNION ALL ".join(
    f"SELECT '{name}' AS collection, count(*) AS rows, count(*) AS created_kept, "
    f"count(*) AS updated_moved FROM ({SQL[query]})"
    for name, query in {
        "UserSessions": "replicate_user_sessions",
        "EventLogs": "replicate_event_logs",
        "SupportTickets": "replicate_support_tickets",
        "UserRecommendations": "replicate_user_recommendations",
        "ModerationQueue": "replicate_moderation_queue",
    }.items()
)

_TURN = "least(CAST(regexp_extract(event_id, '[0-9]+$') AS BIGINT) % 200, 19)"
SQL["upserts_of_small_batches"] = f"""
    SELECT * REPLACE (event_type || CASE WHEN CAST(regexp_extract(event_id, '[0-9]+$') AS BIGINT) % 200 <= 20
                                         THEN '_' || {_TURN} ELSE '' END AS event_type)
    FROM ({EVENT_LOGS})"""
SQL["all_collections_replicated_twice"] = " UNION ALL ".join(
    f"SELECT '{name}' AS collection, count(*) + count(*) FILTER (third) AS rows, "
    f"count(*) FILTER (third) AS new_rows, "
    + ("CAST(NULL AS BIGINT) AS moved " if name == "SupportTickets" else "count(*) FILTER (third) AS moved ")
    + f"FROM (SELECT CAST(regexp_extract({key}, '[0-9]+$') AS BIGINT) % 3 = 0 AS third FROM ({SQL[query]}))"
    for name, key, query in (
        ("UserSessions", "session_id", "replicate_user_sessions"),
        ("EventLogs", "event_id", "replicate_event_logs"),
        ("SupportTickets", "ticket_id", "replicate_support_tickets"),
        ("UserRecommendations", "user_id", "replicate_user_recommendations"),
        ("ModerationQueue", "review_id", "replicate_moderation_queue"),
    )
)
_RUNS = f"WITH keyed AS ({KEYED}), {_incremental_batch('inc_1', 3, 0)}, {_incremental_batch('inc_2', 1, 0)}"
_REASON = """CASE WHEN temperature >= 150 THEN 'temperature below 150'
                  WHEN location = 'unknown' THEN 'place is known' END"""
SQL["load_outcomes_of_runs"] = f"""{_RUNS}
    SELECT 'inc_1' AS batch_id, count(*) FILTER ({_REASON} IS NULL) AS records_loaded, 'partial' AS load_status FROM inc_1
    UNION ALL SELECT 'inc_2', 0, 'no_valid_data'
    UNION ALL SELECT 'inc_3', count(*), 'success' FROM inc_1"""
SQL["rejected_readings"] = f"""{_RUNS}
    SELECT batch_id, 'temperature_incremental' AS table_name, reason, {_time('noted_date')} AS noted_date, device_id,
           round(temperature, 6) AS temperature
    FROM (SELECT *, {_REASON} AS reason FROM inc_1 UNION ALL SELECT *, 'nothing is taken' FROM inc_2)
    WHERE reason IS NOT NULL"""

_OPEN = f"""SELECT event_id // 3 AS session, event_type, {K} AS k FROM events
            QUALIFY row_number() OVER (PARTITION BY event_id // 3 ORDER BY event_id) = 1"""
SQL["open_documents_replicated"] = f"""
    SELECT 'sess_' || session AS session_id,
           '{{"os":"Linux",' || CASE WHEN k % 2 = 0
                THEN '"screen":{{"sizes":[' || k || ',' || (k + 1) || '],"w":' || k || '}},' ELSE '' END
           || '"type":"' || event_type || '"}}' AS device,
           CASE WHEN k % 2 = 0 THEN k + 1 END AS second_size
    FROM ({_OPEN})"""
SQL["document_shapes"] = f"""
    SELECT event_type, 'OBJECT<browser: VOID, os: STRING, screen: ' || CASE WHEN bool_or(k % 2 = 0)
           THEN 'OBJECT<sizes: ARRAY<BIGINT>, w: BIGINT>' ELSE 'VOID' END || ', type: STRING>' AS shape
    FROM ({_OPEN}) GROUP BY event_type"""
SQL["foods_in_foods_loaded"] = f"""{FOODS}
UNION ALL
SELECT 'inner', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '0', '0', '0', '0' FROM part"""
SQL["column_types"] = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*) AS row_count, "
    f"count(*) - count({name}) AS null_count FROM orders"
    for name, kind in (
        ("o_orderkey", "bigint"), ("o_orderdate", "timestamp_ntz"), ("o_totalprice", "double"), ("o_orderstatus", "string"),
    )
)
SQL["first_rows_by_key"] = "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 7"
SQL["table_of_an_older_spec"] = """
    SELECT event_id, CASE WHEN event_id % 3 = 1 OR event_id % 6 < 2 THEN event_type END AS kind,
           CASE WHEN event_id % 6 < 2 THEN -value ELSE value END AS value,
           CASE WHEN event_id % 3 = 1 OR event_id % 6 < 2 THEN user_id END AS user_id
    FROM events WHERE event_id % 3 < 2"""
SQL["csv_inferred_types"] = f"""
    WITH counts AS (SELECT count(*) AS n, count(*) FILTER ({K} % 7 = 0 OR {K} IS NULL OR user_id IS NULL) AS users FROM events)
    SELECT column_name, data_type, n AS row_count,
           CASE column_name WHEN 'user_id' THEN users WHEN 'nothing' THEN n ELSE 0 END AS null_count
    FROM counts, (VALUES ('event_id', 'bigint'), ('user_id', 'bigint'), ('value', 'double'), ('is_error', 'boolean'),
                         ('mixed', 'string'), ('widened', 'double'), ('nothing', 'double')) AS t(column_name, data_type)"""
