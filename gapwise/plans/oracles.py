"""DuckDB SQL with the same results as the registered queries, over the same tables."""

from __future__ import annotations

SHORT_GAP, WIDE_GAP = 300, 21_600
REDO_START, REDO_END = "2024-01-10", "2024-01-20"
CUT = "2024-01-15 00:00:00"

KST = "INTERVAL 9 HOUR"
DAY = "strftime({} + " + KST + ", '%Y-%m-%d')"

# Canonical event columns.
EVENTS = """
SELECT ts AS event_time_utc, event_type, event_id AS product_id,
       CAST(NULL AS BIGINT) AS category_id, CAST(NULL AS VARCHAR) AS category_code,
       CAST(NULL AS VARCHAR) AS brand, CAST(value AS DECIMAL(18,2)) AS price,
       user_id, props AS source_user_session
FROM events
"""

RAW_COLUMNS = (
    "strftime(event_time_utc, '%Y-%m-%d %H:%M:%S') || ' UTC' AS event_time, event_type, "
    "product_id, category_id, category_code, brand, price, user_id, "
    "source_user_session AS user_session"
)

ORDER = "event_time_utc, source_user_session, product_id"


def sessions(gap: int, source: str = EVENTS, run_id: str = "'run-1'", order: str = "") -> str:
    """Published rows of ``source``, cut by the textbook lag, running sum and minimum."""
    return f"""
WITH e AS ({source}),
p AS (SELECT *, lag(event_time_utc) OVER (PARTITION BY user_id ORDER BY {order or ORDER}) AS previous_time FROM e),
g AS (SELECT *, CAST(epoch(date_trunc('second', event_time_utc))
                   - epoch(date_trunc('second', previous_time)) AS BIGINT) AS gap_seconds FROM p),
f AS (SELECT *, CASE WHEN previous_time IS NULL OR gap_seconds >= {gap} THEN 1 ELSE 0 END
             AS is_new_session FROM g),
s AS (SELECT *, CAST(sum(is_new_session) OVER (PARTITION BY user_id ORDER BY {order or ORDER}
             ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_seq FROM f),
z AS (SELECT *, min(event_time_utc) OVER (PARTITION BY user_id, session_seq) AS session_start,
             row_number() OVER (PARTITION BY user_id, session_seq ORDER BY {order or ORDER}) AS session_event_seq
      FROM s)
SELECT event_time_utc, event_time_utc + {KST} AS event_time_kst, event_type, product_id,
       category_id, category_code, brand, price, user_id, source_user_session,
       sha256(concat_ws('|', CAST(user_id AS VARCHAR),
                        strftime(session_start, '%Y-%m-%d %H:%M:%S'))) AS generated_session_id,
       session_seq, session_start AS session_start_at_utc,
       session_start + {KST} AS session_start_at_kst,
       CAST(session_event_seq AS BIGINT) AS session_event_seq,
       {run_id} AS run_id, {DAY.format("event_time_utc")} AS dt
FROM z
"""


PUBLISHED = sessions(WIDE_GAP)
SECOND_EVENTS = f"""
SELECT * REPLACE (CAST(price * 2 AS DECIMAL(18,2)) AS price) FROM ({EVENTS})
WHERE event_type <> 'error' AND {DAY.format("event_time_utc")} < '{REDO_END}'
"""
SECOND_RUN = f"""
SELECT * FROM ({sessions(WIDE_GAP, SECOND_EVENTS, "'run-2'")}) WHERE dt >= '{REDO_START}'
"""
# Rows readers see after the second run took over its days.
REPLACED = f"""
SELECT * FROM ({PUBLISHED}) WHERE dt NOT IN (SELECT DISTINCT dt FROM ({SECOND_RUN}))
UNION ALL SELECT * FROM ({SECOND_RUN})
"""


def columns(source: str, *names: str) -> str:
    return f"SELECT {', '.join(names)} FROM ({source})"


def numbered() -> str:
    names = (
        "product_id",
        "user_id",
        "session_seq",
        "session_start_at_utc AS session_start",
        "session_event_seq",
    )
    return columns(PUBLISHED, *names)


# Old rows left their users' last times behind; of the others, those before them are late.
IN_TIME = f"event_time_utc < TIMESTAMP '{CUT}' AND event_type <> 'error'"
ARRIVED = f"""
SELECT e.*, coalesce(e.event_time_utc < l.last_time, FALSE) AS is_late FROM ({EVENTS}) e
LEFT JOIN (SELECT user_id, max(event_time_utc) AS last_time FROM ({EVENTS}) WHERE {IN_TIME} GROUP BY 1) l
       USING (user_id)
WHERE NOT ({IN_TIME})
"""
ON_TIME = f"""
SELECT * FROM ({EVENTS}) WHERE {IN_TIME}
UNION ALL SELECT * EXCLUDE (is_late) FROM ({ARRIVED}) WHERE NOT is_late
"""
CONTINUED = f"""
SELECT product_id, user_id, session_seq, session_start_at_utc AS session_start, session_event_seq,
       FALSE AS is_late
FROM ({sessions(WIDE_GAP, ON_TIME)})
WHERE product_id IN (SELECT product_id FROM ({ARRIVED}))
UNION ALL SELECT product_id, user_id, NULL, NULL, NULL, TRUE FROM ({ARRIVED}) WHERE is_late
"""

STREAMED = CONTINUED.replace(f"WHERE product_id IN (SELECT product_id FROM ({ARRIVED}))", "")


def local(shift: str) -> str:
    return f"""
SELECT event_id AS product_id, ts {shift} AS local_time,
       strftime(ts {shift}, '%Y-%m-%d') AS dt FROM events
"""


def weekly(source: str, *figures: str) -> str:
    week = "CAST(date_trunc('week', CAST(dt AS DATE)) AS DATE)"
    return f"""
SELECT {week} AS week_start, {', '.join(figures)} FROM ({source}) GROUP BY 1 ORDER BY 1
"""


USERS = "count(DISTINCT user_id) AS wau_users"
SESSIONS = "count(DISTINCT generated_session_id) AS wau_sessions"
AUDIT = (
    "count(*) AS row_count, count(DISTINCT user_id) AS users, "
    "count(DISTINCT generated_session_id) AS sessions"
)


def provenance(source: str) -> str:
    return f"""
SELECT dt, count(*) AS row_count, string_agg(DISTINCT run_id, ',' ORDER BY run_id) AS run_ids,
       min(price) AS min_price, max(price) AS max_price
FROM ({source}) GROUP BY dt
"""


LEDGER = f"""
SELECT 'lake-' || CAST(user_id AS VARCHAR) AS output, {DAY.format("ts")} AS dt,
       'lake-' || CAST(user_id AS VARCHAR) || '/' || {DAY.format("ts")} AS run_id,
       CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED'
            ELSE 'RUNNING' END AS status,
       ts AS started_at
FROM events
"""
LATEST = f"""
SELECT run_id, arg_max(output, started_at) AS output, arg_max(dt, started_at) AS dt,
       arg_max(status, started_at) AS status, max(started_at) AS started_at
FROM ({LEDGER}) GROUP BY run_id
"""
OUTCOME = (
    "CASE status WHEN 'SUCCESS' THEN 'done' WHEN 'FAILED' THEN 'failed' "
    "WHEN 'RUNNING' THEN 'incomplete' ELSE 'not done' END AS outcome"
)

RANGE = f"SELECT * FROM ({PUBLISHED}) WHERE dt >= '{REDO_START}' AND dt < '{REDO_END}'"
TO_THE_SECOND = f"""
SELECT * REPLACE (date_trunc('second', event_time_utc) AS event_time_utc) FROM ({EVENTS})
"""

SIZED = f"""
SELECT user_id, date_trunc('second', session_start_at_utc) AS session_start,
       date_trunc('second', max(event_time_utc)) AS session_end, count(*) AS events
FROM ({PUBLISHED}) GROUP BY user_id, session_start_at_utc
"""
# The watermark trails the last event by an hour; a session closes a gap after its last event.
CLOSED = f"""
session_end + INTERVAL {WIDE_GAP - 1} SECOND
    <= (SELECT date_trunc('second', max(ts)) - INTERVAL 1 HOUR FROM events)
"""

ORACLES: dict[str, str] = {
    "canonical_events": TO_THE_SECOND,
    "parse_event_time": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' AS text,
       date_trunc('second', ts) AS parsed FROM events
""",
    "csv_typed_scan": columns(EVENTS, RAW_COLUMNS),
    "multi_path_scan": f"""
SELECT {RAW_COLUMNS} FROM ({EVENTS})
UNION ALL
SELECT {RAW_COLUMNS} FROM ({EVENTS}) WHERE event_time_utc >= TIMESTAMP '{CUT}'
""",
    "dedup_union": f"""
SELECT * FROM ({EVENTS}) WHERE event_time_utc < TIMESTAMP '{REDO_END} 00:00:00'
UNION
SELECT * FROM ({EVENTS}) WHERE event_time_utc >= TIMESTAMP '{REDO_START} 00:00:00'
""",
    "local_day": local("+ INTERVAL 9 HOUR"),
    "local_day_other_zone": local("- INTERVAL 7 HOUR"),
    "week_start": f"""
SELECT event_id AS product_id, {DAY.format("ts")} AS dt,
       CAST(date_trunc('week', CAST({DAY.format("ts")} AS DATE)) AS DATE) AS week_start
FROM events
""",
    "session_boundaries": f"""
WITH p AS (SELECT *, lag(event_time_utc) OVER (PARTITION BY user_id ORDER BY {ORDER}) AS previous_time
           FROM ({EVENTS})),
g AS (SELECT *, CAST(epoch(date_trunc('second', event_time_utc))
                   - epoch(date_trunc('second', previous_time)) AS BIGINT) AS gap_seconds FROM p)
SELECT product_id, user_id, event_time_utc, previous_time, gap_seconds,
       CASE WHEN previous_time IS NULL OR gap_seconds >= {SHORT_GAP} THEN 1 ELSE 0 END AS is_new_session
FROM g
""",
    "session_numbers": columns(PUBLISHED, "product_id", "user_id", "session_seq"),
    "session_starts": columns(
        PUBLISHED, "product_id", "user_id", "session_start_at_utc", "session_start_at_kst"
    ),
    "session_event_numbers": columns(PUBLISHED, "product_id", "user_id", "session_event_seq"),
    "session_ids": columns(PUBLISHED, "product_id", "user_id", "generated_session_id"),
    "sessionize_full": sessions(SHORT_GAP),
    "sessionize_wide_gap": PUBLISHED,
    "sessionize_split": numbered(),
    "sessionize_hot_ranges": numbered(),
    "sessionize_orders": """
WITH p AS (SELECT o_orderkey, o_custkey, o_orderdate AS ordered_at,
                  lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_time
           FROM orders),
f AS (SELECT *, CASE WHEN previous_time IS NULL OR
             epoch(date_trunc('second', ordered_at)) - epoch(date_trunc('second', previous_time)) >= 7776000
             THEN 1 ELSE 0 END AS is_new_session FROM p),
s AS (SELECT *, CAST(sum(is_new_session) OVER (PARTITION BY o_custkey ORDER BY ordered_at, o_orderkey
             ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_seq FROM f)
SELECT o_orderkey, o_custkey, ordered_at, session_seq,
       min(ordered_at) OVER (PARTITION BY o_custkey, session_seq) AS session_start,
       CAST(row_number() OVER (PARTITION BY o_custkey, session_seq ORDER BY ordered_at, o_orderkey) AS BIGINT)
           AS session_event_seq
FROM s
""",
    "session_rollup": f"""
SELECT user_id, generated_session_id, min(session_start_at_utc) AS session_start_at_utc,
       max(event_time_utc) AS session_end_at_utc, count(*) AS events,
       CAST(epoch(date_trunc('second', max(event_time_utc)))
          - epoch(date_trunc('second', min(event_time_utc))) AS BIGINT) AS duration_seconds,
       CAST(sum(price) AS DECIMAL(18,2)) AS value
FROM ({PUBLISHED}) GROUP BY user_id, generated_session_id
""",
    "day_range_filter": RANGE,
    "lookback_sessionize": RANGE,
    "edge_sessions": f"""
SELECT DISTINCT user_id, generated_session_id, session_start_at_utc FROM ({sessions(WIDE_GAP, f"""
    SELECT * FROM ({EVENTS})
    WHERE {DAY.format("event_time_utc")} >= '{REDO_START}' AND {DAY.format("event_time_utc")} < '{REDO_END}'
""")})
WHERE epoch(date_trunc('second', session_start_at_utc))
      - epoch(TIMESTAMP '{REDO_START} 00:00:00' - {KST}) < {WIDE_GAP}
""",
    "session_state": f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id
                  ORDER BY session_seq DESC, session_event_seq DESC) AS back FROM ({PUBLISHED}))
SELECT user_id, event_time_utc AS last_time, session_seq, session_start_at_utc AS session_start,
       session_event_seq FROM r WHERE back = 1
""",
    "incremental_sessionize": CONTINUED,
    "incremental_hot_ranges": CONTINUED,
    "stream_sessions": f"SELECT * FROM ({SIZED}) WHERE {CLOSED}",
    "stream_all_sessions": SIZED,
    "batch_timestamp": f"SELECT count(*) AS row_count, TRUE AS one_time, TRUE AS of_the_run FROM ({PUBLISHED})",
    "stream_redo_days": f"""
SELECT DISTINCT strftime(day, '%Y-%m-%d') AS dt
FROM (SELECT unnest(generate_series(CAST(session_start + {KST} AS DATE),
                                    CAST(session_end + {KST} AS DATE), INTERVAL 1 DAY)) AS day
      FROM ({SIZED}) WHERE NOT ({CLOSED}))
""",
    "wau_by_user": weekly(PUBLISHED, USERS),
    "wau_by_session": weekly(PUBLISHED, SESSIONS),
    "weekly_engagement": weekly(PUBLISHED, USERS, SESSIONS),
    "wau_from_table": weekly(PUBLISHED, USERS, SESSIONS),
    "complete_weeks": f"""
SELECT week_start, wau_users, week_start >= DATE '2024-01-03'
       AND week_start + INTERVAL 7 DAY <= DATE '2024-01-29' AS complete_week
FROM ({weekly(f"SELECT * FROM ({PUBLISHED}) WHERE dt >= '2024-01-03' AND dt < '2024-01-29'", USERS)})
""",
    "daily_audit": f"SELECT dt, {AUDIT} FROM ({PUBLISHED}) GROUP BY dt",
    "global_audit": f"SELECT {AUDIT}, count(DISTINCT dt) AS days FROM ({PUBLISHED})",
    "staged_output_stats": f"""
SELECT count(*) AS row_count, string_agg(DISTINCT dt, ',' ORDER BY dt) AS days FROM ({PUBLISHED})
""",
    "lake_scan_roundtrip": PUBLISHED,
    "clustered_days": PUBLISHED,
    "rolling_users": f"""
WITH d AS (SELECT DISTINCT user_id, CAST(dt AS DATE) AS day FROM ({PUBLISHED})),
c AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d)
SELECT strftime(c.day, '%Y-%m-%d') AS dt, count(DISTINCT d.user_id) AS users
FROM c LEFT JOIN d ON d.day BETWEEN c.day - INTERVAL 6 DAY AND c.day GROUP BY c.day
""",
    "unreferenced_versions": f"""
SELECT DISTINCT '_versions/version=run-1/dt=' || dt AS folder, TRUE AS has_bytes FROM ({PUBLISHED})
WHERE dt >= '{REDO_START}' AND dt < '{REDO_END}'
""",
    "reconcile_union": f"""
WITH h AS (SELECT *, CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS n FROM ({EVENTS})
           WHERE event_time_utc < TIMESTAMP '{REDO_END} 00:00:00'),
t AS (SELECT *, CASE WHEN event_type = 'click' THEN 3 ELSE 1 END AS n FROM ({EVENTS})
      WHERE event_time_utc >= TIMESTAMP '{REDO_START} 00:00:00'),
u AS (SELECT * FROM h UNION ALL SELECT * FROM t),
m AS (SELECT * EXCLUDE (n), max(n) AS n FROM u GROUP BY ALL)
SELECT * EXCLUDE (n, copy) FROM (SELECT *, unnest(range(n)) AS copy FROM m)
""",
    "csv_rescue": f"""
WITH r AS (SELECT {RAW_COLUMNS} FROM ({EVENTS})),
t AS (SELECT *, CASE WHEN event_type = 'click' THEN 'p' ELSE '' END || CAST(product_id AS VARCHAR) AS product_text,
             CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(price AS VARCHAR) END AS price_text FROM r)
SELECT event_time, event_type, CASE WHEN event_type <> 'click' THEN product_id END AS product_id,
       CASE WHEN event_type <> 'error' THEN price END AS price, CAST(product_id AS VARCHAR) AS user_session,
       CASE WHEN event_type IN ('click', 'error') THEN concat_ws(',', event_time, event_type, product_text, '', '', '',
            price_text, CAST(user_id AS VARCHAR), CAST(product_id AS VARCHAR)) END AS unparsed_line
FROM t
""",
    "merge_late_events": f"""
WITH l AS (SELECT product_id FROM ({EVENTS}) WHERE event_type = 'error' AND price > 40),
o AS ({sessions(WIDE_GAP, f"SELECT * FROM ({EVENTS}) WHERE NOT (event_type = 'error' AND price > 40)")})
SELECT n.product_id, n.user_id, n.session_seq, n.session_start, n.session_event_seq,
       o.product_id IS NULL OR o.session_seq <> n.session_seq OR o.session_start_at_utc <> n.session_start
       OR o.session_event_seq <> n.session_event_seq AS is_changed
FROM ({numbered()}) n LEFT JOIN o USING (product_id)
""",
    "stream_events": STREAMED,
    "redo_closure": f"""
WITH RECURSIVE d AS (
    SELECT 'lake-' || CAST(user_id AS VARCHAR) AS output, {DAY.format("event_time_utc")} AS dt,
           bool_or(event_type = 'error' AND price > 120) AS asked
    FROM ({EVENTS}) GROUP BY ALL),
b AS (SELECT *, output || '/' || dt AS run_id, CAST(substr(dt, 9) AS INTEGER) AS number,
             lag(dt, 1) OVER w AS one, lag(dt, 2) OVER w AS two FROM d WINDOW w AS (PARTITION BY output ORDER BY dt)),
r AS (SELECT *, CASE WHEN number % 7 <> 0 THEN output || '/' || CASE WHEN number % 5 = 0 THEN two ELSE one END END
             AS state_from FROM b),
k AS (SELECT r.*, number % 7 = 0 AND (coalesce(x.asked, FALSE) OR coalesce(y.asked, FALSE)) AS reads
      FROM r LEFT JOIN d x ON x.output = r.output AND x.dt = r.one
      LEFT JOIN d y ON y.output = r.output AND y.dt = r.two),
s(run_id, steps) AS (
    SELECT run_id, CASE WHEN asked THEN 0 ELSE 1 END FROM k WHERE asked OR reads
    UNION SELECT k.run_id, s.steps + 1 FROM s JOIN k ON k.state_from = s.run_id),
f AS (SELECT run_id, min(steps) AS steps FROM s GROUP BY run_id)
SELECT k.output, k.dt, k.run_id,
       CASE WHEN asked THEN 'asked' WHEN reads THEN 'lookback' ELSE 'state' END AS because,
       CAST(f.steps AS INTEGER) AS steps
FROM k JOIN f USING (run_id)
""",
    "files_per_partition": f"""
SELECT dt, count(*) AS row_count, CAST(ceil(count(*) / 300.0) AS BIGINT) AS files FROM ({PUBLISHED}) GROUP BY dt
""",
    "compacted_days": f"""
SELECT dt, count(*) AS row_count, CAST(sum(price) AS DECIMAL(18,2)) AS value, TRUE AS as_planned
FROM ({PUBLISHED}) GROUP BY dt
""",
    "replace_days": provenance(REPLACED),
    "publish_versions": provenance(REPLACED),
    "current_versions": provenance(REPLACED),
    "day_provenance": provenance(f"SELECT * FROM ({PUBLISHED}) UNION ALL SELECT * FROM ({SECOND_RUN})"),
    "table_partitions": f"SELECT DISTINCT 'dt=' || dt AS partition FROM ({PUBLISHED})",
    "batch_job": f"""
SELECT * FROM ({sessions(SHORT_GAP, TO_THE_SECOND, "'job-1'")})
WHERE dt >= '{REDO_START}' AND dt < '{REDO_END}'
""",
    "batch_job_lookback": f"""
WITH t AS (SELECT * FROM ({TO_THE_SECOND}) WHERE event_time_utc >= TIMESTAMP '{REDO_START} 00:00:00' - INTERVAL 1 DAY
                                           AND event_time_utc < TIMESTAMP '{REDO_END} 00:00:00'),
u AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE event_type = 'error'
      UNION ALL SELECT * FROM ({TO_THE_SECOND}) WHERE event_time_utc < TIMESTAMP '{REDO_START} 00:00:00')
SELECT product_id, user_id, event_time_utc, session_seq, session_event_seq, dt
FROM ({sessions(WIDE_GAP, "SELECT *, row_number() OVER () AS place FROM u", "'job-1'", ORDER + ", event_type, place")})
WHERE dt >= '{REDO_START}' AND dt < '{REDO_END}'
""",
    "state_batches_late": f"""
SELECT count(*) AS input_rows,
       count_if({DAY.format("event_time_utc")} >= '{REDO_START}' AND {DAY.format("event_time_utc")} < '{REDO_END}') AS row_count,
       count_if({DAY.format("event_time_utc")} < '{REDO_START}') AS late_rows,
       count_if({DAY.format("event_time_utc")} >= '{REDO_END}') AS after_range_rows,
       CAST(0 AS BIGINT) AS rejected_rows,
       count_if({DAY.format("event_time_utc")} < '{REDO_START}') AS late_kept
FROM ({TO_THE_SECOND}) WHERE event_time_utc >= TIMESTAMP '{REDO_START} 00:00:00' - INTERVAL 2 DAY
""",
    "state_batches": f"""
SELECT * REPLACE (CASE WHEN dt < '{REDO_START}' THEN 'job-1' ELSE 'job-2' END AS run_id)
FROM ({sessions(WIDE_GAP, TO_THE_SECOND)}) WHERE dt < '{REDO_END}'
""",
    "ledger_latest_state": f"SELECT run_id, status, started_at, {OUTCOME} FROM ({LATEST})",
    "run_outcomes": f"""
WITH planned AS (
    SELECT 'lake-' || CAST(u.user_id AS VARCHAR) || '/' || strftime(d.day, '%Y-%m-%d') AS run_id
    FROM (SELECT DISTINCT user_id FROM events) u,
         (SELECT unnest(generate_series(min(CAST({DAY.format("ts")} AS DATE)),
                                        max(CAST({DAY.format("ts")} AS DATE)), INTERVAL 1 DAY)) AS day
          FROM events) d)
SELECT planned.run_id, {OUTCOME} FROM planned LEFT JOIN ({LATEST}) USING (run_id)
""",
    "redo_days": f"SELECT output, dt FROM ({LATEST}) WHERE status <> 'SUCCESS'",
}
