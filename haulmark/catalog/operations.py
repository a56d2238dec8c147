"""T: operations telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmark.catalog.oracle import text_list
from haulmark.catalog.registry import query
from haulmark.operators.graphs import circles
from haulmark.operators.ordered import latest_by
from haulmark.plans import fixed as X
from haulmark.plans import telemetry

_c = F.col
SECONDS = "CAST({} AS DECIMAL(18,0)) * 0.001"


@query("t1_active_requests", f"""
SELECT r.session_id, r.status, r.wait_type, {SECONDS.format('r.wait_time_ms')} AS wait_seconds, r.blocking_session_id,
  r.cpu_time_ms, {SECONDS.format('r.total_elapsed_ms')} AS elapsed_seconds, t.sql_text
FROM requests r JOIN sql_texts t ON t.sql_id = r.sql_id WHERE r.session_id > 50""", money="wait_seconds elapsed_seconds")
def t1(lake):
    rows = telemetry.requests(lake).filter(_c("session_id") > 50)
    return telemetry.with_text(lake, rows).select(
        "session_id", "status", "wait_type", telemetry.seconds("wait_time_ms").alias("wait_seconds"),
        "blocking_session_id", "cpu_time_ms", telemetry.seconds("total_elapsed_ms").alias("elapsed_seconds"), "sql_text")


_SESSIONS_SQL = f"""
SELECT s.session_id, s.login_name, s.host_name, s.program_name, r.status, r.wait_type, r.blocking_session_id,
  {SECONDS.format('r.total_elapsed_ms')} AS elapsed_seconds
FROM sessions s LEFT JOIN requests r ON s.session_id = r.session_id"""


def _sessions(lake):
    return telemetry.session_requests(lake).select(
        "session_id", "login_name", "host_name", "program_name", "is_user_process", "status", "wait_type",
        "blocking_session_id", telemetry.seconds("total_elapsed_ms").alias("elapsed_seconds"))


@query("t2_sessions_and_requests", _SESSIONS_SQL + " WHERE s.is_user_process", money="elapsed_seconds")
def t2(lake):
    return _sessions(lake).filter("is_user_process").drop("is_user_process")


@query("t3_database_states", """
SELECT s_name AS name, s_nationkey AS nation_id, CASE WHEN s_acctbal < 0 THEN 'overdrawn' WHEN s_acctbal < 1000 THEN 'low'
  WHEN s_acctbal IS NULL THEN 'unknown' ELSE 'in credit' END AS state FROM supplier""")
def t3(lake):
    """State of each supplier's account, by its balance."""
    state = (F.when(_c("s_acctbal") < 0, "overdrawn").when(_c("s_acctbal") < X.LOW_BALANCE, "low")
             .when(_c("s_acctbal").isNull(), "unknown").otherwise("in credit"))
    return lake.table("supplier").select(_c("s_name").alias("name"), _c("s_nationkey").alias("nation_id"), state.alias("state"))


@query("t4_top_waits", f"""
SELECT wait_type, waiting_tasks, {SECONDS.format('wait_ms')} AS total_wait_seconds,
  {SECONDS.format('max_wait_ms')} AS max_wait_seconds, {SECONDS.format('(wait_ms - signal_ms)')} AS resource_wait_seconds
FROM (SELECT CASE event_type WHEN 'signup' THEN 'SLEEP_TASK'
               WHEN 'error' THEN 'PAGEIOLATCH_' || CAST(k % 10 AS VARCHAR) WHEN 'click' THEN 'LCK_M_' || CAST(k % 10 AS VARCHAR)
               WHEN 'view' THEN 'CXPACKET_' || CAST(k % 10 AS VARCHAR)
               WHEN 'purchase' THEN 'SOS_YIELD_' || CAST(k % 10 AS VARCHAR) END AS wait_type,
        count(*) AS waiting_tasks, sum(CAST(round(value * 1000) AS BIGINT)) AS wait_ms,
        max(CAST(round(value * 1000) AS BIGINT)) AS max_wait_ms, sum(k) AS signal_ms FROM scans GROUP BY 1) w
WHERE wait_type NOT IN ({text_list(X.BENIGN_WAITS)}) ORDER BY wait_ms DESC, wait_type LIMIT 20""",
       money="total_wait_seconds max_wait_seconds resource_wait_seconds")
def t4(lake):
    return telemetry.top_waits(telemetry.waits(lake))


@query("t5_blocking_pairs", f"""
SELECT b.session_id AS blocked_session, b.blocking_session_id AS blocking_session, bt.sql_text AS blocked_sql,
  kt.sql_text AS blocking_sql, b.wait_type, {SECONDS.format('b.wait_time_ms')} AS wait_seconds
FROM requests b JOIN sessions s ON s.session_id = b.session_id JOIN sessions k ON k.session_id = b.blocking_session_id
JOIN sql_texts bt ON bt.sql_id = b.sql_id JOIN sql_texts kt ON kt.sql_id = k.most_recent_sql_id
WHERE b.blocking_session_id > 0""", money="wait_seconds")
def t5(lake):
    return telemetry.blocking_pairs(lake).select(
        _c("session_id").alias("blocked_session"), _c("blocking_session_id").alias("blocking_session"),
        "blocked_sql", "blocking_sql", "wait_type", telemetry.seconds("wait_time_ms").alias("wait_seconds"))


@query("t6_head_blockers", """
WITH RECURSIVE blocked AS (SELECT session_id, blocking_session_id AS blocker FROM requests WHERE blocking_session_id > 0),
walk AS (
  SELECT DISTINCT blocker AS session_id, blocker AS head_session, 0 AS depth FROM blocked
  WHERE blocker NOT IN (SELECT session_id FROM blocked)
  UNION ALL
  SELECT b.session_id, w.head_session, w.depth + 1 FROM blocked b JOIN walk w ON b.blocker = w.session_id)
SELECT * FROM walk""")
def t6(lake):
    return telemetry.head_blockers(telemetry.requests(lake))


_WAITING_SQL = """
WITH RECURSIVE places AS (
  SELECT CAST(datediff('day', DATE '2000-01-01', CAST(ts AS DATE)) AS BIGINT) * 1000000000 + user_id AS session_id,
    CAST(ts AS DATE) AS day, event_id, k,
    row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) AS age FROM scans),
holders AS (SELECT day, k, max_by(session_id, event_id) AS holder FROM places WHERE age = 1 GROUP BY 1, 2),
blocked AS (SELECT session_id, holder AS blocker FROM places JOIN holders USING (day, k) WHERE age = 2 AND session_id <> holder),
reach AS (SELECT session_id, blocker FROM blocked UNION SELECT r.session_id, b.blocker FROM reach r JOIN blocked b ON r.blocker = b.session_id),
circle AS (SELECT a.session_id, min(a.blocker) AS head, count(*) AS members FROM reach a JOIN reach b
  ON a.session_id = b.blocker AND a.blocker = b.session_id GROUP BY 1)"""


@query("t6_deadlocks", f"{_WAITING_SQL} SELECT head AS circle, session_id, members FROM circle")
def t6_deadlocks(lake):
    """Every circle of sessions that wait for each other, with its members."""
    found = circles(telemetry.statement_waits(lake), "session_id", "blocking_session_id")
    return found.select("circle", _c("node").alias("session_id"), "members")


@query("t6_waiting_heads", f"""{_WAITING_SQL},
walk AS (
  SELECT session_id, head AS head_session, 0 AS depth FROM circle
  UNION ALL SELECT DISTINCT blocker, blocker, 0 FROM blocked WHERE blocker NOT IN (SELECT session_id FROM blocked)
  UNION ALL SELECT b.session_id, w.head_session, w.depth + 1 FROM blocked b JOIN walk w ON b.blocker = w.session_id
    WHERE b.session_id NOT IN (SELECT session_id FROM circle))
SELECT * FROM walk""")
def t6_waiting_heads(lake):
    """Head and depth of every waiting session; a deadlock is the head of what waits for it."""
    return telemetry.head_blockers(telemetry.statement_waits(lake))


_HISTORY_SQL = """
(SELECT event_id, 'job_' || n_name AS job_name, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS run_date,
   CAST(strftime(ts, '%H%M%S') AS INTEGER) AS run_time, k AS run_duration,
   CASE k % 5 WHEN 1 THEN 'Succeeded' WHEN 0 THEN 'Failed' WHEN 3 THEN 'Cancelled' ELSE 'Other' END AS run_status,
   event_type AS message
 FROM scans JOIN nation ON n_nationkey = user_id % 25 WHERE event_id % 4 = 0) h"""


@query("t7_job_outcomes", f"""
SELECT job_name, run_date, run_time, run_duration, run_status, message FROM {_HISTORY_SQL}
ORDER BY run_date DESC, run_time DESC""")
def t7(lake):
    return telemetry.job_outcomes(lake).select(
        "job_name", "run_date", "run_time", "run_duration", "run_status", "message").orderBy(
        _c("run_date").desc(), _c("run_time").desc())


@query("t8_last_run_per_job", f"""
SELECT job_name, run_date, run_time, run_status FROM (
  SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY run_date DESC, run_time DESC, event_id DESC) AS r
  FROM {_HISTORY_SQL}) x WHERE r = 1""")
def t8(lake):
    return latest_by(telemetry.job_outcomes(lake), ["job_name"], ["run_date", "run_time", "event_id"],
                     ["run_date", "run_time", "run_status"])


_LOG_SQL = """
(SELECT event_id, ts AS logged_at, k % 26 AS severity,
   CASE WHEN event_type = 'error' THEN 'Login failed for user_' || CAST(user_id AS VARCHAR)
        ELSE 'Completed ' || event_type END AS message FROM scans) g"""


@query("t9_log_all", f"SELECT logged_at, severity, message FROM {_LOG_SQL}")
def t9(lake):
    return telemetry.log_search(telemetry.server_log(lake)).select("logged_at", "severity", "message")


@query("t9_log_by_text", f"SELECT logged_at, message FROM {_LOG_SQL} WHERE message ILIKE '%login failed%'")
def t9_text(lake):
    return telemetry.log_search(telemetry.server_log(lake), "login failed").select("logged_at", "message")


_SHARES_SQL = """
SELECT {0}, n_events, n_errors, n_errors * 100 // n_events AS error_pct,
  n_errors * sum(n_events) OVER () > n_events * sum(n_errors) OVER () AS over_average
FROM (SELECT {1} AS {0}, count(*) AS n_events, count(*) FILTER (WHERE event_type = 'error') AS n_errors
      FROM events GROUP BY 1) c"""


@query("t10_page_life", _SHARES_SQL.format("sample_day", "CAST(ts AS DATE)"), dates="sample_day")
def t10(lake):
    """Health of each day: its share of errors."""
    return telemetry.error_shares(lake, F.to_date("ts"), "sample_day")


@query("t11_scheduler_pressure", _SHARES_SQL.format("user_id", "user_id"))
def t11(lake):
    """Pressure by user: the share of errors."""
    return telemetry.error_shares(lake, _c("user_id"), "user_id")


@query("t12_deadlock_graphs", """
SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n_errors, min(event_id) AS first_event, max(event_id) AS last_event,
  max(value) AS largest FROM events WHERE event_type = 'error' GROUP BY 1, 2""")
def t12(lake):
    return telemetry.error_bursts(lake)


@query("t13_long_running", f"""
SELECT r.session_id, r.status, {SECONDS.format('r.total_elapsed_ms')} AS elapsed_seconds,
  {SECONDS.format('r.cpu_time_ms')} AS cpu_seconds, r.logical_reads, r.wait_type, t.sql_text
FROM requests r JOIN sql_texts t ON t.sql_id = r.sql_id WHERE r.total_elapsed_ms > 30000
ORDER BY r.total_elapsed_ms DESC, r.session_id""", money="elapsed_seconds cpu_seconds")
def t13(lake):
    rows = telemetry.requests(lake).filter(_c("total_elapsed_ms") > X.LONG_RUNNING_MS)
    return telemetry.with_text(lake, rows).orderBy(_c("total_elapsed_ms").desc(), "session_id").select(
        "session_id", "status", telemetry.seconds("total_elapsed_ms").alias("elapsed_seconds"),
        telemetry.seconds("cpu_time_ms").alias("cpu_seconds"), "logical_reads", "wait_type", "sql_text")


@query("t14_fragmentation_advice", """
SELECT *, CASE WHEN return_pct >= 34 THEN 'act' WHEN return_pct >= 20 THEN 'watch' ELSE 'none' END AS advice
FROM (SELECT l_suppkey AS supplier_id, count(*) AS line_count, count(*) FILTER (WHERE l_returnflag = 'R') * 100 // count(*) AS return_pct
      FROM lineitem GROUP BY 1) s
ORDER BY return_pct DESC, supplier_id""")
def t14(lake):
    """Advice on suppliers by the share of lines that came back."""
    return telemetry.returns_advice(telemetry.returns(lake)).orderBy(_c("return_pct").desc(), "supplier_id")


@query("t15_file_sizes", """
SELECT l_partkey AS part_id, count(*) AS line_count, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS quantity,
  max(l_linenumber) AS last_line FROM lineitem GROUP BY 1""", money="quantity")
def t15(lake):
    """Lines and quantity of each part."""
    return telemetry.part_lines(lake)


@query("t16_role_audit", """
SELECT u.s_name AS user_name, n.n_name AS role_name FROM supplier u
JOIN nation n ON n.n_nationkey = u.s_nationkey OR n.n_nationkey = u.s_suppkey % 25
WHERE u.s_suppkey % 4 <> 2""")
def t16(lake):
    return telemetry.role_audit(telemetry.role_members(lake), telemetry.principals(lake))


@query("t17_session_listing", _SESSIONS_SQL, money="elapsed_seconds")
def t17(lake):
    return _sessions(lake).drop("is_user_process")
