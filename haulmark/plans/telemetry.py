"""Operations telemetry derived from the event stream: sessions, requests, waits, jobs, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.operators.graphs import circles
from haulmark.operators.ordered import latest_by
from haulmark.operators.trees import walk_down
from haulmark.plans import fixed as X
from haulmark.sources.writes import stage

_c = F.col


def seconds(ms: str) -> Column:
    return _c(ms).cast("decimal(18,0)") / F.lit(1000).cast("decimal(4,0)")


def pages_to_mb(pages: str) -> Column:
    """8 KB pages to MB: 1/128 each, which seven decimals hold exactly."""
    return _c(pages).cast("decimal(18,0)") * F.lit("0.0078125").cast("decimal(8,7)")


def scans(lake) -> DataFrame:
    """Events with the number from their properties; ``late_ts`` sends every 17th event two days back."""
    return lake.table("events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
        F.when(_c("event_id") % 17 == 0, _c("ts") - F.expr("INTERVAL 2 DAY")).otherwise(_c("ts")).alias("late_ts"))


# ------------------------------------------------------------------------------ sessions and requests
def sessions(lake) -> DataFrame:
    """One row per connected session, taken from the log once."""
    return lake.once("sessions", lambda: derive_sessions(lake))


def requests(lake) -> DataFrame:
    """The running request of each session that has one, taken from the log once."""
    return lake.once("requests", lambda: derive_requests(lake))


def sql_texts(lake) -> DataFrame:
    return lake.once("sql-texts", lambda: scans(lake).select(_c("k").alias("sql_id")).distinct().withColumn(
        "sql_text", F.concat(F.lit("SELECT "), _c("sql_id").cast("string"))))


def derive_sessions(lake) -> DataFrame:
    """The newest statement of a session comes from its newest event."""
    newest = latest_by(scans(lake), ["user_id"], ["event_id"], ["k"])
    u = _c("user_id")
    return newest.select(
        u.alias("session_id"), F.concat(F.lit("user_"), u.cast("string")).alias("login_name"),
        F.concat(F.lit("host-"), (u % 20).cast("string")).alias("host_name"),
        F.concat(F.lit("app-"), (u % 5).cast("string")).alias("program_name"),
        (u % 10 != 0).alias("is_user_process"), _c("k").alias("most_recent_sql_id"))


def derive_requests(lake) -> DataFrame:
    """The newest event of a session is its running request; a third of the sessions are idle."""
    u, k = _c("user_id"), _c("k")
    newest = latest_by(scans(lake).filter(u % 3 != 0), ["user_id"], ["event_id"], ["event_type", "value", "k"])
    wait = F.round(_c("value") * 1000).cast("long")
    return newest.select(
        u.alias("session_id"), F.when(k % 2 == 0, "running").otherwise("suspended").alias("status"),
        F.concat(F.lit("LCK_M_"), F.upper("event_type")).alias("wait_type"), wait.alias("wait_time_ms"),
        F.when(u % 4 != 0, F.expr("user_id div 3")).otherwise(F.lit(0)).alias("blocking_session_id"),
        (k * 10).cast("long").alias("cpu_time_ms"), (wait + k * 500).alias("total_elapsed_ms"),
        (k * 100).cast("long").alias("logical_reads"), k.alias("sql_id"))


def with_text(lake, rows: DataFrame, sql_id: str = "sql_id", text: str = "sql_text") -> DataFrame:
    """Statement text of a handle, as an equi join."""
    texts = sql_texts(lake).select(_c("sql_id").alias(sql_id), _c("sql_text").alias(text))
    return rows.join(texts, sql_id)


def session_requests(lake) -> DataFrame:
    return sessions(lake).join(requests(lake), "session_id", "left")


def blocking_pairs(lake) -> DataFrame:
    """Blocked request, blocked session, blocking session, and the statements of both."""
    blocked = requests(lake).filter("blocking_session_id > 0")
    blocker = sessions(lake).select(_c("session_id").alias("blocking_session_id"),
                                    _c("most_recent_sql_id").alias("blocker_sql_id"))
    pairs = blocked.join(blocker, "blocking_session_id").join(
        sessions(lake).select("session_id"), "session_id")
    return with_text(lake, with_text(lake, pairs, "sql_id", "blocked_sql"), "blocker_sql_id", "blocking_sql")


def head_blockers(edges: DataFrame) -> DataFrame:
    """Head of every blocking chain: session_id, head_session, depth. ``edges`` has session_id and blocking_session_id (> 0).

    A chain that ends in a circle, a deadlock, has the circle for its head, named by its least session; the sessions on
    the circle have depth 0. Only sessions that no free session blocks are searched for circles.
    """
    blocked = edges.filter("blocking_session_id > 0").select("session_id", "blocking_session_id")
    heads = blocked.select(_c("blocking_session_id").alias("session_id")).distinct().join(
        blocked, "session_id", "left_anti")
    nodes = blocked.select(_c("session_id").alias("node"), _c("blocking_session_id").alias("parent")).unionAll(
        heads.select("session_id", F.lit(None).cast("long")))
    walk = walk_down(nodes, "node", "parent").select(
        _c("node").alias("session_id"), _c("root").alias("head_session"), "depth")
    waiting = stage(blocked.join(walk, "session_id", "left_anti"), "waiting")
    if not waiting.limit(1).count():
        return walk
    ring = stage(circles(waiting, "session_id", "blocking_session_id"), "deadlocks")
    below = waiting.join(ring, waiting["session_id"] == ring["node"], "left_anti")
    hung = walk_down(ring.select("node", F.lit(None).cast("long").alias("parent"))
                     .unionAll(below.select("session_id", "blocking_session_id")), "node", "parent")
    named = ring.select(_c("node").alias("root"), _c("circle").alias("head_session"))
    return walk.unionAll(hung.join(named, "root").select(_c("node").alias("session_id"), "head_session", "depth"))


def statement_waits(lake) -> DataFrame:
    """Who waits for whom at the end of each day: session_id and blocking_session_id.

    The newest event of a user on a day holds its statement, and the one before wants its own; the user whose
    newest event holds that statement last is in the way. A session is a user's day.
    """
    day = F.date_diff(F.to_date("ts"), F.lit("2000-01-01").cast("date")).cast("long") * 1_000_000_000
    rows = scans(lake).select((day + _c("user_id")).alias("session_id"), day.alias("day"), "event_id", "k")
    held = rows.groupBy("session_id", "day").agg(F.max(F.struct("event_id", "k")).alias("newest")).select(
        "session_id", "day", "newest.event_id", "newest.k")
    wanted = (rows.join(held.select(_c("event_id").alias("last_id")), _c("event_id") == _c("last_id"), "left_anti")
              .groupBy("session_id", "day").agg(F.max(F.struct("event_id", "k"))["k"].alias("k")))
    holder = held.groupBy("day", "k").agg(F.max(F.struct("event_id", "session_id"))["session_id"].alias("blocking_session_id"))
    return wanted.join(holder, ["day", "k"]).filter("session_id <> blocking_session_id").select("session_id", "blocking_session_id")


# ------------------------------------------------------------------------------ waits
def wait_type() -> Column:
    kind = (F.when(_c("event_type") == "error", "PAGEIOLATCH_").when(_c("event_type") == "click", "LCK_M_")
            .when(_c("event_type") == "view", "CXPACKET_").when(_c("event_type") == "purchase", "SOS_YIELD_"))
    return F.when(_c("event_type") == "signup", "SLEEP_TASK").otherwise(F.concat(kind, (_c("k") % 10).cast("string")))


def waits(lake) -> DataFrame:
    ms = F.round(_c("value") * 1000).cast("long")
    return scans(lake).groupBy(wait_type().alias("wait_type")).agg(
        F.count(F.lit(1)).alias("waiting_tasks"), F.sum(ms).alias("wait_ms"), F.max(ms).alias("max_wait_ms"),
        F.sum(_c("k").cast("long")).alias("signal_wait_ms"))


def top_waits(rows: DataFrame, limit: int = 20, benign: list[str] = X.BENIGN_WAITS) -> DataFrame:
    return (rows.filter(~_c("wait_type").isin(*benign))
            .orderBy(_c("wait_ms").desc(), "wait_type").limit(limit)
            .select("wait_type", "waiting_tasks", seconds("wait_ms").alias("total_wait_seconds"),
                    seconds("max_wait_ms").alias("max_wait_seconds"),
                    ((_c("wait_ms") - _c("signal_wait_ms")).cast("decimal(18,0)")
                     / F.lit(1000).cast("decimal(4,0)")).alias("resource_wait_seconds")))


# ------------------------------------------------------------------------------ jobs
def jobs(lake) -> DataFrame:
    return lake.table("nation").select(_c("n_nationkey").cast("long").alias("job_id"),
                                       F.concat(F.lit("job_"), _c("n_name")).alias("job_name"))


def job_history(lake) -> DataFrame:
    stamp = F.date_format("ts", "yyyyMMdd").cast("int"), F.date_format("ts", "HHmmss").cast("int")
    return scans(lake).select(
        "event_id", (_c("user_id") % 25).alias("job_id"), (_c("event_id") % 4).alias("step_id"),
        stamp[0].alias("run_date"), stamp[1].alias("run_time"), _c("k").alias("run_duration"),
        (_c("k") % 5).alias("status_code"), _c("event_type").alias("message"))


def job_outcomes(lake) -> DataFrame:
    """Step 0 is the outcome of the whole job."""
    status = (F.when(_c("status_code") == 1, "Succeeded").when(_c("status_code") == 0, "Failed")
              .when(_c("status_code") == 3, "Cancelled").otherwise("Other"))
    return (job_history(lake).filter("step_id = 0").join(jobs(lake), "job_id")
            .withColumn("run_status", status))


# ------------------------------------------------------------------------------ logs, error shares
def server_log(lake) -> DataFrame:
    text = F.when(_c("event_type") == "error",
                  F.concat(F.lit("Login failed for user_"), _c("user_id").cast("string"))) \
            .otherwise(F.concat(F.lit("Completed "), _c("event_type")))
    return scans(lake).select("event_id", _c("ts").alias("logged_at"), _c("event_type").alias("source"),
                              (_c("k") % 26).alias("severity"), text.alias("message"))


def log_search(log: DataFrame, text: str | None = None) -> DataFrame:
    """All entries, or those that hold a text; case does not matter."""
    return log if text is None else log.filter(F.lower("message").contains(text.lower()))


def error_shares(lake, key: Column, name: str) -> DataFrame:
    """Events and errors per key; a key stands out where its share of errors is over that of the whole log."""
    counted = lake.table("events").groupBy(key.alias(name)).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(_c("event_type") == "error").alias("n_errors"))
    whole = counted.agg(F.sum("n_events").alias("all_events"), F.sum("n_errors").alias("all_errors"))
    return counted.select(name, "n_events", "n_errors", F.expr("n_errors * 100 div n_events").alias("error_pct"),
                          (_c("n_errors") * whole.select("all_events").scalar()
                           > _c("n_events") * whole.select("all_errors").scalar()).alias("over_average"))


def error_bursts(lake) -> DataFrame:
    """Hours in which a user met errors: how many, the first and the last, and the largest value."""
    return (lake.table("events").filter(_c("event_type") == "error")
            .groupBy("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
            .agg(F.count(F.lit(1)).alias("n_errors"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"),
                 F.max("value").alias("largest")))


# ------------------------------------------------------------------------------ deadlock graphs in XML
DEADLOCK_EVENT = "xml_deadlock_report"


def deadlocks(ring_buffers: DataFrame, xml: Column, key: str) -> DataFrame:
    """One row per deadlock report: the event nodes are cut out and exploded, then parsed once each.

    The text test only spares nodes the parser; the parsed name decides.
    """
    nodes = F.regexp_extract_all(xml, F.lit(r"(?s)(<event\b[^>]*?(?:/>|>.*?</event>))"), F.lit(1))
    parsed = F.from_xml("node", "_name string, _timestamp string")
    return (ring_buffers.select(key, F.explode(nodes).alias("node"))
            .filter(_c("node").contains(DEADLOCK_EVENT))
            .withColumn("event", parsed)
            .filter(_c("event._name") == DEADLOCK_EVENT)
            .select(key,
                    F.to_timestamp_ntz("event._timestamp", F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("deadlock_time"),
                    _c("node").alias("deadlock_graph")))


# ------------------------------------------------------------------------------ returns
def returns(lake) -> DataFrame:
    """Lines of each supplier, and the share that came back."""
    return lake.table("lineitem").groupBy(_c("l_suppkey").alias("supplier_id")).agg(
        F.count(F.lit(1)).alias("line_count"), F.count_if(_c("l_returnflag") == "R").alias("returned")).select(
        "supplier_id", "line_count", F.expr("returned * 100 div line_count").alias("return_pct"))


def returns_advice(rows: DataFrame) -> DataFrame:
    pct = _c("return_pct")
    return rows.withColumn("advice", F.when(pct >= X.RETURNS_ACT, "act").when(pct >= X.RETURNS_WATCH, "watch").otherwise("none"))


def part_lines(lake) -> DataFrame:
    """Lines and quantity of each part."""
    return lake.table("lineitem").groupBy(_c("l_partkey").alias("part_id")).agg(
        F.count(F.lit(1)).alias("line_count"), F.sum(_c("l_quantity").cast("decimal(18,2)")).alias("quantity"),
        F.max("l_linenumber").alias("last_line"))


# ------------------------------------------------------------------------------ principals
ROLE_BASE = 10**12


def principals(lake) -> DataFrame:
    """Users, groups and roles in one table."""
    s = _c("s_suppkey")
    users = lake.table("supplier").select(
        s.alias("principal_id"), _c("s_name").alias("principal_name"),
        F.when(s % 4 == 1, "U").when(s % 4 == 2, "G").otherwise("S").alias("kind"))
    roles = lake.table("nation").select(
        (F.lit(ROLE_BASE) + _c("n_nationkey")).alias("principal_id"), _c("n_name").alias("principal_name"),
        F.lit("R").alias("kind"))
    return users.unionByName(roles)


def role_members(lake) -> DataFrame:
    s = _c("s_suppkey")
    roles = F.array_distinct(F.array(_c("s_nationkey").cast("long"), s % 25))
    return lake.table("supplier").select(
        s.alias("member_id"), F.explode(roles).alias("n")).select(
        "member_id", (F.lit(ROLE_BASE) + _c("n")).alias("role_id"))


def role_audit(members: DataFrame, people: DataFrame) -> DataFrame:
    """Role memberships of real users; the principals are joined twice, as member and as role."""
    user = people.filter(_c("kind").isin("S", "U")).select(
        _c("principal_id").alias("member_id"), _c("principal_name").alias("user_name"))
    role = people.select(_c("principal_id").alias("role_id"), _c("principal_name").alias("role_name"))
    return members.join(user, "member_id").join(role, "role_id").select("user_name", "role_name")
