"""S: scans, sources, sinks and table changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmark.catalog.oracle import AS_OF, CUTOFF, roll
from haulmark.catalog.registry import query
from haulmark.functions import scalars as S
from haulmark.operators import changes
from haulmark.operators.keys import dense_keys, sequence_keys
from haulmark.plans import fixed as X
from haulmark.plans import loads, quality
from haulmark.session import new_path
from haulmark.sources import versions, writes
from haulmark.sources.ledger import Ledger
from haulmark.sources.tables import INPUT_SCHEMAS, scan_csv

_c = F.col


@query("s1_table_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def s1(lake):
    return lake.table("orders").filter(_c("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query("s2_csv_load", "SELECT * FROM part")
def s2(lake):
    path = new_path(lake.spark, "parts-csv")
    lake.table("part").write.option("header", True).csv(path)
    return scan_csv(lake.spark, path, INPUT_SCHEMAS["part"])


@query("s3_inline_rows", """
SELECT t.path_type, t.event_count, t.slot, t.code, k.n AS entities
FROM (SELECT path_type, event_count, count(*) AS n FROM tracked GROUP BY 1, 2) k
JOIN event_template t ON t.path_type = k.path_type AND t.event_count = k.event_count""")
def s3(lake):
    sizes = lake.tracked.groupBy("path_type", "event_count").agg(F.count(F.lit(1)).alias("entities"))
    return lake.event_template.join(sizes, ["path_type", "event_count"])


@query("s4_row_generator", """
SELECT account_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month_start
FROM (SELECT account_id, date_trunc('month', min(created_at)) AS lo, date_trunc('month', max(created_at)) AS hi
      FROM account_shipments GROUP BY 1) s""", dates="month_start")
def s4(lake):
    """One row per account and month between its first and last shipment, without a number table."""
    span = lake.account_shipments.groupBy("account_id").agg(
        F.trunc(F.min("created_at"), "month").alias("lo"), F.trunc(F.max("created_at"), "month").alias("hi"))
    return span.select("account_id", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month_start"))


@query("s5_staged_intermediate", """
SELECT account_id, total, n, total / (SELECT max(total) FROM
  (SELECT sum(line_amount) AS total FROM account_shipments GROUP BY account_id) m) > 0.5 AS above_half
FROM (SELECT account_id, CAST(sum(line_amount) AS DECIMAL(18,2)) AS total, count(*) AS n
      FROM account_shipments GROUP BY 1) t""", money="total")
def s5(lake):
    """Totals are written once because two later steps read them."""
    totals = writes.stage(lake.account_shipments.groupBy("account_id").agg(
        F.sum("line_amount").cast("decimal(18,2)").alias("total"), F.count(F.lit(1)).alias("n")), "account-totals")
    top = totals.agg(F.max("total")).scalar()
    return totals.select("account_id", "total", "n", (_c("total") / top > 0.5).alias("above_half"))


@query("s6_append", f"""
SELECT service_tier, CASE WHEN created_at >= {CUTOFF} THEN 'recent' ELSE 'history' END AS load, count(*) AS n
FROM shipments GROUP BY 1, 2""")
def s6(lake):
    """Two loads appended to one table."""
    path = new_path(lake.spark, "appended")
    recent = _c("created_at") >= F.lit(X.RECENT_CUTOFF).cast("timestamp_ntz")
    rows = lake.shipments.select("shipment_id", "service_tier", "created_at")
    writes.append(rows.filter(~recent).withColumn("load", F.lit("history")), path)
    writes.append(rows.filter(recent).withColumn("load", F.lit("recent")), path)
    return lake.spark.read.parquet(path).groupBy("service_tier", "load").agg(F.count(F.lit(1)).alias("n"))


@query("s7_ordered_insert", """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS insert_key, o_orderkey, o_orderdate FROM orders""")
def s7(lake):
    """The key follows the sort columns, not the order in which tasks happen to write."""
    rows = lake.table("orders").select("o_orderkey", "o_orderdate")
    return dense_keys(rows, ["o_orderdate", "o_orderkey"], "insert_key")


@query("s8_sequence_keys", f"""
SELECT shipment_id, row_number() OVER (ORDER BY created_at >= {CUTOFF}, created_at, shipment_id) AS sequence_key
FROM shipments""")
def s8(lake):
    """Two loads draw from one sequence: the second is numbered behind the first; no gaps, no reuse."""
    rows = writes.stage(lake.shipments.select("shipment_id", "created_at"), "shipment-keys")
    recent = _c("created_at") >= F.lit(X.RECENT_CUTOFF).cast("timestamp_ntz")
    ledger = Ledger(lake.spark, new_path(lake.spark, "ledger"))
    loads_ = [sequence_keys(rows.filter(part), ["created_at", "shipment_id"], "sequence_key", ledger, "shipments", name)
              for name, part in (("history", ~recent), ("recent", recent))]
    return loads_[0].unionByName(loads_[1]).select("shipment_id", "sequence_key")


_SHARED = """
(SELECT 1 AS load_no, 'shipments' AS source, shipment_id AS source_id, created_at AS loaded_at FROM shipments
 UNION ALL SELECT 2, 'packages', package_id, CAST(NULL AS TIMESTAMP) FROM packages
 UNION ALL SELECT 3, 'freight_bills', freight_bill_id, created_at FROM freight_bills
 UNION ALL SELECT 4, 'invoices', invoice_id, CAST(NULL AS TIMESTAMP) FROM invoices) s"""


def _shared_loads(lake):
    """Shipments, packages, bills and invoices numbered from one sequence, in the order in which they are loaded."""
    ledger = Ledger(lake.spark, new_path(lake.spark, "ledger"))
    orders = {"shipments": ("shipment_id", ["created_at"]), "packages": ("package_id", []),
              "freight_bills": ("freight_bill_id", ["created_at"]), "invoices": ("invoice_id", [])}
    rows = [sequence_keys(getattr(lake, name).select(_c(key).alias("source_id"), *first), [*first, "source_id"],
                          "sequence_value", ledger, "tracking_number", name)
            .select(F.lit(name).alias("source"), _c("source_id").cast("long"), "sequence_value")
            for name, (key, first) in orders.items()]
    return ledger, rows


@query("s8_shared_sequence", f"""
SELECT source, source_id, row_number() OVER (ORDER BY load_no, loaded_at, source_id) AS sequence_value FROM {_SHARED}""")
def s8_shared(lake):
    """One number sequence for four tables; every row of each has its own number."""
    _, rows = _shared_loads(lake)
    return rows[0].unionAll(rows[1]).unionAll(rows[2]).unionAll(rows[3])


@query("s8_sequence_ranges", f"""
SELECT source AS load, CAST(sum(n) OVER w - n + 1 AS BIGINT) AS first, CAST(CASE WHEN n > 0 THEN sum(n) OVER w END AS BIGINT) AS last, n
FROM (SELECT load_no, source, count(*) AS n FROM {_SHARED} GROUP BY 1, 2) c WINDOW w AS (ORDER BY load_no)""")
def s8_ranges(lake):
    """What the ledger says about the four loads: disjoint ranges without a gap between them."""
    return _shared_loads(lake)[0].ranges("tracking_number")


@query("s9_source_key_map", """
SELECT row_number() OVER (ORDER BY created_at, shipment_id) AS freight_key, shipment_id, bol_number
FROM freight_bills""")
def s9(lake):
    """New rows and the map from source key to new key come from one numbered frame."""
    numbered = dense_keys(lake.freight_bills.select("shipment_id", "bol_number", "created_at"),
                          ["created_at", "shipment_id"], "freight_key")
    key_map = numbered.select("shipment_id", "freight_key")
    target = numbered.select("freight_key", "bol_number")
    return key_map.join(target, "freight_key")


def _loaded(lake, **tables):
    """A store of versioned tables with these as its first version."""
    store = versions.Store(lake.spark, new_path(lake.spark, "store"))
    change = store.change()
    for name, rows in tables.items():
        change.replace(name, rows)
    change.commit()
    return store


@query("s10_update_from_join", """
SELECT freight_bill_id, bol_number, total_weight_kg, total_pallets FROM freight_bills""", money="total_weight_kg")
def s10(lake):
    """Placeholder totals of the bills are replaced by the sums over their pallets."""
    sums = lake.pallets.groupBy("freight_bill_id").agg(
        F.sum("weight_kg").cast("decimal(10,2)").alias("total_weight_kg"), F.count(F.lit(1)).alias("total_pallets"))
    bills = lake.freight_bills.select(
        "freight_bill_id", "bol_number", F.lit("1.00").cast("decimal(10,2)").alias("total_weight_kg"),
        F.lit(1).cast("long").alias("total_pallets"))
    store = _loaded(lake, bills=bills)
    change = store.change()
    change.update_from("bills", sums, "freight_bill_id", ["total_weight_kg", "total_pallets"])
    change.commit()
    return store.read("bills")


@query("s11_conditional_update", f"""
SELECT shipment_id, CASE WHEN shipment_status = 'Cancelled' THEN 3
  WHEN shipment_status IN ('FailedDelivery', 'Returned') THEN 5
  WHEN shipment_status = 'Delivered' THEN 4
  WHEN created_at >= {CUTOFF} AND shipment_status = 'OutForDelivery' THEN 4
  WHEN created_at >= {CUTOFF} THEN 3 ELSE 0 END AS planned_events
FROM shipments""")
def s11(lake):
    """Updates in sequence: each later rule overrides what an earlier one set."""
    status = _c("shipment_status")
    recent = _c("created_at") >= F.lit(X.RECENT_CUTOFF).cast("timestamp_ntz")
    planned = changes.override(F.lit(0), [
        (recent, F.lit(3)), (recent & (status == "OutForDelivery"), F.lit(4)),
        (status == "Delivered", F.lit(4)), (status.isin("FailedDelivery", "Returned"), F.lit(5)),
        (status == "Cancelled", F.lit(3))])
    rows = lake.shipments.select("shipment_id", "shipment_status", "created_at", F.lit(0).alias("planned_events"))
    store = _loaded(lake, shipments=rows)
    change = store.change()
    change.update("shipments", planned != 0, {"planned_events": planned})
    change.commit()
    return store.read("shipments").select("shipment_id", "planned_events")


@query("s12_delete_where", """
SELECT shipment_id, retail_payment_status FROM shipments
WHERE NOT coalesce(retail_payment_status = 'Paid', FALSE)""")
def s12(lake):
    store = _loaded(lake, shipments=lake.shipments.select("shipment_id", "retail_payment_status"))
    change = store.change()
    change.delete("shipments", _c("retail_payment_status") == "Paid")
    change.commit()
    return store.read("shipments")


@query("s12_versions", """
SELECT version, CASE WHEN version >= 3 AND shipment_id % 2 = 0 THEN coalesce(retail_payment_status, 'None')
  ELSE retail_payment_status END AS status, count(*) AS n
FROM (VALUES (1), (2), (3), (4)) v(version), shipments
WHERE version = 1 OR NOT coalesce(retail_payment_status = 'Paid', FALSE) GROUP BY 1, 2""")
def s12_versions(lake):
    """The payment states of shipments in every version of a table: loaded, reduced, updated and merged."""
    store = _loaded(lake, shipments=lake.shipments.select("shipment_id", _c("retail_payment_status").alias("status")))
    steps = [lambda c: c.delete("shipments", _c("status") == "Paid"),
             lambda c: c.update("shipments", _c("status").isNull() & (_c("shipment_id") % 2 == 0), {"status": F.lit("None")}),
             lambda c: c.merge("shipments")]
    for step in steps:
        change = store.change()
        step(change)
        change.commit()
    seen = [store.read("shipments", v).select(F.lit(v).alias("version"), "status") for v in (1, 2, 3, 4)]
    rows = seen[0].unionAll(seen[1]).unionAll(seen[2]).unionAll(seen[3])
    return rows.groupBy("version", "status").agg(F.count(F.lit(1)).alias("n"))


@query("s13_self_reference", "SELECT facility_code, facility_id, parent_code, parent_facility_id FROM facilities")
def s13(lake):
    first_pass = lake.facilities.select("facility_code", "facility_id", "parent_code")
    return changes.resolve_parent(first_pass, "facility_code", "parent_code", "facility_id", "parent_facility_id")


@query("s14_null_columns", """
SELECT shipment_id, CAST(NULL AS VARCHAR) AS notes, CAST(NULL AS BIGINT) AS sequence_value FROM shipments""")
def s14(lake):
    return changes.with_null_columns(lake.shipments.select("shipment_id"), notes="string", sequence_value="bigint")


@query("s15_default_fill", """
SELECT account_id, coalesce(credit_limit, 0) AS credit_limit, coalesce(status_in, 'Active') AS status_in
FROM (SELECT account_id, credit_limit, CASE WHEN account_status <> 'Active' THEN account_status END AS status_in
      FROM business_accounts) a""", money="credit_limit")
def s15(lake):
    incoming = lake.business_accounts.select(
        "account_id", "credit_limit",
        F.when(_c("account_status") != "Active", _c("account_status")).alias("status_in"))
    return changes.with_defaults(incoming, credit_limit=0, status_in="Active").withColumn(
        "credit_limit", _c("credit_limit").cast("decimal(14,2)"))


@query("s16_publish_load", """
SELECT 'invoices' AS table_name, count(*) AS n, CAST(sum(total_amount) AS DECIMAL(18,2)) AS amount FROM invoices
UNION ALL SELECT 'invoice_lines', count(*), CAST(sum(line_amount) AS DECIMAL(18,2)) FROM invoice_lines
UNION ALL SELECT 'payments', count(*), CAST(sum(amount_paid) AS DECIMAL(18,2)) FROM payments""", money="amount")
def s16(lake):
    """Finance tables are written, checked against themselves and the stored tables they refer to, and published together."""
    store = versions.Store(lake.spark, new_path(lake.spark, "finance"))
    tables = {name: getattr(lake, name) for name in ("invoices", "invoice_lines", "payments")}
    versions.publish(store, tables, lambda staged: quality.count_violations(staged, lake.warehouse))
    amounts = {"invoices": "total_amount", "invoice_lines": "line_amount", "payments": "amount_paid"}
    parts = [store.read(name).agg(
        F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"),
        F.sum(column).cast("decimal(18,2)").alias("amount")) for name, column in amounts.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("s17_write_row_count", """
SELECT 'payments' AS table_name, count(*) AS rows_written FROM payments
UNION ALL SELECT 'freight_bills', count(*) FROM freight_bills""")
def s17(lake):
    """Rows written per statement; an observed metric reports them during the write as well."""
    written = []
    for name in ("payments", "freight_bills"):
        rows, _progress = writes.observed(getattr(lake, name), name)
        written.append((name, writes.counted_write(rows, new_path(lake.spark, name))))
    return lake.spark.createDataFrame(written, "table_name string, rows_written bigint")


@query("s18_ordered_load", " UNION ALL ".join(
    f"SELECT {i} AS stage, '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows_written"
    for i, t in enumerate(loads.LOAD_ORDER, 1)))
def s18(lake):
    """All tables written in dependency order, with the row counts of the committed files."""
    counts = lake.warehouse.load_all()
    rows = [(stage, name, counts[name]) for stage, name in enumerate(loads.LOAD_ORDER, 1)]
    return lake.spark.createDataFrame(rows, "stage int, table_name string, rows_written bigint")


@query("s18_load_verification", """
SELECT 'shipments' AS table_name, 'check:sender' AS rule,
  count(*) FILTER (WHERE (sender_customer_id IS NULL) = (sender_account_id IS NULL)) AS violations FROM shipments
UNION ALL SELECT 'tracking_events', 'reference:operator_id->employees', count(*) FROM staffed_events
  WHERE operator_id IS NOT NULL AND operator_id NOT IN (SELECT employee_id FROM employees)
UNION ALL SELECT 'freight_bills', 'has_pallets', count(*) FROM freight_bills
  WHERE freight_bill_id NOT IN (SELECT freight_bill_id FROM pallets)
UNION ALL SELECT 'tracking_events', 'time_order', count(*) FROM (
  SELECT event_ts, lag(event_ts) OVER (PARTITION BY entity_type, entity_id ORDER BY event_id) AS p FROM tracking_events) e
  WHERE event_ts < p""")
def s18_verification(lake):
    """The verification that follows a load; a load with violations raises."""
    report = quality.verification_report(lake.warehouse, lake.operator_counts, "n_events")
    quality.require_clean(report)
    return report


@query("s19_time_partitioned_log", """
SELECT CAST(ts AS DATE) AS event_day, event_type, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15' GROUP BY 1, 2""", dates="event_day")
def s19(lake):
    """The day filter is answered by partition pruning: other days are not opened."""
    path = new_path(lake.spark, "log-by-day")
    writes.write_by_day(lake.table("events"), "ts", path)
    days = _c("event_day").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-14").cast("date"))
    return (lake.spark.read.parquet(path).filter(days)
            .groupBy("event_day", "event_type").agg(F.count(F.lit(1)).alias("n")))


@query("s20_compaction", """
SELECT shipment_status, count(*) AS n, min(shipment_id) AS lo, max(shipment_id) AS hi FROM shipments GROUP BY 1""")
def s20(lake):
    fragmented, tidy = new_path(lake.spark, "fragmented"), new_path(lake.spark, "compacted")
    lake.shipments.select("shipment_id", "shipment_status").write.option("maxRecordsPerFile", 1000).parquet(fragmented)
    writes.compact(lake.spark, fragmented, tidy, ["shipment_status", "shipment_id"])
    return lake.spark.read.parquet(tidy).groupBy("shipment_status").agg(
        F.count(F.lit(1)).alias("n"), F.min("shipment_id").alias("lo"), F.max("shipment_id").alias("hi"))
