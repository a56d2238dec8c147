"""B: business derivations."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmark.catalog.oracle import AS_OF, bands, pad, roll
from haulmark.catalog.registry import query
from haulmark.functions import scalars as S
from haulmark.operators.joins import range_join
from haulmark.operators.trees import walk_down
from haulmark.plans import billing, people
from haulmark.plans import fixed as X
from haulmark.session import new_path
from haulmark.sources.layout import Clustered

_c = F.col
TIER_BANDS_SQL = bands(roll("shipment_id", 19, 4), [(25, 1), (55, 2), (80, 3), (92, 4)], 5)

QUOTES = """
(SELECT p.package_id, p.service_tier, p.created_at, greatest(actual_weight_kg, dim_weight_kg) AS billable_kg,
        CAST(r.base_rate + r.per_kg * greatest(actual_weight_kg, dim_weight_kg) AS DECIMAL(12,4)) AS quote
 FROM packages p LEFT JOIN rate_cards r ON r.service_tier = p.service_tier AND r.zone_id = p.origin_nation
  AND r.effective_from <= CAST(p.created_at AS DATE)
  AND (r.effective_to IS NULL OR CAST(p.created_at AS DATE) <= r.effective_to)
  AND greatest(actual_weight_kg, dim_weight_kg) BETWEEN r.min_weight_kg AND r.max_weight_kg) q"""


@query("revenue_by_tier_and_month", f"""
SELECT service_tier, CAST(date_trunc('month', created_at) AS DATE) AS month, count(*) AS packages,
       CAST(sum(billable_kg) AS DECIMAL(18,2)) AS billable_kg, CAST(sum(quote) AS DECIMAL(18,2)) AS revenue
FROM {QUOTES} GROUP BY 1, 2""", money="billable_kg revenue", dates="month")
def revenue(lake):
    return (billing.package_quotes(lake)
            .groupBy("service_tier", F.to_date(F.date_trunc("month", "created_at")).alias("month"))
            .agg(F.count(F.lit(1)).alias("packages"),
                 F.sum("billable_kg").cast("decimal(18,2)").alias("billable_kg"),
                 F.sum("quote").cast("decimal(18,2)").alias("revenue")))


@query("b1_dimensional_weight", """
SELECT package_id, length_cm, width_cm, height_cm, dim_weight_kg FROM packages""",
       money="length_cm width_cm height_cm dim_weight_kg")
def b1(lake):
    return lake.packages.select("package_id", "length_cm", "width_cm", "height_cm", "dim_weight_kg")


@query("b2_billable_weight", """
SELECT package_id, greatest(actual_weight_kg, dim_weight_kg) AS billable_kg FROM packages""", money="billable_kg")
def b2(lake):
    return lake.derive("packages").select(
        "package_id", S.billable_weight(_c("actual_weight_kg"), _c("dim_weight_kg")).alias("billable_kg"))


@query("b3_tracking_number", """
SELECT shipment_id, tracking_number, left(service_tier, 1) AS tier_code, CAST(created_at AS DATE) AS ship_date,
  CAST(hour(created_at) AS INTEGER) AS ship_hour, CAST((shipment_id + 1) % 100000 AS INTEGER) AS sequence FROM shipments""",
       dates="ship_date")
def b3(lake):
    """Made on the shipment side, decoded from the number alone."""
    number = _c("tracking_number")
    return lake.shipments.select("shipment_id", number, *[
        part.alias(name) for name, part in S.tracking_parts(number).items()])


@query("b4_document_numbers", """
SELECT 'bill' AS kind, bol_number AS number FROM freight_bills UNION ALL SELECT 'invoice', invoice_number FROM invoices
UNION ALL SELECT 'payment', payment_reference FROM payments""")
def b4(lake):
    return (lake.freight_bills.select(F.lit("bill").alias("kind"), _c("bol_number").alias("number"))
            .unionAll(lake.invoices.select(F.lit("invoice"), "invoice_number"))
            .unionAll(lake.payments.select(F.lit("payment"), "payment_reference")))


@query("b5_route_code", "SELECT route_id, route_code, service_tier, transit_days FROM routes")
def b5(lake):
    return lake.routes.select("route_id", "route_code", "service_tier", "transit_days")


@query("b6_shipment_class", """
SELECT shipment_id, service_tier, origin_country || '-' || dest_country AS lane, is_cross_border,
  CASE WHEN sender_account_id IS NULL THEN 'Customer' ELSE 'Business' END AS sender_type FROM shipments""")
def b6(lake):
    return lake.shipments.select(
        "shipment_id", "service_tier", F.concat_ws("-", "origin_country", "dest_country").alias("lane"),
        "is_cross_border",
        F.when(_c("sender_account_id").isNull(), "Customer").otherwise("Business").alias("sender_type"))


@query("b7_lane_resolution", """
SELECT shipment_id, origin_nation, dest_nation, origin_address_id, dest_address_id FROM shipments""")
def b7(lake):
    return lake.shipments.select("shipment_id", "origin_nation", "dest_nation", "origin_address_id", "dest_address_id")


@query("b8_status_by_age", """
SELECT service_tier, shipment_status, package_status, created_at >= TIMESTAMP '2001-07-01' AS recent, count(*) AS n
FROM packages GROUP BY 1, 2, 3, 4""")
def b8(lake):
    recent = (_c("created_at") >= F.lit(X.RECENT_CUTOFF).cast("timestamp_ntz")).alias("recent")
    return lake.packages.groupBy("service_tier", "shipment_status", "package_status", recent).agg(
        F.count(F.lit(1)).alias("n"))


@query("b9_conditional_fields", """
SELECT shipment_id, customs_value, customs_currency, duties_amount, customs_cleared_at, retail_payment_status,
  retail_payment_method, retail_amount, retail_currency FROM shipments""", money="customs_value duties_amount retail_amount")
def b9(lake):
    return lake.shipments.select("shipment_id", "customs_value", "customs_currency", "duties_amount",
                                 "customs_cleared_at", "retail_payment_status", "retail_payment_method",
                                 "retail_amount", "retail_currency")


@query("b10_package_fan_out", f"""
SELECT shipment_id, t.n AS package_slot FROM shipments JOIN (VALUES (1), (2), (3), (4), (5)) t(n)
  ON t.n <= {TIER_BANDS_SQL} WHERE service_tier <> 'Freight'""")
def b10(lake):
    """One to five packages per parcel shipment, by a weighted class of its key."""
    count = S.weighted(S.bucket(_c("shipment_id"), 19, 4), [(25, 1), (55, 2), (80, 3), (92, 4)], 5)
    return lake.shipments.filter(_c("service_tier") != "Freight").select(
        "shipment_id", F.explode(F.sequence(F.lit(1), count)).alias("package_slot"))


@query("b11_pallet_rollup", """
SELECT freight_bill_id, bol_number, total_weight_kg, total_pallets, hazmat FROM freight_bills""", money="total_weight_kg")
def b11(lake):
    return lake.freight_bills.select("freight_bill_id", "bol_number", "total_weight_kg", "total_pallets", "hazmat")


@query("b12_event_paths", """
SELECT entity_type, entity_id, slot, CASE WHEN code = 'FINAL' THEN final_code ELSE code END AS event_code
FROM event_rows""")
def b12(lake):
    """Path expansion by joining the template rows (25 literal rows, so Spark broadcasts them)."""
    return lake.tracked.join(lake.event_template, ["path_type", "event_count"]).select(
        "entity_type", "entity_id", "slot",
        F.when(_c("code") == "FINAL", _c("final_code")).otherwise(_c("code")).alias("event_code"))


@query("b13_event_facility_operator", """
SELECT event_id, event_code, facility_id, operator_id FROM staffed_events""")
def b13(lake):
    return lake.staffed_events.select("event_id", "event_code", "facility_id", "operator_id")


@query("b14_event_timeline", """
SELECT entity_type, event_id, event_code, event_ts FROM tracking_events""")
def b14(lake):
    """Derived here from packages and pallets rather than read from the stored log."""
    return lake.derive_tracking_events().select("entity_type", "event_id", "event_code", "event_ts")


@query("b14_timeline_by_running_sum", """
SELECT entity_type, entity_id, slot,
  CAST(sum(hours) OVER (PARTITION BY entity_type, entity_id ORDER BY slot) AS BIGINT) AS cum_hours FROM event_rows""")
def b14_window(lake):
    """The same hours as a running sum over expanded events, with the rule written per event code."""
    first = _c("entity_id") * 10 + F.when(_c("entity_type") == "Pallet", F.lit(10**15)).otherwise(F.lit(0))
    code, slot, tier, e = _c("code"), _c("slot"), _c("service_tier"), (first + _c("slot")) * 13 + 5
    haul = F.when(tier == "Ground", e % 49 + 24).when(tier == "Express", e % 23 + 8).otherwise(e % 73 + 24)
    hours = (F.when(code == "PICKUP", e % 5)
             .when((code == "SCAN_DEPOT") | ((code == "SCAN_HUB") & (slot == 2)), haul)
             .when(code == "SCAN_HUB", F.when(_c("entity_type") == "Pallet", e % 13 + 4).otherwise(e % 7 + 2))
             .when(code == "OUT_FOR_DELIVERY", e % 9 + 8).otherwise(e % 7 + 2))
    # An entity has at most six events, so a plain window is bounded.
    run = Window.partitionBy("entity_type", "entity_id").orderBy("slot").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = lake.tracked.join(lake.event_template, ["path_type", "event_count"]).withColumn("hours", hours)
    return rows.select("entity_type", "entity_id", "slot", F.sum("hours").over(run).alias("cum_hours"))


@query("b15_rate_history", "SELECT * FROM rate_cards", money="min_weight_kg max_weight_kg base_rate per_kg",
       dates="effective_from effective_to")
def b15(lake):
    return lake.rate_cards


# ------------------------------------------------------------------ B16: one query per declared index
@query("b16_shipments_by_status", """
SELECT tracking_number, service_tier, sender_customer_id, sender_account_id, created_at FROM shipments
WHERE shipment_status = 'Returned' AND deleted_at IS NULL ORDER BY created_at DESC, tracking_number""")
def b16_status(lake):
    return S.active(lake.shipments).filter(_c("shipment_status") == "Returned").select(
        "tracking_number", "service_tier", "sender_customer_id", "sender_account_id", "created_at").orderBy(
        _c("created_at").desc(), "tracking_number")


@query("b16_shipments_by_account", """
SELECT sender_account_id, shipment_id, created_at FROM shipments
WHERE sender_account_id IS NOT NULL AND deleted_at IS NULL ORDER BY sender_account_id, created_at DESC, shipment_id""")
def b16_account(lake):
    return S.active(lake.shipments).filter(_c("sender_account_id").isNotNull()).select(
        "sender_account_id", "shipment_id", "created_at").orderBy(
        "sender_account_id", _c("created_at").desc(), "shipment_id")


@query("b16_package_timeline", """
SELECT package_id, event_ts, event_code, facility_id FROM tracking_events WHERE package_id IS NOT NULL
ORDER BY package_id, event_ts DESC""")
def b16_package(lake):
    return lake.tracking_events.filter(_c("package_id").isNotNull()).select(
        "package_id", "event_ts", "event_code", "facility_id").orderBy("package_id", _c("event_ts").desc())


@query("b16_pallet_timeline", """
SELECT pallet_id, event_ts, event_code, facility_id FROM tracking_events WHERE pallet_id IS NOT NULL
ORDER BY pallet_id, event_ts DESC""")
def b16_pallet(lake):
    return lake.tracking_events.filter(_c("pallet_id").isNotNull()).select(
        "pallet_id", "event_ts", "event_code", "facility_id").orderBy("pallet_id", _c("event_ts").desc())


@query("b16_facility_timeline", """
SELECT facility_id, event_ts, event_code, entity_type FROM tracking_events WHERE facility_id = 1007
ORDER BY event_ts DESC""")
def b16_facility(lake):
    return lake.tracking_events.filter(_c("facility_id") == 1007).select(
        "facility_id", "event_ts", "event_code", "entity_type").orderBy(_c("event_ts").desc())


@query("b16_invoices_by_account", """
SELECT account_id, invoice_date, invoice_number, total_amount, currency, invoice_status FROM invoices
ORDER BY account_id, invoice_date DESC""", money="total_amount", dates="invoice_date")
def b16_invoices(lake):
    return lake.invoices.select("account_id", "invoice_date", "invoice_number", "total_amount", "currency",
                                "invoice_status").orderBy("account_id", _c("invoice_date").desc())


@query("b16_assignments_by_day", """
SELECT assignment_date, driver_id, vehicle_id, route_id, shift_start, shift_end, assignment_status FROM assignments
ORDER BY assignment_date, driver_id""", dates="assignment_date")
def b16_assignments(lake):
    return lake.assignments.drop("assignment_id").orderBy("assignment_date", "driver_id")


@query("b16_customer_names", """
SELECT last_name, first_name FROM customers WHERE deleted_at IS NULL ORDER BY last_name, first_name""")
def b16_customers(lake):
    return S.active(lake.customers).select("last_name", "first_name").orderBy("last_name", "first_name")


@query("b16_account_names", "SELECT account_name FROM business_accounts WHERE deleted_at IS NULL ORDER BY account_name")
def b16_accounts(lake):
    return S.active(lake.business_accounts).select("account_name").orderBy("account_name")


@query("b16_facilities_by_type", """
SELECT facility_type, facility_code FROM facilities ORDER BY facility_type, facility_code""")
def b16_facilities(lake):
    return lake.facilities.select("facility_type", "facility_code").orderBy("facility_type", "facility_code")


@query("b16_zone_ranges", """
SELECT zone_id, min_postal_code, max_postal_code FROM zone_postal_codes ORDER BY zone_id, min_postal_code""")
def b16_zones(lake):
    return lake.zone_postal_codes.select("zone_id", "min_postal_code", "max_postal_code").orderBy(
        "zone_id", "min_postal_code")


@query("b16_rate_lookup", """
SELECT service_tier, zone_id, effective_from, min_weight_kg, max_weight_kg, base_rate, per_kg, rate_currency
FROM rate_cards WHERE effective_to IS NULL ORDER BY service_tier, zone_id""",
       money="min_weight_kg max_weight_kg base_rate per_kg", dates="effective_from")
def b16_rates(lake):
    return lake.rate_cards.filter(_c("effective_to").isNull()).select(
        "service_tier", "zone_id", "effective_from", "min_weight_kg", "max_weight_kg", "base_rate", "per_kg",
        "rate_currency").orderBy("service_tier", "zone_id")


# ------------------------------------------------------------------ quotes and finance
_CLUSTERED = ["shipment_status", "created_at", "sender_account_id"]


@query("b16_clustered_lookups", """
SELECT 'status' AS lookup, shipment_id, created_at FROM shipments WHERE shipment_status = 'Returned'
UNION ALL SELECT 'account', shipment_id, created_at FROM shipments
  WHERE sender_account_id = (SELECT min(sender_account_id) FROM shipments)
UNION ALL SELECT 'week', shipment_id, created_at FROM shipments
  WHERE created_at BETWEEN TIMESTAMP '1996-03-04' AND TIMESTAMP '1996-03-10 23:59:59'
UNION ALL SELECT 'status and month', shipment_id, created_at FROM shipments
  WHERE shipment_status = 'Delivered' AND created_at BETWEEN TIMESTAMP '1996-05-01' AND TIMESTAMP '1996-05-31 23:59:59'""")
def b16_clustered(lake):
    """Four access paths over one copy of the shipments, each opening the files that its conditions leave."""
    rows = lake.shipments.select("shipment_id", *_CLUSTERED)
    table = Clustered.write(rows, new_path(lake.spark, "clustered"), _CLUSTERED, file_bytes=8 << 20)
    account = table.all().agg(F.min("sender_account_id")).first()[0]
    day = dt.datetime
    asked = {"status": {"shipment_status": "Returned"}, "account": {"sender_account_id": account},
             "week": {"created_at": (day(1996, 3, 4), day(1996, 3, 10, 23, 59, 59))},
             "status and month": {"shipment_status": "Delivered", "created_at": (day(1996, 5, 1), day(1996, 5, 31, 23, 59, 59))}}
    found = [table.lookup(**conditions).select(F.lit(name).alias("lookup"), "shipment_id", "created_at")
             for name, conditions in asked.items()]
    return reduce(DataFrame.unionAll, found)


@query("b17_rate_quote", f"SELECT package_id, billable_kg, quote FROM {QUOTES}", money="billable_kg quote")
def b17(lake):
    return billing.package_quotes(lake).select("package_id", "billable_kg", "quote")


@query("b17_unquoted_packages", f"""
SELECT service_tier, year(created_at) AS shipped, count(*) AS packages, count(*) - count(quote) AS unquoted FROM {QUOTES} GROUP BY 1, 2""")
def b17_unquoted(lake):
    """Packages that no rate card covers: they are part of the package counts and missing in the revenue."""
    return billing.package_quotes(lake).groupBy("service_tier", F.year("created_at").cast("long").alias("shipped")).agg(
        F.count(F.lit(1)).alias("packages"), F.count_if(_c("quote").isNull()).alias("unquoted"))


@query("b18_account_currency", """
SELECT account_id, country_code, CASE WHEN country_code = 'US' THEN 'USD' ELSE 'CAD' END AS currency,
  CAST(CASE WHEN country_code = 'US' THEN 1 ELSE 0.73 END AS DECIMAL(10,6)) AS rate_to_usd FROM account_country""",
       money="rate_to_usd")
def b18(lake):
    us = _c("country_code") == "US"
    return lake.account_country.select(
        "account_id", "country_code", F.when(us, "USD").otherwise("CAD").alias("currency"),
        F.when(us, F.lit("1.000000")).otherwise(F.lit(X.CAD_TO_USD)).cast("decimal(10,6)").alias("rate_to_usd"))


@query("b19_invoice_plan", """
SELECT invoice_id, invoice_number, account_id, inv_year, inv_month, invoice_date, due_date FROM invoice_heads""",
       dates="invoice_date due_date")
def b19(lake):
    return lake.invoice_heads.select("invoice_id", "invoice_number", "account_id", "inv_year", "inv_month",
                                     "invoice_date", "due_date")


@query("b20_line_items", "SELECT * FROM invoice_lines", money="line_amount")
def b20(lake):
    return lake.invoice_lines


@query("b21_invoice_totals", "SELECT invoice_id, total_amount, line_count FROM invoice_totals", money="total_amount")
def b21(lake):
    return lake.invoice_totals.select("invoice_id", "total_amount", "line_count")


@query("b22_invoice_status", "SELECT invoice_id, invoice_date, invoice_status FROM invoices", dates="invoice_date")
def b22(lake):
    return lake.invoices.select("invoice_id", "invoice_date", "invoice_status")


@query("b23_payment_plan", "SELECT * FROM payments", money="amount_paid rate_to_usd", dates="payment_date")
def b23(lake):
    return lake.payments


@query("b24_payment_application", """
SELECT invoice_id, total_amount, paid, CAST(total_amount - paid AS DECIMAL(12,2)) AS balance,
  CASE WHEN paid > 0 AND total_amount - paid <= 0 THEN 'Paid' WHEN paid > 0 THEN 'PartiallyPaid' ELSE invoice_status END
    AS status
FROM (SELECT i.invoice_id, i.total_amount, i.invoice_status,
        CAST(coalesce(CASE WHEN i.invoice_id % 8 = 0 THEN round(p.amount_paid * 0.5, 2) ELSE p.amount_paid END, 0)
             AS DECIMAL(12,2)) AS paid
      FROM invoices i LEFT JOIN payments p ON p.invoice_id = i.invoice_id) x""", money="total_amount paid balance")
def b24(lake):
    return billing.applied_payments(lake)


@query("b25_usd_amounts", """
SELECT invoice_id, currency, CAST(round(total_amount * rate_to_usd, 2) AS DECIMAL(18,2)) AS usd FROM invoices""", money="usd")
def b25(lake):
    return billing.in_usd(lake.invoices, "total_amount").select("invoice_id", "currency", "usd")


@query("b26_facility_tree", """
WITH RECURSIVE walk AS (
  SELECT facility_id AS node, facility_id AS root, CAST(NULL AS BIGINT) AS parent, 0 AS depth,
         CAST(facility_id AS VARCHAR) AS path FROM facilities WHERE parent_facility_id IS NULL
  UNION ALL
  SELECT f.facility_id, w.root, w.node, w.depth + 1, w.path || '/' || CAST(f.facility_id AS VARCHAR)
  FROM facilities f JOIN walk w ON f.parent_facility_id = w.node)
SELECT * FROM walk""")
def b26(lake):
    return billing.facility_tree(lake)


@query("b26_subtree_rollup", """
SELECT p.facility_id, count(c.facility_id) AS below FROM facilities p
LEFT JOIN (SELECT c.facility_id, c.parent_facility_id AS p1, f.parent_facility_id AS p2 FROM facilities c
           LEFT JOIN facilities f ON f.facility_id = c.parent_facility_id) c
  ON c.p1 = p.facility_id OR c.p2 = p.facility_id
GROUP BY 1""")
def b26_rollup(lake):
    return billing.subtree_sizes(lake)


STAFFING_SQL = f"""
(SELECT employee_id, facility_id, slot, supervisors, role_level,
  role_level = 3 AND slot - 1 - supervisors <= driver_target AS is_driver, driver_target
 FROM (SELECT *, CASE WHEN slot = 1 THEN 1 WHEN slot <= supervisors + 1 THEN 2 ELSE 3 END AS role_level
       FROM (SELECT employee_id, facility_id, row_in_facility AS slot, pool_size // 10 AS supervisors,
                    pool_size * 40 // 100 AS driver_target FROM employee_pool) a) b)"""

REPORTING_SQL = f"""
(SELECT p.employee_id, p.facility_id, p.role_level,
   CASE WHEN p.role_level > 1 THEN coalesce(s.employee_id, m.employee_id) END AS reports_to
 FROM {STAFFING_SQL} p JOIN {STAFFING_SQL} m ON m.facility_id = p.facility_id AND m.role_level = 1
 LEFT JOIN {STAFFING_SQL} s ON s.facility_id = p.facility_id AND s.role_level = 2 AND p.role_level = 3
   AND p.supervisors > 0 AND {roll('p.employee_id', 43, 7)} < 70 AND s.slot - 1 = p.employee_id % nullif(p.supervisors, 0) + 1)"""


@query("b27_org_chart", f"""
WITH RECURSIVE lines AS {REPORTING_SQL}, walk AS (
  SELECT employee_id, employee_id AS site_manager, 0 AS depth, CAST(employee_id AS VARCHAR) AS path FROM lines
  WHERE reports_to IS NULL
  UNION ALL
  SELECT l.employee_id, w.site_manager, w.depth + 1, w.path || '/' || CAST(l.employee_id AS VARCHAR)
  FROM lines l JOIN walk w ON l.reports_to = w.employee_id)
SELECT w.*, coalesce(d.n, 0) AS direct_reports FROM walk w
LEFT JOIN (SELECT reports_to, count(*) AS n FROM lines GROUP BY 1) d ON d.reports_to = w.employee_id""")
def b27(lake):
    return people.org_chart(lake)


@query("b27_management_chain", """
WITH RECURSIVE walk AS (
  SELECT employee_id, 0 AS depth, CAST(employee_id AS VARCHAR) AS path FROM employees WHERE manager_id IS NULL
  UNION ALL
  SELECT e.employee_id, w.depth + 1, w.path || '/' || CAST(e.employee_id AS VARCHAR)
  FROM employees e JOIN walk w ON e.manager_id = w.employee_id)
SELECT * FROM walk""")
def b27_chain(lake):
    return walk_down(lake.employees, "employee_id", "manager_id").select(
        _c("node").alias("employee_id"), "depth", "path")


@query("b28_staffing_plan", f"""
SELECT employee_id, facility_id, slot, supervisors, role_level, is_driver,
  CASE WHEN role_level = 1 THEN 'Facility Manager'
       WHEN role_level = 2 THEN CASE WHEN employee_id % 2 = 0 THEN 'Operations Supervisor' ELSE 'Dispatch Supervisor' END
       WHEN is_driver THEN CASE WHEN {roll('employee_id', 59, 2)} < 25 THEN 'Senior Driver' ELSE 'Driver' END
       ELSE {bands(roll('employee_id', 71, 13),
                   [(35, 'Parcel Handler'), (55, 'Freight Handler'), (70, 'Customer Service Representative'),
                    (80, 'Billing Coordinator'), (90, 'IT Support Technician')], 'Administrative Assistant')}
  END AS planned_title
FROM {STAFFING_SQL} p""")
def b28(lake):
    return people.planned_titles(lake)


@query("b29_weighted_pick", """
SELECT c.c_nationkey AS nation_id, b.band_class, count(*) AS picked FROM (
  SELECT c_nationkey, c_custkey * 37 % t.total + 1 AS pick
  FROM customer JOIN (SELECT s_nationkey, count(*) AS total FROM supplier GROUP BY 1) t ON t.s_nationkey = c_nationkey) c
JOIN (SELECT s_nationkey, band_class, sum(w) OVER (PARTITION BY s_nationkey ORDER BY band_class) - w + 1 AS lo,
             sum(w) OVER (PARTITION BY s_nationkey ORDER BY band_class) AS hi
      FROM (SELECT s_nationkey, s_suppkey % 4 AS band_class, count(*) AS w FROM supplier GROUP BY 1, 2) g) b
  ON b.s_nationkey = c.c_nationkey AND c.pick BETWEEN b.lo AND b.hi GROUP BY 1, 2""")
def b29(lake):
    picked = range_join(people.customer_picks(lake), people.supplier_bands(lake), "pick", "cum_low", "cum_high",
                        ["nation_id"], cell=64)
    return picked.groupBy("nation_id", "band_class").agg(F.count(F.lit(1)).alias("picked"))


@query("b30_vehicle_attributes", "SELECT * FROM vehicles", money="max_payload_kg", dates="first_day")
def b30(lake):
    return lake.vehicles


@query("b31_assignment_matching", "SELECT * FROM assignments", dates="assignment_date")
def b31(lake):
    return lake.assignments


@query("b32_driver_licences", "SELECT * FROM drivers", money="heaviest", dates="last_day")
def b32(lake):
    return lake.drivers


@query("b33_party_assembly", """
SELECT 'customer' AS kind, c.customer_id AS party_id, c.first_name || ' ' || c.last_name AS display_name, c.email AS contact,
  a.address_line1 || ', ' || a.city || ', ' || a.postal_code AS address, CAST(NULL AS VARCHAR) AS tax_id
FROM customers c JOIN addresses a ON a.address_id = c.customer_id * 2
UNION ALL
SELECT 'account', b.account_id, b.account_name, b.credit_currency, a.address_line1 || ', ' || a.city || ', ' || a.postal_code,
  b.tax_id FROM business_accounts b JOIN addresses a ON a.address_id = b.account_id * 2""")
def b33(lake):
    home = lake.addresses.select(
        "address_id", F.concat_ws(", ", "address_line1", "city", "postal_code").alias("address"))
    people_ = lake.customers.select(
        F.lit("customer").alias("kind"), _c("customer_id").alias("party_id"),
        F.concat_ws(" ", "first_name", "last_name").alias("display_name"), _c("email").alias("contact"),
        F.lit(None).cast("string").alias("tax_id"))
    firms = lake.business_accounts.select(
        F.lit("account").alias("kind"), _c("account_id").alias("party_id"), _c("account_name").alias("display_name"),
        _c("credit_currency").alias("contact"), "tax_id")
    return (people_.unionByName(firms).withColumn("address_id", _c("party_id") * 2)
            .join(home, "address_id").drop("address_id"))


@query("b34_primary_flags", """
SELECT 'contact' AS kind, contact_id AS id, is_primary FROM business_contacts
UNION ALL SELECT 'address', address_id, is_primary FROM account_addresses""")
def b34(lake):
    """The first contact and the first role of an account are its primary ones (three per account at most)."""
    def first(df, kind, key):
        place = F.row_number().over(Window.partitionBy("account_id").orderBy(key))
        return df.select(F.lit(kind).alias("kind"), _c(key).alias("id"), (place == 1).alias("is_primary"))
    return first(lake.business_contacts, "contact", "contact_id").unionAll(
        first(lake.account_addresses, "address", "address_id"))


@query("b35_hour_of_day", """
SELECT left(service_tier, 1) AS tier_code, CAST(hour(created_at) AS INTEGER) AS ship_hour, count(*) AS n
FROM shipments GROUP BY 1, 2""")
def b35(lake):
    """Time of day read from the tracking number alone."""
    parts = S.tracking_parts(_c("tracking_number"))
    return lake.shipments.groupBy(parts["tier_code"].alias("tier_code"), parts["ship_hour"].alias("ship_hour")).agg(
        F.count(F.lit(1)).alias("n"))


@query("b36_row_visibility", """
SELECT account_id, account_name FROM business_accounts
WHERE nation_id IN (SELECT nation_id FROM employees WHERE employee_number = 'EMP-00007')""")
def b36(lake):
    return billing.visible_accounts(lake, "EMP-00007").select("account_id", "account_name")


@query("b36_masked_references", "SELECT payment_id, sha256(payment_reference) AS masked FROM payments")
def b36_masked(lake):
    return lake.payments.select("payment_id", F.sha2("payment_reference", 256).alias("masked"))
