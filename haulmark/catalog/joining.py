"""J: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmark.catalog.registry import query
from haulmark.operators.joins import (
    effective_join, found_in, left_join_many, missing_in, postal_zone_join, range_join)
from haulmark.operators.ordered import row_number_within
from haulmark.plans import people, telemetry

_c = F.col


@query("j1_inner_one_key", """
SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def j1(lake):
    return (lake.table("orders").join(lake.table("customer"), _c("o_custkey") == _c("c_custkey"))
            .select("o_orderkey", "c_name", "c_mktsegment"))


@query("j2_inner_composite_key", """
SELECT h.invoice_id, s.shipment_id, s.line_amount FROM account_shipments s JOIN invoice_heads h
  ON h.account_id = s.account_id AND h.inv_year = s.inv_year AND h.inv_month = s.inv_month""", money="line_amount")
def j2(lake):
    return lake.invoice_lines.select("invoice_id", "shipment_id", "line_amount")


@query("j3_left_outer", """
SELECT o_orderkey, l_linenumber, l_partkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def j3(lake):
    """Orders without any line stay, with nulls."""
    lines = lake.table("lineitem").select(_c("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    return left_join_many(lake.table("orders").select("o_orderkey"), lines, "o_orderkey")


@query("j4_left_with_fallback", """
SELECT e.employee_id, coalesce(s.employee_id, e.manager_id) AS reports_to
FROM employees e LEFT JOIN employees s
  ON s.facility_id = e.facility_id AND s.is_driver AND s.employee_id = e.employee_id - 10""")
def j4(lake):
    """A driver of the same site ten numbers before where there is one, the manager otherwise."""
    seniors = lake.employees.filter("is_driver").select(
        "facility_id", (_c("employee_id") + 10).alias("employee_id"), _c("employee_id").alias("senior_id"))
    return lake.employees.join(seniors, ["facility_id", "employee_id"], "left").select(
        "employee_id", F.coalesce("senior_id", "manager_id").alias("reports_to"))


@query("j5_anti", """
SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def j5(lake):
    lines = lake.table("lineitem").select(_c("l_orderkey").alias("o_orderkey"))
    return missing_in(lake.table("orders").select("o_orderkey"), lines, "o_orderkey")


@query("j6_two_roles", """
SELECT r.route_code, o.facility_name AS origin_name, d.facility_name AS dest_name
FROM routes r JOIN facilities o ON o.facility_id = r.origin_facility_id
JOIN facilities d ON d.facility_id = r.dest_facility_id""")
def j6(lake):
    def role(prefix):
        return lake.facilities.select(_c("facility_id").alias(f"{prefix}_facility_id"),
                                      _c("facility_name").alias(f"{prefix}_name"))
    return (lake.routes.join(role("origin"), "origin_facility_id").join(role("dest"), "dest_facility_id")
            .select("route_code", "origin_name", "dest_name"))


@query("j7_self_join", """
SELECT c.facility_code, p.facility_code AS parent FROM facilities c
JOIN facilities p ON c.parent_facility_id = p.facility_id""")
def j7(lake):
    parent = lake.facilities.select(_c("facility_id").alias("parent_facility_id"), _c("facility_code").alias("parent"))
    return lake.facilities.join(parent, "parent_facility_id").select("facility_code", "parent")


@query("j8_bridge", """
SELECT b.account_name, ba.address_role, a.city, a.postal_code FROM business_accounts b
JOIN account_addresses ba ON ba.account_id = b.account_id JOIN addresses a ON a.address_id = ba.address_id""")
def j8(lake):
    return (lake.business_accounts.select("account_id", "account_name")
            .join(lake.account_addresses.select("account_id", "address_id", "address_role"), "account_id")
            .join(lake.addresses.select("address_id", "city", "postal_code"), "address_id")
            .select("account_name", "address_role", "city", "postal_code"))


@query("j9_all_combinations", """
SELECT zone_id, service_tier, effective_from, rate_card_id FROM rate_cards""", dates="effective_from")
def j9(lake):
    """Tier x zone x period: zones are expanded by two literal arrays, so no join is needed."""
    return lake.rate_cards.select("zone_id", "service_tier", "effective_from", "rate_card_id")


@query("j10_fan_out", """
SELECT t.n AS slot, count(*) AS n FROM (VALUES (1), (2), (3), (4), (5)) t(n)
JOIN shipments s ON t.n <= s.shipment_id % 5 + 1 GROUP BY 1""")
def j10(lake):
    """``n <= count`` as an expansion of the row, without an inequality join."""
    slots = F.explode(F.sequence(F.lit(1), (_c("shipment_id") % 5 + 1).cast("int"))).alias("slot")
    return lake.shipments.select(slots).groupBy("slot").agg(F.count(F.lit(1)).alias("n"))


@query("j11_range_join", """
SELECT c.c_custkey, b.band_class FROM (SELECT c_custkey, c_nationkey, c_custkey * 37 % t.total + 1 AS pick
  FROM customer JOIN (SELECT s_nationkey, count(*) AS total FROM supplier GROUP BY 1) t ON t.s_nationkey = c_nationkey) c
JOIN (SELECT s_nationkey, band_class, sum(w) OVER (PARTITION BY s_nationkey ORDER BY band_class) - w + 1 AS lo,
             sum(w) OVER (PARTITION BY s_nationkey ORDER BY band_class) AS hi
      FROM (SELECT s_nationkey, s_suppkey % 4 AS band_class, count(*) AS w FROM supplier GROUP BY 1, 2) g) b
  ON b.s_nationkey = c.c_nationkey AND c.pick BETWEEN b.lo AND b.hi""")
def j11(lake):
    bands = people.supplier_bands(lake)
    picks = people.customer_picks(lake)
    return range_join(picks, bands, "pick", "cum_low", "cum_high", ["nation_id"], cell=64).select(
        _c("customer_key").alias("c_custkey"), "band_class")


@query("j12_postal_range", """
SELECT a.address_id, z.zone_code FROM addresses a JOIN zone_postal_codes z
  ON z.country_code = a.country_code
 AND CASE WHEN a.country_code = 'CA' THEN left(a.postal_code, 3) ELSE a.postal_code END
     BETWEEN z.min_postal_code AND z.max_postal_code""")
def j12(lake):
    return postal_zone_join(lake.addresses.select("address_id", "postal_code", "country_code"),
                            lake.zone_postal_codes).select("address_id", "zone_code")


@query("j13_rate_asof", """
SELECT s.shipment_id, r.rate_card_id, r.base_rate FROM shipments s JOIN rate_cards r
  ON r.service_tier = s.service_tier AND r.zone_id = s.origin_nation AND r.effective_from <= CAST(s.created_at AS DATE)
 AND (r.effective_to IS NULL OR CAST(s.created_at AS DATE) <= r.effective_to)""", money="base_rate")
def j13(lake):
    facts = lake.shipments.select("shipment_id", "service_tier", _c("origin_nation").alias("zone_id"), "created_at")
    return effective_join(facts, lake.rate_cards, _c("created_at"), ["service_tier", "zone_id"]).select(
        "shipment_id", "rate_card_id", "base_rate")


@query("j14_lateral_columns", """
SELECT vehicle_id, vehicle_type, capacity_class, max_payload_kg,
  CASE vehicle_type
    WHEN 'Semi' THEN CASE vehicle_id % 3 WHEN 0 THEN 'Freightliner' WHEN 1 THEN 'Peterbilt' ELSE 'Kenworth' END
    WHEN 'Box Truck' THEN CASE vehicle_id % 3 WHEN 0 THEN 'International' WHEN 1 THEN 'Isuzu' ELSE 'Freightliner' END
    ELSE CASE vehicle_id % 2 WHEN 0 THEN 'Ford' ELSE 'Mercedes-Benz' END END AS make,
  CASE vehicle_type WHEN 'Semi' THEN 'Cascadia' WHEN 'Box Truck' THEN 'MT45'
    ELSE CASE vehicle_id % 2 WHEN 0 THEN 'Transit' ELSE 'Sprinter' END END AS model FROM vehicles""", money="max_payload_kg")
def j14(lake):
    """Each derived column builds on the one before it: payload, type, class, make, model."""
    v, kind = _c("vehicle_id"), _c("vehicle_type")
    make = (F.when(kind == "Semi", F.when(v % 3 == 0, "Freightliner").when(v % 3 == 1, "Peterbilt").otherwise("Kenworth"))
            .when(kind == "Box Truck", F.when(v % 3 == 0, "International").when(v % 3 == 1, "Isuzu")
                  .otherwise("Freightliner"))
            .otherwise(F.when(v % 2 == 0, "Ford").otherwise("Mercedes-Benz")))
    model = (F.when(kind == "Semi", "Cascadia").when(kind == "Box Truck", "MT45")
             .otherwise(F.when(_c("make") == "Ford", "Transit").otherwise("Sprinter")))
    return (lake.vehicles.select("vehicle_id", "vehicle_type", "capacity_class", "max_payload_kg", make.alias("make"))
            .withColumn("model", model))


@query("j15_statement_text", """
SELECT r.session_id, t.sql_text FROM requests r JOIN sql_texts t ON t.sql_id = r.sql_id""")
def j15(lake):
    return telemetry.with_text(lake, telemetry.requests(lake)).select("session_id", "sql_text")


@query("j16_join_aggregate", """
SELECT h.invoice_number, t.total, t.n FROM invoice_heads h
JOIN (SELECT invoice_id, CAST(sum(line_amount) AS DECIMAL(12,2)) AS total, count(*) AS n FROM invoice_lines GROUP BY 1) t
  ON t.invoice_id = h.invoice_id""", money="total")
def j16(lake):
    return lake.invoice_totals.select("invoice_number", _c("total_amount").alias("total"), _c("line_count").alias("n"))


@query("j17_windowed_rows", """
SELECT account_id, row_number() OVER (ORDER BY account_id) AS account_no,
       row_number() OVER (PARTITION BY nation_id ORDER BY account_id) AS no_in_nation
FROM business_accounts""")
def j17(lake):
    """Window columns are used where they arise; nothing is joined back to its own source."""
    rows = lake.business_accounts.select("account_id", "nation_id")
    numbered = row_number_within(rows, [], "account_id", "account_no")
    return row_number_within(numbered, ["nation_id"], "account_id", "no_in_nation").drop("nation_id")


@query("j18_numbered_pool", """
SELECT s.shipment_id, f.facility_code FROM shipments s JOIN
  (SELECT facility_code, row_number() OVER (ORDER BY facility_id) AS n, count(*) OVER () AS size FROM facilities) f
  ON f.n = s.shipment_id % f.size + 1""")
def j18(lake):
    """Index into a numbered pool, stored once; the pool size is a scalar subquery over the pool itself."""
    pool = lake.once("facility-pool", lambda: row_number_within(
        lake.facilities.select("facility_id", "facility_code"), [], "facility_id", "n"))
    size = pool.agg(F.count(F.lit(1))).scalar()
    picks = lake.shipments.select("shipment_id", (_c("shipment_id") % size + 1).alias("n"))
    return picks.join(pool, "n").select("shipment_id", "facility_code")


@query("j19_subtype", """
SELECT d.employee_id, e.full_name, d.line_count FROM drivers d JOIN employees e ON e.employee_id = d.employee_id""")
def j19(lake):
    return lake.drivers.select("employee_id", "line_count").join(
        lake.employees.select("employee_id", "full_name"), "employee_id")


@query("j20_reference_semi_join", """
SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def j20(lake):
    referenced = lake.table("orders").select(_c("o_custkey").alias("c_custkey"))
    return found_in(lake.table("customer").select("c_custkey"), referenced, "c_custkey")
