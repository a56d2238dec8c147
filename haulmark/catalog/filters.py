"""P: projections, filters and predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from haulmark.catalog.oracle import CUTOFF
from haulmark.catalog.registry import query
from haulmark.functions import scalars as S
from haulmark.operators.joins import found_in

_c = F.col


@query("p1_projection", "SELECT facility_code AS code, facility_name AS name, facility_type AS kind FROM facilities")
def p1(lake):
    return lake.facilities.select(_c("facility_code").alias("code"), _c("facility_name").alias("name"),
                                  _c("facility_type").alias("kind"))


@query("p2_comparison_filter", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_quantity >= 45 AND l_discount <> 0 AND l_tax < 0.05 AND l_extendedprice > 1000 AND l_linenumber <= 4
  AND l_returnflag = 'R'""")
def p2(lake):
    return lake.table("lineitem").filter(
        (_c("l_quantity") >= 45) & (_c("l_discount") != 0) & (_c("l_tax") < 0.05)
        & (_c("l_extendedprice") > 1000) & (_c("l_linenumber") <= 4) & (_c("l_returnflag") == "R")
    ).select("l_orderkey", "l_linenumber", "l_quantity")


@query("p3_in_and_not_in", """
SELECT shipment_id, retail_payment_method FROM shipments
WHERE shipment_status IN ('Delivered', 'Returned') AND retail_payment_method NOT IN ('Cash', 'Wire')""")
def p3(lake):
    """A null method is kept by neither IN nor NOT IN."""
    return lake.shipments.filter(
        _c("shipment_status").isin("Delivered", "Returned") & ~_c("retail_payment_method").isin("Cash", "Wire")
    ).select("shipment_id", "retail_payment_method")


@query("p4_between", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 150000")
def p4(lake):
    return lake.table("orders").filter(_c("o_totalprice").between(100000, 150000)).select("o_orderkey", "o_totalprice")


@query("p5_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'")
def p5(lake):
    return lake.table("part").filter(_c("p_name").contains("ring")).select("p_partkey", "p_name")


@query("p6_null_tests", """
SELECT service_tier, count(*) FILTER (WHERE sender_account_id IS NULL) AS retail,
       count(*) FILTER (WHERE sender_account_id IS NOT NULL) AS business
FROM shipments GROUP BY 1""")
def p6(lake):
    return lake.shipments.groupBy("service_tier").agg(
        F.count_if(_c("sender_account_id").isNull()).alias("retail"),
        F.count_if(_c("sender_account_id").isNotNull()).alias("business"))


@query("p7_exactly_one_sender", """
SELECT shipment_id,
       (sender_customer_id IS NOT NULL AND sender_account_id IS NULL) OR
       (sender_customer_id IS NULL AND sender_account_id IS NOT NULL) AS one_sender
FROM shipments""")
def p7(lake):
    return lake.shipments.select(
        "shipment_id", S.exactly_one(_c("sender_customer_id"), _c("sender_account_id")).alias("one_sender"))


@query("p8_three_valued_logic", """
SELECT retail_payment_status, is_cross_border, count(*) AS n,
       count(*) FILTER (WHERE retail_payment_status = 'Paid' AND is_cross_border) AS both_true,
       count(*) FILTER (WHERE retail_payment_status = 'Paid' OR is_cross_border) AS any_true,
       count(*) FILTER (WHERE NOT (retail_payment_status = 'Paid')) AS known_false,
       count(*) FILTER (WHERE coalesce(retail_payment_status = 'Paid', TRUE)) AS check_passes
FROM shipments GROUP BY 1, 2""")
def p8(lake):
    paid, cross = _c("retail_payment_status") == "Paid", _c("is_cross_border")
    return lake.shipments.groupBy("retail_payment_status", "is_cross_border").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(paid & cross).alias("both_true"),
        F.count_if(paid | cross).alias("any_true"), F.count_if(~paid).alias("known_false"),
        F.count_if(S.holds(paid)).alias("check_passes"))


@query("p9_active_rows", "SELECT shipment_id, shipment_status FROM shipments WHERE deleted_at IS NULL")
def p9(lake):
    return S.active(lake.shipments).select("shipment_id", "shipment_status")


@query("p10_filtered_subsets", """
SELECT 'shipments_by_account' AS subset, count(*) AS n FROM shipments
  WHERE sender_account_id IS NOT NULL AND deleted_at IS NULL
UNION ALL SELECT 'events_of_packages', count(*) FROM tracking_events WHERE package_id IS NOT NULL
UNION ALL SELECT 'events_of_pallets', count(*) FROM tracking_events WHERE pallet_id IS NOT NULL
UNION ALL SELECT 'active_customers', count(*) FROM customers WHERE deleted_at IS NULL
UNION ALL SELECT 'active_accounts', count(*) FROM business_accounts WHERE deleted_at IS NULL""")
def p10(lake):
    """The row sets the filtered indexes hold; each reads only the columns of its predicate."""
    subsets = {
        "shipments_by_account": S.active(lake.shipments).filter(_c("sender_account_id").isNotNull()),
        "events_of_packages": lake.tracking_events.filter(_c("package_id").isNotNull()),
        "events_of_pallets": lake.tracking_events.filter(_c("pallet_id").isNotNull()),
        "active_customers": S.active(lake.customers),
        "active_accounts": S.active(lake.business_accounts),
    }
    parts = [df.agg(F.lit(name).alias("subset"), F.count(F.lit(1)).alias("n")) for name, df in subsets.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


@query("p11_existence", f"""
SELECT account_id, account_name FROM business_accounts b
WHERE EXISTS (SELECT 1 FROM shipments s WHERE s.sender_account_id = b.account_id AND s.created_at >= {CUTOFF})""")
def p11(lake):
    recent = lake.shipments.filter(_c("created_at") >= F.lit(dt.datetime(2001, 7, 1)).cast("timestamp_ntz"))
    senders = recent.select(_c("sender_account_id").alias("account_id"))
    return found_in(lake.business_accounts.select("account_id", "account_name"), senders, "account_id")


@query("p12_date_parameters", """
SELECT shipment_status, count(*) AS n FROM shipments
WHERE created_at >= TIMESTAMP '1998-01-01' AND created_at < TIMESTAMP '1999-01-01' GROUP BY 1""")
def p12(lake):
    """Named arguments of a parameterised statement."""
    return lake.spark.sql(
        "SELECT shipment_status, count(*) AS n FROM {shipments} "
        "WHERE created_at >= CAST(:start AS TIMESTAMP_NTZ) "
        "AND created_at < CAST(:start AS TIMESTAMP_NTZ) + INTERVAL 1 YEAR GROUP BY 1",
        args={"start": dt.date(1998, 1, 1)}, shipments=lake.shipments)
