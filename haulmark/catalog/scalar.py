"""F: scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmark.catalog.oracle import AS_OF, pad, roll
from haulmark.catalog.registry import query
from haulmark.functions import scalars as S
from haulmark.plans import fixed as X
from haulmark.plans import telemetry

_c = F.col


@query("f1_searched_case", """
SELECT shipment_id, CASE WHEN is_cross_border AND service_tier = 'Freight' THEN 'broker'
  WHEN is_cross_border THEN 'declare' ELSE 'domestic' END AS customs_path FROM shipments""")
def f1(lake):
    path = (F.when(_c("is_cross_border") & (_c("service_tier") == "Freight"), "broker")
            .when(_c("is_cross_border"), "declare").otherwise("domestic"))
    return lake.shipments.select("shipment_id", path.alias("customs_path"))


@query("f2_simple_case", """
SELECT shipment_id, CASE service_tier WHEN 'Ground' THEN 'G' WHEN 'Express' THEN 'E' ELSE 'F' END AS tier_code,
  CASE shipment_status WHEN 'Delivered' THEN CASE service_tier WHEN 'Express' THEN 'fast' ELSE 'done' END
       ELSE 'open' END AS phase FROM shipments""")
def f2(lake):
    return lake.shipments.selectExpr(
        "shipment_id", "CASE service_tier WHEN 'Ground' THEN 'G' WHEN 'Express' THEN 'E' ELSE 'F' END AS tier_code",
        "CASE shipment_status WHEN 'Delivered' THEN CASE service_tier WHEN 'Express' THEN 'fast' ELSE 'done' END "
        "ELSE 'open' END AS phase")


@query("f3_coalesce", "SELECT shipment_id, coalesce(sender_account_id, sender_customer_id) AS sender FROM shipments")
def f3(lake):
    return lake.shipments.select("shipment_id", F.coalesce("sender_account_id", "sender_customer_id").alias("sender"))


@query("f4_casts", """
SELECT l_orderkey, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS INTEGER) AS pieces,
  CAST(l_linenumber AS VARCHAR) AS line_text, CAST(l_shipdate AS DATE) AS ship_day FROM lineitem""",
       money="price", dates="ship_day")
def f4(lake):
    return lake.table("lineitem").select(
        "l_orderkey", _c("l_extendedprice").cast("decimal(12,2)").alias("price"),
        _c("l_quantity").cast("int").alias("pieces"), _c("l_linenumber").cast("string").alias("line_text"),
        _c("l_shipdate").cast("date").alias("ship_day"))


@query("f5_concatenate", """
SELECT shipment_id, service_tier || ' / ' || retail_payment_method AS label FROM shipments""")
def f5(lake):
    """A null part makes the whole text null."""
    return lake.shipments.select(
        "shipment_id", F.concat("service_tier", F.lit(" / "), "retail_payment_method").alias("label"))


@query("f6_case_folding", "SELECT c_custkey, lower(c_name) AS low, upper(c_name) AS up FROM customer")
def f6(lake):
    return lake.table("customer").select("c_custkey", F.lower("c_name").alias("low"), F.upper("c_name").alias("up"))


@query("f7_left_right", "SELECT p_partkey, left(p_name, 3) AS head, right(p_brand, 2) AS tail FROM part")
def f7(lake):
    return lake.table("part").select("p_partkey", F.left("p_name", F.lit(3)).alias("head"),
                                     F.right("p_brand", F.lit(2)).alias("tail"))


@query("f8_zero_pad", f"SELECT o_orderkey, {pad('o_orderkey * 7', 4)} AS padded FROM orders")
def f8(lake):
    return lake.table("orders").select("o_orderkey", S.zero_pad(_c("o_orderkey") * 7, 4).alias("padded"))


@query("f9_letter_from_code", "SELECT s_suppkey, chr(CAST(65 + s_suppkey % 26 AS INTEGER)) AS letter FROM supplier")
def f9(lake):
    return lake.table("supplier").select("s_suppkey", F.char(_c("s_suppkey") % 26 + 65).alias("letter"))


@query("f10_date_text", """
SELECT shipment_id, strftime(created_at, '%Y%m%d') AS compact, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS iso
FROM shipments""")
def f10(lake):
    return lake.shipments.select("shipment_id", F.date_format("created_at", "yyyyMMdd").alias("compact"),
                                 F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("iso"))


@query("f11_date_parts", """
SELECT shipment_id, CAST(year(created_at) AS INTEGER) AS y, CAST(month(created_at) AS INTEGER) AS m,
  CAST(hour(created_at) AS INTEGER) AS h FROM shipments""")
def f11(lake):
    return lake.shipments.select("shipment_id", F.year("created_at").alias("y"), F.month("created_at").alias("m"),
                                 F.hour("created_at").alias("h"))


@query("f12_month_start", "SELECT shipment_id, CAST(date_trunc('month', created_at) AS DATE) AS month_start FROM shipments",
       dates="month_start")
def f12(lake):
    start = F.make_date(F.year("created_at"), F.month("created_at"), F.lit(1))
    return lake.shipments.select("shipment_id", start.alias("month_start"))


@query("f13_date_shift", """
SELECT shipment_id, CAST(created_at AS DATE) + 15 AS plus_days,
  CAST(CAST(created_at AS DATE) + INTERVAL 1 MONTH AS DATE) AS plus_month,
  created_at + INTERVAL 30 HOUR AS plus_hours, created_at + INTERVAL 90 MINUTE AS plus_minutes FROM shipments""",
       dates="plus_days plus_month")
def f13(lake):
    day = F.to_date("created_at")
    return lake.shipments.select(
        "shipment_id", F.date_add(day, 15).alias("plus_days"), F.add_months(day, 1).alias("plus_month"),
        S.add_hours(_c("created_at"), F.lit(30)).alias("plus_hours"),
        (_c("created_at") + F.expr("INTERVAL 90 MINUTE")).alias("plus_minutes"))


@query("f14_days_between", f"""
SELECT shipment_id, date_diff('day', CAST(created_at AS DATE), {AS_OF}) AS age_days FROM shipments""")
def f14(lake):
    age = F.date_diff(F.lit(X.AS_OF), F.to_date("created_at")).cast("long")
    return lake.shipments.select("shipment_id", age.alias("age_days"))


@query("f15_arithmetic", """
SELECT o_orderkey, o_orderkey // 7 AS quotient, o_orderkey % 7 AS remainder, -o_orderkey + 5 AS negated,
  o_orderkey * 3 - 1 AS scaled, o_orderkey / 128.0::DOUBLE AS exact_ratio FROM orders""")
def f15(lake):
    """Integer by integer stays an integer; a decimal divisor gives the exact ratio."""
    k = _c("o_orderkey")
    return lake.table("orders").select(
        "o_orderkey", F.expr("o_orderkey div 7").alias("quotient"), (k % 7).alias("remainder"),
        (-k + 5).alias("negated"), (k * 3 - 1).alias("scaled"), (k / F.lit(128.0)).alias("exact_ratio"))


@query("f16_abs_power", """
SELECT c_custkey, abs(c_custkey - 700) AS distance, CAST(100 / pow(CAST(1.05 AS DOUBLE), c_custkey % 3) AS DECIMAL(10,4))
  AS discounted FROM customer""", money="discounted")
def f16(lake):
    k = _c("c_custkey")
    return lake.table("customer").select(
        "c_custkey", F.abs(k - 700).alias("distance"),
        (F.lit(100) / F.pow(F.lit(1.05), k % 3)).cast("decimal(10,4)").alias("discounted"))


@query("f17_unit_ratios", """
SELECT session_id, CAST(wait_time_ms AS DECIMAL(18,0)) * 0.001 AS wait_seconds,
  CAST(logical_reads AS DECIMAL(18,0)) / 128 AS read_mb FROM requests""", money="wait_seconds read_mb")
def f17(lake):
    rows = telemetry.requests(lake)
    return rows.select("session_id", telemetry.seconds("wait_time_ms").alias("wait_seconds"),
                       telemetry.pages_to_mb("logical_reads").alias("read_mb"))


@query("f18_weighted_bucket", f"""
SELECT CASE WHEN r < 41 THEN 'Ground' WHEN r < 88 THEN 'Express' ELSE 'Freight' END AS tier, r, count(*) AS n
FROM (SELECT {roll('o_orderkey', 37, 11)} AS r FROM orders) x GROUP BY 1, 2""")
def f18(lake):
    rolled = lake.table("orders").select(S.bucket(_c("o_orderkey"), 37, 11).alias("r"))
    return rolled.groupBy(S.weighted(_c("r"), X.TIER_BANDS, "Freight").alias("tier"), "r").agg(
        F.count(F.lit(1)).alias("n"))


@query("f19_audit_stamp", """
SELECT account_id, account_status, TIMESTAMP '2001-08-01' AS created_at, 'loader' AS created_by FROM business_accounts""")
def f19(lake):
    """The run's clock and user are parameters of the load, so a rerun gives the same rows."""
    return lake.business_accounts.select(
        "account_id", "account_status", F.lit(X.AS_OF).cast("timestamp_ntz").alias("created_at"),
        F.lit("loader").alias("created_by"))


@query("f20_xml_values", """
SELECT page_id, len(links) AS n_links, coalesce(links[1], '') AS first_link, coalesce(links[-1], '') AS last_link
FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), 'href="([^"]*)"', 1) AS links FROM pages) p""")
def f20(lake):
    """Values from the navigation of a page, which is well-formed markup: number, first and last of its links."""
    nav = F.nullif(F.regexp_extract("html", "(?s)<nav>.*?</nav>", 0), F.lit(""))
    links = F.xpath(nav, F.lit("//a/@href"))
    return lake.table("pages").select(
        "page_id", F.coalesce(F.size(links), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.get(links, F.lit(0)), F.lit("")).alias("first_link"),
        F.coalesce(F.element_at(links, -1), F.lit("")).alias("last_link"))


@query("f21_wrapping_successor", """
SELECT shipment_id, shipment_id % 25 + 1 AS pick, (shipment_id % 25 + 1) % 25 + 1 AS next_pick FROM shipments""")
def f21(lake):
    pick = _c("shipment_id") % 25 + 1
    return lake.shipments.select("shipment_id", pick.alias("pick"), S.successor(pick, 25).alias("next_pick"))
