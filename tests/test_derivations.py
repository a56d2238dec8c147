"""Properties that follow from the business rules."""

import datetime as dt

from pyspark.sql import functions as F

from haulmark.catalog.all_queries import run
from haulmark.functions import scalars as S
from haulmark.operators import changes
from haulmark.operators.trees import walk_down
from haulmark.plans import billing, people, telemetry
from tests.conftest import SF_DIR, rows


def test_tracking_number_decodes_to_its_parts(spark):
    df = spark.createDataFrame([("G", dt.datetime(1999, 1, 2, 3), 100007), ("F", dt.datetime(2024, 12, 31, 23), 99999)],
                               "code string, at timestamp_ntz, seq long")
    number = S.tracking_number(F.col("code"), F.col("at"), F.col("seq"))
    parts = S.tracking_parts(F.col("number"))
    got = df.select(number.alias("number")).select("number", F.length("number").alias("n"), *parts.values())
    assert rows(got) == [("TLF2024123123" + "99999", 18, "F", dt.date(2024, 12, 31), 23, 99999),
                         ("TLG1999010203" + "00007", 18, "G", dt.date(1999, 1, 2), 3, 7)]


def test_zero_pad_keeps_the_last_digits(spark):
    df = spark.createDataFrame([(5,), (123456,)], "n int").select(S.zero_pad(F.col("n"), 5).alias("p"))
    assert [r.p for r in df.collect()] == ["00005", "23456"]


def test_dimensional_weight_rounds_half_up(spark):
    df = spark.createDataFrame([(10, 10, 10), (5, 5, 5), (120, 120, 120)], "l int, w int, h int")
    got = [str(r[0]) for r in df.select(S.dim_weight(F.col("l"), F.col("w"), F.col("h"))).collect()]
    assert got == ["0.20", "0.03", "345.60"]


def test_lines_add_up_to_the_invoice(lake):
    sums = lake.invoice_lines.groupBy("invoice_id").agg(F.sum("line_amount").alias("s"))
    joined = lake.invoices.join(sums, "invoice_id", "full")
    assert joined.filter("s IS NULL OR total_amount IS NULL OR s <> total_amount").count() == 0


def test_pallets_add_up_to_the_bill(lake):
    sums = lake.pallets.groupBy("freight_bill_id").agg(F.sum("weight_kg").alias("s"), F.count("*").alias("n"))
    joined = lake.freight_bills.join(sums, "freight_bill_id", "full")
    assert joined.filter("s IS NULL OR s <> total_weight_kg OR n <> total_pallets").count() == 0


def test_bands_cover_every_roll_once(lake):
    bands = people.supplier_bands(lake)
    rolls = bands.select("nation_id", F.explode(F.sequence("cum_low", "cum_high")).alias("roll"))
    check = rolls.groupBy("nation_id").agg(F.count("*").alias("n"), F.countDistinct("roll").alias("d"), F.max("roll").alias("m"))
    assert check.filter("n <> d OR d <> m").count() == 0


def test_one_rate_per_tier_zone_and_day(lake):
    priced = billing.package_quotes(lake)
    assert priced.count() == priced.select("package_id").distinct().count() == lake.packages.count()


def test_event_times_never_run_back(lake):
    from haulmark.plans.quality import out_of_order
    assert out_of_order(lake.tracking_events, ["entity_type", "entity_id"], "event_id", "event_ts").count() == 0


def test_every_employee_is_in_the_org_chart_once(lake):
    chart = people.org_chart(lake)
    assert chart.count() == chart.select("employee_id").distinct().count() == lake.employees.count()


def test_partial_payments_never_exceed_the_invoice(lake):
    applied = billing.applied_payments(lake)
    assert applied.filter("balance < 0 OR paid < 0").count() == 0
    assert {"Paid", "PartiallyPaid"} <= {r.status for r in applied.select("status").distinct().collect()}


def test_chains_and_circles_of_blockers(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (4, 2), (7, 8), (8, 9), (9, 7), (10, 7), (5, 0)],
                                  "session_id long, blocking_session_id long")
    got = {r.session_id: (r.head_session, r.depth) for r in telemetry.head_blockers(edges).collect()}
    assert got == {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (1, 2),
                   7: (7, 0), 8: (7, 0), 9: (7, 0), 10: (7, 1)}  # a deadlock is the head of what waits for it


def test_tree_paths(spark):
    nodes = spark.createDataFrame([(1, None), (2, 1), (3, 2), (9, None)], "id long, up long")
    assert rows(walk_down(nodes, "id", "up").select("node", "root", "depth", "path")) == [
        (1, 1, 0, "1"), (2, 1, 1, "1/2"), (3, 1, 2, "1/2/3"), (9, 9, 0, "9")]


def test_updates_pick_one_of_several_matches(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    updates = spark.createDataFrame([(1, "x", 1), (1, "w", 2), (3, "z", 1), (8, "q", 1)], "k int, v string, seq int")
    assert rows(changes.update_from(target, updates, "k", ["v"], prefer=["seq"])) == [(1, "w"), (2, "b"), (3, "z")]


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    assert rows(changes.delete_where(df, F.col("x") > 2)) == [(1,), (None,)]


def test_deadlock_reports_are_found_among_other_events(spark):
    xml = ('<RingBufferTarget><event name="error_reported" timestamp="2024-01-01T00:00:00"><x>xml_deadlock_report</x></event>'
           '<event name="xml_deadlock_report" timestamp="2024-01-02T03:04:05"><v/></event>'
           '<event timestamp="2024-01-03T00:00:00" name="xml_deadlock_report"/></RingBufferTarget>')
    df = spark.createDataFrame([(1, xml), (2, "<RingBufferTarget/>")], "id int, xml string")
    got = telemetry.deadlocks(df, F.col("xml"), "id").collect()
    assert sorted((r.id, r.deadlock_time) for r in got) == [
        (1, dt.datetime(2024, 1, 2, 3, 4, 5)), (1, dt.datetime(2024, 1, 3))]


def test_entry_contract(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).columns == ["service_tier", "month", "packages", "billable_kg", "revenue"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_packages_without_a_card_keep_a_null_quote(spark, lake):
    """Too early, too heavy, or of a tier without cards: nothing disappears from the revenue."""
    class Some:
        rate_cards = lake.rate_cards
        packages = lake.packages.limit(5).withColumn("n", F.monotonically_increasing_id() % 5).select(
            "package_id", "origin_nation", "dim_weight_kg",
            F.when(F.col("n") == 1, "Drone").otherwise(F.col("service_tier")).alias("service_tier"),
            F.when(F.col("n") == 2, F.lit("1990-01-01").cast("timestamp_ntz")).otherwise(F.col("created_at")).alias("created_at"),
            F.when(F.col("n") == 3, F.lit("5000.00").cast("decimal(8,2)")).otherwise(F.col("actual_weight_kg")).alias("actual_weight_kg"))
    got = billing.package_quotes(Some).select("package_id", "quote").collect()
    assert len(got) == 5 == len({r.package_id for r in got}) and sum(r.quote is None for r in got) == 3


def test_staffing_plan_names_the_titles(spark, lake):
    plan = run("b28_staffing_plan", spark, SF_DIR)
    titles = {1: {"Facility Manager"}, 2: {"Operations Supervisor", "Dispatch Supervisor"}}
    found = plan.select("role_level", "is_driver", "planned_title").distinct().collect()
    assert found and all(r.planned_title in titles.get(r.role_level, {r.planned_title}) for r in found)
    assert all(("Driver" in r.planned_title) == r.is_driver for r in found)


def test_vehicles_have_make_and_model(spark, lake):
    models = {"Semi": {"Cascadia"}, "Box Truck": {"MT45"}, "Cargo Van": {"Transit", "Sprinter"}}
    found = run("j14_lateral_columns", spark, SF_DIR).collect()
    assert found and all(r.model in models[r.vehicle_type] and r.make for r in found)
    assert all((r.make == "Ford") == (r.model == "Transit") for r in found if r.vehicle_type == "Cargo Van")
