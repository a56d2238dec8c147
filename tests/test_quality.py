"""One broken row per rule has to be found, and clean tables have to stay clean."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from haulmark.plans import quality as Q
from haulmark.plans.quality import RULES
from tests.conftest import SF_DIR, rows


def violations(report):
    return {r.rule: r.violations for r in report.collect() if r.violations}


# table -> change to its first row -> rules that must then report exactly one violation
BROKEN = [
    ("addresses", {"country_code": "'XX'"}, {"check:country_code"}),
    ("addresses", {"country_code": "'USA'"}, {"check:country_code", "fixed_length:country_code"}),
    ("business_accounts", {"payment_terms_days": "31"}, {"check:payment_terms"}),
    ("business_accounts", {"account_status": "'Gone'"}, {"check:account_status"}),
    ("business_accounts", {"account_name": "NULL"}, {"not_null:account_name"}),
    ("account_addresses", {"address_role": "'Attic'"}, {"check:address_role"}),
    ("facilities", {"facility_type": "'Kiosk'"}, {"check:facility_type"}),
    ("zone_postal_codes", {"min_postal_code": "'99999'", "max_postal_code": "'00000'"}, {"check:postal_range"}),
    ("routes", {"dest_facility_id": "origin_facility_id"}, {"check:different_facilities"}),
    ("routes", {"transit_days": "0"}, {"check:transit_days"}),
    ("shipments", {"sender_customer_id": "NULL", "sender_account_id": "NULL"}, {"check:sender"}),
    ("shipments", {"sender_customer_id": "1", "sender_account_id": "3"}, {"check:sender"}),
    ("shipments", {"dest_address_id": "origin_address_id"}, {"check:addresses_differ"}),
    ("shipments", {"shipment_status": "'Lost'"}, {"check:shipment_status"}),
    ("shipments", {"retail_payment_status": "'Owed'"}, {"check:retail_payment_status"}),
    ("shipments", {"tracking_number": "'TLG'"}, {"fixed_length:tracking_number"}),
    ("packages", {"actual_weight_kg": "CAST(0 AS DECIMAL(8,2))"}, {"check:weight"}),
    ("packages", {"width_cm": "CAST(-1 AS DECIMAL(8,2))"}, {"check:dimensions"}),
    ("freight_bills", {"total_pallets": "0L"}, {"check:pallets"}),
    ("pallets", {"weight_kg": "CAST(-5 AS DECIMAL(8,2))"}, {"check:weight"}),
    ("tracking_events", {"package_id": "1L", "pallet_id": "1L"}, {"check:entity"}),
    ("tracking_events", {"entity_type": "'Crate'"}, {"check:entity"}),
    ("tracking_events", {"event_code": "'SEEN'"}, {"check:event_code"}),
    ("employees", {"termination_date": "date_sub(hire_date, 1)"}, {"check:termination"}),
    ("vehicles", {"vehicle_type": "'Bike'"}, {"check:vehicle_type"}),
    ("vehicles", {"capacity_class": "'Tiny'"}, {"check:capacity_class"}),
    ("vehicles", {"vehicle_status": "'Sold'"}, {"check:vehicle_status"}),
    ("vehicles", {"max_payload_kg": "CAST(0 AS DECIMAL(10,2))"}, {"check:payload"}),
    ("assignments", {"shift_end": "shift_start"}, {"check:shift"}),
    ("assignments", {"assignment_status": "'Maybe'"}, {"check:assignment_status"}),
    ("rate_cards", {"max_weight_kg": "min_weight_kg"}, {"check:weight_band"}),
    ("rate_cards", {"base_rate": "CAST(-1 AS DECIMAL(10,2))"}, {"check:base_rate"}),
    ("rate_cards", {"effective_to": "date_sub(effective_from, 1)"}, {"check:effective_dates"}),
    ("rate_cards", {"service_tier": "'Air'"}, {"check:service_tier"}),
    ("invoices", {"due_date": "date_sub(invoice_date, 1)"}, {"check:due_date"}),
    ("invoices", {"total_amount": "CAST(-1 AS DECIMAL(12,2))"}, {"check:total_amount"}),
    ("invoices", {"invoice_status": "'Lost'"}, {"check:invoice_status"}),
    ("invoice_lines", {"line_amount": "CAST(-1 AS DECIMAL(10,2))"}, {"check:line_amount"}),
    ("payments", {"amount_paid": "CAST(0 AS DECIMAL(12,2))"}, {"check:amount"}),
    ("payments", {"payment_method": "'Barter'"}, {"check:payment_method"}),
]


@pytest.mark.parametrize("table,change,rules", BROKEN, ids=[f"{t}-{'-'.join(c)}-{i}" for i, (t, c, _) in enumerate(BROKEN)])
def test_broken_row_is_found(lake, table, change, rules):
    key = RULES[table].keys[0][0]
    stored = lake.warehouse[table]
    first = stored.agg(F.min(key)).first()[0]
    hit = F.col(key) == first
    if len(RULES[table].keys[0]) > 1 or table == "account_addresses":
        one = stored.filter(hit).limit(1)
    else:
        one = stored.filter(hit)
    broken = one.withColumns({c: F.expr(v).cast(stored.schema[c].dataType) for c, v in change.items()})
    found = violations(Q.row_rule_report(table, broken, Q.row_predicates(RULES[table])))
    assert found == dict.fromkeys(rules, 1)


def test_checks_pass_on_unknown(spark):
    df = spark.createDataFrame([(None,), (5,), (-5,)], "x int")
    assert violations(Q.row_rule_report("t", df, {"check:x": "x > 0"})) == {"check:x": 1}


def test_two_null_emails_are_duplicates(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "b")], "k int, email string")
    assert violations(Q.unique_report("t", df, ["email"])) == {"unique:email": 1}
    assert violations(Q.unique_report("t", df, ["k"])) == {}


def test_unique_text_ignores_case(spark):
    df = spark.createDataFrame([("a@x",), ("A@X",), ("b@x",)], "email string")
    assert violations(Q.unique_report("t", df, ["email"])) == {"unique:email": 1}


def test_orphans_are_counted_per_row_and_null_is_allowed(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "ref int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    report = Q.reference_report("child", child, "ref", "parent", parent, "id")
    assert violations(report) == {"reference:ref->parent": 2}


def test_late_event_and_bill_without_pallet(spark):
    at = dt.datetime
    events = spark.createDataFrame(
        [(1, 1, at(2024, 1, 1, 5)), (1, 2, at(2024, 1, 1, 4)), (1, 3, at(2024, 1, 1, 4)), (2, 4, at(2024, 1, 1))],
        "entity int, id long, ts timestamp_ntz")
    assert [r.id for r in Q.out_of_order(events, ["entity"], "id", "ts").collect()] == [2]
    bills = spark.createDataFrame([(1,), (2,)], "freight_bill_id int")
    pallets = spark.createDataFrame([(2,), (2,)], "freight_bill_id int")
    assert [r[0] for r in Q.bills_without_pallets(bills, pallets).collect()] == [1]


def test_loaded_tables_are_clean(lake):
    report = Q.integrity_report(lake.warehouse).filter("violations > 0")
    # Numbers repeat only once the five-digit sequence has wrapped, which this input is too small for.
    assert report.collect() == []
    Q.require_clean(report)


def test_violations_raise(spark):
    bad = spark.createDataFrame([("t", "r", 2)], "table_name string, rule string, violations long")
    with pytest.raises(Q.RuleViolation, match="t r: 2"):
        Q.require_clean(bad)


def test_rule_catalog_is_complete():
    assert len(RULES) == 22
    assert sum(len(r.domains) + len(r.orders) + len(r.xors) + len(r.differs) for r in RULES.values()) == 38
    assert sum(len(r.refs) for r in RULES.values()) == 31  # the operator of an event is checked on its own
    assert sum(len(r.keys) for r in RULES.values()) == 22 + 14


def test_fingerprint_sees_paired_duplicates(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    doubled = a.unionAll(spark.createDataFrame([(3, "z"), (3, "z")], "k int, v string"))
    assert Q.fingerprint(a).first() != Q.fingerprint(doubled).first()
    assert Q.fingerprint(a).first() == Q.fingerprint(a.orderBy(F.desc("k")).select("v", "k")).first()


def test_fingerprint_sees_a_value_moved_between_null_columns(spark):
    left = spark.createDataFrame([("a", None)], "x string, y string")
    right = spark.createDataFrame([(None, "a")], "x string, y string")
    assert Q.fingerprint(left).first() != Q.fingerprint(right).first()


def test_profile_orders_numbers_as_numbers(spark):
    row = Q.profile(spark.createDataFrame([(9,), (10,), (200,)], "n long"), ["n"]).first()
    assert (row["smallest"], row["largest"]) == ("9", "200")


def test_row_rules_ask_only_for_tables_that_have_one(spark, lake):
    """Loading the other tables is most of the work of a whole check."""
    class Asked(dict):
        asked = []

        def __missing__(self, name):
            self.asked.append(name)
            return lake.derive(name)

        def __iter__(self):
            return iter(Q.RULES)

    tables = Asked()
    assert rows(Q.row_rules(tables, ("differs",))) == [
        ("routes", "check:different_facilities", 0), ("shipments", "check:addresses_differ", 0)]
    assert tables.asked == ["routes", "shipments"]


def test_unique_values_are_counted_behind_the_exchange(spark):
    df = spark.createDataFrame([("a", 1), ("A", 1), (None, 2), (None, 2), ("b", 3)], "t string, n int")
    report = Q.unique_report("t", df, ["t", "n"])
    assert rows(report) == [("t", "unique:t,n", 2)]
    assert "REPARTITION_BY_COL" in report._jdf.queryExecution().executedPlan().toString()


def test_operators_counted_per_pick_are_those_of_the_events(spark, lake):
    events = lake.staffed_events.filter("operator_id IS NOT NULL").groupBy("operator_id").count()
    assert rows(lake.operator_counts) == rows(events) != []


def test_counting_the_tables_does_not_store_the_event_log(spark):
    from haulmark.catalog.summaries import table_counts
    from haulmark.plans.lake import Lake
    fresh = Lake(spark, SF_DIR)
    counts = {r.table_name: r.n for r in table_counts(fresh).collect()}
    assert "tracking_events" not in fresh.warehouse._tables and counts["tracking_events"] > 0
    assert counts["tracking_events"] == fresh.warehouse["tracking_events"].count()
