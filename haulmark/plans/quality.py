"""Declared rules of all tables as data, and the checks that evaluate them.

Every check gives (table_name, rule, violations). A CHECK is violated only where it is known to be false.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmark.functions.scalars import holds
from haulmark.operators.joins import missing_in
from haulmark.operators.ordered import lag_within
from haulmark.plans import fixed as X


def one_of(column: str, allowed) -> str:
    items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in allowed)
    return f"{column} IN ({items})"


def one_set(a: str, b: str) -> str:
    return f"(({a} IS NULL) <> ({b} IS NULL))"


@dataclass
class Rules:
    keys: list[list[str]]                                                # primary key first, then unique keys
    refs: list[tuple[str, str, str]] = field(default_factory=list)        # column, table, its key
    domains: dict[str, str] = field(default_factory=dict)                 # rule -> SQL predicate
    orders: dict[str, str] = field(default_factory=dict)
    xors: dict[str, str] = field(default_factory=dict)
    differs: dict[str, str] = field(default_factory=dict)
    required: list[str] = field(default_factory=list)                     # NOT NULL
    lengths: dict[str, int] = field(default_factory=dict)                 # longest allowed text
    exact: dict[str, int] = field(default_factory=dict)                   # fixed-length text


RULES: dict[str, Rules] = {
    "addresses": Rules(
        [["address_id"]], domains={"country_code": one_of("country_code", X.COUNTRIES)},
        required=["address_line1", "city", "postal_code", "country_code"],
        lengths={"address_line1": 200, "address_line2": 200, "city": 100, "postal_code": 20},
        exact={"country_code": 2}),
    "customers": Rules(
        [["customer_id"], ["email"]], required=["first_name", "last_name"],
        lengths={"first_name": 100, "last_name": 100, "email": 200, "phone": 30}),
    "business_accounts": Rules(
        [["account_id"]],
        domains={"payment_terms": one_of("payment_terms_days", X.PAYMENT_TERMS),
                 "account_status": one_of("account_status", X.ACCOUNT_STATUSES)},
        required=["account_name", "credit_currency", "payment_terms_days", "account_status"],
        lengths={"account_name": 200, "tax_id": 50}, exact={"credit_currency": 3}),
    "business_contacts": Rules(
        [["contact_id"]], refs=[("account_id", "business_accounts", "account_id")],
        required=["account_id", "first_name", "last_name", "is_primary"],
        lengths={"first_name": 100, "last_name": 100, "email": 200, "job_title": 100}),
    "account_addresses": Rules(
        [["address_id"], ["account_id", "address_id", "address_role"]],
        refs=[("account_id", "business_accounts", "account_id"), ("address_id", "addresses", "address_id")],
        domains={"address_role": one_of("address_role", X.ADDRESS_ROLES)},
        required=["account_id", "address_role", "is_primary"], lengths={"address_role": 30}),
    "facilities": Rules(
        [["facility_id"], ["facility_code"]],
        refs=[("address_id", "addresses", "address_id"), ("parent_facility_id", "facilities", "facility_id")],
        domains={"facility_type": one_of("facility_type", X.FACILITY_TYPES)},
        required=["facility_code", "facility_name", "facility_type", "address_id"],
        lengths={"facility_name": 200, "facility_type": 30}),
    "service_zones": Rules(
        [["zone_id"], ["zone_code"]], required=["zone_code", "zone_name", "country_code"],
        lengths={"zone_code": 10, "zone_name": 100}, exact={"country_code": 2}),
    "zone_postal_codes": Rules(
        [["zone_id", "min_postal_code"]], refs=[("zone_id", "service_zones", "zone_id")],
        orders={"postal_range": "min_postal_code <= max_postal_code"},
        required=["min_postal_code", "max_postal_code"], lengths={"min_postal_code": 20, "max_postal_code": 20}),
    "routes": Rules(
        [["route_id"], ["route_code"]],
        refs=[("origin_facility_id", "facilities", "facility_id"), ("dest_facility_id", "facilities", "facility_id")],
        domains={"service_tier": one_of("service_tier", X.SERVICE_TIERS)},
        orders={"transit_days": "transit_days >= 1"},
        differs={"different_facilities": "origin_facility_id <> dest_facility_id"},
        required=["route_code", "origin_facility_id", "dest_facility_id", "transit_days"],
        lengths={"service_tier": 20}),
    "shipments": Rules(
        [["shipment_id"], ["tracking_number"]],
        refs=[("sender_customer_id", "customers", "customer_id"),
              ("sender_account_id", "business_accounts", "account_id"),
              ("origin_address_id", "addresses", "address_id"), ("dest_address_id", "addresses", "address_id")],
        domains={"service_tier": one_of("service_tier", X.SERVICE_TIERS),
                 "shipment_status": one_of("shipment_status", X.SHIPMENT_STATUSES),
                 "retail_payment_status": "retail_payment_status IS NULL OR "
                                          + one_of("retail_payment_status", X.RETAIL_PAYMENT_STATUSES)},
        xors={"sender": one_set("sender_customer_id", "sender_account_id")},
        differs={"addresses_differ": "origin_address_id <> dest_address_id"},
        required=["tracking_number", "service_tier", "is_cross_border", "shipment_status", "created_at"],
        lengths={"shipment_status": 30, "retail_payment_method": 30}, exact={"tracking_number": 18}),
    "packages": Rules(
        [["package_id"], ["tracking_number"]], refs=[("shipment_id", "shipments", "shipment_id")],
        orders={"weight": "actual_weight_kg > 0",
                "dimensions": "length_cm > 0 AND width_cm > 0 AND height_cm > 0"},
        required=["shipment_id", "actual_weight_kg", "package_status"],
        lengths={"package_status": 30}, exact={"tracking_number": 18}),
    "freight_bills": Rules(
        [["freight_bill_id"], ["shipment_id"], ["bol_number"]], refs=[("shipment_id", "shipments", "shipment_id")],
        orders={"weight": "total_weight_kg > 0", "pallets": "total_pallets >= 1"},
        required=["bol_number", "total_weight_kg", "hazmat"], lengths={"bol_number": 30}),
    "pallets": Rules(
        [["pallet_id"], ["freight_bill_id", "pallet_number"]],
        refs=[("freight_bill_id", "freight_bills", "freight_bill_id")],
        orders={"weight": "weight_kg > 0"}, required=["freight_bill_id", "pallet_number", "weight_kg"]),
    "tracking_events": Rules(
        [["event_id"]],
        refs=[("package_id", "packages", "package_id"), ("pallet_id", "pallets", "pallet_id"),
              ("facility_id", "facilities", "facility_id")],
        domains={"event_code": one_of("event_code", X.EVENT_CODES)},
        xors={"entity": "((package_id IS NOT NULL AND pallet_id IS NULL AND entity_type = 'Package') OR "
                        "(pallet_id IS NOT NULL AND package_id IS NULL AND entity_type = 'Pallet'))"},
        required=["entity_type", "facility_id", "event_code", "event_ts"],
        lengths={"entity_type": 10, "event_code": 30}),
    "employees": Rules(
        [["employee_id"], ["employee_number"], ["email"]],
        refs=[("facility_id", "facilities", "facility_id"), ("manager_id", "employees", "employee_id")],
        orders={"termination": "termination_date IS NULL OR termination_date >= hire_date"},
        required=["employee_number", "full_name", "email", "facility_id", "job_title", "hire_date"],
        lengths={"employee_number": 20, "full_name": 200, "email": 200, "job_title": 100}),
    "drivers": Rules(
        [["employee_id"]], refs=[("employee_id", "employees", "employee_id")],
        required=["line_count", "facility_id"]),
    "vehicles": Rules(
        [["vehicle_id"], ["license_plate", "plate_state"]], refs=[("facility_id", "facilities", "facility_id")],
        domains={"vehicle_type": one_of("vehicle_type", X.VEHICLE_TYPES),
                 "capacity_class": one_of("capacity_class", X.CAPACITY_CLASSES),
                 "vehicle_status": one_of("vehicle_status", X.VEHICLE_STATUSES)},
        orders={"payload": "max_payload_kg > 0"},
        required=["license_plate", "vehicle_type", "max_payload_kg", "facility_id"],
        lengths={"license_plate": 20}, exact={"plate_state": 2}),
    "assignments": Rules(
        [["assignment_id"]],
        refs=[("driver_id", "drivers", "employee_id"), ("vehicle_id", "vehicles", "vehicle_id"),
              ("route_id", "routes", "route_id")],
        domains={"assignment_status": one_of("assignment_status", X.ASSIGNMENT_STATUSES)},
        orders={"shift": "shift_end > shift_start"},
        required=["driver_id", "vehicle_id", "route_id", "assignment_date"], lengths={"assignment_status": 20}),
    "rate_cards": Rules(
        [["rate_card_id"]],
        refs=[("zone_id", "service_zones", "zone_id"), ("dest_zone_id", "service_zones", "zone_id")],
        domains={"service_tier": one_of("service_tier", X.SERVICE_TIERS)},
        orders={"weight_band": "min_weight_kg >= 0 AND max_weight_kg > min_weight_kg",
                "base_rate": "base_rate >= 0",
                "effective_dates": "effective_to IS NULL OR effective_to >= effective_from"},
        required=["service_tier", "base_rate", "effective_from"], exact={"rate_currency": 3}),
    "invoices": Rules(
        [["invoice_id"], ["invoice_number"]], refs=[("account_id", "business_accounts", "account_id")],
        domains={"invoice_status": one_of("invoice_status", X.INVOICE_STATUSES)},
        orders={"due_date": "due_date >= invoice_date", "total_amount": "total_amount >= 0"},
        required=["invoice_number", "account_id", "invoice_date", "total_amount", "rate_to_usd"],
        lengths={"invoice_number": 30}, exact={"currency": 3}),
    "invoice_lines": Rules(
        [["invoice_id", "shipment_id"]],
        refs=[("invoice_id", "invoices", "invoice_id"), ("shipment_id", "shipments", "shipment_id")],
        orders={"line_amount": "line_amount >= 0"}, required=["invoice_id", "shipment_id", "line_amount"],
        lengths={"line_description": 200}, exact={"currency": 3}),
    "payments": Rules(
        [["payment_id"]], refs=[("invoice_id", "invoices", "invoice_id")],
        domains={"payment_method": one_of("payment_method", X.PAYMENT_METHODS)},
        orders={"amount": "amount_paid > 0"}, required=["invoice_id", "payment_date", "amount_paid"],
        lengths={"payment_method": 50, "payment_reference": 100}, exact={"currency": 3}),
}

ROW_KINDS = ("domains", "orders", "xors", "differs", "required", "lengths", "exact")


def row_predicates(rules: Rules, kinds=ROW_KINDS) -> dict[str, str]:
    """Rule name -> SQL predicate for every rule that one row decides on its own."""
    out: dict[str, str] = {}
    for kind in kinds:
        part = getattr(rules, kind)
        if kind == "required":
            out.update({f"not_null:{c}": f"{c} IS NOT NULL" for c in part})
        elif kind == "lengths":
            out.update({f"max_length:{c}": f"length({c}) <= {n}" for c, n in part.items()})
        elif kind == "exact":
            out.update({f"fixed_length:{c}": f"length({c}) = {n}" for c, n in part.items()})
        else:
            out.update({f"check:{name}": predicate for name, predicate in part.items()})
    return out


def row_rule_report(name: str, df: DataFrame, predicates: dict[str, str]) -> DataFrame:
    """All row rules of a table in one scan: one conditional count each, then one row per rule."""
    counts = [F.count_if(~holds(F.expr(p))).alias(f"r{i}") for i, p in enumerate(predicates.values())]
    pairs = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
                      for i, rule in enumerate(predicates)])
    return df.agg(*counts).select(F.lit(name).alias("table_name"), F.inline(pairs))


def unique_report(name: str, df: DataFrame, key: list[str]) -> DataFrame:
    """Number of key values that occur more than once. Nulls count as equal, and text ignores case."""
    named = [f"__key{i}" for i in range(len(key))]
    values = [(F.lower(c) if df.schema[c].dataType.typeName() == "string" else F.col(c)).alias(n) for c, n in zip(key, named)]
    # Counted behind the exchange, since nearly all values are different and a task before it would hold them all.
    repeats = df.select(*values).repartition(*named).groupBy(*named).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return repeats.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("table_name"), F.lit("unique:" + ",".join(key)).alias("rule"), "violations")


def reference_report(name: str, df: DataFrame, column: str, target_name: str, target: DataFrame,
                     key: str, rows: str | None = None) -> DataFrame:
    """Rows whose reference has no target. Values are counted first, so a hot value is one row. ``rows`` is the column with
    the number of rows that a row stands for, where they were counted before."""
    values = (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("__ref"))
              .agg((F.count(F.lit(1)) if rows is None else F.sum(rows)).alias("n")))
    lost = values.join(target.select(F.col(key).alias("__ref")), "__ref", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
        F.lit(name).alias("table_name"), F.lit(f"reference:{column}->{target_name}").alias("rule"), "violations")


def bills_without_pallets(bills: DataFrame, pallets: DataFrame) -> DataFrame:
    return missing_in(bills, pallets, "freight_bill_id")


def out_of_order(events: DataFrame, entity: list[str], order: str, ts: str) -> DataFrame:
    """Events earlier than the one before them in id order of the same entity."""
    return lag_within(events, entity, order, ts, "previous_ts").filter(F.col(ts) < F.col("previous_ts"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def row_rules(tables: Mapping[str, DataFrame], kinds=ROW_KINDS) -> DataFrame:
    """Row rules of all tables. A table without such a rule is not asked for, so it is not loaded either."""
    parts = []
    for name in tables:
        predicates = row_predicates(RULES[name], kinds)
        if predicates:
            parts.append(row_rule_report(name, tables[name], predicates))
    return union_all(parts)


def key_rules(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all([unique_report(name, df, key) for name, df in tables.items() for key in RULES[name].keys])


class UncheckedReference(LookupError):
    """A reference whose target is not at hand."""


def reference_rules(tables: Mapping[str, DataFrame], stored: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Orphans of every declared reference. A target that is not among ``tables`` is looked up in ``stored``; one that is
    in neither raises, since its rows cannot be known to be right."""
    parts = []
    for name, df in tables.items():
        for column, target, key in RULES[name].refs:
            of = tables if target in tables else stored or {}
            if target not in of:
                raise UncheckedReference(f"{name}.{column} refers to {target}, which is not there")
            parts.append(reference_report(name, df, column, target, of[target], key))
    return union_all(parts)


def sum_rules(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Totals that have to agree with their parts: invoices with lines, bills with pallets. A part that is missing counts."""
    def differ(name, rule, heads, parts, key, total):
        sums = parts.groupBy(key).agg(F.sum("part").alias("parts"))
        return (heads.select(key, total).join(sums, key, "full_outer")
                .agg(F.count_if(~F.col(total).eqNullSafe(F.col("parts"))).alias("violations"))
                .select(F.lit(name).alias("table_name"), F.lit(rule).alias("rule"), "violations"))
    parts = []
    if {"invoices", "invoice_lines"} <= set(tables):
        lines = tables["invoice_lines"].select("invoice_id", F.col("line_amount").alias("part"))
        parts.append(differ("invoices", "sum:invoice_lines", tables["invoices"], lines, "invoice_id", "total_amount"))
    if {"freight_bills", "pallets"} <= set(tables):
        weights = tables["pallets"].select("freight_bill_id", F.col("weight_kg").alias("part"))
        parts.append(differ("freight_bills", "sum:pallets", tables["freight_bills"], weights, "freight_bill_id", "total_weight_kg"))
    return union_all(parts)


def structure_rules(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rules across rows that are not keys or references: bills need pallets, events run forward."""
    count = F.count(F.lit(1)).alias("violations")
    bills = bills_without_pallets(tables["freight_bills"], tables["pallets"]).agg(count).select(
        F.lit("freight_bills").alias("table_name"), F.lit("has_pallets").alias("rule"), "violations")
    # An entity has at most six events, so a plain window does: one exchange and one scan.
    entity = Window.partitionBy("entity_type", "entity_id").orderBy("event_id")
    events = tables["tracking_events"].select("event_ts", F.lag("event_ts").over(entity).alias("previous_ts"))
    late = events.filter("event_ts < previous_ts").agg(count).select(
        F.lit("tracking_events").alias("table_name"), F.lit("time_order").alias("rule"), "violations")
    return bills.unionAll(late)


def verification_report(tables: Mapping[str, DataFrame], staffed_events: DataFrame, rows: str | None = None) -> DataFrame:
    """The checks every load has to pass: one sender, known operators, bills with pallets, events in order."""
    sender = row_rule_report("shipments", tables["shipments"], row_predicates(RULES["shipments"], ("xors",)))
    operators = reference_report("tracking_events", staffed_events, "operator_id", "employees",
                                 tables["employees"], "employee_id", rows)
    return union_all([sender, operators, structure_rules(tables)])


def integrity_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared rule of every table in one report."""
    parts = [row_rules(tables), key_rules(tables), reference_rules(tables), structure_rules(tables)]
    return union_all(parts)


class RuleViolation(RuntimeError):
    """A verification check found violations."""


def require_clean(report: DataFrame) -> None:
    """Raise when any rule of a report is violated. Only the offending rules reach the driver."""
    bad = report.filter("violations > 0").collect()  # bounded by the number of rules
    if bad:
        raise RuleViolation("; ".join(f"{r.table_name} {r.rule}: {r.violations}" for r in bad))


def count_violations(tables: Mapping[str, DataFrame], stored: Mapping[str, DataFrame] | None = None) -> int:
    """Violations of the row, key and reference rules and of totals; references lead to the given tables or to ``stored``."""
    report = union_all([row_rules(tables), key_rules(tables), reference_rules(tables, stored)]
                       + ([sum_rules(tables)] if {"invoices", "invoice_lines"} <= set(tables) or {"freight_bills", "pallets"} <= set(tables) else []))
    return report.agg(F.coalesce(F.sum("violations"), F.lit(0)).cast("long")).first()[0]


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Column statistics in one scan: rows, nulls, distinct values, smallest and largest value."""
    stats = []
    for c in columns:
        stats.append(F.struct(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.approx_count_distinct(c, 0.01).alias("approx_distinct"),
            F.min(c).cast("string").alias("smallest"), F.max(c).cast("string").alias("largest")))
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and order-free content hash; decimal sums cannot overflow or cancel pairs.

    The hash skips nulls, so each column's null flag is hashed as well: a value that moved to another column shows.
    """
    parts = [part for c in sorted(df.columns) for part in (F.col(c), F.col(c).isNull())]
    row_hash = F.xxhash64(*parts).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(row_hash).alias("content_hash"))
