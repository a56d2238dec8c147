"""Plans without broadcasts: how often rows are exchanged where tables are read again and again."""

import re

import pytest

from haulmark.catalog.all_queries import PLANS
from haulmark.plans import billing, quality


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange " in line for line in plan.splitlines()), plan.count("FileScan ")


def test_invoices_and_payments_start_from_stored_totals(lake, no_broadcast):
    assert exchanges(lake.invoices) == (0, 1)  # 22 and 12 when totals were derived twice and joined
    assert exchanges(lake.payments) == (0, 1)
    hops, scans = exchanges(billing.applied_payments(lake))
    assert hops <= 6 and scans <= 2  # 33 and 18


def test_tracking_order_needs_one_exchange(lake, no_broadcast):
    late = quality.structure_rules({name: lake.warehouse[name] for name in ("freight_bills", "pallets", "tracking_events")})
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(entity_type") == 1


def test_picks_from_a_numbered_pool_start_from_the_stored_pool(lake, no_broadcast):
    """Three exchanges more than the shipments': both sides of the join and the size of the pool, whose plan is shown repeatedly."""
    def distinct(df):
        return set(re.findall(r"Exchange .*plan_id=(\d+)", df._jdf.queryExecution().executedPlan().toString()))
    assert len(distinct(PLANS["j18_numbered_pool"](lake))) <= len(distinct(lake.shipments.select("shipment_id"))) + 3  # 35 before


def test_shuffles_start_with_partitions_by_the_bytes_of_the_input(spark):
    """Three GB, as six times the larger tables are: a task's share of an exchange does not grow with them."""
    from haulmark.session import _INITIAL, _INPUT_BYTES, partition_for
    before = spark.conf.get(_INITIAL, None)
    try:
        partition_for(spark, 1)
        assert spark.conf.get(_INITIAL, None) == before
        partition_for(spark, 3 << 30)
        assert int(spark.conf.get(_INITIAL)) == (3 << 30) // _INPUT_BYTES
        plan = spark.range(10).repartition("id")._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(id#" in plan and f", {(3 << 30) // _INPUT_BYTES})" in plan
        partition_for(spark, 1 << 30)
        assert int(spark.conf.get(_INITIAL)) == (3 << 30) // _INPUT_BYTES
    finally:
        spark.conf.unset(_INITIAL) if before is None else spark.conf.set(_INITIAL, before)


def test_profiling_all_columns_stores_packages_only(spark):
    from haulmark.plans.lake import Lake
    from tests.conftest import SF_DIR
    fresh = Lake(spark, SF_DIR)
    assert PLANS["q13_all_columns"](fresh).count() > 150
    assert set(fresh.warehouse._tables) == {"packages"}
