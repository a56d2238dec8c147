import datetime as dt

from pyspark.sql import functions as F

from haulmark.operators.joins import (
    effective_join, found_in, left_join_many, missing_in, postal_zone_join, range_join)
from tests.conftest import rows


def test_range_join_against_brute_force(spark):
    ranges = [(g, lo, lo + width) for g in (0, 1) for lo, width in ((0, 9), (5, 0), (10, 130), (120, 40))]
    facts = [(i, i % 2, v) for i, v in enumerate([0, 5, 9, 10, 63, 64, 65, 128, 139, 140, 160, 161])]
    got = range_join(spark.createDataFrame(facts, "i int, g int, v int"),
                     spark.createDataFrame(ranges, "g int, lo int, hi int"), "v", "lo", "hi", ["g"], cell=64)
    want = sorted((i, g, v, lo, hi) for i, g, v in facts for h, lo, hi in ranges if g == h and lo <= v <= hi)
    assert sorted(map(tuple, got.collect())) == want


def test_both_ends_of_a_rate_period_count(spark):
    d = dt.date
    history = spark.createDataFrame(
        [("G", 1, d(1995, 1, 1), d(1996, 12, 31)), ("G", 2, d(1997, 1, 1), None)],
        "tier string, rate int, effective_from date, effective_to date")
    facts = spark.createDataFrame(
        [(1, "G", dt.datetime(1996, 12, 31, 23, 59)), (2, "G", dt.datetime(1997, 1, 1)),
         (3, "G", dt.datetime(1994, 12, 31)), (4, "X", dt.datetime(1996, 1, 1)), (5, "G", dt.datetime(2020, 1, 1))],
        "i int, tier string, at timestamp_ntz")
    got = effective_join(facts, history, F.col("at"), ["tier"]).select("i", "rate")
    assert rows(got) == [(1, 1), (2, 2), (5, 2)]


def test_postal_ranges_and_canadian_prefixes(spark):
    zones = spark.createDataFrame(
        [(1, "US-A", "US", "00900", "01099"), (2, "US-B", "US", "01100", "01100"), (3, "CA-A", "CA", "M5H", "M5H")],
        "zone_id int, zone_code string, country_code string, min_postal_code string, max_postal_code string")
    addresses = spark.createDataFrame(
        [(1, "00899", "US"), (2, "00900", "US"), (3, "01099", "US"), (4, "01100", "US"), (5, "01101", "US"),
         (6, "M5H 2N2", "CA"), (7, "M5V 1A1", "CA"), (8, "M5H", "US")],
        "address_id int, postal_code string, country_code string")
    got = postal_zone_join(addresses, zones).select("address_id", "zone_code")
    assert rows(got) == [(2, "US-A"), (3, "US-A"), (4, "US-B"), (6, "CA-A")]


def test_left_join_keeps_rows_without_match(spark):
    one = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    many = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (9, "d")], "k int, v string")
    assert rows(left_join_many(one, many, "k")) == rows(one.join(many, "k", "left"))
    assert rows(missing_in(one, many, "k")) == [(2,)]
    assert rows(found_in(one, many, "k")) == [(1,), (3,)]


def test_hot_join_key_is_split(spark):
    """Half of the facts share one key; without a broadcast AQE splits that partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        facts = spark.range(0, 200000, numPartitions=8).select(
            "id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"))
        joined = facts.join(spark.range(200000).withColumnRenamed("id", "k"), "k")
        assert len(joined.collect()) == 200000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_nested_loop_in_interval_joins(lake):
    from haulmark.catalog.all_queries import PLANS
    for name in ("j11_range_join", "j12_postal_range", "j13_rate_asof", "b17_rate_quote"):
        plan = PLANS[name](lake)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan, name


def test_keys_of_the_other_side_are_reduced_behind_the_exchange(spark):
    """A task that reads the other side does not hold its keys."""
    from haulmark.operators import joins
    one, many = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(1,), (1,), (None,)], "k int")
    for join, want in ((joins.found_in, [(1,)]), (joins.missing_in, [(2,), (None,)])):
        found = join(one, many, "k")
        assert rows(found) == sorted(want, key=repr)
        assert "REPARTITION_BY_COL" in found._jdf.queryExecution().executedPlan().toString()
