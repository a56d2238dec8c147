"""Hash trees find every change between a table and its copy, and read only what lies below a difference."""

import pytest
from pyspark.sql import functions as F

from haulmark.plans import copies
from haulmark.plans.quality import RULES, Rules

_c = F.col


@pytest.fixture
def data(spark, monkeypatch):
    """Keys of both signs, far apart, and some without a key."""
    monkeypatch.setitem(RULES, "t", Rules([["k"]]))
    monkeypatch.setitem(RULES, "u", Rules([["k"]]))
    n = _c("id")
    return spark.range(20_000).select(
        F.when(n < 9_000, n * 7).when(n < 15_000, -n * 11).when(n < 19_990, n + 10**15).alias("k"),
        (n % 5).cast("string").alias("a"), F.when(n % 3 == 0, (n % 7).cast("string")).alias("b"))


def found(a, b):
    return {(r.table_name, r.low, r.high, r.rows_a, r.rows_b) for r in copies.differing(a, b).collect()}


def leaf(key):
    low = key // copies.LEAF_KEYS * copies.LEAF_KEYS
    return low, low + copies.LEAF_KEYS - 1


def test_equal_copies_in_any_order(spark, data):
    a, b = copies.HashTree({"t": data, "u": data.limit(10)}), copies.HashTree({"t": data.repartition(5).select("b", "k", "a"), "u": data.limit(10)})
    assert found(a, b) == set()
    assert {(r.table_name, r.rows_a, r.same, r.ranges) for r in copies.verdicts(a, b).collect()} == {("t", 20_000, True, 0), ("u", 10, True, 0)}


@pytest.mark.parametrize("key", [-99_000])
def test_one_changed_moved_lost_or_added_row_is_located(spark, data, key):
    hit = _c("k") == key
    assert data.filter(hit).count() == 1
    changed = data.withColumn("a", F.when(hit, "x").otherwise(_c("a")))
    moved = data.withColumns({"a": F.when(hit, None).otherwise(_c("a")), "b": F.when(hit, _c("a")).otherwise(_c("b"))})
    lost, added = data.filter(~F.coalesce(hit, F.lit(False))), data.unionAll(data.filter(hit))
    low, high = leaf(key)
    n = data.filter(_c("k").between(low, high)).count()
    source = copies.HashTree({"t": data})
    for copy, rows in ((changed, n), (moved, n), (lost, n - 1), (added, n + 1)):
        assert found(source, copies.HashTree({"t": copy})) == {("t", low, high, n, rows)}


def test_rows_without_a_key_and_missing_tables(spark, data):
    a = copies.HashTree({"t": data})
    b = copies.HashTree({"t": data.withColumn("a", F.when(_c("k").isNull(), "x").otherwise(_c("a")))})
    assert found(a, b) == {("t", None, None, 10, 10)}
    small = copies.HashTree({"t": data.filter("k = 7")})
    assert sum(r[3] for r in found(a, small)) == 20_000 and sum(r[4] for r in found(a, small)) in (0, 1)


def test_a_comparison_reads_below_differences_only(spark, data, monkeypatch):
    a = copies.HashTree({"t": data})
    b = copies.HashTree({"t": data.withColumn("a", F.when(_c("k") == 7, "x").otherwise(_c("a")))})
    sizes, plain = [], copies._unequal

    def counted(left, right):
        sizes.append(left.count())
        return plain(left, right)
    monkeypatch.setattr(copies, "_unequal", counted)
    assert len(found(a, b)) == 1
    assert a.level(0).count() > 30 and max(sizes) <= copies.FANOUT


def test_hash_sums_are_whole_numbers_of_longs(spark):
    """Hashes are summed as longs in pieces; the sum is that of the hashes, also where it leaves the range of a long."""
    ids = spark.range(10_000).select(F.xxhash64("id").alias("__first"), F.lit(0).cast("long").alias("__second"))
    ends = spark.createDataFrame([(v, 0) for v in (2**63 - 1, 2**63 - 1, -2**63, -2**63, -2**63, -1, 0)], "__first long, __second long")
    for df in (ids, ends):
        held = df.agg(*copies._content())
        assert held.first()["content"] == df.agg(F.sum(_c("__first").cast("decimal(38,0)"))).first()[0]
    assert "sum(cast" not in held._jdf.queryExecution().optimizedPlan().toString().lower()


def test_tables_are_hashed_side_by_side(spark):
    from threading import Barrier
    meet = Barrier(2)
    assert copies.side_by_side(lambda name: meet.wait(60) >= 0, ["t", "u"]) == {"t": True, "u": True}
