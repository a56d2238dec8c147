import json
import os
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from haulmark.catalog.all_queries import run
from haulmark.operators import keys
from haulmark.operators.keys import append_keys, dense_keys, high_water, sequence_keys
from haulmark.session import new_path
from haulmark.sources.commits import Commits
from haulmark.sources.ledger import Ledger
from haulmark.sources.writes import file_sizes
from tests.conftest import SF_DIR, rows


def test_keys_have_no_gaps_and_follow_the_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("b"), (F.col("id") % 3).alias("a"))
    got = [tuple(r) for r in dense_keys(df, ["a", "b"], "k", partitions=7).select("k", "a", "b").orderBy("k").collect()]
    assert [r[0] for r in got] == list(range(1, 5001))
    assert [r[1:] for r in got] == sorted(r[1:] for r in got)


def test_hot_leading_column_is_split(spark):
    """All rows share the first column: the range still splits them on the second."""
    df = spark.range(4000).select(F.lit(1).alias("a"), "id")
    keyed = dense_keys(df, ["a", "id"], "k", partitions=4)
    assert keyed.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert keyed.filter("k <> id + 1").count() == 0


def test_next_load_starts_above_the_high_water_mark(spark):
    first = dense_keys(spark.range(10), ["id"], "k")
    second = append_keys(first, spark.range(100, 105), ["id"], "k")
    assert high_water(first, "k") == 10
    assert [r.k for r in second.orderBy("k").collect()] == [11, 12, 13, 14, 15]


def test_empty_input(spark):
    empty = dense_keys(spark.range(0), ["id"], "k")
    assert rows(empty) == [] and high_water(empty, "k") == 0


def test_numbers_do_not_change_when_read_again(spark):
    keyed = dense_keys(spark.range(1000).select((F.col("id") * 13 % 1000).alias("x")), ["x"], "k", partitions=5)
    assert rows(keyed) == rows(keyed)


def test_ranges_follow_the_stored_bytes(spark, lake, monkeypatch):
    """Joins have no usable statistics, so every caller's rows are sized by what was written."""
    path = new_path(spark, "sized")
    rows_ = lake.shipments.select("shipment_id", "created_at")  # a join of several tables
    rows_.write.parquet(path)
    assert keys.range_count(spark, path) == 1
    monkeypatch.setattr(keys, "_RANGE_BYTES", 1000)
    stored = sum(r["length"] for r in file_sizes(spark, path).collect())
    assert keys.range_count(spark, path) == -(-stored // 1000) > 10
    keyed = dense_keys(rows_, ["shipment_id"], "k")
    assert 10 < len(set(keyed.inputFiles())) <= 2 * -(-stored // 1000)
    assert [r.k for r in keyed.orderBy("shipment_id").collect()] == list(range(1, rows_.count() + 1))


@pytest.mark.parametrize("name", ["s7_ordered_insert", "s8_sequence_keys", "s9_source_key_map"])
def test_every_caller_uses_few_ranges_on_small_input(spark, monkeypatch, name):
    counted, plain = [], keys.range_count
    monkeypatch.setattr(keys, "range_count", lambda *a: counted.append(plain(*a)) or counted[-1])
    run(name, spark, SF_DIR).count()
    assert counted and max(counted) == 1


def test_a_version_is_committed_once(spark):
    commits = Commits(spark, new_path(spark, "commits"))
    assert commits.latest() == 0 and commits.table("by int").count() == 0
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda k: commits.try_commit(1, {"by": k}), range(64)))
    assert sum(won) == 1 and commits.versions() == [1]
    assert commits.read(1) == {"by": won.index(True)} and commits.table("by int").first()["by"] == won.index(True)
    assert not [f for f in os.listdir(commits.root) if f.endswith(".tmp")]


def test_a_rename_does_not_replace_a_commit(spark):
    """The way taken on file systems other than the local one."""
    commits = Commits(spark, new_path(spark, "commits"))
    for k in (1, 2):
        with open(f"{commits.root}/.{k}.tmp", "w") as out:
            out.write(json.dumps({"by": k}))
    assert commits._rename(f"{commits.root}/.1.tmp", commits._file(1))
    assert not commits._rename(f"{commits.root}/.2.tmp", commits._file(1))
    assert commits.read(1) == {"by": 1} and commits.versions() == [1]


def test_concurrent_loads_get_disjoint_ranges_without_gaps(spark):
    ledger = Ledger(spark, new_path(spark, "ledger"))
    sizes = {f"load-{k}": k * 37 % 11 for k in range(12)}
    start = Barrier(len(sizes))

    def load(item):
        start.wait()
        return ledger.reserve("seq", *item)
    with ThreadPoolExecutor(len(sizes)) as pool:
        firsts = dict(zip(sizes, pool.map(load, sizes.items())))
    taken = [n for name, size in sizes.items() for n in range(firsts[name], firsts[name] + size)]
    assert sorted(taken) == list(range(1, sum(sizes.values()) + 1))
    assert {r["load"]: (r["first"], r["n"]) for r in ledger.ranges("seq").collect()} == {k: (firsts[k], n) for k, n in sizes.items()}


def test_a_writer_that_looked_too_early_looks_again(spark, monkeypatch):
    ledger = Ledger(spark, new_path(spark, "ledger"))
    ledger.reserve("seq", "a", 5)
    stale, plain = [0], Commits.latest
    monkeypatch.setattr(Commits, "latest", lambda self: stale.pop() if stale else plain(self))
    assert ledger.reserve("seq", "b", 3) == 6 and not stale


def test_a_repeated_load_gets_its_numbers_again(spark):
    ledger = Ledger(spark, new_path(spark, "ledger"))
    df = spark.range(20)
    first = sequence_keys(df, ["id"], "k", ledger, "seq", "monday")
    other = sequence_keys(spark.range(7), ["id"], "k", ledger, "seq", "tuesday")
    again = sequence_keys(df, ["id"], "k", ledger, "seq", "monday")
    assert rows(first) == rows(again) and sorted(r.k for r in other.collect()) == list(range(21, 28))
    assert ledger.reserve("seq", "empty", 0) == 28 and ledger.reserve("other", "x", 2) == 1
    with pytest.raises(ValueError):
        ledger.reserve("seq", "monday", 21)


def test_two_loads_at_once_number_their_rows(spark):
    ledger = Ledger(spark, new_path(spark, "ledger"))
    with ThreadPoolExecutor(2) as pool:
        both = list(pool.map(lambda n: sequence_keys(spark.range(n), ["id"], "k", ledger, "seq", str(n)).collect(), (400, 700)))
    assert sorted(r.k for part in both for r in part) == list(range(1, 1101))
    for part in both:
        assert [r.k - part[0].k for r in part] == list(range(len(part)))


def test_numbers_within_groups_are_those_of_the_whole_order(spark, monkeypatch):
    """Groups far apart, of both signs and of different sizes, rows equal in the leading columns, several ranges of groups."""
    monkeypatch.setattr(keys, "_RANGE_BYTES", 2000)
    n = F.col("id")
    df = spark.range(6000).select(
        F.when(n < 2000, n % 300 * 10**14 - 10**16).when(n < 5900, n * 7).otherwise(3).alias("g"), (n * 31 % 4).cast("int").alias("a"),
        F.when(n % 9 > 0, (n % 13).cast("double")).alias("b"), n.alias("last"))
    order = ["g", "a", "b", "last"]
    assert rows(keys.dense_keys_by_group(df, order, "k")) == rows(dense_keys(df, order, "k").select(*order, "k"))
    assert rows(keys.dense_keys_by_group(df.limit(0), order, "k")) == []


def test_counts_per_group_are_made_behind_the_exchange(spark):
    keyed = keys.dense_keys_by_group(spark.range(100).select("id", (F.col("id") % 7).alias("b")), ["id", "b"], "k")
    assert rows(keyed.select("id", "k")) == rows(spark.range(100).selectExpr("id", "id + 1"))
