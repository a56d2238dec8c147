"""Versioned tables: changes beside the files, conflicts between writers, older versions, and publishing."""

from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from haulmark.plans import quality as Q
from haulmark.session import new_path
from haulmark.sources.versions import Conflict, PublishError, Store, publish
from tests.conftest import rows

_c = F.col


@pytest.fixture
def store(spark):
    """A table t (id, v) of 100 rows in four files."""
    store = Store(spark, new_path(spark, "store"))
    change = store.change()
    change.replace("t", spark.range(0, 100, 1, 4).select("id", (_c("id") * 10).alias("v")))
    change.commit()
    return store


def as_dict(df):
    return {r.id: r.v for r in df.collect()}


BASE = {k: k * 10 for k in range(100)}


def test_an_update_of_one_row_rewrites_no_file(store):
    before = {f: open(f.removeprefix("file://"), "rb").read() for f in store.files("t")}
    change = store.change()
    change.update("t", _c("id") == 42, {"v": _c("v") + 1})
    assert as_dict(store.read("t")) == BASE  # not committed yet
    assert change.commit() == 2
    assert as_dict(store.read("t")) == BASE | {42: 421} and as_dict(store.read("t", 1)) == BASE
    after = store.files("t")
    assert set(before) < set(after) and all(open(f.removeprefix("file://"), "rb").read() == b for f, b in before.items())
    new = [f for f in after if f not in before]
    assert sum(store.spark.read.parquet(f).count() for f in new) == 1


def test_only_files_with_removals_are_joined(store):
    change = store.change()
    change.delete("t", _c("id").isin(3, 7))
    change.commit()
    plan = store.read("t")
    assert as_dict(plan) == {k: v for k, v in BASE.items() if k not in (3, 7)}
    removed, = store.state()["t"]["removed"]
    assert len(removed["files"]) == 1  # of four


def test_deletes_keep_rows_with_unknown_conditions(spark, store):
    change = store.change()
    change.append("t", spark.createDataFrame([(None, 200), (5, 300)], "v long, id long"))
    change.commit()
    change = store.change()
    change.delete("t", _c("v") > 500)
    change.commit()
    assert as_dict(store.read("t")) == {k: v for k, v in BASE.items() if v <= 500} | {200: None, 300: 5}


def test_update_from_takes_the_last_and_only_what_differs(spark, store):
    updates = spark.createDataFrame([(1, 11), (1, 12), (2, 20), (3, None), (500, 5)], "id long, v long")
    change = store.change()
    change.update_from("t", updates, "id", ["v"])
    change.commit()
    assert as_dict(store.read("t")) == BASE | {1: 12}
    assert sum(store.spark.read.parquet(r["folder"]).count() for r in store.state()["t"]["removed"]) == 1
    nothing = store.change()
    nothing.update_from("t", updates, "id", ["v"])
    assert nothing.parts["t"]["added"] == [] if nothing.parts else True


def test_changes_on_changes_and_a_merge(spark, store):
    want = dict(BASE)
    for k in range(4):
        change = store.change()
        change.update("t", _c("id") % 7 == k, {"v": _c("v") * 2 + k})
        want |= {i: v * 2 + k for i, v in want.items() if i % 7 == k}
        change.commit()
    change = store.change()
    change.delete("t", _c("v") > 1000)
    change.commit()
    want = {i: v for i, v in want.items() if v <= 1000}
    assert as_dict(store.read("t")) == want
    change = store.change()
    change.merge("t")
    merged = change.commit()
    assert as_dict(store.read("t")) == want == as_dict(store.read("t", merged - 1)) and store.state()["t"]["removed"] == []
    assert as_dict(store.read("t", 1)) == BASE
    change = store.change()
    change.delete("t", F.lit(True))
    change.commit()
    change = store.change()
    change.merge("t")
    change.commit()
    assert store.read("t").count() == 0


def test_writers_of_the_same_row_conflict_and_others_do_not(spark, store):
    one, other, apart = store.change(), store.change(), store.change()
    one.update("t", _c("id") == 5, {"v": F.lit(1)})
    other.update("t", _c("id").isin(5, 6), {"v": F.lit(2)})
    apart.update("t", _c("id") == 6, {"v": F.lit(3)})  # the same file, another row
    assert one.commit() == 2
    with pytest.raises(Conflict):
        other.commit()
    assert apart.commit() == 3 and store.version() == 3
    assert as_dict(store.read("t")) == BASE | {5: 1, 6: 3}


def test_appends_and_changes_of_other_tables_do_not_conflict(spark, store):
    first, second, third = store.change(), store.change(), store.change()
    first.append("t", spark.createDataFrame([(1000, 1)], "id long, v long"))
    second.append("t", spark.createDataFrame([(1001, 1)], "id long, v long"))
    third.replace("u", spark.range(3))
    assert [c.commit() for c in (first, second, third)] == [2, 3, 4]
    assert as_dict(store.read("t")) == BASE | {1000: 1, 1001: 1} and store.read("u").count() == 3
    with pytest.raises(KeyError):
        store.read("u", 3)


def test_a_merge_excludes_changes_of_its_files(store):
    change = store.change()
    change.delete("t", _c("id") == 1)
    change.commit()
    merge, late = store.change(), store.change()
    merge.merge("t")
    late.delete("t", _c("id") == 2)
    merge.commit()
    with pytest.raises(Conflict):
        late.commit()


def test_of_many_writers_at_once_one_wins(spark, store):
    start = Barrier(4)

    def write(k):
        change = store.change()
        change.update("t", _c("id") == 9, {"v": F.lit(k)})
        start.wait()
        try:
            change.commit()
            return k
        except Conflict:
            return None
    with ThreadPoolExecutor(4) as pool:
        won = [k for k in pool.map(write, range(1000, 1004)) if k is not None]
    assert len(won) == 1 and store.version() == 2 and as_dict(store.read("t")) == BASE | {9: won[0]}


def test_failed_check_publishes_nothing(spark):
    store = Store(spark, new_path(spark, "publish"))
    publish(store, {"t": spark.range(3)}, lambda staged: 0)
    with pytest.raises(PublishError):
        publish(store, {"t": spark.range(99)}, lambda staged: staged["t"].filter("id > 50").count())
    assert store.read("t").count() == 3
    publish(store, {"t": spark.range(5)}, lambda staged: 0)
    assert store.read("t").count() == 5 and store.read("t", 1).count() == 3


def test_of_two_loads_the_second_fails_and_readers_see_one(spark):
    store = Store(spark, new_path(spark, "publish"))
    publish(store, {"a": spark.range(1), "b": spark.range(1)}, lambda staged: 0)

    def meanwhile(staged):
        publish(store, {"a": spark.range(2), "b": spark.range(2)}, lambda inner: 0)
        assert store.read("a").count() == store.read("b").count() == 2
        return 0
    with pytest.raises(Conflict):
        publish(store, {"a": spark.range(9), "b": spark.range(9)}, meanwhile)
    assert store.version() == 2 and store.read("a").count() == store.read("b").count() == 2


def test_a_load_with_unchecked_or_broken_references_is_refused(spark, lake):
    finance = {name: lake.warehouse[name] for name in ("invoices", "invoice_lines", "payments")}
    with pytest.raises(Q.UncheckedReference):
        Q.count_violations(finance)
    assert Q.count_violations(finance, lake.warehouse) == 0
    broken = finance | {"invoice_lines": finance["invoice_lines"].withColumn(
        "shipment_id", F.when(_c("shipment_id") == finance["invoice_lines"].agg(F.min("shipment_id")).first()[0], -1).otherwise(_c("shipment_id")))}
    assert Q.count_violations(broken, lake.warehouse) == 1


def test_totals_have_to_agree_with_their_parts(lake):
    tables = {name: lake.warehouse[name] for name in ("invoices", "invoice_lines", "freight_bills", "pallets")}
    assert {r.rule: r.violations for r in Q.sum_rules(tables).collect()} == {"sum:invoice_lines": 0, "sum:pallets": 0}
    first = tables["invoices"].agg(F.min("invoice_id")).first()[0]
    off = tables | {"invoices": tables["invoices"].withColumn("total_amount", F.when(_c("invoice_id") == first, _c("total_amount") + 1)
                                                              .otherwise(_c("total_amount")).cast("decimal(12,2)"))}
    assert {r.rule: r.violations for r in Q.sum_rules(off).collect()} == {"sum:invoice_lines": 1, "sum:pallets": 0}
    lost = tables | {"pallets": tables["pallets"].filter(_c("freight_bill_id") != tables["pallets"].agg(F.min("freight_bill_id")).first()[0])}
    assert {r.rule: r.violations for r in Q.sum_rules(lost).collect()} == {"sum:invoice_lines": 0, "sum:pallets": 1}
