"""United sketches of several loads against exact statistics of the whole."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from haulmark.plans import statistics as St
from haulmark.session import new_path

_c = F.col
N = 30_000


@pytest.fixture(scope="module")
def data(spark):
    n = _c("id")
    return spark.range(N).select(
        "id", (n * 7919 % N - 500).cast("decimal(12,2)").alias("amount"), F.concat(F.lit("user"), n % 5000).alias("name"),
        F.when(n % 3 == 0, "hot").otherwise(n.cast("string")).alias("skewed"), (n % 2 == 0).alias("even"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 366).cast("int")).alias("day"),
        F.lit(None).cast("string").alias("nothing"), F.when(n % 4 != 0, n).alias("gaps"))


@pytest.fixture(scope="module")
def merged(spark, data):
    kept = St.Statistics(spark, new_path(spark, "statistics"))
    for k in range(3):
        kept.add(f"load{k}", "t", data.filter(_c("id") % 3 == k))
    kept.add("load1", "t", data.filter("id % 3 = 1"))  # a repeated load counts once
    kept.add("empty", "t", data.limit(0))
    return St.Statistics(spark, kept.path).merged()


def test_exact_statistics(merged):
    got = {r.column_name: tuple(r)[2:] for r in St.exact(merged).collect()}
    assert got == {"id": (N, 0, "0", str(N - 1)), "amount": (N, 0, "-500.00", f"{N - 501}.00"), "name": (N, 0, "user0", "user999"),
                   "skewed": (N, 0, "1", "hot"), "even": (N, 0, "false", "true"), "day": (N, 0, "2024-01-01", "2024-12-31"),
                   "nothing": (N, N, None, None), "gaps": (N, N // 4, "1", str(N - 1))}


def test_estimates_stay_within_their_bounds(merged):
    got = {r.column_name: r for r in St.estimated(merged).collect()}
    for column, distinct in (("id", N), ("amount", N), ("name", 5000), ("skewed", N * 2 // 3 + 1), ("even", 2), ("day", 366), ("nothing", 0), ("gaps", N * 3 // 4)):
        assert abs(got[column].n_distinct - distinct) <= 0.06 * distinct
    for column, low in (("id", 0), ("amount", -500), ("gaps", 0)):
        assert all(abs(q - low - r * N) <= 0.03 * N for q, r in zip(got[column].quantiles, (0.25, 0.5, 0.75)))
    day = (dt.date(2024, 7, 1) - dt.date(1970, 1, 1)).days
    assert abs(got["day"].quantiles[1] - day) <= 12 and got["name"].quantiles is None is got["nothing"].quantiles
    top = got["skewed"].frequent[0]
    assert top["item"] == "hot" and abs(top["count"] - N // 3) <= N // St.TRACKED * 10


def test_a_new_load_reads_its_own_rows_only(spark, data):
    kept, path = St.Statistics(spark, new_path(spark, "statistics")), new_path(spark, "increment")
    kept.add("a", "t", data.filter("id < 29000"))
    data.filter("id >= 29000").write.parquet(path)
    increment = spark.read.schema(data.schema).parquet(path)
    assert set(St.of_load("t", increment).inputFiles()) == set(increment.inputFiles())
    kept.add("b", "t", increment)
    assert {r.n_rows for r in St.exact(kept.merged()).collect()} == {N}
