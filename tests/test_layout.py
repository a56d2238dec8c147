"""The clustered layout: every lookup gives the rows of a plain filter and opens a small share of the files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from haulmark.session import new_path
from haulmark.sources.layout import Clustered
from tests.conftest import rows

_c = F.col
COLUMNS = ["status", "at", "account"]


@pytest.fixture(scope="module")
def data(spark):
    """20,000 rows with a hot status, a fifth of null accounts, and a third of all rows on one account."""
    n = _c("id")
    return spark.range(20_000).select(
        "id", F.when(n % 10 < 6, "Delivered").otherwise(F.concat(F.lit("S"), (n % 10).cast("string"))).alias("status"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(mins=(n * 7919 % 20_000).cast("int"))).alias("at"),
        F.when(n % 5 == 0, None).when(n % 3 == 0, 7).otherwise(n * 31 % 4000).alias("account"))


@pytest.fixture(scope="module")
def table(spark, data):
    return Clustered.write(data, new_path(spark, "clustered"), COLUMNS, file_bytes=3000)


DAY = dt.datetime(2024, 1, 3)
LOOKUPS = [({"status": "S7"}, 0.35), ({"at": (DAY, DAY + dt.timedelta(hours=6))}, 0.35), ({"account": 1234}, 0.35),
           ({"status": "Delivered", "at": (DAY, DAY + dt.timedelta(hours=6))}, 0.25),
           ({"status": "S8", "account": 31 * 8, "at": (DAY, None)}, 0.15), ({"account": (3990, None)}, 0.35), ({"account": None}, 0.5),
           ({"at": (None, dt.datetime(2023, 12, 31))}, 0.35), ({"status": "never"}, 0.35)]


@pytest.mark.parametrize("conditions, share", LOOKUPS)
def test_lookups(spark, data, table, conditions, share):
    want = data
    for c, v in conditions.items():
        low, high = v if isinstance(v, tuple) else (v, v)
        want = want.filter(_c(c).isNull()) if v is None else want
        want = want if low is None else want.filter(_c(c) >= F.lit(low).cast(data.schema[c].dataType))
        want = want if high is None else want.filter(_c(c) <= F.lit(high).cast(data.schema[c].dataType))
    got = table.lookup(**conditions)
    assert rows(got) == rows(want)
    every = len(table.all().inputFiles())
    assert every >= 40 and len(table.files(**conditions)) <= share * every
    assert len(got.inputFiles()) == len(table.files(**conditions))  # what the scan opens


def test_rows_are_kept_and_files_are_even(data, table):
    assert rows(table.all()) == rows(data)
    sizes = [r["count"] for r in table.all().groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 4 * sum(sizes) / len(sizes)  # the hot status and account are spread


def test_a_stored_layout_is_opened_again(spark, table):
    again = Clustered.open(spark, table.path)
    assert again.bounds == table.bounds and again.files(status="S7") == table.files(status="S7")


def test_empty_tables_and_columns_of_nulls(spark, data):
    empty = Clustered.write(data.limit(0), new_path(spark, "clustered"), COLUMNS)
    assert empty.lookup(status="S7").count() == 0 and empty.files(status="S7") == []
    nulls = Clustered.write(data.limit(50).withColumn("status", F.lit(None).cast("string")), new_path(spark, "clustered"), ["status"])
    assert nulls.lookup(status=None).count() == 50 and nulls.lookup(status="S7").count() == 0
