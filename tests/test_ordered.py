"""Block-wise windows against plain ones, with a hot group and blocks far smaller than the groups."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from haulmark.operators.ordered import lag_within, latest_by, row_number_within, running_sum_within
from tests.conftest import rows


@pytest.fixture(scope="module")
def hot(spark):
    """Group 0 holds two thirds of the rows; ids have gaps; some values are null."""
    return spark.range(900).filter("id % 7 <> 3").select(
        F.col("id"), F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 5).alias("g"),
        F.when(F.col("id") % 11 != 0, F.col("id") * 37 % 101).alias("v"))


@pytest.mark.parametrize("block", [1, 7, 100, 10**6])
@pytest.mark.parametrize("group", [["g"], []])
def test_blocks_match_plain_windows(hot, block, group):
    w = Window.partitionBy(*group).orderBy("id")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    want = hot.select("id", F.lag("v").over(w).alias("x"))
    assert rows(lag_within(hot, group, "id", "v", "x", block).select("id", "x")) == rows(want)
    want = hot.select("id", F.row_number().over(w).alias("x"))
    assert rows(row_number_within(hot, group, "id", "x", block).select("id", "x")) == rows(want)
    want = hot.select("id", F.sum("v").over(run).alias("x"))
    assert rows(running_sum_within(hot, group, "id", "v", "x", block).select("id", "x")) == rows(want)


def test_no_task_holds_more_than_a_block(hot):
    blocked = lag_within(hot, ["g"], "id", "v", "x", 50)
    plan = blocked._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" in plan and "__block" in plan


def test_latest_row_wins_by_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (2, 1, "c")], "k int, t int, s string")
    assert rows(latest_by(df, ["k"], ["t"], ["s"])) == [(1, "b"), (2, "c")]
