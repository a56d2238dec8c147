"""Ordered computations per group that survive a hot group.

A window over ``PARTITION BY g ORDER BY id`` sends a whole group to one task. These helpers cut each group
into blocks of ``block_rows`` consecutive ids, so a task never holds more than one block of a group, and
carry the last value, the sum or the count of the earlier blocks in through a small side table with one row
per (group, block). ``order`` must be a non-negative integer that is unique within a group; group columns
must not be null. Everything is an ordinary lazy plan: one exchange of the rows on (group, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 20
_BLOCK = "__block"


def _blocked(df: DataFrame, order: str, block_rows: int) -> DataFrame:
    return df.withColumn(_BLOCK, F.expr(f"`{order}` div {block_rows}"))


def _carried(blocked: DataFrame, group: list[str], summary: Column, carry) -> DataFrame:
    per_block = blocked.groupBy(*group, _BLOCK).agg(summary.alias("__summary"))
    over = Window.partitionBy(*group).orderBy(_BLOCK)
    carried = per_block.select(*group, _BLOCK, carry(F.col("__summary"), over).alias("__carry"))
    # A missing carry means the same as a null one, and most groups end in their first block.
    return carried.filter(F.col("__carry").isNotNull())


def lag_within(df: DataFrame, group: list[str], order: str, value: str, out: str,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY group ORDER BY order)``."""
    rows = _blocked(df, order, block_rows)
    carry = _carried(rows, group, F.max_by(value, order), lambda s, over: F.lag(s).over(over))
    local = Window.partitionBy(*group, _BLOCK).orderBy(order)
    return (rows.withColumn("__lag", F.lag(value).over(local))
            .withColumn("__first", F.row_number().over(local) == 1)
            .join(carry, [*group, _BLOCK], "left")
            .withColumn(out, F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__lag")))
            .drop(_BLOCK, "__lag", "__first", "__carry"))


def running_sum_within(df: DataFrame, group: list[str], order: str, value: str, out: str,
                       block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY group ORDER BY order ROWS UNBOUNDED PRECEDING)``."""
    rows = _blocked(df, order, block_rows)
    carry = _carried(rows, group, F.sum(value),
                     lambda s, over: F.sum(s).over(over.rowsBetween(Window.unboundedPreceding, -1)))
    local = (Window.partitionBy(*group, _BLOCK).orderBy(order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.when(F.col("__carry").isNull(), F.col("__local")).otherwise(
        F.coalesce(F.col("__local"), F.lit(0)) + F.col("__carry"))
    return (rows.withColumn("__local", F.sum(value).over(local))
            .join(carry, [*group, _BLOCK], "left")
            .withColumn(out, total)
            .drop(_BLOCK, "__local", "__carry"))


def row_number_within(df: DataFrame, group: list[str], order: str, out: str,
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY group ORDER BY order)``; no group gives a global numbering."""
    counted = running_sum_within(df.withColumn("__one", F.lit(1).cast("long")), group, order, "__one", out,
                                 block_rows)
    return counted.drop("__one")


def latest_by(df: DataFrame, group: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Last row of each group as a partial aggregate: one row per group leaves each map task."""
    newest = F.max_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(*group).agg(newest.alias("__last")).select(*group, "__last.*")
