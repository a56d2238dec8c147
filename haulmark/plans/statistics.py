"""Column statistics by mergeable sketches: every load adds its own, and the table's are their union.

A load is scanned once, all columns together; what is kept per column is exact (rows, nulls, least and greatest value) or a
sketch of bounded size (distinct values, quantiles, frequent values). Sketches of several loads are united, not made
anew, so keeping the statistics of a table up to date reads its increments only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HLL_BITS = 12       # about 1.6 % standard error of the distinct count
KLL_SIZE = 200      # about 1.3 % error of a rank
TRACKED = 1_000     # frequent values kept; a value's count is too high by at most rows / TRACKED or so
_c = F.col


def _number(column: str, kind: T.DataType) -> Column | None:
    """A column as a number that keeps its order, or nothing for text."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return None
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(_c(column).cast("timestamp")).cast("double")
    return _c(column).cast("int" if isinstance(kind, T.BooleanType) else kind).cast("double")


def _ordered(column: str, kind: T.DataType) -> Column:
    """(exact number or nothing, text): compares as the column does. Texts of dates and times do so by themselves."""
    exact = _c(column).cast("decimal(38,6)") if isinstance(kind, T.NumericType) else F.lit(None).cast("decimal(38,6)")
    return F.when(_c(column).isNotNull(), F.struct(exact.alias("number"), _c(column).cast("string").alias("text")))


def of_load(name: str, df: DataFrame) -> DataFrame:
    """One row of statistics per column, from one scan."""
    stats = []
    for field in df.schema.fields:
        c, kind = field.name, field.dataType
        number = _number(c, kind)
        stats.append(F.struct(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count_if(_c(c).isNull()).alias("nulls"),
            F.min(_ordered(c, kind)).alias("low"), F.max(_ordered(c, kind)).alias("high"),
            F.hll_sketch_agg(_c(c).cast("string"), HLL_BITS).alias("distinct"),
            F.kll_sketch_agg_double(F.lit(None).cast("double") if number is None else number, F.lit(KLL_SIZE)).alias("quantiles"),
            F.expr(f"approx_top_k_accumulate(CAST(`{c}` AS STRING), {TRACKED})").alias("frequent")))
    return df.agg(F.array(*stats).alias("s")).select(F.lit(name).alias("table_name"), F.inline("s"))


class Statistics:
    """The statistics of all loads below a folder, one folder per load and table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.schema = None

    def add(self, load: str, name: str, df: DataFrame) -> None:
        """Keep the statistics of the rows that a load brings to a table; a repeated load replaces its own.

        Tables are done one by one: a plan over all of them would be analysed anew with every table that joins it.
        """
        stats = of_load(name, df)
        self.schema = stats.schema
        stats.write.mode("overwrite").parquet(f"{self.path}/load={load}/source={name}")

    def merged(self) -> DataFrame:
        """Statistics of every column over all loads, still with the sketches."""
        schema = self.schema or self.spark.read.parquet(self.path).drop("load", "source").schema
        return (self.spark.read.schema(schema).parquet(self.path).groupBy("table_name", "column_name").agg(
            F.sum("n_rows").alias("n_rows"), F.sum("nulls").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"),
            F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
            F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent")))


def exact(merged: DataFrame) -> DataFrame:
    return merged.select("table_name", "column_name", "n_rows", "nulls", _c("low.text").alias("smallest"), _c("high.text").alias("largest"))


def estimated(merged: DataFrame, ranks: tuple[float, ...] = (0.25, 0.5, 0.75), top: int = 3) -> DataFrame:
    """Distinct values, quantiles (null for text and for columns of nulls) and the most frequent values with their counts."""
    some = F.kll_sketch_get_n_double("quantiles") > 0
    cuts = F.when(some, F.array(*(F.kll_sketch_get_quantile_double("quantiles", F.lit(r)) for r in ranks)))
    return merged.select("table_name", "column_name", "n_rows", F.hll_sketch_estimate("distinct").alias("n_distinct"),
                         cuts.alias("quantiles"), F.expr(f"approx_top_k_estimate(frequent, {top})").alias("frequent"))
