"""Sinks: staged tables, appends, partitioned logs and compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from haulmark.session import new_path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result that several later steps read, and return the stored table."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate result that no plan reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def counted_write(df: DataFrame, path: str) -> int:
    """Write and return the number of rows written.

    The count comes from the footers of the committed files. A metric observed during the write would count
    the rows of a repeated task twice.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A frame that reports its row count while it is being used, for progress messages."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_by_day(df: DataFrame, ts: str, path: str) -> None:
    """Event log partitioned by day. The rebalance puts a day's rows together for few files, and lets AQE
    split a day that is larger than the rest over several tasks."""
    (df.withColumn("event_day", F.to_date(ts)).hint("rebalance", "event_day")
       .write.partitionBy("event_day").parquet(path))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Data files below a path with their bytes; file contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")


def compact(spark: SparkSession, source: str, target: str, order: list[str],
            file_bytes: int = 512 << 20, file_rows: int = 4 << 20) -> None:
    """Rewrite a fragmented table as files of about ``file_bytes``, or ``file_rows`` where that is less, that are disjoint
    and sorted on ``order``. A task sorts the rows of one file; stored bytes alone do not bound them, since narrow rows
    take far more room in memory than in the file."""
    total = file_sizes(spark, source).agg(F.coalesce(F.sum("length"), F.lit(0)).cast("long")).first()[0]
    rows = spark.read.parquet(source)
    (rows.repartitionByRange(max(1, -(-total // file_bytes), -(-rows.count() // file_rows)), *order)
     .sortWithinPartitions(*order).write.parquet(target))
