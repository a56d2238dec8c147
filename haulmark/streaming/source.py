"""The event log as a stream."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from haulmark.sources.tables import INPUT_SCHEMAS

_c = F.col


def event_stream(spark: SparkSession, pattern: str, files_per_batch: int = 64) -> DataFrame:
    """Files are taken in the order they were written, ``files_per_batch`` at a time."""
    raw = (spark.readStream.schema(INPUT_SCHEMAS["events"])
           .option("maxFilesPerTrigger", files_per_batch).parquet(pattern))
    return raw.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
        F.when(_c("event_id") % 17 == 0, _c("ts") - F.expr("INTERVAL 2 DAY")).otherwise(_c("ts")).alias("late_ts"))


_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started in here keep their state in RocksDB, which arbitrary stateful operators need."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


def run_to_end(writer, progress: str) -> StreamingQuery:
    """Process what is there and stop. A later call with the same ``progress`` folder goes on from there."""
    query = writer.trigger(availableNow=True).option("checkpointLocation", progress).start()
    query.awaitTermination()
    return query
