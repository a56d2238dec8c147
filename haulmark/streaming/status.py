"""Current status per entity, kept up to date as events arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.operators.ordered import latest_by
from haulmark.session import new_path
from haulmark.streaming.source import event_stream, run_to_end

_c = F.col


def current_status(spark: SparkSession, pattern: str, files_per_batch: int = 64, folder: str | None = None) -> DataFrame:
    """Streaming ``max_by`` in update mode: each micro-batch writes the entities it changed.

    A batch folder is overwritten when the batch is repeated, and the newest batch of an entity wins. ``folder`` holds
    results and progress; a later call with the same folder adds the files that are new.
    """
    folder = folder or new_path(spark, "status")
    target = f"{folder}/changed"
    newest = F.max_by(F.struct("event_type", "ts"), F.struct("ts", "event_id")).alias("s")
    status = (event_stream(spark, pattern, files_per_batch).groupBy("user_id").agg(newest)
              .select("user_id", _c("s.event_type").alias("status"), _c("s.ts").alias("since")))

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    run_to_end(status.writeStream.outputMode("update").foreachBatch(write), f"{folder}/progress")
    return latest_by(spark.read.parquet(target), ["user_id"], ["batch"], ["status", "since"])
