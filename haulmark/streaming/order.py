"""Out-of-order detection as events arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmark.session import new_path
from haulmark.sources.writes import stage
from haulmark.streaming.source import event_stream, run_to_end

_c = F.col
BLOCK_IDS = 1 << 20  # event ids of a block
BUCKETS = 16         # folders that entities are dealt to
_EVENT = "user_id long, event_id long, late_ts timestamp_ntz"
_BLOCK = "user_id long, block long, first_id long, first_ts timestamp_ntz, last_ts timestamp_ntz, batch long"
_HEAD = "user_id long, block long, event_id long, late_ts timestamp_ntz, previous_ts timestamp_ntz, batch long"
_BODY = "user_id long, block long, event_id long, late_ts timestamp_ntz, previous_ts timestamp_ntz, batch long"


class History:
    """The events seen so far, in one folder per entity bucket and id block, with an index of the blocks.

    The index has a row for each entity and block that a batch touched: its first event and the time of its last one. The
    newest batch counts. All folders of a batch are its own, so a repeated batch overwrites what it wrote.
    """

    def __init__(self, spark: SparkSession, folder: str, block_ids: int = BLOCK_IDS, buckets: int = BUCKETS):
        self.spark, self.folder, self.block_ids, self.buckets = spark, folder, block_ids, buckets

    def add(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Store the events of a batch; returns them with bucket and block."""
        placed = rows.select("user_id", "event_id", "late_ts", F.pmod(F.xxhash64("user_id"), F.lit(self.buckets)).alias("bucket"),
                             F.floor(_c("event_id") / self.block_ids).alias("block"), F.lit(batch_id).cast("long").alias("batch"))
        fresh = stage(placed, "late-fresh")
        self._write(fresh.hint("rebalance", "bucket", "block"), "events", "bucket", "block", "batch")
        return fresh

    def _write(self, rows: DataFrame, name: str, *folders: str) -> None:
        rows.write.partitionBy(*folders).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{self.folder}/{name}")

    def touched(self, fresh: DataFrame, batch_id: int) -> DataFrame:
        """All events up to a batch in the blocks of its entities. Only the folders of these blocks are opened."""
        places = fresh.select("bucket", "block").distinct().collect()  # one row per folder the batch wrote
        paths = [f"{self.folder}/events/bucket={p['bucket']}/block={p['block']}" for p in places]
        schema = f"{_EVENT}, bucket long, block long, batch long"
        stored = (self.spark.read.schema(schema).option("basePath", f"{self.folder}/events").parquet(*paths) if paths
                  else self.spark.createDataFrame([], schema))
        pairs = fresh.select("user_id", "block").distinct()
        return stored.filter(_c("batch") <= batch_id).join(pairs, ["user_id", "block"], "left_semi")

    def index(self, buckets: list[int] | None = None, before: int | None = None) -> DataFrame:
        """The newest row of every entity and block, of some buckets or all, as of before a batch or now."""
        rows = self._read("blocks", f"{_BLOCK}, bucket long", buckets)
        rows = rows if before is None else rows.filter(_c("batch") < before)
        value = F.struct("first_id", "first_ts", "last_ts", "batch")
        return (rows.groupBy("user_id", "block").agg(F.max_by(value, "batch").alias("b"))
                .select("user_id", "block", "b.first_id", "b.first_ts", "b.last_ts", "b.batch"))

    def _read(self, name: str, schema: str, buckets: list[int] | None) -> DataFrame:
        jvm = self.spark.sparkContext._jvm
        folders = [f"{self.folder}/{name}"] if buckets is None else [f"{self.folder}/{name}/bucket={b}" for b in buckets]
        path = jvm.org.apache.hadoop.fs.Path
        there = [f for f in folders if path(f).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path(f))]
        if not there:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.folder}/{name}").parquet(*there)

    def judge(self, fresh: DataFrame, batch_id: int) -> None:
        """Look again at the blocks that a batch touched, and at the first event of the block behind each.

        The first event of a block is compared with the last one of the entity's block before, which the index knows; all
        other comparisons stay inside a block. So two things are written: the late events of touched blocks behind their
        first one, and what every first event is compared with, where that may have changed.
        """
        here = self.touched(fresh, batch_id)
        inside = Window.partitionBy("user_id", "block").orderBy("event_id")
        walked = stage(here.select("user_id", "event_id", "late_ts", "bucket", "block")
                       .withColumn("previous_ts", F.lag("late_ts").over(inside))
                       .withColumn("first", F.row_number().over(inside) == 1), "late-walked")
        summary = stage(walked.groupBy("user_id", "bucket", "block").agg(
            F.min("event_id").alias("first_id"), F.min_by("late_ts", "event_id").alias("first_ts"),
            F.max_by("late_ts", "event_id").alias("last_ts")), "late-blocks")
        batch = F.lit(batch_id).cast("long")
        self._write(summary.withColumn("batch", batch), "blocks", "bucket", "batch")
        body = walked.filter("NOT first AND late_ts < previous_ts").select("user_id", "block", "event_id", "late_ts", "previous_ts")
        body.write.mode("overwrite").parquet(f"{self.folder}/body/batch={batch_id}")

        buckets = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]
        users = fresh.select("user_id").distinct()
        known = self.index(buckets, before=batch_id).join(users, "user_id", "left_semi")
        now = summary.select("user_id", "block", "first_id", "first_ts", "last_ts").withColumn("touched", F.lit(True))
        untouched = (known.join(now.select("user_id", "block"), ["user_id", "block"], "left_anti").drop("batch")
                     .withColumn("touched", F.lit(False)))
        over = Window.partitionBy("user_id").orderBy("block")  # one row per block of an entity
        heads = (now.unionByName(untouched).withColumn("previous_ts", F.lag("last_ts").over(over))
                 .withColumn("changed", _c("touched") | F.coalesce(F.lag("touched").over(over), F.lit(False)))
                 .filter("changed").select("user_id", "block", _c("first_id").alias("event_id"),
                                           _c("first_ts").alias("late_ts"), "previous_ts"))
        heads.write.mode("overwrite").parquet(f"{self.folder}/heads/batch={batch_id}")

    def late(self) -> DataFrame:
        """All late events: user_id, event_id, late_ts, previous_ts."""
        columns = ["user_id", "event_id", "late_ts", "previous_ts"]
        value = F.struct("event_id", "late_ts", "previous_ts")
        heads = (self._read("heads", _HEAD, None).groupBy("user_id", "block").agg(F.max_by(value, "batch").alias("h"))
                 .select("user_id", "h.*").filter("late_ts < previous_ts"))
        newest = self.index().select("user_id", "block", "batch")
        body = self._read("body", _BODY, None).join(newest, ["user_id", "block", "batch"])
        return body.select(columns).unionAll(heads.select(columns))


def late_events(spark: SparkSession, pattern: str, files_per_batch: int = 64, folder: str | None = None,
                block_ids: int = BLOCK_IDS, buckets: int = BUCKETS) -> DataFrame:
    """Events whose time lies before that of the entity's previous event in id order, whatever order files come in.

    A micro-batch adds its events to the stored history (``History``) and opens only the blocks it touches: an event with
    a low id that comes late can make its successor late, or right again, and the successor is in the same block or first
    of the next one, which the index answers. Each batch is an ordinary plan; a hot entity is cut into its blocks. Nothing
    is evicted.

    ``folder`` holds history, results and progress; a later call with the same folder adds the files that are new.
    """
    history = History(spark, folder or new_path(spark, "late"), block_ids, buckets)

    def check(rows: DataFrame, batch_id: int) -> None:
        history.judge(history.add(rows, batch_id), batch_id)

    stream = event_stream(spark, pattern, files_per_batch).select("user_id", "event_id", "late_ts")
    run_to_end(stream.writeStream.foreachBatch(check), f"{history.folder}/progress")
    return history.late()
