"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the plans rely on. All of them can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small compressed rows take 20 times their room when sorted or hashed, and a task holds one partition.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # A hot key on the fact side of a join is split, also where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hierarchy walks return every row; the depth limit stays as the guard against cycles.
    "spark.sql.cteRecursionRowLimit": "-1",
}


_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_INPUT_BYTES = 4 << 20  # stored input bytes per shuffle partition; exchanged rows are about twice as wide as stored ones


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def partition_for(spark: SparkSession, input_bytes: int) -> None:
    """Let shuffles start with as many partitions as the input needs, so that what a task sorts does not grow with it. AQE puts
    small ones together; the number is never lowered, and the session's own one is the least."""
    needed = -(-input_bytes // _INPUT_BYTES)
    held = int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if needed > held:
        spark.conf.set(_INITIAL, str(needed))


def shared_dir(spark: SparkSession) -> str:
    """Folder visible to all executors, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only for a local master without that setting, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="haulmark-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/haulmark/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing is ever overwritten there."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


# Stored by each task as an Arrow batch outside the heap, and again by its Python worker, which makes larger arrays of it.
_BATCH_BYTES = "4m"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that functions of it run on any executor. Batches
    of long rows are cut by bytes, so that their memory follows neither the length of texts nor the number of rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", _BATCH_BYTES)
    context = spark.sparkContext
    if getattr(context, "_haulmark_shipped", False):
        return
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="haulmark-"), "haulmark"), "zip", home, "haulmark")
    context.addPyFile(os.path.realpath(archive))
    context._haulmark_shipped = True
