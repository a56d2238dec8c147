"""Append-only ingest: each event is checked on the way in; broken ones go to a dead-letter folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions import scalars as S
from haulmark.session import new_path
from haulmark.streaming.source import event_stream, run_to_end

_c = F.col
ACCEPTED_TYPES = ["click", "view", "signup", "purchase"]


def with_entities(events: DataFrame) -> DataFrame:
    """Scanned entity of an event: a package for even users, a pallet for odd ones.

    Some scans name none and some name both; those are the ones the check has to catch.
    """
    u, e = _c("user_id"), _c("event_id")
    return events.withColumns({
        "package_id": F.when((e % 50 != 7) & ((u % 2 == 0) | (e % 53 == 5)), u),
        "pallet_id": F.when((e % 50 != 7) & ((u % 2 == 1) | (e % 53 == 5)), u)})


def verdict() -> Column:
    return (F.when(~_c("event_type").isin(*ACCEPTED_TYPES), "bad_code")
            .when(~S.exactly_one(_c("package_id"), _c("pallet_id")), "bad_entity").otherwise("accepted"))


def ingest(spark: SparkSession, pattern: str, files_per_batch: int = 64, folder: str | None = None) -> DataFrame:
    """Run the stream to its end and return all events with their verdict.

    The file sink commits each micro-batch once; the verdict is a partition column, so accepted rows and
    dead letters are separate folders of one write. ``folder`` holds the rows and the progress; a later call with the
    same folder adds the files that are new.
    """
    folder = folder or new_path(spark, "ingested")
    target = f"{folder}/rows"
    checked = with_entities(event_stream(spark, pattern, files_per_batch)).withColumn("verdict", verdict())
    writer = (checked.select("event_id", "ts", "event_type", "package_id", "pallet_id", "verdict")
              .writeStream.format("parquet").option("path", target).partitionBy("verdict"))
    run_to_end(writer, f"{folder}/progress")
    return spark.read.parquet(target)
