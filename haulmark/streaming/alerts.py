"""Alerts with a pause between responses.

An alert key answers its first severe event and then stays silent until ``delay`` seconds have passed; the
next severe event after that is answered again. The rule works on whole seconds, so what one key can hold is
bounded by elapsed time, not by the number of events.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from haulmark.operators.ordered import lag_within, running_sum_within
from haulmark.plans import fixed as X
from haulmark.session import new_path, ship_package
from haulmark.streaming.source import event_stream, keyed_state, run_to_end

_c = F.col
NEVER = -(2**62)
RUNS_PER_GROUP = 4096
BLOCK = 3600  # seconds of a block of kept state, at most 2^16
_MARKED = "alert string, second long, fired boolean"
_ANSWERS = "alert string, block long, fired array<long>"


def answered(second: np.ndarray, last: int, delay: int) -> list[int]:
    """Seconds (ascending) that get a response, given the last response before them."""
    out, i = [], int(np.searchsorted(second, last + delay))
    while i < len(second):
        last = int(second[i])
        out.append(last)
        i = int(np.searchsorted(second, last + delay))
    return out


def severe_seconds(events: DataFrame, severity: int) -> DataFrame:
    return events.filter(_c("k") % 26 >= severity).select(
        _c("event_type").alias("alert"), F.unix_timestamp(_c("ts").cast("timestamp")).alias("second"))


def _runs(seconds: DataFrame, delay: int) -> DataFrame:
    """Distinct seconds with the number of their run: a silence of ``delay`` re-arms the alert and starts a new one."""
    gaps = lag_within(seconds, ["alert"], "second", "second", "before")
    starts = gaps.withColumn("starts", F.when(_c("second") - _c("before") < delay, 0).otherwise(1).cast("long"))
    return running_sum_within(starts.drop("before"), ["alert"], "second", "starts", "run").drop("starts")


def _marked(runs: DataFrame, delay: int) -> DataFrame:
    """Every second of the runs and whether it is answered.

    Runs are independent of each other; ``RUNS_PER_GROUP`` neighbouring runs share a call into Python.
    """
    def respond(pdf: pd.DataFrame) -> pd.DataFrame:
        seconds = np.sort(pdf["second"].to_numpy())
        return pd.DataFrame({"alert": pdf["alert"].iloc[0], "second": seconds,
                             "fired": np.isin(seconds, answered(seconds, NEVER, delay))})

    ship_package(runs.sparkSession)
    packed = runs.withColumn("pack", F.expr(f"run div {RUNS_PER_GROUP}"))
    return packed.groupBy("alert", "pack").applyInPandas(respond, _MARKED)


def batch_alerts(events: DataFrame, severity: int = X.ALERT_SEVERITY,
                 delay: int = X.ALERT_DELAY_SECONDS) -> DataFrame:
    """Batch form."""
    seconds = severe_seconds(events, severity).distinct()
    return as_report(_marked(_runs(seconds, delay), delay).filter("fired"))


def as_report(fired: DataFrame) -> DataFrame:
    return fired.select("alert", F.timestamp_seconds("second").cast("timestamp_ntz").alias("fired_at"))


class AlertChain(StatefulProcessor):
    """The chain of responses of one alert, kept in blocks of ``BLOCK`` seconds: the severe seconds of a block and the last
    response up to its end.

    New seconds open the blocks they fall into. The chain runs on from there and stops at the first block behind them
    that it leaves with the same last response as before; then it jumps to the next block with new seconds.
    """

    def __init__(self, delay: int):
        self.delay = delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.blocks = handle.getMapState("blocks", "block long", "offsets binary, last long")
        self.index = handle.getValueState("index", "blocks binary")

    def _block(self, block: int) -> tuple[np.ndarray, int]:
        stored = self.blocks.getValue((block,))
        return np.frombuffer(stored[0], np.uint16).astype(np.int64) + block * BLOCK, stored[1]

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        new = np.unique(np.concatenate([pdf["second"].to_numpy() for pdf in rows]))
        known = np.frombuffer(self.index.get()[0], np.int64) if self.index.exists() else np.empty(0, np.int64)
        grown = {}
        for block in np.unique(new // BLOCK).tolist():
            here, before = new[new // BLOCK == block], np.empty(0, np.int64)
            if np.isin(block, known):
                before, _ = self._block(block)
            seconds = np.union1d(before, here)
            if len(seconds) > len(before):
                grown[block] = seconds
        if not grown:
            return
        index = np.union1d(known, np.array(list(grown), np.int64))
        if len(index) > len(known):
            self.index.update((index.tobytes(),))
        out, waiting = [], sorted(grown, reverse=True)
        at, last = -1, NEVER
        while waiting or at >= 0:
            if at < 0:
                at = int(np.searchsorted(index, waiting[-1]))
                last = self._block(int(index[at - 1]))[1] if at else NEVER
            block = int(index[at])
            fresh = bool(waiting) and waiting[-1] == block
            if fresh:
                waiting.pop()
                seconds, was = grown[block], None
            else:
                seconds, was = self._block(block)
            fired = answered(seconds, last, self.delay)
            last = fired[-1] if fired else last
            if last != was:
                self.blocks.updateValue((block,), ((seconds - block * BLOCK).astype(np.uint16).tobytes(), last))
            out.append((key[0], block, fired))
            # The chain goes on unless it left a block that was there before as it did before.
            at = at + 1 if (fresh or last != was) and at + 1 < len(index) else -1
        yield pd.DataFrame(out, columns=["alert", "block", "fired"])

    def close(self) -> None:
        pass


def _once_per_batch(frames):
    """Within an Arrow batch, each second of an alert once: a storm is thin before it is dealt to its alert."""
    for pdf in frames:
        yield pdf.drop_duplicates()


def stream_alerts(spark: SparkSession, pattern: str, files_per_batch: int = 64, severity: int = X.ALERT_SEVERITY,
                  delay: int = X.ALERT_DELAY_SECONDS, folder: str | None = None) -> DataFrame:
    """Streaming form, the same as the batch form whatever order files come in; no event is too late.

    The chain of each alert is keyed state in RocksDB (``AlertChain``). A micro-batch opens the blocks that its seconds
    fall into and those behind them up to the first that is left as before, so its work follows the new seconds and
    not the log. It writes the responses of these blocks into its own folder; the newest batch of a block counts. No
    timer clears state, since any event may still come; it grows with the clock, two bytes for a severe second.

    ``folder`` holds answers, state and progress; a later call with the same folder adds the files that are new.
    """
    folder = folder or new_path(spark, "alerts")
    answers = f"{folder}/answers"
    ship_package(spark)

    def keep(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{answers}/batch={batch_id}")

    seconds = severe_seconds(event_stream(spark, pattern, files_per_batch), severity)
    responses = (seconds.mapInPandas(_once_per_batch, "alert string, second long").groupBy("alert")
                 .transformWithStateInPandas(AlertChain(delay), _ANSWERS, outputMode="Update", timeMode="None"))
    with keyed_state(spark):
        run_to_end(responses.writeStream.outputMode("update").foreachBatch(keep), f"{folder}/progress")
    newest = (spark.read.schema(f"{_ANSWERS}, batch long").parquet(answers)
              .groupBy("alert", "block").agg(F.max_by("fired", "batch").alias("fired")))
    return as_report(newest.select("alert", F.explode("fired").alias("second")))
