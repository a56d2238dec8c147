"""Streams over several micro-batches give the rows of their batch twins."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from haulmark.plans import telemetry
from haulmark.plans.quality import out_of_order
from haulmark.streaming import alerts, ingest, order, source, status
from tests.conftest import rows


@pytest.fixture(scope="module")
def split_events(spark, lake, tmp_path_factory):
    """The event log as six files in time order, so six micro-batches."""
    root = tmp_path_factory.mktemp("events")
    events = lake.table("events")
    top = events.agg(F.max("event_id")).first()[0]
    for i in range(6):
        lo, hi = i * (top + 1) // 6, (i + 1) * (top + 1) // 6
        part = root / f"part-{i}"
        events.filter((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1).write.parquet(str(part))
        file = next(part.glob("*.parquet"))
        target = root / f"events-{i}.parquet"
        target.write_bytes(file.read_bytes())
        import os
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    return f"{root}/events-*.parquet"


def test_alert_state_survives_micro_batches(spark, lake, split_events):
    got = alerts.stream_alerts(spark, split_events, files_per_batch=1)
    assert rows(got) == rows(alerts.batch_alerts(telemetry.scans(lake)))


def test_alert_rule_by_brute_force(spark):
    at = [0, 10, 299, 300, 301, 599, 600, 601, 5000, 5100, 5299, 5300]
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), 19) for s in at]
                               + [("a", dt.datetime(2024, 1, 1, 1), 5)], "event_type string, ts timestamp_ntz, k int")
    fired = [(r.fired_at - dt.datetime(2024, 1, 1)).total_seconds() for r in
             alerts.batch_alerts(df).orderBy("fired_at").collect()]
    assert fired == [0, 300, 600, 5000, 5300]


def test_ingest_splits_accepted_from_dead_letters(spark, split_events):
    got = ingest.ingest(spark, split_events, files_per_batch=2)
    bad = got.filter("verdict = 'accepted' AND (package_id IS NULL) = (pallet_id IS NULL)")
    assert bad.count() == 0
    assert {r.verdict for r in got.select("verdict").distinct().collect()} == {"accepted", "bad_code", "bad_entity"}


def test_status_is_that_of_the_newest_event(spark, lake, split_events):
    newest = lake.table("events").groupBy("user_id").agg(
        F.max_by("event_type", "ts").alias("status"), F.max("ts").alias("since"))
    assert rows(status.current_status(spark, split_events, files_per_batch=1)) == rows(newest)


def test_late_events_across_micro_batches(spark, lake, split_events):
    want = out_of_order(telemetry.scans(lake).select("user_id", "event_id", "late_ts"), ["user_id"], "event_id", "late_ts")
    got = order.late_events(spark, split_events, files_per_batch=1)
    assert rows(got.select("event_id", "previous_ts")) == rows(want.select("event_id", "previous_ts"))


@pytest.fixture(scope="module")
def shuffled_events(split_events, tmp_path_factory):
    """The same files, arriving out of time order."""
    import os
    from pathlib import Path
    root = tmp_path_factory.mktemp("shuffled")
    for place, i in enumerate([3, 0, 5, 1, 4, 2]):
        target = root / f"events-{place}.parquet"
        target.write_bytes(Path(split_events.replace("*", str(i))).read_bytes())
        os.utime(target, (1_700_000_000 + place, 1_700_000_000 + place))
    return root


@pytest.mark.parametrize("files", [1, 3, 64])
def test_streams_do_not_depend_on_the_order_of_files(spark, lake, shuffled_events, files):
    scans = telemetry.scans(lake)
    pattern = f"{shuffled_events}/events-*.parquet"
    assert rows(alerts.stream_alerts(spark, pattern, files)) == rows(alerts.batch_alerts(scans))
    want = out_of_order(scans.select("user_id", "event_id", "late_ts"), ["user_id"], "event_id", "late_ts")
    columns = ["user_id", "event_id", "late_ts", "previous_ts"]
    assert rows(order.late_events(spark, pattern, files).select(columns)) == rows(want.select(columns))


def test_streams_go_on_where_they_stopped(spark, lake, shuffled_events, tmp_path):
    events = tmp_path / "arriving"
    events.mkdir()
    pattern, scans = f"{events}/events-*.parquet", telemetry.scans(lake)
    for part in ([0, 1, 2], [3, 4, 5]):
        for i in part:
            (events / f"events-{i}.parquet").write_bytes((shuffled_events / f"events-{i}.parquet").read_bytes())
        fired = alerts.stream_alerts(spark, pattern, 2, folder=f"{tmp_path}/alerts")
        late = order.late_events(spark, pattern, 2, folder=f"{tmp_path}/late")
        seen = ingest.ingest(spark, pattern, 2, folder=f"{tmp_path}/ingested")
        now = status.current_status(spark, pattern, 2, folder=f"{tmp_path}/status")
    assert rows(fired) == rows(alerts.batch_alerts(scans))
    want = out_of_order(scans.select("user_id", "event_id", "late_ts"), ["user_id"], "event_id", "late_ts")
    assert rows(late.select("event_id", "previous_ts")) == rows(want.select("event_id", "previous_ts"))
    assert seen.count() == lake.table("events").count()
    assert now.count() == lake.table("events").select("user_id").distinct().count()


def test_stream_reads_every_event_once(spark, lake, split_events):
    assert source.event_stream(spark, split_events).isStreaming
    got = ingest.ingest(spark, split_events, files_per_batch=1)
    assert got.count() == got.select("event_id").distinct().count() == lake.table("events").count()


class _Kept:
    """State as a processor sees it, in a dictionary that counts the blocks opened."""

    def __init__(self):
        self.values, self.opened = {}, 0

    def getMapState(self, *_):  # noqa: N802
        return self

    def getValueState(self, *_):  # noqa: N802
        return self

    def getValue(self, key):  # noqa: N802
        self.opened += 1
        return self.values[key]

    def updateValue(self, key, value):  # noqa: N802
        self.values[key] = value

    def exists(self):
        return None in self.values

    def get(self):
        return self.values[None]

    def update(self, value):
        self.values[None] = value


def fed(chain, seconds):
    """Answers by block that the processor writes for one micro-batch."""
    out = {}
    for pdf in chain.handleInputRows(("a",), iter([pd.DataFrame({"alert": "a", "second": np.array(seconds, np.int64)})]), None):
        out |= {block: list(fired) for block, fired in zip(pdf["block"], pdf["fired"])}
    return out


@pytest.mark.parametrize("span, step", [(3_000, 1), (40_000, 50), (2_000_000, 3_000)])
def test_alert_chain_for_any_order(span, step):
    rng = random.Random(span)
    for _ in range(20):
        chain, kept, answers, seen = alerts.AlertChain(300), _Kept(), {}, set()
        chain.init(kept)
        for _ in range(12):
            new = [rng.randrange(-span, span) // step * step for _ in range(rng.randint(1, 60))]
            answers |= fed(chain, new)
            seen |= set(new)
            want = alerts.answered(np.array(sorted(seen)), alerts.NEVER, 300)
            assert sorted(s for fired in answers.values() for s in fired) == want


def test_alert_work_follows_the_new_seconds():
    chain, kept = alerts.AlertChain(300), _Kept()
    chain.init(kept)
    fed(chain, range(0, 500 * alerts.BLOCK, 700))  # every second second is answered: 500 blocks
    kept.opened = 0
    assert set(fed(chain, [250 * alerts.BLOCK + 1])) <= {250, 251, 252} and kept.opened <= 5
    kept.opened = 0
    assert fed(chain, [0, 700]) == {} and kept.opened == 1  # nothing new
    kept.opened = 0
    assert list(fed(chain, [600 * alerts.BLOCK])) == [600] and kept.opened <= 2


def write_events(spark, path, rows, at):
    """One file of events (user_id, event_id, seconds) with a time of its own."""
    import os
    import pyarrow as pa
    import pyarrow.parquet as pq
    start = dt.datetime(2024, 1, 1)
    pq.write_table(pa.table({
        "event_id": pa.array([e for _, e, _ in rows], pa.int64()), "ts": pa.array([start + dt.timedelta(seconds=s) for _, _, s in rows], pa.timestamp("us")),
        "user_id": pa.array([u for u, _, _ in rows], pa.int64()), "event_type": ["view"] * len(rows),
        "value": [1.0] * len(rows), "props": ["{}"] * len(rows)}), path)
    os.utime(path, (1_700_000_000 + at, 1_700_000_000 + at))


def brute_late(rows):
    out, last = set(), {}
    for user, event, second in sorted(rows, key=lambda r: r[1]):
        second -= 172_800 * (event % 17 == 0)
        if user in last and second < last[user]:
            out.add((user, event))
        last[user] = second
    return out


def test_late_events_over_blocks_in_any_order(spark, tmp_path):
    rng = random.Random(12)
    rows_ = [(rng.choice([1, 1, 1, 2, 3, 9]), e, e * 5 + rng.randrange(-9, 9)) for e in range(300) if rng.random() < 0.5]
    shuffled = rng.sample(rows_, len(rows_))
    for k in range(4):
        write_events(spark, f"{tmp_path}/events-{k}.parquet", shuffled[k::4], k)
    got = order.late_events(spark, f"{tmp_path}/events-*.parquet", 1, block_ids=16, buckets=2)
    found = [(r.user_id, r.event_id) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute_late(rows_)


def test_a_batch_opens_only_the_blocks_it_touches(spark, tmp_path, monkeypatch):
    opened, plain = [], order.History.touched

    def touched(self, fresh, batch_id):
        df = plain(self, fresh, batch_id)
        opened.append({f.split("/events/")[1].rsplit("/", 2)[0] for f in df.inputFiles() if "/events/" in f})
        return df
    monkeypatch.setattr(order.History, "touched", touched)
    first = [(u, e, e * 5) for e in range(0, 2000, 2) for u in [e // 2 % 10]]
    late = [(3, 407, 10), (3, 1999, 9_995)]
    write_events(spark, f"{tmp_path}/events-0.parquet", first, 0)
    write_events(spark, f"{tmp_path}/events-1.parquet", late, 1)
    got = order.late_events(spark, f"{tmp_path}/events-*.parquet", 1, block_ids=100, buckets=4)
    assert {(r.user_id, r.event_id) for r in got.collect()} == brute_late(first + late)
    assert len(opened[0]) > 50 and len(opened[1]) == 2  # of the folders of 20 blocks, two


def test_ingest_and_status_after_a_restart_equal_their_batch_forms(spark, lake, shuffled_events, tmp_path):
    events = tmp_path / "arriving"
    events.mkdir()
    pattern = f"{events}/events-*.parquet"
    for part in ([0, 1], [2, 3, 4, 5]):
        for i in part:
            (events / f"events-{i}.parquet").write_bytes((shuffled_events / f"events-{i}.parquet").read_bytes())
        seen = ingest.ingest(spark, pattern, 2, folder=f"{tmp_path}/ingested")
        now = status.current_status(spark, pattern, 2, folder=f"{tmp_path}/status")
    assert rows(seen.select("event_id", "verdict")) == rows(ingest.ingest(spark, pattern, 64).select("event_id", "verdict"))
    e = lake.table("events").toPandas().sort_values(["ts", "event_id"]).groupby("user_id").last()
    assert {(r.user_id, r.status) for r in now.collect()} == set(zip(e.index, e["event_type"]))
    verdicts = {r.event_id: r.verdict for r in seen.collect()}
    for event, kind in zip(*(lake.table("events").toPandas()[c] for c in ("event_id", "event_type"))):
        want = "bad_code" if kind == "error" else "bad_entity" if event % 50 == 7 or event % 53 == 5 else "accepted"
        assert verdicts[event] == want
