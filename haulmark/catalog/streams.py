"""R: streams over the event log, each run to its end and checked against SQL on the same rows."""

from __future__ import annotations

from haulmark.catalog.registry import query
from haulmark.streaming.alerts import batch_alerts, stream_alerts
from haulmark.streaming.ingest import ingest
from haulmark.streaming.order import late_events
from haulmark.streaming.status import current_status
from haulmark.plans import telemetry

_VERDICTS = """
SELECT event_id, CASE WHEN event_type NOT IN ('click', 'view', 'signup', 'purchase') THEN 'bad_code'
  WHEN event_id % 50 = 7 OR event_id % 53 = 5 THEN 'bad_entity' ELSE 'accepted' END AS verdict FROM events"""

_ALERTS = """
WITH RECURSIVE severe AS (SELECT DISTINCT event_type AS alert, date_trunc('second', ts) AS s FROM scans WHERE k % 26 >= 19),
fired AS (
  SELECT alert, min(s) AS fired_at FROM severe GROUP BY 1
  UNION ALL
  SELECT f.alert, min(x.s) FROM fired f JOIN severe x ON x.alert = f.alert AND x.s >= f.fired_at + INTERVAL 300 SECOND
  GROUP BY 1
)
SELECT alert, fired_at FROM fired"""


def _files(lake) -> str:
    return f"{lake.sf_dir}/events*.parquet"


@query("r1_checked_ingest", _VERDICTS)
def r1(lake):
    return ingest(lake.spark, _files(lake)).select("event_id", "verdict")


@query("r2_alert_suppression", _ALERTS)
def r2(lake):
    return stream_alerts(lake.spark, _files(lake))


@query("r2_alert_suppression_batch", _ALERTS)
def r2_batch(lake):
    return batch_alerts(telemetry.scans(lake))


@query("r3_current_status", """
SELECT user_id, event_type AS status, ts AS since FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) e WHERE r = 1""")
def r3(lake):
    return current_status(lake.spark, _files(lake))


@query("r4_late_events", """
SELECT user_id, event_id, late_ts, previous_ts FROM (
  SELECT user_id, event_id, late_ts, lag(late_ts) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_ts FROM scans) s
WHERE late_ts < previous_ts""")
def r4(lake):
    return late_events(lake.spark, _files(lake))
