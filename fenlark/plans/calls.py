"""Calls of keys by event time: breakers that open and close, and buckets that admit."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import breaker
from .base import query, read


@query("""WITH RECURSIVE e AS (SELECT user_id, ts, event_type = 'error' AS failed, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type = 'error') AS k FROM events),
r(user_id, k, state, run, opened, was, half, ts) AS (SELECT user_id, 0::BIGINT, 'CLOSED', 0, NULL::TIMESTAMP, 'CLOSED', NULL::TIMESTAMP, NULL::TIMESTAMP FROM (SELECT DISTINCT user_id FROM events)
 UNION ALL SELECT user_id, k, CASE WHEN now = 'OPEN' THEN 'OPEN' WHEN failed AND (now = 'HALF_OPEN' OR run + 1 >= 2) THEN 'OPEN' WHEN failed THEN now ELSE 'CLOSED' END, CASE WHEN now = 'OPEN' THEN run WHEN failed THEN run + 1 ELSE 0 END,
  CASE WHEN now <> 'OPEN' AND failed AND (now = 'HALF_OPEN' OR run + 1 >= 2) THEN ts ELSE opened END, now, CASE WHEN now <> state THEN opened + INTERVAL 12 HOUR END, ts
 FROM (SELECT e.user_id, e.k, e.ts, e.failed, r.state, r.run, r.opened, CASE WHEN r.state = 'OPEN' AND e.ts >= r.opened + INTERVAL 12 HOUR THEN 'HALF_OPEN' ELSE r.state END AS now FROM r JOIN e ON e.user_id = r.user_id AND e.k = r.k + 1))
SELECT CAST(user_id AS VARCHAR) AS key, half AS ts, 'HALF_OPEN' AS state FROM r WHERE half IS NOT NULL UNION ALL SELECT CAST(user_id AS VARCHAR), ts, state FROM r WHERE k > 0 AND state <> was
UNION ALL SELECT CAST(user_id AS VARCHAR), opened + INTERVAL 12 HOUR, 'HALF_OPEN' FROM r WHERE state = 'OPEN' AND k = (SELECT max(k) FROM e WHERE e.user_id = r.user_id)""")
def breaker_changes(spark, sf_dir):
    """Each user's breaker: two errors in a row open it, after twelve hours it is half open."""
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("key"), "ts", (F.col("event_type") == "error").alias("failed"))
    return breaker.breaker_changes(e, 2, 12 * 3600).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""WITH RECURSIVE e AS (SELECT event_type, event_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM events),
r(event_type, event_id, k, us, credit, ok) AS (SELECT event_type, event_id, k, us, 4 * 1800000000::BIGINT - 1800000000, true FROM e WHERE k = 1
 UNION ALL SELECT event_type, event_id, k, us, CASE WHEN c >= 1800000000 THEN c - 1800000000 ELSE c END, c >= 1800000000 FROM (SELECT e.event_type, e.event_id, e.k, e.us, least(4 * 1800000000::BIGINT, r.credit + e.us - r.us) AS c FROM r JOIN e ON e.event_type = r.event_type AND e.k = r.k + 1))
SELECT event_type AS key, event_id AS id, ok AS admitted FROM r""")
def token_bucket(spark, sf_dir):
    """Events that a bucket of four tokens, one more in half an hour, admits of each kind."""
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("key"), F.col("event_id").alias("id"), "ts")
    return breaker.admitted(e, 4, 1800).select("key", "id", "admitted")
