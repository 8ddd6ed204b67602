"""Feed-rate and throttling reports over metric samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.operators import metrics
from feedfold.plans import fixtures
from feedfold.session import landed

# The ranges once more, as the comparison SQL takes them: steps of five minutes, thirty and ten minutes long.
STEP, INCREASE_STEPS, RATE_STEPS = 300, 6, 2

# Samples as plain columns; the report adds each sample to every step whose range covers it.
_SAMPLES = f"""
samples AS (
  SELECT event_id AS s, event_id // {STEP} AS own_step,
         CASE WHEN user_id % 3 = 0 THEN 'feed_0' ELSE 'feed_' || (user_id % 25) END AS feed,
         'node_' || (user_id % 4) AS instance, 'pool_' || (user_id % 3) AS pool, value
  FROM events
), counted AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY feed ORDER BY s) % {fixtures.COUNTER_WRAP} AS DOUBLE) AS seen,
         CAST(sum(floor(value * 10)) OVER (PARTITION BY instance ORDER BY s) AS DOUBLE) AS paused
  FROM samples
)"""
_EPOCH_STEP = 1704067200 // STEP
_END = f"TIMESTAMP '2024-01-01 00:00:00' + to_seconds((step + 1 - {_EPOCH_STEP}) * {STEP})"

_INCREASES = f"""
{_SAMPLES}, ranged AS (
  SELECT feed, own_step + a.ahead + {_EPOCH_STEP} AS step, seen,
         lag(seen) OVER (PARTITION BY feed, own_step + a.ahead ORDER BY s) AS before
  FROM counted, (SELECT unnest(range({INCREASE_STEPS})) AS ahead) a
), increases AS (
  SELECT step, feed,
         sum(CASE WHEN before IS NULL THEN 0.0 WHEN seen < before THEN seen ELSE seen - before END) AS increase
  FROM ranged GROUP BY 1, 2
), shares AS (
  SELECT *, CASE WHEN sum(increase) OVER (PARTITION BY step) <> 0
                 THEN increase * 10000.0 / sum(increase) OVER (PARTITION BY step) / 100.0 END AS percent
  FROM increases
), hot AS (
  SELECT *, CAST(25000 AS BIGINT) AS pause_ms FROM shares WHERE percent > 5
)"""

_GATE = f"""
queue AS (
  SELECT step, max(value) AS max_queue FROM (
    SELECT own_step + {_EPOCH_STEP} AS step, CAST(floor(arg_max(value, s) * 2500) AS DOUBLE) AS value
    FROM counted GROUP BY own_step, instance, pool) GROUP BY 1
), checkpoint AS (
  SELECT step, max(value) AS max_checkpoint FROM (
    SELECT own_step + {_EPOCH_STEP} AS step, CAST(floor(arg_max(value, s) * 500) AS DOUBLE) AS value
    FROM counted GROUP BY own_step, instance) GROUP BY 1
), pauses AS (
  SELECT own_step + a.ahead + {_EPOCH_STEP} AS step, instance, s, paused,
         row_number() OVER (PARTITION BY own_step + a.ahead, instance ORDER BY s DESC) AS rn,
         lead(paused) OVER (PARTITION BY own_step + a.ahead, instance ORDER BY s DESC) AS before,
         lead(s) OVER (PARTITION BY own_step + a.ahead, instance ORDER BY s DESC) AS before_s
  FROM counted, (SELECT unnest(range({RATE_STEPS})) AS ahead) a
), pause AS (
  SELECT step, max(CASE WHEN paused < before THEN paused ELSE paused - before END / (s - before_s)) AS max_pause_rate
  FROM pauses WHERE rn = 1 AND before IS NOT NULL GROUP BY 1
), gate AS (
  SELECT step, coalesce(max_queue, -1) AS max_queue, coalesce(max_checkpoint, -1) AS max_checkpoint,
         coalesce(max_pause_rate, -1) AS max_pause_rate
  FROM queue FULL JOIN checkpoint USING (step) FULL JOIN pause USING (step)
), gated AS (
  SELECT *, max_queue > 1000000 OR max_checkpoint > 200000
         OR max_pause_rate > 500 AS overloaded
  FROM gate
)"""


def _at_end(report: DataFrame) -> DataFrame:
    """Show a step as the time it ends."""
    return report.withColumn("at", metrics.step_end(F.col("step"))).drop("step")


def _increases(samples: DataFrame) -> DataFrame:
    return metrics.feed_increase(samples, fixtures.READ_TOTAL, "feed", [])


def feed_increase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_end(_increases(fixtures.metric_samples(spark, sf_dir)))


def feed_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_end(metrics.feed_share(_increases(fixtures.metric_samples(spark, sf_dir))))


def hot_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_end(metrics.hot_feeds(metrics.feed_share(_increases(fixtures.metric_samples(spark, sf_dir)))))


def _gate(samples: DataFrame) -> DataFrame:
    return metrics.overload_gate(
        metrics.max_gauge(samples, fixtures.QUEUE_SIZE, ["instance", "pool"], "max_queue"),
        metrics.max_gauge(samples, fixtures.CHECKPOINT, ["instance"], "max_checkpoint"),
        metrics.max_rate(samples, fixtures.PAUSE_TOTAL, ["instance"], "max_pause_rate"),
    )


def overload_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_end(_gate(fixtures.metric_samples(spark, sf_dir)))


def max_instance_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = fixtures.metric_samples(spark, sf_dir)
    return _at_end(metrics.max_instance_sum(samples, fixtures.QUEUE_SIZE, "instance", ["pool"]))


def throttle_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = fixtures.metric_samples(spark, sf_dir)
    increases = landed(_increases(samples), "feed_increase")
    hot = metrics.hot_feeds(metrics.feed_share(increases))
    return _at_end(metrics.throttle_decisions(_gate(samples), hot, increases, "feed"))


QUERIES = {
    "feed_increase": feed_increase,
    "feed_share": feed_share,
    "hot_feeds": hot_feeds,
    "overload_gate": overload_gate,
    "max_instance_sum": max_instance_sum,
    "throttle_decision": throttle_decision,
}

SQL = {
    "feed_increase": f"WITH {_INCREASES} SELECT {_END} AS at, feed, increase FROM increases",
    "feed_share": f"WITH {_INCREASES} SELECT {_END} AS at, feed, increase, percent FROM shares",
    "hot_feeds": f"WITH {_INCREASES} SELECT {_END} AS at, feed, increase, percent, pause_ms FROM hot",
    "overload_gate": f"""
WITH {_SAMPLES}, {_GATE}
SELECT {_END} AS at, max_queue, max_checkpoint, max_pause_rate, overloaded FROM gated""",
    "max_instance_sum": f"""
WITH {_SAMPLES}, lasts AS (
  SELECT own_step + {_EPOCH_STEP} AS step, instance, pool, CAST(floor(arg_max(value, s) * 2500) AS DOUBLE) AS value
  FROM samples GROUP BY own_step, instance, pool
), sums AS (SELECT step, instance, sum(value) AS total FROM lasts GROUP BY 1, 2)
SELECT {_END} AS at, max(total) AS max_total FROM sums GROUP BY step""",
    "throttle_decision": f"""
WITH {_INCREASES}, {_GATE}
SELECT {_END.replace('step', 'i.step')} AS at, i.feed, h.feed IS NOT NULL AS throttle, coalesce(h.pause_ms, 0) AS pause_ms
FROM increases i
LEFT JOIN (SELECT hot.* FROM hot JOIN gated USING (step) WHERE overloaded) h ON h.step = i.step AND h.feed = i.feed""",
}
