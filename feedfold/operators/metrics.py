"""Feed-rate reports over metric samples.

Samples have ``ts`` (timestamp_ntz), ``metric``, ``labels`` (map) and ``value``.
Every report is evaluated at the end of each step of five minutes. Samples
are first reduced to one row per series and step; only those small rows are
spread over the longer look-back ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Thresholds and ranges of the throttle decision.
STEP_SECONDS = 300
INCREASE_RANGE_SECONDS = 1800
RATE_RANGE_SECONDS = 600
MAX_QUEUED = 1_000_000
MAX_CHECKPOINT_MILLIS = 200_000
MAX_PAUSE_GROWTH = 500
HOT_SHARE_PERCENT = 5
PAUSE_MILLIS = 25_000
NO_SINGLE_VALUE = -1.0


def _epoch_seconds(ts: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, ts)


def step_end(step: Column) -> Column:
    """End of a numbered step as a zone-free timestamp."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", (step + 1) * STEP_SECONDS, epoch)


def series(samples: DataFrame, metric: str, labels: list[str]) -> DataFrame:
    """Samples of one metric with some labels as columns and the step each lies in."""
    return samples.filter(F.col("metric") == metric).select(
        *[F.col("labels")[label].alias(label) for label in labels],
        "ts",
        "value",
        F.call_function("div", _epoch_seconds(F.col("ts")), F.lit(STEP_SECONDS)).alias("step"),
    )


def _growth(before: Column, after: Column) -> Column:
    """Growth of a counter; a smaller value means that it restarted at zero."""
    return F.when(after < before, after).otherwise(after - before)


def _over_range(panes: DataFrame, range_seconds: int) -> DataFrame:
    """Let each pane count in every evaluation step whose range covers it."""
    count = range_seconds // STEP_SECONDS
    offsets = F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("_ahead")
    return (
        panes.select("*", offsets)
        .withColumn("pane", F.col("step"))
        .withColumn("step", F.col("step") + F.col("_ahead"))
        .drop("_ahead")
    )


def feed_increase(samples: DataFrame, metric: str, by: str, instance: list[str]) -> DataFrame:
    """Increase of a counter over the last 30 minutes, summed per ``by``.

    ``instance`` are the other labels that tell series apart.
    """
    labels = [by, *instance]
    rows = series(samples, metric, labels)
    inside = Window.partitionBy(*labels, "step").orderBy("ts")
    panes = (
        rows.withColumn("_before", F.lag("value").over(inside))
        .groupBy(*labels, "step")
        .agg(
            F.min_by("value", "ts").alias("first"),
            F.max_by("value", "ts").alias("last"),
            F.coalesce(F.sum(_growth(F.col("_before"), F.col("value"))), F.lit(0.0)).alias("inner"),
        )
    )
    across = Window.partitionBy(*labels, "step").orderBy("pane")
    joints = _over_range(panes, INCREASE_RANGE_SECONDS).withColumn(
        "joint", _growth(F.lag("last").over(across), F.col("first"))
    )
    return joints.groupBy("step", by).agg(
        F.sum(F.col("inner") + F.coalesce("joint", F.lit(0.0))).alias("increase")
    )


def feed_share(increases: DataFrame) -> DataFrame:
    """Share of each feed in the total increase of its step, in percent."""
    total = F.sum("increase").over(Window.partitionBy("step"))
    share = F.when(total != 0, F.col("increase") * 10000.0 / total / 100.0)
    return increases.withColumn("percent", share)


def hot_feeds(shares: DataFrame) -> DataFrame:
    """Feeds above the share limit, with the pause to make."""
    return shares.filter(F.col("percent") > HOT_SHARE_PERCENT).withColumn(
        "pause_ms", F.lit(PAUSE_MILLIS).cast("bigint")
    )


def latest_values(samples: DataFrame, metric: str, instance: list[str]) -> DataFrame:
    """Latest sample of each series in each step."""
    return (
        series(samples, metric, instance)
        .groupBy(*instance, "step")
        .agg(F.max_by("value", "ts").alias("value"))
    )


def max_gauge(samples: DataFrame, metric: str, instance: list[str], name: str) -> DataFrame:
    """Largest latest value over all series, per step."""
    return latest_values(samples, metric, instance).groupBy("step").agg(F.max("value").alias(name))


def max_instance_sum(samples: DataFrame, metric: str, by: str, instance: list[str]) -> DataFrame:
    """Largest per-instance sum of latest values, per step."""
    return (
        latest_values(samples, metric, [by, *instance])
        .groupBy("step", by)
        .agg(F.sum("value").alias("total"))
        .groupBy("step")
        .agg(F.max("total").alias("max_total"))
    )


def max_rate(samples: DataFrame, metric: str, instance: list[str], name: str) -> DataFrame:
    """Largest per-second growth between the last two samples of the last 10 minutes."""
    rows = series(samples, metric, instance)
    point = F.struct("ts", "value")
    inside = Window.partitionBy(*instance, "step").orderBy(F.col("ts").desc())
    panes = (
        rows.withColumn("_rank", F.row_number().over(inside))
        .filter("_rank <= 2")
        .groupBy(*instance, "step")
        .agg(F.collect_list(point).alias("points"))
    )
    pairs = (
        _over_range(panes, RATE_RANGE_SECONDS)
        .groupBy(*instance, "step")
        .agg(F.slice(F.sort_array(F.flatten(F.collect_list("points")), asc=False), 1, 2).alias("points"))
        .filter(F.size("points") == 2)
    )
    after, before = F.col("points")[0], F.col("points")[1]
    seconds = F.timestamp_diff("MICROSECOND", before["ts"], after["ts"]) / 1_000_000.0
    rate = _growth(before["value"], after["value"]) / seconds
    return pairs.groupBy("step").agg(F.max(rate).alias(name))


def overload_gate(queue: DataFrame, checkpoint: DataFrame, pause: DataFrame) -> DataFrame:
    """Whether any gauge is over its limit, per step; a missing value counts as -1."""
    joined = queue.join(checkpoint, "step", "full_outer").join(pause, "step", "full_outer")
    filled = joined.select(
        "step",
        *[
            F.coalesce(F.col(name), F.lit(NO_SINGLE_VALUE)).alias(name)
            for name in ("max_queue", "max_checkpoint", "max_pause_rate")
        ],
    )
    return filled.withColumn(
        "overloaded",
        (F.col("max_queue") > MAX_QUEUED)
        | (F.col("max_checkpoint") > MAX_CHECKPOINT_MILLIS)
        | (F.col("max_pause_rate") > MAX_PAUSE_GROWTH),
    )


def throttle_decisions(gate: DataFrame, hot: DataFrame, increases: DataFrame, by: str) -> DataFrame:
    """Per step and feed: whether to throttle and for how long; other feeds get (false, 0).

    Feeds are those with a counter in the step's range, so nothing is crossed.
    """
    limited = (
        hot.select("step", by, "pause_ms")
        .join(gate.filter("overloaded").select("step"), "step", "left_semi")
    )
    return (
        increases.select("step", by)
        .join(limited, ["step", by], "left")
        .select(
            "step",
            by,
            F.col("pause_ms").isNotNull().alias("throttle"),
            F.coalesce("pause_ms", F.lit(0).cast("bigint")).alias("pause_ms"),
        )
    )
