"""Joining a small summary to a feed after measuring it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A summary has one row per table or schema, so this is far above what feeds have.
BROADCAST_ROWS = 50_000


def attach(
    feed: DataFrame, summary: DataFrame, on: list[str], how: str = "left", limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Join ``summary`` to ``feed``; broadcast it only if it has at most ``limit`` rows.

    The measured rows are reused, so the summary is computed once. Beyond the
    limit the join shuffles, and adaptive execution splits its hot partitions.
    """
    spark = feed.sparkSession
    head = summary.limit(limit + 1).collect()
    if len(head) <= limit:
        small = F.broadcast(spark.createDataFrame(head, summary.schema))
    else:
        small = summary
    return feed.join(small, on, how)
