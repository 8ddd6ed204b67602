"""From topic names to table names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedfold.options import Options


def table_name(topic: Column, options: Options) -> Column:
    """Strip the topic prefix, replace dots, add the table prefix, in that order."""
    name = topic
    if options.topic_prefix:
        rest = F.substring(topic, len(options.topic_prefix) + 1, 2_147_483_647)
        name = F.when(F.startswith(topic, F.lit(options.topic_prefix)), rest).otherwise(topic)
    if options.dot_replacement is not None:
        name = F.replace(name, F.lit("."), F.lit(options.dot_replacement))
    if options.table_prefix is not None:
        name = F.concat(F.lit(options.table_prefix), name)
    if options.lower_table_names:
        name = F.lower(name)
    return name


def route(feed: DataFrame, options: Options) -> DataFrame:
    """Add ``table`` to each record."""
    return feed.withColumn("table", table_name(F.col("topic"), options))
