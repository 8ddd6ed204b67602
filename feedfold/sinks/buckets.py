"""Files in hash buckets of the key, laid out so that Spark reads them without a shuffle.

A *unit* is a folder of parquet files below ``table=.../bucket=...``, written once.
The files carry Spark's own bucket numbers, so a scan of a unit, or a union of scans of
units with the same number of buckets, is known to be partitioned by key: a
fold by key needs no exchange. The bucket is a folder too, so that rewriting or
reading some buckets touches only their files.

Spark takes the buckets of files from a table's description. A unit is described to
the session catalog while it is read or written, and forgotten right
after; nothing in the catalog outlives the call.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE, KEY, BUCKET = "table", "key", "bucket"
#: With this on, Spark would keep a list of a described table's folders in the catalog.
TRACKED_FOLDERS = "spark.sql.hive.manageFilesourcePartitions"


def bucket_of(key: Column, buckets: int) -> Column:
    """Bucket of a key, from 0, by the hash of Spark's bucketed files."""
    return F.pmod(F.hash(key), F.lit(buckets))


def new_unit(root: str, buckets: int) -> str:
    """Path of a unit to be written; its name tells the number of buckets."""
    return f"{root}/b{buckets}-{uuid.uuid4().hex}"


def buckets_in(path: str) -> int:
    return int(path.rsplit("/", 1)[1].split("-")[0].removeprefix("b"))


@contextmanager
def _described(spark: SparkSession, path: str, schema: T.StructType) -> Iterator[str]:
    """Name of a table over a unit, known to the session catalog only inside."""
    name = f"spark_catalog.default.unit_{uuid.uuid4().hex}"
    columns = T.StructType([f for f in schema if f.name not in (TABLE, BUCKET)]).toDDL()
    before = spark.conf.get(TRACKED_FOLDERS, "true")
    spark.conf.set(TRACKED_FOLDERS, "false")
    try:
        spark.sql(
            f"CREATE TABLE {name} ({columns}, `{TABLE}` string, `{BUCKET}` int) USING parquet "
            f"PARTITIONED BY (`{TABLE}`, `{BUCKET}`) CLUSTERED BY (`{KEY}`) INTO {buckets_in(path)} BUCKETS "
            f"LOCATION '{path}'"
        )
    finally:
        spark.conf.set(TRACKED_FOLDERS, before)
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_unit(rows: DataFrame, path: str, spread: bool = True) -> None:
    """Write rows with ``table`` and ``key``.

    ``spread`` deals them by table and bucket first, which splits large buckets over
    tasks and joins small ones; rows that were read from units are dealt already.
    """
    others = [c for c in rows.columns if c not in (TABLE, BUCKET)]
    placed = rows.select(*others, TABLE, bucket_of(F.col(KEY), buckets_in(path)).alias(BUCKET))
    if spread:
        placed = placed.hint("rebalance", F.col(TABLE), F.col(BUCKET))
    with _described(rows.sparkSession, path, placed.schema) as name:
        placed.write.insertInto(name)


def read_unit(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A unit's rows with the columns of ``schema``, then ``table`` and ``bucket``; columns its files lack are null."""
    with _described(spark, path, schema) as name:
        return spark.table(name)
