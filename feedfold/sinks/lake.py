"""Writing current rows to files or catalog tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.functions.convert import Field, column_schema
from feedfold.options import Options

BUCKET = "bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Hash bucket of a key, from 0."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


# A value of each kind of key column, which is never stored: it only shows that the column has no nulls.
STAND_INS = {
    T.StringType: "", T.BinaryType: bytearray(), T.BooleanType: False, T.DateType: date(1970, 1, 1),
    T.TimestampType: datetime(1970, 1, 1, tzinfo=timezone.utc),
}


def never_null(column: str, kind: T.DataType) -> Column:
    """A column that Spark knows to hold no nulls; one that turns up raises."""
    checked = F.when(F.col(column).isNull(), F.raise_error(F.lit(f"null in key column {column}")).cast(kind)).otherwise(F.col(column))
    return F.coalesce(checked, F.lit(STAND_INS.get(type(kind), 0)).cast(kind)).alias(column)


def _with_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in rows.schema}
    return rows.select(*[never_null(c, kinds[c]) if c in keys else c for c in rows.columns])


def write_lake(rows: DataFrame, path: str, options: Options, mode: str = "overwrite", keys: Sequence[str] = ()) -> None:
    """Rows as files of the configured format, one folder per table.

    Adaptive execution sizes the files: it splits large tables and joins
    small ones. ``keys`` are marked as non-null in parquet files. The ``avro`` format
    needs Spark's Avro package.
    """
    spread = _with_keys(rows.hint("rebalance", F.col("table")), keys)
    spread.write.mode(mode).partitionBy("table").format(options.lake_format).save(path)


def read_lake(rows_schema: DataFrame, path: str, options: Options) -> DataFrame:
    """Rows written by ``write_lake``, with the columns of ``rows_schema``."""
    spark = rows_schema.sparkSession
    return spark.read.format(options.lake_format).schema(rows_schema.schema).load(path)


def read_lake_fields(spark: SparkSession, path: str, fields: Sequence[Field], keys: Sequence[str], options: Options) -> DataFrame:
    """Rows of ``table`` and fields, by the schema of finished columns: keys are checked and known to be non-null."""
    shape = column_schema(list(fields), list(keys), options.profile)
    rows = spark.read.format(options.lake_format).schema(T.StructType([*shape, T.StructField("table", T.StringType())])).load(path)
    return _with_keys(rows, keys)


def write_catalog_table(rows: DataFrame, table: str, options: Options) -> None:
    """Rows as a table of a catalog that supports the data source writer API."""
    rows.writeTo(f"{options.lake_namespace}.{table}").using(options.lake_format).createOrReplace()


def write_buckets(rows: DataFrame, path: str, keys: Sequence[str], options: Options) -> None:
    """Rows of one table in hash buckets of its key, one folder per bucket."""
    spread = rows.withColumn(BUCKET, bucket_of(keys, options.buckets))
    spread.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def save_bucketed(rows: DataFrame, table: str, keys: Sequence[str], options: Options) -> None:
    """Rows as a bucketed, sorted session-catalog table: joins and folds on the key need no shuffle."""
    spread = rows.repartition(options.buckets, *keys)
    writer = spread.write.mode("overwrite").bucketBy(options.buckets, *keys).sortBy(*keys)
    writer.format("parquet").saveAsTable(table)


def merge_into(changes: DataFrame, target: str, keys: Sequence[str], columns: Sequence[str]) -> None:
    """Apply folded changes to a catalog table that supports row-level operations.

    ``changes`` has the keys, ``alive``, ``reset`` and, per column, a struct
    ``v`` that is null where the column is not set.
    """
    table = target.split(".")[-1]
    matches = reduce(and_, [F.col(f"{table}.{key}") == F.col(f"changes.{key}") for key in keys])

    def merged(name: str) -> Column:
        new, old = F.col(f"changes.{name}"), F.col(f"{table}.{name}")
        return F.when(new.isNotNull(), new["v"]).when(~F.col("changes.reset"), old)

    insert = {key: F.col(f"changes.{key}") for key in keys}
    insert |= {name: F.col(f"changes.{name}")["v"] for name in columns}
    (
        changes.alias("changes")
        .mergeInto(target, matches)
        .whenMatched(~F.col("changes.alive"))
        .delete()
        .whenMatched()
        .update({name: merged(name) for name in columns})
        .whenNotMatched(F.col("changes.alive"))
        .insert(insert)
        .merge()
    )
