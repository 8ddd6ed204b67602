"""Classifying records and setting bad ones aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedfold.functions import rules
from feedfold.operators.bounded import attach
from feedfold.options import Options
from feedfold.sources.decode import after_text, lacks_after

UPSERT, DELETE = "u", "d"


class RejectedRecords(ValueError):
    """Raised in strict mode where a feed holds records that cannot be applied."""


def order_of_record() -> Column:
    """Arrival order: offset within partition."""
    return F.struct("partition", "offset")


def classify(feed: DataFrame, options: Options) -> DataFrame:
    """Add ``op``: a record without a row is a delete by key.

    With the ``after`` envelope, ``value`` becomes the row inside it. ``stray``
    marks values that are no envelope; they are not taken for deletes.
    """
    stray = F.lit(False)
    if options.envelope == "after":
        feed = feed.withColumn("stray", lacks_after(F.col("value")))
        feed = feed.withColumn("value", F.when(F.col("stray"), F.col("value")).otherwise(after_text(F.col("value"))))
        stray = F.col("stray")
    return feed.withColumn("stray", stray).withColumn(
        "op", F.when(F.col("value").isNull(), DELETE).otherwise(UPSERT)
    )


def drop_disabled_deletes(records: DataFrame, options: Options) -> DataFrame:
    """Without deletes, tombstones are counted but not applied."""
    return records if options.deletes else records.filter(F.col("op") != DELETE)


def first_upserts(records: DataFrame) -> DataFrame:
    """Arrival order of the first upsert of each table that has one; one without a key does not count."""
    return (
        records.filter((F.col("op") == UPSERT) & F.col("key").isNotNull())
        .groupBy("table")
        .agg(F.min(order_of_record()).alias("first_upsert"))
    )


def flag_leading_deletes(records: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Add ``leading``: a delete before the first upsert of a table that does not exist yet.

    ``existing`` has one row per table that already exists.
    """
    flagged = attach(records, first_upserts(records), ["table"])
    early = (F.col("op") == DELETE) & (
        F.col("first_upsert").isNull() | (order_of_record() < F.col("first_upsert"))
    )
    if existing is not None:
        known = existing.select("table").distinct().withColumn("_exists", F.lit(True))
        flagged = attach(flagged, known, ["table"])
        early = early & F.col("_exists").isNull()
    return flagged.withColumn("leading", early).drop("first_upsert", "_exists")


def null_key(records: DataFrame) -> Column:
    return F.col("key").isNull()


def key_changed(sent: Column, key_names: str = "key_names") -> Column:
    """A delete whose key fields are not the target's key fields, as a set.

    ``sent`` are the names in the record's key. False where the target does not
    exist, that is where ``key_names`` is null.
    """
    differs = ~F.sort_array(sent).eqNullSafe(F.sort_array(key_names))
    return (F.col("op") == DELETE) & F.col(key_names).isNotNull() & differs


def unsupported_fields(fields: DataFrame) -> DataFrame:
    """Fields that have no column type."""
    return rules.resolve_types(fields).filter(F.col("internal") == rules.OTHER)


def split_rejects(records: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """Add ``reason``: the first that holds, else null."""
    reason = F.coalesce(*[F.when(test, F.lit(name)) for name, test in reasons.items()])
    return records.withColumn("reason", reason)


def accepted(flagged: DataFrame, options: Options) -> DataFrame:
    """Records without a reason; in strict mode any other record raises."""
    if options.strict:
        bad = flagged.filter(F.col("reason").isNotNull()).select("table", "reason").head()
        if bad is not None:
            raise RejectedRecords(f"table {bad['table']}: {bad['reason']}")
    return flagged.filter(F.col("reason").isNull()).drop("reason")


def rejected(flagged: DataFrame) -> DataFrame:
    """The reject table."""
    return flagged.filter(F.col("reason").isNotNull()).select(
        "table", "partition", "offset", "reason", "key", "value"
    )


def op_counts(records: DataFrame, *by: str) -> DataFrame:
    """Received, written and rejected records per group and operation."""
    rejects = F.col("reason").isNotNull() if "reason" in records.columns else F.lit(False)
    return records.groupBy(*by, "op").agg(
        F.count("*").alias("received"),
        F.count_if("applied").alias("written"),
        F.count_if(rejects).alias("rejected"),
    )


def spread_keys(records: DataFrame, keys: list[str]) -> DataFrame:
    """Keys seen in more than one topic partition, whose order is therefore undefined.

    The places are counted after they are made distinct, so a hot key is
    reduced before it is shuffled.
    """
    places = records.select("table", *keys, "topic", "partition").distinct()
    return (
        places.groupBy("table", *keys)
        .agg(F.count("*").alias("places"))
        .filter(F.col("places") > 1)
    )
