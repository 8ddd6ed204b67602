"""Record schemas over time: change points, differences to the table, evolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedfold.functions import rules
from feedfold.operators.bounded import attach
from feedfold.operators.ordered import SPAN, previous_value, running_total
from feedfold.operators.records import DELETE, order_of_record
from feedfold.sources.decode import RECORD_SCHEMA, physical_type

NEW, DROPPED, SAME, CONFLICT = "new", "dropped", "same", "type_conflict"


def fingerprint(*schemas: Column) -> Column:
    """Fingerprint of schema texts."""
    return F.sha2(F.concat_ws("\n", *schemas), 256)


def schema_report(schema: Column) -> Column:
    """Readable one-line report of a record schema."""
    parsed = F.from_json(schema, RECORD_SCHEMA)

    def describe(f: Column) -> Column:
        return F.concat(
            f["field"],
            F.lit(":"),
            physical_type(f["type"]),
            F.coalesce(F.concat(F.lit("/"), f["name"]), F.lit("")),
            F.when(
                F.size(F.coalesce(f["parameters"], F.create_map())) > 0, F.to_json(f["parameters"])
            ).otherwise(""),
        )

    fields = F.array_join(F.transform(parsed["fields"], describe), ", ")
    head = F.concat_ws(" ", F.upper(parsed["type"]), parsed["name"], parsed["version"].cast("string"))
    return F.concat(head, F.lit("("), fields, F.lit(")"))


# Columns of a schema log: one row per record, with schema texts and their fingerprint.
LOG_COLUMNS = ["table", "partition", "offset", "op", "fp", "key_schema", "value_schema"]


def with_fingerprint(records: DataFrame) -> DataFrame:
    """Add ``fp`` to records with ``key_schema`` and ``value_schema``; null for deletes."""
    upsert = F.col("op") != DELETE
    return records.withColumn("fp", F.when(upsert, fingerprint(F.col("key_schema"), F.col("value_schema"))))


def flag_changes(log: DataFrame, span: int = SPAN) -> DataFrame:
    """Add ``changed`` to the rows of a schema log.

    An upsert is compared with the last upsert of its table in its topic
    partition. Deletes neither count as a change nor take part in the comparison.
    """
    rows = log.select("table", "partition", "offset", "op", "fp")
    rows = previous_value(rows, ["table", "partition"], F.col("fp"), "previous_fp", span)
    changed = F.col("fp").isNotNull() & ~F.col("fp").eqNullSafe(F.col("previous_fp"))
    return rows.withColumn("changed", changed).drop("previous_fp")


def fingerprint_changes(upserts: DataFrame, span: int = SPAN) -> DataFrame:
    """Upserts whose ``fp`` differs from ``previous_fp``, that of the upsert before in their partition.

    The first one of a partition counts, with a null before it.
    """
    rows = previous_value(upserts, ["table", "partition"], F.col("fp"), "previous_fp", span)
    return rows.filter(~F.col("fp").eqNullSafe(F.col("previous_fp")))


def moves(upserts: DataFrame, span: int = SPAN) -> DataFrame:
    """Distinct schema changes per table and partition, with the first and last offset of each.

    Producers with an old and a new schema that write by turns make many
    changes, but only a few distinct ones.
    """
    found = fingerprint_changes(upserts, span).groupBy("table", "partition", "previous_fp", "fp")
    return found.agg(F.min("offset").alias("first"), F.max("offset").alias("last"))


def schema_texts(log: DataFrame) -> DataFrame:
    """Key and value schema per fingerprint."""
    return (
        log.filter(F.col("fp").isNotNull())
        .groupBy("fp")
        .agg(F.any_value("key_schema").alias("key_schema"), F.any_value("value_schema").alias("value_schema"))
    )


def change_points(log: DataFrame, span: int = SPAN) -> DataFrame:
    """Records at which a table's schema differs from the one before.

    Only fingerprints go through the ordered scan; the few texts join after it.
    """
    upserts = log.filter(F.col("fp").isNotNull()).select("table", "partition", "offset", "fp")
    return attach(fingerprint_changes(upserts, span).drop("previous_fp"), schema_texts(log), ["fp"])


def numbered_changes(log: DataFrame, span: int = SPAN) -> DataFrame:
    """Change points with ``epoch``, counted from 1 per table and topic partition."""
    return running_total(change_points(log, span), ["table", "partition"], F.lit(1), "epoch", span)


def with_epochs(log: DataFrame, span: int = SPAN) -> DataFrame:
    """Add ``epoch``: how many schema changes lie at or before the record in its topic partition.

    Partitions have no order among each other. Rows of one epoch of a partition are
    written before the next epoch's change is made.
    """
    rows = flag_changes(log, span)
    return running_total(rows, ["table", "partition"], F.col("changed").cast("int"), "epoch", span)


def epoch_vectors(epochs: DataFrame) -> DataFrame:
    """Per table, the last epoch of each partition, and how far all and any of them are.

    ``epochs`` has ``table, partition, epoch``, in any number of rows. ``frontier`` is the epoch
    that every partition of the table has reached: the changes up to it are behind all
    partitions. ``ahead`` is the furthest one.
    """
    ends = epochs.groupBy("table", "partition").agg(F.max("epoch").alias("epoch"))
    place = F.struct("partition", "epoch")
    return ends.groupBy("table").agg(
        F.map_from_entries(F.sort_array(F.collect_list(place))).alias("vector"),
        F.min("epoch").alias("frontier"),
        F.max("epoch").alias("ahead"),
    )


def with_frontier(epochs: DataFrame) -> DataFrame:
    """Add ``settled``: whether the table's frontier has reached the row's epoch."""
    known = attach(epochs, epoch_vectors(epochs).select("table", "frontier"), ["table"])
    return known.withColumn("settled", F.col("epoch") <= F.col("frontier")).drop("frontier")


def schema_catalog(log: DataFrame) -> DataFrame:
    """Distinct record schemas per table with their first record and record count."""
    counts = (
        log.filter(F.col("fp").isNotNull())
        .groupBy("table", "fp")
        .agg(F.min(order_of_record()).alias("first_record"), F.count("*").alias("records"))
    )
    return attach(counts, schema_texts(log), ["fp"])


def column_types(fields: DataFrame, profile: str) -> DataFrame:
    """Add ``internal`` and ``column_type`` to field rows."""
    return rules.target_types(rules.resolve_types(fields), profile)


def schema_diff(fields: DataFrame, columns: DataFrame, on: list[str]) -> DataFrame:
    """Compare record fields with table columns by name, over the union of names.

    Both sides have ``on``, ``field`` and ``column_type``.
    """
    sent = fields.select(*on, "field", F.col("column_type").alias("record_type"))
    held = columns.select(*on, "field", F.col("column_type").alias("table_type"))
    both = sent.join(held, [*on, "field"], "full_outer")
    status = (
        F.when(F.col("record_type").isNull(), DROPPED)
        .when(F.col("table_type").isNull(), NEW)
        .when(F.col("record_type") == F.col("table_type"), SAME)
        .otherwise(CONFLICT)
    )
    return both.withColumn("status", status)


def needs_change(diff: DataFrame, on: list[str], allow_missing: bool) -> DataFrame:
    """Whether the table must be altered, and whether it cannot be.

    The same rule decides over all columns of a record's value and, apart from it, over the fields
    of its key against the table's key columns; ``needs_any_change`` joins the two.
    """
    new = F.bool_or(F.col("status") == NEW)
    dropped = F.bool_or(F.col("status") == DROPPED)
    change = new if allow_missing else new | dropped
    return diff.groupBy(*on).agg(
        change.alias("needs_change"), F.bool_or(F.col("status") == CONFLICT).alias("conflict")
    )


def needs_any_change(keys: DataFrame, values: DataFrame, on: list[str]) -> DataFrame:
    """The decision over a record from those over its key and over its value; a delete has none over a value."""
    sides = [
        side.select(*on, F.col("needs_change").alias(f"{name}_change"), F.col("conflict").alias(f"{name}_conflict"))
        for name, side in (("key", keys), ("value", values))
    ]
    either = sides[0].join(sides[1], on, "full_outer")
    told = [F.coalesce(F.col(c), F.lit(False)) for c in ("key_change", "value_change", "key_conflict", "value_conflict")]
    return either.select(*on, (told[0] | told[1]).alias("needs_change"), (told[2] | told[3]).alias("conflict"))


def type_conflicts(diff: DataFrame) -> DataFrame:
    return diff.filter(F.col("status") == CONFLICT)


def previous_layout(fields: DataFrame, allow_missing: bool, by: Sequence[str] = ("table",)) -> DataFrame:
    """Columns the table has before each epoch, from the fields of all epochs.

    ``fields`` has ``by``, ``epoch, field, column_type``. Epochs are counted within ``by``,
    which names the topic partition, too, where there are several. Unless missing fields
    are allowed, the table follows the last epoch exactly; else it keeps
    every column once seen.
    """
    if not allow_missing:
        return fields.select(*by, (F.col("epoch") + 1).alias("epoch"), "field", "column_type")
    epochs = fields.select(*by, "epoch").distinct()
    since = fields.groupBy(*by, "field").agg(
        F.min("epoch").alias("since"), F.min_by("column_type", "epoch").alias("column_type")
    )
    return (
        epochs.join(since, list(by))
        .filter(F.col("since") < F.col("epoch"))
        .select(*by, "epoch", "field", "column_type")
    )


def create_layout(fields: DataFrame) -> DataFrame:
    """Columns of a new table: keys in key order, then the value's other fields.

    ``fields`` has ``table, side, pos, field, column_type``.
    """
    merged = fields.groupBy("table", "field").agg(
        F.min("side").alias("side"),
        F.min_by("pos", "side").alias("pos"),
        F.min_by("column_type", "side").alias("column_type"),
    )
    key = F.col("side") == "key"
    order = F.row_number().over(
        Window.partitionBy("table").orderBy(F.when(key, 0).otherwise(1), "pos")
    )
    return merged.select(
        "table", "field", "column_type", key.alias("is_key"), (~key).alias("nullable"),
        order.alias("position"),
    )


def column_starts(moves: DataFrame) -> DataFrame:
    """From which records each column of a table counts.

    ``moves`` has, per distinct schema change, ``table, partition, last`` (its
    last offset) and the field ``names`` after and ``previous`` names before it
    (null at the start of a partition). A column is lost when every
    partition that had it dropped it; then it counts, per partition, from the
    record that added it last. ``starts`` maps a field to ``kept`` (it was never
    lost: all its values count) and ``at`` (partition to first offset).
    """
    before = F.coalesce("previous", F.array().cast("array<string>"))
    fields = moves.withColumn("previous", before).select(
        "table", "partition", "last", "names", "previous", F.explode(F.array_union("previous", "names")).alias("field")
    )
    has, had = F.array_contains("names", F.col("field")), F.array_contains("previous", F.col("field"))
    sides = fields.groupBy("table", "partition", "field").agg(
        F.max(F.when(has & ~had, F.col("last"))).alias("added"), F.max(F.when(had & ~has, F.col("last"))).alias("dropped")
    )
    alive = F.col("dropped").isNull() | (F.col("added") > F.col("dropped"))
    start = F.when(alive, F.struct("partition", "added"))
    columns = sides.groupBy("table", "field").agg(
        F.struct(
            F.bool_or(F.col("dropped").isNull()).alias("kept"), F.map_from_entries(F.collect_list(start)).alias("at")
        ).alias("start")
    )
    return columns.groupBy("table").agg(F.map_from_entries(F.collect_list(F.struct("field", "start"))).alias("starts"))
