"""The standard plan: feed to classified, typed, current rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedfold.functions import convert
from feedfold.functions.convert import Field
from feedfold.operators import fold, records, schema
from feedfold.operators.bounded import attach
from feedfold.operators.route import route
from feedfold.options import Options
from feedfold.session import landed
from feedfold.sources.decode import RECORD_SCHEMA, decode_json, looks_like_object, payload_or_text, split_described

# Name under which the JSON parser keeps a text it could not parse in full.
CORRUPT = "_corrupt"


def prepare(feed: DataFrame, options: Options) -> DataFrame:
    """Routed and classified records."""
    return records.classify(route(feed, options), options)


def with_typed_key(rows: DataFrame, key_fields: Sequence[Field], options: Options) -> DataFrame:
    """Add the key columns."""
    parsed = rows.withColumn("_key", decode_json(F.col("key"), list(key_fields)))
    return convert.typed(parsed, "_key", list(key_fields), options).drop("failed")


def with_sound_key(rows: DataFrame, key_fields: Sequence[Field], options: Options) -> DataFrame:
    """Add the key columns; records whose key does not give all of them are left out."""
    return _with_key(rows, key_fields, options).filter("_key_reason IS NULL").drop("_key_reason")


def _with_key(rows: DataFrame, key_fields: Sequence[Field], options: Options) -> DataFrame:
    """Add the key columns and ``_key_reason``: why the key is no good."""
    fields = list(key_fields)
    parsed = rows.withColumn("_key", decode_json(F.col("key"), fields, CORRUPT))
    parsed = parsed.withColumn("_corrupt_key", F.col("_key")[CORRUPT].isNotNull())
    typed = convert.typed(parsed, "_key", fields, options)
    lacks = reduce(Column.__or__, [F.col(f.name).isNull() for f in fields], F.lit(False))
    reason = (
        F.when(F.col("key").isNull(), "null_key")
        .when(~looks_like_object(F.col("key")), "malformed_key")
        .when(F.col("_corrupt_key") | (F.size("failed") > 0), "cast_failed")
        .when(lacks, "null_key")
    )
    return typed.withColumn("_key_reason", reason).drop("failed", "_corrupt_key")


def sound_values(rows: DataFrame, fields: Sequence[Field], options: Options, prefix: str = "") -> DataFrame:
    """Replace ``value`` by its columns (or add them, with a prefix); upserts with a bad value are left out."""
    return _with_values(rows, fields, options, prefix).filter("_value_reason IS NULL").drop("_value_reason")


def _with_values(rows: DataFrame, fields: Sequence[Field], options: Options, prefix: str = "") -> DataFrame:
    """Replace ``value`` by its columns (or add them, with a prefix), and add ``_value_reason``: why an upsert's value is no good."""
    parsed = rows.withColumn("_value", decode_json(F.col("value"), list(fields), CORRUPT))
    malformed = ~F.coalesce(looks_like_object(F.col("value")), F.lit(False))
    told = F.when(malformed, "malformed_value").when(F.col("_value")[CORRUPT].isNotNull(), "cast_failed")
    parsed = parsed.withColumn("_told", told)
    if not prefix:
        parsed = parsed.drop("value")
    typed = convert.typed(parsed, "_value", list(fields), options, prefix)
    reason = F.coalesce("_told", F.when(F.size("failed") > 0, "cast_failed"))
    return typed.withColumn("_value_reason", F.when(F.col("op") != records.DELETE, reason)).drop("failed", "_told")


def flagged_records(
    feed: DataFrame, key_fields: Sequence[Field], value_fields: Sequence[Field], options: Options
) -> DataFrame:
    """Routed, classified and typed records with ``reason``, from one parse of each.

    Reasons are those of a stream whose tables have these keys. Value columns carry the
    prefix ``v_``; ``key`` and ``value`` stay as they were sent.
    """
    names = [f.name for f in key_fields]
    rows = prepare(feed, options)
    keyed = _with_key(rows, key_fields, options)
    typed = _with_values(keyed, [f for f in value_fields if f.name not in names], options, "v_")
    other_key = records.key_changed(F.json_object_keys("key"), "_names")
    no_object = ~F.coalesce(looks_like_object(F.col("key")), F.lit(False))
    reason = F.coalesce(
        F.when(no_object, F.col("_key_reason")),
        F.when(F.col("stray"), "malformed_value"),
        F.when(F.col("_value_reason") == "malformed_value", F.col("_value_reason")),
        F.when(other_key, "delete_key_change"),
        F.when(F.col("_key_reason") == "cast_failed", "cast_failed"),
        F.col("_value_reason"),
        F.col("_key_reason"),
    )
    flagged = typed.withColumn("_names", F.array(*map(F.lit, names))).withColumn("reason", reason)
    return flagged.drop("_names", "_key_reason", "_value_reason")


def rows_and_rejects(
    feed: DataFrame, key_fields: Sequence[Field], value_fields: Sequence[Field], options: Options
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Current rows, the reject table, and counts of records by table and operation.

    The feed is read and parsed once: flagged records are written down, and all three
    results come from there. With ``strict`` a reject raises.
    """
    key_names = [f.name for f in key_fields]
    columns = [f.name for f in value_fields if f.name not in key_names]
    keys = ["table", *key_names]
    flagged = landed(flagged_records(feed, key_fields, value_fields, options), "flagged")
    enabled = F.lit(options.deletes) | (F.col("op") != records.DELETE)
    leading = F.col("leading") if options.evolves else F.lit(False)
    counted = records.flag_leading_deletes(flagged).withColumn("applied", F.col("reason").isNull() & enabled & ~leading)
    counts = records.op_counts(counted, "table")
    good = records.drop_disabled_deletes(records.accepted(flagged, options), options)
    if options.null_overwrites:
        rows = fold.latest(good, keys, *[f"v_{c}" for c in columns])
        rows = rows.select(*keys, *[F.col(f"v_{c}").alias(c) for c in columns])
    else:
        groups = fold.single_groups([f"v_{c}" for c in columns])
        present = {g: F.col(members[0]).isNotNull() for g, members in groups.items()}
        rows = fold.fold(good, keys, groups, present)
        rows = rows.select(*keys, *[F.col(f"v_{c}").alias(c) for c in columns])
    return rows, records.rejected(flagged), counts


def with_typed_value(
    rows: DataFrame, fields: Sequence[Field], options: Options, payload: str = "value", prefix: str = ""
) -> DataFrame:
    """Replace the JSON ``payload`` by its columns, and add ``failed``.

    With a ``prefix`` the payload stays and the columns are added under new names.
    """
    parsed = rows.withColumn("_value", decode_json(F.col(payload), list(fields)))
    if not prefix:
        parsed = parsed.drop(payload)
    return convert.typed(parsed, "_value", list(fields), options, prefix)


def current_rows(
    feed: DataFrame, key_fields: Sequence[Field], value_fields: Sequence[Field], options: Options
) -> DataFrame:
    """Current rows of all tables in a feed whose records share one schema.

    Every record carries every column, so the last record decides the whole
    row: its text is folded, after a look that no bad record takes part. Where
    nulls leave columns alone, records are folded column by column.
    """
    key_names = [f.name for f in key_fields]
    value_fields = [f for f in value_fields if f.name not in key_names]
    keys = ["table", *key_names]
    rows = prepare(feed, options).filter(F.col("key").isNotNull() & ~F.col("stray"))
    rows = records.drop_disabled_deletes(with_sound_key(rows, key_fields, options), options)
    if options.null_overwrites:
        checked = sound_values(rows, value_fields, options, "v_").drop(*[f"v_{f.name}" for f in value_fields])
        last = fold.latest(checked, keys, "value")
        return with_typed_value(last, value_fields, options).select(*keys, *[f.name for f in value_fields])
    typed = sound_values(rows, value_fields, options)
    groups = fold.single_groups([f.name for f in value_fields])
    present = {g: F.col(members[0]).isNotNull() for g, members in groups.items()}
    return fold.fold(typed, keys, groups, present)


def unwrap(rows: DataFrame) -> DataFrame:
    """Split self-describing keys and values into schema and payload."""
    parts = rows.select(
        "*", split_described(F.col("key")).alias("_k"), split_described(F.col("value")).alias("_v")
    )
    return parts.select(
        *[c for c in rows.columns if c not in ("key", "value")],
        payload_or_text(F.col("key"), F.col("_k")).alias("key"),
        payload_or_text(F.col("value"), F.col("_v")).alias("value"),
        F.col("_k.schema").alias("key_schema"),
        F.col("_v.schema").alias("value_schema"),
    )


def schema_log(rows: DataFrame) -> DataFrame:
    """The schema side of fingerprinted records, landed so that it is worked out once."""
    return landed(rows.select(*schema.LOG_COLUMNS), "schema_log")


def field_names(schema_json: Column) -> Column:
    return F.transform(F.from_json(schema_json, RECORD_SCHEMA)["fields"], lambda f: f["field"])


def evolved_rows(
    feed: DataFrame,
    key_fields: Sequence[Field],
    value_fields: Sequence[Field],
    options: Options,
) -> DataFrame:
    """Current rows of tables whose record schemas change over time.

    ``value_fields`` are all fields seen. A record sets the columns its schema
    names. Unless missing fields are allowed, a column that all partitions drop is
    lost: it counts only from the record that added it last, and is null here
    for tables whose last schemas lack it. Only then is the order of schema
    changes needed; else the distinct schemas are enough.
    """
    key_names = [f.name for f in key_fields]
    columns = [f for f in value_fields if f.name not in key_names]
    keys = ["table", *key_names]
    rows = schema.with_fingerprint(prepare(unwrap(feed), options))
    log = schema_log(rows)
    upserts = log.filter(F.col("fp").isNotNull())
    names = field_names(F.col("value_schema")).alias("names")
    known = attach(rows, schema.schema_texts(log).select("fp", names), ["fp"])
    if not options.allow_missing:
        texts = schema.schema_texts(log).select("fp", names)
        before = texts.select(F.col("fp").alias("previous_fp"), F.col("names").alias("previous"))
        moves = schema.moves(upserts.select("table", "partition", "offset", "fp"))
        moves = attach(attach(moves, texts, ["fp"]), before, ["previous_fp"])
        known = attach(known, schema.column_starts(moves), ["table"])
    known = records.drop_disabled_deletes(with_sound_key(known, key_fields, options), options)
    known = sound_values(known, columns, options)
    groups = fold.single_groups([f.name for f in columns])
    present = {}
    for group, (name,) in groups.items():
        counts = F.array_contains("names", name)
        if not options.allow_missing:
            start = F.col("starts")[name]
            counts = counts & (start["kept"] | (F.col("offset") >= start["at"][F.col("partition")]))
        if not options.null_overwrites:
            counts = counts & F.col(name).isNotNull()
        present[group] = F.coalesce(counts, F.lit(False))
    return fold.fold(known, keys, groups, present)
