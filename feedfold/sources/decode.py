"""Turning payload text or bytes into columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.functions.convert import Field, raw_schema

# Type names in a JSON record schema -> physical types.
JSON_SCHEMA_TYPES = {
    "int8": "INT8",
    "int16": "INT16",
    "int32": "INT32",
    "int64": "INT64",
    "float": "FLOAT32",
    "float32": "FLOAT32",
    "double": "FLOAT64",
    "float64": "FLOAT64",
    "boolean": "BOOLEAN",
    "string": "STRING",
    "bytes": "BYTES",
}

# Shape of the schema part of a self-describing JSON record.
_FIELD_SCHEMA = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("optional", T.BooleanType()),
        T.StructField("name", T.StringType()),
        T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
        T.StructField("fields", T.StringType()),
    ]
)
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("fields", T.ArrayType(_FIELD_SCHEMA)),
    ]
)

AVRO_HEADER_BYTES = 5


def physical_type(json_type: Column) -> Column:
    """Physical type name of a JSON schema type name."""
    pairs = [F.lit(part) for item in JSON_SCHEMA_TYPES.items() for part in item]
    return F.coalesce(F.create_map(*pairs)[json_type], F.upper(json_type))


def decode_json(text: Column, fields: list[Field], corrupt: str | None = None) -> Column:
    """JSON text as a struct of raw values; text that is no object gives null values.

    ``corrupt`` names a further field that keeps the text where it, or a value
    in it, does not fit; such a value alone is null.
    """
    target = raw_schema(fields)
    options = {"mode": "PERMISSIVE"}
    if corrupt is not None:
        target = target.add(corrupt, T.StringType())
        options["columnNameOfCorruptRecord"] = corrupt
    return F.from_json(text, target, options)


def split_described(record: Column) -> Column:
    """Schema and payload texts of a self-describing record, in one pass over it."""
    return F.from_json(record, "schema string, payload string")


def payload_or_text(record: Column, parts: Column) -> Column:
    """Payload of a split record; the whole text where it does not describe itself.

    A payload that is there and null stays null, for that is a delete; text
    without any payload must not be taken for one.
    """
    stray = parts["schema"].isNull() & parts["payload"].isNull() & ~_has_name(record, "payload")
    return F.when(stray, record).otherwise(parts["payload"])


def _has_name(text: Column, name: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(text), name), F.lit(False))


def looks_like_object(text: Column) -> Column:
    """Cheap test that rules out JSON values other than objects."""
    return F.startswith(F.ltrim(text), F.lit("{"))


def lacks_after(text: Column) -> Column:
    """Whether text is there but is no before/after envelope; keys are only read without an ``after``."""
    return text.isNotNull() & after_text(text).isNull() & ~_has_name(text, "after")


def after_image(text: Column, fields: list[Field]) -> Column:
    """Row part of a before/after envelope; null where the row was deleted."""
    envelope = T.StructType([T.StructField("after", raw_schema(fields))])
    return F.from_json(text, envelope)["after"]


def after_text(text: Column) -> Column:
    """Row part of a before/after envelope as text; null where the row was deleted."""
    return F.get_json_object(text, "$.after")


def schema_fields(schemas: DataFrame, schema_column: str, *carry: str) -> DataFrame:
    """One row per field of each record schema: ``pos, field, physical, logical, params``."""
    parsed = schemas.select(
        *carry, F.posexplode(F.from_json(schema_column, RECORD_SCHEMA)["fields"]).alias("pos", "_f")
    )
    return parsed.select(
        *carry,
        "pos",
        F.col("_f.field").alias("field"),
        physical_type(F.col("_f.type")).alias("physical"),
        F.col("_f.name").alias("logical"),
        F.col("_f.parameters").alias("params"),
    )


def registry_id(binary: Column) -> Column:
    """Schema number in the header of registry-framed bytes (a zero byte, then four of the number); null without one."""
    framed = (F.substring(binary, 1, 1) == F.lit(b"\x00")) & (F.octet_length(binary) >= AVRO_HEADER_BYTES)
    return F.when(framed, F.conv(F.hex(F.substring(binary, 2, 4)), 16, 10).cast("long"))


def decode_avro(binary: Column, schema_json: str) -> Column:
    """Avro bytes behind a five-byte registry header, null without one; needs Spark's Avro package."""
    from pyspark.sql.avro.functions import from_avro

    body = F.when(registry_id(binary).isNotNull(), F.substring(binary, AVRO_HEADER_BYTES + 1, 2_147_483_647))
    return from_avro(body, schema_json, {"mode": "PERMISSIVE"})


def avro_text(binary: Column, schemas: Mapping[int, str]) -> Column:
    """Avro bytes as JSON text, each record by the schema that its header names; bytes of no known schema give ``{``.

    That is text which is there and is no object, so such a record is rejected rather than taken for a delete.
    """
    number = registry_id(binary)
    known = [
        F.when(number == at, F.to_json(decode_avro(binary, schema), {"ignoreNullFields": "false"}))
        for at, schema in schemas.items()
    ]
    return F.when(binary.isNotNull(), F.coalesce(*known, F.lit("{")))


def avro_feed_as_text(feed: DataFrame, key_schemas: Mapping[int, str], value_schemas: Mapping[int, str]) -> DataFrame:
    """A feed with Avro keys and values as one with JSON text, for the later steps; schemas by registry number."""
    others = [c for c in feed.columns if c not in ("key", "value")]
    return feed.select(
        *others, avro_text(F.col("key"), key_schemas).alias("key"), avro_text(F.col("value"), value_schemas).alias("value")
    )
