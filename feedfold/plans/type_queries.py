"""Queries over field types and typed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.functions import rules, temporal
from feedfold.functions.convert import Field, utc_wall_clock
from feedfold.options import Options
from feedfold.plans import build, fixtures

_values = lambda items: "[" + ", ".join("NULL" if i is None else f"'{i}'" for i in items) + "]"

FIELD_ROWS = f"""
field_rows AS (
  SELECT 't_' || (o_custkey % 16) AS table_name, 'c_' || o_orderkey AS field,
         ({_values(fixtures.PHYSICAL_TYPES)})[o_orderkey % {len(fixtures.PHYSICAL_TYPES)} + 1] AS physical,
         ({_values(fixtures.LOGICAL_NAMES)})[o_custkey % {len(fixtures.LOGICAL_NAMES)} + 1] AS logical,
         CASE WHEN o_orderpriority LIKE '5%' THEN o_orderpriority
              WHEN o_orderpriority NOT LIKE '4%' THEN CAST(o_custkey % 20 + 10 AS VARCHAR) END AS p,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 8 AS VARCHAR) END AS s
  FROM orders
)"""

# The rules once more, in SQL's terms, so that a slip in the code's tables shows.
_RULE_ROWS = """
  ('INT8', NULL, 'TINYINT'), ('INT16', NULL, 'SHORT'), ('INT32', NULL, 'INT'), ('INT64', NULL, 'LONG'),
  ('FLOAT32', NULL, 'FLOAT'), ('FLOAT64', NULL, 'DOUBLE'), ('BOOLEAN', NULL, 'BOOLEAN'), ('STRING', NULL, 'STRING'),
  ('BYTES', NULL, 'BYTES'), ('BYTES', 'org.apache.kafka.connect.data.Decimal', 'DECIMAL'),
  ('INT32', 'org.apache.kafka.connect.data.Date', 'DATE'), ('INT32', 'io.debezium.time.Date', 'DATE'),
  ('INT64', 'org.apache.kafka.connect.data.Timestamp', 'TIMESTAMP'), ('INT64', 'io.debezium.time.Timestamp', 'TIMESTAMP'),
  ('STRING', 'io.debezium.time.ZonedTimestamp', 'TIMESTAMP'), ('INT64', 'io.debezium.time.MicroTimestamp', 'TIMESTAMP'),
  ('INT32', 'org.apache.kafka.connect.data.Time', 'TIME'), ('INT64', 'io.debezium.time.MicroTime', 'TIME'),
  ('INT32', 'io.debezium.time.Year', 'INT'), ('BYTES', 'io.debezium.data.Bits', 'BYTES'),
  ('STRING', 'io.debezium.data.Enum', 'STRING'), ('STRING', 'io.debezium.data.EnumSet', 'STRING'),
  ('STRING', 'io.debezium.data.Json', 'STRING')"""
_COLUMN_ROWS = """
  SELECT 'column_table', internal, a FROM kinds UNION ALL
  SELECT 'row_cache', internal, internal FROM kinds UNION ALL
  SELECT 'lake', internal, b FROM kinds"""
_KINDS = """kinds(internal, a, b) AS (VALUES
  ('TINYINT', 'INT8', 'Byte'), ('SHORT', 'INT16', 'Short'), ('INT', 'INT32', 'Integer'), ('LONG', 'INT64', 'Long'),
  ('FLOAT', 'FLOAT', 'Float'), ('DOUBLE', 'DOUBLE', 'Double'), ('BOOLEAN', 'BOOL', 'Boolean'), ('STRING', 'STRING', 'String'),
  ('BYTES', 'BINARY', 'byte[]'), ('DECIMAL', 'DECIMAL', 'BigDecimal'), ('DATE', 'STRING', 'String'), ('TIME', 'STRING', 'String'),
  ('TIMESTAMP', 'UNIXTIME_MICROS', 'String'))"""
_RESOLVED = f"""
WITH {FIELD_ROWS}, rules(physical, logical, internal) AS (VALUES {_RULE_ROWS}), resolved AS (
  SELECT f.*, coalesce(r.internal, 'OTHER') AS internal
  FROM field_rows f LEFT JOIN rules r
    ON f.physical = r.physical AND f.logical IS NOT DISTINCT FROM r.logical
)"""


def resolve_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = rules.resolve_types(fixtures.field_rows(spark, sf_dir))
    return resolved.groupBy("physical", "logical", "internal").agg(F.count("*").alias("fields"))


RESOLVE_TYPES = f"{_RESOLVED} SELECT physical, logical, internal, count(*) AS fields FROM resolved GROUP BY 1, 2, 3"


def target_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column types of every field under each profile."""
    resolved = rules.resolve_types(fixtures.field_rows(spark, sf_dir))
    known = resolved.filter(F.col("internal") != rules.OTHER)
    typed = known.join(F.broadcast(rules.column_type_rules(spark)), "internal")
    return typed.groupBy("profile", "internal", "column_type").agg(F.count("*").alias("fields"))


TARGET_TYPES = f"""{_RESOLVED}, {_KINDS}, columns(profile, internal, column_type) AS ({_COLUMN_ROWS})
SELECT c.profile, r.internal, c.column_type, count(*) AS fields
FROM resolved r JOIN columns c USING (internal) GROUP BY 1, 2, 3"""


def reject_unsupported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields without a column type."""
    from feedfold.operators.records import unsupported_fields

    bad = unsupported_fields(fixtures.field_rows(spark, sf_dir))
    return bad.select(
        F.col("table").alias("table_name"), "field", "physical", "logical", F.lit("unsupported_type").alias("reason")
    )


REJECT_UNSUPPORTED = f"""{_RESOLVED}
SELECT table_name, field, physical, logical, 'unsupported_type' AS reason FROM resolved WHERE internal = 'OTHER'"""


def decimal_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = rules.decimal_attributes(fixtures.field_rows(spark, sf_dir))
    return sized.groupBy("precision", "scale").agg(F.count("*").alias("fields"))


DECIMAL_ATTRS = f"""
WITH {FIELD_ROWS}
SELECT coalesce(TRY_CAST(p AS INTEGER), 20) AS precision, coalesce(TRY_CAST(s AS INTEGER), 4) AS scale,
       count(*) AS fields
FROM field_rows GROUP BY 1, 2"""


TYPED_FIELDS = [
    Field("tiny", "INT8"),
    Field("small", "INT16"),
    Field("cust", "INT32"),
    Field("order_id", "INT64"),
    Field("eighths", "FLOAT32"),
    Field("price", "FLOAT64"),
    Field("final", "BOOLEAN"),
    Field("priority", "STRING"),
    Field("raw", "BYTES"),
    Field("amount", "BYTES", rules.CONNECT_DECIMAL, {"connect.decimal.precision": "18", "scale": "2"}),
    Field("day", "INT32", rules.CONNECT_DATE),
    Field("day2", "INT32", rules.DEBEZIUM_DATE),
    Field("at_ms", "INT64", rules.CONNECT_TIMESTAMP),
    Field("at_ms2", "INT64", rules.DEBEZIUM_TIMESTAMP),
    Field("at_iso", "STRING", rules.DEBEZIUM_ZONED_TIMESTAMP),
    Field("at_us", "INT64", rules.DEBEZIUM_MICRO_TIMESTAMP),
    Field("clock_ms", "INT32", rules.CONNECT_TIME),
    Field("clock_us", "INT64", rules.DEBEZIUM_MICRO_TIME),
    Field("year", "INT32", rules.DEBEZIUM_YEAR),
    Field("bits", "BYTES", rules.DEBEZIUM_BITS),
    Field("status", "STRING", rules.DEBEZIUM_ENUM),
    Field("statuses", "STRING", rules.DEBEZIUM_ENUM_SET),
    Field("doc", "STRING", rules.DEBEZIUM_JSON),
]


def _micros(wall: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, wall)


def _encoded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON payloads in the physical forms a feed carries.

    Each order's moment is its date plus a number of microseconds; moments of
    status ``F`` orders are mirrored to before 1970.
    """
    key = F.col("o_orderkey")
    spread = _micros(F.col("o_orderdate")) + key * 7_919_317
    micros = F.when(F.col("o_orderstatus") == "F", -spread).otherwise(spread)
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    cents = F.when(F.col("o_orderstatus") == "O", -cents).otherwise(cents)
    hex_cents = F.hex(cents)
    packed = F.base64(F.unhex(F.when(cents < 0, hex_cents).otherwise(F.lpad(hex_cents, 16, "0"))))
    millis = F.call_function("div", micros, F.lit(1000))
    of_day = F.pmod(micros, F.lit(86_400_000_000))
    iso = F.concat(F.replace(utc_wall_clock(F.timestamp_micros(F.abs(micros))).cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    columns = {
        "tiny": key % 128,
        "small": F.col("o_custkey") % 30000,
        "cust": F.col("o_custkey"),
        "order_id": key,
        "eighths": (key % 1000) / 8,
        "price": F.col("o_totalprice"),
        "final": F.col("o_orderstatus") == "F",
        "priority": F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")),
        "raw": F.base64(F.encode("o_orderpriority", "UTF-8")),
        "amount": packed,
        "day": F.unix_date(F.col("o_orderdate").cast("date")),
        "day2": -F.unix_date(F.col("o_orderdate").cast("date")),
        "at_ms": millis,
        "at_ms2": millis,
        "at_iso": iso,
        "at_us": micros,
        "clock_ms": F.call_function("div", of_day, F.lit(1000)),
        "clock_us": of_day,
        "year": F.year("o_orderdate"),
        "bits": F.base64(F.unhex(F.lpad(F.hex(key % 256), 2, "0"))),
        "status": F.col("o_orderstatus"),
        "statuses": F.concat_ws(",", "o_orderstatus", F.substring("o_orderpriority", 1, 1)),
        "doc": F.to_json(F.struct("o_orderstatus")),
    }
    return table_orders(spark, sf_dir).select(
        fixtures._text(*[c.alias(name) for name, c in columns.items()]).alias("value")
    )


def table_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, "orders")


def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversion at once; instants are shown as UTC wall clocks, bytes as hex text."""
    typed = build.with_typed_value(_encoded_orders(spark, sf_dir), TYPED_FIELDS, Options())
    shown = []
    for f in TYPED_FIELDS:
        kind = f.column_type("column_table").simpleString()
        column = F.col(f.name)
        if kind == "timestamp":
            column = utc_wall_clock(column)
        elif kind == "binary":
            column = F.hex(column)
        shown.append(column.alias(f.name))
    return typed.select(*shown, F.size("failed").cast("bigint").alias("failures"))


TYPED_PROJECTION = """
WITH base AS (
  SELECT *, CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END * (epoch_us(o_orderdate) + o_orderkey * 7919317) AS us
  FROM orders
)
SELECT CAST(o_orderkey % 128 AS TINYINT) AS tiny, CAST(o_custkey % 30000 AS SMALLINT) AS small,
       CAST(o_custkey AS INTEGER) AS cust, o_orderkey AS order_id,
       CAST((o_orderkey % 1000) / 8.0 AS FLOAT) AS eighths, o_totalprice AS price,
       o_orderstatus = 'F' AS final,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority,
       hex(encode(o_orderpriority)) AS raw,
       CAST(CASE WHEN o_orderstatus = 'O' THEN -1 ELSE 1 END * CAST(o_totalprice AS DECIMAL(18, 2)) AS DECIMAL(18, 2)) AS amount,
       strftime(o_orderdate, '%Y-%m-%d') AS day,
       strftime(DATE '1970-01-01' - CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER), '%Y-%m-%d') AS day2,
       make_timestamp(CAST(trunc(us / 1000.0) AS BIGINT) * 1000) - INTERVAL 8 HOUR AS at_ms,
       make_timestamp(CAST(trunc(us / 1000.0) AS BIGINT) * 1000) - INTERVAL 8 HOUR AS at_ms2,
       date_trunc('millisecond', make_timestamp(abs(us))) AS at_iso,
       make_timestamp(CAST(trunc(us / 1000.0) AS BIGINT) * 1000) AS at_us,
       strftime(make_timestamp(us), '%H:%M:%S') AS clock_ms,
       strftime(make_timestamp(us), '%H:%M:%S') AS clock_us,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       lpad(upper(to_hex(o_orderkey % 256)), 2, '0') AS bits,
       o_orderstatus AS status, o_orderstatus || ',' || substr(o_orderpriority, 1, 1) AS statuses,
       '{"o_orderstatus":"' || o_orderstatus || '"}' AS doc, CAST(0 AS BIGINT) AS failures
FROM base"""


ZONE = "Asia/Shanghai"


def temporal_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as text and numbers in a zone, and back."""
    instant = fixtures._instant(F.col("ts"))
    texts = fixtures.table(spark, sf_dir, "events").select(
        "event_id",
        temporal.date_text(instant, ZONE).alias("date_text"),
        temporal.time_text(instant, ZONE).alias("time_text"),
        temporal.timestamp_text(instant, ZONE).alias("timestamp_text"),
        temporal.epoch_nanos(instant).alias("nanos"),
        temporal.epoch_nanos_text(instant).alias("nanos_text"),
        temporal.iso_text(instant, ZONE).alias("iso_text"),
    )
    return texts.select(
        "*",
        utc_wall_clock(temporal.from_epoch_nanos(F.col("nanos"))).alias("from_nanos"),
        utc_wall_clock(temporal.from_epoch_nanos(F.col("nanos_text"))).alias("from_nanos_text"),
        utc_wall_clock(temporal.from_iso_text(F.col("iso_text"), ZONE)).alias("from_iso"),
    )


TEMPORAL_NORMALISE = """
WITH local AS (SELECT event_id, ts, ts + INTERVAL 8 HOUR AS wall FROM events)
SELECT event_id, strftime(wall, '%Y-%m-%d') AS date_text, strftime(wall, '%H:%M:%S.%g') AS time_text,
       strftime(wall, '%Y-%m-%d %H:%M:%S.%g') AS timestamp_text,
       epoch_us(ts) * 1000 AS nanos, CAST(epoch_us(ts) * 1000 AS VARCHAR) AS nanos_text,
       strftime(wall, '%Y-%m-%dT%H:%M:%S.%f') || '000' AS iso_text,
       ts AS from_nanos, ts AS from_nanos_text, ts AS from_iso
FROM local"""


QUERIES = {
    "resolve_types": resolve_types,
    "target_types": target_types,
    "reject_unsupported": reject_unsupported,
    "decimal_attrs": decimal_attrs,
    "typed_projection": typed_projection,
    "temporal_normalise": temporal_normalise,
}

SQL = {
    "resolve_types": RESOLVE_TYPES,
    "target_types": TARGET_TYPES,
    "reject_unsupported": REJECT_UNSUPPORTED,
    "decimal_attrs": DECIMAL_ATTRS,
    "typed_projection": TYPED_PROJECTION,
    "temporal_normalise": TEMPORAL_NORMALISE,
}
