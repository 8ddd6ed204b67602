"""Queries over record schemas and their changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.operators import schema
from feedfold.options import Options
from feedfold.plans import build, fixtures
from feedfold.plans.feed_queries import LOG
from feedfold.session import landed
from feedfold.sources.decode import schema_fields

PROFILE = "column_table"

_ROWS = f"""
{LOG}, rows AS (
  SELECT *, CASE WHEN ts < TIMESTAMP '{fixtures.EPOCH_STARTS[0]}' THEN 0
                 WHEN ts < TIMESTAMP '{fixtures.EPOCH_STARTS[1]}' THEN 1 ELSE 2 END AS era
  FROM log
), flagged AS (
  SELECT *, op = 'u' AND era IS DISTINCT FROM last_value(CASE WHEN op = 'u' THEN era END IGNORE NULLS) OVER (
      PARTITION BY table_name ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS changed
  FROM rows
), numbered AS (
  SELECT *, CAST(sum(CAST(changed AS INTEGER)) OVER (PARTITION BY table_name ORDER BY event_id) AS BIGINT) AS epoch
  FROM flagged
)"""


def _log_of(feed: DataFrame) -> DataFrame:
    return build.schema_log(schema.with_fingerprint(build.prepare(build.unwrap(feed), Options())))


def _log(spark: SparkSession, sf_dir: str, conflicts: bool = False) -> DataFrame:
    return _log_of(fixtures.schema_feed(spark, sf_dir, conflicts))


def change_point_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = schema.change_points(_log(spark, sf_dir))
    return points.select(
        F.col("table").alias("table_name"), "offset", schema.schema_report(F.col("value_schema")).alias("schema")
    )


_REPORTS = [
    "STRUCT row 1(user_id:INT64, k:INT32, event_type:STRING)",
    "STRUCT row 1(user_id:INT64, k:INT32, event_type:STRING, value:FLOAT64)",
    "STRUCT row 1(user_id:INT64, k:INT32, event_type:STRING, props:STRING/io.debezium.data.Json)",
]
CHANGE_POINTS = f"""
WITH {_ROWS}
SELECT table_name, event_id AS "offset",
       CASE era WHEN 0 THEN '{_REPORTS[0]}' WHEN 1 THEN '{_REPORTS[1]}' ELSE '{_REPORTS[2]}' END AS schema
FROM numbered WHERE changed"""


def epoch_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is written between two schema changes of a table."""
    rows = schema.with_epochs(_log(spark, sf_dir))
    return rows.groupBy(F.col("table").alias("table_name"), "epoch").agg(
        F.count("*").alias("records"),
        F.count_if(F.col("op") == "d").alias("deletes"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


EPOCH_SEGMENTS = f"""
WITH {_ROWS}
SELECT table_name, epoch, count(*) AS records, count(*) FILTER (WHERE op = 'd') AS deletes,
       min(event_id) AS first_offset, max(event_id) AS last_offset
FROM numbered GROUP BY 1, 2"""


def _fields_of(log: DataFrame, side: str = "value", by: tuple[str, ...] = ("table",)) -> DataFrame:
    """Fields of the key or value in each schema epoch, with column types."""
    changes = schema.numbered_changes(log)
    fields = schema_fields(changes.select(*by, "epoch", f"{side}_schema"), f"{side}_schema", *by, "epoch")
    return landed(schema.column_types(fields, PROFILE), "epoch_fields")


def _epoch_fields(spark: SparkSession, sf_dir: str, conflicts: bool) -> DataFrame:
    return _fields_of(_log(spark, sf_dir, conflicts))


def _diff(fields: DataFrame, allow_missing: bool, by: tuple[str, ...] = ("table",)) -> DataFrame:
    """Each epoch's fields against the table as the epochs before left it."""
    held = schema.previous_layout(fields, allow_missing, by)
    last = fields.groupBy(*by).agg(F.max("epoch").alias("_last"))
    diff = schema.schema_diff(fields, held, [*by, "epoch"])
    # The layout after the last epoch meets no further record.
    return diff.join(last, list(by)).filter((F.col("epoch") > 1) & (F.col("epoch") <= F.col("_last"))).drop("_last")


_FIELD_ROWS = """, shapes(era, field, kind) AS (VALUES
  (0, 'user_id', 'INT64'), (0, 'k', 'INT32'), (0, 'event_type', 'STRING'),
  (1, 'user_id', 'INT64'), (1, 'k', 'INT32'), (1, 'event_type', 'STRING'), (1, 'value', 'DOUBLE'),
  (2, 'user_id', 'INT64'), (2, 'k', 'INT32'), (2, 'event_type', 'STRING'), (2, 'props', 'STRING')
), fields AS (
  SELECT n.table_name, n.epoch, s.field,
         CASE WHEN {conflict} THEN 'INT64' ELSE s.kind END AS kind
  FROM numbered n JOIN shapes s USING (era) WHERE n.changed
)"""
_NO_CONFLICT = _FIELD_ROWS.format(conflict="FALSE")
_WITH_CONFLICT = _FIELD_ROWS.format(conflict="s.era = 2 AND s.field = 'k' AND n.user_id % 4 = 0")
_HELD_LAST = "held AS (SELECT table_name, epoch + 1 AS epoch, field, kind FROM fields)"
_HELD_ALL = """held AS (
  SELECT e.table_name, e.epoch, f.field, arg_min(f.kind, f.epoch) AS kind
  FROM (SELECT DISTINCT table_name, epoch FROM fields) e
  JOIN fields f ON f.table_name = e.table_name AND f.epoch < e.epoch
  GROUP BY 1, 2, 3
)"""


def _diff_sql(fields: str, held: str) -> str:
    return f"""
WITH {_ROWS} {fields}, {held}, diff AS (
  SELECT table_name, epoch, field, f.kind AS record_type, h.kind AS table_type,
         CASE WHEN f.kind IS NULL THEN 'dropped' WHEN h.kind IS NULL THEN 'new'
              WHEN f.kind = h.kind THEN 'same' ELSE 'type_conflict' END AS status
  FROM fields f FULL OUTER JOIN held h USING (table_name, epoch, field)
  WHERE epoch > 1 AND (table_name, epoch) IN (SELECT table_name, epoch FROM fields)
)"""


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("table", "table_name")


def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(_diff(_epoch_fields(spark, sf_dir, False), False))


SCHEMA_DIFF = _diff_sql(_NO_CONFLICT, _HELD_LAST) + " SELECT * FROM diff"


def needs_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under both settings of ``allow_missing``."""
    fields = _epoch_fields(spark, sf_dir, True)
    results = [
        schema.needs_change(_diff(fields, allowed), ["table", "epoch"], allowed).withColumn(
            "allow_missing", F.lit(allowed)
        )
        for allowed in (False, True)
    ]
    return _named(results[0].unionByName(results[1]))


_NEEDS = "bool_or(status = 'new'{extra}) AS needs_change, bool_or(status = 'type_conflict') AS conflict"
NEEDS_CHANGE = f"""
SELECT * FROM ({_diff_sql(_WITH_CONFLICT, _HELD_LAST)}
  SELECT table_name, epoch, FALSE AS allow_missing, {_NEEDS.format(extra=" OR status = 'dropped'")}
  FROM diff GROUP BY 1, 2)
UNION ALL
SELECT * FROM ({_diff_sql(_WITH_CONFLICT, _HELD_ALL)}
  SELECT table_name, epoch, TRUE AS allow_missing, {_NEEDS.format(extra="")}
  FROM diff GROUP BY 1, 2)"""


def needs_change_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a record's key asks for another table, under both settings of ``allow_missing``."""
    fields = _fields_of(_log_of(fixtures.key_schema_feed(spark, sf_dir)), "key")
    results = [
        schema.needs_change(_diff(fields, allowed), ["table", "epoch"], allowed).withColumn(
            "allow_missing", F.lit(allowed)
        )
        for allowed in (False, True)
    ]
    return _named(results[0].unionByName(results[1]))


_KEY_ROWS = """, shapes(era, field, kind) AS (VALUES
  (0, 'user_id', 'INT64'), (1, 'user_id', 'INT64'), (1, 'k', 'INT32'), (2, 'k', 'INT32')
), fields AS (
  SELECT n.table_name, n.epoch, s.field,
         CASE WHEN s.era = 2 AND n.user_id % 4 = 0 THEN 'INT64' ELSE s.kind END AS kind
  FROM numbered n JOIN shapes s USING (era) WHERE n.changed
)"""
NEEDS_CHANGE_KEYS = f"""
SELECT * FROM ({_diff_sql(_KEY_ROWS, _HELD_LAST)}
  SELECT table_name, epoch, FALSE AS allow_missing, {_NEEDS.format(extra=" OR status = 'dropped'")}
  FROM diff GROUP BY 1, 2)
UNION ALL
SELECT * FROM ({_diff_sql(_KEY_ROWS, _HELD_ALL)}
  SELECT table_name, epoch, TRUE AS allow_missing, {_NEEDS.format(extra="")}
  FROM diff GROUP BY 1, 2)"""


def partition_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epochs of two partitions that take turns, and whether the table's frontier has reached them."""
    rows = schema.with_frontier(schema.with_epochs(_log_of(fixtures.two_partition_feed(spark, sf_dir))))
    return rows.groupBy(F.col("table").alias("table_name"), "partition", "epoch").agg(
        F.count("*").alias("records"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.bool_and("settled").alias("settled"),
    )


_TURNS = f"""
{LOG}, dated AS (
  SELECT *, event_id % 2 AS part,
         ts - CASE WHEN event_id % 2 = 0 THEN INTERVAL 0 DAY ELSE INTERVAL {fixtures.PARTITION_LAG} DAY END AS moment
  FROM log
), rows AS (
  SELECT *, CASE WHEN moment < TIMESTAMP '{fixtures.EPOCH_STARTS[0]}' THEN 0
                 WHEN moment < TIMESTAMP '{fixtures.EPOCH_STARTS[1]}' OR part = 1 THEN 1 ELSE 2 END AS era
  FROM dated
), flagged AS (
  SELECT *, op = 'u' AND era IS DISTINCT FROM last_value(CASE WHEN op = 'u' THEN era END IGNORE NULLS) OVER (
      PARTITION BY table_name, part ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS changed
  FROM rows
), numbered AS (
  SELECT *, CAST(sum(CAST(changed AS INTEGER)) OVER (PARTITION BY table_name, part ORDER BY event_id) AS BIGINT) AS epoch
  FROM flagged
), ends AS (SELECT table_name, part, max(epoch) AS epoch FROM numbered GROUP BY 1, 2
), frontiers AS (SELECT table_name, min(epoch) AS frontier, max(epoch) AS ahead FROM ends GROUP BY 1)"""
PARTITION_EPOCHS = f"""
WITH {_TURNS}
SELECT table_name, CAST(part AS INTEGER) AS partition, epoch, count(*) AS records, min(event_id) AS first_offset,
       max(event_id) AS last_offset, bool_and(epoch <= frontier) AS settled
FROM numbered JOIN frontiers USING (table_name) GROUP BY 1, 2, 3"""


def epoch_frontiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every and any partition of a table is."""
    found = schema.epoch_vectors(schema.with_epochs(_log_of(fixtures.two_partition_feed(spark, sf_dir))))
    return found.select(
        F.col("table").alias("table_name"),
        F.array_join(F.transform(F.map_entries("vector"), lambda e: F.concat_ws(":", e["key"], e["value"])), ",").alias("vector"),
        "frontier", "ahead",
    )


EPOCH_FRONTIERS = f"""
WITH {_TURNS}
SELECT table_name, string_agg(part || ':' || epoch, ',' ORDER BY part) AS vector, any_value(frontier) AS frontier,
       any_value(ahead) AS ahead
FROM ends JOIN frontiers USING (table_name) GROUP BY 1"""


def partition_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each epoch of a partition against the one before it in that partition."""
    by = ("table", "partition")
    fields = _fields_of(_log_of(fixtures.two_partition_feed(spark, sf_dir)), "value", by)
    return _named(_diff(fields, False, by)).select("table_name", "partition", "epoch", "field", "status")


PARTITION_DIFF = f"""
WITH {_TURNS}, shapes(era, field) AS (VALUES
  (0, 'user_id'), (0, 'k'), (0, 'event_type'), (1, 'user_id'), (1, 'k'), (1, 'event_type'), (1, 'value'),
  (2, 'user_id'), (2, 'k'), (2, 'event_type'), (2, 'props')
), fields AS (SELECT table_name, part, epoch, field FROM numbered JOIN shapes USING (era) WHERE changed
), held AS (SELECT table_name, part, epoch + 1 AS epoch, field FROM fields)
SELECT table_name, CAST(part AS INTEGER) AS partition, epoch, field,
       CASE WHEN sent IS NULL THEN 'dropped' WHEN kept IS NULL THEN 'new' ELSE 'same' END AS status
FROM (SELECT *, field AS sent FROM fields) f FULL OUTER JOIN (SELECT *, field AS kept FROM held) h USING (table_name, part, epoch, field)
WHERE epoch > 1 AND (table_name, part, epoch) IN (SELECT table_name, part, epoch FROM fields)"""


def type_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(schema.type_conflicts(_diff(_epoch_fields(spark, sf_dir, True), True)))


TYPE_CONFLICTS = _diff_sql(_WITH_CONFLICT, _HELD_ALL) + " SELECT * FROM diff WHERE status = 'type_conflict'"


def create_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of each table as its first record creates it."""
    catalog = schema.schema_catalog(_log(spark, sf_dir))
    first = catalog.groupBy("table").agg(
        F.min_by("key_schema", "first_record").alias("key_schema"),
        F.min_by("value_schema", "first_record").alias("value_schema"),
    )
    sides = [
        schema_fields(first, f"{side}_schema", "table").withColumn("side", F.lit(side)) for side in ("key", "value")
    ]
    typed = schema.column_types(sides[0].unionByName(sides[1]), PROFILE)
    return _named(schema.create_layout(typed))


CREATE_LAYOUT = f"""
WITH {_ROWS} {_NO_CONFLICT}
SELECT table_name, field, kind AS column_type, field IN ('user_id', 'k') AS is_key,
       field NOT IN ('user_id', 'k') AS nullable,
       CAST(list_position(['user_id', 'k', 'event_type', 'value', 'props'], field) AS INTEGER) AS position
FROM fields WHERE epoch = 1 AND field <> 'props'
UNION ALL
SELECT table_name, field, kind, FALSE, TRUE, CAST(4 AS INTEGER) FROM fields WHERE epoch = 1 AND field = 'props'"""


def _evolved(spark: SparkSession, sf_dir: str, allow_missing: bool) -> DataFrame:
    feed = fixtures.schema_feed(spark, sf_dir)
    options = Options(allow_missing=allow_missing)
    return _named(build.evolved_rows(feed, fixtures.KEY_FIELDS, fixtures.VALUE_FIELDS, options))


def evolve_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing fields are allowed: columns are only ever added."""
    return _evolved(spark, sf_dir, True)


def evolve_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing fields drop their column, and its values are lost."""
    return _evolved(spark, sf_dir, False)


_EVOLVED = """
WITH {rows}, state AS (
  SELECT *, arg_max(op, event_id) OVER w AS last_op,
         coalesce(max(CASE WHEN op = 'd' THEN event_id END) OVER w, -1) AS last_del
  FROM numbered WINDOW w AS (PARTITION BY table_name, user_id, k)
), live AS (SELECT * FROM state WHERE last_op = 'u' AND op = 'u' AND event_id > last_del)
SELECT table_name, user_id, k, arg_max(event_type, event_id) AS event_type,
       {value} AS value,
       arg_max(props, event_id) FILTER (WHERE era = 2) AS props
FROM live GROUP BY 1, 2, 3"""
EVOLVE_ADD = _EVOLVED.format(rows=_ROWS, value="arg_max(value, event_id) FILTER (WHERE era = 1)")
# Every table ends with the last schema, which has no value column.
EVOLVE_DROP = _EVOLVED.format(
    rows=_ROWS,
    value="""arg_max(value, event_id) FILTER (WHERE era = 1 AND table_name NOT IN (
         SELECT table_name FROM rows WHERE op = 'u' AND era = 2))""",
)

QUERIES = {
    "schema_change_points": change_point_rows,
    "epoch_segments": epoch_segments,
    "schema_diff": schema_diff,
    "needs_change": needs_change,
    "needs_change_keys": needs_change_keys,
    "partition_epochs": partition_epochs,
    "epoch_frontiers": epoch_frontiers,
    "partition_diff": partition_diff,
    "type_conflicts": type_conflicts,
    "create_layout": create_layout,
    "evolve_add": evolve_add,
    "evolve_drop": evolve_drop,
}

SQL = {
    "schema_change_points": CHANGE_POINTS,
    "epoch_segments": EPOCH_SEGMENTS,
    "schema_diff": SCHEMA_DIFF,
    "needs_change": NEEDS_CHANGE,
    "needs_change_keys": NEEDS_CHANGE_KEYS,
    "partition_epochs": PARTITION_EPOCHS,
    "epoch_frontiers": EPOCH_FRONTIERS,
    "partition_diff": PARTITION_DIFF,
    "type_conflicts": TYPE_CONFLICTS,
    "create_layout": CREATE_LAYOUT,
    "evolve_add": EVOLVE_ADD,
    "evolve_drop": EVOLVE_DROP,
}
