"""Queries over folded feeds: current rows under each write mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.functions.convert import Field
from feedfold.operators import fold, records
from feedfold.options import Options
from feedfold.plans import build, fixtures
from feedfold.plans.feed_queries import LOG

SNAPSHOT = "2024-01-21"
USER_KEY = [Field("user_id", "INT64")]
USER_VALUE = [Field("event_type", "STRING"), Field("value", "FLOAT64")]
USER_KEYS = ["table", "user_id"]


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("table", "table_name")


def _current(feed: DataFrame, options: Options) -> DataFrame:
    return _named(build.current_rows(feed, fixtures.KEY_FIELDS, fixtures.VALUE_FIELDS, options))


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _current(fixtures.flat_feed(spark, sf_dir), Options())


def _latest_sql(source: str) -> str:
    return f"""
SELECT table_name, user_id, k, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, user_id, k ORDER BY event_id DESC) AS rn FROM {source}
) WHERE rn = 1 AND op = 'u'"""


UPSERT_LATEST = f"WITH {LOG} {_latest_sql('log')}"


def delete_disabled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _current(fixtures.flat_feed(spark, sf_dir), Options(deletes=False))


DELETE_DISABLED = f"WITH {LOG}, kept AS (SELECT * FROM log WHERE op = 'u') {_latest_sql('kept')}"


def as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State as it was at a point in time."""
    feed = fixtures.flat_feed(spark, sf_dir)
    limit = fixtures._instant(F.lit(f"{SNAPSHOT} 00:00:00").cast("timestamp_ntz"))
    return _current(fold.as_of_time(feed, limit), Options())


AS_OF = f"""
WITH {LOG}, kept AS (SELECT * FROM log WHERE ts <= TIMESTAMP '{SNAPSHOT} 00:00:00')
{_latest_sql('kept')}"""


def _user_records(spark: SparkSession, sf_dir: str, options: Options) -> DataFrame:
    rows = build.prepare(fixtures.user_feed(spark, sf_dir), options)
    rows = build.with_typed_key(rows, USER_KEY, options)
    return build.with_typed_value(rows, USER_VALUE, options)


def delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the deletes, applied to stored rows; those of absent keys do nothing."""
    rows = build.prepare(fixtures.flat_feed(spark, sf_dir, key=fixtures._text("user_id")), Options())
    deletes = build.with_typed_key(rows.filter(F.col("op") == records.DELETE), USER_KEY, Options())
    stored = fixtures.stored_customers(spark, sf_dir)
    return _named(fold.delete_rows(stored, deletes, USER_KEYS))


DELETE_BY_KEY = """
SELECT 'app_t_' || (c_custkey % 16) AS table_name, c_custkey AS user_id, c_name AS name,
       c_mktsegment AS event_type, c_acctbal AS value
FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')"""


def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-row replacement: stored columns the record lacks become null."""
    options = Options(profile="row_cache")
    rows = build.with_typed_key(build.prepare(fixtures.user_feed(spark, sf_dir), options), USER_KEY, options)
    stored = fixtures.stored_customers(spark, sf_dir)
    last = fold.replace_rows(stored, rows, USER_KEYS, "value", "sent")
    typed = build.with_typed_value(last, USER_VALUE, options, payload="sent", prefix="new_")
    columns = [
        F.when(F.col("sent").isNotNull(), F.col(f"new_{f.name}")).otherwise(F.col("stored")[f.name]).alias(f.name)
        for f in USER_VALUE
    ]
    return _named(typed.select(*USER_KEYS, F.col("stored.name").alias("name"), *columns))


_USER_LOG = f"""
{LOG}, recs AS (
  SELECT table_name, user_id, event_id, op,
         CASE WHEN op = 'u' AND event_type <> 'click' THEN event_type END AS event_type,
         CASE WHEN op = 'u' AND event_type <> 'view' THEN value END AS value,
         event_type AS kind
  FROM log
), stored AS (
  SELECT 'app_t_' || (c_custkey % 16) AS table_name, c_custkey AS user_id, c_name AS name,
         c_mktsegment AS event_type, c_acctbal AS value
  FROM customer
)"""

UPSERT_REPLACE = f"""
WITH {_USER_LOG}, lasts AS (
  SELECT * FROM recs QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
)
SELECT table_name, user_id, CAST(NULL AS VARCHAR) AS name, event_type, value FROM lasts WHERE op = 'u'
UNION ALL
SELECT s.table_name, s.user_id, s.name, s.event_type, s.value
FROM stored s ANTI JOIN lasts l ON s.user_id = l.user_id"""


def _patched(spark: SparkSession, sf_dir: str, options: Options, present: dict, with_stored: bool) -> DataFrame:
    rows = _user_records(spark, sf_dir, options)
    if with_stored:
        groups = {"g_name": ["name"], "g_type": ["event_type"], "g_value": ["value"]}
        rows = rows.withColumn("name", F.lit(None).cast("string"))
        present = {"g_name": F.lit(False), **present}
        stored = fixtures.stored_customers(spark, sf_dir)
    else:
        groups = {"g_type": ["event_type"], "g_value": ["value"]}
        stored = None
    return _named(fold.fold(rows, USER_KEYS, groups, present, stored))


def column_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record sets the columns of its schema, null or not; stored others stay."""
    rows = _user_records(spark, sf_dir, Options()).withColumn("name", F.lit(None).cast("string"))
    groups = {"g_name": ["name"], "g_row": ["event_type", "value"]}
    stored = fixtures.stored_customers(spark, sf_dir)
    return _named(fold.fold(rows, USER_KEYS, groups, {"g_name": F.lit(False)}, stored))


# Latest record that counts for a column after the last delete, per key.
def _patch_sql(type_counts: str, value_counts: str, with_stored: bool) -> str:
    keys = """, keyed AS (
  SELECT table_name, user_id, coalesce(max(event_id) FILTER (WHERE op = 'd'), -1) AS last_del,
         arg_max(op, event_id) AS last_op
  FROM recs GROUP BY 1, 2
), picked AS (
  SELECT k.table_name, k.user_id, k.last_del, k.last_op,
         t.event_type, t.event_id AS type_at, v.value, v.event_id AS value_at
  FROM keyed k
  LEFT JOIN (
    SELECT r.user_id, arg_max(struct_pack(x := r.event_type), r.event_id).x AS event_type, max(r.event_id) AS event_id
    FROM recs r JOIN keyed q USING (user_id)
    WHERE r.op = 'u' AND r.event_id > q.last_del AND {t} GROUP BY 1
  ) t USING (user_id)
  LEFT JOIN (
    SELECT r.user_id, arg_max(struct_pack(x := r.value), r.event_id).x AS value, max(r.event_id) AS event_id
    FROM recs r JOIN keyed q USING (user_id)
    WHERE r.op = 'u' AND r.event_id > q.last_del AND {v} GROUP BY 1
  ) v USING (user_id)
)""".format(t=type_counts, v=value_counts)
    if not with_stored:
        return f"""
WITH {_USER_LOG} {keys}
SELECT table_name, user_id, event_type, value FROM picked WHERE last_op = 'u'"""
    return f"""
WITH {_USER_LOG} {keys}
SELECT coalesce(p.table_name, s.table_name) AS table_name, coalesce(p.user_id, s.user_id) AS user_id,
       CASE WHEN coalesce(p.last_del, -1) < 0 THEN s.name END AS name,
       CASE WHEN p.type_at IS NOT NULL THEN p.event_type
            WHEN coalesce(p.last_del, -1) < 0 THEN s.event_type END AS event_type,
       CASE WHEN p.value_at IS NOT NULL THEN p.value
            WHEN coalesce(p.last_del, -1) < 0 THEN s.value END AS value
FROM picked p FULL OUTER JOIN stored s ON p.user_id = s.user_id
WHERE p.last_op IS NULL OR p.last_op = 'u'"""


COLUMN_UPSERT = _patch_sql("TRUE", "TRUE", True)


def _field_sent() -> dict:
    """A record lacks the fields that are null in it."""
    return {"g_type": F.col("event_type").isNotNull(), "g_value": F.col("value").isNotNull()}


def patch_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields a record has replace stored ones, others stay; a delete removes the row."""
    return _patched(spark, sf_dir, Options(profile="row_cache", allow_missing=True), _field_sent(), True)


PATCH_MERGE = _patch_sql("r.kind <> 'click'", "r.kind <> 'view'", True)


def delete_reinsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row that is deleted and inserted again in one batch starts empty."""
    return _patched(spark, sf_dir, Options(profile="row_cache", allow_missing=True), _field_sent(), False)


DELETE_REINSERT = _patch_sql("r.kind <> 'click'", "r.kind <> 'view'", False)


def null_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls leave columns alone."""
    options = Options(null_overwrites=False)
    feed = fixtures.user_feed(spark, sf_dir)
    return _named(build.current_rows(feed, USER_KEY, USER_VALUE, options))


NULL_KEEP = _patch_sql("r.event_type IS NOT NULL", "r.value IS NOT NULL", False)


def null_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls are stored like other values."""
    return _named(build.current_rows(fixtures.user_feed(spark, sf_dir), USER_KEY, USER_VALUE, Options()))


NULL_OVERWRITE = f"""
WITH {_USER_LOG}
SELECT table_name, user_id, event_type, value FROM (
  SELECT * FROM recs QUALIFY row_number() OVER (PARTITION BY table_name, user_id ORDER BY event_id DESC) = 1
) WHERE op = 'u'"""


QUERIES = {
    "upsert_latest": upsert_latest,
    "delete_disabled": delete_disabled,
    "as_of": as_of,
    "delete_by_key": delete_by_key,
    "upsert_replace": upsert_replace,
    "column_upsert": column_upsert,
    "patch_merge": patch_merge,
    "delete_reinsert": delete_reinsert,
    "null_keep": null_keep,
    "null_overwrite": null_overwrite,
}

SQL = {
    "upsert_latest": UPSERT_LATEST,
    "delete_disabled": DELETE_DISABLED,
    "as_of": AS_OF,
    "delete_by_key": DELETE_BY_KEY,
    "upsert_replace": UPSERT_REPLACE,
    "column_upsert": COLUMN_UPSERT,
    "patch_merge": PATCH_MERGE,
    "delete_reinsert": DELETE_REINSERT,
    "null_keep": NULL_KEEP,
    "null_overwrite": NULL_OVERWRITE,
}
