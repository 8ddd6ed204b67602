"""Queries over feeds as they arrive: scan, route, decode, reject, count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.functions.convert import utc_wall_clock
from feedfold.operators import records
from feedfold.operators.bounded import attach
from feedfold.operators.ordered import flush_segments
from feedfold.operators.route import route
from feedfold.options import Options
from feedfold.plans import build, fixtures
from feedfold.sources.decode import after_image, after_text

PLAIN = Options()
POLL_ROWS = 500

# Start of every comparison query: the feed in terms of the event columns.
LOG = """
log AS (
  SELECT 'app_t_' || (user_id % 16) AS table_name, event_id, ts, user_id,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         event_type, value, props,
         CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op
  FROM events
)"""


def feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fixtures.flat_feed(spark, sf_dir)
    return feed.groupBy("topic").agg(
        F.count("*").alias("records"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count_if(F.col("value").isNull()).alias("tombstones"),
        utc_wall_clock(F.min("ts")).alias("first_ts"),
        utc_wall_clock(F.max("ts")).alias("last_ts"),
    )


FEED_SCAN = f"""
WITH {LOG}
SELECT 'app.t_' || (user_id % 16) AS topic, count(*) AS records, min(event_id) AS first_offset,
       max(event_id) AS last_offset, count(*) FILTER (WHERE op = 'd') AS tombstones,
       min(ts) AS first_ts, max(ts) AS last_ts
FROM log GROUP BY 1"""


def op_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = build.prepare(fixtures.flat_feed(spark, sf_dir), PLAIN)
    flagged = records.flag_leading_deletes(rows).withColumn("applied", ~F.col("leading"))
    poll = flagged.withColumn("batch", F.call_function("div", F.col("offset"), F.lit(POLL_ROWS)))
    return records.op_counts(poll.withColumnRenamed("table", "table_name"), "table_name", "batch").drop("rejected")


OP_COUNTS = f"""
WITH {LOG}, firsts AS (
  SELECT table_name, min(event_id) AS first_u FROM log WHERE op = 'u' GROUP BY 1
)
SELECT l.table_name, l.event_id // {POLL_ROWS} AS batch, l.op, count(*) AS received,
       count(*) FILTER (WHERE l.op = 'u' OR l.event_id > f.first_u) AS written
FROM log l LEFT JOIN firsts f USING (table_name) GROUP BY 1, 2, 3"""


def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = build.prepare(fixtures.flat_feed(spark, sf_dir), PLAIN).filter(F.col("op") == records.UPSERT)
    keyed = build.with_typed_key(rows, fixtures.KEY_FIELDS, PLAIN)
    typed = build.with_typed_value(keyed, fixtures.VALUE_FIELDS[2:], PLAIN)
    return typed.select("offset", "user_id", "k", "event_type", "value", "props")


DECODE_JSON = f"""
WITH {LOG}
SELECT event_id AS "offset", user_id, k, event_type, value, props FROM log WHERE op = 'u'"""


def _mixed_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of two databases; only one has the prefix to strip."""
    server = F.when(F.col("user_id") % 4 == 3, "db2.").otherwise("db1.")
    topic = F.concat(server, F.lit("App.T_"), F.col("user_id") % 16)
    return fixtures.flat_feed(spark, sf_dir, topic=topic)


def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = Options(profile="row_cache", topic_prefix="db1.", table_prefix="ods_")
    routed = route(_mixed_topics(spark, sf_dir), options)
    return routed.groupBy(F.col("table").alias("table_name")).agg(F.count("*").alias("records"))


ROUTE_COUNTS = """
SELECT CASE WHEN user_id % 4 = 3 THEN 'ods_db2_App_T_' ELSE 'ods_App_T_' END || (user_id % 16) AS table_name,
       count(*) AS records
FROM events GROUP BY 1"""


def route_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route(_mixed_topics(spark, sf_dir), Options(topic_prefix="db1.App."))
    return routed.groupBy(F.col("table").alias("table_name")).agg(F.count("*").alias("records"))


ROUTE_LOWER = """
SELECT CASE WHEN user_id % 4 = 3 THEN 'db2_app_t_' ELSE 't_' END || (user_id % 16) AS table_name,
       count(*) AS records
FROM events GROUP BY 1"""


def extract_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fixtures.envelope_feed(spark, sf_dir)
    row = after_image(F.col("value"), fixtures.VALUE_FIELDS)
    op = F.when(after_text(F.col("value")).isNull(), "d").otherwise("u")
    return feed.select("offset", op.alias("op"), row.alias("row")).select(
        "offset", "op", "row.user_id", "row.k", "row.event_type", "row.value"
    )


EXTRACT_AFTER = f"""
WITH {LOG}
SELECT event_id AS "offset", op, CASE WHEN op = 'u' THEN user_id END AS user_id,
       CASE WHEN op = 'u' THEN k END AS k, CASE WHEN op = 'u' THEN event_type END AS event_type,
       CASE WHEN op = 'u' THEN value END AS value
FROM log"""


def leading_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table per user; those of users that are customers of nation 0 exist already."""
    topic = F.concat(F.lit("app.u_"), F.col("user_id"))
    rows = build.prepare(fixtures.flat_feed(spark, sf_dir, topic=topic), PLAIN)
    existing = (
        fixtures.table(spark, sf_dir, "customer")
        .filter(F.col("c_nationkey") == 0)
        .select(F.concat(F.lit("app_u_"), F.col("c_custkey")).alias("table"))
    )
    flagged = records.flag_leading_deletes(rows, existing)
    return flagged.filter("leading").select(F.col("table").alias("table_name"), "offset", "key")


LEADING_DELETES = f"""
WITH {LOG}
SELECT 'app_u_' || user_id AS table_name, event_id AS "offset",
       '{{"user_id":' || user_id || ',"k":' || k || '}}' AS key
FROM log l
WHERE op = 'd'
  AND NOT EXISTS (SELECT 1 FROM log u WHERE u.user_id = l.user_id AND u.op = 'u' AND u.event_id < l.event_id)
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = l.user_id AND c.c_nationkey = 0)"""


def reject_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("event_type") != "signup", fixtures._text(*fixtures.KEYS))
    rows = build.prepare(fixtures.flat_feed(spark, sf_dir, key=key), PLAIN)
    flagged = records.split_rejects(rows, {"null_key": records.null_key(rows)})
    bad = records.rejected(flagged)
    return bad.select(F.col("table").alias("table_name"), "partition", "offset", "reason", "key")


REJECT_NULL_KEY = f"""
WITH {LOG}
SELECT table_name, CAST(0 AS INTEGER) AS partition, event_id AS "offset", 'null_key' AS reason,
       CAST(NULL AS VARCHAR) AS key
FROM log WHERE event_type = 'signup'"""


def reject_key_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes of every third key lack a key field, others have the fields in another order."""
    key = (
        F.when(fixtures.is_delete() & (F.col("k") % 3 == 0), fixtures._text("user_id"))
        .when(fixtures.is_delete(), fixtures._text("k", "user_id"))
        .otherwise(fixtures._text(*fixtures.KEYS))
    )
    rows = build.prepare(fixtures.flat_feed(spark, sf_dir, key=key), PLAIN)
    targets = (
        rows.filter(F.col("op") == records.UPSERT)
        .groupBy("table")
        .agg(F.min_by("key", "offset").alias("first_key"))
        .select("table", F.json_object_keys("first_key").alias("key_names"))
    )
    known = attach(rows, targets, ["table"])
    flagged = records.split_rejects(known, {"key_change": records.key_changed(F.json_object_keys("key"))})
    bad = records.rejected(flagged)
    return bad.select(F.col("table").alias("table_name"), "offset", "reason", "key")


REJECT_KEY_CHANGE = f"""
WITH {LOG}
SELECT table_name, event_id AS "offset", 'key_change' AS reason, '{{"user_id":' || user_id || '}}' AS key
FROM log WHERE op = 'd' AND k % 3 = 0"""


def partition_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases go to another topic partition, so keys with both kinds are spread."""
    other = F.when(F.col("event_type") == "purchase", 1).otherwise(0)
    rows = build.prepare(fixtures.flat_feed(spark, sf_dir, partition=other), PLAIN)
    keyed = build.with_typed_key(rows, fixtures.KEY_FIELDS, PLAIN)
    return records.spread_keys(keyed, fixtures.KEYS).withColumnRenamed("table", "table_name")


PARTITION_SPREAD = f"""
WITH {LOG}
SELECT table_name, user_id, k, count(DISTINCT event_type = 'purchase') AS places
FROM log GROUP BY 1, 2, 3 HAVING count(DISTINCT event_type = 'purchase') > 1"""


def flush_segment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write segments of the feed after leading deletes are dropped."""
    rows = build.prepare(fixtures.flat_feed(spark, sf_dir), PLAIN)
    applied = records.flag_leading_deletes(rows).filter(~F.col("leading"))
    cut = flush_segments(applied.select("partition", "offset", "op"), PLAIN.segment_rows, ["partition"])
    return cut.groupBy("segment").agg(
        F.count("*").alias("records"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count_if(F.col("op") == "d").alias("deletes"),
    )


FLUSH_SEGMENTS = f"""
WITH {LOG}, numbered AS (
  SELECT l.event_id, l.op, (row_number() OVER (ORDER BY l.event_id) - 1) // {PLAIN.segment_rows} AS segment
  FROM log l JOIN (SELECT table_name, min(event_id) AS first_u FROM log WHERE op = 'u' GROUP BY 1) f
    USING (table_name)
  WHERE l.op = 'u' OR l.event_id > f.first_u
)
SELECT segment, count(*) AS records, min(event_id) AS first_offset, max(event_id) AS last_offset,
       count(*) FILTER (WHERE op = 'd') AS deletes
FROM numbered GROUP BY 1"""


#: Short segments, so that each topic partition has several.
TOPIC_SEGMENT_ROWS = 20


def flush_topic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write segments of each topic partition; many topics share a partition number."""
    feed = fixtures.flat_feed(spark, sf_dir, partition=F.col("event_id") % 2)
    place = ["topic", "partition"]
    cut = flush_segments(feed.select(*place, "offset", F.col("value").isNull().alias("gone")), TOPIC_SEGMENT_ROWS, place)
    return cut.groupBy(*place, "segment").agg(
        F.count("*").alias("records"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count_if("gone").alias("deletes"),
    )


FLUSH_TOPIC_SEGMENTS = f"""
WITH {LOG}, numbered AS (
  SELECT *, CAST(event_id % 2 AS INTEGER) AS partition,
         (row_number() OVER (PARTITION BY user_id % 16, event_id % 2 ORDER BY event_id) - 1) // {TOPIC_SEGMENT_ROWS} AS segment
  FROM log
)
SELECT 'app.t_' || (user_id % 16) AS topic, partition, segment, count(*) AS records, min(event_id) AS first_offset,
       max(event_id) AS last_offset, count(*) FILTER (WHERE op = 'd') AS deletes
FROM numbered GROUP BY 1, 2, 3"""


def _bad_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return build.rows_and_rejects(fixtures.bad_feed(spark, sf_dir), fixtures.KEY_FIELDS, fixtures.VALUE_FIELDS, PLAIN)


def reject_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record that its table cannot take, and why."""
    _, bad, _ = _bad_split(spark, sf_dir)
    return bad.select(F.col("table").alias("table_name"), "partition", "offset", "reason")


_BAD = f"""
{LOG}, told AS (
  SELECT *, event_id % {fixtures.KINDS} AS kind, CASE event_id % {fixtures.KINDS}
    WHEN 0 THEN 'null_key' WHEN 1 THEN 'malformed_key' WHEN 2 THEN 'malformed_key' WHEN 3 THEN 'null_key'
    WHEN 4 THEN CASE WHEN op = 'd' THEN 'delete_key_change' ELSE 'cast_failed' END
    WHEN 5 THEN CASE WHEN op = 'd' THEN 'delete_key_change' END
    WHEN 6 THEN CASE WHEN op = 'u' THEN 'malformed_value' END
    WHEN 7 THEN CASE WHEN op = 'u' THEN 'cast_failed' END END AS reason
  FROM log
)"""
REJECT_MALFORMED = f"""
WITH {_BAD}
SELECT table_name, CAST(0 AS INTEGER) AS partition, event_id AS "offset", reason FROM told WHERE reason IS NOT NULL"""


def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records received, written and rejected."""
    _, _, counts = _bad_split(spark, sf_dir)
    return counts.withColumnRenamed("table", "table_name")


REJECT_COUNTS = f"""
WITH {_BAD}, firsts AS (
  SELECT table_name, min(event_id) AS first_u FROM told WHERE op = 'u' AND kind <> 0 GROUP BY 1
)
SELECT table_name, op, count(*) AS received,
       count(*) FILTER (WHERE reason IS NULL AND (op = 'u' OR event_id > first_u)) AS written,
       count(*) FILTER (WHERE reason IS NOT NULL) AS rejected
FROM told LEFT JOIN firsts USING (table_name) GROUP BY 1, 2"""


def rows_beside_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows of the same feed: bad records neither set nor delete anything."""
    rows, _, _ = _bad_split(spark, sf_dir)
    return rows.withColumnRenamed("table", "table_name")


ROWS_BESIDE_REJECTS = f"""
WITH {_BAD}
SELECT table_name, user_id, k, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, user_id, k ORDER BY event_id DESC) AS rn FROM told WHERE reason IS NULL
) WHERE rn = 1 AND op = 'u'"""


QUERIES = {
    "feed_scan": feed_scan,
    "op_counts": op_counts,
    "decode_json": decode_json,
    "route_counts": route_counts,
    "route_lower": route_lower,
    "extract_after": extract_after,
    "leading_deletes": leading_deletes,
    "reject_null_key": reject_null_key,
    "reject_key_change": reject_key_change,
    "partition_spread": partition_spread,
    "flush_segments": flush_segment_rows,
    "flush_topic_segments": flush_topic_segments,
    "reject_malformed": reject_malformed,
    "reject_counts": reject_counts,
    "rows_beside_rejects": rows_beside_rejects,
}

SQL = {
    "feed_scan": FEED_SCAN,
    "op_counts": OP_COUNTS,
    "decode_json": DECODE_JSON,
    "route_counts": ROUTE_COUNTS,
    "route_lower": ROUTE_LOWER,
    "extract_after": EXTRACT_AFTER,
    "leading_deletes": LEADING_DELETES,
    "reject_null_key": REJECT_NULL_KEY,
    "reject_key_change": REJECT_KEY_CHANGE,
    "partition_spread": PARTITION_SPREAD,
    "flush_segments": FLUSH_SEGMENTS,
    "flush_topic_segments": FLUSH_TOPIC_SEGMENTS,
    "reject_malformed": REJECT_MALFORMED,
    "reject_counts": REJECT_COUNTS,
    "rows_beside_rejects": ROWS_BESIDE_REJECTS,
}
