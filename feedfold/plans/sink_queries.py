"""Queries that write: streaming application, lake files, buckets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.functions.convert import utc_wall_clock
from feedfold.operators.layout import Layout
from feedfold.options import Options
from feedfold.plans import build, feed_queries, fixtures, fold_queries, schema_queries
from feedfold.plans.feed_queries import LOG
from feedfold.session import scratch_path
from feedfold.sinks import buckets, lake
from feedfold.sinks.store import Catalog, TableStore
from feedfold.sources.feed import FEED_SCHEMA, read_feed, stream_feed
from feedfold.streaming.apply import FeedSink
from feedfold.streaming.merge import RowMerger

# The feed lands in slices that are cut at the start of these days; the first and the last are open.
LANDINGS = ["2024-01-09", "2024-01-16", "2024-01-24"]


def _slices(feed: DataFrame) -> list[DataFrame]:
    at = [fixtures._instant(F.lit(f"{day} 00:00:00").cast("timestamp_ntz")) for day in LANDINGS]
    inside = [(F.col("ts") >= start) & (F.col("ts") < end) for start, end in zip(at, at[1:], strict=False)]
    first = F.col("ts").isNull() | (F.col("ts") < at[0])
    return [feed.filter(test) for test in (first, *inside, F.col("ts") >= at[-1])]


def _land(rows: DataFrame, path: str) -> None:
    rows.select(FEED_SCHEMA.names).write.mode("append").parquet(path)


def stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with changing schemas, applied as it lands, with a compaction on the way."""
    root = scratch_path(spark, "stream_apply")
    store = TableStore(spark, f"{root}/tables", Options(allow_missing=True))
    sink = FeedSink(store)
    for number, rows in enumerate(_slices(fixtures.schema_feed(spark, sf_dir, dealt=True))):
        _land(rows, f"{root}/feed")
        sink.start(stream_feed(spark, f"{root}/feed"), f"{root}/checkpoint").awaitTermination()
        if number == 1:
            store.compact()
    names = ["table", *fixtures.KEYS, "event_type", "value", "props"]
    frames = [
        reduce(
            lambda rows, c: rows if c in rows.columns else rows.withColumn(c, F.lit(None).cast("string")), names, f
        ).select(names)
        for f in store.current_all().values()
    ]
    return reduce(DataFrame.unionByName, frames).withColumnRenamed("table", "table_name")


def _all_rows(store: TableStore, columns: list[str]) -> DataFrame:
    rows = [frame.select("table", *columns) for frame in store.current_all().values()]
    return reduce(DataFrame.unionByName, rows).withColumnRenamed("table", "table_name")


def evolve_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table keeps its column types while the records' fields change form; what does not fit is rejected."""
    options = Options(source_utc_offset_hours=0, decimal_format="numeric")
    store = TableStore(spark, scratch_path(spark, "evolve_types"), options)
    sink = FeedSink(store)
    for batch, rows in enumerate(_slices(fixtures.form_feed(spark, sf_dir))):
        sink.apply(rows, batch)
    rows = _all_rows(store, ["user_id", "amount", "at", "day"])
    return rows.withColumn("at", utc_wall_clock(F.col("at")))


EVOLVE_TYPES = f"""
WITH {LOG}, told AS (
  SELECT *, op = 'u' AND ts >= TIMESTAMP '{fixtures.EPOCH_STARTS[1]} 00:00:00' AND event_id % 4 = 0 AS bad FROM log
), last AS (
  SELECT *, row_number() OVER (PARTITION BY table_name, user_id ORDER BY event_id DESC) AS rn FROM told WHERE NOT bad
)
SELECT table_name, user_id, CAST(CAST(floor(value * 100) AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(2, 2)) AS DECIMAL(20, 2)) AS amount,
       date_trunc('milliseconds', ts) AS "at", strftime(ts, '%Y-%m-%d') AS day
FROM last WHERE rn = 1 AND op = 'u'"""


class _Interrupted(OSError):
    """A run that ends between writing a batch and committing it."""


class _InterruptedStore(TableStore):
    """A store whose every commit fails once."""

    failed: int = -1

    def commit(self, catalog: Catalog) -> Catalog:
        if catalog.last_batch > self.failed:
            self.failed = catalog.last_batch
            raise _Interrupted
        return super().commit(catalog)


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch is lost once after its data were written, and applied again; then once more after its commit."""
    schemas = {f"app_t_{n}": (fixtures.KEY_FIELDS, fixtures.VALUE_FIELDS[2:]) for n in range(16)}
    store = _InterruptedStore(spark, scratch_path(spark, "stream_replay"), Options())
    sink = FeedSink(store, schemas)
    for batch, rows in enumerate(_slices(fixtures.bad_feed(spark, sf_dir, dealt=True))):
        try:
            sink.apply(rows, batch)
        except _Interrupted:
            sink.apply(rows, batch)
        sink.apply(rows, batch)
    rejected = spark.read.parquet(f"{store.root}/rejects").groupBy("table").agg(F.count("*").alias("rejects"))
    counted = spark.read.parquet(f"{store.root}/counts").groupBy("table").agg(F.sum("rejected").alias("counted"))
    rows = _all_rows(store, [*fixtures.KEYS, "event_type", "value", "props"]).withColumnRenamed("table_name", "table")
    known = rows.join(rejected, "table", "left").join(counted, "table", "left")
    return known.withColumnRenamed("table", "table_name")


STREAM_REPLAY = f"""
WITH live AS ({feed_queries.ROWS_BESIDE_REJECTS}), bad AS ({feed_queries.REJECT_MALFORMED}),
rejected AS (SELECT table_name, count(*) AS rejects FROM bad GROUP BY 1)
SELECT live.*, rejects, rejects AS counted FROM live LEFT JOIN rejected USING (table_name)"""


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a feed with bad records, as the store keeps them after applying it in slices."""
    schemas = {f"app_t_{n}": (fixtures.KEY_FIELDS, fixtures.VALUE_FIELDS) for n in range(16)}
    store = TableStore(spark, scratch_path(spark, "stream_rejects"), Options())
    sink = FeedSink(store, schemas)
    for batch, rows in enumerate(_slices(fixtures.bad_feed(spark, sf_dir, dealt=True))):
        sink.apply(rows, batch)
    counts = spark.read.parquet(f"{store.root}/counts")
    return counts.groupBy(F.col("table").alias("table_name"), "op").agg(
        *[F.sum(c).alias(c) for c in ("received", "written", "rejected")]
    )


def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patch merge that gives out the changed rows of each batch; the last output of a key is its row."""
    root = scratch_path(spark, "stream_merge")
    options = Options(profile="row_cache", allow_missing=True)
    store = TableStore(spark, f"{root}/rows", options)

    def keep(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{root}/merged/batch={batch}")

    merger = RowMerger(store, fold_queries.USER_KEY, fold_queries.USER_VALUE, keep)
    for number, rows in enumerate(_slices(fixtures.user_feed(spark, sf_dir))):
        _land(rows, f"{root}/feed")
        records = build.prepare(stream_feed(spark, f"{root}/feed"), options)
        records = build.with_typed_key(records, fold_queries.USER_KEY, options)
        records = build.with_typed_value(records, fold_queries.USER_VALUE, options)
        merger.start(records, f"{root}/checkpoint").awaitTermination()
        if number == 1:
            store.compact()
    outputs = spark.read.parquet(f"{root}/merged")
    last = outputs.groupBy(*fold_queries.USER_KEYS).agg(
        F.max_by(F.struct("alive", "event_type", "value"), F.struct("partition", "offset")).alias("_last")
    )
    rows = last.filter("_last.alive").select(*fold_queries.USER_KEYS, "_last.event_type", "_last.value")
    return rows.withColumnRenamed("table", "table_name")


def feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed landed as files and read back as a batch, counted by table and operation."""
    path = scratch_path(spark, "feed_files")
    _land(fixtures.flat_feed(spark, sf_dir), path)
    rows = build.prepare(read_feed(spark, path), Options())
    return rows.groupBy(F.col("table").alias("table_name"), "op").agg(
        F.count("*").alias("records"), F.max("offset").alias("last_offset")
    )


FEED_FILES = f"WITH {LOG} SELECT table_name, op, count(*) AS records, max(event_id) AS last_offset FROM log GROUP BY 1, 2"


def lake_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows written as lake files in two formats; rows that both hold."""
    rows = fold_queries.upsert_latest(spark, sf_dir).withColumnRenamed("table_name", "table")
    path = scratch_path(spark, "lake_write")
    found = []
    for kind in ("parquet", "orc"):
        options = Options(profile="lake", lake_format=kind)
        source = rows if not found else found[0]
        lake.write_lake(source, f"{path}/{kind}", options)
        found.append(lake.read_lake(rows, f"{path}/{kind}", options))
    return found[1].select(rows.columns).withColumnRenamed("table", "table_name")


def lake_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows written with keys marked as non-null and read by their fields; how Spark knows the keys."""
    rows = fold_queries.upsert_latest(spark, sf_dir).withColumnRenamed("table_name", "table")
    path, options = scratch_path(spark, "lake_keys"), Options(profile="lake", lake_format="parquet")
    lake.write_lake(rows, path, options, keys=fixtures.KEYS)
    back = lake.read_lake_fields(spark, path, fixtures.VALUE_FIELDS, fixtures.KEYS, options)
    nullable = [f.name for f in back.schema if f.nullable]
    return back.withColumn("nullable", F.lit(",".join(nullable))).withColumnRenamed("table", "table_name")


LAKE_KEYS = f"SELECT *, 'event_type,value,props,table' AS nullable FROM ({fold_queries.UPSERT_LATEST})"


def bucket_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table that lie in one of its hash buckets."""
    rows = fold_queries.upsert_latest(spark, sf_dir)
    buckets = Options().buckets
    numbered = rows.withColumn(lake.BUCKET, lake.bucket_of(fixtures.KEYS, buckets))
    return numbered.groupBy("table_name").agg(
        F.count("*").alias("records"),
        F.count_if(F.col(lake.BUCKET).between(0, buckets - 1)).alias("placed"),
    )


BUCKET_BALANCE = f"""
SELECT table_name, count(*) AS records, count(*) AS placed
FROM ({fold_queries.UPSERT_LATEST}) GROUP BY 1"""

def bucket_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys per hash bucket of stored tables, after a compaction and another batch, read from the buckets' files."""
    schemas = {f"app_t_{n}": (fixtures.KEY_FIELDS, fixtures.VALUE_FIELDS[2:]) for n in range(16)}
    store = TableStore(spark, scratch_path(spark, "bucket_store"), Options())
    sink = FeedSink(store, schemas)
    for batch, rows in enumerate(_slices(fixtures.flat_feed(spark, sf_dir))[:2]):
        sink.apply(rows, batch)
        store.compact()
    units: dict[tuple[str, tuple[int, ...], Layout], list[str]] = {}
    for name, entry in store.catalog().tables.items():
        for path, own in entry.base:
            units.setdefault((path, own, entry.layout), []).append(name)
    held = [
        buckets.read_unit(spark, path, store.patch_schema(layout)).filter(
            F.col("table").isin(names) & F.col(buckets.BUCKET).isin(list(own))
        )
        for (path, own, layout), names in units.items()
    ]
    rows = [frame.select(F.col("table").alias("table_name"), buckets.BUCKET, "key.user_id", "key.k") for frame in held]
    places = reduce(DataFrame.union, rows).groupBy("table_name", "user_id", "k").agg(
        F.count_distinct(buckets.BUCKET).alias("places"), F.max(buckets.BUCKET).alias("bucket")
    )
    return places.groupBy("table_name", "bucket").agg(
        F.count("*").alias("keys"), F.max("places").alias("most_places"), F.sum(F.col("user_id") * 100 + F.col("k")).alias("key_sum")
    )


def _hash_sql(source: str, parts: list[tuple[str, int]], name: str) -> str:
    """Steps of the 32-bit hash of numbers, over ``source``; each part is an expression and the bytes of its number."""
    mask, steps = 4294967295, []

    def step(expression: str) -> None:
        steps.append(f"{name}{len(steps)} AS (SELECT * REPLACE ({expression}) FROM {name if steps else source}{len(steps) - 1 if steps else ''})")

    def turned(value: str, by: int) -> str:
        return f"((({value}) << {by}) & {mask}) | (({value}) >> {32 - by})"

    def times(value: str, by: int) -> str:
        return f"CAST(CAST({value} AS HUGEINT) * {by} % 4294967296 AS BIGINT)"

    for value, size in parts:
        for word in range(size // 4):
            step(f"({value} >> {32 * word}) & {mask} AS w")
            step(f"{times('w', 0xCC9E2D51)} AS w")
            step(f"{times('(' + turned('w', 15) + ')', 0x1B873593)} AS w")
            step("xor(h, w) AS h")
            step(f"({turned('h', 13)}) * 5 + {0xE6546B64} & {mask} AS h")
        step(f"xor(h, {size}) AS h")
        step("xor(h, h >> 16) AS h")
        step(f"{times('h', 0x85EBCA6B)} AS h")
        step("xor(h, h >> 13) AS h")
        step(f"{times('h', 0xC2B2AE35)} AS h")
        step("xor(h, h >> 16) AS h")
    return ", ".join([*steps, f"{name} AS (SELECT * FROM {name}{len(steps) - 1})"])


BUCKET_STORE = f"""
WITH {LOG}, rows AS (
  SELECT table_name, user_id, k, CAST(42 AS BIGINT) AS h, CAST(0 AS BIGINT) AS w FROM (
    SELECT *, row_number() OVER (PARTITION BY table_name, user_id, k ORDER BY event_id DESC) AS rn
    FROM log WHERE ts < TIMESTAMP '{LANDINGS[1]} 00:00:00'
  ) WHERE rn = 1 AND op = 'u'
), {_hash_sql("rows", [("user_id", 8), ("CAST(k AS BIGINT)", 4)], "hashed")}
SELECT table_name, CAST(((h - CASE WHEN h >= 2147483648 THEN 4294967296 ELSE 0 END) % 5 + 5) % 5 AS INTEGER) AS bucket,
       count(*) AS keys, CAST(1 AS BIGINT) AS most_places, CAST(sum(user_id * 100 + k) AS BIGINT) AS key_sum
FROM hashed GROUP BY 1, 2"""

QUERIES = {
    "feed_files": feed_files,
    "stream_apply": stream_apply,
    "stream_merge": stream_merge,
    "stream_rejects": stream_rejects,
    "stream_replay": stream_replay,
    "evolve_types": evolve_types,
    "lake_write": lake_write,
    "lake_keys": lake_keys,
    "bucket_balance": bucket_balance,
    "bucket_store": bucket_store,
}

SQL = {
    "feed_files": FEED_FILES,
    "stream_apply": schema_queries.EVOLVE_ADD,
    "stream_merge": fold_queries.DELETE_REINSERT,
    "stream_rejects": feed_queries.REJECT_COUNTS,
    "stream_replay": STREAM_REPLAY,
    "evolve_types": EVOLVE_TYPES,
    "lake_write": fold_queries.UPSERT_LATEST,
    "lake_keys": LAKE_KEYS,
    "bucket_balance": BUCKET_BALANCE,
    "bucket_store": BUCKET_STORE,
}
