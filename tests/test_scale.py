"""What makes the work of queries on feeds grow with the feed, and no faster."""

from pyspark.sql import functions as F

from feedfold.functions.convert import Field
from feedfold.operators import layout as layouts
from feedfold.options import Options
from feedfold.plans import fixtures, sink_queries
from feedfold.sinks.store import TableStore
from feedfold.streaming import apply


def events(spark, path, n):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    rows = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.timestamp_add("SECOND", F.col("id"), start).alias("ts"),
        (F.col("id") % 40).alias("user_id"),
        F.lit("view").alias("event_type"),
        (F.col("id") / 8).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 3).alias("props"),
    )
    rows.coalesce(1).write.parquet(f"{path}/events.parquet")


def test_records_of_a_slice_are_made_by_many_tasks(spark, tmp_path):
    """All events of the first slice lie together in one file."""
    events(spark, tmp_path, 2_000)
    feeds = [
        fixtures.form_feed(spark, str(tmp_path)),
        fixtures.schema_feed(spark, str(tmp_path), dealt=True),
        fixtures.bad_feed(spark, str(tmp_path), dealt=True),
    ]
    for feed in feeds:
        tasks = sink_queries._slices(feed)[0].groupBy(F.spark_partition_id()).count().collect()
        assert sum(t["count"] for t in tasks) == 2_000
        assert len(tasks) == spark.sparkContext.defaultParallelism
        assert max(t["count"] for t in tasks) < 2_000 / 2


def test_refused_records_are_decoded_once(spark, tmp_path):
    fields = [Field("n", "INT64")]
    layout = layouts.create([Field("id", "INT64")], fields)
    sink = apply.FeedSink(TableStore(spark, str(tmp_path), Options()))
    values = spark.createDataFrame([(0, '{"n":1}'), (1, '{"n":"x"}'), (2, None)], "offset long, value string")
    values = values.select(
        F.lit("t").alias("table"), F.lit(0).alias("partition"), "offset", F.when(F.col("value").isNull(), "d").otherwise("u").alias("op"),
        F.lit("f").alias("fp"), F.format_string('{"id":%d}', "offset").alias("key"), "value",
    )
    bad = apply._refused(sink._decode_as(values, layout, (*layout.keys, *layout.columns)))
    assert [tuple(r) for r in bad.collect()] == [("t", 0, 1, "cast_failed", '{"id":1}', '{"n":"x"}')]
    assert bad._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 2  # the key and the value
