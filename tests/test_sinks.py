"""File and table sinks, small-side joins and plans."""

from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from feedfold.operators import bounded, fold, records
from feedfold.functions.convert import Field
from feedfold.functions.rules import CONNECT_DECIMAL
from feedfold.options import Options
from feedfold.plans import build, fixtures
from feedfold.session import landed, scratch_path
from feedfold.sinks import lake

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame, capsys):
    frame.explain()
    return capsys.readouterr().out


def test_lake_formats(spark):
    rows = spark.range(20).select(F.concat(F.lit("t"), F.col("id") % 2).alias("table"), "id")
    for kind in ("parquet", "orc"):
        options = Options(profile="lake", lake_format=kind)
        path = scratch_path(spark, "lake")
        lake.write_lake(rows, path, options)
        back = lake.read_lake(rows, path, options)
        assert sorted(back.select("table", "id").collect()) == sorted(rows.collect())
        assert back.filter("table = 't1'").count() == 10


def test_keys_are_marked_and_checked(spark):
    fields = [Field("id", "INT64"), Field("name", "STRING"), Field("d", "BYTES", CONNECT_DECIMAL), Field("a", "STRING")]
    keys, options = ["id", "name", "d"], Options(profile="lake", lake_format="parquet")
    kind = "`table` string, id long, name string, d decimal(20,4), a string"
    path = scratch_path(spark, "lake_keys")
    rows = [("t", 1, "x", Decimal("1.5000"), None), ("t", 0, "", Decimal("0.0000"), "b")]
    lake.write_lake(spark.createDataFrame(rows, kind), path, options, keys=keys)
    (file,) = Path(path.removeprefix("file:"), "table=t").glob("*.parquet")
    marked = [f.name for f in pq.read_schema(file) if not f.nullable]
    assert marked == keys
    back = lake.read_lake_fields(spark, path, fields, keys, options)
    assert [f.name for f in back.schema if not f.nullable] == keys
    assert sorted(map(tuple, back.select("table", "id", "name", "d", "a").collect())) == sorted(rows, key=str)
    with pytest.raises(Exception, match="null in key column name"):
        lake.write_lake(spark.createDataFrame([("t", 1, None, Decimal(1), "a")], kind), scratch_path(spark, "null_key"), options, keys=keys)
    bad = scratch_path(spark, "null_key_read")
    lake.write_lake(spark.createDataFrame([("t", 1, None, Decimal(1), "a")], kind), bad, options)
    with pytest.raises(Exception, match="null in key column name"):
        lake.read_lake_fields(spark, bad, fields, keys, options).collect()


def test_buckets_hold_every_key_once(spark):
    rows = spark.range(200)
    path = scratch_path(spark, "buckets")
    lake.write_buckets(rows, path, ["id"], Options(buckets=5))
    back = spark.read.parquet(path)
    assert back.count() == 200 and back.select("bucket").distinct().count() == 5
    assert back.groupBy("id").agg(F.count_distinct("bucket").alias("n")).filter("n > 1").count() == 0


def test_bucketed_tables_fold_without_a_shuffle(spark, capsys):
    rows = spark.range(100).select("id", (F.col("id") * 2).alias("v"))
    lake.save_bucketed(rows, "bucketed_rows", ["id"], Options(buckets=3))
    try:
        plan = plan_of(spark.table("bucketed_rows").groupBy("id").agg(F.max("v")), capsys)
        assert "Exchange" not in plan
    finally:
        spark.sql("DROP TABLE bucketed_rows")


def test_merge_into_needs_a_row_level_catalog(spark):
    spark.range(3).select("id", F.lit(1).alias("v")).write.mode("overwrite").saveAsTable("plain_rows")
    changes = spark.range(1).select(
        "id", F.lit(True).alias("alive"), F.lit(False).alias("reset"), F.struct(F.lit(2).alias("v")).alias("v")
    )
    try:
        with pytest.raises(UnsupportedOperationException, match="MERGE"):
            lake.merge_into(changes, "plain_rows", ["id"], ["v"])
    finally:
        spark.sql("DROP TABLE plain_rows")


def test_attach_gives_the_same_rows_on_both_sides_of_the_limit(spark, capsys):
    feed = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    summary = feed.groupBy("k").agg(F.count("*").alias("n"))
    small, large = bounded.attach(feed, summary, ["k"]), bounded.attach(feed, summary, ["k"], limit=3)
    assert sorted(small.collect()) == sorted(large.collect())
    assert "BroadcastHashJoin" in plan_of(small, capsys)


def test_spread_keys(spark):
    rows = [("t", "x", 0, 1), ("t", "x", 1, 1), ("t", "x", 0, 2), ("t", "y", 0, 2), ("t", "x", 0, 3), ("t", "x", 0, 3)]
    frame = spark.createDataFrame(rows, "`table` string, topic string, partition int, k int")
    assert sorted((r.k, r.places) for r in records.spread_keys(frame, ["k"]).collect()) == [(1, 2), (2, 2)]


def test_as_of_offset_reaches_the_scan(spark, capsys):
    feed = landed(fixtures.flat_feed(spark, SF_DIR), "as_of")
    rows = build.current_rows(fold.as_of(feed, 500), fixtures.KEY_FIELDS, fixtures.VALUE_FIELDS, Options())
    assert "PushedFilters: [IsNotNull(offset), LessThanOrEqual(offset,500)" in plan_of(rows, capsys)


def test_current_rows_shuffle_once_and_check_before(spark, capsys):
    feed = landed(fixtures.flat_feed(spark, SF_DIR), "plan")
    plan = plan_of(build.current_rows(feed, fixtures.KEY_FIELDS, fixtures.VALUE_FIELDS, Options()), capsys)
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan
    shuffle = plan.index("Exchange")
    # bad records are told before the shuffle; what is shuffled is text, decoded for the surviving rows
    assert "StructField(event_type" in plan[:shuffle] and "StructField(_corrupt" in plan[shuffle:]
    assert "ReadSchema: struct<topic:string,partition:int,offset:bigint,key:string,value:string>" in plan


def test_bad_records_do_not_overwrite_rows_in_batch(spark):
    keys, values = [Field("id", "INT64")], [Field("id", "INT64"), Field("a", "STRING"), Field("n", "INT32")]
    rows = [
        ("t", 0, 1, None, '{"id": 1}', '{"id": 1, "a": "ok", "n": 1}'), ("t", 0, 2, None, "junk", '{"a": "z"}'),
        ("t", 0, 3, None, "[]", '{"a": "z"}'), ("t", 0, 4, None, '{"id": 1}', "broken"),
        ("t", 0, 5, None, '{"id": 1}', '{"id": 1, "n": "many"}'), ("t", 0, 6, None, '{"id": null}', '{"a": "z"}'),
        ("t", 0, 7, None, '{"id": 1}', '{"a": '),
    ]
    feed = spark.createDataFrame(rows, "topic string, partition int, offset bigint, ts timestamp, key string, value string")
    for options in (Options(), Options(null_overwrites=False)):
        found = build.current_rows(feed, keys, values, options).collect()
        assert [tuple(r) for r in found] == [("t", 1, "ok", 1)]


def test_hot_key_is_folded_before_the_shuffle(spark):
    count = 20_000
    rows = spark.range(count, numPartitions=4).select(
        F.lit(1).alias("k"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit("u").alias("op"),
        F.col("id").alias("v"),
    )
    assert [tuple(r) for r in fold.latest(rows, ["k"], "v").collect()] == [(1, count - 1)]


def test_strict_batch_plans_raise(spark):
    rows = spark.createDataFrame([("t", None), ("t", "k")], "`table` string, key string")
    flagged = records.split_rejects(rows, {"null_key": records.null_key(rows)})
    assert records.accepted(flagged, Options()).count() == 1
    with pytest.raises(records.RejectedRecords, match="null_key"):
        records.accepted(flagged, Options(strict=True))
