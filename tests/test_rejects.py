"""Rejects of the batch plan against those of a stream, and decisions over schemas."""

import json

import pytest
from pyspark.sql import functions as F

from feedfold.functions.convert import Field
from feedfold.operators import ordered, records, schema
from feedfold.options import Options
from feedfold.plans import build
from feedfold.session import scratch_path
from feedfold.sinks.store import TableStore
from feedfold.streaming.apply import FeedSink

FEED = "topic string, partition int, offset bigint, ts timestamp, key string, value string"
KEYS = [Field("id", "INT64"), Field("k", "INT32")]
VALUES = [*KEYS, Field("a", "STRING"), Field("n", "INT32"), Field("at", "INT64", "io.debezium.time.MicroTime")]

GOOD = {"a": "x", "n": 1, "at": 5}


def texts():
    key = '{"id": 1, "k": 2}'
    row = json.dumps(GOOD)
    return [
        (key, row), (None, row), ("junk", row), ("[]", row), ("5", None), ('{"id": 1, "k": ', row), ('{"id": 1, "k": ', None),
        ('{"id": "one", "k": 2}', row), ('{"id": null, "k": 2}', row), ('{"id": 1}', row), ('{"id": 1}', None), ('{"k": 2, "id": 1}', None),
        (key, "junk"), (key, "[1]"), (key, '{"a": '), (key, '{"n": "many"}'), (key, '{"at": -5}'), ('{"id": 1}', "junk"), ("junk", "junk"),
        (key, json.dumps({**GOOD, "a": None})), ('{"id": 3, "k": 2}', row), ('{"id": 3, "k": 2, "x": 1}', None), (None, None), ("", row), (key, ""),
    ]


def feed_of(spark, pairs):
    rows = [("t", 0, n, None, k, v) for n, (k, v) in enumerate(pairs)] + [("u", 0, 0, None, '{"id": 1, "k": 1}', None)]
    return spark.createDataFrame(rows, FEED)


def told(frame):
    return sorted((r["table"], r["offset"], r["reason"], r["key"], r["value"]) for r in frame.collect())


@pytest.mark.parametrize("options", [Options(), Options(null_overwrites=False), Options(deletes=False)])
def test_batch_and_stream_agree(spark, options):
    feed = feed_of(spark, texts())
    rows, bad, counts = build.rows_and_rejects(feed, KEYS, VALUES, options)
    store = TableStore(spark, scratch_path(spark, "agree"), options)
    FeedSink(store, {"t": (KEYS, VALUES), "u": (KEYS, VALUES)}).apply(feed, 0)
    kept = spark.read.parquet(f"{store.root}/rejects")
    assert told(bad) == told(kept) and len({r[2] for r in told(bad)}) == 5
    kept = spark.read.parquet(f"{store.root}/counts").select(counts.columns)
    assert sorted(counts.collect()) == sorted(kept.collect())
    received, written, rejected = counts.groupBy().agg(F.sum("received"), F.sum("written"), F.sum("rejected")).head()
    assert received == len(texts()) + 1 and written + rejected <= received and rejected == bad.count()
    found = rows.where("`table` = 't'").drop("table")
    assert sorted(found.collect()) == sorted(store.current("t").select(found.columns).collect())


def test_the_feed_is_read_once(spark):
    path = scratch_path(spark, "read_once")
    feed_of(spark, texts()).write.parquet(path)
    results = build.rows_and_rejects(spark.read.schema(FEED).parquet(path), KEYS, VALUES, Options())
    for frame in results:
        assert path not in "".join(frame.inputFiles())
        assert "from_json" not in frame._jdf.queryExecution().executedPlan().toString()


def test_strict_raises(spark):
    with pytest.raises(records.RejectedRecords):
        build.rows_and_rejects(feed_of(spark, texts()), KEYS, VALUES, Options(strict=True))


def test_envelopes_and_nothing(spark):
    pairs = [('{"id": 1, "k": 1}', '{"after": {"a": "x"}}'), ('{"id": 1, "k": 1}', '{"heartbeat": 1}'), ('{"id": 2, "k": 1}', '{"after": null}')]
    rows, bad, _ = build.rows_and_rejects(feed_of(spark, pairs), KEYS, VALUES, Options(envelope="after"))
    assert [r["a"] for r in rows.collect()] == ["x"] and [t[2] for t in told(bad)] == ["malformed_value"]
    for frame in build.rows_and_rejects(spark.createDataFrame([], FEED), KEYS, VALUES, Options()):
        assert frame.collect() == []


def test_either_side_decides(spark):
    on = ["table", "epoch"]
    kind = "`table` string, epoch int, needs_change boolean, conflict boolean"
    keys = spark.createDataFrame([("t", 2, True, False), ("t", 3, False, False), ("t", 4, False, True)], kind)
    values = spark.createDataFrame([("t", 2, False, False), ("t", 3, False, False)], kind)
    found = schema.needs_any_change(keys, values, on)
    assert sorted(map(tuple, found.collect())) == [("t", 2, True, False), ("t", 3, False, False), ("t", 4, False, True)]


def test_partitions_have_epochs_of_their_own(spark):
    turns = [("t", 0, n, "u", f"s{n // 4}") for n in range(0, 12, 2)] + [("t", 1, n, "u", f"s{n // 8}") for n in range(1, 12, 2)]
    log = spark.createDataFrame([*turns, ("t", 1, 20, "d", None)], "`table` string, partition int, offset bigint, op string, fp string")
    for span in (3, 1 << 18):
        rows = schema.with_frontier(schema.with_epochs(log, span))
        found = sorted((r["partition"], r["offset"], r["epoch"], r["settled"]) for r in rows.collect())
        want = [(0, n, n // 4 + 1, n < 8) for n in range(0, 12, 2)] + [(1, n, n // 8 + 1, True) for n in range(1, 12, 2)]
        assert found == [*want, (1, 20, 2, True)]
    (vector,) = schema.epoch_vectors(schema.with_epochs(log)).collect()
    assert (vector["vector"], vector["frontier"], vector["ahead"]) == ({0: 3, 1: 2}, 2, 3)


def test_cells_hold_one_topic_partition(spark):
    rows = spark.range(4000).select(
        F.concat(F.lit("t"), F.col("id") % 4).alias("topic"), (F.col("id") % 2).cast("int").alias("partition"),
        F.call_function("div", F.col("id"), F.lit(4)).alias("offset"),
    )
    place = ["topic", "partition"]
    cells = ordered._with_cells(rows, 100).groupBy(*place, ordered._CELL).count()
    assert cells.agg(F.max("count")).head()[0] == 100
    cut = ordered.flush_segments(rows, 300, place, 100).groupBy(*place, "segment").count()
    assert sorted(tuple(r) for r in cut.collect())[:4] == [("t0", 0, 0, 300), ("t0", 0, 1, 300), ("t0", 0, 2, 300), ("t0", 0, 3, 100)]
