"""Merged rows of a stream: values, replays, compaction, and the plan."""

import pytest

from feedfold.functions.convert import Field
from feedfold.options import Options
from feedfold.session import scratch_path
from feedfold.sinks import store as stores
from feedfold.sinks.store import TableStore
from feedfold.streaming.merge import RowMerger

RECORDS = "`table` string, partition int, offset bigint, op string, id bigint, n bigint, s string"
BIG = 2**53 + 1


def merger_on(spark, name, options=None):
    out = []
    store = TableStore(spark, scratch_path(spark, name), options or Options(profile="row_cache", allow_missing=True))

    def emit(rows, batch):
        rows.explain()
        found = rows.select("table", "id", "offset", "alive", "n", "s").collect()
        out.append((batch, sorted(map(tuple, found))))

    merger = RowMerger(store, [Field("id", "INT64")], [Field("n", "INT64"), Field("s", "STRING")], emit)
    return merger, store, out


def apply(merger, batch, *rows):
    frame = merger.store.spark.createDataFrame([(t, 0, o, op, i, n, s) for t, o, op, i, n, s in rows], RECORDS)
    merger.apply(frame, batch)


def test_rows_as_they_change(spark, capsys):
    merger, store, out = merger_on(spark, "merge")
    apply(merger, 0, ("t", 1, "u", 1, BIG, None), ("t", 2, "u", 2, None, "b"), ("t", 3, "u", 2, BIG + 2, None), ("t", 4, "u", 9, 1, "x"))
    assert out[-1] == (0, [("t", 1, 1, True, BIG, None), ("t", 2, 3, True, BIG + 2, "b"), ("t", 9, 4, True, 1, "x")])
    # a delete, and a row that is deleted and inserted again; a new table
    apply(merger, 1, ("t", 5, "d", 1, None, None), ("t", 6, "d", 2, None, None), ("t", 7, "u", 2, None, "c"), ("u", 1, "u", 1, 5, None))
    assert out[-1] == (1, [("t", 1, 5, False, None, None), ("t", 2, 7, True, None, "c"), ("u", 1, 1, True, 5, None)])
    store.compact()
    capsys.readouterr()
    apply(merger, 2, ("t", 8, "u", 1, None, "d"), ("u", 2, "u", 1, BIG, None))
    assert out[-1] == (2, [("t", 1, 8, True, None, "d"), ("u", 1, 2, True, BIG, None)])
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "Exchange hashpartitioning" not in plan
    assert "BroadcastHashJoin" in plan and plan.count("Bucketed: true") >= 2
    assert sorted(map(tuple, store.current("t").collect())) == [(1, None, "d"), (2, None, "c"), (9, 1, "x")]


def test_a_replay_gives_the_same_rows_and_changes_nothing(spark):
    merger, store, out = merger_on(spark, "merge_replay")
    batches = [[("t", 1, "u", 1, 5, "a"), ("t", 2, "u", 2, 6, None)], [("t", 3, "u", 1, None, "b")], [("t", 4, "d", 1, None, None)]]
    for number, rows in enumerate(batches):
        apply(merger, number, *rows)
    store.compact()
    before = store.catalog()
    for number in (1, 2):
        apply(merger, number, *batches[number])
    assert out[3:] == out[1:3] and store.catalog() == before


def test_more_keys_than_are_sent(spark, monkeypatch, capsys):
    merger, _, out = merger_on(spark, "merge_many")
    monkeypatch.setattr(stores, "SENT_BYTES", 0)
    apply(merger, 0, *[("t", n, "u", n, n, "a") for n in range(40)])
    capsys.readouterr()
    apply(merger, 1, *[("t", 100 + n, "u", n, None, "b") for n in range(0, 40, 2)])
    plan = capsys.readouterr().out
    assert out[-1] == (1, [("t", n, 100 + n, True, n, "b") for n in range(0, 40, 2)])
    assert "Join" not in plan and "Exchange" not in plan


def test_empty_batches(spark):
    merger, store, out = merger_on(spark, "merge_empty")
    apply(merger, 0)
    apply(merger, 1, ("t", 1, "u", 1, 5, "a"))
    apply(merger, 2)
    assert [rows for _, rows in out] == [[], [("t", 1, 1, True, 5, "a")], []]
    assert store.catalog().last_batch == 2


def test_as_a_stream(spark):
    root = scratch_path(spark, "merge_stream")
    merger, _, out = merger_on(spark, "merge_stream_store")
    for n in range(2):
        spark.createDataFrame([("t", 0, n, "u", 1, BIG if n else None, "a")], RECORDS).coalesce(1).write.mode("append").parquet(f"{root}/in")
        records = spark.readStream.schema(RECORDS).parquet(f"{root}/in")
        merger.start(records, f"{root}/checkpoint").awaitTermination()
    assert out == [(0, [("t", 1, 0, True, None, "a")]), (1, [("t", 1, 1, True, BIG, "a")])]


def test_no_batch_to_give_out_again(spark):
    _, store, _ = merger_on(spark, "merge_none")
    with pytest.raises(ValueError, match="batch 4"):
        store.catalog_after(4)
