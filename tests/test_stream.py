"""Applying feeds to a store: splits, replays, compaction, schema changes, rejects."""

import base64
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from feedfold.functions import rules
from feedfold.functions.convert import Field
from feedfold.operators import layout as layouts
from feedfold.operators import records
from feedfold.operators.layout import RefusedSchema
from feedfold.options import Options
from feedfold.session import scratch_path
from feedfold.sinks.store import TableStore
from feedfold.sources.feed import kafka_options, read_feed, stream_feed
from feedfold.streaming.apply import FeedSink

FEED = "topic string, partition int, offset bigint, ts timestamp, key string, value string"
ID = {"id": "int64"}


def schema_of(fields):
    return {"type": "struct", "fields": [{"field": n, "type": t} for n, t in fields.items()]}


def described(fields, payload):
    return json.dumps({"schema": schema_of(fields), "payload": payload})


def upsert(offset, fields, row, topic="t", key=ID):
    return (topic, 0, offset, None, described(key, {k: row[k] for k in key}), described({**key, **fields}, row))


def delete(offset, number, topic="t", key=ID):
    return (topic, 0, offset, None, described(key, {k: number for k in key}), None)


def sink_on(spark, name, options=None, schemas=None):
    store = TableStore(spark, scratch_path(spark, name), options or Options())
    return FeedSink(store, schemas), store


def apply(sink, batch, *rows):
    sink.apply(sink.spark.createDataFrame(list(rows), FEED), batch)


def held(store, table="t", batch=None):
    return sorted(map(tuple, store.current(table, batch).collect()), key=str)


def reasons(spark, store):
    found = spark.read.parquet(f"{store.root}/rejects")
    return sorted((r.offset, r.reason) for r in found.collect())


AB = {"a": "string", "b": "int32"}


def test_splits_replay_compaction_and_as_of(spark):
    rows = [
        upsert(1, AB, {"id": 1, "a": "x", "b": 1}),
        upsert(2, AB, {"id": 2, "a": "y", "b": 2}),
        delete(3, 1),
        upsert(4, {"a": "string"}, {"id": 1, "a": "z"}),
        upsert(5, {"b": "int32"}, {"id": 2, "b": None}),
        delete(6, 9),
        upsert(7, AB, {"id": 3, "a": None, "b": 7}),
        delete(8, 3),
    ]
    options = Options(allow_missing=True)
    want = [(1, "z", None), (2, "y", None)]
    whole, whole_store = sink_on(spark, "whole", options)
    apply(whole, 0, *rows)
    assert held(whole_store) == want
    parts, store = sink_on(spark, "parts", options)
    apply(parts, 0, *rows[:3])
    after_first = held(store)
    apply(parts, 1, *rows[3:5])
    apply(parts, 1, *rows[:3])  # a replayed batch number is skipped
    assert not store.catalog().tables["t"].uniform
    store.compact()
    apply(parts, 2, *rows[5:])
    assert held(store) == want
    store.compact()
    assert held(store) == want and store.catalog().tables["t"].uniform
    apply(parts, 3, upsert(9, AB, {"id": 1, "a": "q", "b": None}), delete(10, 2))
    assert held(store) == [(1, "q", None)] and store.catalog().tables["t"].uniform
    apply(parts, 4, upsert(11, {"b": "int32"}, {"id": 1, "b": 4}))
    assert held(store) == [(1, "q", 4)] and not store.catalog().tables["t"].uniform
    assert held(store, batch=0) == after_first == [(2, "y", 2)]
    counts = spark.read.parquet(f"{store.root}/counts").groupBy().agg(F.sum("received"), F.sum("written")).head()
    assert tuple(counts) == (11, 11)


def numbered(n, a="x", offset=None):
    return upsert(n if offset is None else offset, AB, {"id": n, "a": a, "b": n})


def test_reading_base_and_deltas_needs_no_shuffle(spark, capsys):
    sink, store = sink_on(spark, "buckets")
    apply(sink, 0, *[numbered(n) for n in range(60)])
    store.compact()
    apply(sink, 1, delete(60, 1), numbered(70, "z"))
    apply(sink, 2, numbered(2, "w", 71))
    rows = store.current("t")
    rows.explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 3
    want = [(n, "w" if n == 2 else "x", n) for n in range(60) if n != 1] + [(70, "z", 70)]
    assert sorted(map(tuple, rows.collect())) == want
    apply(sink, 3, numbered(3, "v", 80))
    store.compact()
    assert sorted(map(tuple, store.current("t").collect())) == [(3, "v", 3) if r[0] == 3 else r for r in want]


def test_compaction_leaves_other_buckets_alone(spark):
    sink, store = sink_on(spark, "compaction")
    apply(sink, 0, *[numbered(n) for n in range(60)], upsert(90, AB, {"id": 1, "a": "u", "b": 1}, topic="u"))
    store.compact()
    before = store.catalog().tables["t"].base
    assert [held for _, held in before] == [(0, 1, 2, 3, 4)]
    apply(sink, 1, numbered(7, "z", 100))
    bucket = spark.sql("SELECT pmod(hash(named_struct('id', 7L)), 5) AS b").head().b
    store.compact()
    after = store.catalog().tables
    assert [held for _, held in after["t"].base] == [tuple(b for b in range(5) if b != bucket), (bucket,)]
    assert after["t"].base[0][0] == before[0][0] and len(after["u"].base) == 1 and not after["t"].deltas
    assert held(store) == sorted([(n, "z" if n == 7 else "x", n) for n in range(60)], key=str)
    assert held(store, "u") == [(1, "u", 1)]
    # every row of the bucket goes; its folder is then empty
    apply(sink, 2, *[delete(200 + n, n) for n in range(60)])
    store.compact()
    assert held(store) == [] and held(store, "u") == [(1, "u", 1)]


def test_columns_that_come_back_stay_empty_in_buckets_that_compaction_left_alone(spark):
    sink, store = sink_on(spark, "since")
    apply(sink, 0, *[numbered(n) for n in range(20)])
    store.compact()
    apply(sink, 1, upsert(100, {"a": "string"}, {"id": 100, "a": "y"}))
    apply(sink, 2, upsert(101, AB, {"id": 101, "a": "z", "b": 1}))
    want = sorted([*((n, "x", None) for n in range(20)), (100, "y", None), (101, "z", 1)], key=str)
    assert held(store) == want
    store.compact()
    assert len(store.catalog().tables["t"].base) == 2 and held(store) == want
    apply(sink, 3, *[numbered(n, "q", 200 + n) for n in range(20)])
    store.compact()
    store.compact()
    assert held(store) == sorted([*((n, "q", n) for n in range(20)), (100, "y", None), (101, "z", 1)], key=str)


def test_another_number_of_buckets_rewrites_all(spark):
    sink, store = sink_on(spark, "rebucket")
    apply(sink, 0, *[numbered(n) for n in range(30)])
    store.compact()
    wider = TableStore(spark, store.root, Options(buckets=7))
    apply(FeedSink(wider), 1, numbered(3, "z", 50))
    want = sorted([(n, "z" if n == 3 else "x", n) for n in range(30)], key=str)
    assert held(wider) == want
    wider.compact()
    (base,) = wider.catalog().tables["t"].base
    assert base[1] == tuple(range(7)) and held(wider) == want


def test_finding_the_newest_catalog_reads_a_bounded_number_of_versions(spark, monkeypatch):
    store = TableStore(spark, scratch_path(spark, "versions"), Options())
    catalog = store.catalog()
    for _ in range(37):
        catalog = store.commit(catalog)
    read = []
    versions = TableStore._versions
    monkeypatch.setattr(TableStore, "_versions", lambda self, *about: read.append(about) or versions(self, *about))
    assert TableStore(spark, store.root, Options()).catalog().version == 37
    assert store.catalog().version == 37
    assert read == [(32, 48), (37, 53)]
    # a note that is lost is made up for from the first version on
    spark.createDataFrame([], "version bigint").write.mode("overwrite").parquet(f"{store.root}/head")
    assert TableStore(spark, store.root, Options()).catalog().version == 37


def test_dropped_column_comes_back_empty(spark):
    sink, store = sink_on(spark, "drop")
    apply(sink, 0, upsert(1, AB, {"id": 1, "a": "x", "b": 1}), upsert(2, AB, {"id": 2, "a": "y", "b": 2}))
    apply(sink, 1, upsert(3, {"a": "string"}, {"id": 3, "a": "w"}))
    assert held(store) == [(1, "x"), (2, "y"), (3, "w")]
    apply(sink, 2, upsert(4, AB, {"id": 2, "a": "v", "b": 5}))
    assert held(store) == [(1, "x", None), (2, "v", 5), (3, "w", None)]
    store.compact()
    assert held(store) == [(1, "x", None), (2, "v", 5), (3, "w", None)]
    same, same_store = sink_on(spark, "drop_in_batch")
    apply(
        same, 0,
        upsert(1, AB, {"id": 1, "a": "x", "b": 1}), upsert(3, {"a": "string"}, {"id": 3, "a": "w"}),
        upsert(4, AB, {"id": 2, "a": "v", "b": 5}),
    )
    assert held(same_store) == [(1, "x", None), (2, "v", 5), (3, "w", None)]


def placed(partition, row):
    return (row[0], partition, *row[2:])


def test_partitions_that_get_a_column_keep_its_values(spark):
    a = {"a": "string"}
    rows = [
        placed(p, row)
        for p in (0, 1)
        for row in (
            upsert(1, a, {"id": 10 + p, "a": "x"}),
            upsert(2, AB, {"id": 20 + p, "a": "y", "b": 7 + p}),
        )
    ]
    want = [(10, "x", None), (11, "x", None), (20, "y", 7), (21, "y", 8)]
    for split in (4, 2):
        sink, store = sink_on(spark, "partitions")
        for batch, at in enumerate(range(0, 4, split)):
            apply(sink, batch, *rows[at : at + split])
        assert held(store) == want
        # one partition drops the column, the other still has it
        apply(sink, 9, placed(0, upsert(3, a, {"id": 30, "a": "z"})))
        assert held(store) == [*want, (30, "z", None)]
        apply(sink, 10, placed(1, upsert(3, a, {"id": 31, "a": "z"})))
        assert held(store) == [(10, "x"), (11, "x"), (20, "y"), (21, "y"), (30, "z"), (31, "z")]


def test_alternating_producers_are_few_steps(spark, monkeypatch):
    kinds = [{"a": "string"}, AB]
    rows = [upsert(n, kinds[n % 2], {"id": n, "a": "x", **({"b": n} if n % 2 else {})}) for n in range(400)]
    met = []
    evolve = FeedSink._evolve
    monkeypatch.setattr(FeedSink, "_evolve", lambda *about: met.append(about) or evolve(*about))
    sink, store = sink_on(spark, "alternating")
    apply(sink, 0, *rows)
    assert len(met) == 2
    # the column was dropped before the last record, which adds it again
    assert [r for r in held(store) if r[2] is not None] == [(399, "x", 399)]


def test_stage_holds_one_batch(spark):
    sink, store = sink_on(spark, "staged")
    for n in range(3):
        apply(sink, n, upsert(n, AB, {"id": n, "a": "x", "b": n}))
    assert spark.read.parquet(f"{store.root}/stage").count() == 1


def test_rejects(spark):
    sink, store = sink_on(spark, "rejects")
    bad_text = upsert(7, AB, {"id": 4, "a": "x", "b": "many"})
    apply(
        sink, 0,
        delete(0, 1),  # before the table exists: skipped, not rejected
        upsert(1, AB, {"id": 1, "a": "x", "b": 1}),
        ("t", 0, 2, None, None, described(AB, {"a": "n"})),
        upsert(3, {"a": "string", "b": "string"}, {"id": 2, "a": "y", "b": "2"}),
        upsert(4, {"a": "string", "b": "map"}, {"id": 2, "a": "y", "b": {}}),
        delete(5, 1, key={"other": "int64"}),
        upsert(6, AB, {"other": 5, "a": "x", "b": 1}, key={"other": "int64"}),
        bad_text,
        ("t", 0, 8, None, described(ID, {"id": 5}), json.dumps({"schema": schema_of(AB), "payload": 5})),
        # Neither broken text nor a bare row is a delete of key 1.
        ("t", 0, 9, None, described(ID, {"id": 1}), '{"schema": {"type"'),
        ("t", 0, 10, None, described(ID, {"id": 1}), '{"id": 1, "a": "y"}'),
    )
    assert held(store) == [(1, "x", 1)]
    assert reasons(spark, store) == [
        (2, "null_key"), (3, "type_conflict"), (4, "unsupported_type"), (5, "delete_key_change"),
        (6, "key_change"), (7, "cast_failed"), (8, "malformed_value"), (9, "no_schema"), (10, "no_schema"),
    ]


def test_strict_raises_and_commits_nothing(spark):
    sink, store = sink_on(spark, "strict", Options(strict=True))
    with pytest.raises(records.RejectedRecords):
        apply(sink, 0, ("t", 0, 2, None, None, described(AB, {"a": "n"})))
    with pytest.raises(records.RejectedRecords):
        apply(sink, 0, upsert(7, AB, {"id": 4, "a": "x", "b": "many"}))
    assert store.catalog().tables == {} and store.catalog().last_batch == -1


@pytest.mark.parametrize(
    "options, want",
    [
        (Options(profile="row_cache"), [(1, None, 5)]),
        (Options(profile="row_cache", allow_missing=True), [(1, "x", 5)]),
        (Options(allow_missing=True, null_overwrites=False), [(1, "x", 5)]),
        (Options(allow_missing=True, deletes=False), [(1, "x", 5), (2, "y", None)]),
    ],
)
def test_modes(spark, options, want):
    sink, store = sink_on(spark, "modes", options)
    apply(sink, 0, upsert(1, AB, {"id": 1, "a": "x", "b": 1}), upsert(2, AB, {"id": 2, "a": "y", "b": None}))
    apply(sink, 1, upsert(3, {"b": "int32"}, {"id": 1, "b": 5}), delete(4, 2))
    assert held(store) == want


def test_null_policy(spark):
    for overwrites, kept in ((True, None), (False, "x")):
        sink, store = sink_on(spark, "nulls", Options(null_overwrites=overwrites))
        apply(sink, 0, upsert(1, AB, {"id": 1, "a": "x", "b": 1}))
        apply(sink, 1, upsert(2, AB, {"id": 1, "a": None, "b": 2}))
        assert held(store) == [(1, kept, 2)]


def test_envelope_and_many_tables(spark):
    def event(offset, row, topic):
        image = {**schema_of({**ID, **AB}), "field": "after"}
        shape = {"type": "struct", "fields": [{**image, "field": "before"}, image, {"field": "op", "type": "string"}]}
        value = {"schema": shape, "payload": {"before": None, "after": row, "op": "d" if row is None else "c"}}
        number = 1 if row is None else row["id"]
        return (topic, 0, offset, None, described(ID, {"id": number}), json.dumps(value))

    sink, store = sink_on(spark, "envelope", Options(envelope="after", topic_prefix="db."))
    apply(
        sink, 0,
        event(1, {"id": 1, "a": "x", "b": 1}, "db.S.A"), event(2, {"id": 2, "a": "y", "b": 2}, "db.S.B"),
        event(3, {"id": 3, "a": "z", "b": 3}, "db.S.A"), event(4, None, "db.S.A"),
    )
    assert held(store, "s_a") == [(3, "z", 3)] and held(store, "s_b") == [(2, "y", 2)]
    (frame,) = store.current_all().values()
    assert {r.table for r in frame.collect()} == {"s_a", "s_b"}


def test_bare_envelope_that_is_none(spark):
    schemas = {"t": ([Field("id", "INT32")], [Field("a", "STRING")])}
    sink, store = sink_on(spark, "bare_envelope", Options(envelope="after"), schemas)
    values = ['{"after": {"a": "x"}}', '{"after": {"a": "y"}}', '{"after": null}', '{"heartbeat": 1}', '{"after": ']
    rows = [("t", 0, n, None, '{"id": %d}' % (n % 2 if n < 3 else 1), v) for n, v in enumerate(values)]
    apply(sink, 0, *rows)
    assert held(store) == [(1, "y")]
    assert reasons(spark, store) == [(3, "malformed_value"), (4, "malformed_value")]


def test_landing_without_a_shuffle(spark):
    sink, store = sink_on(spark, "per_topic")
    sink.topic_per_task = True
    apply(sink, 0, upsert(1, AB, {"id": 1, "a": "x", "b": 1}), upsert(2, AB, {"id": 2, "a": "y", "b": 2}, "u"))
    assert held(store) == [(1, "x", 1)] and held(store, "u") == [(2, "y", 2)]


def test_supplied_schemas_and_key_only_table(spark):
    schemas = {"t": ([Field("key_id", "INT32")], [Field("name", "STRING")]), "k": ([Field("id", "INT64")], [])}
    sink, store = sink_on(spark, "supplied", schemas=schemas)
    rows = [("t", 0, i, None, json.dumps({"key_id": i % 2}), json.dumps({"name": f"n{i}"})) for i in range(4)]
    apply(sink, 0, *rows, ("k", 0, 1, None, '{"id": 4}', "{}"), ("u", 0, 1, None, '{"id": 4}', "{}"))
    assert held(store) == [(0, "n2"), (1, "n3")]
    assert held(store, "k") == [(4,)]
    assert reasons(spark, store) == [(1, "no_schema")]


def test_streaming_run_bounds_files_and_resumes(spark):
    root = scratch_path(spark, "files")
    sink, store = sink_on(spark, "run")
    for number in range(2):
        row = upsert(number, AB, {"id": 1, "a": f"v{number}", "b": number})
        frame = spark.createDataFrame([row], FEED).coalesce(1)
        frame.write.mode("append").parquet(f"{root}/feed")
    sink.start(stream_feed(spark, f"{root}/feed", max_files=1), f"{root}/checkpoint").awaitTermination()
    assert store.catalog().last_batch == 1 and held(store) == [(1, "v1", 1)]
    sink.start(stream_feed(spark, f"{root}/feed", max_files=1), f"{root}/checkpoint").awaitTermination()
    assert store.catalog().last_batch == 1
    assert read_feed(spark, f"{root}/feed").count() == 2


def logical(kind, **params):
    """A field's description beside its physical type."""
    return {"name": kind, "parameters": params} if params else {"name": kind}


def told(offset, fields, row):
    """An upsert whose fields are full descriptions."""
    shape = {"type": "struct", "fields": [{"field": "id", "type": "int64"}, *fields]}
    value = json.dumps({"schema": shape, "payload": row})
    return ("t", 0, offset, None, described(ID, {"id": row["id"]}), value)


def unscaled(number):
    return base64.b64encode(number.to_bytes(8, "big", signed=True)).decode()


def test_each_record_is_decoded_by_its_own_schema(spark):
    def shape(scale, stamp, text):
        return [
            {"field": "d", "type": "bytes", **logical(rules.CONNECT_DECIMAL, scale=str(scale))},
            {"field": "w", "type": "int64", "name": stamp},
            {"field": "s", **text},
        ]

    old = shape(2, "io.debezium.time.Timestamp", {"type": "string"})
    new = shape(4, rules.DEBEZIUM_MICRO_TIMESTAMP, {"type": "int32", "name": "io.debezium.time.Date"})
    at = 1_700_000_000_000
    rows = [
        told(1, old, {"id": 1, "d": unscaled(12345), "w": at, "s": "x"}),
        told(2, new, {"id": 2, "d": unscaled(1230000), "w": at * 1000, "s": 19000}),
        told(3, new, {"id": 3, "d": unscaled(12345), "w": at * 1000, "s": 19000}),
    ]
    for split in (False, True):
        sink, store = sink_on(spark, "own_schema", Options(source_utc_offset_hours=0))
        for number, batch in enumerate([rows[:1], rows[1:]] if split else [rows]):
            apply(sink, number, *batch)
        found = store.current("t").selectExpr("id", "cast(d AS string)", "unix_millis(w)", "s").collect()
        assert sorted(map(tuple, found)) == [(1, "123.45", at, "x"), (2, "123.00", at, "2022-01-08")]
        assert reasons(spark, store) == [(3, "cast_failed")]


def test_wide_decimals_are_refused_and_the_rest_goes_on(spark):
    def sized(offset, number, **params):
        kind = logical(rules.CONNECT_DECIMAL, **params)
        return told(offset, [{"field": "d", "type": "bytes", **kind}], {"id": number, "d": unscaled(5)})

    sink, store = sink_on(spark, "wide")
    precision = rules.PRECISION_PARAMETER
    apply(
        sink, 0, sized(1, 1, **{precision: "65", "scale": "2"}), sized(2, 2, **{precision: "4", "scale": "6"}),
        sized(3, 3, scale="-1"), sized(4, 4, scale="2"),
    )
    assert [r.id for r in store.current("t").collect()] == [4]
    assert reasons(spark, store) == [(n, "unsupported_type") for n in (1, 2, 3)]


def test_null_key_fields_and_replayed_rejects(spark, monkeypatch):
    sink, store = sink_on(spark, "replayed")
    rows = [
        upsert(1, AB, {"id": 1, "a": "x", "b": 1}), upsert(2, AB, {"id": None, "a": "y", "b": 2}),
        upsert(3, AB, {"id": 2, "a": "z", "b": "many"}), delete(4, None),
    ]
    commit = store.commit
    monkeypatch.setattr(store, "commit", lambda _: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        apply(sink, 0, *rows)
    monkeypatch.setattr(store, "commit", commit)
    apply(sink, 0, *rows)
    assert held(store) == [(1, "x", 1)]
    assert reasons(spark, store) == [(2, "null_key"), (3, "cast_failed"), (4, "null_key")]
    counts = spark.read.parquet(f"{store.root}/counts")
    assert sorted((r.op, r.received, r.written, r.rejected) for r in counts.collect()) == [("d", 1, 0, 1), ("u", 3, 1, 2)]


def test_layouts():
    keys, value = [Field("id", "INT64")], [Field("id", "INT64"), Field("a", "STRING")]
    first = layouts.create(keys, value)
    assert first.key_names == ["id"] and first.column_names == ["a"]
    wide = layouts.evolve(first, keys, [Field("id", "INT64"), Field("b", "INT32")], Options(), (3, 0, 9))
    assert wide.column_names == ["b"] and wide.since == {"b": (3, 0, 9)}
    kept = layouts.evolve(first, keys, [Field("b", "INT32")], Options(allow_missing=True), (3, 0, 9))
    assert kept.column_names == ["a", "b"]
    assert layouts.load(layouts.dump(kept)) == kept and layouts.load(layouts.dump(kept)).since == kept.since
    with pytest.raises(RefusedSchema):
        layouts.evolve(first, keys, [Field("a", "INT32")], Options(), (3, 0, 9))
    with pytest.raises(RefusedSchema):
        layouts.create(keys, [Field("a", "ARRAY")])


def test_registry_headers_are_read(spark):
    from feedfold.sources.decode import avro_text, registry_id

    framed = [b"\x00\x00\x00\x01\x02rest", b"\x00\xff\xff\xff\xff", b"\x01\x00\x00\x01\x02rest", b"\x00\x00\x01", b"", None]
    frame = spark.createDataFrame([(n, b) for n, b in enumerate(framed)], "n int, b binary").orderBy("n")
    assert [r.i for r in frame.select("n", registry_id(F.col("b")).alias("i")).collect()] == [258, 2**32 - 1, None, None, None, None]
    # no schema is known: text that is there but no object, except where there are no bytes at all
    assert [r.t for r in frame.select("n", avro_text(F.col("b"), {}).alias("t")).collect()] == ["{"] * 5 + [None]


def test_kafka_options_and_missing_packages(spark):
    options = kafka_options("host:1", "db\\..*", 1000)
    assert options["subscribePattern"] == "db\\..*" and options["maxOffsetsPerTrigger"] == "1000"
    from feedfold.sources.decode import decode_avro

    try:
        spark.range(1).select(decode_avro(F.lit(b"\x00\x00\x00\x00\x01\x02"), '"int"').alias("x")).head()
    except (AnalysisException, TypeError) as missing:
        pytest.skip(f"no Avro package: {type(missing).__name__}")
