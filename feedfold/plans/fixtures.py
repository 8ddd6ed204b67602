"""Change feeds and metric samples derived from the driver's tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.functions import rules
from feedfold.functions.convert import Field
from feedfold.operators.ordered import running_total
from feedfold.session import landed

KEYS = ["user_id", "k"]
KEY_FIELDS = [Field("user_id", "INT64"), Field("k", "INT32")]
VALUE_FIELDS = [
    *KEY_FIELDS,
    Field("event_type", "STRING"),
    Field("value", "FLOAT64"),
    Field("props", "STRING", rules.DEBEZIUM_JSON),
]

# Value fields of the three record schemas, by time; the middle one adds a
# field and the last one swaps it for another.
EPOCH_COLUMNS = [["event_type"], ["event_type", "value"], ["event_type", "props"]]
EPOCH_STARTS = ["2024-01-11", "2024-01-21"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_rows(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Events with the key within their properties as a column.

    With ``dealt`` they are dealt to as many tasks as there are cores before records are made of them: where files lie in
    order of time, few tasks would make all records of a slice of time.
    """
    rows = table(spark, sf_dir, "events")
    if dealt:
        rows = rows.repartition(spark.sparkContext.defaultParallelism, "event_id")
    return rows.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _instant(wall: Column) -> Column:
    """UTC wall clock as an instant, whatever the session zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, wall))


def _text(*columns: Column | str) -> Column:
    """Columns as a JSON object, which the optimizer can see is never null."""
    return F.coalesce(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), F.lit(""))


def _feed(rows: DataFrame, topic: Column, key: Column, value: Column, partition: Column) -> DataFrame:
    return rows.select(
        topic.alias("topic"),
        partition.cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        _instant(F.col("ts")).alias("ts"),
        key.alias("key"),
        value.alias("value"),
    )


def table_topic() -> Column:
    return F.concat(F.lit("app.t_"), F.col("user_id") % 16)


def is_delete() -> Column:
    return F.col("event_type") == "error"


def flat_feed(
    spark: SparkSession,
    sf_dir: str,
    topic: Column | None = None,
    key: Column | None = None,
    partition: Column | None = None,
) -> DataFrame:
    """Events as a flat feed: every ``error`` event deletes its key."""
    rows = event_rows(spark, sf_dir)
    return _feed(
        rows,
        table_topic() if topic is None else topic,
        _text(*KEYS) if key is None else key,
        F.when(~is_delete(), _text(*KEYS, "event_type", "value", "props")),
        F.lit(0) if partition is None else partition,
    )


# Fields of the records of ``form_feed`` before and after their types change form.
FORMS = [
    [Field("amount", "BYTES", rules.CONNECT_DECIMAL, {rules.SCALE_PARAMETER: "2"}),
     Field("at", "INT64", rules.DEBEZIUM_TIMESTAMP), Field("day", "STRING")],
    [Field("amount", "BYTES", rules.CONNECT_DECIMAL, {rules.SCALE_PARAMETER: "4"}),
     Field("at", "INT64", rules.DEBEZIUM_MICRO_TIMESTAMP), Field("day", "INT32", rules.DEBEZIUM_DATE)],
]


def form_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Self-describing records whose fields change form on the way: a longer scale, finer times, dates as numbers.

    Every fourth record of the new form has more digits than the table's column holds.
    """
    user = [Field("user_id", "INT64")]
    epoch_day = F.lit("1970-01-01").cast("date")
    cents = F.floor(F.col("value") * 100).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")
    more = F.when(F.col("event_id") % 4 == 0, F.lit("0.0001").cast("decimal(5,4)")).otherwise(F.lit("0").cast("decimal(5,4)"))
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    millis = F.call_function("div", micros, F.lit(1000))
    day = F.col("ts").cast("date")
    old = _text("user_id", cents.alias("amount"), millis.alias("at"), day.cast("string").alias("day"))
    new = _text(
        "user_id", (cents + more).alias("amount"), (millis * 1000).alias("at"), F.date_diff(day, epoch_day).alias("day")
    )
    values = [_with_schema(_schema_json([*user, *fields], "row"), text) for fields, text in zip(FORMS, (old, new), strict=True)]
    value = F.when(day.cast("string") < EPOCH_STARTS[1], values[0]).otherwise(values[1])
    key = _with_schema(_schema_json(user, "key"), _text("user_id"))
    return _feed(event_rows(spark, sf_dir, dealt=True), table_topic(), key, F.when(~is_delete(), value), F.lit(0))


#: How many kinds of records ``bad_feed`` has; those from ``GOOD`` on are sound.
KINDS, GOOD = 16, 8


def bad_feed(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """The flat feed with every kind of record that a table cannot take, told by the event's number."""
    kind = F.col("event_id") % KINDS
    key = (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, "junk")
        .when(kind == 2, "[1]")
        .when(kind == 3, _text(F.lit(None).cast("bigint").alias("user_id"), "k"))
        .when(kind == 4, F.concat(F.lit('{"user_id":'), F.col("user_id"), F.lit(',"k":')))
        .when((kind == 5) & is_delete(), _text("k"))
        .otherwise(_text(*KEYS))
    )
    value = (
        F.when(is_delete(), F.lit(None))
        .when(kind == 6, "broken")
        .when(kind == 7, _text(*KEYS, "event_type", F.lit("many").alias("value"), "props"))
        .otherwise(_text(*KEYS, "event_type", "value", "props"))
    )
    return _feed(event_rows(spark, sf_dir, dealt), table_topic(), key, value, F.lit(0))


def user_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a feed keyed by user alone; ``view`` lacks a type and ``click`` a value."""
    rows = event_rows(spark, sf_dir)
    kind = F.when(F.col("event_type") != "click", F.col("event_type")).alias("event_type")
    amount = F.when(F.col("event_type") != "view", F.col("value")).alias("value")
    return _feed(
        rows, table_topic(), _text("user_id"), F.when(~is_delete(), _text("user_id", kind, amount)), F.lit(0)
    )


def envelope_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events inside a before/after envelope; a delete has a null ``after``."""
    row = F.struct(*KEYS, "event_type", "value", "props")
    before = F.when(is_delete(), row).alias("before")
    after = F.when(~is_delete(), row).alias("after")
    op = F.when(is_delete(), "d").otherwise("c").alias("op")
    return _feed(event_rows(spark, sf_dir), table_topic(), _text(*KEYS), _text(before, after, op), F.lit(0))


def _schema_json(fields: list[Field], name: str) -> str:
    described = []
    for f in fields:
        entry = {"field": f.name, "type": f.physical.lower(), "optional": f.name not in KEYS}
        if f.logical:
            entry["name"] = f.logical
        if f.params:
            entry["parameters"] = dict(f.params)
        described.append(entry)
    return json.dumps({"type": "struct", "name": name, "version": 1, "fields": described})


def _with_schema(schema: str, payload: Column) -> Column:
    return F.concat(F.lit(f'{{"schema":{schema},"payload":'), payload, F.lit("}"))


def epoch_fields(number: int, wide_key: bool = False) -> list[Field]:
    """Fields of one record schema; ``wide_key`` changes the type of ``k``."""
    names = set(EPOCH_COLUMNS[number])
    keys = [Field("user_id", "INT64"), Field("k", "INT64" if wide_key else "INT32")]
    return [*keys, *[f for f in VALUE_FIELDS[2:] if f.name in names]]


# Key fields of the three record schemas of ``key_schema_feed``.
EPOCH_KEYS = [["user_id"], ["user_id", "k"], ["k"]]


def key_schema_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Self-describing records whose key schema changes with the value's; every fourth table also changes a key's type."""
    day = F.col("ts").cast("date").cast("string")
    epoch = F.when(day < EPOCH_STARTS[0], 0).when(day < EPOCH_STARTS[1], 1).otherwise(2)

    def key(number: int, wide_key: bool = False) -> Column:
        fields = [f for f in epoch_fields(number, wide_key) if f.name in EPOCH_KEYS[number]]
        return _with_schema(_schema_json(fields, "key"), _text(*EPOCH_KEYS[number]))

    last = F.when(F.col("user_id") % 4 == 0, key(2, wide_key=True)).otherwise(key(2))
    keys = F.when(epoch == 0, key(0)).when(epoch == 1, key(1)).otherwise(last)
    value = _with_schema(_schema_json(epoch_fields(0), "row"), _text(*[f.name for f in epoch_fields(0)]))
    return _feed(event_rows(spark, sf_dir), table_topic(), keys, F.when(~is_delete(), value), F.lit(0))


#: Days by which the second partition's schemas change later than the first one's.
PARTITION_LAG = 4


def two_partition_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Self-describing records by turns in two partitions, of which the second changes its schemas later, and not the last time."""
    return schema_feed(spark, sf_dir, partition=F.col("event_id") % 2)


def schema_feed(
    spark: SparkSession, sf_dir: str, conflicts: bool = False, partition: Column | None = None, dealt: bool = False
) -> DataFrame:
    """Self-describing records whose schema changes twice over time.

    With ``conflicts`` the last schema of every fourth table changes a type. With a
    ``partition``, records outside partition 0 lag behind and miss the last schema.
    """
    day = F.col("ts").cast("date")
    if partition is not None:
        day = F.date_sub(day, F.when(partition == 0, 0).otherwise(PARTITION_LAG))
    day = day.cast("string")
    epoch = F.when(day < EPOCH_STARTS[0], 0).when(day < EPOCH_STARTS[1], 1).otherwise(2)
    if partition is not None:
        epoch = F.when(partition == 0, epoch).otherwise(F.least(epoch, F.lit(1)))

    def value(number: int, wide_key: bool = False) -> Column:
        fields = epoch_fields(number, wide_key)
        return _with_schema(_schema_json(fields, "row"), _text(*[f.name for f in fields]))

    last = value(2)
    if conflicts:
        last = F.when(F.col("user_id") % 4 == 0, value(2, wide_key=True)).otherwise(last)
    record = F.when(epoch == 0, value(0)).when(epoch == 1, value(1)).otherwise(last)
    key = _with_schema(_schema_json(KEY_FIELDS, "key"), _text(*KEYS))
    rows = event_rows(spark, sf_dir, dealt)
    return _feed(rows, table_topic(), key, F.when(~is_delete(), record), F.lit(0) if partition is None else partition)


def stored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the rows tables hold before the feed."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("app_t_"), F.col("c_custkey") % 16).alias("table"),
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("event_type"),
        F.col("c_acctbal").alias("value"),
    )


# Physical types and logical names the field rows are drawn from.
PHYSICAL_TYPES = [
    "INT8", "INT16", "INT32", "INT64", "FLOAT32", "FLOAT64", "BOOLEAN", "STRING", "BYTES", "STRUCT", "ARRAY", "MAP",
]
LOGICAL_NAMES = [
    None,
    rules.CONNECT_DECIMAL,
    rules.CONNECT_DATE,
    rules.CONNECT_TIME,
    rules.CONNECT_TIMESTAMP,
    rules.DEBEZIUM_DATE,
    rules.DEBEZIUM_TIMESTAMP,
    rules.DEBEZIUM_MICRO_TIMESTAMP,
    rules.DEBEZIUM_ZONED_TIMESTAMP,
    rules.DEBEZIUM_MICRO_TIME,
    rules.DEBEZIUM_YEAR,
    rules.DEBEZIUM_BITS,
    rules.DEBEZIUM_ENUM,
    rules.DEBEZIUM_ENUM_SET,
    rules.DEBEZIUM_JSON,
    "custom.Unknown",
]


def field_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record field per order, its types drawn by order and customer number."""
    physical = F.array(*[F.lit(t) for t in PHYSICAL_TYPES])
    logical = F.array(*[F.lit(t) for t in LOGICAL_NAMES])
    precision = F.when(F.col("o_orderpriority").startswith("5"), F.col("o_orderpriority")).when(
        ~F.col("o_orderpriority").startswith("4"), (F.col("o_custkey") % 20 + 10).cast("string")
    )
    scale = F.when(F.col("o_orderstatus") != "P", (F.col("o_orderkey") % 8).cast("string"))
    params = F.create_map(
        F.lit(rules.PRECISION_PARAMETER), precision, F.lit(rules.SCALE_PARAMETER), scale
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("t_"), F.col("o_custkey") % 16).alias("table"),
        F.concat(F.lit("c_"), F.col("o_orderkey")).alias("field"),
        F.get(physical, (F.col("o_orderkey") % len(PHYSICAL_TYPES)).cast("int")).alias("physical"),
        F.get(logical, (F.col("o_custkey") % len(LOGICAL_NAMES)).cast("int")).alias("logical"),
        params.alias("params"),
    )


# Sample names of the metric fixture.
READ_TOTAL = "records_read_total"
QUEUE_SIZE = "pool_queue_size"
CHECKPOINT = "checkpoint_duration_millis"
PAUSE_TOTAL = "pause_total_millis"
COUNTER_WRAP = 50


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sample per event and metric, one second apart, landed like a metric store's.

    The read counter of a feed restarts at every 50th record; one feed gets a
    third of all events. The pause counter is the running whole of the value.
    """
    feed = F.when(F.col("user_id") % 3 == 0, "feed_0").otherwise(F.concat(F.lit("feed_"), F.col("user_id") % 25))
    rows = table(spark, sf_dir, "events").select(
        feed.alias("feed"),
        F.concat(F.lit("node_"), F.col("user_id") % 4).alias("instance"),
        F.concat(F.lit("pool_"), F.col("user_id") % 3).alias("pool"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_add(
            "SECOND", F.col("event_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        ).alias("ts"),
        "value",
    )
    counted = running_total(rows, ["feed"], F.lit(1), "seen")
    counted = running_total(counted, ["instance"], F.floor(F.col("value") * 10), "paused")

    def sample(metric: str, value: Column, *labels: str) -> Column:
        pairs = [part for label in labels for part in (F.lit(label), F.col(label))]
        return F.struct(
            F.lit(metric).alias("metric"), F.create_map(*pairs).alias("labels"), value.cast("double").alias("value")
        )

    samples = F.array(
        sample(READ_TOTAL, F.col("seen") % COUNTER_WRAP, "feed"),
        sample(QUEUE_SIZE, F.floor(F.col("value") * 2500), "instance", "pool"),
        sample(CHECKPOINT, F.floor(F.col("value") * 500), "instance"),
        sample(PAUSE_TOTAL, F.col("paused"), "instance"),
    )
    exploded = counted.select("ts", F.explode(samples).alias("_s"))
    return landed(exploded.select("ts", "_s.metric", "_s.labels", "_s.value"), "metric_samples")
