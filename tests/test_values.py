"""Names, types and value conversions, case by case."""

import base64
import datetime
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.functions import convert, rules, temporal
from feedfold.functions.convert import Field
from feedfold.operators.route import table_name
from feedfold.options import Options


def one(spark, column, value, kind="string"):
    frame = spark.createDataFrame([(value,)], f"x {kind}")
    return frame.select(column(F.col("x")).alias("y")).head()[0]


@pytest.mark.parametrize(
    "options, topic, table",
    [
        (Options(topic_prefix="shop01.sales_dev."), "shop01.sales_dev.t_day_quota", "t_day_quota"),
        (Options(), "shop01.sales_dev.t_day_quota", "shop01_sales_dev_t_day_quota"),
        (Options(topic_prefix="shop01."), "other.shop01.t", "other_shop01_t"),
        (Options(table_prefix="Test_"), "a.B", "test_a_b"),
        (Options(profile="row_cache", table_prefix="Test_"), "a.B", "Test_a_B"),
        (Options(dot_replacement=None), "a.b", "a.b"),
        (Options(dot_replacement="$1"), "a.b", "a$1b"),
        (Options(topic_prefix="a.b"), "a.b", ""),
    ],
)
def test_table_name(spark, options, topic, table):
    assert one(spark, lambda x: table_name(x, options), topic) == table


def test_options_from_properties():
    options = Options.from_properties(
        {
            "topic.replace.prefix": "db.",
            "message.extract": "debezium",
            "batch.size": "500",
            "delete.enabled": "false",
            "ignore-null-values": "false",
            "allow-record-fields-less-than-table-fields": "true",
            "default.partition.buckets": "7",
            "name": "x",
        }
    )
    assert options == Options(
        topic_prefix="db.", envelope="after", segment_rows=500, deletes=False,
        null_overwrites=False, allow_missing=True, buckets=7,
    )
    assert Options.from_properties({"message.extract": "other"}).envelope == "flat"
    assert Options.from_properties({"ignore-null-values": "false"}, "row_cache").null_overwrites
    with pytest.raises(ValueError):
        Options(profile="row_cache", null_overwrites=False)


def test_type_rules_are_distinct_and_complete():
    pairs = [(p, n) for p, n, _ in rules.TYPE_RULES]
    assert len(pairs) == len(set(pairs)) == 23
    for mapping in rules.COLUMN_TYPES.values():
        assert {i for _, _, i in rules.TYPE_RULES} == set(mapping)
    assert rules.internal_type("INT32", rules.DEBEZIUM_MICRO_TIME) == rules.OTHER
    assert rules.internal_type("STRUCT", None) == rules.OTHER


def as_decimal(x, target, options=Options()):  # noqa: B008
    spec = Field("d", "BYTES", rules.CONNECT_DECIMAL)
    return convert.decimal_value(convert.prepare(x, spec, options), target, options)


def packed(number, length=None):
    length = length or (number.bit_length() + 8) // 8
    return base64.b64encode(number.to_bytes(length, "big", signed=True)).decode()


EDGES = [0, 1, -1, 127, 128, -128, -129, 2**63 - 1, -(2**63), 2**63, 2**64, -(2**64), 10**37, -(10**37), 10**38 - 1]


@pytest.mark.parametrize("number", EDGES)
@pytest.mark.parametrize("length", [None, 16, 20])
def test_decimal_bytes(spark, number, length):
    target = T.DecimalType(38, 6)
    expected = decimal.Decimal(number).scaleb(-6, decimal.Context(prec=60))
    found = one(spark, lambda x: as_decimal(x, target), packed(number, length))
    assert found == expected


def test_decimal_text_and_overflow(spark):
    target = T.DecimalType(6, 2)
    numeric = Options(decimal_format="numeric")
    for text, want in (("12.5", "12.50"), ("-7", "-7.00"), ("1234", "1234.00")):
        assert one(spark, lambda x: as_decimal(x, target, numeric), text) == decimal.Decimal(want)  # noqa: B023
    # bytes before the last 16 may only extend the sign
    wide = T.DecimalType(38, 2)
    for number, length in ((700, 17), (-700, 20), (5, 40)):
        found = one(spark, lambda x: as_decimal(x, wide), packed(number, length))
        assert found == decimal.Decimal(number).scaleb(-2)
    for number in (2**128 + 700, -(2**128) - 5, 2**127, 255 << 128):
        assert one(spark, lambda x: as_decimal(x, wide), packed(number, 18)) is None
    assert one(spark, lambda x: as_decimal(x, target), packed(10**9)) is None
    assert one(spark, lambda x: as_decimal(x, target), "!!") is None


def test_decimal_parameters():
    assert Field("d", "BYTES", rules.CONNECT_DECIMAL).decimal_type() == T.DecimalType(20, 4)
    odd = {"connect.decimal.precision": "x", "scale": "2"}
    assert Field("d", "BYTES", rules.CONNECT_DECIMAL, odd).decimal_type() == T.DecimalType(20, 2)


def at(text):
    return datetime.datetime.fromisoformat(text)


@pytest.mark.parametrize(
    "spec, raw, kind, text",
    [
        (Field("t", "INT64", rules.CONNECT_TIMESTAMP), 0, "bigint", "1969-12-31 16:00:00"),
        (Field("t", "INT64", rules.DEBEZIUM_TIMESTAMP), 28_800_123, "bigint", "1970-01-01 00:00:00.123"),
        (Field("t", "INT64", rules.DEBEZIUM_MICRO_TIMESTAMP), 1_234_567, "bigint", "1970-01-01 00:00:01.234"),
        (Field("t", "INT64", rules.DEBEZIUM_MICRO_TIMESTAMP), -1_999, "bigint", "1969-12-31 23:59:59.999"),
        (Field("t", "STRING", rules.DEBEZIUM_ZONED_TIMESTAMP), "2024-01-02T03:04:05.678999Z", "string",
         "2024-01-02 03:04:05.678"),
        (Field("t", "STRING", rules.DEBEZIUM_ZONED_TIMESTAMP), "2024-01-02T03:04:05+02:00", "string",
         "2024-01-02 01:04:05"),
        (Field("t", "STRING", rules.DEBEZIUM_ZONED_TIMESTAMP), "yesterday", "string", None),
        (Field("t", "STRING", rules.DEBEZIUM_ZONED_TIMESTAMP), "2024-01-02T03:04:05", "string", None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps(spark, spec, raw, kind, text, zone):
    lake = Options(profile="lake")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = one(spark, lambda x: convert.convert(x, spec, lake), raw, kind)
        shown = one(spark, lambda x: convert.utc_wall_clock(convert.convert(x, spec, Options())), raw, kind)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert found == text
    assert shown == (at(text) if text else None)


def test_micro_exact_keeps_micros(spark):
    spec = Field("t", "INT64", rules.DEBEZIUM_MICRO_TIMESTAMP)
    options = Options(micro_exact=True)
    shown = one(spark, lambda x: convert.utc_wall_clock(convert.convert(x, spec, options)), 1_234_567, "bigint")
    assert shown == at("1970-01-01 00:00:01.234567")


@pytest.mark.parametrize(
    "logical, physical, raw, text",
    [
        (rules.CONNECT_TIME, "INT32", 3_723_999, "01:02:03"),
        (rules.CONNECT_TIME, "INT32", 86_400_000, None),
        (rules.DEBEZIUM_MICRO_TIME, "INT64", 86_399_999_999, "23:59:59"),
        (rules.DEBEZIUM_MICRO_TIME, "INT64", -1, None),
        (rules.DEBEZIUM_DATE, "INT32", -1, "1969-12-31"),
        (rules.CONNECT_DATE, "INT32", 19_782, "2024-02-29"),
    ],
)
def test_times_and_dates(spark, logical, physical, raw, text):
    spec = Field("t", physical, logical)
    assert one(spark, lambda x: convert.convert(x, spec, Options()), raw, "bigint" if physical == "INT64" else "int") == text


def test_date_of_row_cache_is_a_date(spark):
    spec = Field("t", "INT32", rules.CONNECT_DATE)
    options = Options(profile="row_cache")
    assert one(spark, lambda x: convert.convert(x, spec, options), 0, "int") == datetime.date(1970, 1, 1)


def test_unsupported_field_raises(spark):
    with pytest.raises(ValueError):
        convert.convert(F.col("x"), Field("x", "MAP"), Options())


def test_column_schema():
    fields = [Field("id", "INT64"), Field("day", "INT32", rules.CONNECT_DATE)]
    shape = convert.column_schema(fields, ["id"], "column_table")
    assert shape == T.StructType([T.StructField("id", T.LongType(), False), T.StructField("day", T.StringType())])


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_temporal_round_trip(spark, zone):
    micros = 1_700_000_000_123_456
    instant = F.timestamp_micros(F.lit(micros))
    text, back, nanos = (
        spark.range(1)
        .select(
            temporal.iso_text(instant, zone).alias("a"),
            F.unix_micros(temporal.from_iso_text(temporal.iso_text(instant, zone), zone)).alias("b"),
            F.unix_micros(temporal.from_epoch_nanos(temporal.epoch_nanos_text(instant))).alias("c"),
        )
        .head()
    )
    assert back == nanos == micros and text.endswith("123456000")


def test_nanos_before_1970(spark):
    found = one(spark, lambda x: F.unix_micros(temporal.from_epoch_nanos(x)), -1, "bigint")
    assert found == -1
