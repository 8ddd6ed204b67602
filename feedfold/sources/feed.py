"""Reading change feeds: one row per record, payloads as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEED_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("ts", T.TimestampType(), True),
        T.StructField("key", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
    ]
)


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """A feed landed as parquet files."""
    return spark.read.schema(FEED_SCHEMA).parquet(path)


def stream_feed(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same files as a stream; ``max_files`` bounds each micro-batch."""
    reader = spark.readStream.schema(FEED_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def kafka_options(servers: str, topics: str, max_offsets: int | None = None) -> dict[str, str]:
    """Options of a topic-pattern subscription."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribePattern": topics,
        "startingOffsets": "earliest",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def _kafka_rows(source: DataFrame, binary: bool) -> DataFrame:
    kind = "binary" if binary else "string"
    return source.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("ts"),
        F.col("key").cast(kind).alias("key"),
        F.col("value").cast(kind).alias("value"),
    )


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topics: str,
    max_offsets: int | None = None,
    binary: bool = False,
) -> DataFrame:
    """Topics as a stream; needs Spark's Kafka package on the class path."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topics, max_offsets))
    return _kafka_rows(reader.load(), binary)


def read_kafka(spark: SparkSession, servers: str, topics: str, binary: bool = False) -> DataFrame:
    """Topics from first to last offset as a batch."""
    reader = spark.read.format("kafka").options(**kafka_options(servers, topics))
    return _kafka_rows(reader.load(), binary)
