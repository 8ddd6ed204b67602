"""Field types of a change record and the column types they become."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Logical type names carried by record schemas.
CONNECT_DECIMAL = "org.apache.kafka.connect.data.Decimal"
CONNECT_DATE = "org.apache.kafka.connect.data.Date"
CONNECT_TIME = "org.apache.kafka.connect.data.Time"
CONNECT_TIMESTAMP = "org.apache.kafka.connect.data.Timestamp"
DEBEZIUM_DATE = "io.debezium.time.Date"
DEBEZIUM_TIMESTAMP = "io.debezium.time.Timestamp"
DEBEZIUM_MICRO_TIMESTAMP = "io.debezium.time.MicroTimestamp"
DEBEZIUM_ZONED_TIMESTAMP = "io.debezium.time.ZonedTimestamp"
DEBEZIUM_MICRO_TIME = "io.debezium.time.MicroTime"
DEBEZIUM_YEAR = "io.debezium.time.Year"
DEBEZIUM_BITS = "io.debezium.data.Bits"
DEBEZIUM_ENUM = "io.debezium.data.Enum"
DEBEZIUM_ENUM_SET = "io.debezium.data.EnumSet"
DEBEZIUM_JSON = "io.debezium.data.Json"

OTHER = "OTHER"

# Fixed values: (physical type, logical name) -> internal type.
TYPE_RULES = [
    ("INT8", None, "TINYINT"),
    ("INT16", None, "SHORT"),
    ("INT32", None, "INT"),
    ("INT64", None, "LONG"),
    ("FLOAT32", None, "FLOAT"),
    ("FLOAT64", None, "DOUBLE"),
    ("BOOLEAN", None, "BOOLEAN"),
    ("STRING", None, "STRING"),
    ("BYTES", None, "BYTES"),
    ("BYTES", CONNECT_DECIMAL, "DECIMAL"),
    ("INT32", CONNECT_DATE, "DATE"),
    ("INT32", DEBEZIUM_DATE, "DATE"),
    ("INT64", CONNECT_TIMESTAMP, "TIMESTAMP"),
    ("INT64", DEBEZIUM_TIMESTAMP, "TIMESTAMP"),
    ("STRING", DEBEZIUM_ZONED_TIMESTAMP, "TIMESTAMP"),
    ("INT64", DEBEZIUM_MICRO_TIMESTAMP, "TIMESTAMP"),
    ("INT32", CONNECT_TIME, "TIME"),
    ("INT64", DEBEZIUM_MICRO_TIME, "TIME"),
    ("INT32", DEBEZIUM_YEAR, "INT"),
    ("BYTES", DEBEZIUM_BITS, "BYTES"),
    ("STRING", DEBEZIUM_ENUM, "STRING"),
    ("STRING", DEBEZIUM_ENUM_SET, "STRING"),
    ("STRING", DEBEZIUM_JSON, "STRING"),
]

# Internal type -> column type, per profile.
COLUMN_TYPES = {
    "column_table": {
        "TINYINT": "INT8",
        "SHORT": "INT16",
        "INT": "INT32",
        "LONG": "INT64",
        "FLOAT": "FLOAT",
        "DOUBLE": "DOUBLE",
        "BOOLEAN": "BOOL",
        "STRING": "STRING",
        "BYTES": "BINARY",
        "DECIMAL": "DECIMAL",
        "DATE": "STRING",
        "TIME": "STRING",
        "TIMESTAMP": "UNIXTIME_MICROS",
    },
    "row_cache": {
        "TINYINT": "TINYINT",
        "SHORT": "SHORT",
        "INT": "INT",
        "LONG": "LONG",
        "FLOAT": "FLOAT",
        "DOUBLE": "DOUBLE",
        "BOOLEAN": "BOOLEAN",
        "STRING": "STRING",
        "BYTES": "BYTES",
        "DECIMAL": "DECIMAL",
        "DATE": "DATE",
        "TIME": "TIME",
        "TIMESTAMP": "TIMESTAMP",
    },
    "lake": {
        "TINYINT": "Byte",
        "SHORT": "Short",
        "INT": "Integer",
        "LONG": "Long",
        "FLOAT": "Float",
        "DOUBLE": "Double",
        "BOOLEAN": "Boolean",
        "STRING": "String",
        "BYTES": "byte[]",
        "DECIMAL": "BigDecimal",
        "DATE": "String",
        "TIME": "String",
        "TIMESTAMP": "String",
    },
}

# Spark types of the raw JSON field, by physical type. Bytes travel as base64 text.
RAW_TYPES = {
    "INT8": T.ByteType(),
    "INT16": T.ShortType(),
    "INT32": T.IntegerType(),
    "INT64": T.LongType(),
    "FLOAT32": T.FloatType(),
    "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "STRING": T.StringType(),
    "BYTES": T.StringType(),
}

# Spark types of the finished column, by internal type. DECIMAL depends on its parameters.
SPARK_TYPES = {
    "TINYINT": T.ByteType(),
    "SHORT": T.ShortType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "STRING": T.StringType(),
    "BYTES": T.BinaryType(),
    "DATE": T.DateType(),
    "TIME": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
}

DEFAULT_PRECISION = 20
DEFAULT_SCALE = 4
PRECISION_PARAMETER = "connect.decimal.precision"
SCALE_PARAMETER = "scale"


def internal_type(physical: str, logical: str | None) -> str:
    """Internal type of one field, on the driver."""
    for rule_physical, rule_logical, internal in TYPE_RULES:
        if (physical, logical) == (rule_physical, rule_logical):
            return internal
    return OTHER


def type_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TYPE_RULES, "physical string, logical string, internal string")


def column_type_rules(spark: SparkSession) -> DataFrame:
    rows = [
        (profile, internal, column)
        for profile, mapping in COLUMN_TYPES.items()
        for internal, column in mapping.items()
    ]
    return spark.createDataFrame(rows, "profile string, internal string, column_type string")


def resolve_types(fields: DataFrame) -> DataFrame:
    """Add ``internal`` to rows with ``physical`` and ``logical``.

    The rule table has a fixed 23 rows, so it is always broadcast.
    """
    rules = type_rules(fields.sparkSession).select(
        F.col("physical").alias("_physical"), F.col("logical").alias("_logical"), "internal"
    )
    matched = fields.join(
        F.broadcast(rules),
        (F.col("physical") == F.col("_physical")) & F.col("logical").eqNullSafe(F.col("_logical")),
        "left",
    )
    return matched.drop("_physical", "_logical").withColumn(
        "internal", F.coalesce("internal", F.lit(OTHER))
    )


def target_types(fields: DataFrame, profile: str) -> DataFrame:
    """Add ``column_type``, null where the internal type has no column type."""
    rules = (
        column_type_rules(fields.sparkSession)
        .filter(F.col("profile") == profile)
        .select(F.col("internal").alias("_internal"), "column_type")
    )
    return fields.join(F.broadcast(rules), F.col("internal") == F.col("_internal"), "left").drop(
        "_internal"
    )


def whole_number_or(text: Column, default: int) -> Column:
    """The integer a parameter holds, or the default where it is missing or not a number."""
    return F.coalesce(
        F.when(text.rlike(r"^[+-]?[0-9]+$"), text).try_cast("int"), F.lit(default)
    )


def decimal_attributes(fields: DataFrame) -> DataFrame:
    """Add ``precision`` and ``scale`` from the ``params`` map of each field."""
    return fields.withColumn(
        "precision", whole_number_or(F.col("params")[PRECISION_PARAMETER], DEFAULT_PRECISION)
    ).withColumn("scale", whole_number_or(F.col("params")[SCALE_PARAMETER], DEFAULT_SCALE))
