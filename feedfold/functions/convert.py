"""Conversions from raw field values to column values, as built-in expressions.

None depends on the session time zone, and none raises on a bad value: it
gives null, which the typed projection reports as a reject.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.functions import rules
from feedfold.options import Options

MICROS_PER_DAY = 86_400_000_000
MILLIS_PER_DAY = 86_400_000
MILLIS_PER_HOUR = 3_600_000


@dataclass(frozen=True)
class Field:
    """One field of a record schema."""

    name: str
    physical: str
    logical: str | None = None
    params: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def internal(self) -> str:
        return rules.internal_type(self.physical, self.logical)

    @property
    def raw_type(self) -> T.DataType:
        """Type to parse the JSON field as; nested values stay text."""
        return rules.RAW_TYPES.get(self.physical, T.StringType())

    def decimal_type(self) -> T.DecimalType:
        precision = _whole_number(self.params.get(rules.PRECISION_PARAMETER), rules.DEFAULT_PRECISION)
        scale = _whole_number(self.params.get(rules.SCALE_PARAMETER), rules.DEFAULT_SCALE)
        return T.DecimalType(precision, scale)

    def column_type(self, profile: str) -> T.DataType:
        """Spark type of the finished column."""
        if self.internal == "DECIMAL":
            return self.decimal_type()
        if self.internal == "DATE" and profile != "row_cache":
            return T.StringType()
        if self.internal == "TIMESTAMP" and profile == "lake":
            return T.StringType()
        return rules.SPARK_TYPES[self.internal]


def _whole_number(text: str | None, default: int) -> int:
    try:
        return default if text is None else int(text)
    except ValueError:
        return default


def wall_clock(micros: Column) -> Column:
    """Zone-free timestamp that lies the given microseconds after 1970."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", micros, epoch)


def utc_wall_clock(instant: Column) -> Column:
    """UTC reading of an instant as a zone-free timestamp."""
    return wall_clock(F.unix_micros(instant))


def time_text(seconds_of_day: Column) -> Column:
    """``HH:mm:ss`` of a second within the day."""
    pad = lambda part: F.lpad(part.cast("string"), 2, "0")
    return F.concat_ws(
        ":",
        pad(F.floor(seconds_of_day / 3600)),
        pad(F.floor(seconds_of_day % 3600 / 60)),
        pad(seconds_of_day % 60),
    )


def micro_time(micros: Column) -> Column:
    """Microseconds of the day as text; null outside the day."""
    inside = (micros >= 0) & (micros < MICROS_PER_DAY)
    return F.when(inside, time_text(F.floor(micros / 1_000_000)))


def connect_time(millis: Column) -> Column:
    """Milliseconds of the day as wall-clock text."""
    inside = (millis >= 0) & (millis < MILLIS_PER_DAY)
    return F.when(inside, time_text(F.floor(millis / 1000)))


def epoch_date(days: Column) -> Column:
    return F.date_from_unix_date(days)


def shifted_millis(millis: Column, offset_hours: int) -> Column:
    """Milliseconds of a source-zone wall clock as an instant."""
    return F.timestamp_millis(millis - F.lit(offset_hours * MILLIS_PER_HOUR).cast("bigint"))


def micro_timestamp(micros: Column, exact: bool = False) -> Column:
    """Microseconds as an instant, cut to milliseconds toward zero unless ``exact``."""
    if exact:
        return F.timestamp_micros(micros)
    cut = micros - F.when(micros >= 0, F.pmod(micros, F.lit(1000))).otherwise(
        -F.pmod(-micros, F.lit(1000))
    )
    return F.timestamp_micros(cut)


ISO_INSTANT = r"^[+-]?\d{4,}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d{1,9})?)?(Z|[+-]\d\d(:?\d\d(:?\d\d)?)?)$"


def zoned_timestamp(text: Column) -> Column:
    """ISO-8601 text with a zone as an instant, cut to milliseconds."""
    instant = F.when(text.rlike(ISO_INSTANT), text).try_cast("timestamp")
    micros = F.unix_micros(instant)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(1000)))


def prepare(raw: Column, spec: Field, options: Options) -> Column:
    """First step of a conversion, done in a projection of its own.

    The bytes of a decimal become hex digits, which the second step looks at
    several times. A decimal that is sent as a number stays as it is.
    """
    if spec.internal != "DECIMAL" or options.decimal_format == "numeric":
        return raw
    return F.hex(F.try_to_binary(raw, F.lit("base64")))


def hex_decimal(digits: Column, target: T.DecimalType) -> Column:
    """Hex digits of a two's-complement big-endian number, scaled.

    Up to eight bytes are one 64-bit number; more, sign-extended to 16 bytes,
    are two of them. Bytes before the last 16 may only extend the sign, else
    the number is beyond any decimal and gives null.
    """
    fill = F.when(F.substring(digits, 1, 1) >= "8", "F").otherwise("0")
    short = F.conv(F.lpad(digits, 16, fill), 16, -10)
    last = F.right(digits, F.lit(32))
    wide = F.lpad(last, 32, fill)
    high = F.conv(F.substring(wide, 1, 16), 16, -10).cast("decimal(38,0)")
    low = F.conv(F.substring(wide, 17, 16), 16, 10).cast("decimal(38,0)")
    step = F.lit("18446744073709551616").cast("decimal(38,0)")
    long = F.try_add(F.try_multiply(high, step), low).cast("string")
    # the sign's digit repeated in front, and a number behind that has the same sign
    spare = F.left(digits, F.length(digits) - 32)
    same_sign = (F.substring(last, 1, 1) >= "8") == (fill == "F")
    fits = (F.translate(spare, "F", "") == F.when(fill == "F", "").otherwise(spare)) & (
        F.translate(spare, "0", "") == F.when(fill == "F", spare).otherwise("")
    )
    unscaled = (
        F.when(F.length(digits) <= 16, short).when(F.length(digits) <= 32, long).when(fits & same_sign, long)
    )
    return F.concat(unscaled, F.lit(f"E-{target.scale}")).try_cast(target)


def decimal_value(prepared: Column, target: T.DecimalType, options: Options) -> Column:
    """A prepared decimal: hex digits, or a number in text."""
    return prepared.try_cast(target) if options.decimal_format == "numeric" else hex_decimal(prepared, target)


def convert(raw: Column, spec: Field, options: Options) -> Column:
    """Column value of one prepared field value."""
    internal = spec.internal
    if internal == rules.OTHER:
        raise ValueError(f"field {spec.name}: no column type for {spec.physical}/{spec.logical}")
    if internal == "BYTES":
        return F.try_to_binary(raw, F.lit("base64"))
    if internal == "DECIMAL":
        return decimal_value(raw, spec.decimal_type(), options)
    if internal == "DATE":
        date = epoch_date(raw)
        return date if options.profile == "row_cache" else date.cast("string")
    if internal == "TIME":
        return micro_time(raw) if spec.logical == rules.DEBEZIUM_MICRO_TIME else connect_time(raw)
    if internal == "TIMESTAMP":
        if spec.logical == rules.DEBEZIUM_ZONED_TIMESTAMP:
            instant = zoned_timestamp(raw)
        elif spec.logical == rules.DEBEZIUM_MICRO_TIMESTAMP:
            instant = micro_timestamp(raw, options.micro_exact)
        else:
            instant = shifted_millis(raw, options.source_utc_offset_hours)
        if options.profile == "lake":
            return utc_wall_clock(instant).cast("string")
        return instant
    return raw.try_cast(rules.SPARK_TYPES[internal])


def raw_schema(fields: list[Field]) -> T.StructType:
    """Schema to parse the JSON payload with."""
    return T.StructType([T.StructField(f.name, f.raw_type, True) for f in fields])


def column_schema(fields: list[Field], keys: list[str], profile: str) -> T.StructType:
    """Schema of the finished columns: keys are never null."""
    return T.StructType(
        [T.StructField(f.name, f.column_type(profile), f.name not in keys) for f in fields]
    )


# Internal types whose parsed value always converts.
SAFE = {"TINYINT", "SHORT", "INT", "LONG", "FLOAT", "DOUBLE", "BOOLEAN", "STRING", "DATE"}


def typed(rows: DataFrame, payload: str, fields: list[Field], options: Options, prefix: str = "") -> DataFrame:
    """Replace the parsed ``payload`` struct by finished columns, and add ``failed``.

    ``failed`` lists the fields whose raw value is there and whose column value
    is not. Each step is a projection of its own, so nothing is computed twice.
    """
    kept = [c for c in rows.columns if c != payload]
    raw = {f.name: f"_raw_{f.name}" for f in fields}
    checked = [f for f in fields if f.internal not in SAFE]
    had = [F.col(payload)[f.name].isNotNull().alias(f"_had_{f.name}") for f in checked]
    prepared = rows.select(
        *kept, *[prepare(F.col(payload)[f.name], f, options).alias(raw[f.name]) for f in fields], *had
    )
    finished = prepared.select(
        *kept,
        *[convert(F.col(raw[f.name]), f, options).alias(prefix + f.name) for f in fields],
        *[f"_had_{f.name}" for f in checked],
    )
    flags = [F.when(F.col(f"_had_{f.name}") & F.col(prefix + f.name).isNull(), f.name) for f in checked]
    failed = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
    return finished.select(*kept, *[prefix + f.name for f in fields], failed.alias("failed"))
