"""Text and number forms of timestamps in a zone, as built-in expressions.

Inputs are instants (``timestamp``); results do not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedfold.functions.convert import utc_wall_clock


def in_zone(instant: Column, zone: str) -> Column:
    """Wall clock of an instant in a zone, as a zone-free timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall_clock(instant))


def _text(wall: Column, fraction_digits: int) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` and a fraction of fixed length, cut rather than rounded."""
    text = wall.cast("string")
    whole = F.substring(text, 1, 19)
    fraction = F.rpad(F.substring(text, 21, 6), fraction_digits, "0")
    return F.concat(whole, F.lit("."), fraction)


def date_text(instant: Column, zone: str) -> Column:
    return F.substring(in_zone(instant, zone).cast("string"), 1, 10)


def time_text(instant: Column, zone: str) -> Column:
    return F.substring(_text(in_zone(instant, zone), 3), 12, 12)


def timestamp_text(instant: Column, zone: str) -> Column:
    return _text(in_zone(instant, zone), 3)


def epoch_nanos(instant: Column) -> Column:
    return F.unix_micros(instant) * 1000


def epoch_nanos_text(instant: Column) -> Column:
    return epoch_nanos(instant).cast("string")


def iso_text(instant: Column, zone: str) -> Column:
    """ISO text with nine fraction digits; Spark holds six of them."""
    return F.replace(_text(in_zone(instant, zone), 9), F.lit(" "), F.lit("T"))


def from_epoch_nanos(nanos: Column) -> Column:
    """Instant of epoch nanoseconds, given as a number or as text."""
    whole = nanos.try_cast("bigint")
    return F.timestamp_micros(F.call_function("div", whole - F.pmod(whole, F.lit(1000)), F.lit(1000)))


ISO_PATTERN = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{9}$"


def from_iso_text(text: Column, zone: str) -> Column:
    """Instant of ISO text with nine fraction digits, read as a wall clock in a zone."""
    wall = F.when(text.rlike(ISO_PATTERN), F.substring(text, 1, 26)).try_cast("timestamp_ntz")
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, utc))
