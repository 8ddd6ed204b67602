"""Ordered scans over groups of any size.

A window over a whole table's feed would put a hot table into one task. Here
each group is cut into cells of ``span`` offsets. Offsets are unique within a
topic partition, so a cell holds at most ``span`` records per topic. A window
works inside each cell, and a second window over one summary row per cell
carries the state from cell to cell. The result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = 1 << 18
_CELL = "_cell"


def _with_cells(rows: DataFrame, span: int) -> DataFrame:
    return rows.withColumn(_CELL, F.call_function("div", F.col("offset"), F.lit(span)))


def _attach_carry(local: DataFrame, carry: DataFrame, cells: list[str]) -> DataFrame:
    return local.join(carry, cells, "left").drop(_CELL)


def previous_value(
    rows: DataFrame, group: list[str], value: Column, name: str, span: int = SPAN
) -> DataFrame:
    """Add the last non-null ``value`` before each row, in (partition, offset) order."""
    cells = [*dict.fromkeys([*group, "partition"]), _CELL]
    rows = _with_cells(rows, span).withColumn("_value", value)
    inside = Window.partitionBy(*cells).orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.last("_value", ignorenulls=True).over(inside))
    across = (
        Window.partitionBy(*group)
        .orderBy("partition", _CELL)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        rows.groupBy(*cells)
        .agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("offset"))).alias("_tail"))
        .withColumn("_carry", F.last("_tail", ignorenulls=True).over(across))
        .select(*cells, "_carry")
    )
    return (
        _attach_carry(local, carry, cells)
        .withColumn(name, F.coalesce("_local", "_carry"))
        .drop("_value", "_local", "_carry")
    )


def running_total(
    rows: DataFrame, group: list[str], amount: Column, name: str, span: int = SPAN
) -> DataFrame:
    """Add the sum of ``amount`` up to and with each row, in (partition, offset) order."""
    cells = [*dict.fromkeys([*group, "partition"]), _CELL]
    rows = _with_cells(rows, span).withColumn("_amount", amount.cast("bigint"))
    inside = Window.partitionBy(*cells).orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_local", F.sum("_amount").over(inside))
    across = (
        Window.partitionBy(*group)
        .orderBy("partition", _CELL)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        rows.groupBy(*cells)
        .agg(F.sum("_amount").alias("_total"))
        .withColumn("_carry", F.sum("_total").over(across))
        .select(*cells, "_carry")
    )
    return (
        _attach_carry(local, carry, cells)
        .withColumn(name, F.col("_local") + F.coalesce("_carry", F.lit(0)))
        .drop("_amount", "_local", "_carry")
    )


def flush_segments(rows: DataFrame, segment_rows: int, group: list[str], span: int = SPAN) -> DataFrame:
    """Number the write segments of ``segment_rows`` applied rows within each group."""
    numbered = running_total(rows, group, F.lit(1), "_row", span)
    return numbered.withColumn(
        "segment", F.call_function("div", F.col("_row") - 1, F.lit(segment_rows))
    ).drop("_row")
