"""Ordered scans over cells give what one window over the group gives."""

import random

import pytest
from pyspark.sql import functions as F

from feedfold.operators import ordered


def rows(count, seed):
    rng = random.Random(seed)
    groups = ["hot"] * 3 + ["a", "b"]
    return [
        (rng.choice(groups), rng.randrange(2), offset * rng.choice([1, 1, 7]) * 1000 + offset, rng.choice([None, "x", "y"]))
        for offset in range(count)
    ]


@pytest.mark.parametrize("span", [1, 10_000, 1 << 18])
def test_previous_value_and_total(spark, span):
    data = rows(300, span)
    frame = spark.createDataFrame(data, "g string, partition int, offset bigint, v string").repartition(5)
    before = ordered.previous_value(frame, ["g"], F.col("v"), "before", span)
    found = ordered.running_total(before, ["g"], F.col("v").isNotNull().cast("int"), "total", span)
    got = {(r.g, r.partition, r.offset): (r.before, r.total) for r in found.collect()}
    last, total, want = {}, {}, {}
    for g, p, o, v in sorted(data, key=lambda r: (r[1], r[2])):
        total[g] = total.get(g, 0) + (v is not None)
        want[g, p, o] = (last.get(g), total[g])
        last[g] = v if v is not None else last.get(g)
    assert got == want


def test_flush_segments(spark):
    frame = spark.range(1, 26).select(F.lit(0).alias("partition"), (F.col("id") * 3).alias("offset"))
    cut = ordered.flush_segments(frame, 10, ["partition"], span=16)
    sizes = dict(cut.groupBy("segment").count().collect())
    assert sizes == {0: 10, 1: 10, 2: 5}


def test_the_large_side_is_shuffled_by_cell(spark, capsys):
    frame = spark.range(10).select(F.lit("t").alias("g"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    ordered.running_total(frame, ["g"], F.lit(1), "n").explain()
    assert "_cell" in capsys.readouterr().out
