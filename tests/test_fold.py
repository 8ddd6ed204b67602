"""The fold against a plain loop over records, and its algebra."""

import random

import pytest
from pyspark.sql import functions as F

from feedfold.operators import fold

SCHEMA = "k int, partition int, offset bigint, op string, a string, b int, has_a boolean, has_b boolean"
GROUPS = {"ga": ["a"], "gb": ["b"]}


def present():
    return {"ga": F.col("has_a"), "gb": F.col("has_b")}


def log(seed, count=200, keys=12):
    rng = random.Random(seed)
    out = []
    for offset in range(count):
        op = rng.choice("uuud")
        a, b = rng.choice([None, "p", "q"]), rng.choice([None, 1, 2])
        up = op == "u"
        out.append(
            (rng.choice([0] * 4 + list(range(keys))), 0, offset, op, a if up else None, b if up else None,
             up and rng.random() < 0.6, up and rng.random() < 0.6)
        )
    return out


def replay(records, state=None):
    """What a writer that applies one record at a time would hold."""
    state = {k: dict(v) for k, v in (state or {}).items()}
    for k, _, _, op, a, b, has_a, has_b in sorted(records, key=lambda r: (r[1], r[2])):
        if op == "d":
            state.pop(k, None)
            continue
        row = state.setdefault(k, {"a": None, "b": None})
        if has_a:
            row["a"] = a
        if has_b:
            row["b"] = b
    return {k: (v["a"], v["b"]) for k, v in state.items()}


def collected(frame):
    return {r.k: (r.a, r.b) for r in frame.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_fold_is_replay(spark, seed):
    records = log(seed)
    random.Random(seed).shuffle(records)
    frame = spark.createDataFrame(records, SCHEMA).repartition(4)
    assert collected(fold.fold(frame, ["k"], GROUPS, present())) == replay(records)


def test_fold_over_stored_rows(spark):
    records, old = log(7, 60), {k: {"a": f"s{k}", "b": -k} for k in range(0, 20, 2)}
    stored = spark.createDataFrame([(k, v["a"], v["b"]) for k, v in old.items()], "k int, a string, b int")
    found = fold.fold(spark.createDataFrame(records, SCHEMA), ["k"], GROUPS, present(), stored)
    assert collected(found) == replay(records, old)


@pytest.mark.parametrize("cuts", [[50, 120], [1, 2, 3, 199], [100]])
def test_fold_is_associative(spark, cuts):
    records = log(3)
    whole = None
    for start, end in zip([0, *cuts], [*cuts, len(records)], strict=True):
        frame = spark.createDataFrame(records[start:end], SCHEMA)
        part = fold.combine(fold.patches(frame, ["k"], GROUPS, present()), ["k"], GROUPS)
        whole = part if whole is None else fold.combine(whole.unionByName(part), ["k"], GROUPS)
    assert collected(fold.live_rows(whole, ["k"], GROUPS)) == replay(records)


def test_fold_is_idempotent(spark):
    frame = spark.createDataFrame(log(5), SCHEMA)
    rows = fold.patches(frame, ["k"], GROUPS, present())
    once = fold.combine(rows, ["k"], GROUPS)
    twice = fold.combine(once.unionByName(once), ["k"], GROUPS)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_latest_and_replace(spark):
    records = log(9)
    frame = spark.createDataFrame(records, SCHEMA)
    always = [r[:6] + (r[3] == "u", r[3] == "u") for r in records]
    assert collected(fold.latest(frame, ["k"], "a", "b")) == replay(always)


def test_presence_groups():
    groups = fold.presence_groups(["a", "b", "c", "d"], [{"a", "b"}, {"a", "b", "c"}])
    assert sorted(groups.values()) == [["a", "b"], ["c"], ["d"]]


def test_fold_combines_before_the_shuffle(spark, capsys):
    frame = spark.createDataFrame(log(1), SCHEMA)
    fold.fold(frame, ["k"], GROUPS, present()).explain()
    plan = capsys.readouterr().out
    assert "partial_max_by" in plan and plan.count("Exchange") == 1 and "Window" not in plan


def test_delete_rows_of_absent_keys(spark):
    stored = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    deletes = spark.createDataFrame([(2,), (2,), (3,)], "k int")
    assert [tuple(r) for r in fold.delete_rows(stored, deletes, ["k"]).collect()] == [(1, "x")]
