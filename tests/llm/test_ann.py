"""Pruned graph search against all pairs."""

import math

import numpy as np

from feedfold.llm import ann


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, queries, k):
    rows = [(i, np.array(v)) for i, v in rows if usable(v)]
    out = {}
    for q, v in queries:
        if usable(v):
            v = np.array(v)
            near = {(-(v @ w) / math.sqrt((v @ v) * (w @ w)), i) for i, w in rows if i != q and len(w) == len(v)}
            out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.4 * rng.normal(size=16)).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # one vector at a quarter of all rows
    odd = [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [math.nan] * 16), (2004, [None] * 16), (2005, [math.inf] * 16)]
    frame = spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id long, embedding array<double>, v string")
    queries = [r for r in rows + odd if r[0] % 20 == 0]
    found = ann.search(frame, frame.where("vec_id % 20 = 0"), k=5, shard=250).collect()
    wanted, got = brute(rows, queries, 5), {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert got.keys() == wanted.keys() and all(len(g) == 5 for g in got.values())
    close = sum(s >= wanted[q][4][1] - 1e-12 for q, g in got.items() for _, s in g)
    assert close >= 0.97 * 5 * len(got)
    vectors = dict(rows)
    for q, near in got.items():
        assert [i for i, _ in near if i == q] == []
        for i, score in near:
            a, b = np.array(vectors[q]), np.array(vectors[i])
            assert abs(score - a @ b / math.sqrt((a @ a) * (b @ b))) < 1e-12


def test_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0, 1.0]), (0, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, schema)
    found = ann.search(frame, frame.where("vec_id = 0"), k=5).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(found)] == [(1, 1, 1.0), (2, 2, 0.0)]
    assert ann.search(frame, frame.where("vec_id = 3")).count() == 0
    assert ann.search(frame.limit(0), frame.limit(0)).count() == 0


def test_recall_of_full_shards(spark):
    """Two full shards at the production settings: clusters, and points without any structure, which are harder."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 32))
    for spread in (0.5, None):
        points = rng.normal(size=(2 * ann.SHARD, 32))
        if spread:
            points = centres[np.arange(len(points)) % 60] + spread * points
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(points.tolist())], "vec_id long, embedding array<double>")
        found = ann.search(frame, frame.where("vec_id % 50 = 0"), k=5).collect()
        units = points / np.linalg.norm(points, axis=1, keepdims=True)
        asked = np.arange(0, len(points), 50)
        near = units[asked] @ units.T
        near[np.arange(len(asked)), asked] = -2
        wanted = {(int(q), int(v)) for q, row in zip(asked, near, strict=True) for v in np.argsort(-row)[:5]}
        recall = len(wanted & {(r["query_id"], r["vec_id"]) for r in found}) / len(wanted)
        print(f"recall, spread {spread}: {recall:.3f}")
        assert recall >= 0.9
