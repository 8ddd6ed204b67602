"""Approximate nearest neighbours by cosine: a robust-pruned directed graph per shard.

Vectors are dealt into shards by a hash, so that no shard depends on the
data's order or skew. Equal vectors are one node that lists its smallest ids:
one more than are asked for are enough, since a query leaves out only itself.
Each shard builds its graph in two passes: a greedy search from the shard's
medoid proposes the nodes on its way as neighbours, relaxed distance pruning (a
candidate goes when a kept neighbour is ``ALPHA`` times closer to it than the
node is) keeps diverse edges, and reverse edges are pruned in the same way where a node has
too many. Queries are cut into blocks; every block meets every shard, a beam
search finds its nearest nodes there, and each shard's best are merged per
query. Scores are computed again in double precision on the original vectors.

Every vector is indexed; there is no sample. Work per query grows with the
number of shards, that is with the table, by the logarithm of a shard each.

Defined cases: vectors that are null, empty, zero or hold nulls or non-finite
components take no part, as queries or candidates; vectors of another length than most
queries' compare with those of their own length only. Ties go to the smaller id. A query's own rows (rows
of its id) are no candidates; rows that repeat an id and vector count once.
A query without candidates gives no row. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedfold.llm.common import landed

SHARD = 4_000
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 96
ALPHA = 1.2
#: Points that are put into a graph together, and queries of a block.
STEP = 512
BLOCK = 8_192


def unit(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(axis=1, keepdims=True)
    rows = rows / largest  # no overflow or underflow in the squares
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def beam_search(units: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes that greedy search finds per query, nearest first (-1 where fewer), and similarities.

    All queries of a block take their steps together: each opens the nearest
    node of its beam that it has not opened yet, until none has one left.
    """
    n, q = len(units), len(queries)
    ids = np.full((q, beam), -1, np.int64)
    near = np.full((q, beam), -np.inf)
    opened = np.ones((q, beam), bool)
    ids[:, 0], near[:, 0], opened[:, 0] = start, queries @ units[start], False
    seen = np.zeros((q, n), bool)
    seen[:, start] = True
    live = np.arange(q)
    while len(live):
        closed = np.where(opened[live], -np.inf, near[live])
        at = closed.argmax(axis=1)
        left = closed[np.arange(len(live)), at] > -np.inf
        live, at = live[left], at[left]
        if not len(live):
            break
        node = ids[live, at]
        opened[live, at] = True
        out = graph[node]
        fresh = (out >= 0) & ~seen[live[:, None], np.maximum(out, 0)]
        row, col = np.nonzero(fresh)
        seen[live[row], out[row, col]] = True
        gain = np.full(out.shape, -np.inf)
        gain[row, col] = np.einsum("ij,ij->i", queries[live[row]], units[out[row, col]])
        every = np.concatenate([near[live], gain], axis=1)
        best = np.argsort(-every, axis=1, kind="stable")[:, :beam]
        near[live] = np.take_along_axis(every, best, axis=1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], np.where(fresh, out, -1)], axis=1), best, axis=1)
        opened[live] = np.take_along_axis(np.concatenate([opened[live], ~fresh], axis=1), best, axis=1)
        empty = near[live] == -np.inf
        ids[live] = np.where(empty, -1, ids[live])
        opened[live] = opened[live] | empty
    return ids, near


def pruned(units: np.ndarray, node: int, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning of a node's candidate neighbours."""
    candidates = np.unique(candidates[(candidates >= 0) & (candidates != node)])
    far = 1 - units[candidates] @ units[node]
    order = np.argsort(far, kind="stable")
    candidates, far = candidates[order], far[order]
    kept: list[int] = []
    alive = np.ones(len(candidates), bool)
    between = 1 - units[candidates] @ units[candidates].T
    for i in range(len(candidates)):
        if alive[i]:
            kept.append(i)
            if len(kept) == degree:
                break
            alive &= alpha * between[i] > far
    return candidates[kept]


def build(units: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Out-neighbours of every node (-1 pads) and the node where searches start."""
    n = len(units)
    width = degree + degree // 2  # room for reverse edges, so that pruning is rare
    graph = np.full((n, width), -1, np.int64)
    size = np.zeros(n, np.int64)
    mean = units.mean(axis=0)
    start = int(np.argmax(units @ mean))
    order = np.random.default_rng(n).permutation(n)
    for factor in (1.0, alpha):
        for at in range(0, n, STEP):
            some = order[at : at + STEP]
            found, _ = beam_search(units, graph, start, units[some], beam)
            for node, near in zip(some, found, strict=True):
                # the points of a step do not know each other yet: they are candidates, too
                close = some[np.argsort(-(units[some] @ units[node]), kind="stable")[: degree // 2]]
                out = pruned(units, node, np.concatenate([near, graph[node], close]), degree, factor)
                graph[node] = -1
                graph[node, : len(out)] = out
                size[node] = len(out)
                for other in out:
                    if node in graph[other, : size[other]]:
                        continue
                    if size[other] < width:
                        graph[other, size[other]] = node
                        size[other] += 1
                    else:
                        back = pruned(units, other, np.append(graph[other], node), degree, factor)
                        graph[other] = -1
                        graph[other, : len(back)] = back
                        size[other] = len(back)
    return graph, start


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, dims) of rows that take part, vectors as doubles."""
    vector = F.col(vector_col).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    rows = rows.where((F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0))
    return rows.withColumn("dims", F.size("v"))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(v, dims, ids): each vector once, with its k + 1 smallest ids.

    A vector may be a third of all rows: its ids are thinned in salted parts first.
    """
    salted = rows.distinct().withColumns({"h": F.xxhash64("v"), "salt": F.pmod(F.xxhash64("id"), F.lit(64))})
    few = salted.withColumn("r", F.row_number().over(Window.partitionBy("h", "v", "salt").orderBy("id"))).where(F.col("r") <= k + 1)
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))).where(F.col("r") <= k + 1)
    return few.groupBy("h", "v", "dims").agg(F.sort_array(F.collect_list("id")).alias("ids")).drop("h")


def search(
    table: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row of ``queries``."""
    nodes = landed(distinct_vectors(usable(table, id_col, vector_col), k), "vectors")
    asked = landed(usable(queries, id_col, vector_col).distinct(), "queries")
    # one row per length of vectors reaches the driver
    shards = {r["dims"]: -(-r["n"] // shard) for r in nodes.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    blocks = -(-asked.count() // BLOCK)
    if not shards or not blocks:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    count = F.lit(1)
    for dims, n in shards.items():
        count = F.when(F.col("dims") == dims, n).otherwise(count)
    key = F.pmod(F.xxhash64("v"), count).cast("int")
    nodes = nodes.withColumn("shard", key)

    def graphs(group: pd.DataFrame) -> pd.DataFrame:
        units = unit(np.array(group["v"].tolist(), np.float64))
        graph, start = build(units)
        return pd.DataFrame(
            {
                "dims": group["dims"].iloc[0],
                "shard": group["shard"].iloc[0],
                "v": group["v"],
                "ids": group["ids"],
                "place": np.arange(len(group)),
                "edges": list(graph),
                "start": start,
            }
        )

    schema = "dims int, shard int, v array<double>, ids array<long>, place long, edges array<long>, start long"
    index = landed(nodes.groupBy("dims", "shard").applyInPandas(graphs, schema), "graph_index")

    def found(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if not len(left) or not len(right):
            return empty
        left = left.sort_values("place")
        vectors = np.array(left["v"].tolist(), np.float64)
        units, graph, ids = unit(vectors), np.array(left["edges"].tolist()), left["ids"].tolist()
        asked_ids, wanted = right["id"].to_numpy(), np.array(right["v"].tolist(), np.float64)
        start, beam = int(left["start"].iloc[0]), min(SEARCH_BEAM, len(left))
        parts = [wanted[a : a + STEP] for a in range(0, len(wanted), STEP)]
        hits = np.concatenate([beam_search(units, graph, start, unit(p), beam)[0] for p in parts])
        out: list[tuple[int, int, float]] = []
        for q, own in enumerate(asked_ids.tolist()):
            near = hits[q][hits[q] >= 0]
            scores = cosines(wanted[q], vectors[near])
            rows = sorted((-s, i) for s, at in zip(scores.tolist(), near.tolist(), strict=True) for i in ids[at] if i != own)
            out += [(own, i, -s) for s, i in rows[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]) if out else empty

    asked = asked.withColumn("shards", count).where("shards > 0")
    spread = asked.withColumns(
        {"block": F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"), "shard": F.explode(F.sequence(F.lit(0), F.col("shards") - 1))}
    ).select("dims", "shard", "block", "id", "v")
    every = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = every.groupBy("dims", "shard", "block").cogroup(spread.groupBy("dims", "shard", "block"))
    hits = pairs.applyInPandas(found, "query_id long, vec_id long, score double").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine in double precision on original vectors; scaled first where squares would overflow."""
    dots, norms = rows @ query, np.sqrt((rows * rows).sum(axis=1) * (query @ query))
    odd = ~np.isfinite(norms) | (norms < 1e-150)
    out = dots / np.where(odd, 1.0, norms)
    if odd.any():
        out[odd] = unit(rows[odd]) @ unit(query[None])[0]
    return out

