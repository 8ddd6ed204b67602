"""Rows dealt to shards on a consistent-hash ring with virtual nodes and bounded loads.

Each shard has ``POINTS`` virtual nodes on a ring of ``RING`` places, and a row
belongs to the first node at or after the place of its id. A shard holds no
more rows than its capacity: all shards get the same number of rows, the first
few one more where the number does not divide. What a full shard cannot hold
goes on clockwise to the next nodes whose shards have room. Capacities add up
to the number of rows, so counts are at most one apart whatever the ids are,
and most rows stay where the ring puts them when rows or shards are added.

The rows that meet at one node are an *arc*. Rows are sorted by arc and id,
which numbers them without a window over a shard: a row's rank in its arc is
its place in the sorted table less where the arc begins. A hot id is spread
over sort partitions by a row number that was written down before. The
overflow is planned on counts alone: one number per node, a quantity set by
``shards`` and ``POINTS``, not by the data. The plan is a list of stretches
(arc, first rank, end, shard, first slot), to which rows are joined.

Defined cases: a null text has no bytes, so its size is ``OVERHEAD`` and its
checksum that of the empty text; null ids share a place on the ring; repeated rows are
rows of their own and get slots of their own. Other columns play no part,
whatever their names, unless they are carried. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedfold.llm.common import landed, unused

SHARDS = 40
#: Virtual nodes of a shard, and places on the ring.
POINTS, RING = 128, 1 << 16
#: Bytes that a row takes besides its text.
OVERHEAD = 16
#: Low bits of Spark's row ids, which count the rows of a partition.
IN_PARTITION = (1 << 33) - 1


def ring(shards: int, points: int = POINTS) -> list[tuple[int, int]]:
    """(place, shard) of all virtual nodes, clockwise; of nodes that meet, the one of smallest hash holds the place."""
    held: dict[int, tuple[str, int]] = {}
    for shard in range(shards):
        for point in range(points):
            digest = hashlib.sha256(f"{shard}/{point}".encode()).hexdigest()
            place = int(digest[:8], 16) % RING
            held[place] = min(held.get(place, ("g", 0)), (digest, shard))
    return [(place, shard) for place, (_, shard) in sorted(held.items())]


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


#: Stretch of an arc: arc, first rank, end, shard, first slot.
Stretch = tuple[int, int, int, int, int]


def plan(counts: list[int], owners: list[int], shards: int) -> list[Stretch]:
    """Where the rows of each arc go; ``counts`` and ``owners`` are per node, clockwise.

    Shards first take the rows of their own arcs. Then the rest is carried
    round the ring, first come first served; two rounds pass every node with all that
    can reach it.
    """
    room = capacities(sum(counts), shards)
    used = [0] * shards
    found: list[Stretch] = []
    rest = []

    def place(arc: int, start: int, length: int, shard: int) -> int:
        """Put as much as fits; how much that is."""
        taken = min(length, room[shard] - used[shard])
        if taken:
            found.append((arc, start, start + taken, shard, used[shard]))
            used[shard] += taken
        return taken

    for arc, (count, shard) in enumerate(zip(counts, owners, strict=True)):
        taken = place(arc, 0, count, shard)
        rest.append((arc, taken, count - taken))
    carried: deque[tuple[int, int, int]] = deque()
    for step in range(2 * len(owners)):
        node = step % len(owners)
        while carried and used[owners[node]] < room[owners[node]]:
            arc, start, length = carried.popleft()
            taken = place(arc, start, length, owners[node])
            if taken < length:
                carried.appendleft((arc, start + taken, length - taken))
        if step < len(owners) and rest[node][2]:
            carried.append(rest[node])
    return found


def inline(spark: SparkSession, rows: list[tuple[int, ...]], *names: str) -> DataFrame:
    """A table of whole numbers from the driver."""
    cells = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), "array<array<long>>")).alias("r"))
    return cells.select(*[F.col("r")[i].alias(name) for i, name in enumerate(names)])


def place_of(doc_id: Column) -> Column:
    """Place of an id on the ring."""
    digest = F.sha2(F.coalesce(doc_id.cast("string"), F.lit("")), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % RING


def arcs_of_places(spark: SparkSession, nodes: list[tuple[int, int]]) -> DataFrame:
    """(arc, place) for every place of the ring; places after the last node belong to the first."""
    rows, begin = [], 0
    for arc, (place, _) in enumerate(nodes):
        rows.append((arc, begin, place))
        begin = place + 1
    if begin < RING:
        rows.append((0, begin, RING - 1))
    return inline(spark, rows, "arc", "begin", "end").select("arc", F.explode(F.sequence("begin", "end")).alias("place"))


def assign(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) per row, and ``row``, a struct of the carried columns, if there are any."""
    spark = docs.sparkSession
    nodes = ring(shards)
    text = F.coalesce(F.col(text_col), F.lit(""))
    more = [F.struct(*carry).alias("row")] if carry else []
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        *more,
    )
    rows = rows.select("*", place_of(F.col("doc_id")).alias("place"), F.monotonically_increasing_id().alias("uid"))
    rows = landed(rows, "shard_rows")
    # the ring has a fixed number of places
    known = rows.join(F.broadcast(arcs_of_places(spark, nodes)), "place")
    order = ["arc", "doc_id", "size", "text_crc32", "uid"]
    ranked = known.orderBy(*order).select("*", F.monotonically_increasing_id().alias("at"))
    ranked = ranked.select(
        *[c for c in known.columns if c not in ("place", "uid")],
        F.shiftright("at", 33).alias("part"),
        F.col("at").bitwiseAND(F.lit(IN_PARTITION)).alias("at"),
    )
    ranked = landed(ranked, "shard_order")
    # per arc and sort partition: arcs are contiguous, so this has one row per node and partition at most
    parts = ranked.groupBy("arc", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    parts = landed(parts, "shard_arcs")
    sizes = {r["arc"]: r["n"] for r in parts.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    counts = [sizes.get(arc, 0) for arc in range(len(nodes))]
    stretches = plan(counts, [shard for _, shard in nodes], shards)
    starts = before_parts(parts)
    where = inline(spark, stretches, "arc", "begin", "end", "shard", "slot")
    placed = ranked.join(starts, ["arc", "part"]).withColumn("rank", F.col("at") - F.col("first") + F.col("before"))
    found = placed.join(F.broadcast(where), "arc").where("rank >= begin AND rank < end")
    return found.select(
        "doc_id", "size", "text_crc32",
        F.col("shard").cast("int").alias("shard"),
        (F.col("slot") + F.col("rank") - F.col("begin")).alias("slot"),
        *(["row"] if carry else []),
    )


def before_parts(parts: DataFrame) -> DataFrame:
    """(arc, part, first, before): rows of an arc in earlier sort partitions."""
    earlier = Window.partitionBy("arc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("arc", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Whole rows in one folder per shard, files in the order of slots; several tasks write a shard."""
    shard, slot = unused(docs.columns, "shard"), unused(docs.columns, "slot")
    placed = assign(docs, shards, id_col, text_col, list(docs.columns))
    dealt = placed.select("row.*", F.col("shard").alias(shard), F.col("slot").alias(slot))
    ordered = dealt.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot)
    ordered.write.mode("overwrite").partitionBy(shard).parquet(path)
