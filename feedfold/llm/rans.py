"""Token ids in files, coded by a static range asymmetric numeral system.

Layout. A store is a folder: ``tables`` holds the one shared frequency table
(symbol, frequency out of 2^20); ``blocks`` has a row per block of whole
documents in ascending order (shard, ids of the shard before it, document ids and
sizes, coded segments). A block is cut into segments of ``SEGMENT`` ids. A segment is coded
by up to ``LANES`` interleaved coders that share one stream of 32-bit words;
the checkpoint of a segment is the place of its words in the payload and the
states its lanes start from, so any segment is decoded alone, and the crc32 of
its ids tells a damaged one. Blocks are independent of each other, too.

Spark's Parquet writer carries the bytes, so files appear only when a task
commits, and a lost executor costs the tasks it ran.

Defined cases: a null text is empty; with an end id it holds one id. Null
document ids come first. Rows of one document id stand in the order of the
hash of their text. An empty table gives an empty store. Other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.llm.common import bounded_batches, bounded_runs, scratch_path, starts_of
from feedfold.llm.tokens import library_encoder

SCALE = 20
TOTAL = 1 << SCALE
#: States stay in [2^31, 2^63); a word of 32 bits leaves a state that would pass.
LOW = np.uint64(1 << 31)
LIMIT_SHIFT = np.uint64(31 - SCALE + 32)
WORD = np.uint64(32)
LANES = 1024
SEGMENT = 1 << 18
#: Ids after which a block ends with its current document.
BLOCK = 1 << 19

BLOCK_SCHEMA = (
    "shard long, first long, doc_ids array<string>, sizes array<int>, n_tokens long, "
    "segments array<struct<n: int, place: int, states: binary, crc32: long>>, payload binary"
)


def quantised(counts: np.ndarray) -> np.ndarray:
    """Frequencies out of 2^20 for counts of symbols; every symbol that occurs keeps at least one.

    At most 2^19 different symbols may occur, which any vocabulary here keeps far below.
    """
    counts = counts.astype(np.float64)
    seen = counts > 0
    if not seen.any():
        return np.zeros(len(counts), np.int64)
    spare = TOTAL - int(seen.sum())
    share = counts / counts.sum() * spare
    freq = np.floor(share).astype(np.int64) + seen
    most = np.argsort(-(share - np.floor(share)), kind="stable")[: TOTAL - int(freq.sum())]
    freq[most] += 1
    return freq


class Table:
    """The shared frequency table in the forms that coders look up."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """Words and first states of one segment."""
        lanes = min(LANES, len(ids))
        x, words = np.full(lanes, LOW, np.uint64), []
        for at in range((len(ids) - 1) // lanes * lanes, -1, -lanes):
            some = ids[at : at + lanes]
            states, freq = x[: len(some)], self.freq[some]
            over = states >= freq << LIMIT_SHIFT
            words.append(states[over].astype("<u4"))
            states = np.where(over, states >> WORD, states)
            whole = states // freq
            x[: len(some)] = (whole << np.uint64(SCALE)) + (states - whole * freq) + self.cum[some]
        return b"".join(w.tobytes() for w in reversed(words)), x.astype("<u8").tobytes()

    def decode(self, n: int, states: bytes, payload: bytes, place: int) -> np.ndarray:
        """The ids of one segment, from its checkpoint on."""
        x = np.frombuffer(states, "<u8").astype(np.uint64)
        words = np.frombuffer(payload, "<u4", offset=place).astype(np.uint64)
        out, read, lanes = np.empty(n, np.uint32), 0, len(x)
        for at in range(0, n, lanes):
            some = x[: min(lanes, n - at)]
            slot = some & np.uint64(TOTAL - 1)
            symbol = self.symbol[slot]
            out[at : at + lanes] = symbol
            some = self.freq[symbol] * (some >> np.uint64(SCALE)) + slot - self.cum[symbol]
            low = np.flatnonzero(some < LOW)
            some[low] = (some[low] << WORD) | words[read : read + len(low)]
            read += len(low)
            x[: len(some)] = some
        return out


def encode_block(table: Table, ids: np.ndarray) -> tuple[list[dict], bytes]:
    segments, parts, place = [], [], 0
    for at in range(0, len(ids), SEGMENT):
        some = ids[at : at + SEGMENT]
        words, states = table.encode(some)
        crc = zlib.crc32(some.astype("<u4").tobytes())
        segments.append({"n": len(some), "place": place, "states": states, "crc32": crc})
        parts.append(words)
        place += len(words)
    return segments, b"".join(parts)


def decode_segment(table: Table, segment, payload: bytes) -> np.ndarray:
    """One segment by itself; a wrong checksum raises."""
    ids = table.decode(segment["n"], segment["states"], payload, segment["place"])
    if zlib.crc32(ids.astype("<u4").tobytes()) != segment["crc32"]:
        raise ValueError("a segment's checksum does not match its ids")
    return ids


def tokenised(docs: DataFrame, path: str, end_id: int | None, id_col: str, text_col: str) -> DataFrame:
    """Blocks of ids in the order of the documents, cut in the tasks of a range sort."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, shard = library_encoder(path), TaskContext.get().partitionId()
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        first, size, held_ids, held = 0, 0, [], []

        def row() -> pd.DataFrame:
            sizes, ids = [len(h) // 4 for h in held], b"".join(held)
            return pd.DataFrame(
                {"shard": [shard], "first": [first], "doc_ids": [held_ids], "sizes": [sizes], "ids": [ids], "seen": [seen_in(ids)]}
            )

        for batch in batches:
            texts, keys = batch["text"].tolist(), batch["doc_id"].tolist()
            for a, b in bounded_runs(texts):
                for key, ids in zip(keys[a:b], encoder.ids(texts[a:b]), strict=True):
                    held_ids.append(key)
                    held.append(ids + end)
                    size += len(held[-1]) // 4
                    if size >= BLOCK:
                        yield row()
                        first, size, held_ids, held = first + size, 0, [], []
        if held:
            yield row()

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    # ids travel as text, since pandas has no integers with nulls
    blocks = ordered.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        run, "shard long, first long, doc_ids array<string>, sizes array<int>, ids binary, seen binary"
    )
    return blocks.withColumn("doc_ids", F.col("doc_ids").cast(f"array<{kind}>"))


def seen_in(ids: bytes) -> bytes:
    """The symbols of a block, ascending, and how often each of them occurs."""
    total = np.bincount(np.frombuffer(ids, "<u4"))
    symbols = np.flatnonzero(total)
    return np.stack([symbols, total[symbols]]).astype("<u4").tobytes()


def symbol_counts(blocks: DataFrame) -> np.ndarray:
    """How often each id occurs; blocks are counted where they are made, and a vocabulary bounds what reaches the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for seen in batch["seen"]:
                symbols, counts = np.frombuffer(seen, "<u4").reshape(2, -1)
                if len(symbols):
                    total = np.pad(total, (0, max(0, int(symbols[-1]) + 1 - len(total))))
                    total[symbols] += counts
        symbols = np.flatnonzero(total)
        yield pd.DataFrame({"symbol": symbols, "n": total[symbols]})

    rows = blocks.select("seen").mapInPandas(run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))
    found = rows.collect()
    counts = np.zeros(1 + max((r["symbol"] for r in found), default=-1), np.int64)
    for r in found:
        counts[r["symbol"]] = r["n"]
    return counts


def write(
    docs: DataFrame, folder: str, path: str, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode the texts and write a store to ``folder``."""
    spark = docs.sparkSession
    blocks_path = scratch_path(spark, "token_blocks")
    blocks = tokenised(docs, path, end_id, id_col, text_col)
    blocks.write.option("compression", "zstd").parquet(blocks_path)
    blocks = spark.read.schema(blocks.schema).parquet(blocks_path)
    freq = quantised(symbol_counts(blocks))
    rows = [(int(s), int(freq[s])) for s in np.flatnonzero(freq)]
    spark.createDataFrame(rows, "symbol long, frequency long").coalesce(1).write.parquet(f"{folder}/tables")
    shared = spark.sparkContext.broadcast(freq)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table(shared.value)
        for batch in batches:
            for row in batch.itertuples(index=False):
                segments, payload = encode_block(table, np.frombuffer(row.ids, "<u4"))
                yield pd.DataFrame(
                    {
                        "shard": [row.shard],
                        "first": [row.first],
                        "doc_ids": [row.doc_ids],
                        "sizes": [row.sizes],
                        "n_tokens": [len(row.ids) // 4],
                        "segments": [segments],
                        "payload": [payload],
                    }
                )

    kind = docs.schema[id_col].dataType.simpleString()
    coded = blocks.drop("seen").withColumn("doc_ids", F.col("doc_ids").cast("array<string>")).mapInPandas(run, BLOCK_SCHEMA)
    coded = coded.withColumn("doc_ids", F.col("doc_ids").cast(f"array<{kind}>"))
    coded.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document its id, the ids before it in the whole store, and its own ids (little-endian, 32 bits)."""
    entries = spark.read.parquet(f"{folder}/tables").collect()  # bounded by the vocabulary
    freq = np.zeros(1 + max((r["symbol"] for r in entries), default=-1), np.int64)
    for r in entries:
        freq[r["symbol"]] = r["frequency"]
    shared = spark.sparkContext.broadcast(freq)
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table(shared.value)
        for batch in batches:
            for row in batch.itertuples(index=False):
                whole = [decode_segment(table, s, row.payload) for s in row.segments]
                ids = np.concatenate([*whole, np.zeros(0, np.uint32)]).astype("<u4").tobytes()
                sizes = [int(s) for s in row.sizes]
                starts = starts_of(sizes)
                yield pd.DataFrame(
                    {
                        "shard": row.shard,
                        "doc_id": pd.Series(list(row.doc_ids), dtype=object),
                        "at": [row.first + s for s in starts],
                        "ids": [ids[4 * s : 4 * (s + n)] for s, n in zip(starts, sizes, strict=True)],
                    }
                )

    # one row per shard reaches the driver: as many as the sort had tasks
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    firsts = list(zip([r["shard"] for r in totals], starts_of([r["n"] for r in totals]), strict=True))
    shards = spark.createDataFrame(firsts, "shard long, shard_start long")
    decoded = blocks.withColumn("doc_ids", F.col("doc_ids").cast("array<string>")).mapInPandas(
        run, "shard long, doc_id string, at long, ids binary"
    )
    decoded = decoded.withColumn("doc_id", F.col("doc_id").cast(kind))
    return decoded.join(F.broadcast(shards), "shard").selectExpr("doc_id", "shard_start + at AS start", "ids")


def digests(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Write a store, read it back, and give start, size and checksum of each document."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token_store")
    write(docs, folder, path, end_id)
    rows = read(spark, folder)
    return rows.select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
