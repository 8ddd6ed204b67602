"""Vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens.

An item demands (tokens, 1 segment, loss-bearing tokens); a sequence has room
for so much of each. The dot-product heuristic fills one sequence at a time:
of the items that fit, it takes the one whose demand, as shares of the limits,
has the largest dot product with the room left. Where cutting is allowed and
no item fits whole, the item that would fill the room best is cut. What a limit
or the end of a task leaves short of a full sequence becomes sequences whose lengths
are powers of two, which need no padding.

Each task packs the documents it reads, through a pool of at most ``POOL``
open items, so nothing is shuffled and memory has a bound. The loss-bearing
tokens of an item are its last ones (a prompt comes before its answer).

Defined cases: a null text is empty and holds the end id alone. Items without
tokens give no piece. Repeated rows are packed once each. Ties go to the item
that came first. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedfold.llm.common import bounded_batches, bounded_runs
from feedfold.llm.tokens import library_encoder

#: Open items per task; beyond it, sequences are filled until half are left.
POOL = 2_000


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 512
    loss: int = 4096


@dataclass
class Item:
    """A document, or what is left of it: ids from ``start`` on."""

    doc_id: object
    ids: bytes
    loss: int
    start: int = 0

    @property
    def total(self) -> int:
        return len(self.ids) // 4

    @property
    def tokens(self) -> int:
        return self.total - self.start

    def loss_of(self, first: int, last: int) -> int:
        return max(0, last - max(first, self.total - self.loss))

    def head(self, room: int, room_loss: int) -> int:
        """Tokens from the start on that fit into so much room."""
        free = max(0, self.total - self.loss - self.start)  # before the first loss-bearing one
        return min(self.tokens, room, free + room_loss)


class Packer:
    """Fills sequences from a pool; pieces are (item, start, length, sequence, offset)."""

    def __init__(self, limits: Limits, cut: bool = True):
        self.limits, self.cut, self.sequences = limits, cut, 0
        self.pool: list[Item] = []
        self.demand = np.zeros((0, 3))
        self.caps = np.array([limits.tokens, limits.segments, limits.loss], float)

    def add(self, items: list[Item]) -> None:
        for item in items:
            if not self.cut and (item.tokens > self.limits.tokens or item.loss > self.limits.loss):
                raise ValueError(f"document {item.doc_id} is beyond the limits and may not be cut")
        items = [i for i in items if i.tokens]
        rows = np.array([[i.tokens, 1, i.loss_of(i.start, i.total)] for i in items], float).reshape(-1, 3)
        self.pool += items
        self.demand = np.concatenate([self.demand, rows])

    def drop(self, at: int) -> Item:
        item, last = self.pool[at], len(self.pool) - 1
        self.pool[at], self.demand[at] = self.pool[last], self.demand[last]
        self.pool.pop()
        self.demand = self.demand[:last]
        return item

    def one(self) -> list[tuple[Item, int, int]]:
        """Pieces of the next sequence: (item, start, length)."""
        room, pieces = self.caps.copy(), []
        while self.pool and (room > 0).all():
            gain = (self.demand / self.caps) @ (room / self.caps)
            fits = (self.demand <= room).all(axis=1)
            if fits.any():
                item = self.drop(int(np.argmax(np.where(fits, gain, -1.0))))
                length = item.tokens
            elif self.cut:
                clipped = np.minimum(self.demand, room) / self.caps
                at = int(np.argmax(clipped @ (room / self.caps)))
                length = self.pool[at].head(int(room[0]), int(room[2]))
                item = self.drop(at)
                if length <= 0:
                    self.add([item])
                    break
                self.add([Item(item.doc_id, item.ids, item.loss, item.start + length)])
            else:
                break
            pieces.append((item, item.start, length))
            room -= [length, 1, item.loss_of(item.start, item.start + length)]
        return pieces

    def fill(self, until: int) -> Iterator[tuple[Item, int, int, int, int]]:
        while len(self.pool) > until:
            yield from self.placed(self.one())

    def placed(self, pieces: list[tuple[Item, int, int]]) -> Iterator[tuple[Item, int, int, int, int]]:
        left, offset = sum(p[2] for p in pieces), 0
        size = self.size_of(left)
        for item, start, length in pieces:
            while length:
                some = min(length, size - offset)
                yield item, start, some, self.sequences, offset
                start, length, offset = start + some, length - some, offset + some
                if offset == size:
                    left, offset = left - size, 0
                    self.sequences += 1
                    size = self.size_of(left)

    def size_of(self, tokens: int) -> int:
        """Length of the next sequence when so many tokens are at hand."""
        if not self.cut or tokens >= self.limits.tokens or not tokens:
            return tokens
        return 1 << (tokens.bit_length() - 1)


def pack(
    docs: DataFrame,
    path: str,
    end_id: int,
    limits: Limits = Limits(),  # noqa: B008
    loss_share: float = 1.0,
    cut: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with their ids and places.

    ``loss_share`` is the share of a document's last ids that bear loss.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def frame(placed: list) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "doc_id": pd.Series([p[0].doc_id for p in placed], dtype=object),
                "start": [p[1] for p in placed],
                "length": [p[2] for p in placed],
                "ids": [p[0].ids[4 * p[1] : 4 * (p[1] + p[2])] for p in placed],
                "doc_tokens": [p[0].total for p in placed],
                "sequence_id": [(TaskContext.get().partitionId() << 36) + p[3] for p in placed],
                "offset": [p[4] for p in placed],
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, packer = library_encoder(path), Packer(limits, cut)
        for batch in batches:
            texts, keys = batch["text"].tolist(), batch["doc_id"].tolist()
            for a, b in bounded_runs(texts):
                items = []
                for key, ids in zip(keys[a:b], encoder.ids(texts[a:b]), strict=True):
                    ids += end
                    items.append(Item(key, ids, round(loss_share * (len(ids) // 4))))
                packer.add(items)
                if len(packer.pool) > POOL:
                    yield frame(list(packer.fill(POOL // 2)))
        rest = list(packer.fill(0))
        if rest:
            yield frame(rest)

    # ids travel as text, since pandas has no integers with nulls
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = rows.mapInPandas(
        run,
        "doc_id string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
    return pieces.withColumn("doc_id", F.col("doc_id").cast(kind))
