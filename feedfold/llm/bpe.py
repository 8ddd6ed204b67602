"""Byte-level BPE encoding with a segment tree over the ranks of adjacent pairs, and decoding.

A piece of text starts as its bytes. The leaves of the tree hold, for each
symbol, the rank of the pair it forms with the next living symbol (with the
place, so that equal ranks go to the left); the root is the leftmost pair of
lowest rank. A merge changes three leaves and their paths, so a piece of n
bytes takes O(n log n). Short pieces are merged side by side in numpy, one
tree per row; long ones alone.

Defined cases: a null text is empty; an empty text has no ids, and its decimal
text is empty. Repeated rows give repeated results, other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedfold.llm.common import bounded_runs
from feedfold.llm.tokens import Encoder

#: Fixed value: the pattern by which byte-level BPE of this family cuts text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces up to so many bytes share a numpy table.
SIDE_BY_SIDE = 64
NO_PAIR = 1 << 30
ROWS = 40_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Merges and tokens of a vocabulary file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.added.values()]) + 1
        self.byte_ids = np.zeros(256, np.int32)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_rank = keys[order], order.astype(np.int32)
        self.pair_rank = dict(zip(keys.tolist(), range(len(merges)), strict=True))
        self.token_bytes = [b""] * self.size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        for content, i in self.added.items():
            self.token_bytes[i] = content.encode()
        self.decimals = [str(i) for i in range(self.size)]
        self.pieces = regex.compile(PIECES)
        self.cut_added = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
            if self.added
            else None
        )

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_PAIR where there is none (also beside a place without a symbol)."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = (self.keys[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(hit, self.key_rank[at], NO_PAIR)


def merge_side_by_side(voc: Vocabulary, parts: list[bytes], width: int) -> list[bytes]:
    """Ids of parts of at most ``width`` bytes (a power of two), one segment tree per row."""
    n, bits = len(parts), width.bit_length() - 1
    sizes = np.fromiter(map(len, parts), np.int64, n)
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(n, width)
    places = np.arange(width)
    ids = np.full((n, width + 1), -1, np.int32)  # the last column is the place beyond either end
    ids[:, :width] = np.where(places < sizes[:, None], voc.byte_ids[raw], -1)
    after = np.tile(np.append(places + 1, width), (n, 1))
    before = np.tile(np.append(places - 1, width), (n, 1))
    before[:, 0] = width
    tree = np.full((n, 2 * width), NO_PAIR, np.int64)

    def leaf(rank, place):
        return np.where(rank < NO_PAIR, (rank.astype(np.int64) << bits) | place, NO_PAIR)

    tree[:, width:] = leaf(voc.ranks(ids[:, :width], ids[:, 1:]), places)
    level = width // 2
    while level:
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        level //= 2
    row = np.flatnonzero(tree[:, 1] < NO_PAIR)
    while len(row):
        root = tree[row, 1]
        at = root & (width - 1)
        gone = after[row, at]
        beyond, ahead = after[row, gone], before[row, at]
        made = voc.merged[root >> bits]
        ids[row, at], ids[row, gone] = made, -1
        after[row, at], before[row, beyond] = beyond, at
        tree[row, width + gone] = NO_PAIR
        tree[row, width + at] = leaf(voc.ranks(made, ids[row, beyond]), at)
        first = ahead < width
        own = np.flatnonzero(first)
        tree[row[own], width + ahead[own]] = leaf(voc.ranks(ids[row[own], ahead[own]], made[own]), ahead[own])
        nodes = [width + gone, width + at, width + np.where(first, ahead, at)]
        for _ in range(bits):
            nodes = [x >> 1 for x in nodes]
            for x in nodes:
                tree[row, x] = np.minimum(tree[row, 2 * x], tree[row, 2 * x + 1])
        row = row[tree[row, 1] < NO_PAIR]
    living = ids[:, :width] >= 0
    flat, ends = ids[:, :width][living].astype("<u4").tobytes(), (4 * np.cumsum(living.sum(1))).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def merge_alone(voc: Vocabulary, part: bytes) -> bytes:
    """Ids of one long part."""
    n, ids = len(part), voc.byte_ids[np.frombuffer(part, np.uint8)].tolist()
    width, rank, size = 1 << (n - 1).bit_length(), voc.pair_rank, voc.size
    none = len(voc.merged) * width
    tree = [none] * (2 * width)
    for i in range(n - 1):
        r = rank.get(ids[i] * size + ids[i + 1])
        if r is not None:
            tree[width + i] = r * width + i
    for i in range(width - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(place: int, left: int, right: int) -> None:
        r = rank.get(left * size + right) if right >= 0 else None
        at = width + place
        tree[at] = none if r is None else r * width + place
        while at > 1:
            at >>= 1
            low = min(tree[2 * at], tree[2 * at + 1])
            if low == tree[at]:
                break
            tree[at] = low

    while tree[1] < none:
        r, at = divmod(tree[1], width)
        gone = after[at]
        beyond, made = after[gone], int(voc.merged[r])
        ids[at], ids[gone], after[at] = made, -1, beyond
        put(gone, 0, -1)
        if beyond < n:
            before[beyond] = at
        put(at, made, ids[beyond] if beyond < n else -1)
        if before[at] >= 0:
            put(before[at], ids[before[at]], made)
    return np.array([i for i in ids if i >= 0], "<u4").tobytes()


def merge_all(voc: Vocabulary, parts: list[bytes]) -> dict[bytes, bytes]:
    by_width: dict[int, list[bytes]] = {}
    out: dict[bytes, bytes] = {}
    for p in parts:
        if len(p) > SIDE_BY_SIDE:
            out[p] = merge_alone(voc, p)
        else:
            by_width.setdefault(max(2, 1 << (len(p) - 1).bit_length()), []).append(p)
    for width, group in by_width.items():
        for start in range(0, len(group), ROWS):
            some = group[start : start + ROWS]
            out.update(zip(some, merge_side_by_side(voc, some, width), strict=True))
    return out


class BpeEncoder(Encoder):
    """Ids of whole texts, decimal and decoded forms."""

    def __init__(self, path: str):
        self.voc = voc = Vocabulary(path)
        #: A byte that UTF-8 text cannot hold marks an added token among the pieces.
        self.added = {content: b"\xff" + content.encode() for content in voc.added}
        self.kept = {self.added[c]: np.array([i], "<u4").tobytes() for c, i in voc.added.items()}
        super().__init__(self.encode_stretches)

    def encode_stretches(self, parts: list[str]) -> list[bytes]:
        voc, cut = self.voc, []
        for text in parts:
            found: list[bytes] = []
            bits = voc.cut_added.split(text) if voc.cut_added and any(a in text for a in voc.added) else [text]
            for i, bit in enumerate(bits):
                found += [self.added[bit]] if i % 2 else [p.encode() for p in voc.pieces.findall(bit)]
            cut.append(found)
        ids = merge_all(voc, list(set(chain.from_iterable(cut)) - self.kept.keys())) | self.kept
        return [b"".join(map(ids.__getitem__, f)) for f in cut]

    def read(self, ids: bytes) -> tuple[str, str]:
        """The text that ids decode to, and the ids in decimal."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        text = b"".join(map(self.voc.token_bytes.__getitem__, numbers)).decode("utf-8", "replace")
        return text, ",".join(map(self.voc.decimals.__getitem__, numbers))


_LOADED: dict[str, BpeEncoder] = {}


def bpe_encoder(path: str) -> BpeEncoder:
    if path not in _LOADED:
        _LOADED[path] = BpeEncoder(path)
    return _LOADED[path]


def with_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, its token ids (little-endian unsigned 32-bit), their decimal form and the decoded text."""

    @F.pandas_udf("ids binary, decoded string, decimal string")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = bpe_encoder(path)
        for batch in batches:
            texts = batch.tolist()
            ids = [i for a, b in bounded_runs(texts) for i in encoder.ids(texts[a:b])]
            decoded, decimal = zip(*map(encoder.read, ids), strict=True) if ids else ((), ())
            yield pd.DataFrame({"ids": ids, "decoded": decoded, "decimal": decimal})

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), encoded(text).alias("made")).select("doc_id", "made.*")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row the number of ids and the digests of ids and decoded text."""
    return with_ids(docs, path).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("decimal"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
