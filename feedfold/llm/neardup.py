"""Near-duplicates by HyperMinHash: compressed registers, banding, corrected estimates, exact checks.

A document is the set of its k-word shingles (64-bit hashes). Documents with
equal sets are one class, and only classes are compared. Each shingle's hash
picks one of ``REGISTERS`` registers and leaves a number there; a register
keeps the smallest as the count of its leading zeros (6 bits) and the ``MANTISSA``
bits after them, which is what a floating point number of that size would
keep. Bands of registers are hashed, and classes that share a band are
candidates. The share of equal registers, less what chance makes equal, estimates
the similarity; pairs estimated more than ``ERRORS`` standard errors below the threshold go, the others are
checked on the full sets.

No pairs of a whole band are made. First every class is paired with the
smallest class of each of its bands (a star). The links found so make
components. Bands that still hold several components are compared in blocks:
their members are dealt into groups of about ``BLOCK`` by a hash, and every two
groups meet in one task. What lies in different components and passes the
estimate stays in its block as lists of partners; the full sets of those members are brought
to the block and checked there, and only links that join two components come out,
fewer than the block has members. So one big group of copies costs a star, and a big
group that stays apart costs comparisons inside tasks, but rows only in proportion to its size. Nothing is
capped, and no link that would join two components is lost, but for what
banding misses: with ``BANDS`` bands of ``ROWS`` registers a pair at similarity
0.8 shares none with probability 3e-6.

Hashes of words are worked out for many texts at once, as differences of running sums over their bytes.

Defined cases: a null, empty or blank text has no shingles, is linked with
nothing and is its own component. A text of fewer than k words is one shingle.
Repeated rows are exact copies; each row gets a result. Null ids come after
others: a component takes its smallest id that is not null. Other columns are
ignored (``dedup`` keeps them).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedfold.llm.common import bounded_batches, bounded_runs, landed, starts_of
from feedfold.llm.components import components

ROWS, BANDS = 6, 42
REGISTERS = ROWS * BANDS
MANTISSA = 10
#: An estimate may lie so many standard errors below the similarity and still be checked.
ERRORS = 6
BLOCK = 2_048
#: Texts whose registers are worked out at once.
TEXTS = 64
#: Orders rows by id, null ids last, and by text.
NAMED = "struct(d IS NULL AS nameless, d, t)"
EMPTY = np.uint16(0xFFFF)

ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
#: Bytes of text whose words are hashed at once.
SLICE = 1 << 18
WHITE = re.compile(rb"[\x20\x09-\x0D]")
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Odd, so that its powers have inverses modulo 2^64.
BASE = 0x2545F4914F6CDD1B
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(32))) * ODD[3]
    x = (x ^ (x >> np.uint64(32))) * ODD[3]
    return x ^ (x >> np.uint64(32))


#: A number for each byte; capital letters have those of the small ones.
LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * ODD[0])
LETTERS[ord("A") : ord("Z") + 1] = LETTERS[ord("a") : ord("z") + 1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE + 4_096)
        _POWERS[:] = [
            np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, x, np.uint64)])) for x in (BASE, INVERSE)
        ]
    return _POWERS[0][:n], _POWERS[1][:n]


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and the places where they begin, cut between words into parts of about ``SLICE`` bytes."""
    hashes, places, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(data):
        cut = WHITE.search(data, min(at + SLICE, len(data)))
        end = cut.end() if cut else len(data)
        some = np.frombuffer(data, np.uint8, end - at, at)
        blank = np.concatenate([[True], BLANK[some], [True]])
        turns = np.flatnonzero(blank[1:] != blank[:-1])
        first, last = turns[::2], turns[1::2]
        up, down = powers(len(some))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(LETTERS[some] * up)])
        hashes.append(mixed((sums[last] - sums[first]) * down[first]))
        places.append(first + at)
        at = end
    return np.concatenate(hashes), np.concatenate(places)


def chained(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of so many words."""
    n = len(hashes) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = mixed(out * ODD[0] + hashes[i : i + n])
    return out


def distinct(numbers: np.ndarray) -> np.ndarray:
    found = np.sort(numbers)
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def shingles(texts: Sequence[str | None], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    whole = [t or "" for t in texts]
    for a, b in bounded_runs(whole, SLICE):
        coded = [t.encode("utf-8", "surrogatepass") for t in whole[a:b]]
        hashes, places = words_of(b"\n".join(coded))
        bounds = np.searchsorted(places, starts_of([*(len(c) + 1 for c in coded), 0])).tolist()
        runs = chained(hashes, k) if len(hashes) >= k else hashes[:0]
        for first, last in zip(bounds, bounds[1:], strict=False):
            if last - first >= k:
                out.append(distinct(runs[first : last - k + 1]))
            else:
                out.append(chained(hashes[first:last], last - first) if last > first else np.zeros(0, np.uint64))
    return out


def registers(found: np.ndarray) -> np.ndarray:
    """HyperMinHash of a set: per register the leading zeros and mantissa of its smallest number."""
    return all_registers([found])[0]


def all_registers(sets: Sequence[np.ndarray]) -> np.ndarray:
    """The registers of each set."""
    found = np.concatenate([np.zeros(0, np.uint64), *sets])
    spread = mixed(found * ODD[1])
    place = ((spread >> np.uint64(32)) % np.uint64(REGISTERS)).astype(np.int64)
    place += np.repeat(np.arange(len(sets)) * REGISTERS, [len(s) for s in sets])
    number = (mixed(found ^ ODD[2]) >> np.uint64(11)).astype(np.float64)  # 53 bits
    least = np.full(len(sets) * REGISTERS, np.inf)
    np.minimum.at(least, place, number)
    held = np.flatnonzero(np.isfinite(least))
    fraction, exponent = np.frexp(np.maximum(least[held], 1.0))
    zeros = np.minimum(53 - exponent, 62)
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    out = np.full(len(least), EMPTY, np.uint16)
    out[held] = (zeros << MANTISSA | mantissa).astype(np.uint16)
    return out.reshape(len(sets), REGISTERS)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """A 64-bit key per row of registers and band; 0 for a band of empty registers."""
    cut = rows.reshape(len(rows), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(rows), BANDS))
    for i in range(ROWS):
        key = mixed(key * ODD[0] + cut[:, :, i])
    return np.where((cut == EMPTY).all(axis=2), np.uint64(0), np.maximum(key, np.uint64(1)))


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of registers row by row, corrected for equal registers of different sets."""
    used = (a != EMPTY) | (b != EMPTY)
    union = np.maximum(used.sum(axis=1), 1)
    same = ((a == b) & used).sum(axis=1) / union
    # two numbers with equal leading zeros (chance about 1/3) agree in the mantissa by 2^-MANTISSA
    chance = 1 / (3 << MANTISSA)
    return np.clip((same - chance) / (1 - chance), 0, 1)


def could_reach(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Pairs to check on full sets; the fewer registers are in use, the less an estimate decides."""
    sized = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
    used, goal = np.maximum(((a != EMPTY) | (b != EMPTY)).sum(axis=1), 1), percent / 100
    return sized & (estimates(a, b) >= goal - ERRORS * np.sqrt(goal * (1 - goal) / used))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def digest(found: np.ndarray) -> str | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest() if len(found) else None


def sketched(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(d, t, x, n, sketch): id, hash of the text, digest of the set (null if empty), its size and registers."""

    @F.pandas_udf("x string, n long, sketch binary")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        sets = shingles(texts.tolist(), k)
        rows: list[bytes] = []
        for at in range(0, len(sets), TEXTS):
            rows += [row.tobytes() for row in all_registers(sets[at : at + TEXTS])]
        return pd.DataFrame(
            {
                "x": [digest(s) for s in sets],
                "n": [len(s) for s in sets],
                "sketch": [row if len(s) else None for s, row in zip(sets, rows, strict=True)],
            }
        )

    rows = docs.select(F.col(id_col).alias("d"), F.xxhash64(text_col).alias("t"), sketch(F.col(text_col)).alias("s"))
    return rows.select("d", "t", "s.*")


def to_rows(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), REGISTERS)


def bands_of(classes: DataFrame) -> DataFrame:
    """(band, c): the keys of each class's bands."""

    @F.pandas_udf("array<long>")
    def keys(sketches: pd.Series) -> pd.Series:
        rows = band_keys(to_rows(sketches)) if len(sketches) else np.zeros((0, BANDS), np.uint64)
        return pd.Series([r[r != 0].astype(np.int64) for r in rows])

    return classes.select("c", F.explode(keys("sketch")).alias("band"))


def worth_checking(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose registers allow a link."""

    @F.pandas_udf("boolean")
    def passes(a: pd.Series, b: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        return pd.Series(could_reach(to_rows(a), to_rows(b), na.to_numpy(), nb.to_numpy(), percent))

    left = classes.selectExpr("c AS a", "n AS na", "sketch AS sa")
    right = classes.selectExpr("c AS b", "n AS nb", "sketch AS sb")
    sized = pairs.join(left, "a").join(right, "b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    return sized.where(passes("sa", "sb", "na", "nb")).select("a", "b")


def set_rows(nodes: DataFrame, classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(c, whole): the hashes of these classes, from the text of each one's smallest row."""

    @F.pandas_udf("binary")
    def full(texts: pd.Series, wanted: pd.Series) -> pd.Series:
        # wanted is read here so that only texts of these classes are cut into shingles
        sets = shingles(texts.tolist(), k)
        return pd.Series([s.tobytes() if digest(s) == x else None for s, x in zip(sets, wanted, strict=True)], dtype=object)

    named = nodes.distinct().join(classes, "c").selectExpr("c", "d AS e", "t AS h", "x")
    texts = docs.select("d", F.xxhash64("text").alias("t"), "text")
    # one plan at every size: the number of candidates does not decide whether texts move
    found = texts.join(named.hint("merge"), texts["d"].eqNullSafe(named["e"]) & (F.col("t") == F.col("h")))
    # nulls go after the aggregate: a condition right after the function would be moved before it, and call it once more
    found = found.select("c", full("text", "x").alias("whole")).groupBy("c")
    return found.agg(F.first("whole", ignorenulls=True).alias("whole")).where("whole IS NOT NULL")


def full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    return landed(set_rows(nodes, classes, docs, k), "full_sets")


def checked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough, as links (u, v)."""

    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        found = [
            linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(a, b, strict=True)
        ]
        return pd.Series(found, dtype=bool)

    pairs = landed(pairs, "candidate_pairs")
    sets = full_sets(pairs.selectExpr("a AS c").union(pairs.selectExpr("b AS c")), classes, docs, k)
    left, right = sets.selectExpr("c AS a", "whole AS wa"), sets.selectExpr("c AS b", "whole AS wb")
    both = pairs.join(left, "a").join(right, "b")
    return landed(both.where(similar("wa", "wb")).selectExpr("a AS u", "b AS v"), "links")


def left_apart(
    bands: DataFrame, classes: DataFrame, labels: DataFrame, docs: DataFrame, k: int, percent: int
) -> DataFrame:
    """Links (u, v) between different components in bands that hold several, found and checked in blocks."""
    named = bands.join(labels.withColumnRenamed("u", "c"), "c", "left")
    named = named.select("band", "c", F.coalesce("v", "c").alias("label"))
    open_bands = named.groupBy("band").agg(
        F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    open_bands = open_bands.where("low != high").select("band", F.ceil(F.col("members") / BLOCK).cast("int").alias("parts"))
    rows = named.join(open_bands, "band").join(classes.select("c", "n", "sketch"), "c")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int"))
    # group i meets group j in the block (i, j), i <= j
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    blocks = rows.select("band", "i", "j", "own", "c", "label", "n", "sketch")
    dealt = blocks.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "c")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in whole_blocks(batches):
            yield with_partners(some, *pairs_in_blocks(some, percent))

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in whole_blocks(batches):
            found = [pair for _, block in some.groupby(BLOCK_KEY, sort=False) for pair in joins_in_block(block, percent)]
            u, v = zip(*found, strict=True) if found else ((), ())
            yield pd.DataFrame({"u": u, "v": v}, dtype=np.int64)

    members = dealt.mapInPandas(compare, "band long, i int, j int, c long, label long, partners binary")
    members = landed(members, "members")
    held = members.join(full_sets(members.select("c"), classes, docs, k), "c").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "c")
    return landed(held.mapInPandas(confirm, "u long, v long").distinct(), "links_apart")


#: Rows of blocks that are compared together; a block has at most two groups of about ``BLOCK``.
TOGETHER = 8_192
BLOCK_KEY = ["band", "i", "j"]


def whole_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by block, cut between blocks into parts of about ``TOGETHER`` rows."""
    held: pd.DataFrame | None = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        while len(held) >= TOGETHER:
            key = held[BLOCK_KEY].to_numpy()
            ends = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            cut = ends[min(np.searchsorted(ends, TOGETHER), len(ends) - 1)] if len(ends) else 0
            if not cut:
                break
            yield held[:cut]
            held = held[cut:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def pairs_in_blocks(rows: pd.DataFrame, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of different components to check, from rows sorted by block; all blocks are compared at once.

    In each step every row meets the one so many places after it, if that is in its
    block; rows whose block ends before take no further part.
    """
    sketches, n = to_rows(rows["sketch"]), rows["n"].to_numpy()
    own, label, band = rows["own"].to_numpy(), rows["label"].to_numpy(), rows["band"].to_numpy()
    key = rows[BLOCK_KEY].to_numpy()
    within = (rows["i"] == rows["j"]).to_numpy()
    starts = np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])
    block = np.cumsum(starts) - 1
    end = np.append(np.flatnonzero(starts)[1:], len(rows))[block]
    keys = band_keys(sketches)
    here = np.arange(len(rows))
    out: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
    step = 1
    while len(here := here[here + step < end[here]]):
        there = here + step
        meets = (label[here] != label[there]) & (within[here] | (own[here] != own[there]))
        meets &= 100 * np.minimum(n[here], n[there]) >= percent * np.maximum(n[here], n[there])
        a, b = here[meets], there[meets]
        if len(a):
            # a pair is taken up in the first band that it shares
            shared = (keys[a] == keys[b]) & (keys[a] != 0)
            first = keys[a, shared.argmax(axis=1)].astype(np.int64) == band[a]
            a, b = a[first], b[first]
            near = could_reach(sketches[a], sketches[b], n[a], n[b], percent)
            out.append(np.stack([a[near], b[near]], axis=1))
        step += 1
    found = np.concatenate(out)
    return found[:, 0], found[:, 1]


def with_partners(rows: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """The members of blocks that are in a pair, each with the classes it is to be checked against."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    members = np.unique(np.concatenate([a, b]))
    c = rows["c"].to_numpy()
    first, last = np.searchsorted(a, members), np.searchsorted(a, members, "right")
    partners = [c[b[x:y]].tobytes() for x, y in zip(first, last, strict=True)]
    return rows[[*BLOCK_KEY, "c", "label"]].iloc[members].assign(partners=partners)


def joins_in_block(rows: pd.DataFrame, percent: int) -> Iterator[tuple[int, int]]:
    """Links that join two components, from the members of one block sorted by class."""
    c, component = rows["c"].to_numpy(), rows["label"].to_numpy().copy()
    sets = [np.frombuffer(w, np.uint64) for w in rows["whole"]]
    sizes = np.array([len(s) for s in sets])
    known, number = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    held = np.zeros(len(known), bool)
    for me, wanted in enumerate(rows["partners"]):
        others = np.searchsorted(c, np.frombuffer(wanted, np.int64))
        others = others[component[others] != component[me]]
        if not len(others):
            continue
        mine = number[starts[me] : starts[me] + sizes[me]]
        held[mine] = True
        many = sizes[others]
        ends = np.cumsum(many)
        places = np.repeat(starts[others] - (ends - many), many) + np.arange(ends[-1])
        both = np.add.reduceat(held[number[places]].astype(np.int64), ends - many)
        held[mine] = False
        for other in others[100 * both >= percent * (sizes[me] + many - both)]:
            if component[other] != component[me]:
                component[component == component[other]] = component[me]
                yield int(c[me]), int(c[other])


def with_firsts(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """What ``resolve`` gives, and first: the smallest hash of a text that has the smallest id in the component."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("text"))
    rows = landed(sketched(docs, k, "d", "text"), "sketches")
    classes = rows.where("x IS NOT NULL").groupBy("x").agg(
        F.min(F.expr(NAMED)).alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = classes.select("x", "least.d", "least.t", "n", "sketch")
    classes = landed(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
    bands = bands_of(classes)
    shared = bands.groupBy("band").agg(F.min("c").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    bands = landed(bands.join(shared, "band"), "bands")
    stars = bands.where("a != c").selectExpr("a", "c AS b").distinct()
    labels = components(checked(worth_checking(stars, classes, percent), classes, docs, k, percent))
    more = left_apart(bands.select("band", "c"), classes, labels, docs, k, percent)
    if not more.isEmpty():
        labels = components(labels.union(more))
    named = classes.join(labels.withColumnRenamed("u", "c"), "c", "left").select(
        "x", "d", "t", F.coalesce("v", "c").alias("label")
    )
    smallest = named.groupBy("label").agg(F.min(F.expr(NAMED)).alias("least"))
    by_class = named.select("x", "label").join(smallest, "label")
    by_class = landed(by_class.select("x", F.col("least.d").alias("component"), F.col("least.t").alias("first")), "class_components")
    alone = F.col("x").isNull()
    return rows.join(by_class, "x", "left").select(
        "d",
        "t",
        "n",
        F.when(alone, F.col("d")).otherwise(F.col("component")).alias("component"),
        F.when(alone, F.col("t")).otherwise(F.col("first")).alias("first"),
    )


def resolve(
    docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row (d, t, n, component): id, hash of the text, size of its set and smallest id of its component."""
    return with_firsts(docs, k, percent, id_col, text_col).drop("first")


def dedup(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of documents that stay: one of each component, with all their columns.

    Rows are named by id and text, as ids may be null or repeated; the smallest name of a component
    stays, null ids last. Rows that repeat an id and its text are reduced to one.
    """
    found = landed(with_firsts(docs, k, percent, id_col, text_col), "found_components")
    gone = found.where("NOT (d <=> component AND t = first)").select("d", "t").distinct()
    twice = found.groupBy("d", "t").agg(F.count("*").alias("n")).where("n > 1").select("d", "t")

    def same(rows: DataFrame):
        return docs[id_col].eqNullSafe(rows["d"]) & (F.xxhash64(docs[text_col]) == rows["t"])

    if twice.isEmpty():
        return docs.join(gone.hint("merge"), same(gone), "left_anti")
    twice = landed(twice, "repeated_rows")
    kept = docs.join(gone.hint("merge"), same(gone), "left_anti")
    once = kept.join(twice, same(twice), "left_anti")
    return once.unionByName(kept.join(twice, same(twice), "left_semi").dropDuplicates([id_col, text_col]))
