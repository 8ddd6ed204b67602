"""Spelling variants: words one edit apart, and the frequent form each of them leads to.

Words are counted in the tasks that read the texts, so one row per word and
task is shuffled. The vocabulary that remains is dealt to sorted lists: a word
appears, for itself and for partners one letter longer, in the list of each block of
letters that an edit may lie in, together with the words that agree outside this block.
Two words one edit apart meet in the list of the block where they part.
A block has two letters (more beyond 16 letters, so that a word is in at most 18
lists), which bounds a list by the square and cube of the alphabet, whatever the data.

A list is scanned in order with the edit matrix of a word, banded to three
cells a row. Rows are reused down to the length of the prefix that a word
shares with the one before it. Where all cells of a row exceed one edit, every
word with that prefix is skipped at once.

A word's form is its most frequent near word, if that one is at least ``ratio`` times as
frequent; forms of forms are followed by pointer doubling to the last word.

Defined cases: null and empty texts have no words. A null id counts as an
empty one. Rows that repeat a document count each time. Long runs of letters are
words like others. Other columns play no part, whatever their names. An empty table
gives no rows.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedfold.llm.common import landed

# What a run of letters is, and the documents' typing errors: one in so many runs.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SLIP = 97
MIN_CHARS, MIN_COUNT, RATIO = 5, 3, 2
#: Words that a task counts before it hands them on, and letters of a block.
HELD_WORDS, BLOCK, BLOCKS = 400_000, 2, 8
#: Rows of an Arrow batch that a task gives out.
OUT_ROWS = 50_000


def slipped(word: str, start: int) -> str:
    """The word as its document has it: some lose a letter, drawn by a checksum that begins with ``start``."""
    drawn = zlib.crc32(word.encode(), start)
    if drawn % SLIP:
        return word
    at = drawn % len(word)
    return word[:at] + word[at + 1 :]


def count_words(doc_id: object, text: str, counts: Counter, min_chars: int = MIN_CHARS) -> None:
    """Add the words of a document."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text)).items():
        if len(run) >= min_chars:
            word = slipped(run.lower() if run.isascii() else run.translate(LOWER), start)
            if len(word) >= min_chars:
                counts[word] += n


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT
) -> DataFrame:
    """(word, n) of words that occur often enough."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                count_words(doc_id, text.as_py(), counts, min_chars)
                if len(counts) > HELD_WORDS:
                    yield from batches_of(counts.items())
                    counts.clear()
        yield from batches_of(counts.items())

    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("x"))
    parts = rows.mapInArrow(counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def batches_of(pairs: Iterable[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    words, numbers = zip(*pairs, strict=True) if pairs else ((), ())
    for at in range(0, len(words), OUT_ROWS):
        rows = [pa.array(words[at : at + OUT_ROWS], pa.string()), pa.array(numbers[at : at + OUT_ROWS], pa.int64())]
        yield pa.RecordBatch.from_arrays(rows, ["word", "n"])


def lists_of(word: Column, min_chars: int = MIN_CHARS) -> Column:
    """Names of the lists a word is in: shorter length, block, and the letters around the block."""
    length = F.length(word)
    shorter = F.filter(F.array(length, length - 1), lambda m: m >= min_chars)

    def named(m: Column) -> Column:
        wide = F.greatest(F.lit(BLOCK), F.ceil(m / BLOCKS).cast("int"))

        def one(block: Column) -> Column:
            start = block * wide
            end = F.least(start + wide, m) + length - m
            around = [F.substring(word, F.lit(1), start), F.substring(word, end + 1, length)]
            return F.concat_ws(":", m, block, *around)

        return F.transform(F.sequence(F.lit(0), F.ceil(m / wide).cast("int") - 1), one)

    return F.flatten(F.transform(shorter, named))


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    at, most = 0, min(len(a), len(b))
    while at < most and a[at] == b[at]:
        at += 1
    return at


#: A banded row for the first j letters of a word: edits to the first j-1, j and j+1 letters of the query; 2 stands for more than one.
Row = tuple[int, int, int]


def next_row(row: Row, j: int, letter: str, query: str) -> Row:
    """The row after one more letter, the j-th from 0."""
    less, even, more = row
    n = len(query)
    low = min(even + 1, less + (query[j - 1] != letter)) if 0 < j <= n else even + 1
    mid = min(more + 1, low + 1, even + (query[j] != letter)) if j < n else 2
    high = min(mid + 1, more + (query[j + 1] != letter)) if j + 1 < n else 2
    return (min(low, 2), min(mid, 2), min(high, 2))


def scan(query: str, words: list[str], lcps: list[int], common: int) -> Iterator[int]:
    """Indices of the sorted words one edit from the query.

    ``lcps`` holds the prefix each word shares with the one before it, and
    ``common`` the prefix that the query and all words share.
    """
    rows: list[Row] = [(1, 0, 1) if common else (2, 0, 1)]
    dead = None  # words that share more letters than this with the one before are out
    for at, word in enumerate(words):
        keep = lcps[at] - common if at else 0
        if dead is not None and keep > dead:
            continue
        dead = None
        del rows[keep + 1 :]
        row = rows[-1]
        for j in range(common + len(rows) - 1, len(word)):
            row = next_row(row, j, word[j], query)
            rows.append(row)
            if min(row) > 1:
                dead = j - common
                break
        else:
            apart = len(query) - len(word)
            if -1 <= apart <= 1 and row[1 + apart] == 1:
                yield at


def links_of(name: str, words: list[str], numbers: list[int]) -> Iterator[tuple[str, str, int]]:
    """(word, near word, its count) for pairs that part in the block of this list; its words come in order."""
    m, block = map(int, name.split(":", 2)[:2])
    wide = max(BLOCK, -(-m // BLOCKS))
    last = -(-m // wide) - 1
    lcps = [0, *map(shared, words, words[1:])]
    common = shared(words[0], words[-1])
    for at, query in enumerate(words):
        if len(query) != m:
            continue
        for other in scan(query, words, lcps, common):
            word = words[other]
            if min(min(shared(query, word), m) // wide, last) == block:
                yield query, word, numbers[other]
                if len(word) > m:
                    yield word, query, numbers[at]


def near_words(words: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(word, near, near_n): all pairs of words one edit apart, from both sides."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[str, str, int]] = []
        for name, group, numbers in sorted_lists(batches):
            found += links_of(name, group, numbers)
            if len(found) >= OUT_ROWS:
                yield link_batch(found)
                found = []
        yield link_batch(found)

    placed = words.select("word", "n", F.explode(lists_of(F.col("word"), min_chars)).alias("list"))
    dealt = placed.repartition("list").sortWithinPartitions("list", "word").select("list", "word", "n")
    return dealt.mapInArrow(linked, "word string, near string, near_n long")


def link_batch(found: list[tuple[str, str, int]]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [(), (), ()]
    kinds = (pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "near", "near_n"])


def sorted_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str], list[int]]]:
    """Lists of more than one word, from rows sorted by list; a list may go over several batches."""
    name, words, numbers = None, [], []
    for batch in batches:
        for key, word, n in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if key == name:
                words.append(word)
                numbers.append(n)
            else:
                if len(words) > 1:
                    yield name, words, numbers
                name, words, numbers = key, [word], [n]
    if len(words) > 1:
        yield name, words, numbers


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: the last word that forms lead to.

    ``forms`` has (word, form). Each round doubles the steps taken. Counts at
    least double from word to form, so chains, and rounds, are few.
    """
    ends = landed(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        step = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = landed(
            ends.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling_roots",
        )
        ends = after.select("word", "root")
        if not after.where("moved").head(1):
            return ends


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word."""
    words = landed(vocabulary(docs, id_col, text_col, min_chars, min_count), "spelling_words")
    best = near_words(words, min_chars).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    frequent = -F.col("best.less") >= ratio * F.col("n")
    known = words.join(best, "word", "left").select(
        "word",
        F.when(frequent, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, -F.col("best.less")).alias("form_n"),
    )
    known = landed(known, "spelling_forms")
    ends = roots(known.where("form IS NOT NULL").select("word", "form"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
