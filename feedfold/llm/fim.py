"""Fill-in-middle: texts cut in three whose middle is moved to the end, and back.

The cuts and the form of a text are drawn from a hash of its id, so a row's
outcome never depends on other rows or on how the table is split. A text is
one ``bytearray``: a sentinel is inserted before each segment, and segments
change places by rotation in place, each made of three reversals. Undoing the
same rotation and deleting the sentinels gives the text back exactly, from
the output and its form alone.

Forms: ``psm`` is prefix, suffix, middle; ``spm`` is suffix, prefix, middle,
each behind its sentinel; ``plain`` is the text itself. Cuts count code points.

Defined cases: a null text is an empty one; an empty text and one that holds a
sentinel are plain, as are the texts that the draw leaves out. A null id is
drawn as an empty one; rows that repeat an id and a text come out alike.
Other columns play no part, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100 texts so many are cut, and of 100 of these so many are in suffix-first order.
CUT_PERCENT, SPM_PERCENT = 90, 20


def turn(text: bytearray, start: int, end: int) -> None:
    text[start:end] = text[start:end][::-1]


def rotate(text: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange the segments [start, middle) and [middle, end)."""
    turn(text, start, middle)
    turn(text, middle, end)
    turn(text, start, end)


def rearrange(text: str, first: int, last: int, form: str) -> str:
    """The text in its form; ``first`` and ``last`` are the cuts in code points."""
    if form == PLAIN:
        return text
    out = bytearray(text, "utf-8")
    ascii_only = len(out) == len(text)
    first_byte = first if ascii_only else len(text[:first].encode())
    last_byte = last if ascii_only else first_byte + len(text[first:last].encode())
    for at, mark in ((last_byte, SUFFIX), (first_byte, MIDDLE), (0, PREFIX)):
        out[at:at] = mark
    middle = first_byte + len(PREFIX)
    suffix = last_byte + len(PREFIX) + len(MIDDLE)
    rotate(out, middle if form == PSM else 0, suffix, len(out))
    return out.decode()


def restore(output: str, form: str) -> str:
    """The text that ``rearrange`` was given."""
    if form == PLAIN:
        return output
    text = bytearray(output, "utf-8")
    if form == PSM:
        rotate(text, text.find(SUFFIX), text.find(MIDDLE), len(text))
    else:
        rotate(text, 0, text.find(PREFIX), len(text))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = text.find(mark)
        del text[at : at + len(mark)]
    return text.decode()


def draws(seed: str, doc_id: Column, n: int) -> list[Column]:
    """The first ``n`` 32-bit numbers of a row's hash."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "1",
    cut_percent: int = CUT_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) per row; the lengths are null for plain texts."""

    @F.pandas_udf("string")
    def made(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for parts in batches:
            yield pd.Series([rearrange(*row) for row in zip(*parts, strict=True)], dtype=object)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("*", F.length("text").cast("long").alias("n"), F.array(*draws(seed, F.col("doc_id"), 4)).alias("h"))
    cuts = [F.col("h")[i] % (F.col("n") + 1) for i in (0, 1)]
    held = [F.contains("text", F.lit(mark.decode())) for mark in (PREFIX, SUFFIX, MIDDLE)]
    plain = (F.col("n") == 0) | held[0] | held[1] | held[2] | (F.col("h")[2] % 100 >= cut_percent)
    form = F.when(plain, PLAIN).when(F.col("h")[3] % 100 < spm_percent, SPM).otherwise(PSM)
    rows = rows.select("doc_id", "text", "n", form.alias("form"), F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"))
    cut = F.col("form") != PLAIN
    return rows.select(
        "doc_id", "n", "form",
        F.when(cut, F.col("a")).alias("prefix_chars"),
        F.when(cut, F.col("b") - F.col("a")).alias("middle_chars"),
        made("text", "a", "b", "form").alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text of an output in its form."""

    @F.pandas_udf("string")
    def undone(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for outputs, forms in batches:
            yield pd.Series([restore(o, f) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return undone(output, form)


def digests(docs: DataFrame) -> DataFrame:
    """Per row its form, its lengths, and the digests of its output and of the text restored from it."""
    made = transform(docs).withColumn("restored", restored(F.col("output"), F.col("form")))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(F.col("restored"), 256).alias("restored_sha256"),
    )
