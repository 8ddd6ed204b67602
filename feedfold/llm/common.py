"""Helpers shared by the operators: tables, scratch data and bounded batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.session import landed, scratch_path

__all__ = ["bounded_batches", "bounded_runs", "landed", "outcome", "scratch_path", "table", "unused"]

#: Characters of text that one task works on at a time.
BATCH_CHARS = 2_000_000
#: Bytes of rows that go to a Python worker at once, and Spark's setting for them.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(columns: Sequence[str], wanted: str) -> str:
    """``wanted``, lengthened until no column has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def bounded_batches(spark: SparkSession) -> None:
    """From now on this session sends rows to Python workers in batches of at most ``BATCH_BYTES``, or less if it is set so.

    A batch is held several times over, by the executor and by its workers; the number of its rows alone bounds nothing
    where texts are long.
    """
    held = spark.conf.get(BATCH_SETTING).removesuffix("b")
    if not held.isdecimal() or int(held) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def bounded_runs(texts: Sequence[str], limit: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts with about ``limit`` characters each."""
    start = size = 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield start, at + 1
            start, size = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def starts_of(sizes: Iterable[int], first: int = 0) -> list[int]:
    """Where each part begins when the parts stand one after another."""
    return list(accumulate(sizes, initial=first))[:-1]


def outcome(spans: list[tuple[int, int, str]]) -> str:
    """Spans as ``kind:start:end`` joined by commas."""
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def joined_spans(spans):
    """The column form of ``outcome`` for an array of (start, end, kind) structs."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
