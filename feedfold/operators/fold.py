"""The keyed fold: from change records to at most one row per key.

Records and folded rows share one shape, the *patch*:

* the key columns,
* ``ord``: arrival order of the last record in it,
* ``alive``: whether the last record was an upsert,
* ``reset``: whether a delete is in it,
* one struct column per column group: null where no record set the group.

Folding patches gives a patch again and is associative as long as patches
follow arrival order, so one function serves a batch, a micro-batch, the
merge with stored rows, and compaction.

A group's value is the one at the latest patch that set the group *or* holds
a reset. A reset without the group therefore wins with null, which makes a row
start empty after a delete. No window and no second pass are needed, the
aggregate combines before the shuffle, and a hot key shrinks to one row per
input task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedfold.operators.records import DELETE, order_of_record

Groups = Mapping[str, Sequence[str]]


def presence_groups(columns: Sequence[str], schemas: Iterable[Iterable[str]]) -> dict[str, list[str]]:
    """Columns that always occur in the same record schemas share a group.

    Only right where nulls overwrite; else presence differs row by row and
    every column needs a group of its own.
    """
    schemas = [frozenset(s) for s in schemas]
    found: dict[tuple[bool, ...], list[str]] = {}
    for column in columns:
        found.setdefault(tuple(column in s for s in schemas), []).append(column)
    return {f"g{n}": members for n, members in enumerate(found.values())}


def single_groups(columns: Sequence[str]) -> dict[str, list[str]]:
    """One group per column."""
    return {f"g{n}": [column] for n, column in enumerate(columns)}


def patches(
    records: DataFrame,
    keys: Sequence[str],
    groups: Groups,
    present: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Patches of classified records that carry the columns themselves.

    ``present`` tells, per group, whether the record sets it; a missing entry
    means that every upsert does.
    """
    present = present or {}
    upsert = F.col("op") != DELETE
    structs = [
        F.when(upsert & present.get(name, F.lit(True)), F.struct(*members)).alias(name)
        for name, members in groups.items()
    ]
    return records.select(
        *keys,
        order_of_record().alias("ord"),
        upsert.alias("alive"),
        (~upsert).alias("reset"),
        *structs,
    )


def _before_all() -> Column:
    """An order before that of any record."""
    return F.struct(F.lit(-1).alias("partition"), F.lit(-1).cast("bigint").alias("offset"))


def stored_patches(rows: DataFrame, keys: Sequence[str], groups: Groups) -> DataFrame:
    """Patches of stored rows, older than any record unless they carry ``ord``."""
    order = F.col("ord") if "ord" in rows.columns else _before_all()
    return rows.select(
        *keys,
        order.alias("ord"),
        F.lit(True).alias("alive"),
        F.lit(False).alias("reset"),
        *[F.struct(*members).alias(name) for name, members in groups.items()],
    )


def combine(
    rows: DataFrame, keys: Sequence[str], groups: Iterable[str], *extra: Column, found: Mapping[str, Column] | None = None
) -> DataFrame:
    """Fold patches to one per key; ``extra`` are further aggregates.

    ``found`` gives the values of groups that are not columns of that name.
    """
    values = []
    for name in groups:
        value = (found or {}).get(name, F.col(name))
        counts = F.col("reset") | value.isNotNull()
        values.append(F.max_by(value, F.when(counts, F.col("ord"))).alias(name))
    return rows.groupBy(*keys).agg(
        F.max("ord").alias("ord"),
        F.max_by("alive", "ord").alias("alive"),
        F.bool_or("reset").alias("reset"),
        *values,
        *extra,
    )


def live_rows(folded: DataFrame, keys: Sequence[str], groups: Groups) -> DataFrame:
    """Current rows of folded patches."""
    columns = [
        F.col(name)[member].alias(member)
        for name, members in groups.items()
        for member in members
        if member not in keys
    ]
    return folded.filter("alive").select(*keys, *columns)


def fold(
    records: DataFrame,
    keys: Sequence[str],
    groups: Groups,
    present: Mapping[str, Column] | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Current rows after applying ``records`` to the ``stored`` rows."""
    rows = patches(records, keys, groups, present)
    if stored is not None:
        rows = rows.unionByName(stored_patches(stored, keys, groups))
    return live_rows(combine(rows, keys, groups), keys, groups)


def latest(records: DataFrame, keys: Sequence[str], *payload: str) -> DataFrame:
    """Last record per key, without the keys whose last record is a delete.

    This is the fold for whole-row replacement. ``payload`` can be undecoded
    text, so that only surviving rows are decoded.
    """
    last = records.groupBy(*keys).agg(
        F.max_by(F.struct("op", *payload), order_of_record()).alias("_last")
    )
    return last.filter(F.col("_last.op") != DELETE).select(
        *keys, *[F.col("_last")[p].alias(p) for p in payload]
    )


def replace_rows(
    stored: DataFrame, records: DataFrame, keys: Sequence[str], payload: str, sent: str
) -> DataFrame:
    """Whole-row replacement on stored rows.

    Gives the keys, ``stored`` (the row as it was, null where replaced) and
    ``sent`` (the undecoded payload that replaces it, null where untouched).
    """
    row = F.struct(*[c for c in stored.columns if c not in keys])
    old = stored.select(*keys, _before_all().alias("ord"), F.lit("u").alias("op"), row.alias("stored"))
    new = records.select(*keys, order_of_record().alias("ord"), "op", F.col(payload).alias(sent))
    both = new.unionByName(old, allowMissingColumns=True)
    last = both.groupBy(*keys).agg(F.max_by(F.struct("op", "stored", sent), "ord").alias("_last"))
    return last.filter(F.col("_last.op") != DELETE).select(*keys, "_last.stored", f"_last.{sent}")


def delete_rows(stored: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows without the deleted keys; deletes of absent keys do nothing."""
    return stored.join(deletes.select(*keys).distinct(), list(keys), "left_anti")


def as_of(records: DataFrame, offset: int) -> DataFrame:
    """Records up to and with ``offset``; the filter reaches the scan."""
    return records.filter(F.col("offset") <= offset)


def as_of_time(records: DataFrame, instant: Column) -> DataFrame:
    """Records up to and with an instant."""
    return records.filter(F.col("ts") <= instant)
