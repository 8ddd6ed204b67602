"""Patch merge inside a stream: the merged row of each changed key, as it changes.

The alternative to ``FeedSink`` for consumers that want to see rows rather
than tables. A micro-batch is folded to one patch per key, natively and
before the shuffle, and appended to a table store as a delta. Merged rows are then
the fold of the stored patches of the changed keys: the buckets that the
delta touches are read, rows of other keys are left out where the changed keys are
few enough to be sent to all tasks, and nothing stored is shuffled.

The patches are committed before merged rows are given out, and merged rows are worked out
from what is committed. A replayed batch therefore changes nothing and gives
the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedfold.functions.convert import Field
from feedfold.operators import fold
from feedfold.operators import layout as layouts
from feedfold.sinks.store import NO_COLUMN, Catalog, TableEntry, TableStore

Emit = Callable[[DataFrame, int], None]


class RowMerger:
    """Merges typed records into a store and gives out the changed rows.

    Records have ``table, partition, offset, op`` and the columns of ``keys`` and
    ``columns``. A column that is null in a record is one the record lacks.
    ``emit`` receives, per batch, ``table``, the keys, ``partition, offset, alive`` and
    the columns of every changed key; a deleted one has no values.
    """

    def __init__(self, store: TableStore, keys: Sequence[Field], columns: Sequence[Field], emit: Emit) -> None:
        self.store = store
        self.layout = layouts.create(list(keys), list(columns))
        self.emit = emit

    def start(self, records: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Run on streaming records."""
        writer = records.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def apply(self, records: DataFrame, batch: int) -> None:
        """Merge one batch, unless it was committed before, and give out its rows."""
        catalog = self.store.catalog()
        if batch > catalog.last_batch:
            path = self.store.new_unit()
            self.store.write_patches(self._patches(records, batch), path)
            catalog = self.store.commit(self._with_delta(catalog, batch, path))
        else:
            catalog = self.store.catalog_after(batch)
        self.emit(self.changed(catalog, batch), batch)

    def changed(self, catalog: Catalog, batch: int) -> DataFrame:
        """Merged rows of the keys of a batch, by the catalog that its commit wrote."""
        names, entry = list(catalog.tables), next(iter(catalog.tables.values()), None)
        if entry is None or not entry.deltas or entry.deltas[-1][0] != batch:
            return self._rows(self.store.folded([], TableEntry(self.layout)))
        return self._rows(self.store.folded_changes(names, entry).filter(F.col("batch") == batch))

    def _with_delta(self, catalog: Catalog, batch: int, path: str) -> Catalog:
        """All tables share one list of files; a table is known from its first record on."""
        held = next(iter(catalog.tables.values()), TableEntry(self.layout))
        names = self.store.tables_in(self.layout, path)
        if names:
            entry = replace(held, deltas=(*held.deltas, (batch, path)), uniform=False)
            catalog = replace(catalog, tables=dict.fromkeys([*catalog.tables, *names], entry))
        return replace(catalog, last_batch=batch)

    def _patches(self, records: DataFrame, batch: int) -> DataFrame:
        """One stored patch per key."""
        keys = ["table", *self.layout.key_names]
        groups = fold.single_groups(self.layout.column_names)
        present = {group: F.col(name).isNotNull() for group, (name,) in groups.items()}
        folded = fold.combine(fold.patches(records, keys, groups, present), keys, groups)
        owner = {name: group for group, (name,) in groups.items()}
        values = [
            F.when(F.col(owner[c]).isNotNull(), F.struct(F.col(owner[c])[c].alias("v"))).alias(c)
            for c in self.layout.column_names
        ] or [F.lit(None).cast("struct<v: boolean>").alias(NO_COLUMN)]
        return folded.select(
            F.lit(batch).cast("bigint").alias("batch"), F.struct(*self.layout.key_names).alias("key"),
            "ord", "alive", "reset", F.struct(*values).alias("cols"), "table",
        )

    def _rows(self, folded: DataFrame) -> DataFrame:
        values = [F.when(F.col("alive"), F.col("cols")[c]["v"]).alias(c) for c in self.layout.column_names]
        return folded.select(
            "table", *[F.col("key")[k].alias(k) for k in self.layout.key_names],
            "ord.partition", "ord.offset", "alive", *values,
        )
