"""Current-state tables as parquet files: a base per table and one delta per batch.

A delta holds the patches of one batch (see ``operators.fold``): its cost
follows the batch, not the table. Base and deltas lie in hash buckets of the key
(``sinks.buckets``). Reading a table folds both bucket by bucket, without a
shuffle; ``compact`` turns the buckets that deltas have touched into new
base files and leaves the files of the others alone.

Files become visible only through the catalog. Each version of it is a small
parquet folder that lists every table's layout, base and deltas. A batch that
is replayed after its commit is skipped; one that failed before its commit
left files no catalog names. One job writes at a time. Finding the newest version reads a
bounded number of them: one version in ``HEAD_EVERY`` is noted as a
place to start from.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.operators import layout as layouts
from feedfold.operators.fold import combine
from feedfold.operators.layout import Layout
from feedfold.options import Options
from feedfold.sinks import buckets
from feedfold.sinks.buckets import BUCKET

CATALOG_SCHEMA = (
    "last_batch bigint, `table` string, layout string, base array<struct<path: string, buckets: array<int>>>, "
    "deltas array<struct<batch: bigint, path: string>>, uniform boolean"
)
ORDER_TYPE = T.StructType(
    [T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())]
)
# Stands in for the columns of a table that has none but its keys.
NO_COLUMN = "_none"
# Keys of a delta that take up to this are sent to all tasks of a scan.
SENT_BYTES = 32 << 20
# Catalog versions between two that are noted as places to look for the newest from.
HEAD_EVERY = 16


@dataclass(frozen=True)
class TableEntry:
    """What the catalog knows of one table.

    ``base``: units, and the buckets that each of them holds for this table.
    ``uniform``: every stored patch sets all columns or none, so that they fold
    as one.
    """

    layout: Layout
    base: tuple[tuple[str, tuple[int, ...]], ...] = ()
    deltas: tuple[tuple[int, str], ...] = ()
    uniform: bool = True

    @property
    def files(self) -> tuple:
        """Tables that agree in this are read and folded together."""
        since = tuple(sorted((name, start[0]) for name, start in self.layout.since.items()))
        return self.layout, since, self.base, self.deltas, self.uniform


@dataclass(frozen=True)
class Catalog:
    version: int = -1
    last_batch: int = -1
    tables: dict[str, TableEntry] = field(default_factory=dict)


class TableStore:
    def __init__(self, spark: SparkSession, root: str, options: Options) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.options = options
        self._version = -1  # the newest one known here

    # Catalog ---------------------------------------------------------------

    def catalog(self, batch: int | None = None) -> Catalog:
        """Newest catalog, or the newest one of a batch up to ``batch``."""
        if batch is None:
            return self._loaded(*self._newest())
        return self._loaded(*self._listed(F.max(F.when(F.col("last_batch") <= batch, F.col("version"))), batch))

    def catalog_after(self, batch: int) -> Catalog:
        """The catalog that the commit of ``batch`` wrote, before any compaction."""
        return self._loaded(*self._listed(F.min(F.when(F.col("last_batch") == batch, F.col("version"))), batch))

    def _loaded(self, version: int, rows: list[Row]) -> Catalog:
        tables = {
            row["table"]: TableEntry(
                layouts.load(row["layout"]),
                tuple((b["path"], tuple(b["buckets"])) for b in row["base"]),
                tuple((d["batch"], d["path"]) for d in row["deltas"]),
                row["uniform"],
            )
            for row in rows
            if row["table"] is not None
        }
        return Catalog(version, rows[0]["last_batch"], tables)

    def commit(self, catalog: Catalog) -> Catalog:
        """Write the next version; a row without a table keeps the batch number."""
        version = catalog.version + 1
        rows = [
            (catalog.last_batch, name, layouts.dump(e.layout), list(e.base), list(e.deltas), e.uniform)
            for name, e in sorted(catalog.tables.items())
        ]
        self._write_catalog(version, catalog.last_batch, rows, "overwrite")
        if version % HEAD_EVERY == 0:
            head = self.spark.createDataFrame([(version,)], "version bigint").coalesce(1)
            head.write.mode("overwrite").parquet(f"{self.root}/head")
        self._version = version
        return replace(catalog, version=version)

    def _newest(self) -> tuple[int, list[Row]]:
        """The newest version and its rows, looked for from one that is known or noted."""
        start = self._version if self._version >= 0 else self._head()
        while True:
            found = self._versions(start, start + HEAD_EVERY)
            newest = max(row["version"] for row in found)
            if newest < start + HEAD_EVERY:
                break
            start = newest
        self._version = newest
        return newest, [row for row in found if row["version"] == newest]

    def _versions(self, first: int, last: int) -> list[Row]:
        """Rows of those of these versions that are there; the first one is."""
        numbers = ",".join(map(str, range(first, last + 1)))
        reader = self.spark.read.schema(f"{CATALOG_SCHEMA}, version bigint").option("basePath", f"{self.root}/catalog")
        return reader.parquet(f"{self.root}/catalog/version={{{numbers}}}").collect()

    def _head(self) -> int:
        """A version to start from; where the note of it was lost between its removal and its writing, the first."""
        self._write_catalog(0, -1, [], "ignore")
        note = self.spark.createDataFrame([(0,)], "version bigint").coalesce(1)
        note.write.mode("ignore").parquet(f"{self.root}/head")
        noted = self.spark.read.schema(note.schema).parquet(f"{self.root}/head").head()
        return noted["version"] if noted else 0

    def _listed(self, wanted: Column, batch: int) -> tuple[int, list[Row]]:
        """A version chosen among all, and its rows."""
        self._newest()
        versions = self.spark.read.schema(f"{CATALOG_SCHEMA}, version bigint").parquet(f"{self.root}/catalog")
        version = versions.agg(wanted).head()[0]
        if version is None:
            raise ValueError(f"no catalog as of batch {batch}")
        return version, [row for row in self._versions(version, version) if row["version"] == version]

    def _write_catalog(self, version: int, last_batch: int, rows: list[tuple], mode: str) -> None:
        marker = (last_batch, None, None, None, None, None)
        frame = self.spark.createDataFrame([marker, *rows], CATALOG_SCHEMA).coalesce(1)
        frame.write.mode(mode).parquet(f"{self.root}/catalog/version={version}")

    def new_unit(self) -> str:
        """Folder for the patches of one write."""
        return buckets.new_unit(f"{self.root}/patches", self.options.buckets)

    # Reading ---------------------------------------------------------------

    def patch_schema(self, layout: Layout) -> T.StructType:
        """Schema of stored patches; columns a file lacks read as null, that is as not set."""
        profile = self.options.profile
        key = [T.StructField(f.name, f.column_type(profile)) for f in layout.keys]
        kinds = {f.name: f.column_type(profile) for f in layout.columns} or {NO_COLUMN: T.BooleanType()}
        columns = [
            T.StructField(name, T.StructType([T.StructField("v", kind)])) for name, kind in kinds.items()
        ]
        return T.StructType(
            [
                T.StructField("batch", T.LongType()),
                T.StructField("key", T.StructType(key)),
                T.StructField("ord", ORDER_TYPE),
                T.StructField("alive", T.BooleanType()),
                T.StructField("reset", T.BooleanType()),
                T.StructField("cols", T.StructType(columns)),
                T.StructField("table", T.StringType()),
            ]
        )

    def _read(self, layout: Layout, path: str, chosen: Column) -> DataFrame:
        return buckets.read_unit(self.spark, path, self.patch_schema(layout)).filter(chosen)

    def current(self, table: str, batch: int | None = None) -> DataFrame:
        """Current rows of a table, or its rows after ``batch``."""
        entry = self.catalog(batch).tables[table]
        return rows_of(self.folded([table], entry), entry.layout).drop("table")

    def current_all(self, batch: int | None = None) -> dict[Layout, DataFrame]:
        """Current rows of all tables with a ``table`` column, one frame per layout."""
        frames: dict[Layout, DataFrame] = {}
        for tables, entry in _together(self.catalog(batch).tables):
            rows = rows_of(self.folded(tables, entry), entry.layout)
            held = frames.get(entry.layout)
            frames[entry.layout] = rows if held is None else held.unionByName(rows)
        return frames

    def folded(self, tables: list[str], entry: TableEntry, chosen: Column | None = None) -> DataFrame:
        """One patch per table and key from base and deltas; all tables share ``entry``.

        Units of one number of buckets fold without a shuffle. ``chosen`` picks
        some tables and buckets.
        """
        wanted = F.col("table").isin(tables) if chosen is None else chosen
        units = [self._read(entry.layout, path, wanted & F.col(BUCKET).isin(list(held))) for path, held in entry.base]
        units += [self._read(entry.layout, path, wanted) for _, path in entry.deltas]
        if not units:
            return self.spark.createDataFrame([], self.patch_schema(entry.layout))
        rows = reduce(DataFrame.union, units)
        return combine_patches(rows, entry) if entry.deltas else counting(rows, entry.layout).drop(BUCKET)

    def folded_changes(self, tables: list[str], entry: TableEntry) -> DataFrame:
        """One patch for each key that occurs in the last delta.

        Only the buckets that it touches are read. Where its keys take up to
        ``SENT_BYTES``, they are sent to the tasks and other keys leave the fold before it.
        """
        layout, last = entry.layout, entry.deltas[-1][1]
        delta = self._read(layout, last, F.col("table").isin(tables))
        older = [*entry.base, *[(path, None) for _, path in entry.deltas[:-1]]]
        places = delta.groupBy("table", BUCKET).agg(F.sum(F.octet_length(F.to_json("key")) + F.octet_length("table")).alias("n"))
        touched: dict[str, list[int]] = {}
        sent = 0
        for row in places.collect():  # as many as folders
            touched.setdefault(row["table"], []).append(row[BUCKET])
            sent += row["n"]
        alike = {buckets.buckets_in(path) for path in self._paths(entry)} == {buckets.buckets_in(last)}
        chosen = _in_buckets(touched) if alike else F.col("table").isin(list(touched))
        units = [
            self._read(layout, path, chosen if held is None else chosen & F.col(BUCKET).isin(list(held)))
            for path, held in older
        ]
        if sent <= SENT_BYTES:
            keys = F.broadcast(delta.select(F.col("table").alias("_table"), F.col("key").alias("_key")))
            same = (F.col("table") == F.col("_table")) & (F.col("key") == F.col("_key"))
            units = [unit.join(keys, same, "left_semi") for unit in units]
        return combine_patches(reduce(DataFrame.union, [*units, delta]), entry)

    def tables_in(self, layout: Layout, path: str) -> list[str]:
        """Tables with patches in a unit."""
        found = buckets.read_unit(self.spark, path, self.patch_schema(layout)).select("table").distinct()
        return sorted(row["table"] for row in found.collect())

    # Compaction ------------------------------------------------------------

    def compact(self, tables: list[str] | None = None) -> Catalog:
        """Write a new base for the buckets that deltas touch, without the rows they delete.

        A base row is complete: columns never set become null, and no older
        patch is left that a column's start would have to hide. Buckets without deltas
        keep their files.
        """
        catalog = self.catalog()
        entries = dict(catalog.tables)
        chosen = {name: e for name, e in entries.items() if e.deltas and (tables is None or name in tables)}
        for names, entry in _together(chosen):
            path = self.new_unit()
            same = {buckets.buckets_in(p) for p in self._paths(entry)} == {self.options.buckets}
            touched = self._touched(names, entry) if same else dict.fromkeys(names, range(self.options.buckets))
            live = self.folded(names, entry, _in_buckets(touched) if same else None).filter("alive")
            values = [F.struct(F.col("cols")[c]["v"].alias("v")).alias(c) for c in stored_names(entry.layout)]
            base = live.withColumns(
                {"reset": F.lit(True), "cols": F.struct(*values), "batch": F.lit(catalog.last_batch).cast("bigint")}
            )
            buckets.write_unit(base, path, spread=not same)
            for name in names:
                entries[name] = _compacted(entry, path, set(touched.get(name, ())), same)
        return self.commit(replace(catalog, tables=entries))

    def _paths(self, entry: TableEntry) -> list[str]:
        return [path for path, _ in entry.base] + [path for _, path in entry.deltas]

    def _touched(self, tables: list[str], entry: TableEntry) -> dict[str, list[int]]:
        """Buckets with patches in deltas, per table."""
        deltas = [self._read(entry.layout, path, F.col("table").isin(tables)) for _, path in entry.deltas]
        places = reduce(DataFrame.unionByName, [d.select("table", BUCKET) for d in deltas]).distinct()
        found: dict[str, list[int]] = {}
        for row in places.collect():  # as many as folders
            found.setdefault(row["table"], []).append(row[BUCKET])
        return found

    def write_patches(self, patches: DataFrame, path: str) -> None:
        """Write folded patches of a batch."""
        buckets.write_unit(patches, path)


def _in_buckets(touched: dict[str, list[int]]) -> Column:
    """Rows of these tables and buckets; tables with the same buckets share a test, which prunes folders."""
    by_buckets: dict[tuple[int, ...], list[str]] = {}
    for name, held in touched.items():
        by_buckets.setdefault(tuple(sorted(held)), []).append(name)
    tests = [F.col("table").isin(names) & F.col(BUCKET).isin(list(held)) for held, names in by_buckets.items()]
    return reduce(Column.__or__, tests, F.lit(False))


def _compacted(entry: TableEntry, path: str, touched: set[int], same: bool) -> TableEntry:
    """A table's entry after its touched buckets were written to ``path``."""
    kept = [(old, tuple(b for b in held if b not in touched)) for old, held in entry.base] if same else []
    kept = [(old, held) for old, held in kept if held]
    # files from before a column's start still need it to hide their values
    layout = entry.layout if kept else replace(entry.layout, since={})
    base = (*kept, (path, tuple(sorted(touched)))) if touched else tuple(kept)
    return TableEntry(layout, base, (), entry.uniform or not kept)


def _together(tables: dict[str, TableEntry]) -> list[tuple[list[str], TableEntry]]:
    """Tables whose rows lie in the same files."""
    found: dict[tuple, list[str]] = {}
    for name, entry in tables.items():
        found.setdefault(entry.files, []).append(name)
    return [(names, tables[names[0]]) for names in found.values()]


def stored_names(layout: Layout) -> list[str]:
    return layout.column_names or [NO_COLUMN]


def counted_values(layout: Layout) -> dict[str, Column]:
    """Stored columns, without values from batches before their column was (last) added.

    Within the adding batch, older values were left out when it was folded.
    """
    found = {}
    for name in stored_names(layout):
        start = layout.since.get(name)
        value = F.col("cols")[name]
        found[name] = value if start is None else F.when(F.col("batch") >= start[0], value)
    return found


def counting(patches: DataFrame, layout: Layout) -> DataFrame:
    """Patches with the values that count."""
    if not layout.since:
        return patches
    values = [value.alias(name) for name, value in counted_values(layout).items()]
    return patches.withColumn("cols", F.when(F.col("cols").isNotNull(), F.struct(*values)))


def rows_of(folded: DataFrame, layout: Layout) -> DataFrame:
    """Live rows of folded patches."""
    return folded.filter("alive").select(
        "table",
        *[F.col("key")[name].alias(name) for name in layout.key_names],
        *[F.col("cols")[name]["v"].alias(name) for name in layout.column_names],
    )


def combine_patches(patches: DataFrame, entry: TableEntry) -> DataFrame:
    """Fold stored patches to one per table and key.

    What is folded is worked out inside the aggregates: a projection between them and the
    union of units would hide from Spark that all units are partitioned alike.
    """
    values = counted_values(entry.layout)
    names = list(values)
    if entry.uniform:
        every = F.struct(*[value.alias(name) for name, value in values.items()]) if entry.layout.since else F.col("cols")
        found = {"c0": F.when(values[names[0]].isNotNull(), every)}
        whole = F.col("c0")
    else:
        found = {f"c{n}": values[name] for n, name in enumerate(names)}
        whole = F.struct(*[F.col(group).alias(name) for group, name in zip(found, names, strict=True)])
    folded = combine(patches, ["table", "key"], found, F.max("batch").alias("batch"), found=found)
    return folded.select("batch", "key", "ord", "alive", "reset", whole.alias("cols"), "table")
