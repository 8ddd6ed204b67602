"""Applying a feed to a table store, batch by batch."""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedfold.functions import convert
from feedfold.functions.convert import Field
from feedfold.operators import fold, records, schema
from feedfold.operators import layout as layouts
from feedfold.operators.bounded import attach
from feedfold.operators.layout import Layout, RefusedSchema
from feedfold.options import Options
from feedfold.plans import build
from feedfold.sinks.store import NO_COLUMN, TableEntry, TableStore
from feedfold.sources.decode import decode_json, looks_like_object

# Name under which the JSON parser keeps a text it could not parse in full.
CORRUPT = "_corrupt"

COUNTS_SCHEMA = "`table` string, op string, received bigint, written bigint, rejected bigint"

Schemas = Mapping[str, tuple[list[Field], list[Field]]]
At = tuple[int, int, int]
Starts = Mapping[str, dict[str, dict[int, int]]]
# Per table and operation: records received, written and rejected.
Counts = dict[tuple[str, str], list[int]]


@dataclass
class _TablePlan:
    """How one table takes part in a batch."""

    layout: Layout | None
    first_upsert: tuple[int, int] | None = None
    shapes: dict[str, list[str]] | None = None  # column names per accepted schema
    refused: dict[str, str] | None = None  # reject reason per refused schema
    is_new: bool = False
    fields: dict[str, dict[str, Field]] = field(default_factory=dict)  # fields by name, per accepted schema
    starts: dict[str, dict[int, int]] = field(default_factory=dict)  # offsets by partition of columns that came back


class FeedSink:
    """Applies micro-batches of a feed to a store.

    Records either describe themselves (schema and payload) or follow
    ``schemas``: key and value fields per table. ``topic_per_task`` says that
    each input task reads one topic, as Kafka's do: the batch then lands by
    table without a shuffle.
    """

    def __init__(
        self, store: TableStore, schemas: Schemas | None = None, topic_per_task: bool = False
    ) -> None:
        self.store = store
        self.spark = store.spark
        self.options: Options = store.options
        self.schemas = schemas
        self.topic_per_task = topic_per_task

    def start(self, feed: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Run on a streaming feed; a micro-batch is one batch."""
        writer = feed.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def apply(self, feed: DataFrame, batch: int) -> None:
        """Apply one batch, unless it was committed before."""
        catalog = self.store.catalog()
        if batch <= catalog.last_batch:
            return
        staged = self._stage(feed)
        plans = self._plan_tables(staged, catalog.tables, batch)
        flagged = self._flag(staged, plans)
        counts = self._write_rejects(flagged, batch)
        changed = {name for (name, _), (_, written, _) in counts.items() if written}
        entries = dict(catalog.tables)
        for shape, names in self._shapes(plans, changed).items():
            chosen = {name: plans[name] for name in names}
            rows = self._decode(flagged.filter(F.col("table").isin(names) & F.col("applied")), shape, chosen)
            path = self.store.new_unit()
            started = {name: plan.starts for name, plan in chosen.items() if plan.starts}
            groups = self._groups(shape, chosen, bool(started))
            for name, op, refused in self._write_delta(rows, shape, chosen, (groups, started), batch, path):
                counts[name, op][1] -= refused
                counts[name, op][2] += refused
            for name in names:
                old = entries.get(name) or TableEntry(shape)
                same = self.options.mode == "replace" or old.layout == shape
                entries[name] = replace(
                    old,
                    layout=plans[name].layout,
                    deltas=(*old.deltas, (batch, path)),
                    uniform=old.uniform and same and len(groups) <= 1,
                )
        self._write_counts(counts, batch)
        self.store.commit(replace(catalog, last_batch=batch, tables=entries))

    # Steps -----------------------------------------------------------------

    def _stage(self, feed: DataFrame) -> DataFrame:
        """Land the batch once, by table, so that the source is read only once.

        The next batch overwrites it: nothing reads it after the commit.
        """
        rows = build.unwrap(feed) if self.schemas is None else self._with_schemas(feed)
        rows = build.prepare(rows, self.options)
        upsert = F.col("op") == records.UPSERT
        fingerprint = schema.fingerprint(F.col("key_schema"), F.col("value_schema"))
        malformed = F.when(~looks_like_object(F.col("key")), "malformed_key").when(
            F.col("stray") | (upsert & ~looks_like_object(F.col("value"))), "malformed_value"
        )
        staged = rows.select(
            "table", "partition", "offset", "ts", "op", "key", "value", "key_schema", "value_schema",
            F.when(upsert, fingerprint).alias("fp"),
            malformed.alias("malformed"),
            F.when(~upsert, F.json_object_keys("key")).alias("sent_keys"),
        )
        path = f"{self.store.root}/stage"
        if not self.topic_per_task:
            staged = staged.hint("rebalance", F.col("table"))
        staged.write.mode("overwrite").partitionBy("table").parquet(path)
        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in staged.schema)
        return self.spark.read.schema(types).parquet(path)

    def _with_schemas(self, feed: DataFrame) -> DataFrame:
        """Schema texts of supplied fields, looked up by table."""
        from feedfold.operators.route import table_name

        rows = [
            (name, layouts.schema_json(list(key)), layouts.schema_json(list(value)))
            for name, (key, value) in self.schemas.items()
        ]
        texts = self.spark.createDataFrame(rows, "_table string, key_schema string, value_schema string")
        routed = feed.withColumn("_table", table_name(F.col("topic"), self.options))
        return attach(routed, texts, ["_table"]).drop("_table")

    def _plan_tables(self, staged: DataFrame, known: Mapping[str, TableEntry], batch: int) -> dict[str, _TablePlan]:
        """Evolve each table's layout by the schemas of the batch.

        Usually a partition has one schema per batch. Only tables where one has
        several need the ordered scan for changes, of which the distinct ones
        reach the driver. Columns are added first; what is dropped is settled
        when all changes are known, so a column cannot change its type within a
        batch.
        """
        keyed = staged.filter(F.col("key").isNotNull())
        upserts = keyed.filter(F.col("op") == records.UPSERT)
        seen = upserts.groupBy("table", "partition", "fp").agg(F.min("offset").alias("first")).collect()
        per_partition = Counter((r["table"], r["partition"]) for r in seen)
        several = sorted({table for (table, _), n in per_partition.items() if n > 1})
        found = [(r["table"], r["partition"], None, r["fp"], r["first"], r["first"]) for r in seen if r["table"] not in several]
        if several:
            rows = upserts.filter(F.col("table").isin(several)).select("table", "partition", "offset", "fp")
            order = ["table", "partition", "previous_fp", "fp", "first", "last"]
            found += map(tuple, schema.moves(rows).select(order).collect())
        texts = self._texts(upserts, {r["fp"]: (r["table"], r["partition"], r["first"]) for r in seen}) if seen else {}
        plans = {name: _TablePlan(entry.layout, shapes={}, refused={}) for name, entry in known.items()}
        for table, partition, _, fp, first, _ in sorted(found, key=lambda m: (m[0], m[1], m[4])):
            plan = plans.setdefault(table, _TablePlan(None, shapes={}, refused={}, is_new=True))
            plan.first_upsert = plan.first_upsert or (partition, first)
            if fp not in plan.shapes and fp not in plan.refused:
                self._evolve(plan, fp, texts[fp], (batch, partition, first))
        if self.options.evolves and not self.options.allow_missing:
            for table, plan in plans.items():
                moves = [
                    # after a refused schema, what came before it is taken to be the same
                    (partition, plan.shapes.get(before, plan.shapes[fp]) if before else None, plan.shapes[fp], last)
                    for name, partition, before, fp, _, last in found
                    if name == table and fp in plan.shapes
                ]
                if moves:
                    plan.layout, plan.starts = layouts.settle(plan.layout, moves, batch)
        return plans

    def _texts(self, upserts: DataFrame, first: Mapping[str, tuple]) -> dict[str, tuple[str | None, str | None]]:
        """Schema texts by fingerprint, read from one record of each."""
        rows = [(fp, *place) for fp, place in first.items()]
        wanted = self.spark.createDataFrame(rows, "fp string, `table` string, partition int, offset bigint")
        found = attach(upserts, wanted.select("*", F.lit(True).alias("_wanted")), ["table", "partition", "offset", "fp"], "inner")
        return {r["fp"]: (r["key_schema"], r["value_schema"]) for r in found.toLocalIterator()}

    def _evolve(self, plan: _TablePlan, fp: str, texts: tuple[str | None, str | None], at: At) -> None:
        if None in texts:
            plan.refused[fp] = "no_schema"
            return
        try:
            key = layouts.fields_of(texts[0])
            value = layouts.fields_of(texts[1], self.options.envelope)
            if plan.layout is None:
                plan.layout = layouts.create(key, value)
            else:
                plan.layout = layouts.evolve(plan.layout, key, value, replace(self.options, allow_missing=True), at)
            plan.shapes[fp] = [f.name for f in value]
            plan.fields[fp] = {f.name: f for f in (*value, *key)}
        except RefusedSchema as refusal:
            plan.refused[fp] = refusal.reason
        except (json.JSONDecodeError, KeyError, AttributeError, TypeError):
            plan.refused[fp] = "bad_schema"

    def _flag(self, staged: DataFrame, plans: Mapping[str, _TablePlan]) -> DataFrame:
        """Add ``reason``, ``leading`` and ``applied``."""
        rows = [
            (
                name,
                p.layout.key_names if p.layout else None,
                p.first_upsert if p.is_new and self.options.evolves else (-1, -1),
                p.refused,
            )
            for name, p in plans.items()
        ]
        about = self.spark.createDataFrame(
            rows,
            "`table` string, key_names array<string>, starts struct<partition: int, offset: bigint>, "
            "refused map<string, string>",
        )
        known = attach(staged, about, ["table"])
        upsert = F.col("op") == records.UPSERT
        absent = F.col("starts").isNull() if self.options.evolves else F.lit(False)
        before = F.coalesce(F.struct("partition", "offset") < F.col("starts"), F.lit(False)) | absent
        flagged = records.split_rejects(
            known,
            {
                "null_key": records.null_key(known),
                **{reason: F.col("malformed") == reason for reason in ("malformed_key", "malformed_value")},
                **{
                    reason: upsert & F.col("refused")[F.col("fp")].eqNullSafe(F.lit(reason))
                    for reason in ("no_schema", "bad_schema", "key_change", "unsupported_type", "type_conflict")
                },
                "delete_key_change": records.key_changed(F.col("sent_keys")),
            },
        )
        sound, early = F.col("reason").isNull(), ~upsert & before
        flagged = flagged.withColumn("leading", sound & early)
        enabled = upsert | F.lit(self.options.deletes)
        # in words that name the reason once, as this becomes the filter of all later steps
        return flagged.withColumn("applied", sound & ~early & enabled).drop(
            "refused", "key_names", "starts", "malformed", "sent_keys"
        )

    def _rejects_path(self, batch: int, step: str) -> str:
        """Where a step of a batch puts its rejects; a replay overwrites them."""
        return f"{self.store.root}/rejects/batch={batch}/step={step}"

    def _write_rejects(self, flagged: DataFrame, batch: int) -> Counts:
        """Write the rejects of this step, if there are any, and count records by table and operation."""
        rows = records.op_counts(flagged, "table").collect()
        if any(row["rejected"] for row in rows):
            path = self._rejects_path(batch, "records")
            records.rejected(flagged).write.mode("overwrite").parquet(path)
            if self.options.strict:
                raise records.RejectedRecords(f"batch {batch}: see {path}")
        return {(r["table"], r["op"]): [r["received"], r["written"], r["rejected"]] for r in rows}

    def _write_counts(self, counts: Counts, batch: int) -> None:
        rows = [(*about, *numbers) for about, numbers in counts.items()]
        frame = self.spark.createDataFrame(rows, COUNTS_SCHEMA).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.store.root}/counts/batch={batch}")

    def _shapes(self, plans: Mapping[str, _TablePlan], changed: set[str]) -> dict[Layout, list[str]]:
        """Changed tables of one layout are folded and written together."""
        shapes: dict[Layout, list[str]] = {}
        for name, plan in plans.items():
            if plan.layout is not None and name in changed:
                shapes.setdefault(plan.layout, []).append(name)
        return shapes

    def _decode(self, rows: DataFrame, layout: Layout, plans: Mapping[str, _TablePlan]) -> DataFrame:
        """Typed key and columns of records, and the ``reason`` why a record is refused here.

        A record is decoded by the fields of its own schema, then brought to
        the column types that the table holds. Usually all schemas of a batch
        agree on the fields they share, and there is one pass.
        """
        parts = [self._decode_as(rows.filter(test), layout, fields) for fields, test in _variants(layout, plans)]
        return reduce(DataFrame.unionByName, parts)

    def _decode_as(self, rows: DataFrame, layout: Layout, fields: tuple[Field, ...]) -> DataFrame:
        options, held, n = self.options, (*layout.keys, *layout.columns), len(layout.keys)
        rows = rows.select(
            "table", "partition", "offset", "op", "fp",
            F.col("key").alias("key_text"), F.col("value").alias("value_text"),
            decode_json(F.col("key"), list(fields[:n]), CORRUPT).alias("_key"),
            decode_json(F.col("value"), list(fields[n:]), CORRUPT).alias("_row"),
        )
        corrupt = [F.col(side)[CORRUPT].isNotNull() for side in ("_key", "_row")]
        rows = rows.withColumn("_bad", F.coalesce(corrupt[0], F.lit(False)) | F.coalesce(corrupt[1], F.lit(False)))
        rows = convert.typed(rows, "_key", list(fields[:n]), options, "k_").withColumnRenamed("failed", "_failed_key")
        rows = convert.typed(rows, "_row", list(fields[n:]), options, "v_")
        failed = F.col("_bad") | (F.size("_failed_key") > 0) | (F.size("failed") > 0)
        fitted = {}
        for at, (sent, kept) in enumerate(zip(fields, held, strict=True)):
            name = ("k_" if at < n else "v_") + kept.name
            types = sent.column_type(options.profile), kept.column_type(options.profile)
            if types[0] != types[1]:
                fitted[name] = _fitted(F.col(name), *types)
                failed = failed | (F.col(name).isNotNull() & fitted[name].isNull())
        keys = [fitted.get(f"k_{f.name}", F.col(f"k_{f.name}")).alias(f.name) for f in layout.keys]
        lacks_key = reduce(Column.__or__, [F.col(f"k_{f.name}").isNull() for f in layout.keys], F.lit(False))
        return rows.select(
            "table", "partition", "offset", "op", "fp", "key_text", "value_text",
            F.struct(*keys).alias("key"),
            *[fitted.get(f"v_{f.name}", F.col(f"v_{f.name}")).alias(f"v_{f.name}") for f in layout.columns],
            F.when(failed, "cast_failed").when(lacks_key, "null_key").alias("reason"),
        )

    def _write_delta(
        self,
        rows: DataFrame,
        layout: Layout,
        plans: Mapping[str, _TablePlan],
        grouping: tuple[dict[str, list[str]], Starts],
        batch: int,
        path: str,
    ) -> list[tuple[str, str, int]]:
        """Write the patches, and give the numbers of records refused on the way, by table and operation.

        Only if there are any does a second pass write them to the reject table.
        """
        seen = Observation()
        counted = rows.observe(seen, F.count_if(F.col("reason").isNotNull()).alias("failures"))
        good = counted.filter(F.col("reason").isNull()).drop("reason", "key_text", "value_text")
        self.store.write_patches(self._patches(good, layout, plans, grouping, batch), path)
        if not _may_exceed_zero(seen, "failures"):
            return []
        bad = _refused(rows)
        step = hashlib.sha256(min(plans).encode()).hexdigest()[:16]
        bad.write.mode("overwrite").parquet(self._rejects_path(batch, step))
        op = F.when(F.col("value").isNull(), records.DELETE).otherwise(records.UPSERT).alias("op")
        written = self.spark.read.schema(bad.schema).parquet(self._rejects_path(batch, step))
        found = written.groupBy("table", op).agg(F.count("*").alias("n")).collect()  # at most two rows a table
        if found and self.options.strict:
            raise records.RejectedRecords(f"batch {batch}: see {self._rejects_path(batch, step)}")
        return [(r["table"], r["op"], r["n"]) for r in found]

    def _groups(self, layout: Layout, plans: Mapping[str, _TablePlan], started: bool) -> dict[str, list[str]]:
        """Columns that are set together in every record of the batch."""
        columns = layout.column_names
        if self.options.mode == "replace":
            return {"g0": columns} if columns else {}
        if started or not self.options.null_overwrites:
            return fold.single_groups(columns)
        return fold.presence_groups(columns, _shapes_of(plans).values())

    def _patches(
        self,
        rows: DataFrame,
        layout: Layout,
        plans: Mapping[str, _TablePlan],
        grouping: tuple[dict[str, list[str]], Starts],
        batch: int,
    ) -> DataFrame:
        """Folded patches of the applied records of tables that share a layout."""
        columns = layout.column_names
        groups, started = grouping
        present: dict[str, Column] = {}
        if self.options.mode != "replace":
            shapes = _shapes_of(plans)
            rows = self._with_starts(rows, started)
            present = {g: self._present(members, shapes, bool(started)) for g, members in groups.items()}
        renamed = {g: [f"v_{m}" for m in members] for g, members in groups.items()}
        folded = fold.combine(fold.patches(rows, ["table", "key"], renamed, present), ["table", "key"], renamed)
        owner = {m: g for g, members in groups.items() for m in members}
        wrapped = [
            F.when(F.col(owner[c]).isNotNull(), F.struct(F.col(owner[c])[f"v_{c}"].alias("v"))).alias(c)
            for c in columns
        ] or [F.lit(None).cast("struct<v: boolean>").alias(NO_COLUMN)]
        return folded.select(
            F.lit(batch).cast("bigint").alias("batch"), "key", "ord", "alive", "reset",
            F.struct(*wrapped).alias("cols"), "table",
        )

    def _with_starts(self, rows: DataFrame, started: Starts) -> DataFrame:
        """Add ``starts``: per column that came back in this batch, its first offset by partition."""
        if not started:
            return rows
        frame = self.spark.createDataFrame(
            list(started.items()), "`table` string, starts map<string, map<int, bigint>>"
        )
        return attach(rows, frame, ["table"])

    def _present(self, members: list[str], shapes: Mapping[str, list[str]], started: bool) -> Column:
        """Whether a record sets a group, by its schema, the null policy and the group's start."""
        holding = [fp for fp, names in shapes.items() if members[0] in names]
        test = F.col("fp").isin(holding)
        if not self.options.null_overwrites:
            test = test & F.col(f"v_{members[0]}").isNotNull()
        if started:
            start = F.col("starts")[members[0]]
            test = test & (start.isNull() | (F.col("offset") >= start[F.col("partition")]))
        return F.coalesce(test, F.lit(False))


def _refused(rows: DataFrame) -> DataFrame:
    """Decoded records with a ``reason``, as the reject table has them.

    They are observed first: else the filter would go below the decoding, and that would be done twice for each record.
    """
    told = rows.observe(Observation(), F.count_if(F.col("reason").isNotNull()).alias("failures"))
    return told.filter(F.col("reason").isNotNull()).select(
        "table", "partition", "offset", "reason", F.col("key_text").alias("key"), F.col("value_text").alias("value")
    )


def _variants(layout: Layout, plans: Mapping[str, _TablePlan]) -> Iterator[tuple[tuple[Field, ...], Column]]:
    """Fields to decode the layout's columns with, and the records they are for; first those the table holds."""
    held = (*layout.keys, *layout.columns)
    found: dict[tuple[Field, ...], list[str]] = {}
    for plan in plans.values():
        for fp, sent in plan.fields.items():
            found.setdefault(tuple(sent.get(f.name, f) for f in held), []).append(fp)
    found.pop(held, None)
    others = [fp for fps in found.values() for fp in fps]
    yield held, F.coalesce(~F.col("fp").isin(others), F.lit(True))
    for fields, fps in found.items():
        yield fields, F.col("fp").isin(fps)


def _fitted(value: Column, sent: T.DataType, held: T.DataType) -> Column:
    """A value as the held type; null where it does not come back as it was."""
    cast = value.try_cast(held)
    return F.when(cast.try_cast(sent) == value, cast)


def _shapes_of(plans: Mapping[str, _TablePlan]) -> dict[str, list[str]]:
    """Column names per accepted schema."""
    return {fp: names for plan in plans.values() for fp, names in plan.shapes.items()}


def _may_exceed_zero(seen: Observation, name: str) -> bool:
    """Whether an observed count may be above zero.

    The count is missing where execution found a side empty and skipped it.
    """
    try:
        return bool(seen.get[name])
    except (Py4JJavaError, KeyError):
        return True
