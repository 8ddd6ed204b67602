"""A table's layout and how record schemas change it.

Layouts are a handful of names and types per table and live on the driver;
rows never do.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from feedfold.functions import rules
from feedfold.functions.convert import Field
from feedfold.options import Options
from feedfold.sources.decode import JSON_SCHEMA_TYPES


#: Digits of the widest decimal column.
MAX_PRECISION = 38


class RefusedSchema(ValueError):
    """A record schema that a table cannot take; ``reason`` goes into the reject table."""

    def __init__(self, reason: str, detail: str) -> None:
        super().__init__(f"{reason}: {detail}")
        self.reason = reason


def fields_of(schema_json: str, envelope: str = "flat") -> list[Field]:
    """Fields of a record schema text; with the ``after`` envelope, those of the row inside."""
    described = json.loads(schema_json)
    if envelope == "after":
        inside = [f for f in described.get("fields", []) if f.get("field") == "after"]
        described = inside[0] if inside else described
    return [
        Field(
            f["field"],
            JSON_SCHEMA_TYPES.get(f["type"], f["type"].upper()),
            f.get("name"),
            dict(f.get("parameters") or {}),
        )
        for f in described.get("fields", [])
    ]


def schema_json(fields: list[Field]) -> str:
    """Schema text of supplied fields, for feeds whose records do not describe themselves."""
    return json.dumps({"type": "struct", "fields": [describe(f) for f in fields]})


def describe(f: Field) -> dict:
    entry: dict = {"field": f.name, "type": f.physical.lower()}
    if f.logical:
        entry["name"] = f.logical
    if f.params:
        entry["parameters"] = dict(f.params)
    return entry


@dataclass(frozen=True)
class Layout:
    """Key fields and other columns of a table, in order.

    ``since`` is, per column, the (batch, partition, offset) of the record
    that added it: values from before do not count. Layouts compare equal
    without it. ``sent`` is, per topic partition, the fields of its last record
    schema, which decides when a column is dropped.
    """

    keys: tuple[Field, ...]
    columns: tuple[Field, ...]
    since: dict[str, tuple[int, int, int]] = field(default_factory=dict, compare=False)
    sent: dict[int, list[str]] = field(default_factory=dict, compare=False)

    @property
    def key_names(self) -> list[str]:
        return [f.name for f in self.keys]

    @property
    def column_names(self) -> list[str]:
        return [f.name for f in self.columns]


def create(keys: list[Field], value: list[Field]) -> Layout:
    """Layout of a new table: keys first, then the value's other fields."""
    names = {f.name for f in keys}
    _refuse_unsupported([*keys, *value])
    return Layout(tuple(keys), tuple(f for f in value if f.name not in names))


def _refuse_unsupported(fields: list[Field]) -> None:
    for f in fields:
        if f.internal == rules.OTHER:
            raise RefusedSchema("unsupported_type", f"{f.name} is {f.physical}/{f.logical}")
        if f.internal == "DECIMAL":
            size = f.decimal_type()
            if not (0 < size.precision <= MAX_PRECISION and 0 <= size.scale <= size.precision):
                raise RefusedSchema("unsupported_type", f"{f.name} is {size.simpleString()}")


def evolve(
    layout: Layout, keys: list[Field], value: list[Field], options: Options, at: tuple[int, int, int]
) -> Layout:
    """Layout after a record schema that first occurs at ``at``.

    Adds new columns, drops missing ones unless they are allowed, and refuses
    a column whose type differs or a key of other columns.
    """
    if {f.name for f in keys} != set(layout.key_names):
        raise RefusedSchema("key_change", f"{[f.name for f in keys]} for {layout.key_names}")
    _refuse_unsupported([*keys, *value])
    if not options.evolves:
        return _grow(layout, value, at)
    held = {f.name: f for f in (*layout.keys, *layout.columns)}
    target = rules.COLUMN_TYPES[options.profile]
    for f in (*keys, *value):
        if f.name in held and target[f.internal] != target[held[f.name].internal]:
            raise RefusedSchema("type_conflict", f"{f.name}: {f.internal} for {held[f.name].internal}")
    grown = _grow(layout, value, at)
    if options.allow_missing:
        return grown
    sent = {f.name for f in value}
    kept = tuple(f for f in grown.columns if f.name in sent)
    since = {name: start for name, start in grown.since.items() if name in sent}
    return replace(grown, columns=kept, since=since)


def _grow(layout: Layout, value: list[Field], at: tuple[int, int, int]) -> Layout:
    known = {f.name for f in (*layout.keys, *layout.columns)}
    added = tuple(f for f in value if f.name not in known)
    since = {**layout.since, **{f.name: at for f in added}}
    return replace(layout, columns=(*layout.columns, *added), since=since)


#: A schema change within a batch: partition, fields before (None: not known), fields after, its last offset.
Move = tuple[int, list[str] | None, list[str], int]


def settle(layout: Layout, moves: list[Move], batch: int) -> tuple[Layout, dict[str, dict[int, int]]]:
    """The layout after a batch's schema changes, and where columns start that were lost and came back in it.

    Partitions have no order among each other, so a column is lost only when every
    partition that had it dropped it. It stays if some partition's last
    schema has it, and counts there from the record that added it last.
    """
    sent, added, dropped = dict(layout.sent), {}, {}
    holders = {(p, name) for p, names in sent.items() for name in names}
    for partition, before, names, last in sorted(moves, key=lambda m: m[3]):
        before = layout.sent.get(partition, []) if before is None else before
        holders |= {(partition, name) for name in (*before, *names)}
        added |= {(partition, name): last for name in names if name not in before}
        dropped |= {(partition, name): last for name in before if name not in names}
        sent[partition] = names
    kept, since, starts = [], dict(layout.since), {}
    for f in layout.columns:
        alive = [p for p, names in sent.items() if f.name in names]
        if not alive:
            since.pop(f.name, None)
            continue
        kept.append(f)
        if all(at in dropped for at in holders if at[1] == f.name):
            starts[f.name] = {p: added[p, f.name] for p in alive}
            first = min(starts[f.name].items())
            since[f.name] = (batch, *first)
    return replace(layout, columns=tuple(kept), since=since, sent=sent), starts


def dump(layout: Layout) -> str:
    return json.dumps(
        {
            "keys": [describe(f) for f in layout.keys],
            "columns": [describe(f) for f in layout.columns],
            "since": layout.since,
            "sent": layout.sent,
        }
    )


def load(text: str) -> Layout:
    stored = json.loads(text)
    keys = fields_of(json.dumps({"fields": stored["keys"]}))
    columns = fields_of(json.dumps({"fields": stored["columns"]}))
    since = {name: tuple(start) for name, start in stored["since"].items()}
    sent = {int(partition): names for partition, names in stored.get("sent", {}).items()}
    return Layout(tuple(keys), tuple(columns), since, sent)
