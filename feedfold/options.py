"""Settings of a change-feed job."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

PROFILES = ("column_table", "row_cache", "lake")
LAKE_FORMATS = ("parquet", "orc", "avro")

# Property names a sink configuration file uses, and our field for each.
PROPERTY_FIELDS = {
    "topic.replace.prefix": ("topic_prefix", str),
    "table.name.format": ("dot_replacement", str),
    "table.name.prefix": ("table_prefix", str),
    "message.extract": ("envelope", str),
    "batch.size": ("segment_rows", int),
    "delete.enabled": ("deletes", bool),
    "allow-record-fields-less-than-table-fields": ("allow_missing", bool),
    "ignore-null-values": ("null_overwrites", bool),
    "timezoned.source": ("source_utc_offset_hours", int),
    "default.partition.buckets": ("buckets", int),
    "table.namespace": ("lake_namespace", str),
}
# The one property that is a prefix of the file format's own key.
LAKE_FORMAT_SUFFIX = "default.write.format"


@dataclass(frozen=True)
class Options:
    """Settings of one job.

    ``profile`` picks the target's behaviour: ``column_table`` evolves its
    schema, sets only the columns a record carries and lower-cases table
    names; ``row_cache`` never evolves and always stores nulls; ``lake``
    stores date and time types as text. ``decimal_format`` says how decimals
    are sent: ``base64`` bytes of the unscaled number, or ``numeric``.
    """

    profile: str = "column_table"
    topic_prefix: str | None = None
    dot_replacement: str | None = "_"
    table_prefix: str | None = None
    envelope: str = "flat"
    segment_rows: int = 1000
    deletes: bool = True
    allow_missing: bool = False
    null_overwrites: bool = True
    source_utc_offset_hours: int = 8
    micro_exact: bool = False
    decimal_format: str = "base64"
    buckets: int = 5
    lake_format: str = "avro"
    lake_namespace: str = "default"
    strict: bool = False

    def __post_init__(self) -> None:
        if self.profile not in PROFILES:
            raise ValueError(f"profile must be one of {PROFILES}, not {self.profile!r}")
        if self.envelope not in ("flat", "after"):
            raise ValueError(f"envelope must be 'flat' or 'after', not {self.envelope!r}")
        if self.lake_format not in LAKE_FORMATS:
            raise ValueError(f"lake_format must be one of {LAKE_FORMATS}, not {self.lake_format!r}")
        if self.decimal_format not in ("base64", "numeric"):
            raise ValueError(f"decimal_format must be 'base64' or 'numeric', not {self.decimal_format!r}")
        if self.segment_rows < 1 or self.buckets < 1:
            raise ValueError("segment_rows and buckets must be positive")
        if self.profile == "row_cache" and not self.null_overwrites:
            raise ValueError("the row_cache profile always stores nulls")

    @property
    def evolves(self) -> bool:
        return self.profile != "row_cache"

    @property
    def lower_table_names(self) -> bool:
        return self.profile == "column_table"

    @property
    def mode(self) -> str:
        """How an upsert meets the stored row: ``patch`` keeps columns the record lacks."""
        if self.profile == "row_cache" and not self.allow_missing:
            return "replace"
        return "patch"

    def but(self, **changes) -> Options:
        return replace(self, **changes)

    @classmethod
    def from_properties(cls, properties: Mapping[str, str], profile: str = "column_table") -> Options:
        """Read a sink configuration; keys without a meaning here are left alone."""
        found: dict[str, object] = {}
        for name, text in properties.items():
            if name.endswith(LAKE_FORMAT_SUFFIX):
                found["lake_format"] = text.lower()
                continue
            if name not in PROPERTY_FIELDS:
                continue
            field, kind = PROPERTY_FIELDS[name]
            if kind is bool:
                found[field] = str(text).strip().lower() == "true"
            else:
                found[field] = kind(text)
        if "envelope" in found:
            found["envelope"] = "after" if str(found["envelope"]).upper() == "DEBEZIUM" else "flat"
        if profile == "row_cache":
            found.pop("null_overwrites", None)
        return cls(profile=profile, **found)
