"""Declared dataset specifications; schemas are never inferred."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import types as T

ROLES = ("KEY", "EVENT_TIME", "VECTOR", "TEXT", "METADATA", "TOMBSTONE", "LINEAGE")
SINGLE = ("KEY", "EVENT_TIME", "TOMBSTONE")
INDEXES = {"IVF": {"VECTOR"}, "BTREE": {"KEY", "EVENT_TIME", "METADATA", "LINEAGE"}, "BITMAP": {"METADATA", "TOMBSTONE"}, "ZONEMAP": {"EVENT_TIME", "LINEAGE"}, "INVERTED": {"TEXT"}}
LINEAGE = {"window_seq": "long", "source_sequence": "long", "event_digest": "binary"}


class SpecError(ValueError):
    pass


@dataclass(frozen=True)
class Field:
    name: str
    role: str
    type: str
    dimension: int | None = None


@dataclass(frozen=True)
class Index:
    name: str
    kind: str
    column: str


@dataclass(frozen=True)
class DatasetSpec:
    """An immutable revision: fields in order and indexes, known by the digest of their canonical JSON."""

    fields: tuple[Field, ...]
    indexes: tuple[Index, ...] = ()
    metric: str = "cosine"

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise SpecError("a field twice")
        for f in self.fields:
            if f.role not in ROLES:
                raise SpecError(f"unknown role {f.role}")
            if f.role == "VECTOR" and (not f.dimension or f.dimension < 8 or f.dimension % 8):
                raise SpecError("a vector's dimension is a multiple of 8")
        for role in SINGLE:
            if sum(f.role == role for f in self.fields) != 1:
                raise SpecError(f"exactly one {role}")
        if {f.name: f.type for f in self.fields if f.role == "LINEAGE"} != LINEAGE:
            raise SpecError("the lineage fields are fixed")
        roles = {f.name: f.role for f in self.fields}
        if len({i.name for i in self.indexes}) != len(self.indexes):
            raise SpecError("an index name twice")
        for i in self.indexes:
            if i.kind not in INDEXES or roles.get(i.column) not in INDEXES[i.kind]:
                raise SpecError(f"no {i.kind} index on {i.column}")

    def by_role(self, role: str) -> list[str]:
        return [f.name for f in self.fields if f.role == role]

    def schema(self) -> T.StructType:
        kinds = {"string": T.StringType(), "long": T.LongType(), "bool": T.BooleanType(), "binary": T.BinaryType(), "timestamp": T.TimestampType(), "vector": T.ArrayType(T.FloatType())}
        fixed = {"KEY", "TOMBSTONE", "LINEAGE"}
        return T.StructType([T.StructField(f.name, kinds[f.type], f.role not in fixed) for f in self.fields])

    def digest(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, separators=(",", ":")).encode()).hexdigest()

    def index_targets(self) -> list[Index]:
        """Declared indexes, or one a vector, text and metadata field in order of name."""
        if self.indexes:
            return list(self.indexes)
        kinds = (("VECTOR", "IVF"), ("METADATA", "BTREE"), ("TEXT", "INVERTED"))
        return [Index(f"{c}_{k.lower()}", k, c) for role, k in kinds for c in sorted(self.by_role(role))]


def check_partitions(found: list[tuple[str, str]], declared: list[tuple[str, str]]) -> None:
    """Partition fields (column, transform) must be those declared, in their order."""
    if list(found) != list(declared):
        raise SpecError(f"partitioned by {found}, not {declared}")


def check_checkpoint(table_uuid: str, spec_id: int, schema_digest: str, checkpoint: dict) -> None:
    """A table must be the one that a checkpoint was taken of."""
    now = {"table_uuid": table_uuid, "spec_id": spec_id, "schema_digest": schema_digest}
    changed = [k for k, v in now.items() if checkpoint.get(k) != v]
    if changed:
        raise SpecError(f"changed since the checkpoint: {changed}")


def default_spec(dimension: int = 128) -> DatasetSpec:
    fields = [Field("record_id", "KEY", "string"), Field("ts", "EVENT_TIME", "timestamp"), Field("vector", "VECTOR", "vector", dimension), Field("text", "TEXT", "string"), Field("cluster", "METADATA", "string")]
    fields += [Field(n, "LINEAGE", t) for n, t in LINEAGE.items()] + [Field("is_deleted", "TOMBSTONE", "bool")]
    return DatasetSpec(tuple(fields))
