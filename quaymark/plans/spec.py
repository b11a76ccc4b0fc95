"""Declared tables and columns: what is migrated, how each column is protected and compared."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from enum import StrEnum

from pyspark.sql import types as T


class Protection(StrEnum):
    NONE = "none"
    TOKENIZE = "tokenize"
    ENCRYPT = "encrypt"
    REDACT = "redact"

    @property
    def deterministic(self) -> bool:
        return self in (Protection.NONE, Protection.TOKENIZE)


class Logical(StrEnum):
    STRING = "string"
    INT = "int"
    DECIMAL = "decimal"
    FLOAT = "float"
    BOOL = "bool"
    TIMESTAMP = "timestamp"
    DATE = "date"
    BYTES = "bytes"
    JSON = "json"


#: Columns that every target table has besides its own.
META_LSN, META_DELETED, META_UPDATED = "_mig_lsn", "_mig_deleted", "_mig_updated_at"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: Logical = Logical.STRING
    target_name: str = ""
    protect: Protection = Protection.NONE
    nullable: bool = False
    trim_trailing_space: bool = False
    scale: int = 0

    @property
    def target(self) -> str:
        return self.target_name or self.name

    def spark_type(self) -> T.DataType:
        return {
            Logical.STRING: T.StringType(), Logical.INT: T.LongType(), Logical.DECIMAL: T.DecimalType(38, self.scale), Logical.FLOAT: T.DoubleType(),
            Logical.BOOL: T.BooleanType(), Logical.TIMESTAMP: T.TimestampType(), Logical.DATE: T.DateType(), Logical.BYTES: T.BinaryType(), Logical.JSON: T.StringType(),
        }[self.type]


def split_table(name: str) -> tuple[str, str]:
    """(schema, table) of a name, split at its last dot."""
    schema, _, table = name.rpartition(".")
    return schema, table


@dataclass(frozen=True)
class TableSpec:
    source: str
    target: str
    primary_key: tuple[str, ...]
    columns: tuple[ColumnSpec, ...]
    chunk_column: str = ""
    chunk_size: int = 50_000
    exclude: str = ""

    def column(self, name: str) -> ColumnSpec | None:
        return next((c for c in self.columns if c.name == name), None)

    def comparable(self) -> list[ColumnSpec]:
        """Columns that both sides can be compared on; what is encrypted or left out can't be."""
        return [c for c in self.columns if c.protect not in (Protection.ENCRYPT, Protection.REDACT)]

    def kept(self) -> list[ColumnSpec]:
        return [c for c in self.columns if c.protect != Protection.REDACT]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type(), True) for c in self.columns])

    def problems(self) -> list[str]:
        """Everything that is wrong with the declaration."""
        out = []
        if not split_table(self.source)[1] or not split_table(self.target)[1]:
            out.append("source and target need a table name")
        if not self.primary_key:
            out.append("a primary key is required")
        for what, names in (("source", [c.name for c in self.columns]), ("target", [c.target for c in self.columns])):
            out += [f"duplicate {what} column {n}" for n in sorted({n for n in names if names.count(n) > 1})]
        for name in self.primary_key:
            column = self.column(name)
            if column is None:
                out.append(f"key column {name} is not declared")
            elif not column.protect.deterministic:
                out.append(f"key column {name} cannot be protected by {column.protect}")
        if self.chunk_column and self.column(self.chunk_column) is None:
            out.append(f"chunk column {self.chunk_column} is not declared")
        if self.chunk_size < 0:
            out.append("chunk size is negative")
        return out


@dataclass(frozen=True)
class Plan:
    name: str
    tables: tuple[TableSpec, ...] = field(default_factory=tuple)

    def find(self, table: str) -> TableSpec | None:
        """A table by its source name, else by its name without a schema."""
        exact = next((t for t in self.tables if t.source == table), None)
        return exact or next((t for t in self.tables if split_table(t.source)[1] == split_table(table)[1]), None)

    def names(self) -> list[str]:
        return sorted(t.source for t in self.tables)

    def problems(self) -> list[str]:
        names = self.names()
        twice = [f"table {n} is declared twice" for n in sorted({n for n in names if names.count(n) > 1})]
        return twice + [f"{t.source}: {p}" for t in self.tables for p in t.problems()]


def _only(kind, given: dict) -> dict:
    known = {f.name for f in fields(kind)}
    if unknown := sorted(set(given) - known):
        raise ValueError(f"unknown fields of {kind.__name__}: {unknown}")
    return given


def load_plan(text: str) -> Plan:
    """A plan from JSON; unknown fields and invalid declarations are errors."""
    given = _only(Plan, json.loads(text))
    tables = []
    for t in given.get("tables", []):
        t = _only(TableSpec, t)
        columns = tuple(ColumnSpec(**(_only(ColumnSpec, c) | {"type": Logical(c.get("type", "string")), "protect": Protection(c.get("protect", "none"))})) for c in t.get("columns", []))
        tables.append(TableSpec(**(t | {"primary_key": tuple(t.get("primary_key", [])), "columns": columns})))
    plan = Plan(given.get("name", ""), tuple(tables))
    if found := plan.problems():
        raise ValueError("; ".join(found))
    return plan


@dataclass(frozen=True)
class Settings:
    """What a run may set: sizes of batches, budgets of a verification, the gate's thresholds."""

    migration_id: str = ""
    files_per_batch: int = 1000
    trigger_ms: int = 500
    store_buckets: int = 64
    leaf_rows: int = 5000
    max_depth: int = 48
    max_findings: int = 1000
    max_lag_seconds: float = 10
    lag_stable_seconds: float = 900

    def problems(self) -> list[str]:
        sizes = ("files_per_batch", "trigger_ms", "store_buckets", "leaf_rows", "max_depth", "max_findings")
        return [f"{n} must be positive" for n in sizes if getattr(self, n) <= 0] + [f"{n} is negative" for n in ("max_lag_seconds", "lag_stable_seconds") if getattr(self, n) < 0]


def load_settings(text: str = "{}", environ: dict[str, str] | None = None, prefix: str = "QUAYMARK_") -> Settings:
    """Settings from JSON, over which variables with the prefix go; unknown fields, also of the prefix, and bad values are errors."""
    given = dict(_only(Settings, json.loads(text)))
    kinds = {f.name: type(f.default) for f in fields(Settings)}
    overlay = {n.removeprefix(prefix).lower(): v for n, v in (environ or {}).items() if n.startswith(prefix)}
    given |= _only(Settings, overlay)
    try:
        made = Settings(**{n: kinds[n](v) for n, v in given.items()})
    except (TypeError, ValueError) as error:
        raise ValueError(f"settings: {error}") from error
    if found := made.problems():
        raise ValueError("; ".join(found))
    return made
