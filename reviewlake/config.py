"""Flow configuration: one row of the control table, typed.

The control table holds one row per flow version. A row is small and bounded, so it is the only
data that is brought to the driver; everything it describes stays in DataFrames.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.errors import ParseException
from pyspark.sql import Row
from pyspark.sql import types as T

# Type names of the control table that are not, or not with this meaning, Spark's own.
TYPE_ALIASES = {"LONG": "BIGINT", "FLOAT": "DOUBLE", "DECIMAL": "DECIMAL(38,18)"}
# Heads of the type names that are understood; anything else is text.
TYPE_HEADS = {"STRING", "INT", "INTEGER", "BIGINT", "DOUBLE", "BOOLEAN", "DATE", "TIMESTAMP", "DECIMAL",
              "ARRAY", "MAP", "STRUCT"}

CONTROL_SCHEMA_DDL = """
    version DOUBLE, source_layer STRING, table_name_target STRING,
    schema_expected ARRAY<STRUCT<name_column: STRING, type_column: STRING, other: STRING>>,
    schema_target ARRAY<STRUCT<name_column: STRING, type_column: STRING,
                               is_pk: BOOLEAN, is_zorder: BOOLEAN>>,
    schema_depara ARRAY<STRUCT<source_column: STRING, target_column: STRING>>,
    rule_control ARRAY<STRUCT<rule: STRING, value: STRING, column_name: STRING>>,
    source_config MAP<STRING, STRING>, target_config MAP<STRING, STRING>,
    fallback_config MAP<STRING, STRING>, last_modified TIMESTAMP
"""

def resolve_type(name: str | None) -> T.DataType:
    """Spark type for a configured type name, as Spark's DDL parser reads it.

    Unknown or empty names are strings; a decimal that the parser refuses is the widest one.
    """
    text = (name or "").strip()
    head = re.split(r"\W", text, maxsplit=1)[0].upper()
    ddl = TYPE_ALIASES.get(text.upper(), text)
    if head == "STRING" or TYPE_ALIASES.get(head, head).split("(")[0] not in TYPE_HEADS:
        return T.StringType()
    try:
        return T.DataType.fromDDL(ddl)
    except ParseException:
        return T.DataType.fromDDL(TYPE_ALIASES["DECIMAL"]) if head == "DECIMAL" else T.StringType()


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type_name: str = "STRING"
    other: str = ""
    is_pk: bool = False
    is_zorder: bool = False

    @property
    def data_type(self) -> T.DataType:
        return resolve_type(self.type_name)


@dataclass(frozen=True)
class Rule:
    name: str
    value: str | None = None
    column: str | None = None


def build_schema(columns: Iterable[ColumnSpec], nested: bool = True) -> T.StructType:
    """Nullable schema for a declared column list.

    ``client.segment`` becomes field ``segment`` of struct ``client``. With ``nested=False`` the
    dotted text stays one flat field name, which JSON documents never contain, so it reads NULL.
    """
    tree: dict[str, Any] = {}
    for column in columns:
        parts = column.name.split(".") if nested else [column.name]
        node = tree
        for part in parts[:-1]:
            node = node.setdefault(part, {})
            if not isinstance(node, dict):
                raise ValueError(f"{column.name}: {part} is declared both as value and as struct")
        if isinstance(node.get(parts[-1]), dict):
            raise ValueError(f"{column.name} is declared both as value and as struct")
        node[parts[-1]] = column.data_type

    def to_struct(node: Mapping[str, Any]) -> T.StructType:
        return T.StructType([
            T.StructField(name, to_struct(value) if isinstance(value, dict) else value, True)
            for name, value in node.items()
        ])

    return to_struct(tree)


def _flag(value: Any) -> bool:
    return str(value).strip().lower() == "true"


@dataclass(frozen=True)
class FlowConfig:
    """Everything one flow needs to know about its source, mapping, rules and target."""

    target_table: str
    source_layer: str = "raw"
    version: float = 1.0
    expected: tuple[ColumnSpec, ...] = ()
    target: tuple[ColumnSpec, ...] = ()
    mapping: Mapping[str, str] = field(default_factory=dict)  # target column -> source column
    rules: tuple[Rule, ...] = ()
    source: Mapping[str, str] = field(default_factory=dict)
    sink: Mapping[str, str] = field(default_factory=dict)
    fallback: Mapping[str, str] = field(default_factory=dict)
    last_modified: datetime | None = None

    @classmethod
    def from_row(cls, row: Row) -> FlowConfig:
        data = row.asDict(recursive=True)
        return cls(
            target_table=data["table_name_target"],
            source_layer=data["source_layer"],
            version=data["version"],
            expected=_columns(data.get("schema_expected")),
            target=_columns(data.get("schema_target")),
            mapping={m["target_column"]: m["source_column"] for m in data.get("schema_depara") or ()},
            rules=tuple(
                Rule(r["rule"], r.get("value"), r.get("column_name"))
                for r in data.get("rule_control") or ()
            ),
            source=data.get("source_config") or {},
            sink=data.get("target_config") or {},
            fallback=data.get("fallback_config") or {},
            last_modified=data.get("last_modified"),
        )

    def rule(self, name: str, default: str) -> str:
        """Value of a rule; the last entry of that name wins."""
        values = [r.value for r in self.rules if r.name == name and r.value is not None]
        return values[-1] if values else default

    def rule_is_true(self, name: str) -> bool:
        return _flag(self.rule(name, "false"))

    @property
    def primary_key(self) -> list[str]:
        return [c.name for c in self.target if c.is_pk]

    @property
    def zorder_columns(self) -> list[str]:
        return [c.name for c in self.target if c.is_zorder]

    @property
    def required_columns(self) -> list[str]:
        """Columns that a ``not_empty`` rule names."""
        return [r.column for r in self.rules
                if r.name == "not_empty" and r.column and _flag(r.value)]

    @property
    def expected_schema(self) -> T.StructType:
        return build_schema(self.expected)

    def columns_tagged(self, tag: str) -> list[str]:
        """Expected columns that belong to one of several source tables."""
        return [c.name for c in self.expected if c.other == tag]


def _columns(items: Sequence[Mapping[str, Any]] | None) -> tuple[ColumnSpec, ...]:
    return tuple(
        ColumnSpec(
            name=item["name_column"],
            type_name=item.get("type_column") or "STRING",
            other=item.get("other") or "",
            is_pk=_flag(item.get("is_pk")),
            is_zorder=_flag(item.get("is_zorder")),
        )
        for item in items or ()
    )
