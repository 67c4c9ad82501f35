"""The control table: latest version per flow, loading of documents, rules as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.config import CONTROL_SCHEMA_DDL, FlowConfig

FLOW_KEYS = ("source_layer", "table_name_target")

# A metadata document, in the shape it is written by hand.
DOCUMENT_SCHEMA_DDL = """
    flow_config STRUCT<
        metadata: STRUCT<version: STRING, last_modified: STRING>,
        data_layers: STRUCT<source_layer: STRING, target_table: STRING>,
        schemas: STRUCT<
            schema_expected: ARRAY<STRUCT<name_column: STRING, type_column: STRING, other: STRING>>,
            schema_target: ARRAY<STRUCT<name_column: STRING, type_column: STRING,
                                        is_pk: BOOLEAN, is_zorder: BOOLEAN>>>,
        column_mapping: ARRAY<STRUCT<source_column: STRING, target_column: STRING>>,
        control_rules: ARRAY<STRUCT<rule: STRING, value: STRING, column_name: STRING>>,
        configurations: STRUCT<source_config: MAP<STRING, STRING>,
                               target_config: MAP<STRING, STRING>,
                               fallback_config: MAP<STRING, STRING>>>
"""

_CONTROL_TYPES = {
    "schema_expected": "array<struct<name_column:string,type_column:string,other:string>>",
    "schema_target":
        "array<struct<name_column:string,type_column:string,is_pk:boolean,is_zorder:boolean>>",
    "schema_depara": "array<struct<source_column:string,target_column:string>>",
    "rule_control": "array<struct<rule:string,value:string,column_name:string>>",
}


def latest_config(
    control: DataFrame,
    keys: Sequence[str] = FLOW_KEYS,
    order: Sequence[str] = ("version", "last_modified"),
) -> DataFrame:
    """Newest row of every flow, by version and then by time of change."""
    newest = F.max_by(F.struct("*"), F.struct(*order))
    return control.groupBy(*keys).agg(newest.alias("row")).select("row.*")


def load_flow_config(control: DataFrame, source_layer: str, table: str) -> FlowConfig:
    """Latest configuration of one flow; an unknown flow is an error."""
    rows = latest_config(
        control.filter((F.col("source_layer") == source_layer)
                       & (F.col("table_name_target") == table))
    ).take(1)
    if not rows:
        raise LookupError(f"no configuration for layer {source_layer!r} and table {table!r}")
    return FlowConfig.from_row(rows[0])


def config_from_documents(documents: DataFrame, column: str = "document") -> DataFrame:
    """Metadata documents (JSON text) to typed control rows, one per document."""
    parsed = documents.select(F.from_json(F.col(column), DOCUMENT_SCHEMA_DDL).alias("d")).select(
        "d.flow_config.*"
    )
    return parsed.select(
        F.col("metadata.version").try_cast("double").alias("version"),
        F.col("data_layers.source_layer").alias("source_layer"),
        F.col("data_layers.target_table").alias("table_name_target"),
        F.col("schemas.schema_expected").alias("schema_expected"),
        F.col("schemas.schema_target").alias("schema_target"),
        F.col("column_mapping").alias("schema_depara"),
        F.col("control_rules").alias("rule_control"),
        F.col("configurations.source_config").alias("source_config"),
        F.col("configurations.target_config").alias("target_config"),
        F.col("configurations.fallback_config").alias("fallback_config"),
        F.try_to_timestamp(F.col("metadata.last_modified")).alias("last_modified"),
    )


def type_config_strings(rows: DataFrame) -> DataFrame:
    """Rows whose nested columns are JSON text (maps as ``[[key, value], ...]``), typed."""

    def pairs(name: str) -> Column:
        parsed = F.from_json(F.col(name), "array<array<string>>")
        return F.map_from_entries(F.transform(parsed, lambda p: F.struct(p[0], p[1])))

    return rows.select(
        F.col("version").try_cast("double").alias("version"),
        "source_layer",
        "table_name_target",
        *[F.from_json(F.col(name), ddl).alias(name) for name, ddl in _CONTROL_TYPES.items()],
        *[pairs(name).alias(name) for name in ("source_config", "target_config", "fallback_config")],
        F.try_to_timestamp(F.col("last_modified").cast("string")).alias("last_modified"),
    )


def explode_rules(control: DataFrame, keys: Sequence[str] = FLOW_KEYS) -> DataFrame:
    """One row per rule. Where a flow repeats a rule, its last entry wins.

    The choice is made inside each array, so no rows are shuffled.
    """
    last_wins = F.filter(
        F.col("rule_control"),
        lambda entry, i: ~F.exists(
            F.slice(F.col("rule_control"), i + 2, F.size("rule_control")),
            lambda later: later["rule"].eqNullSafe(entry["rule"]),
        ),
    )
    return control.select(*keys, F.explode(last_wins).alias("entry")).select(
        *keys, F.col("entry.rule").alias("rule"), F.col("entry.value").alias("value")
    )


def control_schema() -> str:
    return CONTROL_SCHEMA_DDL
