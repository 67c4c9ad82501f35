"""Table declarations and their idempotent creation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from reviewlake import filesystem


@dataclass(frozen=True)
class TableSpec:
    """A table: columns as (name, type, comment), in order, and its partition columns."""

    columns: Sequence[tuple[str, str, str]]
    partition_by: Sequence[str] = ()
    comment: str = ""

    def ddl(self, name: str, location: str, file_format: str = "parquet") -> str:
        body = ", ".join(
            f"`{column}` {kind}" + (f" COMMENT '{quoted(note)}'" if note else "")
            for column, kind, note in self.columns
        )
        parts = [f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING {file_format}"]
        if self.partition_by:
            parts.append(f"PARTITIONED BY ({', '.join(self.partition_by)})")
        if self.comment:
            parts.append(f"COMMENT '{quoted(self.comment)}'")
        parts.append(f"LOCATION '{quoted(location)}'")
        return " ".join(parts)


def quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def create_table(
    spark: SparkSession,
    database: str,
    table: str,
    spec: TableSpec,
    location: str,
    *,
    recreate: bool = False,
    file_format: str = "parquet",
) -> str:
    """Create database and table unless they exist; return the full name.

    ``recreate`` drops the table and deletes its files first: dropping an external table alone would
    let the old rows reappear.
    """
    name = f"{database}.{table}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{quoted(_parent(location))}'")
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        filesystem.delete(spark, location)
    spark.sql(spec.ddl(name, location, file_format))
    return name


def evolve_table(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Add the columns that a table lacks, after those it has; returns their names.

    Rows written before have NULL there. Columns are never dropped or changed in type.
    """
    known = {f.name.lower() for f in spark.table(table).schema.fields}
    new = [f for f in schema.fields if f.name.lower() not in known]
    if new:
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
    return [f.name for f in new]


def _parent(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[0]


# Names and types of the columns of the five tables.
EXTERNAL_REVIEWS = TableSpec(
    comment="App-store reviews as received",
    # One app's run replaces its own rows only, so apps of a day can be loaded side by side.
    partition_by=("date_load", "app_reference"),
    columns=(
        ("author_ura", "STRING", "profile address of the author"),
        ("author_name", "STRING", "name of the author"),
        ("author_label", "STRING", "label of the author, if any"),
        ("updated_at", "STRING", "time of the last change, ISO 8601 with offset"),
        ("rating", "INT", "rating given"),
        ("version", "STRING", "app version that was rated"),
        ("review_id", "STRING", "id of the review at its source"),
        ("title", "STRING", "title"),
        ("content", "STRING", "text"),
        ("content_type_attribute", "STRING", "kind of the text"),
        ("link_rel", "STRING", "kind of the link"),
        ("link_href", "STRING", "address of the link"),
        ("vote_sum", "INT", "sum of votes"),
        ("content_term", "STRING", "content type, term"),
        ("content_label", "STRING", "content type, label"),
        ("vote_count", "INT", "number of votes"),
        ("ingestion_ts", "TIMESTAMP", "time of loading"),
        ("date_load", "STRING", "load day, yyyy-MM-dd"),
        ("app_reference", "STRING", "app the review is about"),
    ),
)

INTERNAL_REVIEWS = TableSpec(
    comment="Internal feedback as received",
    partition_by=("date_load",),
    columns=(
        ("submission_date", "TIMESTAMP", "time of submission"),
        ("client_segment", "STRING", "private or business client"),
        ("client_identification", "STRING", "tax number of the client"),
        ("client_classification", "STRING", "class of the client"),
        ("feedback_rating", "INT", "rating given"),
        ("feedback_comment", "STRING", "text"),
        ("service_type", "STRING", "service the feedback is about"),
        ("service_id", "STRING", "id of the service"),
        ("service_feedback", "STRING", "comment on the service"),
        ("source_channel", "STRING", "channel of the feedback"),
        ("source_id", "STRING", "version of the sending app"),
        ("app_reference", "STRING", "sending app"),
        ("source_user_agent", "STRING", "user agent"),
        ("ingestion_ts", "TIMESTAMP", "time of loading"),
        ("date_load", "STRING", "load day, yyyy-MM-dd"),
    ),
)

UNIFIED_REVIEWS = TableSpec(
    comment="Reviews of all sources, cleaned and deduplicated",
    partition_by=("date_load",),
    columns=(
        ("review_id", "STRING", "hash that identifies the review"),
        ("client_id", "STRING", "normalised or anonymised client"),
        ("review_date", "TIMESTAMP", "time of the review"),
        ("review_rating", "INT", "rating, 1 to 5"),
        ("review_title", "STRING", "title"),
        ("review_text", "STRING", "text"),
        ("review_version", "STRING", "app version"),
        ("source_channel", "STRING", "channel"),
        ("source_system", "STRING", "system of origin"),
        ("segment", "STRING", "client segment"),
        ("service_type", "STRING", "service"),
        ("source_agent", "STRING", "platform"),
        ("ingestion_ts", "TIMESTAMP", "time of loading into bronze"),
        ("user_agent", "STRING", "user agent class"),
        ("app_reference", "STRING", "app"),
        ("date_load", "STRING", "snapshot month, yyyyMM"),
    ),
)

REVIEW_KPIS = TableSpec(
    comment="Monthly review indicators",
    partition_by=("review_year",),
    columns=(
        ("review_month", "STRING", "month, MM"),
        ("review_version", "STRING", "app version"),
        ("segment", "STRING", "client segment"),
        ("service_type", "STRING", "service"),
        ("app_reference", "STRING", "app"),
        ("review_count", "BIGINT", "number of reviews"),
        ("average_rating", "DOUBLE", "mean rating, one decimal"),
        ("min_rating", "DOUBLE", "lowest rating"),
        ("max_rating", "DOUBLE", "highest rating"),
        ("nps_score", "DOUBLE", "promoter score, -1 to 1"),
        ("review_year", "STRING", "year, yyyy"),
    ),
)

CONTROL_PARAMS = TableSpec(
    comment="Flow configurations, one row per version",
    partition_by=("version",),
    columns=(
        ("source_layer", "STRING", "layer the flow reads"),
        ("table_name_target", "STRING", "table the flow writes"),
        ("schema_expected",
         "ARRAY<STRUCT<name_column: STRING, type_column: STRING, other: STRING>>", "source columns"),
        ("schema_target",
         "ARRAY<STRUCT<name_column: STRING, type_column: STRING,"
         " is_pk: BOOLEAN, is_zorder: BOOLEAN>>", "target columns"),
        ("schema_depara", "ARRAY<STRUCT<source_column: STRING, target_column: STRING>>",
         "renamed columns"),
        ("rule_control", "ARRAY<STRUCT<rule: STRING, value: STRING, column_name: STRING>>", "rules"),
        ("source_config", "MAP<STRING, STRING>", "source settings"),
        ("target_config", "MAP<STRING, STRING>", "target settings"),
        ("fallback_config", "MAP<STRING, STRING>", "fallback settings"),
        ("last_modified", "TIMESTAMP", "time of change"),
        ("version", "DOUBLE", "version of the flow"),
    ),
)

TABLES: dict[str, TableSpec] = {
    "external_reviews": EXTERNAL_REVIEWS,
    "internal_reviews": INTERNAL_REVIEWS,
    "unified_reviews": UNIFIED_REVIEWS,
    "review_kpis": REVIEW_KPIS,
    "control_params": CONTROL_PARAMS,
}
