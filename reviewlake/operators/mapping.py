"""Configured projection of source columns onto a target table."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.config import ColumnSpec
from reviewlake.functions import any_of, lossy_cast

CONTROL_COLUMNS = ("ingestion_ts", "date_load")
UNKNOWN_APP = "na"


def resolve_source(schema: T.StructType, name: str) -> Column | None:
    """The column a source name stands for: a literal field name first, then a struct path."""
    if name in schema.fieldNames():
        return F.col(f"`{name}`")
    first, *rest = name.split(".")
    if not rest or first not in schema.fieldNames():
        return None
    column, data_type = F.col(f"`{first}`"), schema[first].dataType
    for part in rest:
        if not isinstance(data_type, T.StructType) or part not in data_type.fieldNames():
            return None
        column, data_type = column.getField(part), data_type[part].dataType
    return column


def map_columns(
    df: DataFrame,
    target: Sequence[ColumnSpec],
    mapping: Mapping[str, str],
    *,
    table_types: Mapping[str, T.DataType] | None = None,
    missing: str = "error",
    skip: Collection[str] = CONTROL_COLUMNS,
    keep: Sequence[Column] = (),
    type_issue: str | None = None,
) -> DataFrame:
    """Rename, cast and order columns as the target declares.

    The type of a live table column (``table_types``) wins over the configured one. A value that
    cannot be read as its type becomes NULL; with ``type_issue`` a boolean column of that name marks
    such rows. A source column that does not exist is an error or a NULL column (``missing``).
    """
    if missing not in ("error", "null"):
        raise ValueError(f"missing must be 'error' or 'null', not {missing!r}")
    table_types = table_types or {}
    projected, lossy = [], []
    for spec in target:
        if spec.name in skip:
            continue
        wanted = table_types.get(spec.name, spec.data_type)
        source_name = mapping.get(spec.name, spec.name)
        source = resolve_source(df.schema, source_name)
        if source is None:
            if missing == "error":
                raise ValueError(f"source column {source_name!r} for {spec.name!r} does not exist")
            projected.append(F.lit(None).cast(wanted).alias(spec.name))
            continue
        projected.append(source.try_cast(wanted).alias(spec.name))
        if type_issue:
            lossy.append(lossy_cast(source, wanted))
    if type_issue:
        projected.append(any_of(lossy).alias(type_issue))
    return df.select(*projected, *keep)


def app_reference_column(
    schema: T.StructType, app: str | None = None, folder: Column | None = None
) -> Column:
    """The app a row belongs to: the run's argument or folder, else the row's value, else ``na``."""
    candidates = []
    if app and app.strip():
        candidates.append(F.lit(app.strip().lower()))
    if folder is not None:
        candidates.append(F.trim(F.lower(folder)))
    if "app_reference" in schema.fieldNames():
        candidates.append(F.trim(F.lower(F.col("app_reference"))))
    return F.coalesce(*candidates, F.lit(UNKNOWN_APP))


def with_control_columns(df: DataFrame, day: str, run_ts: datetime | None = None) -> DataFrame:
    """Add load time and load day. A run passes its own time, so all its rows carry one value."""
    loaded_at = F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp()
    return df.withColumns({"ingestion_ts": loaded_at, "date_load": F.lit(day)})
