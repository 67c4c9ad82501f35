"""Partition writes that replace exactly the partitions they bring.

Overwrites run in dynamic mode: partitions without new rows are left alone, so an empty input
changes nothing, and a repeated run replaces its own output. Neither ``replaceWhere`` (Parquet
ignores it and drops the other partitions) nor ``saveAsTable`` (replaces the whole table) is used.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.session import TARGET_BYTES, shuffles_dropped, write_sizing
from reviewlake.sources.tables import month_of, partition_columns

# Names of the counts of values lost in casts.
LOSSY = "__lossy_"


def stamp_month(df: DataFrame, run_day: str) -> DataFrame:
    """Put all rows into the month of the run: a partition is the snapshot taken in that month."""
    return df.withColumn("date_load", F.lit(month_of(run_day)))


def _arranged(
    df: DataFrame, partition_by: Sequence[str], static: Mapping[str, str], rebalance: bool | None
) -> DataFrame:
    absent = {name: F.lit(value) for name, value in static.items() if name not in df.columns}
    df = df.withColumns(absent) if absent else df
    missing = [name for name in partition_by if name not in df.columns]
    if missing:
        raise ValueError(f"partition columns {missing} are neither in the data nor given as values")
    spread = [name for name in partition_by if name not in static]
    # Rows of one partition are brought together so that each task does not open a file in every
    # partition. AQE splits what is too large for one file, so a hot partition becomes many files.
    # Rows bound for a single known partition need no shuffle.
    if spread if rebalance is None else rebalance:
        df = df.hint("rebalance", *(spread or partition_by))
    return df


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("date_load",),
    *,
    mode: str = "overwrite",
    static: Mapping[str, str] | None = None,
    file_format: str = "parquet",
    rebalance: bool | None = None,
    file_bytes: int = TARGET_BYTES,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write to a partitioned folder.

    ``static`` names partition columns that hold one known value; columns absent from the data are
    added from it. ``options`` are those of the format.
    """
    df = _arranged(df, partition_by, static or {}, rebalance)
    with write_sizing(df.sparkSession, df, file_bytes), shuffles_dropped(df.sparkSession):
        (df.write.format(file_format).mode(mode).partitionBy(*partition_by).options(**(options or {}))
         .option("partitionOverwriteMode", "dynamic").save(path))


def insert_partitions(
    df: DataFrame,
    table: str,
    *,
    mode: str = "overwrite",
    static: Mapping[str, str] | None = None,
    rebalance: bool | None = None,
    file_bytes: int = TARGET_BYTES,
    measure: Mapping[str, Column] | None = None,
    run_id: str | None = None,
    on_bad: str = "raise",
) -> dict[str, Any]:
    """Write to a catalog table, matching columns by name and partitioning as the table declares.

    ``measure`` holds aggregates over the rows written. They are taken in the writing tasks, whose
    results count once however often earlier stages are repeated. Returns their values. The files of a
    write with a ``run_id`` bear its name, by which ``own_rows`` finds them again.

    A value that its column's type cannot hold ends the write before anything is committed. With
    ``on_bad="count"`` it becomes NULL, and ``lossy`` in the result has the number of such values for each
    column that is cast.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown write mode {mode!r}")
    spark = df.sparkSession
    target = spark.table(table).schema
    df = _arranged(df, partition_columns(spark, table), static or {}, rebalance)
    if on_bad not in ("raise", "count"):
        raise ValueError(f"unknown treatment of values that cannot be cast: {on_bad!r}")
    given = {f.name: f.dataType for f in df.schema.fields}
    cast = [f for f in target.fields if given[f.name] != f.dataType]
    lossy = {f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in cast}
    counts = dict(measure or {})
    if on_bad == "count":
        counts |= {f"{LOSSY}{name}": F.count_if(bad) for name, bad in lossy.items()}
    measured = Observation("measured") if counts else None
    if measured:
        df = df.observe(measured, *[column.alias(name) for name, column in counts.items()])

    def fitted(f: T.StructField) -> Column:
        if f.name not in lossy:
            return F.col(f.name)
        value = F.col(f.name).try_cast(f.dataType)
        if on_bad == "raise":
            told = F.concat(F.lit(f"{table}.{f.name} cannot hold "), F.left(F.col(f.name).cast("string"), F.lit(80)))
            value = F.when(lossy[f.name], F.raise_error(told).cast(f.dataType)).otherwise(value)
        return value.alias(f.name)

    ordered = df.select(*map(fitted, target.fields))
    # The mode is an option of this one statement: as a session setting, a write in another thread
    # could lose it half-way and replace the whole table.
    verb = "OVERWRITE" if mode == "overwrite" else "INTO"
    with write_sizing(spark, ordered, file_bytes):
        named = f", 'mapreduce.output.basename' = '{run_id}'" if run_id else ""
        spark.sql(f"INSERT {verb} {table} WITH ('partitionOverwriteMode' = 'dynamic'{named})"
                  " SELECT * FROM {rows}", rows=ordered)
    seen = dict(measured.get) if measured else {}
    found = {name: int(seen.pop(f"{LOSSY}{name}") or 0) for name in lossy if on_bad == "count"}
    return seen | ({"lossy": found} if on_bad == "count" else {})


def own_rows(df: DataFrame, run_id: str) -> DataFrame:
    """The rows of a table that one run has written, until they are rewritten."""
    return df.filter(F.col("_metadata.file_name").startswith(f"{run_id}-"))


def new_run_id() -> str:
    return f"run-{uuid.uuid4().hex}"
