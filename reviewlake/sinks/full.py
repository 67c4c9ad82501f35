"""Replacement of whole tables: the new rows are written first, then the catalog points to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from reviewlake import filesystem
from reviewlake.session import session_conf, write_sizing
from reviewlake.sinks.catalog import TableSpec, quoted
from reviewlake.sinks.maintenance import (
    leaf_folders,
    partition_location,
    partition_spec,
    point_to,
    table_partitions,
    version_folder,
)
from reviewlake.sources.tables import partition_columns, table_location


def write_full(
    df: DataFrame,
    target: str,
    *,
    mode: str = "overwrite",
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
    as_table: bool = True,
    on_empty: str = "skip",
) -> bool:
    """Replace a whole table; FALSE if empty input was skipped.

    The rows go to a folder of their own before the catalog is told, so readers see the old table or the
    new one, and a failed write changes nothing. Columns that stay keep their comments and, unless
    ``partition_by`` names others, their part in the partitioning, also where other columns change.

    Meant for aggregates. The input is held while it is checked, so that the check and the write
    share one computation; Spark recomputes what a lost executor held.
    """
    if on_empty not in ("skip", "write"):
        raise ValueError(f"unknown treatment of empty input: {on_empty!r}")
    spark = df.sparkSession
    # Lets AQE merge the small partitions of held data too; else each becomes a file.
    merging = session_conf(spark, spark__sql__optimizer__canChangeCachedPlanOutputPartitioning="true")
    with merging, write_sizing(spark):
        held = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if on_empty == "skip" and held.isEmpty():
                return False
            if as_table and mode == "overwrite" and spark.catalog.tableExists(target):
                _replace(held, target, partition_by, file_format)
                return True
            writer = held.write.format(file_format).mode(mode)
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.saveAsTable(target) if as_table else writer.save(target)
            return True
        finally:
            held.unpersist()


def _replace(df: DataFrame, target: str, partition_by: Sequence[str], file_format: str) -> None:
    spark, root = df.sparkSession, table_location(df.sparkSession, target)
    declared = partition_columns(spark, target)
    parts = list(partition_by) or [c for c in declared if c in df.columns]
    if parts == declared and sorted(spark.table(target).dtypes) == sorted(df.dtypes):
        _same_table(df.select(*spark.table(target).columns), target, root, parts, file_format)
    else:
        _other_table(df, target, root, parts, file_format)
    spark.catalog.refreshTable(target)


def _written(df: DataFrame, folder: str, parts: Sequence[str], file_format: str) -> None:
    writer = df.write.format(file_format).mode("errorifexists")
    (writer.partitionBy(*parts) if parts else writer).save(folder)


def _same_table(df: DataFrame, target: str, root: str, parts: Sequence[str], file_format: str) -> None:
    """Each partition changes over at once; those that are no more go last."""
    spark = df.sparkSession
    fresh = version_folder(root, {"all": "rows"} if parts else None)
    _written(df, fresh, parts, file_format)
    if not parts:
        point_to(spark, target, {}, fresh)
        filesystem.delete(spark, root)
        return
    old = {tuple(sorted(values.items())): partition_location(spark, target, values) for values in table_partitions(spark, target)}
    new = {tuple(sorted(values.items())): (values, folder) for values, folder in leaf_folders(spark, fresh, parts)}
    for key, (values, folder) in new.items():
        if key in old:
            point_to(spark, target, values, folder)
        else:
            spark.sql(f"ALTER TABLE {target} ADD {partition_spec(values)} LOCATION '{quoted(folder)}'")
    for key in old.keys() - new.keys():
        spark.sql(f"ALTER TABLE {target} DROP {partition_spec(dict(key))}")
    for folder in old.values():
        filesystem.delete(spark, folder)


def _other_table(df: DataFrame, target: str, root: str, parts: Sequence[str], file_format: str) -> None:
    """Other columns: the declaration is made anew around rows that are there already."""
    spark = df.sparkSession
    notes = {f.name: f.metadata.get("comment", "") for f in spark.table(target).schema.fields}
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").filter("col_name = 'Comment'").collect()
    ordered = df.select(*[c for c in df.columns if c not in parts], *parts)
    spec = TableSpec(columns=[(name, kind, notes.get(name, "")) for name, kind in ordered.dtypes],
                     partition_by=parts, comment=told[0]["data_type"] if told else "")
    fresh = version_folder(root)
    _written(ordered, fresh, parts, file_format)
    spark.sql(f"DROP TABLE {target}")
    spark.sql(spec.ddl(target, fresh, file_format))
    if parts:
        spark.sql(f"ALTER TABLE {target} RECOVER PARTITIONS")
    filesystem.delete(spark, root)
