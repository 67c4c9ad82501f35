"""Compaction, clustering and retention of partitioned tables and folders."""

from __future__ import annotations

import logging
import math
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake import filesystem
from reviewlake.session import TARGET_BYTES
from reviewlake.sinks.catalog import quoted
from reviewlake.sinks.partitions import insert_partitions
from reviewlake.sources.tables import partition_columns, table_location

logger = logging.getLogger(__name__)

PARTITION_ROOT_MARK = "="
_ZKEY, _TIE = "__zkey", "__tie"
# How often rows added to a folder that is being replaced are looked for.
ABSORBING = 5


def unescaped(spark: SparkSession, name: str) -> str:
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name)


def compact(
    spark: SparkSession,
    table: str,
    partition: Mapping[str, str] | None = None,
    *,
    cluster_by: Sequence[str] = (),
    target_bytes: int = TARGET_BYTES,
) -> int:
    """Rewrite one partition (or an unpartitioned table) of the catalog into files of about ``target_bytes``.

    Returns the number of files aimed at; unless it is to be clustered, a folder is left alone where
    a rewrite would not halve its files. Without ``cluster_by`` neighbouring splits are merged and
    nothing is shuffled; with it rows are range-partitioned and sorted, so that file statistics let
    scans skip files.

    The new files are written to a folder of their own, and one catalog statement points the partition
    there: nothing is moved, readers see the old files or the new ones, and a run that dies on the way
    leaves the table as it was. A folder that changes while it is rewritten ends the rewrite with an error.
    What others have added to the old folder by the time the pointer has changed is inserted anew; where
    they have replaced it, the pointer goes back. A writer that began before the change must have
    committed by its end.
    """
    partition = dict(partition or {})
    declared = partition_columns(spark, table)
    if sorted(partition) != sorted(declared):
        raise ValueError(f"{table} is partitioned by {declared}; name one partition")
    folder = partition_location(spark, table, partition)
    if folder is None:
        logger.warning("nothing to compact, %s has no partition %s", table, partition)
        return 0
    listed = _data_files(spark, folder)
    files = max(1, math.ceil(sum(listed.values()) / target_bytes))
    if not listed or (not cluster_by and len(listed) < 2 * files):
        return len(listed)
    fresh = version_folder(table_location(spark, table), partition)
    columns = [f for f in spark.table(table).schema.fields if f.name not in partition]
    # Just the files listed, under the schema of the table: a folder's own partition column stays out.
    source = spark.read.schema(T.StructType(columns)).parquet(*[f"{folder}/{name}" for name in listed])
    arranged = clustered(source, cluster_by, files) if cluster_by else source.coalesce(files)
    rows = Observation("rows")
    arranged.observe(rows, F.count("*").alias("n")).write.mode("errorifexists").parquet(fresh)
    written = spark.read.schema(T.StructType(columns)).parquet(fresh).count()
    if written != rows.get["n"] or _data_files(spark, folder) != listed:
        filesystem.delete(spark, fresh)
        raise RuntimeError(f"{folder} changed while it was rewritten")
    point_to(spark, table, partition, fresh)
    for _ in range(ABSORBING):
        now = _data_files(spark, folder)
        if not listed.items() <= now.items():
            point_to(spark, table, partition, folder)
            raise RuntimeError(f"{folder} was replaced while it was rewritten")
        late = sorted(now.keys() - listed.keys())
        if not late:
            filesystem.delete(spark, folder)
            return files
        added = spark.read.schema(T.StructType(columns)).parquet(*[f"{folder}/{name}" for name in late])
        insert_partitions(added, table, mode="append", static=partition)
        listed = now
    logger.warning("%s is still written to and stays; its rows so far are in %s", folder, table)
    return files


def version_folder(root: str, partition: Mapping[str, str] | None = None) -> str:
    """A new folder for files of a table at ``root``; its name hides it from scans of folders above.

    That of a partition lies below the table's folder, that of an unpartitioned table beside it.
    """
    parent, name = root.rstrip("/").rsplit("/", 1)
    label = "-".join(f"{name}-{value}" for name, value in partition.items()) if partition else re.sub(
        r"^_version-[0-9a-f]{12}-", "", name)
    return f"{root.rstrip('/') if partition else parent}/_version-{uuid.uuid4().hex[:12]}-{re.sub(r'[^A-Za-z0-9._-]', '_', label)}"


def partition_spec(partition: Mapping[str, str]) -> str:
    values = ", ".join(f"`{name}` = '{quoted(value)}'" for name, value in partition.items())
    return f"PARTITION ({values})"


def partition_location(spark: SparkSession, table: str, partition: Mapping[str, str]) -> str | None:
    """The folder a partition (or the unpartitioned table) points to; none if there is no such partition."""
    if not partition:
        return table_location(spark, table)
    if dict(partition) not in table_partitions(spark, table):
        return None
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition_spec(partition)}").collect()
    return next(row["data_type"] for row in told if row["col_name"] == "Location").rstrip("/")


def point_to(spark: SparkSession, table: str, partition: Mapping[str, str], folder: str) -> None:
    spec = f" {partition_spec(partition)}" if partition else ""
    spark.sql(f"ALTER TABLE {table}{spec} SET LOCATION '{quoted(folder)}'")
    spark.catalog.refreshTable(table)


def leaf_folders(spark: SparkSession, root: str, columns: Sequence[str]) -> list[tuple[dict[str, str], str]]:
    """Values and folder of each partition below a folder that was written by ``columns``."""
    found: list[tuple[dict[str, str], str]] = [({}, root.rstrip("/"))]
    for name in columns:
        found = [({**values, name: unescaped(spark, child.split(PARTITION_ROOT_MARK, 1)[1])}, f"{folder}/{child}")
                 for values, folder in found for child in filesystem.child_names(spark, folder)
                 if unescaped(spark, child).startswith(f"{name}=")]
    return found


def _data_files(spark: SparkSession, folder: str) -> dict[str, int]:
    return {n: size for n, size in filesystem.file_lengths(spark, folder).items() if not n.startswith(("_", "."))}


def compact_table(
    spark: SparkSession, table: str, within: Mapping[str, str] | None = None, *, cluster_by: Sequence[str] = (),
    target_bytes: int = TARGET_BYTES,
) -> int:
    """Compact every partition of a catalog table that has the values of ``within``, or the whole table."""
    return sum(compact(spark, table, values, cluster_by=cluster_by, target_bytes=target_bytes)
               for values in table_partitions(spark, table)
               if all(values.get(name) == value for name, value in (within or {}).items()))


def table_partitions(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """Values of each partition; one empty set for a table without partitions."""
    if not partition_columns(spark, table):
        return [{}]
    return [{unescaped(spark, name): unescaped(spark, value) for name, value in
             (part.split(PARTITION_ROOT_MARK, 1) for part in row[0].split("/"))}
            for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def clustered(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """Rows in ``files`` ranges of the cluster columns, sorted within each.

    One column is ordered by its value, several by a Z-order key. The position of a row in its file
    breaks ties, so a value that fills a third of the table still spreads over files.
    """
    position = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    key = F.col(columns[0]) if len(columns) == 1 else zorder_key(df, columns, position=position)
    keyed = df.select("*", key.alias(_ZKEY), position.alias(_TIE))
    ranged = keyed.repartitionByRange(files, _ZKEY, _TIE)
    return ranged.sortWithinPartitions(_ZKEY).select(*df.columns)


def zorder_key(
    df: DataFrame, columns: Sequence[str], bits: int | None = None, sample: int = 8_192, position: Column | None = None
) -> Column:
    """Interleaved bits of the columns' ranks: of each column the range of its values a row falls into.

    The ranges hold about as many rows each, whatever the values look like; whole values are compared.
    ``bits`` per column (ranges are 2 to that power) shrink with the number of columns by default. NULLs
    come first. ``position`` tells rows apart, whatever they hold.
    """
    if bits is None:
        bits = max(1, min(8, 60 // max(1, len(columns))))
    if bits * len(columns) > 62:
        raise ValueError("too many columns for a 62-bit key")
    starts = range_starts(df, columns, 1 << bits, sample, position)
    key = F.lit(0).cast("bigint")
    for place, name in enumerate(columns):
        if not starts[name]:
            continue
        kind = df.schema[name].dataType
        ranges = F.array(*[F.lit(start).cast(kind) for start in starts[name]])
        step = F.when(F.col(name).isNull(), 0).otherwise(_reached(ranges, F.col(name), 1 << bits)).cast("bigint")
        for bit in range(bits):
            set_bit = F.shiftright(step, bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(set_bit, bit * len(columns) + place))
    return key


def range_starts(
    df: DataFrame, columns: Sequence[str], ranges: int, sample: int = 8_192, position: Column | None = None
) -> dict[str, list]:
    """The first value of each of ``ranges`` even ranges of a column but the lowest, without repeats.

    Numbers, dates and times: quantile sketches of all rows, merged by Spark, all columns in one pass. Other
    types have no sketch and take a seeded sample of rows, chosen by a hash of a row's position rather
    than of its values, so that a frequent value is in it as often as among the rows.
    """
    # Just beyond each share stands the first row of the next range.
    shares = [min(1.0, i / ranges + 1e-9) for i in range(1, ranges)]
    sketched = [c for c in columns if isinstance(df.schema[c].dataType, (T.NumericType, T.DateType, T.TimestampType,
                                                                          T.TimestampNTZType))]
    sampled = [c for c in columns if c not in sketched]
    found: dict[str, list] = {}
    if sketched:
        row = df.agg(*[F.percentile_approx(c, shares, 64 * ranges).alias(f"q{i}") for i, c in enumerate(sketched)],
                     *[F.min(c).alias(f"m{i}") for i, c in enumerate(sketched)]).first()
        for i, name in enumerate(sketched):
            found[name] = sorted(set(row[f"q{i}"] or ()) - {row[f"m{i}"]}, key=lambda v: (v != v, v))  # NaN is last
    if sampled:
        chosen = df.select(*sampled).orderBy(F.xxhash64(F.monotonically_increasing_id() if position is None else position)).limit(sample).collect()
        for name in sampled:
            values = sorted(row[name] for row in chosen if row[name] is not None)
            found[name] = sorted({values[min(len(values) - 1, int(len(values) * s))] for s in shares} - {values[0]}) if values else []
    return found


def _reached(starts: Column, value: Column, ranges: int) -> Column:
    """How many of the starts, sorted and fewer than ``ranges``, lie at or below the value: found by halving."""
    leaps = [F.lit(1 << bit) for bit in reversed(range((ranges - 1).bit_length()))]
    return F.aggregate(F.array(*leaps), F.lit(0), lambda found, leap: found + F.when(
        F.get(starts, found + leap - 1) <= value, leap).otherwise(0))


def drop_partitions(
    spark: SparkSession, root: str, column: str, condition: Callable[[str], bool]
) -> list[str]:
    """Delete the partitions whose value meets the condition; returns the values.

    The column may be any of the partition columns. Only folder names are looked at: no data is read or
    rewritten, whatever the table's size.
    """
    dropped = []
    pending = [root.rstrip("/")]
    while pending:
        folder = pending.pop()
        for child in filesystem.child_names(spark, folder):
            if PARTITION_ROOT_MARK not in child or child.startswith(("_", ".")):
                continue
            name, value = (unescaped(spark, part) for part in child.split(PARTITION_ROOT_MARK, 1))
            if name != column:
                pending.append(f"{folder}/{child}")
            elif condition(value):
                filesystem.delete(spark, f"{folder}/{child}")
                dropped.append(value)
    spark.catalog.refreshByPath(root)
    return sorted(set(dropped))


def drop_table_partitions(
    spark: SparkSession, table: str, column: str, condition: Callable[[str], bool]
) -> list[str]:
    """The same for a catalog table: its partition entries go together with their files, wherever these are."""
    gone = [values for values in table_partitions(spark, table) if condition(values[column])]
    folders = [partition_location(spark, table, values) for values in gone]
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(partition_spec(values) for values in gone)}")
    for folder in folders:
        filesystem.delete(spark, folder)
    dropped = {values[column] for values in gone}
    dropped |= set(drop_partitions(spark, table_location(spark, table), column, condition))
    spark.catalog.refreshTable(table)
    return sorted(dropped)


def retain_days(spark: SparkSession, root: str, as_of: date, days: int, column: str = "date_load") -> list[str]:
    """Delete day partitions older than ``days`` days before ``as_of``."""
    oldest_kept = (as_of - timedelta(days=days)).isoformat()
    return drop_partitions(spark, root, column, lambda value: value < oldest_kept)
