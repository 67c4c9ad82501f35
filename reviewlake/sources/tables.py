"""Scans of lake tables that prune by partition."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_days_back(df: DataFrame, as_of: date, days: int = 365) -> DataFrame:
    """Partitions of the last ``days`` days, counted from the run date.

    Text is compared with text, so the filter reaches the scan as a partition filter; the run date
    is an argument, so a repeated run reads the same partitions.
    """
    return df.filter(F.col("date_load") >= F.lit((as_of - timedelta(days=days)).isoformat()))


def scan_month(df: DataFrame, run_day: str) -> DataFrame:
    """The ``yyyyMM`` partition that a run day falls into."""
    if "date_load" not in df.columns:
        raise ValueError("the table has no date_load column")
    return df.filter(F.col("date_load") == F.lit(month_of(run_day)))


def month_of(run_day: str) -> str:
    return date.fromisoformat(run_day).strftime("%Y%m")


def select_tagged(df: DataFrame, columns: Sequence[str], table_name: str) -> DataFrame:
    """Required columns plus the name of the table they came from."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"{table_name} lacks required columns: {missing}")
    wanted = [name for name in columns if name != "date_load"]
    return df.select(*wanted, F.lit(table_name).alias("source_table"), "date_load")


def read_partitioned(spark: SparkSession, path: str, partition_columns: Sequence[str]) -> DataFrame:
    """A Parquet folder whose partition values stay text (``202401`` would be read as a number)."""
    found = spark.read.parquet(path).schema
    schema = T.StructType([
        T.StructField(f.name, T.StringType()) if f.name in partition_columns else f
        for f in found.fields
    ])
    return spark.read.schema(schema).parquet(path)


def table_column_types(spark: SparkSession, table: str | None) -> dict[str, T.DataType]:
    """Column types of a table that exists already; nothing for a new one."""
    if not table or not spark.catalog.tableExists(table):
        return {}
    return {f.name: f.dataType for f in spark.table(table).schema.fields}


def table_location(spark: SparkSession, table: str) -> str:
    """Folder of a catalog table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(row["data_type"] for row in described if row["col_name"] == "Location")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """Partition columns of a catalog table, in order."""
    names = [row["col_name"] for row in spark.sql(f"DESCRIBE TABLE {table}").collect()]
    if "# Partition Information" not in names:
        return []
    listed = names[names.index("# Partition Information") + 1:]
    return [name for name in listed if name and not name.startswith("#")]
