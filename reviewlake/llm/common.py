"""What the operators share: tables, cuts of the lineage and text predicates."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake import filesystem
from reviewlake.session import scratch_dir, shuffles_dropped

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def registered(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL twin where SQL can express it."""

    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read again.

    Later steps start from the files, so a lost executor costs no recomputation of what came before,
    and the shuffle files of the step can go at its end.
    """
    return cut_all([df], label)


def cut_all(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """The rows of all parts, at least one, written one part after another as ``cut`` does."""
    path = None
    for df in parts:
        path = path or scratch_dir(df.sparkSession, label)
        with shuffles_dropped(df.sparkSession):
            df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(written: DataFrame) -> None:
    """Delete the files of a table that ``cut`` wrote and nothing will read again."""
    for path in {file.rsplit("/", 1)[0] for file in written.inputFiles()}:
        filesystem.delete(written.sparkSession, path)


def row_but(df: DataFrame, name: str) -> Column:
    """All columns as ``row``, for an operator that adds ``name``; one of that name gives way."""
    return F.struct(*(df[c] for c in df.columns if c != name)).alias("row")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
