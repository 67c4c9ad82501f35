"""Which landing files a run has read, and the purge of files that successful runs have read."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake import filesystem
from reviewlake.operators.metrics import RUN_DAY, RUN_ID
from reviewlake.sources.landing import existing_paths

# A file is known by where it is, how long it is and when it was last written.
FILE = ("path", "length", "modified")
FILE_DDL = "path STRING, length BIGINT, modified TIMESTAMP"


def list_files(spark: SparkSession, folders: Iterable[str]) -> DataFrame:
    """(path, length, modified) of every file below the folders, by Spark's own listing; no file is opened."""
    found = existing_paths(spark, folders)
    if not found:
        return spark.createDataFrame([], FILE_DDL)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(found)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def append_manifest(files: DataFrame, path: str, run_id: str) -> None:
    """Put the files that a run is about to read on file; they count once the run has a record."""
    (files.select(*FILE).withColumn(RUN_ID, F.lit(run_id)).write.mode("overwrite").partitionBy(RUN_ID)
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def loaded_files(
    listing: DataFrame, manifest: DataFrame, metrics: DataFrame, *, day: str | None = None, flows: Sequence[str] = ()
) -> DataFrame:
    """The listed files that are just as a successful run has read them.

    A run is successful if it has a record in ``metrics``; ``day`` and ``flows`` (target tables) choose
    among the records. What a record counts does not matter: a run opens the files on its own list only.
    """
    runs = metrics.filter(F.col(RUN_ID).isNotNull())
    if day is not None:
        runs = runs.filter(F.col(RUN_DAY) == day)
    if flows:
        runs = runs.filter(F.col("app_id").isin(*flows))
    read = manifest.join(runs.select(RUN_ID).distinct(), RUN_ID, "left_semi").select(*FILE).distinct()
    return listing.join(read, list(FILE), "left_semi")


def purge_loaded(
    spark: SparkSession,
    folders: Iterable[str],
    *,
    manifest: DataFrame,
    metrics: DataFrame,
    day: str | None = None,
    flows: Sequence[str] = (),
) -> int:
    """Delete the landing files below ``folders`` that successful runs have read; returns how many.

    Files that no run has listed stay, as do files written again since, and those of runs that left no
    record. Paths pass through the driver a few at a time; folders go once they are empty.
    """
    folders = list(folders)
    gone = 0
    for row in loaded_files(list_files(spark, folders), manifest, metrics, day=day, flows=flows).toLocalIterator():
        gone += filesystem.delete(spark, row["path"])
    for folder in folders:
        filesystem.prune(spark, folder)
    return gone
