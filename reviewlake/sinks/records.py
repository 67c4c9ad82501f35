"""The table of run records: one folder a run, folded into one a day once the day is over."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake import filesystem
from reviewlake.operators.metrics import RUN_BATCH, RUN_DAY, RUN_ID
from reviewlake.sinks.partitions import new_run_id

FOLDED = "day-"


def append_metrics(metrics: DataFrame, path: str, run_id: str | None = None) -> None:
    """Add run records to the metrics table; a handful of rows, so one file per run.

    Every call fills a folder of its own, named by the run: runs of several apps end at the same
    time, and plain appends to one folder share a work folder that the first to finish removes.
    """
    run_id = run_id or new_run_id()
    own = metrics.coalesce(1).withColumns({RUN_ID: F.lit(run_id), RUN_BATCH: F.lit(run_id)})
    (own.write.mode("overwrite").partitionBy(RUN_BATCH)
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """All records, each once: while a day is being folded, its runs' own folders no longer count."""
    rows = spark.read.parquet(path)
    folded = F.col(RUN_BATCH).startswith(FOLDED)
    runs = rows.filter(folded).select(RUN_ID).distinct()
    return rows.filter(folded).unionByName(rows.filter(~folded).join(runs, RUN_ID, "left_anti"))


def fold_metrics(spark: SparkSession, path: str, day: str) -> int:
    """Put the records of a finished day into one folder; returns how many folders it takes the place of.

    The folder appears complete, by one rename of a new name, and the runs' own folders go after it; a fold that
    dies on the way is ended by the next.
    """
    root = path.rstrip("/")
    rows = read_metrics(spark, path).filter(F.col(RUN_DAY) == day)
    runs = [r[0] for r in rows.filter(~F.col(RUN_BATCH).startswith(FOLDED)).select(RUN_BATCH).distinct().collect()]
    if runs:
        name = f"{FOLDED}{day}-{uuid.uuid4().hex[:12]}"
        fresh = rows.filter(F.col(RUN_BATCH).isin(*runs)).drop(RUN_BATCH)
        fresh.coalesce(1).write.parquet(f"{root}/_fold-{name}")
        filesystem.move(spark, f"{root}/_fold-{name}", f"{root}/{RUN_BATCH}={name}")
    stored = spark.read.parquet(path)
    held = stored.filter(F.col(RUN_BATCH).startswith(FOLDED)).select(RUN_ID).distinct()
    done = stored.filter((F.col(RUN_DAY) == day) & ~F.col(RUN_BATCH).startswith(FOLDED)).join(held, RUN_ID, "left_semi")
    gone = [r[0] for r in done.select(RUN_BATCH).distinct().collect()]
    for run in gone:
        filesystem.delete(spark, f"{root}/{RUN_BATCH}={run}")
    spark.catalog.refreshByPath(path)
    return len(gone)
