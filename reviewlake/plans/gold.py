"""One silver snapshot to the indicator table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.config import FlowConfig
from reviewlake.operators import output_check_metrics, prepare_for_kpis, review_kpis
from reviewlake.plans.run import RunResult, finish, owner_of, settled, utc_now
from reviewlake.sinks import compact_table, write_full
from reviewlake.sources import scan_month

CLUSTER_COLUMN = "review_month"


def gold_rows(silver: DataFrame, run_day: str) -> DataFrame:
    """Indicators of the snapshot of the run's month."""
    return review_kpis(prepare_for_kpis(scan_month(silver, run_day)))


def run_gold(
    spark: SparkSession,
    config: FlowConfig,
    *,
    source_table: str,
    table: str,
    run_day: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    cluster_after: bool = True,
    metrics_path: str | None = None,
    domain: str = "",
    project: str = "",
) -> RunResult:
    """Replace the indicator table; an empty snapshot leaves it as it was and fails the check."""
    started = utc_now()
    written = write_full(gold_rows(spark.table(source_table), run_day), table, mode=mode,
                         partition_by=partition_by)
    if written and cluster_after:
        compact_table(spark, table, cluster_by=[CLUSTER_COLUMN])
    rows = spark.table(table) if written else spark.range(0)
    counted = settled(rows.agg(F.count("*").alias("total_records")))
    metrics = output_check_metrics(
        counted,
        owner_of(domain, project, "gold", config.source_layer), config.target_table,
        started, utc_now(),
    )
    return finish(RunResult(table, {}, metrics), metrics_path, run_day)
