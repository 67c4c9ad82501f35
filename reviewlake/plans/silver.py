"""Bronze tables to the unified silver table: a rolling window, snapshotted per month."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.config import FlowConfig
from reviewlake.operators import (
    apply_review_rules,
    clean_reviews,
    quality_summary,
    run_metrics,
    unify_external,
    unify_internal,
    union_sources,
)
from reviewlake.operators.unify import EXTERNAL_SYSTEM, INTERNAL_SYSTEM
from reviewlake.plans.run import RunResult, finish, owner_of, settled, utc_now, write_mode
from reviewlake.sinks import compact, insert_partitions, new_run_id, own_rows, stamp_month
from reviewlake.sources import scan_days_back, select_tagged
from reviewlake.sources.tables import month_of

# Columns the unification reads, where the configuration does not list them.
EXTERNAL_COLUMNS = ("review_id", "author_name", "updated_at", "rating", "title", "content",
                    "version", "app_reference", "ingestion_ts")
INTERNAL_COLUMNS = ("client_identification", "app_reference", "submission_date", "feedback_rating",
                    "feedback_comment", "source_id", "source_channel", "client_segment",
                    "service_type", "source_user_agent", "ingestion_ts")
# Value of the rule ``days_back`` that looks back without an end.
ALL_DAYS = "all"


def silver_rows(
    external: DataFrame,
    internal: DataFrame,
    config: FlowConfig,
    run_day: str,
    *,
    external_name: str = "external_reviews",
    internal_name: str = "internal_reviews",
    filter_first: bool = False,
    null_clients: str = "collapse",
    legacy_map: bool = False,
    anonymize_client: bool = False,
    salt: str = "",
) -> DataFrame:
    """Unified, deduplicated, filtered and cleaned reviews of the look-back window.

    The rule ``days_back = all`` takes every row, those without a load day too. One shuffle, by the review
    key; cleaning runs on what the rules leave.
    """
    as_of, days = date.fromisoformat(run_day), config.rule("days_back", "365").strip().lower()

    def window(df: DataFrame, name: str, tag: str, default: Sequence[str]) -> DataFrame:
        columns = config.columns_tagged(tag) or default
        return select_tagged(df if days == ALL_DAYS else scan_days_back(df, as_of, int(days)), columns, name)

    unified = union_sources(
        unify_external(window(external, external_name, EXTERNAL_SYSTEM, EXTERNAL_COLUMNS)),
        unify_internal(window(internal, internal_name, INTERNAL_SYSTEM, INTERNAL_COLUMNS)),
    )
    kept = apply_review_rules(unified, config, filter_first=filter_first, null_clients=null_clients)
    cleaned = clean_reviews(kept, legacy_map=legacy_map, anonymize_client=anonymize_client, salt=salt)
    return stamp_month(cleaned, run_day)


def run_silver(
    spark: SparkSession,
    config: FlowConfig,
    *,
    external_table: str,
    internal_table: str,
    table: str,
    run_day: str,
    mode: str | None = None,
    compact_after: bool = True,
    metrics_path: str | None = None,
    domain: str = "",
    project: str = "",
    **options,
) -> RunResult:
    """Write the month's snapshot; ``options`` are those of :func:`silver_rows`."""
    started = utc_now()
    mode = write_mode(spark, config, table, mode)
    rows = silver_rows(spark.table(external_table), spark.table(internal_table), config, run_day,
                       external_name=external_table, internal_name=internal_table, **options)
    partition = {"date_load": month_of(run_day)}
    run_id = new_run_id()
    insert_partitions(rows, table, mode=mode, static=partition, run_id=run_id)
    # What the partition held before is not this run's.
    written = own_rows(spark.table(table).filter(F.col("date_load") == F.lit(partition["date_load"])), run_id)
    keys = written.select(*[c for c in config.primary_key if c in written.columns])
    summary = settled(quality_summary(written, config.primary_key, config.required_columns), keys)
    if compact_after and config.zorder_columns:
        # AQE sizes the files of the write already; a rewrite only pays where it clusters.
        compact(spark, table, partition, cluster_by=config.zorder_columns)
    metrics = run_metrics(summary, owner_of(domain, project, "silver", config.source_layer),
                          config.target_table, started, utc_now())
    return finish(RunResult(table, partition, metrics), metrics_path, run_day, run_id=run_id)
