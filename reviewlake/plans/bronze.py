"""Raw files to a bronze table, one day (and app) at a time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.config import FlowConfig
from reviewlake.operators import (
    app_reference_column,
    map_columns,
    quality_summary,
    run_metrics,
    with_control_columns,
)
from reviewlake.operators.mapping import CONTROL_COLUMNS
from reviewlake.plans.run import RunResult, finish, owner_of, settled, utc_now, write_mode
from reviewlake.sinks import append_manifest, compact_table, evolve_table, insert_partitions, list_files, new_run_id, own_rows
from reviewlake.sources import (
    app_folder,
    partition_columns,
    read_flow_source,
    source_paths,
    table_column_types,
)

TYPE_ISSUE = "is_type_issue"
PATH = "__path"


def bronze_rows(
    raw: DataFrame,
    config: FlowConfig,
    day: str,
    *,
    app: str | None = None,
    tag_app: bool = False,
    run_ts: datetime | None = None,
    table_types: dict | None = None,
    missing: str = "error",
    type_issue: str | None = None,
    base: str = "",
    app_key: str = "",
) -> DataFrame:
    """Raw rows in the layout of the target table.

    ``tag_app`` sets the app as a control column: from the argument, else from the folder of the
    row's file where the raw rows carry its path; ``base`` is the folder that holds the days.
    """
    skip, keep = CONTROL_COLUMNS, []
    if tag_app:
        folder = app_folder(F.col(PATH), day, base, app_key) if PATH in raw.columns else None
        skip = (*CONTROL_COLUMNS, "app_reference")
        keep = [app_reference_column(raw.schema, app, folder).alias("app_reference")]
    mapped = map_columns(raw, config.target, config.mapping, table_types=table_types,
                         missing=missing, skip=skip, keep=keep, type_issue=type_issue)
    return with_control_columns(mapped, day, run_ts)


def run_bronze(
    spark: SparkSession,
    config: FlowConfig,
    *,
    landing_root: str,
    day: str,
    table: str,
    app: str | None = None,
    tag_app: bool = False,
    mode: str | None = None,
    missing: str = "error",
    strict_types: bool = False,
    compact_after: bool = True,
    metrics_path: str | None = None,
    manifest_path: str | None = None,
    domain: str = "",
    project: str = "",
    run_ts: datetime | None = None,
) -> RunResult:
    """Load one day of one flow; failures are raised, so nothing downstream mistakes them for success.

    The raw files are parsed once, by the write. Quality is measured on the files that the run has written,
    which are columnar and pruned to key and rule columns. ``overwrite`` makes a repeated run replace its
    own rows, ``append`` adds them again. With ``tag_app`` and no ``app`` one run loads the folders of
    all apps of the day, each row tagged with its folder.

    With the rule ``evolution_mergeschema`` the table gets the columns of the configuration that it lacks; a
    day without files is empty unless the fallback settings say ``create_empty_if_missing = false``.
    ``manifest_path`` keeps the files that the run reads, listed before it reads them: what arrives in
    between may be read, but a purge will not take it for loaded.
    """
    started = utc_now()
    mode = write_mode(spark, config, table, mode)
    one_app, run_id = bool(app and app.strip()), new_run_id()
    if manifest_path:
        paths = source_paths(config, landing_root, day, [app] if one_app else [])
        append_manifest(list_files(spark, paths), manifest_path, run_id)
    raw = read_flow_source(spark, config, landing_root, day, [app] if one_app else [],
                           path_column=PATH if tag_app and not one_app else None)
    rows = bronze_rows(
        raw, config, day, app=app, tag_app=tag_app, run_ts=run_ts or started, missing=missing,
        table_types=table_column_types(spark, table),
        type_issue=TYPE_ISSUE if strict_types else None,
        base=f"{landing_root.rstrip('/')}/{config.source['directory'].strip('/')}",
        app_key=config.source.get("app_key") or "",
    )
    partition = {"date_load": day}
    if tag_app and one_app:
        partition["app_reference"] = app.strip().lower()
    declared = partition_columns(spark, table)
    partition = {name: value for name, value in partition.items() if name in declared}

    if config.rule_is_true("evolution_mergeschema"):
        evolve_table(spark, table, rows.drop(TYPE_ISSUE).schema)
    seen = insert_partitions(
        rows, table, mode=mode, static=partition, run_id=run_id,
        measure={"type_issues": F.count_if(TYPE_ISSUE)} if strict_types else None,
    )
    # Only the rows of this run: what the partition held before is not its doing.
    written = own_rows(spark.table(table), run_id)
    for name, value in partition.items():
        written = written.filter(F.col(name) == F.lit(value))
    keys = written.select(*[c for c in config.primary_key if c in written.columns])
    summary = settled(quality_summary(written, config.primary_key, config.required_columns,
                                      type_issues_seen=int(seen.get("type_issues") or 0)), keys)
    if compact_after:
        compact_table(spark, table, partition, cluster_by=config.zorder_columns)
    metrics = run_metrics(summary, owner_of(domain, project, "bronze", config.source_layer),
                          config.target_table, started, utc_now())
    return finish(RunResult(table, partition, metrics), metrics_path, day,
                  app.strip().lower() if one_app else None, run_id)
