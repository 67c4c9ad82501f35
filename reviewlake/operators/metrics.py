"""Run metrics: one record per run, its JSON form, and the operations roll-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLOCK_FORMAT = "yyyy-MM-dd HH:mm:ss"
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
# Partition column of the metrics table, not part of a record.
RUN_ID = "run_id"
# The folder that a record lies in: that of its run, or that of its day once the day is folded.
RUN_BATCH = "run_batch"
# What a record on file is of; not part of the record itself.
RUN_DAY, RUN_APP = "run_day", "run_app"
CHECKS = {
    "duplicate_check": "duplicate_count",
    "null_check": "null_count",
    "type_consistency_check": "type_count",
}
# Messages of the output check.
ROWS_WRITTEN = "Dados agregados com sucesso."
NO_ROWS = "Nenhum registro a ser gravado."

# Both kinds of record share one layout, so one table holds them; checks that were not made are
# NULL there and absent from the JSON form.
VALIDATION_DDL = """
    total_records BIGINT,
    duplicate_check STRUCT<status: BOOLEAN, count: BIGINT>,
    null_check STRUCT<status: BOOLEAN, count: BIGINT>,
    type_consistency_check STRUCT<status: BOOLEAN, count: BIGINT>,
    main_check STRUCT<status: BOOLEAN, message: STRING>
"""


def _as_column(value: Column | str | datetime) -> Column:
    if isinstance(value, datetime):
        return F.lit(value).cast("timestamp")
    return value if isinstance(value, Column) else F.lit(value)


def _clocks(started: Column, ended: Column, prefix: str) -> list[Column]:
    # Epoch micros keep the fraction of a second that a difference of timestamps in seconds drops.
    seconds = (F.unix_micros(ended) - F.unix_micros(started)) / 1000000
    return [
        F.format_string("%.2f s", seconds).alias("total_processing_time"),
        F.struct(
            F.date_format(started, CLOCK_FORMAT).alias(f"{prefix}_start_ts"),
            F.date_format(ended, CLOCK_FORMAT).alias(f"{prefix}_end_ts"),
        ).alias("_ts"),
        F.date_format(ended, STAMP_FORMAT).alias("timestamp"),
    ]


def _owner(owner: Mapping[str, Column | str]) -> Column:
    return F.struct(*[_as_column(v).alias(k) for k, v in owner.items()]).alias("owner")


def _validation(fields: Mapping[str, Column]) -> Column:
    declared = T.DataType.fromDDL(VALIDATION_DDL)
    return F.struct(*[
        fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in declared.fields
    ]).alias("validation_results")


def _share(count: Column, percentage: Column, name: str) -> Column:
    return F.struct(count.alias("count"), percentage.alias("percentage")).alias(name)


def run_metrics(
    summary: DataFrame,
    owner: Mapping[str, Column | str],
    app_id: Column | str,
    started: Column | datetime,
    ended: Column | datetime,
    *,
    keep: Sequence[str] = (),
    clock_prefix: str = "run",
) -> DataFrame:
    """Metrics record of each row of a quality summary; a check passes when its count is 0.

    ``clock_prefix`` names the two clock fields of ``_ts``, for readers that expect their own.
    """
    passed = {check: F.col(count) == 0 for check, count in CHECKS.items()}
    passed_count = sum((ok.cast("int") for ok in passed.values()), F.lit(0))
    checks = {check: F.struct(ok.alias("status"), F.col(CHECKS[check]).alias("count"))
              for check, ok in passed.items()}
    elapsed, clock, stamp = _clocks(_as_column(started), _as_column(ended), clock_prefix)
    return summary.select(
        *keep,
        _owner(owner),
        _share(F.col("valid_count"), F.col("valid_percentage"), "valid_data"),
        _share(F.col("invalid_count"), F.col("invalid_percentage"), "invalid_data"),
        "total_records",
        elapsed,
        _validation({"total_records": F.col("total_records"), **checks}),
        passed_count.alias("success_count"),
        (F.lit(len(CHECKS)) - passed_count).alias("error_count"),
        clock,
        stamp,
        _as_column(app_id).alias("app_id"),
    )


def output_check_metrics(
    rows: DataFrame,
    owner: Mapping[str, Column | str],
    app_id: Column | str,
    started: Column | datetime,
    ended: Column | datetime,
    *,
    clock_prefix: str = "run",
) -> DataFrame:
    """Metrics record of an aggregate flow: it passes when it produced rows.

    ``rows`` is a one-row DataFrame with the column ``total_records``.
    """
    total = F.col("total_records")
    ok = total > 0
    elapsed, clock, stamp = _clocks(_as_column(started), _as_column(ended), clock_prefix)
    message = F.when(ok, ROWS_WRITTEN).otherwise(NO_ROWS)
    return rows.select(
        _owner(owner),
        _share(total, F.when(ok, 100.0).otherwise(0.0), "valid_data"),
        _share(F.lit(0).cast("bigint"), F.lit(0.0), "invalid_data"),
        "total_records",
        elapsed,
        _validation({"main_check": F.struct(ok.alias("status"), message.alias("message"))}),
        ok.cast("int").alias("success_count"),
        (~ok).cast("int").alias("error_count"),
        clock,
        stamp,
        _as_column(app_id).alias("app_id"),
    )


def metrics_payload(metrics: DataFrame) -> DataFrame:
    """Each record as one JSON document, next to the columns a reader filters by."""
    return metrics.select(
        F.col("owner.layer_lake").alias("layer_lake"),
        "app_id",
        "timestamp",
        "error_count",
        F.to_json(F.struct(*[c for c in metrics.columns if c not in (RUN_ID, RUN_BATCH, RUN_DAY, RUN_APP)])).alias("payload"),
    )


def operations_dashboard(metrics: DataFrame) -> DataFrame:
    """Runs passed and failed, issue totals and mean processing time per layer."""
    checks = F.col("validation_results")
    seconds = F.regexp_extract("total_processing_time", r"^(-?[0-9.]+) s$", 1).try_cast("decimal(18,2)")
    failed = F.col("error_count") > 0
    return metrics.groupBy(F.col("owner.layer_lake").alias("layer_lake")).agg(
        F.count("*").alias("runs"),
        F.count_if(~failed).alias("runs_passed"),
        F.count_if(failed).alias("runs_failed"),
        F.coalesce(F.sum(checks["null_check"]["count"]), F.lit(0)).alias("null_total"),
        F.coalesce(F.sum(checks["type_consistency_check"]["count"]), F.lit(0))
        .alias("inconsistent_total"),
        F.coalesce(F.sum(checks["duplicate_check"]["count"]), F.lit(0)).alias("duplicate_total"),
        F.avg(seconds).cast("double").alias("mean_processing_seconds"),
    )
