"""What a run leaves behind."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.config import FlowConfig
from reviewlake.operators.metrics import RUN_APP, RUN_DAY
from reviewlake.session import write_sizing
from reviewlake.sinks import append_metrics
from reviewlake.sources import partition_columns


# Keys that one task counts, as shuffled: in its hash table they take some 25 times as much.
COUNTED_BYTES = 8 << 20


@dataclass(frozen=True)
class RunResult:
    """The table written, the partition it went to, and the metrics record of the run."""

    table: str
    partition: Mapping[str, str]
    metrics: DataFrame


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def owner_of(domain: str, project: str, layer: str, layer_source: str) -> dict[str, str]:
    """Owner part of a metrics record; the field names are fixed by its readers."""
    return {"dominio": domain, "projeto": project, "layer_lake": layer, "layer_source": layer_source}


def write_mode(spark: SparkSession, config: FlowConfig, table: str, mode: str | None) -> str:
    """The mode of a write: the argument, else what the flow's target settings say.

    Format and partition of the settings must be those the table declares.
    """
    sink = config.sink
    declared, wanted = partition_columns(spark, table), sink.get("partitionBy")
    columns = [c.strip() for c in wanted.split(",")] if wanted else []
    if declared and not set(columns) <= set(declared):
        raise ValueError(f"{table} is partitioned by {declared}, its flow names {columns}")
    if sink.get("format"):
        rows = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Provider'").collect()
        provider = rows[0]["data_type"].lower() if rows else ""
        if provider and provider != sink["format"].lower():
            raise ValueError(f"{table} is stored as {provider}, its flow names {sink['format']}")
    return mode or sink.get("mode") or "overwrite"


def settled(df: DataFrame, measured: DataFrame | None = None) -> DataFrame:
    """A one-row result, computed now; ``measured`` are the keys that its count shuffles."""
    spark = df.sparkSession
    with write_sizing(spark, measured, COUNTED_BYTES):
        return spark.createDataFrame(df.collect(), df.schema)


def finish(
    result: RunResult, metrics_path: str | None, day: str, app: str | None = None, run_id: str | None = None
) -> RunResult:
    """Put the record of a run on file, with the day and app it is of."""
    if metrics_path:
        named = result.metrics.withColumn(RUN_DAY, F.lit(day)).withColumn(RUN_APP, F.lit(app).cast("string"))
        append_metrics(named, metrics_path, run_id)
    return result
