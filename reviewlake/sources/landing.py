"""Raw landing files: ``<root>/<day>[/<app>]/...``, read under a declared schema."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake import filesystem
from reviewlake.config import FlowConfig

logger = logging.getLogger(__name__)


def landing_paths(root: str, days: str | Iterable[str], apps: Iterable[str] = (), key: str = "") -> list[str]:
    """Folders to list. Blank or no apps means the whole day, so other days are never listed.

    With ``key`` the folder of an app is named as Spark names partitions: ``key=app``.
    """
    base = root.rstrip("/")
    days = [days] if isinstance(days, str) else list(days)
    wanted = [app.strip() for app in apps if app and app.strip()]
    return [f"{base}/{day.strip()}{suffix}"
            for day in days
            for suffix in ([f"/{key}={app}" if key else f"/{app}" for app in wanted] or [""])]


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    found = []
    for path in paths:
        if filesystem.exists(spark, path):
            found.append(path)
        else:
            logger.warning("landing path not found, skipped: %s", path)
    return found


def read_landing(
    spark: SparkSession,
    file_format: str,
    schema: T.StructType,
    paths: Sequence[str],
    options: Mapping[str, str] | None = None,
    *,
    path_column: str | None = None,
) -> DataFrame:
    """Read every file below the given folders in one scan.

    A missing folder holds no rows and is not an error. Any other failure is: a folder that cannot
    be read must not look like a quiet day. ``path_column`` adds the path of each row's file.
    """
    file_format = file_format.lower()
    found = existing_paths(spark, paths)
    if not found:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(path_column, F.lit("")) if path_column else empty
    reader = spark.read.format(file_format).schema(schema).option("recursiveFileLookup", "true")
    if file_format == "csv":
        reader = reader.option("header", "true")
    rows = reader.options(**(options or {})).load(found)
    return rows.select("*", F.col("_metadata.file_path").alias(path_column)) if path_column else rows


def app_folder(path: Column, day: str, base: str = "", key: str = "") -> Column:
    """Name of the folder below the day that a file lies in; NULL if it lies in the day itself.

    ``base`` is the folder that holds the days, so that a day further up in the path is not taken for it.
    With ``key`` the folder is named ``key=app``.
    """
    # The scheme may be written in more than one way; what follows it may not.
    base = re.sub(r"^\w+:/*", "/", base.rstrip("/"))
    prefix = f"{re.escape(key)}=" if key else ""
    # Spark gives paths percent-encoded; a plus sign stands for itself there.
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.nullif(F.regexp_extract(decoded, f"{re.escape(base)}/{re.escape(day)}/{prefix}([^/]+)/", 1), F.lit(""))


def read_flow_source(
    spark: SparkSession,
    config: FlowConfig,
    root: str,
    days: str | Iterable[str],
    apps: Iterable[str] = (),
    *,
    path_column: str | None = None,
) -> DataFrame:
    """The landing files that a flow declares; none at all is empty, or an error if its fallback settings say so."""
    paths = source_paths(config, root, days, apps)
    if config.fallback.get("create_empty_if_missing", "true").strip().lower() == "false" and not existing_paths(spark, paths):
        raise FileNotFoundError(f"none of the landing folders is there: {paths}")
    return read_landing(spark, config.source["format"], config.expected_schema, paths, path_column=path_column)


def source_paths(config: FlowConfig, root: str, days: str | Iterable[str], apps: Iterable[str] = ()) -> list[str]:
    """The folders that hold a flow's files; its source settings name the directory and the ``app_key``, if any."""
    directory = config.source["directory"].strip("/")
    return landing_paths(f"{root.rstrip('/')}/{directory}", days, apps, config.source.get("app_key") or "")
