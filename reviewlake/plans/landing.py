"""Feed pages to landing files: one parse, reviews by day and app, unreadable pages set aside."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reviewlake import filesystem
from reviewlake.operators import run_metrics
from reviewlake.plans.run import RunResult, finish, owner_of, utc_now
from reviewlake.session import scratch_dir
from reviewlake.sinks import append_manifest, list_files, new_run_id, write_partitions
from reviewlake.sources import app_folder, existing_paths, landing_paths, read_feed_pages
from reviewlake.sources.feed import CORRUPT, page_entries, review_fields

# Folder name of an app among the landing files: ``app=<name>``, as Spark names partitions.
APP_KEY = "app"
FLOW = "landing"
# Landing files are packed, so one task must read each as a whole; its rows take about so much when shuffled.
LANDING_OPTIONS, LANDING_BYTES = {"compression": "gzip"}, 32 << 20


@dataclass(frozen=True)
class Landed(RunResult):
    """A landing run: pages read, pages set aside, reviews written."""

    pages: int = 0
    unreadable: int = 0
    reviews: int = 0


def parsed_pages(pages: DataFrame, day: str, base: str, key: str = "") -> DataFrame:
    """(app, entries, page): the reviews of each page, or its text if it cannot be read."""
    entries, broken = page_entries(pages)
    return pages.select(
        F.coalesce(F.lower(app_folder(F.col("_metadata.file_path"), day, base, key)), F.lit("na")).alias(APP_KEY),
        F.when(~broken, entries).alias("entries"),
        F.when(broken, F.coalesce(F.col(CORRUPT), F.col("feed.entry"))).alias("page"))


def land_feed(
    spark: SparkSession,
    *,
    pages_root: str,
    landing: str,
    quarantine: str,
    day: str,
    apps: Iterable[str] = (),
    page_key: str = "",
    multiline: bool = False,
    metrics_path: str | None = None,
    manifest_path: str | None = None,
    domain: str = "",
    project: str = "",
) -> Landed:
    """Pages below ``<pages_root>/<day>[/<app>]`` (or ``/<page_key>=<app>``) to ``<landing>/<day>/app=<app>`` and a quarantine table.

    Pages are read and parsed once. What an app's pages of the day held before is replaced, so a run may
    be repeated; apps without pages stay as they are. Unreadable pages go, with their app, to the day's
    partition of the quarantine table, which a run without any empties. The record of the run counts
    pages, and pages set aside as type issues. Pages directly in the day's folder are of app ``na``.
    Landing files are JSON lines in gzip, as old and new ones lie side by side until a repeated run commits.
    """
    started, run_id, apps = utc_now(), new_run_id(), list(apps)
    paths = landing_paths(pages_root, day, apps, page_key)
    if manifest_path:
        append_manifest(list_files(spark, paths), manifest_path, run_id)
    counts, staged = Observation("pages"), scratch_dir(spark, "parsed-pages")
    found = existing_paths(spark, paths)
    seen = {"pages": 0, "unreadable": 0, "reviews": 0}
    if found:
        parsed = parsed_pages(read_feed_pages(spark, found, multiline), day, pages_root, page_key)
        parsed.observe(counts, F.count("*").alias("pages"), F.count("page").alias("unreadable"),
                       F.coalesce(F.sum(F.when(F.col("entries").isNotNull(), F.size("entries"))), F.lit(0)).alias("reviews"),
                       ).write.parquet(staged)
        seen = {name: int(value) for name, value in counts.get.items()}
        pages = spark.read.schema(parsed.schema).parquet(staged)
        reviews = pages.select(APP_KEY, F.explode("entries").alias("entry")).select(*review_fields(), APP_KEY)
        write_partitions(reviews, f"{landing.rstrip('/')}/{day}", [APP_KEY], file_format="json",
                         file_bytes=LANDING_BYTES, options=LANDING_OPTIONS)
        # A static overwrite of one partition: yesterday's pages of a mended day do not stay behind.
        aside = pages.filter("page is not null").select(APP_KEY, "page")
        aside.coalesce(max(1, seen["unreadable"] // 100_000)).write.mode("overwrite").parquet(
            f"{quarantine.rstrip('/')}/date_load={day}")
        filesystem.delete(spark, staged)
    good = seen["pages"] - seen["unreadable"]
    share = lambda n: round(100.0 * n / seen["pages"], 2) if seen["pages"] else 0.0
    summary = spark.createDataFrame(
        [(seen["pages"], 0, 0, seen["unreadable"], good, share(good), seen["unreadable"], share(seen["unreadable"]))],
        "total_records BIGINT, duplicate_count BIGINT, null_count BIGINT, type_count BIGINT, valid_count BIGINT, "
        "valid_percentage DOUBLE, invalid_count BIGINT, invalid_percentage DOUBLE")
    metrics = run_metrics(summary, owner_of(domain, project, FLOW, "feed"), FLOW, started, utc_now())
    result = Landed(landing, {"date_load": day}, metrics, **seen)
    return finish(result, metrics_path, day, apps[0].strip().lower() if len(apps) == 1 else None, run_id)
