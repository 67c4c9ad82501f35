"""Queries that run whole flows, from files or bronze tables to the table they fill."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.checks import adapters as a
from reviewlake.checks.registry import checked
from reviewlake.checks.scans import FEED_COLUMNS, feed_entry
from reviewlake.checks.writes import scratch_database
from reviewlake.config import Rule
from reviewlake.plans import land_feed, run_bronze, run_gold, run_silver
from reviewlake.plans.landing import APP_KEY
from reviewlake.session import session_conf, shuffles_dropped, write_sizing
from reviewlake.sinks import TABLES, create_table, export_documents, insert_partitions

RUN_TS = datetime(2024, 2, 10, 6, 30, tzinfo=timezone.utc)


# One task that gathers pages takes about so many reviews, or bytes of them as shuffled.
TASK_REVIEWS, PAGE_TASK_BYTES = 200_000, 32 << 20
# Landing files come from pages, one folder for each app.
PAGED_FLOW = replace(a.EXTERNAL_FLOW, source={**a.EXTERNAL_FLOW.source, "app_key": APP_KEY})


def _pages(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Feed pages of up to 50 reviews by app, and for every third page one more that is cut off."""
    reviews = a.external_reviews(spark, sf_dir).withColumnRenamed("author_ura", "author_uri")
    entry = feed_entry({name: F.col(name).cast("string") for name in FEED_COLUMNS})
    pages = reviews.groupBy(F.col("app_reference").alias("app"), F.floor(F.col("review_id").cast("bigint") / 50).alias("page")).agg(
        F.to_json(F.struct(F.struct(F.collect_list(entry).alias("entry")).alias("feed"))).alias("value"))
    texts = F.when(F.col("page") % 3 == 0, F.array("value", F.substring("value", 1, 90))).otherwise(F.array("value"))
    # Entries are far longer than the optimizer takes them for, so the tasks are counted by the reviews.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), reviews.count() // TASK_REVIEWS)
    sizing = session_conf(spark, spark__sql__adaptive__coalescePartitions__initialPartitionNum=str(tasks),
                          spark__sql__adaptive__advisoryPartitionSizeInBytes=str(PAGE_TASK_BYTES))
    with write_sizing(spark), sizing, shuffles_dropped(spark):
        pages.select("app", F.explode(texts).alias("value")).write.partitionBy("app").text(
            f"{root}/pages/{a.RUN_DAY}", compression="gzip")
    return f"{root}/pages"


@checked("bronze_external", f"""
WITH {a.EXTERNAL_SQL}
SELECT * EXCLUDE (updated_utc) REPLACE ('2024-02-10 06:30:00.000000' AS ingestion_ts,
                                        '2024-02-10' AS date_load)
FROM ext""")
def bronze_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From feed pages: one run loads all apps of a day, a second run of one app replaces its rows only."""
    database, root = scratch_database(spark)
    land_feed(spark, pages_root=_pages(spark, sf_dir, root), landing=f"{root}/landing/feed/reviews",
              quarantine=f"{root}/quarantine", day=a.RUN_DAY, page_key="app", metrics_path=f"{root}/metrics")
    name = create_table(spark, database, "external_reviews", TABLES["external_reviews"],
                        f"{root}/external_reviews")
    for app in (None, "f"):
        run_bronze(spark, PAGED_FLOW, landing_root=f"{root}/landing", day=a.RUN_DAY, table=name,
                   app=app, tag_app=True, run_ts=RUN_TS, metrics_path=f"{root}/metrics")
    return spark.table(name).withColumn("ingestion_ts", a.stamp("ingestion_ts"))


@checked("land_feed", f"""
WITH {a.EXTERNAL_SQL},
pages AS (SELECT app_reference AS app, CAST(review_id AS BIGINT) // 50 AS page, count(*) AS reviews FROM ext GROUP BY ALL),
told AS (SELECT app, sum(reviews) AS reviews, count(*) + count(*) FILTER (WHERE page % 3 = 0) AS pages,
                count(*) FILTER (WHERE page % 3 = 0) AS unreadable FROM pages GROUP BY app)
SELECT app, reviews::BIGINT AS reviews, unreadable, (SELECT sum(pages)::BIGINT FROM told) AS total_pages,
       (SELECT sum(unreadable)::BIGINT FROM told) AS total_unreadable, 2::BIGINT AS listed_runs FROM told""")
def land_feed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews landed and pages set aside by app, with the totals of the run's record; landed twice without harm."""
    _, root = scratch_database(spark)
    args = dict(pages_root=_pages(spark, sf_dir, root), landing=f"{root}/landing", quarantine=f"{root}/quarantine",
                day=a.RUN_DAY, page_key="app", metrics_path=f"{root}/metrics", manifest_path=f"{root}/manifest")
    for _ in range(2):
        result = land_feed(spark, **args)
    record = result.metrics.select("total_records", "validation_results.type_consistency_check.count").first()
    runs = spark.read.parquet(f"{root}/manifest").select("run_id").distinct().count()
    landed = spark.read.schema("review_id STRING, app STRING").json(f"{root}/landing/{a.RUN_DAY}").groupBy("app").agg(
        F.count("*").alias("reviews"))
    aside = spark.read.parquet(f"{root}/quarantine").groupBy("app").agg(F.count("page").alias("unreadable"))
    told = {"total_pages": record[0], "total_unreadable": record[1], "listed_runs": runs}
    return landed.join(aside, "app").withColumns({name: F.lit(n).cast("long") for name, n in told.items()})


@checked("bronze_append_metrics", f"""
WITH {a.EXTERNAL_SQL}
SELECT run, CASE WHEN run = 3 THEN 0 ELSE count(*) END AS total_records FROM ext, (VALUES (1), (2), (3)) r(run) GROUP BY run""")
def bronze_append_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of two appending runs and of one without a landing folder: each of its own rows."""
    database, root = scratch_database(spark)
    reviews = a.external_reviews(spark, sf_dir).withColumnRenamed("author_ura", "author_uri")
    reviews.select(*[F.col(name).cast("string") for name in FEED_COLUMNS]).write.json(
        f"{root}/landing/feed/reviews/{a.RUN_DAY}/f")
    name = create_table(spark, database, "external_reviews", TABLES["external_reviews"], f"{root}/external_reviews")
    records = None
    for run, landing in enumerate(("landing", "landing", "void"), 1):
        result = run_bronze(spark, a.EXTERNAL_FLOW, landing_root=f"{root}/{landing}", day=a.RUN_DAY, table=name,
                            app="f", tag_app=True, mode="append", metrics_path=f"{root}/metrics")
        record = result.metrics.select(F.lit(run).alias("run"), "total_records")
        records = record if records is None else records.union(record)
    return records


@checked("bronze_internal", f"""
WITH {a.INTERNAL_SQL}
SELECT * REPLACE (strftime(submission_date, '%Y-%m-%d %H:%M:%S.%f') AS submission_date,
                  '2024-02-10 06:30:00.000000' AS ingestion_ts, '2024-02-10' AS date_load)
FROM feedback""")
def bronze_internal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents exported to one day's folder and loaded from there."""
    database, root = scratch_database(spark)
    documents = a.internal_documents(spark, sf_dir).drop("date_load")
    export_documents(documents, f"{root}/landing/internal/reviews/{a.RUN_DAY}")
    name = create_table(spark, database, "internal_reviews", TABLES["internal_reviews"],
                        f"{root}/internal_reviews")
    run_bronze(spark, a.INTERNAL_FLOW, landing_root=f"{root}/landing", day=a.RUN_DAY, table=name,
               missing="null", strict_types=True, run_ts=RUN_TS, metrics_path=f"{root}/metrics")
    return spark.table(name).withColumns(
        {c: a.stamp(c) for c in ("submission_date", "ingestion_ts")})


@checked("bronze_evolved", f"""
WITH {a.INTERNAL_SQL}
SELECT client_identification, service_type, CASE WHEN day = '2024-02-11' THEN source_user_agent END AS source_user_agent,
       day AS date_load FROM feedback, (VALUES ('2024-02-10'), ('2024-02-11')) d(day)""")
def bronze_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flow that gains a column: the table gains it too, and the rows of the day before have NULL there."""
    database, root = scratch_database(spark)
    documents, days = a.internal_documents(spark, sf_dir).drop("date_load"), (a.RUN_DAY, "2024-02-11")
    export_documents(documents, f"{root}/landing/internal/reviews/{days[0]}")
    export_documents(documents, f"{root}/landing/internal/reviews/{days[1]}")
    before = replace(TABLES["internal_reviews"], columns=[c for c in TABLES["internal_reviews"].columns if c[0] != "source_user_agent"])
    name = create_table(spark, database, "internal_reviews", before, f"{root}/internal_reviews")
    evolving = replace(a.INTERNAL_FLOW, rules=(*a.INTERNAL_FLOW.rules, Rule("evolution_mergeschema", "true")))
    for flow, day in ((a.INTERNAL_FLOW, days[0]), (evolving, days[1])):
        run_bronze(spark, flow, landing_root=f"{root}/landing", day=day, table=name, missing="null", run_ts=RUN_TS)
    return spark.table(name).select("client_identification", "service_type", "source_user_agent", "date_load")


@checked("gold_flow", ",".join([
    f"WITH {a.UNIFIED_SQL}", a.deduplicated_sql("unified", "kept"),
    "rated AS (SELECT * FROM kept WHERE review_rating BETWEEN 1 AND 5)",
    a.cleaned_sql("rated", "silver", "202402"),
]) + a.kpi_sql("silver"))
def gold_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze tables through the silver snapshot to the indicator table."""
    database, root = scratch_database(spark)
    names = {label: create_table(spark, database, label, TABLES[label], f"{root}/{label}")
             for label in ("external_reviews", "internal_reviews", "unified_reviews", "review_kpis")}
    insert_partitions(a.external_reviews(spark, sf_dir), names["external_reviews"])
    insert_partitions(a.internal_reviews(spark, sf_dir), names["internal_reviews"])
    run_silver(spark, a.SILVER_FLOW, external_table=names["external_reviews"],
               internal_table=names["internal_reviews"], table=names["unified_reviews"],
               run_day=a.RUN_DAY, metrics_path=f"{root}/metrics")
    run_gold(spark, a.GOLD_FLOW, source_table=names["unified_reviews"],
             table=names["review_kpis"], run_day=a.RUN_DAY, metrics_path=f"{root}/metrics")
    return spark.table(names["review_kpis"])
