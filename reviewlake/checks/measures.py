"""Queries on deduplication, quality, indicators and run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake import filesystem
from reviewlake.checks import adapters as a
from reviewlake.checks.projections import stamped, stamped_sql, unified
from reviewlake.checks.registry import checked, table
from reviewlake.operators import (
    dedup_reviews,
    filter_rating,
    flag_duplicates,
    flag_nulls,
    flag_type_issues,
    metrics_payload,
    operations_dashboard,
    output_check_metrics,
    prepare_for_kpis,
    quality_summary,
    review_kpis,
    run_metrics,
    sentiment_kpis,
)
from reviewlake.plans import silver_rows
from reviewlake.plans.run import owner_of
from reviewlake.session import scratch_dir
from reviewlake.sinks import append_metrics, fold_metrics, read_metrics

KEY = ["client_identification", "app_reference"]
REQUIRED = ["feedback_comment", "client_identification"]


@checked("dedup_reviews", f"""
WITH {a.UNIFIED_SQL}, {a.deduplicated_sql('unified', 'kept')} {stamped_sql('kept')}""")
def dedup_reviews_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamped(dedup_reviews(unified(spark, sf_dir)))


@checked("flag_duplicates", f"""
WITH {a.INTERNAL_SQL}
SELECT client_identification, app_reference, service_id,
       count(*) OVER (PARTITION BY client_identification, app_reference, service_id) > 1
           AS is_duplicate
FROM feedback""")
def flag_duplicates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.internal_reviews(spark, sf_dir).select(*KEY, "service_id")
    return flag_duplicates(rows, [*KEY, "service_id"])


@checked("flag_nulls", f"""
WITH {a.INTERNAL_SQL}
SELECT feedback_comment, client_identification,
       feedback_comment IS NULL OR trim(feedback_comment) = ''
           OR client_identification IS NULL OR trim(client_identification) = '' AS is_null_issue
FROM feedback""")
def flag_nulls_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_nulls(a.internal_reviews(spark, sf_dir).select(*REQUIRED), REQUIRED)


@checked("flag_type_issues", """
SELECT o_orderkey, o_orderpriority,
       NOT regexp_full_match(substr(o_orderpriority, 1 + o_orderkey % 2, 1), '[0-9]')
           AS is_type_issue
FROM orders""")
def flag_type_issues_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first letter of the priority is a digit, the second is not."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select("o_orderkey", "o_orderpriority",
                         F.expr("substring(o_orderpriority, 1 + o_orderkey % 2, 1)").alias("rank"))
    return flag_type_issues(rows, {"rank": T.IntegerType()}).drop("rank")


def summary_sql(source: str, key: str, by: str = "") -> str:
    group, listed = (f"GROUP BY {by}", f"{by}, ") if by else ("", "")
    partition = f"{listed}{key}"
    return f"""
    SELECT {listed}*, total_records - invalid_count AS valid_count,
           CAST((total_records - invalid_count) AS DOUBLE) / total_records * 100 AS valid_percentage,
           CAST(invalid_count AS DOUBLE) / total_records * 100 AS invalid_percentage
    FROM (
        SELECT {listed}count(*) AS total_records, count(*) FILTER (duplicate) AS duplicate_count,
               count(*) FILTER (missing) AS null_count, count(*) FILTER (untyped) AS type_count,
               count(*) FILTER (duplicate) + count(*) FILTER (missing)
                   + count(*) FILTER (untyped) AS invalid_count,
               count(*) FILTER (duplicate OR missing OR untyped) AS distinct_invalid
        FROM (
            SELECT *, count(*) OVER (PARTITION BY {partition}) > 1 AS duplicate,
                   feedback_comment IS NULL OR trim(feedback_comment) = ''
                       OR client_identification IS NULL AS missing,
                   feedback_rating IS NULL AS untyped
            FROM {source})
        {group})""".replace("SELECT , ", "SELECT ").replace(f"SELECT {listed}*, total", "SELECT *, total")


def _graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.internal_reviews(spark, sf_dir).withColumn("untyped", F.col("feedback_rating").isNull())


@checked("quality_summary", f"""
WITH {a.INTERNAL_SQL} {summary_sql('feedback', 'client_identification, app_reference, service_id')}""")
def quality_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_summary(_graded(spark, sf_dir), [*KEY, "service_id"], REQUIRED,
                           type_issue="untyped")


@checked("quality_by_app", f"""
WITH {a.INTERNAL_SQL} {summary_sql('feedback', 'client_identification, service_id', 'app_reference')}""")
def quality_by_app_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for every app at once: one job instead of one per app."""
    return quality_summary(_graded(spark, sf_dir), ["client_identification", "service_id"], REQUIRED,
                           type_issue="untyped", by=["app_reference"])


def _runs(spark: SparkSession, sf_dir: str, layer: Column | str, by: list[str]) -> DataFrame:
    """A metrics record per group; a run takes ten milliseconds per row."""
    summary = quality_summary(_graded(spark, sf_dir), ["client_identification", "service_id"],
                              REQUIRED, type_issue="untyped", by=by)
    started = F.to_timestamp(F.lit("2024-02-10 06:00:00"))
    ended = F.timestamp_micros(F.unix_micros(started) + F.col("total_records") * 10000)
    owner = {**owner_of("reviews", "lake", "", "raw"), "layer_lake": layer}
    return run_metrics(summary, owner, F.col("app_reference"), started, ended)


RUNS_SQL = f"""
{a.INTERNAL_SQL}, runs AS (
    SELECT *, (duplicate_count = 0)::INTEGER + (null_count = 0)::INTEGER
              + (type_count = 0)::INTEGER AS success_count
    FROM ({summary_sql('feedback', 'client_identification, service_id', 'app_reference, date_load')})
)"""


@checked("run_metrics", f"""
WITH {RUNS_SQL.replace('app_reference, date_load', 'app_reference')}
SELECT 'bronze' AS layer_lake, app_reference AS app_id, total_records, valid_count, valid_percentage,
       invalid_count, invalid_percentage, duplicate_count, duplicate_count = 0 AS duplicate_ok,
       null_count, null_count = 0 AS null_ok, type_count, type_count = 0 AS type_ok, success_count,
       3 - success_count AS error_count,
       (total_records // 100) || '.' || lpad(CAST(total_records % 100 AS VARCHAR), 2, '0') || ' s'
           AS total_processing_time,
       '2024-02-10 06:00:00' AS run_start_ts
FROM runs""")
def run_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = F.col("validation_results")
    return _runs(spark, sf_dir, "bronze", ["app_reference"]).select(
        "owner.layer_lake", "app_id", "total_records",
        F.col("valid_data.count").alias("valid_count"),
        F.col("valid_data.percentage").alias("valid_percentage"),
        F.col("invalid_data.count").alias("invalid_count"),
        F.col("invalid_data.percentage").alias("invalid_percentage"),
        checks["duplicate_check"]["count"].alias("duplicate_count"),
        checks["duplicate_check"]["status"].alias("duplicate_ok"),
        checks["null_check"]["count"].alias("null_count"),
        checks["null_check"]["status"].alias("null_ok"),
        checks["type_consistency_check"]["count"].alias("type_count"),
        checks["type_consistency_check"]["status"].alias("type_ok"),
        "success_count", "error_count", "total_processing_time", "_ts.run_start_ts",
    )


@checked("metrics_json", f"""
WITH {RUNS_SQL.replace('app_reference, date_load', 'app_reference')}
SELECT 'bronze' AS layer_lake, app_reference AS app_id, 3 - success_count AS error_count,
       CAST(total_records AS VARCHAR) AS total_records,
       CAST(duplicate_count AS VARCHAR) AS duplicate_count,
       CAST(null_count = 0 AS VARCHAR) AS null_ok,
       'raw' AS layer_source, CAST(NULL AS VARCHAR) AS main_check
FROM runs""")
def metrics_json_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records appended to a metrics table and read as JSON, some fields picked out again."""
    path = scratch_dir(spark, "metrics")
    append_metrics(_runs(spark, sf_dir, "bronze", ["app_reference"]), path)
    payload = metrics_payload(spark.read.parquet(path))

    def field(path: str, name: str) -> Column:
        return F.get_json_object("payload", f"$.{path}").alias(name)

    return payload.select(
        "layer_lake", "app_id", "error_count",
        field("total_records", "total_records"),
        field("validation_results.duplicate_check.count", "duplicate_count"),
        field("validation_results.null_check.status", "null_ok"),
        field("owner.layer_source", "layer_source"),
        field("validation_results.main_check", "main_check"),
    )


@checked("output_check_metrics", f"""
WITH {a.UNIFIED_SQL},
rated AS (SELECT * FROM unified WHERE review_rating BETWEEN 1 AND 5), kpis AS ({a.kpi_sql('rated')}),
apps AS (SELECT DISTINCT app_reference FROM unified)
SELECT 'gold' AS layer_lake, app_reference AS app_id, count(k.review_month) AS total_records,
       count(k.review_month) AS valid_count,
       CASE WHEN count(k.review_month) > 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END
           AS valid_percentage,
       CAST(0 AS BIGINT) AS invalid_count, count(k.review_month) > 0 AS status,
       CASE WHEN count(k.review_month) > 0 THEN 'Dados agregados com sucesso.'
            ELSE 'Nenhum registro a ser gravado.' END AS message,
       (count(k.review_month) > 0)::INTEGER AS success_count,
       (count(k.review_month) = 0)::INTEGER AS error_count
FROM apps LEFT JOIN (SELECT * FROM kpis WHERE segment = 'PF') k USING (app_reference)
GROUP BY app_reference""")
def output_check_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per app over its indicators; external apps have none for private clients."""
    reviews = unified(spark, sf_dir)
    kpis = review_kpis(prepare_for_kpis(filter_rating(reviews))).filter(F.col("segment") == "PF")
    found = kpis.groupBy("app_reference").agg(F.count("*").alias("n")).unionByName(
        reviews.groupBy("app_reference").agg(F.lit(0).cast("bigint").alias("n")))
    totals = found.groupBy("app_reference").agg(F.sum("n").alias("total_records"))
    started = F.to_timestamp(F.lit("2024-02-10 06:00:00"))
    records = output_check_metrics(totals, owner_of("reviews", "lake", "gold", "silver"),
                                   F.col("app_reference"), started, started)
    check = F.col("validation_results.main_check")
    return records.select(
        "owner.layer_lake", "app_id", "total_records",
        F.col("valid_data.count").alias("valid_count"),
        F.col("valid_data.percentage").alias("valid_percentage"),
        F.col("invalid_data.count").alias("invalid_count"),
        check["status"].alias("status"), check["message"].alias("message"),
        "success_count", "error_count",
    )


@checked("metrics_fold", """
WITH runs AS (SELECT DISTINCT o_custkey % 50 AS run FROM orders)
SELECT CAST(run AS INT) AS run, CAST(run % 3 AS INT) AS day, 3::BIGINT AS folders, count(*) OVER () AS folded FROM runs""")
def metrics_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of fifty runs over three days, folded into a folder a day: none is lost, none is there twice."""
    path = scratch_dir(spark, "metrics-fold")
    run = (F.col("o_custkey") % 50).cast("int")
    runs = table(spark, sf_dir, "orders").select(run.alias("run")).distinct()
    named = F.concat(F.lit("run-"), F.col("run").cast("string"))
    records = runs.withColumns({"day": (F.col("run") % 3).cast("int"), "run_id": named, "run_batch": named,
                                "run_day": F.concat(F.lit("2024-02-1"), (F.col("run") % 3).cast("string"))})
    records.write.partitionBy("run_batch").parquet(path)
    folded = sum(fold_metrics(spark, path, f"2024-02-1{day}") for day in range(3))
    folders = [n for n in filesystem.child_names(spark, path) if "=" in n]
    return read_metrics(spark, path).select("run", "day", F.lit(len(folders)).cast("long").alias("folders"),
                                            F.lit(folded).cast("long").alias("folded"))


@checked("ops_dashboard", f"""
WITH {RUNS_SQL}
SELECT CASE app_reference WHEN 'app_0' THEN 'gold' WHEN 'app_1' THEN 'silver' ELSE 'bronze' END
           AS layer_lake,
       count(*) AS runs, count(*) FILTER (success_count = 3) AS runs_passed,
       count(*) FILTER (success_count < 3) AS runs_failed,
       CAST(sum(null_count) AS BIGINT) AS null_total,
       CAST(sum(type_count) AS BIGINT) AS inconsistent_total,
       CAST(sum(duplicate_count) AS BIGINT) AS duplicate_total,
       CAST({a.half_up_sql('CAST(sum(total_records) AS BIGINT)', '100 * count(*)', 6)} AS DOUBLE)
           AS mean_processing_seconds
FROM runs GROUP BY 1""")
def ops_dashboard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per app and day; two apps stand for the later layers."""
    app = F.col("app_reference")
    layer = F.when(app == "app_0", "gold").when(app == "app_1", "silver").otherwise("bronze")
    return operations_dashboard(_runs(spark, sf_dir, layer, ["app_reference", "date_load"]))


@checked("gold_review_kpis", f"""
WITH {a.UNIFIED_SQL},
rated AS (SELECT * FROM unified WHERE review_rating BETWEEN 1 AND 5) {a.kpi_sql('rated')}""")
def gold_review_kpis_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicators straight from both sources."""
    return review_kpis(prepare_for_kpis(filter_rating(unified(spark, sf_dir))))


@checked("gold_sentiment_kpis", f"""
WITH {a.UNIFIED_SQL}, rated AS (SELECT * FROM unified WHERE review_rating BETWEEN 1 AND 5)
SELECT strftime(review_date, '%Y%m') AS review_month, service_type, app_reference,
       count(*) AS total_reviews, count(*) FILTER (review_rating >= 4) AS positive_reviews,
       count(*) FILTER (review_rating <= 2) AS negative_reviews,
       count(*) FILTER (review_rating = 3) AS neutral_reviews,
       CAST({a.half_up_sql('CAST(sum(review_rating) AS BIGINT)', 'count(*)', 1)} AS DOUBLE)
           AS avg_rating,
       CAST({a.half_up_sql(
           '(count(*) FILTER (review_rating >= 4) - count(*) FILTER (review_rating <= 2))',
           'count(*)', 2)} AS DOUBLE) AS sentiment_score
FROM rated GROUP BY ALL""")
def gold_sentiment_kpis_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment_kpis(filter_rating(unified(spark, sf_dir)))


SILVER_SQL = ",".join([
    a.UNIFIED_SQL, a.deduplicated_sql("unified", "kept"),
    "rated AS (SELECT * FROM kept WHERE review_rating BETWEEN 1 AND 5)",
    a.cleaned_sql("rated", "silver", "202402"),
])


@checked("silver_reviews", f"WITH {SILVER_SQL} {stamped_sql('silver')}")
def silver_reviews_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole silver flow without its write."""
    return stamped(silver_rows(a.external_reviews(spark, sf_dir), a.internal_reviews(spark, sf_dir),
                               a.SILVER_FLOW, a.RUN_DAY))
