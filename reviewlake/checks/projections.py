"""Queries on projections, filters and text cleaning."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.checks import adapters as a
from reviewlake.checks.registry import checked, table
from reviewlake.config import ColumnSpec
from reviewlake.functions import (
    anonymize,
    clean_category,
    clean_identifier,
    clean_text,
    fold_accents,
    strip_symbols,
)
from reviewlake.operators import (
    app_reference_column,
    filter_rating,
    map_columns,
    prepare_for_kpis,
    unify_external,
    unify_internal,
    union_sources,
    with_control_columns,
)
from reviewlake.operators.unify import UNIFIED_COLUMNS

ORDER_TARGET = (
    ColumnSpec("order_id", "BIGINT"), ColumnSpec("priority_rank", "INT"),
    ColumnSpec("amount", "DECIMAL(12,2)"), ColumnSpec("ordered_at", "TIMESTAMP"),
    ColumnSpec("status", "STRING"), ColumnSpec("ingestion_ts", "TIMESTAMP"),
)


@checked("map_columns", """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL
            ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS priority_rank,
       o_orderkey || '.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS amount,
       CASE WHEN o_orderkey % 6 <> 0
            THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') END AS ordered_at,
       o_orderstatus AS status,
       o_orderkey % 4 = 0 OR o_orderkey % 6 = 0 AS is_type_issue
FROM orders""")
def map_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns renamed and typed; unreadable values become NULL and mark their row."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    raw = orders.select(
        key.cast("string").alias("order_id"),
        F.when(key % 4 == 0, F.col("o_orderpriority"))
        .otherwise(F.substring("o_orderpriority", 1, 1)).alias("o_priority"),
        F.concat(key.cast("string"), F.lit("."), F.lpad((key % 100).cast("string"), 2, "0"))
        .alias("amount"),
        F.when(key % 6 == 0, "not a time")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("o_date"),
        F.col("o_orderstatus").alias("status"),
    )
    mapped = map_columns(raw, ORDER_TARGET, {"priority_rank": "o_priority", "ordered_at": "o_date"},
                         type_issue="is_type_issue")
    return mapped.withColumns({"ordered_at": a.stamp("ordered_at"),
                               "amount": F.col("amount").cast("string")})


@checked("map_columns_safe", f"""
WITH {a.INTERNAL_SQL}
SELECT client_segment, client_identification, CAST(NULL AS VARCHAR) AS client_region, service_id,
       CAST(NULL AS INTEGER) AS helpful_votes, feedback_rating
FROM feedback""")
def map_columns_safe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested sources, and sources that do not exist."""
    target = [ColumnSpec(name) for name in
              ("client_segment", "client_identification", "client_region", "service_id")]
    target += [ColumnSpec("helpful_votes", "INT"), ColumnSpec("feedback_rating", "INT")]
    mapping = {"client_segment": "client.segment", "client_region": "client.region",
               "client_identification": "client.identification", "helpful_votes": "votes.helpful"}
    return map_columns(a.internal_documents(spark, sf_dir), target, mapping, missing="null")


@checked("flatten_client", f"""
WITH {a.INTERNAL_SQL}
SELECT client_segment, client_identification, client_classification, feedback_comment
FROM feedback""")
def flatten_client_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = [ColumnSpec(name) for name in ("client_segment", "client_identification",
                                            "client_classification", "feedback_comment")]
    return map_columns(a.internal_documents(spark, sf_dir), target, a.INTERNAL_FLOW.mapping)


@checked("app_reference_fallback", """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'na' WHEN 1 THEN lower(o_orderstatus)
                       ELSE '' END AS from_row, 'my_app' AS from_run
FROM orders""")
def app_reference_fallback_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    reviews = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 3 == 1, F.concat(F.lit("  "), F.col("o_orderstatus"), F.lit(" ")))
        .when(key % 3 == 2, "   ").alias("app_reference"),
    )
    return reviews.select(
        "o_orderkey",
        app_reference_column(reviews.schema, "  ").alias("from_row"),
        app_reference_column(reviews.schema, " My_App ").alias("from_run"),
    )


@checked("control_columns", """
SELECT o_orderkey, '2024-02-10 06:30:00.000000' AS ingestion_ts, '2024-02-10' AS date_load
FROM orders""")
def control_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_control_columns(table(spark, sf_dir, "orders").select("o_orderkey"), a.RUN_DAY,
                                datetime(2024, 2, 10, 6, 30, tzinfo=timezone.utc))
    return rows.withColumn("ingestion_ts", a.stamp("ingestion_ts"))


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumns({name: a.stamp(name) for name in ("review_date", "ingestion_ts")})


def stamped_sql(source: str) -> str:
    columns = [a.sql_stamp(name) if name in ("review_date", "ingestion_ts") else name
               for name in UNIFIED_COLUMNS]
    return f"SELECT {', '.join(columns)} FROM {source}"


@checked("unify_external", f"WITH {a.UNIFIED_SQL} {stamped_sql('unified_ext')}")
def unify_external_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamped(unify_external(a.external_reviews(spark, sf_dir)))


@checked("unify_internal", f"WITH {a.UNIFIED_SQL} {stamped_sql('unified_int')}")
def unify_internal_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamped(unify_internal(a.internal_reviews(spark, sf_dir)))


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_sources(unify_external(a.external_reviews(spark, sf_dir)),
                         unify_internal(a.internal_reviews(spark, sf_dir)))


@checked("union_sources", f"""
WITH {a.EXTERNAL_SQL}, {a.INTERNAL_SQL}
SELECT app_reference, date_load, review_id, rating, feedback_rating, service_id FROM (
    SELECT app_reference, date_load, review_id, rating FROM ext
    UNION ALL BY NAME
    SELECT date_load, app_reference, feedback_rating, service_id FROM feedback)""")
def union_sources_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that share some columns only."""
    return union_sources(
        a.external_reviews(spark, sf_dir).select("app_reference", "date_load", "review_id", "rating"),
        a.internal_reviews(spark, sf_dir)
        .select("date_load", "app_reference", "feedback_rating", "service_id"),
    )


@checked("filter_rating", f"""
WITH {a.UNIFIED_SQL} {stamped_sql('unified WHERE review_rating BETWEEN 1 AND 5')}""")
def filter_rating_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamped(filter_rating(unified(spark, sf_dir)))


@checked("gold_prepare", f"""
WITH {a.UNIFIED_SQL}
SELECT {a.sql_stamp('review_date')}, review_rating, review_version, segment, service_type,
       app_reference, strftime(review_date, '%Y') AS review_year,
       strftime(review_date, '%m') AS review_month
FROM unified WHERE review_date IS NOT NULL AND review_rating IS NOT NULL""")
def gold_prepare_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = prepare_for_kpis(unified(spark, sf_dir))
    return prepared.withColumn("review_date", a.stamp("review_date"))


@checked("fold_accents", f"SELECT doc_id, {a.folded_sql('text')} AS folded FROM documents")
def fold_accents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", fold_accents(F.col("text")).alias("folded"))


@checked("fold_accents_legacy", f"""
SELECT doc_id, translate(text, '{a.ACCENTS[0]}', '{a.SHIFTED}') AS folded FROM documents""")
def fold_accents_legacy_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", fold_accents(F.col("text"), legacy_map=True).alias("folded"))


@checked("strip_symbols", f"SELECT doc_id, {a.stripped_sql('text')} AS stripped FROM documents")
def strip_symbols_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", strip_symbols(F.col("text")).alias("stripped"))


@checked("clean_text", f"SELECT doc_id, {a.text_sql('text')} AS cleaned FROM documents")
def clean_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", clean_text(F.col("text")).alias("cleaned"))


@checked("clean_client_id", f"""
WITH {a.INTERNAL_SQL}
SELECT client_identification, {a.identifier_sql('client_identification')} AS client_id
FROM feedback""")
def clean_client_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.internal_reviews(spark, sf_dir).select(
        "client_identification",
        clean_identifier(F.col("client_identification")).alias("client_id"))


@checked("clean_service_type", f"""
WITH {a.INTERNAL_SQL}
SELECT service_type AS raw, {a.category_sql('service_type')} AS service_type FROM feedback""")
def clean_service_type_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.internal_reviews(spark, sf_dir).select(
        F.col("service_type").alias("raw"),
        clean_category(F.col("service_type")).alias("service_type"))


@checked("anonymize_client", f"""
WITH {a.INTERNAL_SQL}
SELECT app_reference, sha256(client_identification) AS client_id,
       sha256('pepper' || client_identification) AS salted_client_id
FROM feedback""")
def anonymize_client_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    client = F.col("client_identification")
    return a.internal_reviews(spark, sf_dir).select(
        "app_reference", anonymize(client).alias("client_id"),
        anonymize(client, "pepper").alias("salted_client_id"))
