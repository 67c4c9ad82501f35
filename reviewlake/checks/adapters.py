"""The test tables in the shape of review sources, once for Spark and once for the SQL twins.

``orders`` plays the app-store reviews and ``events`` the internal feedback. Both versions use
integer arithmetic and text only, so they agree to the last byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.checks.registry import table
from reviewlake.config import ColumnSpec, FlowConfig, Rule

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def stamp(name: str) -> Column:
    """A timestamp as text, so that both engines print it alike."""
    return F.date_format(F.col(name), STAMP).alias(name)


def sql_stamp(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def external_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` in the layout of the external bronze table; load days are year starts."""
    orders = table(spark, sf_dir, "orders")
    key, made = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    return orders.select(
        _text("https://reviews.example/u/", F.col("o_custkey")).alias("author_ura"),
        F.col("o_custkey").cast("string").alias("author_name"),
        F.lit(None).cast("string").alias("author_label"),
        _text(F.date_format(made, "yyyy-MM-dd'T'HH:mm:ss"), "-03:00").alias("updated_at"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("rating"),
        F.when(key % 13 != 0, _text("1.", key % 5)).alias("version"),
        key.cast("string").alias("review_id"),
        F.when(key % 7 != 0, _text("Opinião ★ ", F.col("o_orderpriority"))).alias("title"),
        F.when(key % 17 != 0, _text(" ", F.col("o_orderpriority"), " – avaliação nº ", key, " 👍 "))
        .alias("content"),
        F.lit("text").alias("content_type_attribute"),
        F.lit("related").alias("link_rel"),
        _text("https://reviews.example/r/", key).alias("link_href"),
        (key % 10).cast("int").alias("vote_sum"),
        F.lit("Application").alias("content_term"),
        F.lit("Aplicativo").alias("content_label"),
        (key % 20).cast("int").alias("vote_count"),
        (made + F.expr("INTERVAL 30 HOURS")).alias("ingestion_ts"),
        F.date_format(F.date_trunc("year", made), "yyyy-MM-dd").alias("date_load"),
        F.lower("o_orderstatus").alias("app_reference"),
    )


EXTERNAL_SQL = """
ext AS (
    SELECT 'https://reviews.example/u/' || o_custkey AS author_ura,
           CAST(o_custkey AS VARCHAR) AS author_name,
           CAST(NULL AS VARCHAR) AS author_label,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-03:00' AS updated_at,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rating,
           CASE WHEN o_orderkey % 13 <> 0 THEN '1.' || (o_orderkey % 5) END AS version,
           CAST(o_orderkey AS VARCHAR) AS review_id,
           CASE WHEN o_orderkey % 7 <> 0 THEN 'Opinião ★ ' || o_orderpriority END AS title,
           CASE WHEN o_orderkey % 17 <> 0
                THEN ' ' || o_orderpriority || ' – avaliação nº ' || o_orderkey || ' 👍 ' END
               AS content,
           'text' AS content_type_attribute,
           'related' AS link_rel,
           'https://reviews.example/r/' || o_orderkey AS link_href,
           CAST(o_orderkey % 10 AS INTEGER) AS vote_sum,
           'Application' AS content_term,
           'Aplicativo' AS content_label,
           CAST(o_orderkey % 20 AS INTEGER) AS vote_count,
           o_orderdate + INTERVAL 30 HOUR AS ingestion_ts,
           strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS date_load,
           lower(o_orderstatus) AS app_reference,
           o_orderdate + INTERVAL 3 HOUR AS updated_utc
    FROM orders
)"""


def internal_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as feedback documents: the client is a nested struct, ``_id`` the storage id."""
    events = table(spark, sf_dir, "events")
    key, user = F.col("event_id"), F.col("user_id")
    service = (
        F.when(F.col("event_type") == "click", "cartão de crédito")
        .when(F.col("event_type") == "view", " empréstimo  pessoal ")
        .when(F.col("event_type") == "error", "conta\tcorrente")
        .when(F.col("event_type") == "purchase", "seguro")
    )
    channel = (
        F.when(key % 4 == 0, "website").when(key % 4 == 1, "mobile_app")
        .when(key % 4 == 2, "agência ").otherwise("call_center")
    )
    number = _text(
        F.lpad(user.cast("string"), 6, "0"), ".", F.lpad((user * 7 % 1000).cast("string"), 3, "0"),
        "/0001-", F.lpad((user % 100).cast("string"), 2, "0"),
    )
    return events.select(
        key.alias("_id"),
        F.col("ts").cast("timestamp").alias("submission_date"),
        F.struct(
            F.when(user % 2 == 0, "pf").otherwise("pj").alias("segment"),
            F.when(key % 97 != 0, number).alias("identification"),
            F.when(user % 3 == 0, "Médio").otherwise("Sênior").alias("classification"),
        ).alias("client"),
        F.when(key % 8 != 7, (key % 8).cast("int")).alias("feedback_rating"),
        F.when(key % 11 == 0, "").when(key % 11 == 1, None).when(key % 11 == 2, "   ")
        .otherwise(_text("O serviço não funcionou 👎 por $", key, " + ç"))
        .alias("feedback_comment"),
        service.alias("service_type"),
        _text("PROD-", key % 900 + 100).alias("service_id"),
        F.col("event_type").alias("service_feedback"),
        channel.alias("source_channel"),
        F.when(key % 9 != 0, _text(key % 5 + 1, ".", key % 11, ".0")).alias("source_id"),
        _text("app_", user % 7).alias("app_reference"),
        F.when(key % 10 != 0, F.col("props")).alias("source_user_agent"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_load"),
    )


def internal_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in the layout of the internal bronze table."""
    documents = internal_documents(spark, sf_dir)
    return documents.select(
        "submission_date",
        F.col("client.segment").alias("client_segment"),
        F.col("client.identification").alias("client_identification"),
        F.col("client.classification").alias("client_classification"),
        "feedback_rating", "feedback_comment", "service_type", "service_id", "service_feedback",
        "source_channel", "source_id", "app_reference", "source_user_agent",
        (F.col("submission_date") + F.expr("INTERVAL 30 HOURS")).alias("ingestion_ts"),
        "date_load",
    )


INTERNAL_SQL = """
feedback AS (
    SELECT ts AS submission_date,
           CASE WHEN user_id % 2 = 0 THEN 'pf' ELSE 'pj' END AS client_segment,
           CASE WHEN event_id % 97 <> 0 THEN
               lpad(CAST(user_id AS VARCHAR), 6, '0') || '.'
               || lpad(CAST(user_id * 7 % 1000 AS VARCHAR), 3, '0') || '/0001-'
               || lpad(CAST(user_id % 100 AS VARCHAR), 2, '0') END AS client_identification,
           CASE WHEN user_id % 3 = 0 THEN 'Médio' ELSE 'Sênior' END AS client_classification,
           CASE WHEN event_id % 8 <> 7 THEN CAST(event_id % 8 AS INTEGER) END AS feedback_rating,
           CASE event_id % 11 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '   '
               ELSE 'O serviço não funcionou 👎 por $' || event_id || ' + ç' END AS feedback_comment,
           CASE event_type WHEN 'click' THEN 'cartão de crédito'
                           WHEN 'view' THEN ' empréstimo  pessoal '
                           WHEN 'error' THEN 'conta' || chr(9) || 'corrente'
                           WHEN 'purchase' THEN 'seguro' END AS service_type,
           'PROD-' || (event_id % 900 + 100) AS service_id,
           event_type AS service_feedback,
           CASE event_id % 4 WHEN 0 THEN 'website' WHEN 1 THEN 'mobile_app'
                             WHEN 2 THEN 'agência ' ELSE 'call_center' END AS source_channel,
           CASE WHEN event_id % 9 <> 0
                THEN (event_id % 5 + 1) || '.' || (event_id % 11) || '.0' END AS source_id,
           'app_' || (user_id % 7) AS app_reference,
           CASE WHEN event_id % 10 <> 0 THEN props END AS source_user_agent,
           ts + INTERVAL 30 HOUR AS ingestion_ts,
           strftime(ts, '%Y-%m-%d') AS date_load
    FROM events
)"""

UNIFIED_EXTERNAL_SQL = """
unified_ext AS (
    SELECT sha256(review_id) AS review_id, author_name AS client_id, updated_utc AS review_date,
           rating AS review_rating, coalesce(title, 'NAO_IDENTIFICADO') AS review_title,
           coalesce(content, 'NAO_INFORMADO') AS review_text,
           coalesce(version, '1.0.0') AS review_version, 'external' AS source_channel,
           'apple_reviews' AS source_system, 'NA' AS segment, 'NA' AS service_type,
           'Itunes' AS source_agent, ingestion_ts, date_load, 'REVIEWS' AS user_agent,
           upper(app_reference) AS app_reference
    FROM ext
)"""

UNIFIED_INTERNAL_SQL = """
unified_int AS (
    SELECT sha256(concat_ws(':', client_identification, app_reference)) AS review_id,
           client_identification AS client_id, submission_date AS review_date,
           coalesce(feedback_rating, 0) AS review_rating, 'NAO_IDENTIFICADO' AS review_title,
           CASE WHEN coalesce(feedback_comment, '') = '' THEN 'NAO_INFORMADO'
                ELSE feedback_comment END AS review_text,
           coalesce(source_id, '1.0.0') AS review_version, source_channel,
           'internaldb_reviews' AS source_system, upper(client_segment) AS segment,
           coalesce(service_type, 'NA') AS service_type,
           coalesce(source_user_agent, 'NAO_INFORMADO') AS source_agent, ingestion_ts, date_load,
           'REVIEWS' AS user_agent, upper(app_reference) AS app_reference
    FROM feedback
)"""

UNIFIED_SQL = ",".join([
    EXTERNAL_SQL, INTERNAL_SQL, UNIFIED_EXTERNAL_SQL, UNIFIED_INTERNAL_SQL,
    """
unified AS (
    SELECT * FROM unified_ext UNION ALL BY NAME SELECT * FROM unified_int
)""",
])

SURVIVOR_SQL = ", ".join(f"{name} DESC NULLS LAST" for name in (
    "review_date", "date_load", "ingestion_ts", "review_rating", "review_text", "review_title",
    "review_version", "source_channel", "segment", "service_type", "source_agent", "user_agent"))


def deduplicated_sql(source: str, target: str) -> str:
    return f"""
{target} AS (
    SELECT * EXCLUDE (rank_) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY review_id, client_id, source_system, app_reference
            ORDER BY {SURVIVOR_SQL}) AS rank_
        FROM {source})
    WHERE rank_ = 1
)"""


# Fixed values, as in functions.text.
ACCENTS = ("ÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇáàãâäéèêëíìîïóòõôöúùûüç",
           "AAAAAEEEEIIIIOOOOOUUUUCaaaaaeeeeiiiiooooouuuuc")
SHIFTED = "AAAAAEEEEIIIIOOOOOUUUUCaaaaaeeeeiiiiiooooouuuuc"


def folded_sql(text: str) -> str:
    return f"translate({text}, '{ACCENTS[0]}', '{ACCENTS[1]}')"


def upper_sql(text: str) -> str:
    """DuckDB writes the capital of ß as one letter, Spark as two."""
    return f"replace(upper({text}), 'ẞ', 'SS')"


def tidy_sql(text: str) -> str:
    return upper_sql(f"trim({text})")


def stripped_sql(text: str) -> str:
    return rf"regexp_replace({text}, '[^\p{{L}}\p{{N}}\s\p{{P}}]', '', 'g')"


def text_sql(text: str) -> str:
    return tidy_sql(stripped_sql(folded_sql(text)))


def identifier_sql(text: str) -> str:
    return tidy_sql(rf"regexp_replace({text}, '[./\-\s]', '', 'g')")


def category_sql(text: str) -> str:
    return tidy_sql(rf"regexp_replace({text}, '\s+', '_', 'g')")


def cleaned_sql(source: str, target: str, month: str | None = None) -> str:
    date_load = f"'{month}' AS date_load" if month else "date_load"
    return f"""
{target} AS (
    SELECT review_id, {identifier_sql(folded_sql('client_id'))} AS client_id, review_date,
           review_rating, {text_sql('review_title')} AS review_title,
           {text_sql('review_text')} AS review_text, review_version,
           {tidy_sql(folded_sql('source_channel'))} AS source_channel,
           {tidy_sql(folded_sql('source_system'))} AS source_system, segment,
           {category_sql(folded_sql('service_type'))} AS service_type, source_agent, ingestion_ts,
           user_agent, app_reference, {date_load}
    FROM {source}
)"""


def half_up_sql(numerator: str, denominator: str, digits: int) -> str:
    """A ratio rounded half away from zero, in whole numbers, as a double."""
    scale = 10 ** digits
    return (f"(sign({numerator}) * ((2 * {scale} * abs({numerator}) + ({denominator}))"
            f" // (2 * ({denominator}))) / {scale}.0)")


def kpi_sql(source: str) -> str:
    score = "(count(*) FILTER (review_rating = 5) - count(*) FILTER (review_rating <= 3))"
    return f"""
SELECT strftime(review_date, '%Y') AS review_year, strftime(review_date, '%m') AS review_month,
       review_version, segment, service_type, app_reference, count(*) AS review_count,
       CAST({half_up_sql('CAST(sum(review_rating) AS BIGINT)', 'count(*)', 1)} AS DOUBLE)
           AS average_rating,
       CAST(min(review_rating) AS DOUBLE) AS min_rating,
       CAST(max(review_rating) AS DOUBLE) AS max_rating,
       CAST({half_up_sql(score, 'count(*)', 2)} AS DOUBLE) AS nps_score
FROM {source} WHERE review_date IS NOT NULL AND review_rating IS NOT NULL
GROUP BY ALL"""


RUN_DAY = "2024-02-10"

# Configurations of the flows over the adapters.
EXTERNAL_FLOW = FlowConfig(
    target_table="external_reviews",
    version=1.1,
    expected=tuple(ColumnSpec(name) for name in (
        "author_uri", "author_name", "author_label", "updated_at", "rating", "version", "review_id",
        "title", "content", "content_type_attribute", "link_rel", "link_href", "vote_sum",
        "content_term", "content_label", "vote_count")),
    target=(
        *[ColumnSpec(name) for name in (
            "author_ura", "author_name", "author_label", "updated_at")],
        ColumnSpec("rating", "INT"), ColumnSpec("version"), ColumnSpec("review_id", is_pk=True),
        *[ColumnSpec(name) for name in (
            "title", "content", "content_type_attribute", "link_rel", "link_href")],
        ColumnSpec("vote_sum", "INT"), ColumnSpec("content_term"), ColumnSpec("content_label"),
        ColumnSpec("vote_count", "INT"), ColumnSpec("app_reference"),
        ColumnSpec("ingestion_ts", "TIMESTAMP"), ColumnSpec("date_load"),
    ),
    mapping={"author_ura": "author_uri"},
    rules=(Rule("not_empty", "true", "title"),),
    source={"format": "json", "directory": "feed/reviews"},
    sink={"format": "parquet", "mode": "overwrite", "partitionBy": "date_load"},
)

INTERNAL_FLOW = FlowConfig(
    target_table="internal_reviews",
    version=1.1,
    expected=(
        ColumnSpec("submission_date", "TIMESTAMP"),
        *[ColumnSpec(f"client.{part}") for part in ("segment", "identification", "classification")],
        ColumnSpec("feedback_rating", "INT"),
        *[ColumnSpec(name) for name in (
            "feedback_comment", "service_type", "service_id", "source_channel", "service_feedback",
            "source_id", "app_reference", "source_user_agent")],
    ),
    target=(
        ColumnSpec("submission_date", "TIMESTAMP"),
        ColumnSpec("client_identification", is_pk=True), ColumnSpec("client_segment"),
        ColumnSpec("client_classification"), ColumnSpec("feedback_rating", "INT"),
        *[ColumnSpec(name, is_pk=name == "app_reference") for name in (
            "feedback_comment", "service_type", "service_id", "source_channel", "service_feedback",
            "app_reference", "source_id", "source_user_agent")],
        ColumnSpec("ingestion_ts", "TIMESTAMP"), ColumnSpec("date_load"),
    ),
    mapping={f"client_{part}": f"client.{part}"
             for part in ("identification", "segment", "classification")},
    rules=(Rule("not_empty", "true", "feedback_comment"), Rule("evolution_mergeschema", "false")),
    source={"format": "json", "directory": "internal/reviews/"},
    sink={"format": "parquet", "mode": "append", "partitionBy": "date_load"},
    fallback={"create_empty_if_missing": "true"},
)

SILVER_FLOW = FlowConfig(
    target_table="unified_reviews",
    source_layer="bronze",
    target=(ColumnSpec("review_id", is_pk=True), ColumnSpec("client_id", is_pk=True),
            ColumnSpec("source_system", is_pk=True), ColumnSpec("app_reference", is_pk=True)),
    rules=(Rule("min_value", "1"), Rule("max_value", "5"), Rule("days_back", "all")),
)

GOLD_FLOW = FlowConfig(target_table="review_kpis", source_layer="silver")
