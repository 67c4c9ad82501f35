"""Queries on sources: landing files, feed pages, table scans and the control table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake import filesystem
from reviewlake.checks import adapters as a
from reviewlake.checks.registry import checked, table
from reviewlake.session import scratch_dir
from reviewlake.sinks import export_documents, write_partitions
from reviewlake.sinks.export import TIME_FORMAT
from reviewlake.sources import (
    config_from_documents,
    explode_rules,
    flatten_feed,
    unreadable_pages,
    landing_paths,
    latest_config,
    read_feed_pages,
    read_landing,
    read_partitioned,
    scan_days_back,
    scan_month,
    select_tagged,
    type_config_strings,
)
from reviewlake.sources.feed import FEED_FIELDS

DOCUMENT_COLUMNS = """strftime(submission_date, '%Y-%m-%d %H:%M:%S.%f') AS submission_date,
    client_segment, client_identification, client_classification, feedback_rating,
    feedback_comment, service_type, service_id, service_feedback, source_channel, source_id,
    app_reference, source_user_agent"""


def _land_documents(spark: SparkSession, sf_dir: str, label: str) -> str:
    """The feedback documents as JSON files in one folder per day."""
    root = scratch_dir(spark, label)
    writer = a.internal_documents(spark, sf_dir).drop("_id").write.partitionBy("date_load")
    writer.option("timestampFormat", TIME_FORMAT).json(root)
    return root


def _flat(documents: DataFrame) -> DataFrame:
    return documents.select(
        a.stamp("submission_date"),
        *[F.col(f"client.{part}").alias(f"client_{part}")
          for part in ("segment", "identification", "classification")],
        "feedback_rating", "feedback_comment", "service_type", "service_id", "service_feedback",
        "source_channel", "source_id", "app_reference", "source_user_agent",
    )


@checked("scan_raw_json", f"WITH {a.INTERNAL_SQL} SELECT {DOCUMENT_COLUMNS} FROM feedback")
def scan_raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day folder under a declared, nested schema."""
    root = _land_documents(spark, sf_dir, "landing-json")
    days = [name for name in filesystem.child_names(spark, root) if "=" in name]
    return _flat(read_landing(spark, "JSON", a.INTERNAL_FLOW.expected_schema,
                              landing_paths(root, days)))


@checked("scan_missing_path", f"WITH {a.INTERNAL_SQL} SELECT {DOCUMENT_COLUMNS} FROM feedback")
def scan_missing_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without a folder add no rows to those that have one, and raise nothing."""
    root = _land_documents(spark, sf_dir, "landing-gaps")
    days = [name for name in filesystem.child_names(spark, root) if "=" in name]
    gaps = ["date_load=1999-12-31", "date_load=2999-01-01"]
    schema = a.INTERNAL_FLOW.expected_schema
    present = read_landing(spark, "json", schema, landing_paths(root, [gaps[0], *days]))
    absent = read_landing(spark, "json", schema, landing_paths(root, gaps, ["nowhere"]))
    return _flat(present.unionByName(absent))


@checked("scan_raw_csv", f"""
SELECT event_id, {a.sql_stamp('ts')}, user_id, event_type, value, props FROM events""")
def scan_raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with a header line, typed by the declared schema."""
    root = scratch_dir(spark, "landing-csv")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    stamps = {"timestampFormat": TIME_FORMAT}
    events.write.options(header="true", **stamps).csv(f"{root}/2024-02-10")
    rows = read_landing(spark, "csv", events.schema, landing_paths(root, "2024-02-10"), stamps)
    return rows.withColumn("ts", a.stamp("ts"))


def feed_entry(columns: dict[str, Column]) -> Column:
    """One feed entry with every value where the feed keeps it."""
    tree: dict = {}
    for name, path in FEED_FIELDS.items():
        *parents, leaf = path.split(".")
        node = tree
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = columns[name]

    def build(node: dict) -> Column:
        return F.struct(*[(build(v) if isinstance(v, dict) else v).alias(k)
                          for k, v in node.items()])

    return build(tree)


FEED_COLUMNS = ("author_uri", "author_name", "author_label", "updated_at", "rating", "version",
                "review_id", "title", "content", "content_type_attribute", "link_rel", "link_href",
                "vote_sum", "content_term", "content_label", "vote_count")


@checked("flatten_feed", f"""
WITH {a.EXTERNAL_SQL}
SELECT author_ura AS author_uri, author_name, author_label, updated_at,
       CAST(rating AS VARCHAR) AS rating, version, review_id, title, content,
       content_type_attribute, link_rel, link_href, CAST(vote_sum AS VARCHAR) AS vote_sum,
       content_term, content_label, CAST(vote_count AS VARCHAR) AS vote_count
FROM ext""")
def flatten_feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of up to 49 reviews, and pages whose only entry is not in an array."""
    reviews = a.external_reviews(spark, sf_dir).withColumnRenamed("author_ura", "author_uri")
    key = F.col("review_id").cast("bigint")
    alone = key % 50 == 49
    entry = feed_entry({name: F.col(name).cast("string") for name in FEED_COLUMNS})
    pages = (
        reviews.groupBy(F.when(alone, -key).otherwise(F.floor(key / 50)).alias("page"))
        .agg(F.collect_list(entry).alias("entries"))
        .select(
            F.when(
                F.size("entries") == 1,
                F.to_json(F.struct(F.struct(F.col("entries")[0].alias("entry")).alias("feed"))),
            ).otherwise(F.to_json(F.struct(F.struct(F.col("entries").alias("entry")).alias("feed"))))
            .alias("value")
        )
    )
    root = scratch_dir(spark, "feed-pages")
    pages.write.text(root)
    return flatten_feed(read_feed_pages(spark, root))


@checked("flatten_feed_corrupt", f"""
WITH {a.EXTERNAL_SQL},
keyed AS (SELECT CAST(review_id AS BIGINT) // 50 AS page FROM ext)
SELECT 'reviews' AS kind, count(*) AS n FROM keyed WHERE page % 3 <> 0
UNION ALL SELECT 'pages', count(DISTINCT page) FROM keyed WHERE page % 3 = 0""")
def flatten_feed_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third page is cut off: its text is set aside, the reviews of the others are read."""
    reviews = a.external_reviews(spark, sf_dir).withColumnRenamed("author_ura", "author_uri")
    entry = feed_entry({name: F.col(name).cast("string") for name in FEED_COLUMNS})
    text = F.to_json(F.struct(F.struct(F.col("entries").alias("entry")).alias("feed")))
    pages = (
        reviews.groupBy(F.floor(F.col("review_id").cast("bigint") / 50).alias("page"))
        .agg(F.collect_list(entry).alias("entries"))
        .select(F.when(F.col("page") % 3 == 0, F.substring(text, 1, 90)).otherwise(text).alias("value"))
    )
    root = scratch_dir(spark, "feed-corrupt")
    pages.write.text(root)
    read = read_feed_pages(spark, root)
    count = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
    return count(flatten_feed(read, "quarantine"), "reviews").union(count(unreadable_pages(read), "pages"))


@checked("export_ndjson", f"""
WITH {a.INTERNAL_SQL}
SELECT {DOCUMENT_COLUMNS}, (SELECT count(*) FROM events) AS exported FROM feedback""")
def export_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written one per line, read back, with the number the export reported."""
    root = scratch_dir(spark, "export")
    count = export_documents(a.internal_documents(spark, sf_dir), root)
    documents = read_landing(spark, "json", a.INTERNAL_FLOW.expected_schema, [root])
    return _flat(documents).withColumn("exported", F.lit(count).cast("bigint"))


@checked("scan_days_back", f"""
WITH {a.EXTERNAL_SQL}
SELECT review_id, rating, date_load FROM ext WHERE date_load >= '1998-08-02'""")
def scan_days_back_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = scan_days_back(a.external_reviews(spark, sf_dir), date(2001, 8, 1), 1095)
    return reviews.select("review_id", "rating", "date_load")


@checked("scan_month", f"""
WITH {a.EXTERNAL_SQL}
SELECT review_id, rating, strftime(o.o_orderdate, '%Y%m') AS date_load
FROM ext JOIN orders o ON review_id = CAST(o.o_orderkey AS VARCHAR)
WHERE strftime(o.o_orderdate, '%Y%m') = '199803'""")
def scan_month_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of a folder partitioned by month; no file of another month is read."""
    months = a.external_reviews(spark, sf_dir).withColumn(
        "date_load", F.regexp_replace(F.substring("updated_at", 1, 7), "-", ""))
    root = scratch_dir(spark, "months")
    write_partitions(months.select("review_id", "rating", "date_load"), root)
    return scan_month(read_partitioned(spark, root, ["date_load"]), "1998-03-17").select("review_id", "rating", "date_load")


@checked("scan_days_pruned", f"""
WITH {a.INTERNAL_SQL.replace('SELECT ts AS', 'SELECT event_id, ts AS')}
SELECT event_id, feedback_rating, date_load FROM feedback WHERE date_load >= '2024-01-21'""")
def scan_days_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last days of a folder partitioned by day; no file of an older day is read."""
    days = a.internal_documents(spark, sf_dir).select(F.col("_id").alias("event_id"), "feedback_rating", "date_load")
    root = scratch_dir(spark, "days")
    write_partitions(days, root)
    return scan_days_back(read_partitioned(spark, root, ["date_load"]), date(2024, 1, 31), 10)


@checked("select_tagged", f"""
WITH {a.EXTERNAL_SQL}
SELECT review_id, rating, content, 'external_reviews' AS source_table, date_load FROM ext""")
def select_tagged_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_tagged(a.external_reviews(spark, sf_dir), ["review_id", "rating", "content"],
                         "external_reviews")


@checked("latest_config", f"""
SELECT source_layer, table_name_target, version, {a.sql_stamp('last_modified')}, revision FROM (
    SELECT o_orderstatus AS source_layer, 'flow_' || o_custkey AS table_name_target,
           CAST(o_orderkey % 50 AS DOUBLE) / 10 AS version, o_orderdate AS last_modified,
           o_orderkey AS revision,
           row_number() OVER (PARTITION BY o_orderstatus, o_custkey
               ORDER BY o_orderkey % 50 DESC, o_orderdate DESC, o_orderkey DESC) AS rank_
    FROM orders)
WHERE rank_ = 1""")
def latest_config_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as versions of flows: the highest version of each flow, ties by time."""
    control = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("source_layer"),
        F.concat(F.lit("flow_"), F.col("o_custkey").cast("string")).alias("table_name_target"),
        ((F.col("o_orderkey") % 50).cast("double") / 10).alias("version"),
        F.col("o_orderdate").cast("timestamp").alias("last_modified"),
        F.col("o_orderkey").alias("revision"),
    )
    newest = latest_config(control, order=("version", "last_modified", "revision"))
    return newest.withColumn("last_modified", a.stamp("last_modified"))


@checked("load_config", """
SELECT CAST(p_size AS DOUBLE) AS version, 'raw' AS source_layer,
       'table_' || p_partkey AS table_name_target,
       'id:BIGINT,client.name:STRING' AS expected, 'id:true,client_name:false' AS target,
       'client.name>client_name' AS mapping,
       'not_empty=true,max_value=' || p_size AS rules,
       'json' AS source_format, lower(p_type) AS source_directory, 'append' AS target_mode,
       'true' AS create_empty, '2024-01-01 00:00:00.000000' AS last_modified
FROM part""")
def load_config_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metadata document per part, parsed into typed control rows."""
    def named(**columns) -> Column:
        return F.struct(*[(c if isinstance(c, Column) else F.lit(c)).alias(n)
                          for n, c in columns.items()])

    size = F.col("p_size").cast("string")
    document = named(flow_config=named(
        metadata=named(version=size, last_modified="2024-01-01T00:00:00Z"),
        data_layers=named(
            source_layer="raw",
            target_table=F.concat(F.lit("table_"), F.col("p_partkey").cast("string"))),
        schemas=named(
            schema_expected=F.array(
                named(name_column="id", type_column="BIGINT", other=""),
                named(name_column="client.name", type_column="STRING", other="")),
            schema_target=F.array(
                named(name_column="id", type_column="BIGINT", is_pk=True),
                named(name_column="client_name", type_column="STRING", is_pk=False))),
        column_mapping=F.array(named(source_column="client.name", target_column="client_name")),
        control_rules=F.array(named(rule="not_empty", value="true"),
                              named(rule="max_value", value=size)),
        configurations=named(
            source_config=named(format="json", directory=F.lower("p_type")),
            target_config=named(mode="append"),
            fallback_config=named(create_empty_if_missing="true")),
    ))
    documents = table(spark, sf_dir, "part").select(F.to_json(document).alias("document"))

    def joined(name: str, left: str, right: str, mark: str) -> Column:
        return F.array_join(F.transform(
            F.col(name), lambda e: F.concat(e[left], F.lit(mark), e[right].cast("string"))), ",")

    return config_from_documents(documents).select(
        "version", "source_layer", "table_name_target",
        joined("schema_expected", "name_column", "type_column", ":").alias("expected"),
        joined("schema_target", "name_column", "is_pk", ":").alias("target"),
        joined("schema_depara", "source_column", "target_column", ">").alias("mapping"),
        joined("rule_control", "rule", "value", "=").alias("rules"),
        F.col("source_config")["format"].alias("source_format"),
        F.col("source_config")["directory"].alias("source_directory"),
        F.col("target_config")["mode"].alias("target_mode"),
        F.col("fallback_config")["create_empty_if_missing"].alias("create_empty"),
        a.stamp("last_modified"),
    )


@checked("load_config_strings", """
SELECT CAST(p_size AS DOUBLE) AS version, 'table_' || p_partkey AS table_name_target,
       'id:BIGINT' AS expected, lower(p_type) AS source_directory, 'json' AS source_format,
       CAST(0 AS INTEGER) AS fallback_settings, '2024-01-01 00:00:00.000000' AS last_modified
FROM part""")
def load_config_strings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows flattened to JSON text, with settings as lists of pairs."""
    directory = F.concat(F.lit('[["format","json"],["directory","'), F.lower("p_type"), F.lit('"]]'))
    flat = table(spark, sf_dir, "part").select(
        F.col("p_size").cast("string").alias("version"),
        F.lit("raw").alias("source_layer"),
        F.concat(F.lit("table_"), F.col("p_partkey").cast("string")).alias("table_name_target"),
        F.lit('[{"name_column":"id","type_column":"BIGINT","other":""}]').alias("schema_expected"),
        *[F.lit("[]").alias(name) for name in ("schema_target", "schema_depara", "rule_control")],
        directory.alias("source_config"),
        *[F.lit("[]").alias(name) for name in ("target_config", "fallback_config")],
        F.lit("2024-01-01").alias("last_modified"),
    )
    first = F.col("schema_expected")[0]
    return type_config_strings(flat).select(
        "version", "table_name_target",
        F.concat(first["name_column"], F.lit(":"), first["type_column"]).alias("expected"),
        F.col("source_config")["directory"].alias("source_directory"),
        F.col("source_config")["format"].alias("source_format"),
        F.size("fallback_config").alias("fallback_settings"),
        a.stamp("last_modified"),
    )


@checked("config_rules", """
SELECT o_orderstatus AS source_layer, 'flow_' || o_orderkey AS table_name_target,
       unnest(['max_value', 'not_empty', 'min_value']) AS rule,
       unnest(['5', CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END,
               CAST(o_orderkey % 3 AS VARCHAR)]) AS value
FROM orders""")
def config_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rules per flow, one of them given twice."""
    key = F.col("o_orderkey")

    def rule(name: str, value: Column | str) -> Column:
        value = value if isinstance(value, Column) else F.lit(value)
        return F.struct(F.lit(name).alias("rule"), value.alias("value"))

    control = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("source_layer"),
        F.concat(F.lit("flow_"), key.cast("string")).alias("table_name_target"),
        F.array(
            rule("min_value", "9"),
            rule("max_value", "5"),
            rule("not_empty", F.when(key % 2 == 0, "true").otherwise("false")),
            rule("min_value", (key % 3).cast("string")),
        ).alias("rule_control"),
    )
    return explode_rules(control)
