"""Queries that write a table, maintain it, and read it back."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake import filesystem
from reviewlake.checks import adapters as a
from reviewlake.checks.projections import stamped, stamped_sql, unified
from reviewlake.checks.registry import checked, table
from reviewlake.operators import filter_rating, prepare_for_kpis, review_kpis
from reviewlake.session import scratch_dir
from reviewlake.sinks import (
    TABLES,
    append_manifest,
    append_metrics,
    compact_table,
    create_table,
    drop_partitions,
    drop_table_partitions,
    insert_partitions,
    list_files,
    new_run_id,
    partition_location,
    purge_loaded,
    retain_days,
    stamp_month,
    write_full,
    write_partitions,
)
from reviewlake.sources import read_partitioned


def scratch_database(spark: SparkSession) -> tuple[str, str]:
    """Name and folder of a database of its own."""
    name = f"lake_{uuid.uuid4().hex[:12]}"
    return name, scratch_dir(spark, name)


def _feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.internal_documents(spark, sf_dir).select(
        F.col("_id").alias("event_id"), "feedback_rating", "service_id", "date_load")


@checked("write_day_partition", f"""
WITH {a.INTERNAL_SQL.replace('SELECT ts AS', 'SELECT event_id, ts AS')}
SELECT event_id, CASE WHEN date_load = '2024-01-10' THEN 5 ELSE feedback_rating END
           AS feedback_rating, service_id, date_load
FROM feedback""")
def write_day_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day is replaced, twice; all others stay."""
    root, rows = scratch_dir(spark, "day-partitions"), _feedback(spark, sf_dir)
    write_partitions(rows, root)
    day = rows.filter(F.col("date_load") == "2024-01-10")
    corrected = day.withColumn("feedback_rating", F.lit(5)).drop("date_load")
    for _ in range(2):
        write_partitions(corrected, root, static={"date_load": "2024-01-10"})
    return read_partitioned(spark, root, ["date_load"])


@checked("insert_counted", """
SELECT count(*) AS "rows", count(*) FILTER (WHERE o_orderkey % 7 <> 0) AS numbers, count(*) FILTER (WHERE o_orderkey % 5 <> 0) AS days,
       count(*) FILTER (WHERE o_orderkey % 7 = 0) AS lost_numbers, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS lost_days,
       true AS refused FROM orders""")
def insert_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that a typed table cannot hold: refused by default, or counted for each column."""
    database, root = scratch_database(spark)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    name = f"{database}.typed"
    spark.sql(f"CREATE TABLE {name} (number INT, day DATE, app STRING) USING parquet PARTITIONED BY (app) LOCATION '{root}/typed'")
    key = F.col("o_orderkey")
    texts = table(spark, sf_dir, "orders").select(
        F.when(key % 7 == 0, F.lit("many")).otherwise((key % 1000).cast("string")).alias("number"),
        F.when(key % 5 == 0, F.lit("someday")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.col("o_orderstatus").alias("app"))
    refused = False
    try:
        insert_partitions(texts, name)
    except PySparkException as error:
        refused = "cannot hold" in str(error) and spark.table(name).isEmpty()
    lost = insert_partitions(texts, name, on_bad="count")["lossy"]
    return spark.table(name).agg(
        F.count("*").alias("rows"), F.count("number").alias("numbers"), F.count("day").alias("days"),
        F.lit(lost["number"]).cast("long").alias("lost_numbers"), F.lit(lost["day"]).cast("long").alias("lost_days"),
        F.lit(refused).alias("refused"))


@checked("write_month_partition", f"""
WITH {a.UNIFIED_SQL},
snapshots AS (
    SELECT * EXCLUDE (date_load), '202401' AS date_load FROM unified_ext
    UNION ALL BY NAME SELECT * EXCLUDE (date_load), '202402' AS date_load FROM unified)
{stamped_sql("snapshots")}""")
def write_month_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two monthly snapshots of the catalog table; the second is written twice."""
    database, root = scratch_database(spark)
    name = create_table(spark, database, "unified_reviews", TABLES["unified_reviews"],
                        f"{root}/unified_reviews")
    both = unified(spark, sf_dir)
    first = both.filter(F.col("source_system") == "apple_reviews")
    for rows, day in ((first, "2024-01-31"), (first, "2024-02-01"), (both, "2024-02-10")):
        insert_partitions(stamp_month(rows, day), name,
                          static={"date_load": day[:7].replace("-", "")})
    return stamped(spark.table(name))


@checked("write_full", f"""
WITH {a.UNIFIED_SQL},
rated AS (SELECT * FROM unified WHERE review_rating BETWEEN 1 AND 5) {a.kpi_sql('rated')}""")
def write_full_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced together with its schema, kept in its folder."""
    database, root = scratch_database(spark)
    name = create_table(spark, database, "review_kpis", TABLES["review_kpis"], f"{root}/review_kpis")
    write_full(table(spark, sf_dir, "nation"), name)
    write_full(review_kpis(prepare_for_kpis(filter_rating(unified(spark, sf_dir)))), name)
    return spark.table(name)


@checked("write_skip_empty", f"""
WITH {a.INTERNAL_SQL.replace('SELECT ts AS', 'SELECT event_id, ts AS')}
SELECT event_id, feedback_rating, service_id, date_load FROM feedback""")
def write_skip_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty input changes neither a partitioned folder nor a whole table."""
    rows = _feedback(spark, sf_dir)
    none = rows.filter(F.col("event_id") < 0)
    root = scratch_dir(spark, "skip-empty")
    write_partitions(rows, f"{root}/partitioned")
    write_partitions(none, f"{root}/partitioned")
    kept = read_partitioned(spark, f"{root}/partitioned", ["date_load"])
    write_full(kept, f"{root}/whole", as_table=False)
    write_full(none, f"{root}/whole", as_table=False)
    return spark.read.parquet(f"{root}/whole")


LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag"]
LINE_SQL = f"""
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, {a.sql_stamp('l_shipdate')}, l_returnflag
FROM lineitem"""


def _lines(spark: SparkSession, sf_dir: str) -> str:
    """A table of line items in three partitions of many small files."""
    database, root = scratch_database(spark)
    name = f"{database}.lines"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    spark.sql(f"CREATE TABLE {name} (l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
              f"l_shipdate TIMESTAMP, l_returnflag STRING) USING parquet PARTITIONED BY (l_returnflag) LOCATION '{root}/lines'")
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    insert_partitions(lines.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")).repartition(16, "l_orderkey"),
                      name, rebalance=False)
    return name


def _line_rows(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).select(*LINE_COLUMNS).withColumn("l_shipdate", a.stamp("l_shipdate"))


@checked("compact_partition", LINE_SQL)
def compact_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every partition rewritten into fewer files; no row changes."""
    name = _lines(spark, sf_dir)
    compact_table(spark, name, target_bytes=1 << 20)
    return _line_rows(spark, name)


@checked("compact_files", "SELECT DISTINCT l_returnflag, 1::BIGINT AS files FROM lineitem")
def compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many files each partition is read from after compaction into one."""
    name = _lines(spark, sf_dir)
    compact_table(spark, name, target_bytes=1 << 40)
    return spark.table(name).groupBy("l_returnflag").agg(F.count_distinct("_metadata.file_path").alias("files"))


@checked("cluster_by", LINE_SQL)
def cluster_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One partition ordered by one column, two by two columns; no row changes."""
    return _line_rows(spark, _clustered(spark, sf_dir))


def _clustered(spark: SparkSession, sf_dir: str) -> str:
    name = _lines(spark, sf_dir)
    for flag, columns in (("R", ["l_shipdate"]), ("A", ["l_shipdate", "l_partkey"]), ("N", ["l_shipdate", "l_partkey"])):
        folder = partition_location(spark, name, {"l_returnflag": flag})
        compact_table(spark, name, {"l_returnflag": flag}, cluster_by=columns,
                      target_bytes=max(1, filesystem.size_in_bytes(spark, folder) // 16))
    return name


@checked("cluster_ranges", """
SELECT DISTINCT l_returnflag, CASE WHEN l_returnflag = 'R' THEN 0 END::BIGINT AS within_others, true AS several, true AS narrow
FROM lineitem""")
def cluster_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the files of clustered partitions overlap, from the lowest and highest value of each file.

    Clustered by one column, no file begins or ends strictly within another. Clustered by two, a file
    covers less than half of the values on average, by the product of its two shares; unclustered, all.
    """
    rows = spark.table(_clustered(spark, sf_dir)).select(
        "l_returnflag", F.unix_seconds("l_shipdate").alias("x"), F.col("l_partkey").alias("y"),
        F.col("_metadata.file_path").alias("file"))
    files = rows.groupBy("l_returnflag", "file").agg(*[f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("low", F.min), ("high", F.max))])
    part = Window.partitionBy("l_returnflag")
    before = part.orderBy("low_x", "high_x").rowsBetween(Window.unboundedPreceding, -1)
    share = lambda c: (F.col(f"high_{c}") - F.col(f"low_{c}")) / (
        F.max(f"high_{c}").over(part) - F.min(f"low_{c}").over(part))
    told = files.select("l_returnflag", (F.max("high_x").over(before) > F.col("low_x")).alias("within"),
                        (share("x") * F.when(F.col("l_returnflag") == "R", 1).otherwise(share("y"))).alias("share"))
    return told.groupBy("l_returnflag").agg(
        F.when(F.col("l_returnflag") == "R", F.count_if("within")).alias("within_others"),
        (F.count("*") > 8).alias("several"), (F.avg("share") < 0.5).alias("narrow"))


@checked("table_catalog", f"""
WITH {a.UNIFIED_SQL},
rated AS (SELECT * FROM unified WHERE review_rating BETWEEN 1 AND 5),
kpis AS ({a.kpi_sql('rated')})
SELECT 'external_reviews' AS table_name, 19 AS columns, count(*) AS "rows" FROM ext
UNION ALL SELECT 'internal_reviews', 15, count(*) FROM feedback
UNION ALL SELECT 'unified_reviews', 16, count(*) FROM unified
UNION ALL SELECT 'review_kpis', 11, count(*) FROM kpis
UNION ALL SELECT 'control_params', 11, count(*) FROM part""")
def table_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five tables, created twice without harm, then filled; one was filled before and created anew."""
    database, root = scratch_database(spark)
    names = {}
    for _ in range(2):
        names = {label: create_table(spark, database, label, spec, f"{root}/{label}")
                 for label, spec in TABLES.items()}
    insert_partitions(a.internal_reviews(spark, sf_dir), names["internal_reviews"])
    create_table(spark, database, "internal_reviews", TABLES["internal_reviews"], f"{root}/internal_reviews", recreate=True)
    month = stamp_month(unified(spark, sf_dir), a.RUN_DAY)
    insert_partitions(a.external_reviews(spark, sf_dir), names["external_reviews"])
    insert_partitions(a.internal_reviews(spark, sf_dir), names["internal_reviews"])
    insert_partitions(month, names["unified_reviews"], static={"date_load": "202402"})
    insert_partitions(review_kpis(prepare_for_kpis(filter_rating(month))), names["review_kpis"])
    control = table(spark, sf_dir, "part").select(
        (F.col("p_size").cast("double") / 10).alias("version"),
        *[F.lit(None).alias(name) for name, _, _ in TABLES["control_params"].columns
          if name not in ("version", "table_name_target")],
        F.col("p_name").alias("table_name_target"),
    )
    insert_partitions(control, names["control_params"])
    counts = [spark.table(name).agg(F.lit(label).alias("table_name"),
                                    F.lit(len(spark.table(name).columns)).alias("columns"),
                                    F.count("*").alias("rows"))
              for label, name in names.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


@checked("purge_landing", """
SELECT * FROM (SELECT o_orderstatus AS app, count(*) AS "rows" FROM orders GROUP BY 1) WHERE app <> 'F'
UNION ALL SELECT 'F', (SELECT count(*) FROM orders WHERE o_orderstatus = 'O')""")
def purge_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a day's landing files: all that no finished run has read.

    App F was read by a finished run, and a file came after it; a run of app O found no rows in another
    folder; a run of app P read its files and left no record.
    """
    root = scratch_dir(spark, "purge-landing")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("app"))
    landing, manifest, metrics = f"{root}/reviews/2024-01-10", f"{root}/manifest", f"{root}/metrics"
    orders.write.partitionBy("app").json(landing)
    runs = {app: new_run_id() for app in "FOP"}
    for app, folder in (("F", f"{landing}/app=F"), ("O", f"{root}/nothing"), ("P", f"{landing}/app=P")):
        append_manifest(list_files(spark, [folder]), manifest, runs[app])
    orders.filter("app = 'O'").select("o_orderkey").write.mode("append").json(f"{landing}/app=F")
    for app in "FO":
        record = spark.createDataFrame([("2024-01-10", "reviews")], "run_day STRING, app_id STRING")
        append_metrics(record, metrics, runs[app])
    purge_loaded(spark, [landing], manifest=spark.read.parquet(manifest), metrics=spark.read.parquet(metrics),
                 day="2024-01-10", flows=["reviews"])
    left = spark.read.schema("o_orderkey BIGINT, app STRING").json(landing)
    return left.groupBy("app").agg(F.count("*").alias("rows"))


@checked("purge_app", """
SELECT l_orderkey, l_linenumber, l_returnflag, 'k:' || l_linestatus AS status FROM lineitem WHERE l_linestatus <> 'O'""")
def purge_app(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value of the inner partition column, escaped in folder names, goes from every outer partition."""
    database, root = scratch_database(spark)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    spark.sql(f"CREATE TABLE {database}.lines (l_orderkey BIGINT, l_linenumber INT, l_returnflag STRING, status STRING) "
              f"USING parquet PARTITIONED BY (l_returnflag, status) LOCATION '{root}/lines'")
    insert_partitions(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.concat(F.lit("k:"), "l_linestatus").alias("status")),
        f"{database}.lines")
    drop_table_partitions(spark, f"{database}.lines", "status", lambda value: value == "k:O")
    spark.sql(f"MSCK REPAIR TABLE {database}.lines")
    return spark.table(f"{database}.lines")


@checked("purge_day", f"""
WITH {a.INTERNAL_SQL.replace('SELECT ts AS', 'SELECT event_id, ts AS')}
SELECT event_id, feedback_rating, service_id, date_load FROM feedback
WHERE date_load <> '2024-01-10' AND date_load >= '2024-01-05'""")
def purge_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day dropped, then everything older than the retention time."""
    root = scratch_dir(spark, "purge")
    write_partitions(_feedback(spark, sf_dir), root)
    drop_partitions(spark, root, "date_load", lambda day: day == "2024-01-10")
    retain_days(spark, root, date(2024, 1, 31), 26)
    return read_partitioned(spark, root, ["date_load"])


