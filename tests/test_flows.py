from __future__ import annotations

import json
import os
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from reviewlake.checks.adapters import EXTERNAL_FLOW, GOLD_FLOW, INTERNAL_FLOW, SILVER_FLOW
from reviewlake.operators import metrics_payload, operations_dashboard
from reviewlake.plans import land_feed, run_bronze, run_gold, run_silver
from reviewlake.sinks import TABLES, compact, create_table, insert_partitions, purge_loaded
from tests.conftest import plan_of, rows

DAY = "2024-02-10"


def land(path, *objects):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.writelines(json.dumps(o, ensure_ascii=False) + "\n" for o in objects)


def review(key, rating="5", title="Bom"):
    return {"author_uri": "u", "author_name": f"author {key}", "updated_at": "2024-02-09T10:00:00-03:00",
            "rating": rating, "review_id": str(key), "title": title, "content": "ótimo 👍",
            "version": "1.0"}


def feedback(client, rating, comment="bom", segment="pf"):
    return {"submission_date": "2024-02-09T12:00:00.123456+00:00",
            "client": {"segment": segment, "identification": client, "classification": "Alto"},
            "feedback_rating": rating, "feedback_comment": comment, "service_type": "cartão de crédito",
            "source_channel": "website", "source_id": "2.0.1", "app_reference": "APP_X"}


@pytest.fixture
def tables(spark, lake):
    database = f"flow_{abs(hash(lake)) % 10**10}"
    names = {label: create_table(spark, database, label, spec, f"{lake}/tables/{label}")
             for label, spec in TABLES.items()}
    yield {**names, "database": database}
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def load_app(spark, lake, tables, app, **options):
    return run_bronze(spark, EXTERNAL_FLOW, landing_root=f"{lake}/raw", day=DAY, app=app, tag_app=True,
                      table=tables["external_reviews"], metrics_path=f"{lake}/metrics", **options)


def load_internal(spark, lake, tables, **options):
    return run_bronze(spark, INTERNAL_FLOW, landing_root=f"{lake}/raw", day=DAY, missing="null",
                      table=tables["internal_reviews"], metrics_path=f"{lake}/metrics", **options)


@pytest.fixture
def landed(lake):
    land(f"{lake}/raw/feed/reviews/{DAY}/alpha/p1.json", review(1), review(2, "x"))
    land(f"{lake}/raw/feed/reviews/{DAY}/alpha/p2.json", review(3, "2", title=" "))
    land(f"{lake}/raw/feed/reviews/{DAY}/beta/p1.json", review(9, "1"))
    land(f"{lake}/raw/internal/reviews/{DAY}/f.json",
         feedback("1.2-3", 4), feedback("1.2-3", 2), feedback("77", None), feedback("88", 5, ""),
         feedback("99", "bad"))


def test_bronze_of_two_apps_is_repeatable(spark, lake, tables, landed):
    for app in ("alpha", "beta", "alpha"):
        load_app(spark, lake, tables, app)
    table = spark.table(tables["external_reviews"])
    assert sorted(rows(table.select("app_reference", "review_id", "rating", "author_ura"))) == [
        ("alpha", "1", 5, "u"), ("alpha", "2", None, "u"), ("alpha", "3", 2, "u"),
        ("beta", "9", 1, "u")]
    assert {r.date_load for r in table.collect()} == {DAY}
    assert {r.ingestion_ts.date() for r in table.collect()} != {None}


def test_apps_can_be_loaded_side_by_side(spark, lake, tables, landed):
    """Runs of one day that overlap in time keep each other's rows and records."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(2) as pool:
        runs = [pool.submit(load_app, spark, lake, tables, app) for app in ("alpha", "beta")]
        assert [run.result().partition["app_reference"] for run in runs] == ["alpha", "beta"]
    assert spark.table(tables["external_reviews"]).count() == 4
    assert spark.read.parquet(f"{lake}/metrics").count() == 2


def test_one_run_loads_all_apps(spark, lake, tables, landed):
    """Rows carry their folder's name, whatever letters it has; files of the day itself have none."""
    land(f"{lake}/raw/feed/reviews/{DAY}/Ção +1/deep/p1.json", review(20))
    land(f"{lake}/raw/feed/reviews/{DAY}/stray.json", review(21))
    result = load_app(spark, lake, tables, None)
    table = spark.table(tables["external_reviews"])
    assert sorted(rows(table.select("app_reference", "review_id"))) == [
        ("alpha", "1"), ("alpha", "2"), ("alpha", "3"), ("beta", "9"), ("na", "21"), ("ção +1", "20")]
    assert result.partition == {"date_load": DAY}
    load_app(spark, lake, tables, "beta")
    assert spark.table(tables["external_reviews"]).count() == 6
    assert load_app(spark, f"{lake}/void", tables, " ").metrics.first().total_records == 0


def test_bronze_append_repeats_rows(spark, lake, tables, landed):
    for _ in range(2):
        assert load_app(spark, lake, tables, "beta", mode="append").metrics.first().total_records == 1
    assert spark.table(tables["external_reviews"]).count() == 2


def test_bronze_metrics(spark, lake, tables, landed):
    first = load_app(spark, lake, tables, "alpha").metrics.first()
    assert (first.total_records, first.validation_results.null_check["count"]) == (3, 1)
    assert first.validation_results.type_consistency_check["count"] == 0
    strict = load_app(spark, lake, tables, "alpha", strict_types=True).metrics.first()
    assert strict.validation_results.type_consistency_check["count"] == 1
    assert strict.error_count == 2 and strict.owner.layer_lake == "bronze"
    assert spark.read.parquet(f"{lake}/metrics").count() == 2


def test_bronze_internal_reads_the_nested_client(spark, lake, tables, landed):
    result = load_internal(spark, lake, tables, strict_types=True)
    table = spark.table(tables["internal_reviews"])
    assert sorted(rows(table.select("client_identification", "client_segment", "feedback_rating")),
                  key=str) == sorted(
        [("1.2-3", "pf", 4), ("1.2-3", "pf", 2), ("77", "pf", None), ("88", "pf", 5),
         ("99", "pf", None)], key=str)
    assert table.first().submission_date.microsecond == 123456
    metrics = result.metrics.first()
    assert metrics.validation_results.duplicate_check["count"] == 2
    assert metrics.validation_results.null_check["count"] == 1


def test_a_day_without_files_writes_nothing(spark, lake, tables):
    result = load_app(spark, lake, tables, "alpha", strict_types=True)
    assert spark.table(tables["external_reviews"]).isEmpty()
    metrics = result.metrics.first()
    assert (metrics.total_records, metrics.error_count) == (0, 0)


def test_missing_table_is_raised(spark, lake, tables, landed):
    with pytest.raises(Exception, match="nosuch"):
        run_bronze(spark, EXTERNAL_FLOW, landing_root=f"{lake}/raw", day=DAY, app="alpha",
                   tag_app=True, table=f"{tables['database']}.nosuch")


def test_compaction_of_a_catalog_partition_is_seen(spark, lake, tables, landed):
    load_app(spark, lake, tables, "alpha", compact_after=False)
    name = tables["external_reviews"]
    before = sorted(rows(spark.table(name)), key=str)
    compact(spark, name, {"date_load": DAY, "app_reference": "alpha"})
    assert sorted(rows(spark.table(name)), key=str) == before
    assert spark.table(name).select("_metadata.file_path").distinct().count() == 1


def test_a_missing_day_is_empty_unless_the_flow_says_otherwise(spark, lake, tables):
    strict = replace(EXTERNAL_FLOW, fallback={"create_empty_if_missing": "false"})
    args = dict(landing_root=f"{lake}/raw", day=DAY, app="alpha", tag_app=True, table=tables["external_reviews"])
    with pytest.raises(FileNotFoundError):
        run_bronze(spark, strict, **args)
    assert run_bronze(spark, EXTERNAL_FLOW, **args).metrics.first().total_records == 0


def test_appending_runs_with_one_time_stamp_count_their_own_rows(spark, lake, tables, landed):
    stamp = datetime(2024, 2, 10, 6)
    totals = [load_app(spark, lake, tables, "alpha", mode="append", run_ts=stamp, compact_after=again).metrics.first().total_records
              for again in (True, False, True)]
    assert totals == [3, 3, 3] and spark.table(tables["external_reviews"]).count() == 9


def page(*entries):
    return {"feed": {"entry": [{"id": {"label": str(key)}, "im:rating": {"label": "5"}} for key in entries]}}


def test_pages_to_landing_to_bronze_to_purge(spark, lake, tables):
    land(f"{lake}/pages/{DAY}/Alpha/1.json", page(1, 2), page(3))
    land(f"{lake}/pages/{DAY}/beta/1.json", page(9), {"feed": {}})
    with open(f"{lake}/pages/{DAY}/beta/2.json", "w") as file:
        file.write('{"feed": {"entry": [{"id"')
    args = dict(pages_root=f"{lake}/pages", landing=f"{lake}/raw/feed/reviews", quarantine=f"{lake}/quarantine", day=DAY,
                metrics_path=f"{lake}/metrics", manifest_path=f"{lake}/manifest")
    for _ in range(2):
        result = land_feed(spark, **args)
    assert (result.pages, result.unreadable, result.reviews) == (5, 1, 4)
    metrics = result.metrics.first()
    assert (metrics.total_records, metrics.validation_results.type_consistency_check["count"]) == (5, 1)
    aside = spark.read.parquet(f"{lake}/quarantine").collect()
    assert [(r.app, r.page[:6]) for r in aside] == [("beta", '{"feed')]
    flow = replace(EXTERNAL_FLOW, source={**EXTERNAL_FLOW.source, "app_key": "app"})
    for app in (None, "alpha"):
        run_bronze(spark, flow, landing_root=f"{lake}/raw", day=DAY, app=app, tag_app=True, manifest_path=f"{lake}/manifest",
                   table=tables["external_reviews"], metrics_path=f"{lake}/metrics")
    table = spark.table(tables["external_reviews"])
    assert sorted(rows(table.select("app_reference", "review_id", "rating"))) == [
        ("alpha", "1", 5), ("alpha", "2", 5), ("alpha", "3", 5), ("beta", "9", 5)]
    purged = dict(manifest=spark.read.parquet(f"{lake}/manifest"), metrics=spark.read.parquet(f"{lake}/metrics"), day=DAY)
    assert purge_loaded(spark, [f"{lake}/raw/feed/reviews/{DAY}"], flows=["external_reviews"], **purged) > 0
    assert not os.path.exists(f"{lake}/raw/feed/reviews/{DAY}")
    assert purge_loaded(spark, [f"{lake}/pages/{DAY}"], flows=["landing"], **purged) == 3
    # A mended day: the page is readable now, and nothing stays in quarantine.
    land(f"{lake}/pages/{DAY}/beta/2.json", page(10))
    assert land_feed(spark, **args).reviews == 1
    assert spark.read.schema("app STRING, page STRING").parquet(f"{lake}/quarantine/date_load={DAY}").count() == 0
    nothing = land_feed(spark, **{**args, "day": "2024-02-11"})
    assert (nothing.pages, nothing.metrics.first().total_records) == (0, 0)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_landing_is_packed_and_leaves_no_shuffles(spark, lake, tables):
    land(f"{lake}/pages/{DAY}/alpha/1.json", *[page(*range(50 * i, 50 * i + 50)) for i in range(40)])
    land(f"{lake}/pages/{DAY}/beta/1.json", page("é 👍"))
    # What a run before packing has left goes, too.
    land(f"{lake}/raw/feed/reviews/{DAY}/app=alpha/part-0.json", review("old"))
    before = shuffle_files(spark)
    for _ in range(2):
        assert land_feed(spark, pages_root=f"{lake}/pages", landing=f"{lake}/raw/feed/reviews", quarantine=f"{lake}/quarantine",
                         day=DAY).reviews == 2001
    assert not shuffle_files(spark) - before
    landed = spark.read.json(f"{lake}/raw/feed/reviews/{DAY}")
    assert {r["review_id"] for r in landed.collect()} == {"é 👍", *map(str, range(2000))} and landed.count() == 2001
    lines = sum(len(json.dumps(r.asDict())) for r in landed.drop("app").toLocalIterator())
    files = [os.path.join(d, f) for d, _, names in os.walk(f"{lake}/raw") for f in names if f.startswith("part-")]
    assert sum(map(os.path.getsize, files)) < lines / 4
    flow = replace(EXTERNAL_FLOW, source={**EXTERNAL_FLOW.source, "app_key": "app"})
    run_bronze(spark, flow, landing_root=f"{lake}/raw", day=DAY, tag_app=True, table=tables["external_reviews"])
    loaded = spark.table(tables["external_reviews"])
    assert rows(loaded.groupBy("app_reference").count().orderBy("app_reference")) == [("alpha", 2000), ("beta", 1)]
    assert loaded.filter("app_reference = 'beta'").first().review_id == "é 👍"


def run_all(spark, lake, tables):
    for app in ("alpha", "beta"):
        load_app(spark, lake, tables, app)
    load_internal(spark, lake, tables)
    silver = run_silver(spark, SILVER_FLOW, external_table=tables["external_reviews"],
                        internal_table=tables["internal_reviews"], table=tables["unified_reviews"],
                        run_day=DAY, metrics_path=f"{lake}/metrics")
    gold = run_gold(spark, GOLD_FLOW, source_table=tables["unified_reviews"],
                    table=tables["review_kpis"], run_day=DAY, metrics_path=f"{lake}/metrics")
    return silver, gold


def test_whole_flow_twice(spark, lake, tables, landed):
    other_month = spark.table(tables["unified_reviews"]).filter("false").unionByName(
        spark.range(1).select(F.lit("old").alias("review_id")), allowMissingColumns=True)
    insert_partitions(other_month.drop("date_load"), tables["unified_reviews"],
                      static={"date_load": "202401"})
    results = []
    for _ in range(2):
        run_all(spark, lake, tables)
        silver = spark.table(tables["unified_reviews"]).filter("date_load = '202402'")
        results.append((sorted(rows(silver.select("client_id", "review_rating", "review_text",
                                                  "app_reference", "service_type")), key=str),
                        sorted(rows(spark.table(tables["review_kpis"])), key=str)))
    assert results[0] == results[1]
    # The two ratings of one client differ only in the rating, so the higher one survives.
    assert results[0][0] == sorted([
        ("AUTHOR1", 5, "OTIMO", "ALPHA", "NA"), ("AUTHOR3", 2, "OTIMO", "ALPHA", "NA"),
        ("AUTHOR9", 1, "OTIMO", "BETA", "NA"), ("123", 4, "BOM", "APP_X", "CARTAO_DE_CREDITO"),
        ("88", 5, "NAO_INFORMADO", "APP_X", "CARTAO_DE_CREDITO")], key=str)
    assert spark.table(tables["unified_reviews"]).filter("date_load = '202401'").count() == 1
    dashboard = {r.layer_lake: r.runs for r in
                 operations_dashboard(spark.read.parquet(f"{lake}/metrics")).collect()}
    assert dashboard == {"bronze": 6, "silver": 2, "gold": 2}
    payloads = metrics_payload(spark.read.parquet(f"{lake}/metrics"))
    records = [json.loads(r.payload) for r in payloads.collect()]
    assert len(records) == 10 and all(r["app_id"] and "run_id" not in r for r in records)


def test_gold_keeps_its_table_when_the_snapshot_is_empty(spark, lake, tables, landed):
    run_all(spark, lake, tables)
    before = spark.table(tables["review_kpis"]).count()
    result = run_gold(spark, GOLD_FLOW, source_table=tables["unified_reviews"],
                      table=tables["review_kpis"], run_day="2030-01-01")
    assert spark.table(tables["review_kpis"]).count() == before
    assert result.metrics.first().error_count == 1


def test_gold_by_year(spark, lake, tables, landed):
    run_all(spark, lake, tables)
    run_gold(spark, GOLD_FLOW, source_table=tables["unified_reviews"], table=tables["review_kpis"],
             run_day=DAY, partition_by=["review_year"])
    assert {r.review_year for r in spark.table(tables["review_kpis"]).collect()} == {"2024"}
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {tables['review_kpis']}").collect()] == ["review_year=2024"]


def test_silver_reads_only_the_window(spark, lake, tables, landed):
    from reviewlake.plans import silver_rows
    load_app(spark, lake, tables, "alpha")
    external, internal = (spark.table(tables[f"{kind}_reviews"]) for kind in ("external", "internal"))
    near = silver_rows(external, internal, SILVER_FLOW, DAY)
    assert near.count() == 2
    assert silver_rows(external, internal, GOLD_FLOW, "2026-01-01").count() == 0  # 365 days back
    plan = plan_of(near)
    assert plan.count("Exchange") == 1
    assert "PythonUDF" not in plan and "ArrowEval" not in plan
    assert datetime.fromisoformat(DAY)


def test_silver_flow_takes_reviews_of_every_day(spark, lake, tables, landed):
    from reviewlake.plans import silver_rows
    load_app(spark, lake, tables, "alpha")
    external, internal = (spark.table(tables[f"{kind}_reviews"]) for kind in ("external", "internal"))
    for day in ("1900-01-01", None):
        old = external.withColumn("date_load", F.lit(day).cast("string"))
        assert silver_rows(old, internal, SILVER_FLOW, DAY).count() == 2
        assert silver_rows(old, internal, GOLD_FLOW, DAY).count() == 0  # 365 days back


def test_silver_queries_read_the_oldest_load_days(spark, sf_dir):
    from reviewlake.checks.registry import QUERIES, table
    oldest = table(spark, sf_dir, "orders").agg(F.year(F.min("o_orderdate")).cast("string")).first()[0]
    assert QUERIES["gold_flow"](spark, sf_dir).agg(F.min("review_year")).first()[0] == oldest
    assert QUERIES["silver_reviews"](spark, sf_dir).agg(F.min("review_date")).first()[0][:4] == oldest


def test_keys_are_counted_in_tasks_of_bounded_size(spark):
    """As bronze_external counts the keys of its run: more keys, more tasks."""
    from types import SimpleNamespace

    from reviewlake.plans.run import settled
    name, seen = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", []
    summary = SimpleNamespace(sparkSession=spark, schema="n INT",
                              collect=lambda: seen.append(int(spark.conf.get(name))) or [(1,)])
    for keys in (20_000_000, 200_000_000):
        assert settled(summary, spark.range(keys)).count() == 1
    assert seen[0] >= 19 and seen[1] >= 190
