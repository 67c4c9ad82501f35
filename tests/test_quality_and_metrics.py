from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.operators import (
    flag_duplicates,
    flag_nulls,
    flag_type_issues,
    metrics_payload,
    operations_dashboard,
    output_check_metrics,
    quality_summary,
    run_metrics,
)
from reviewlake.plans.run import owner_of
from reviewlake.session import session_conf
from tests.conftest import plan_of, rows

START = datetime(2024, 1, 1, 6, 0, 0, tzinfo=timezone.utc)
END = datetime(2024, 1, 1, 6, 1, 2, 345000, tzinfo=timezone.utc)


@pytest.fixture
def sample(spark):
    """Two equal keys, two NULL keys, one blank text on a repeated key, one NULL text alone."""
    return spark.createDataFrame(
        [("a", "x", "t"), ("a", "x", "  "), (None, "x", "t"), (None, "x", "t"), ("b", "x", None),
         ("c", "y", "t")], "k STRING, g STRING, text STRING")


def test_duplicates_mark_every_member(spark, sample):
    flagged = flag_duplicates(sample, ["k"])
    assert flagged.columns == ["k", "g", "text", "is_duplicate"]
    assert sorted(((r.k, r.is_duplicate) for r in flagged.collect()), key=str) == sorted(
        [("a", True), ("a", True), (None, True), (None, True), ("b", False), ("c", False)], key=str)


@pytest.mark.parametrize("key", [[], ["k", "absent"]])
def test_without_a_key_nothing_is_a_duplicate(sample, key):
    assert {r.is_duplicate for r in flag_duplicates(sample, key).collect()} == {False}
    assert quality_summary(sample, key).first().duplicate_count == 0


def test_hot_key_is_split_over_tasks(spark):
    """One key holds a third of the rows: the join divides them instead of using one task."""
    df = spark.range(200_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 40_000).alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"))
    small = {"spark__sql__autoBroadcastJoinThreshold": "-1",
             "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
             "spark__sql__adaptive__advisoryPartitionSizeInBytes": "200KB",
             "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
             "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "500KB"}
    with session_conf(spark, **small):
        flagged = flag_duplicates(df, ["k"])
        counted = {r.is_duplicate: r["count"] for r in
                   flagged.select("is_duplicate", "text").groupBy("is_duplicate").count().collect()}
        flagged.write.format("noop").mode("overwrite").save()
        held = flagged.collect()
        assert "skew=true" in plan_of(flagged)
    expected = df.groupBy("k").count().filter("count > 1").agg(F.sum("count")).first()[0]
    assert counted.get(True) == expected and len(held) == 200_000


def test_nulls(sample):
    flags = [r.is_null_issue for r in flag_nulls(sample, ["text", "absent"]).collect()]
    assert flags == [False, True, False, False, True, False]
    assert not any(r.is_null_issue for r in flag_nulls(sample, []).collect())


def test_numbers_can_be_required(spark):
    df = spark.sql("SELECT * FROM VALUES (1), (NULL) AS t(n)")
    assert [r.is_null_issue for r in flag_nulls(df, ["n"]).collect()] == [False, True]


def test_type_issues(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", None), (None, "soon")], "n STRING, d STRING")
    flagged = flag_type_issues(df, {"n": T.IntegerType(), "d": T.DateType(), "z": T.DateType()})
    assert [r.is_type_issue for r in flagged.collect()] == [False, True, True]


def test_summary(sample):
    row = quality_summary(sample, ["k"], ["text"]).first()
    assert row.asDict() == {
        "total_records": 6, "duplicate_count": 4, "null_count": 2, "type_count": 0,
        "valid_count": 0, "valid_percentage": 0.0, "invalid_count": 6, "invalid_percentage": 100.0,
        "distinct_invalid": 5}


def test_two_issues_subtract_twice(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "k STRING, text STRING")
    row = quality_summary(df, ["k"], ["text"]).first()
    assert (row.valid_count, row.invalid_count, row.distinct_invalid) == (-2, 4, 2)


@pytest.mark.parametrize("key", [[], ["k"]])
def test_empty_input(sample, key):
    row = quality_summary(sample.filter("false"), key, ["text"]).first()
    assert (row.total_records, row.duplicate_count, row.null_count, row.valid_count,
            row.valid_percentage, row.distinct_invalid) == (0, 0, 0, 0, 0.0, 0)


def test_summary_agrees_with_the_flags(spark):
    df = spark.range(3000).select(
        (F.col("id") % 1100).alias("k"), (F.col("id") % 3).cast("string").alias("g"),
        F.when(F.col("id") % 5 != 0, "t").alias("text"), (F.col("id") % 11 == 0).alias("odd"))
    row = quality_summary(df, ["k", "g"], ["text"], type_issue="odd").first()
    flags = flag_nulls(flag_duplicates(df, ["k", "g"]), ["text"])
    expected = flags.agg(
        F.count("*"), F.count_if("is_duplicate"), F.count_if("is_null_issue"), F.count_if("odd"),
        F.count_if(F.expr("is_duplicate OR is_null_issue OR odd"))).first()
    assert (row.total_records, row.duplicate_count, row.null_count, row.type_count,
            row.distinct_invalid) == tuple(expected)


def test_groups(sample):
    summary = quality_summary(sample, ["k"], ["text"], by=["g"])
    assert sorted((r.g, r.total_records, r.duplicate_count) for r in summary.collect()) == [
        ("x", 5, 4), ("y", 1, 0)]


def test_type_issues_counted_while_writing(sample):
    row = quality_summary(sample, ["k"], type_issues_seen=2).first()
    assert (row.type_count, row.valid_count) == (2, 0)


def test_summary_needs_no_window(sample):
    plan = plan_of(quality_summary(sample, ["k"], ["text"]))
    assert "Window" not in plan and "SortAggregate" not in plan


def record(sample, layer="bronze"):
    return run_metrics(quality_summary(sample, ["k"], ["text"]), owner_of("d", "p", layer, "raw"),
                       "app", START, END)


def test_run_metrics(sample):
    row = record(sample).first().asDict(recursive=True)
    assert row["owner"] == {"dominio": "d", "projeto": "p", "layer_lake": "bronze",
                            "layer_source": "raw"}
    assert row["valid_data"] == {"count": 0, "percentage": 0.0}
    assert row["total_processing_time"] == "62.35 s" or row["total_processing_time"] == "62.34 s"
    assert row["validation_results"]["duplicate_check"] == {"status": False, "count": 4}
    assert row["validation_results"]["type_consistency_check"] == {"status": True, "count": 0}
    assert (row["success_count"], row["error_count"]) == (1, 2)
    assert row["_ts"] == {"run_start_ts": "2024-01-01 06:00:00", "run_end_ts": "2024-01-01 06:01:02"}
    assert row["timestamp"] == "2024-01-01T06:01:02.345Z" and row["app_id"] == "app"


def test_output_check(spark):
    def check(n):
        frame = spark.range(n).agg(F.count("*").alias("total_records"))
        return output_check_metrics(frame, owner_of("d", "p", "gold", "silver"), "k", START, END).first()
    ok, empty = check(3), check(0)
    assert (ok.valid_data.count, ok.valid_data.percentage) != (0, 0.0)
    assert ok.validation_results.main_check.status and (ok.success_count, ok.error_count) == (1, 0)
    assert not empty.validation_results.main_check.status
    assert (empty.success_count, empty.error_count) == (0, 1)
    assert empty["valid_data"]["percentage"] == 0.0


def test_payload_holds_only_the_checks_made(spark, sample):
    payload = json.loads(metrics_payload(record(sample)).first().payload)
    assert "main_check" not in payload["validation_results"]
    assert payload["validation_results"]["null_check"] == {"status": False, "count": 2}
    gold = output_check_metrics(spark.range(1).agg(F.count("*").alias("total_records")),
                                owner_of("d", "p", "gold", "silver"), "k", START, END)
    assert list(json.loads(metrics_payload(gold).first().payload)["validation_results"]) == [
        "main_check"]


def test_dashboard(spark, sample):
    gold = output_check_metrics(spark.range(1).agg(F.count("*").alias("total_records")),
                                owner_of("d", "p", "gold", "silver"), "k", START, END)
    metrics = record(sample).unionByName(record(sample.filter("k = 'c'"))).unionByName(gold)
    dashboard = {r.layer_lake: r for r in operations_dashboard(metrics).collect()}
    bronze = dashboard["bronze"]
    assert (bronze.runs, bronze.runs_passed, bronze.runs_failed, bronze.null_total,
            bronze.duplicate_total, bronze.inconsistent_total) == (2, 1, 1, 2, 4, 0)
    assert abs(bronze.mean_processing_seconds - 62.345) < 0.01
    assert (dashboard["gold"].runs_passed, dashboard["gold"].null_total) == (1, 0)
    assert rows(operations_dashboard(metrics.filter("false"))) == []
