from __future__ import annotations

from datetime import datetime, timezone
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.config import ColumnSpec, FlowConfig, Rule
from reviewlake.operators import (
    app_reference_column,
    apply_review_rules,
    clean_reviews,
    dedup_reviews,
    filter_rating,
    map_columns,
    prepare_for_kpis,
    resolve_source,
    review_kpis,
    sentiment_kpis,
    unify_external,
    unify_internal,
    union_sources,
    with_control_columns,
)
from reviewlake.operators.unify import UNIFIED_COLUMNS
from tests.conftest import plan_of, rows

UTC = timezone.utc


def test_resolve_source(spark):
    df = spark.sql("SELECT 1 AS `a.b`, named_struct('b', 2, 'c', named_struct('d', 3)) AS a, 4 AS x")
    values = {name: df.select(resolve_source(df.schema, name)).first()[0]
              for name in ("a.b", "a.c.d", "x")}
    assert values == {"a.b": 1, "a.c.d": 3, "x": 4}  # a literal name wins over a path
    for name in ("y", "x.b", "a.z", "a.c.z"):
        assert resolve_source(df.schema, name) is None


TARGET = (ColumnSpec("n", "INT"), ColumnSpec("segment"), ColumnSpec("at", "TIMESTAMP"),
          ColumnSpec("ingestion_ts", "TIMESTAMP"), ColumnSpec("date_load"))


def test_map_columns_casts_without_failing(spark):
    df = spark.sql("SELECT * FROM VALUES ('1', '2024-01-01T00:00:00-03:00', 'pf'),"
                   " ('x', 'bad', NULL), (NULL, NULL, 'pj') AS t(num, at, seg)")
    df = df.select("num", "at", F.struct(F.col("seg").alias("segment")).alias("client"))
    mapping = {"n": "num", "segment": "client.segment"}
    mapped = map_columns(df, TARGET, mapping, type_issue="bad")
    assert mapped.columns == ["n", "segment", "at", "bad"]
    assert rows(mapped) == [(1, "pf", datetime(2024, 1, 1, 3), False), (None, None, None, True),
                            (None, "pj", None, False)]


def test_live_table_types_win(spark):
    df = spark.sql("SELECT '1' AS n")
    mapped = map_columns(df, [ColumnSpec("n", "INT")], {}, table_types={"n": T.LongType()})
    assert mapped.schema["n"].dataType == T.LongType()


def test_missing_source_columns(spark):
    df = spark.sql("SELECT 1 AS a")
    target = [ColumnSpec("a", "INT"), ColumnSpec("b", "DOUBLE")]
    with pytest.raises(ValueError, match="'b' does not exist|'b' for 'b'"):
        map_columns(df, target, {})
    mapped = map_columns(df, target, {}, missing="null")
    assert rows(mapped) == [(1, None)] and mapped.schema["b"].dataType == T.DoubleType()
    with pytest.raises(ValueError, match="missing must be"):
        map_columns(df, target, {}, missing="guess")


def test_empty_input_keeps_the_target_layout(spark):
    empty = spark.createDataFrame([], "num STRING, at STRING, client STRUCT<segment: STRING>")
    mapped = with_control_columns(
        map_columns(empty, TARGET, {"n": "num", "segment": "client.segment"}), "2024-01-01")
    assert mapped.columns == ["n", "segment", "at", "ingestion_ts", "date_load"]
    assert mapped.isEmpty()


def test_app_reference(spark):
    df = spark.sql("SELECT * FROM VALUES (' AbC '), (NULL), ('  ') AS t(app_reference)")
    def values(frame, app):
        return [r[0] for r in frame.select(app_reference_column(frame.schema, app)).collect()]
    assert values(df, None) == ["abc", "na", ""]
    assert values(df, " My App ") == ["my app"] * 3
    assert values(df, "  ") == ["abc", "na", ""]
    assert values(spark.range(1).toDF("x"), None) == ["na"]


def test_control_columns_are_one_value_per_run(spark):
    stamped = with_control_columns(spark.range(3), "2024-01-02", datetime(2024, 1, 2, 5, tzinfo=UTC))
    assert {(r.ingestion_ts, r.date_load) for r in stamped.collect()} == {
        (datetime(2024, 1, 2, 5), "2024-01-02")}


EXTERNAL = ("review_id STRING, author_name STRING, updated_at STRING, rating INT, title STRING,"
            " content STRING, version STRING, app_reference STRING, ingestion_ts TIMESTAMP,"
            " date_load STRING, source_table STRING")
INTERNAL = ("client_identification STRING, app_reference STRING, submission_date TIMESTAMP,"
            " feedback_rating INT, feedback_comment STRING, source_id STRING,"
            " source_channel STRING, client_segment STRING, service_type STRING,"
            " source_user_agent STRING, ingestion_ts TIMESTAMP, date_load STRING")


def test_unify_external(spark):
    df = spark.createDataFrame([
        ("1", "Zé", "2024-01-01T10:00:00-07:00", 5, None, None, None, None, None, "d", "t"),
        (None, None, "yesterday", None, "T", "C", "2.0", "nu", None, "d", "t")], EXTERNAL)
    first, second = unify_external(df).collect()
    assert unify_external(df).columns == list(UNIFIED_COLUMNS)
    assert first.review_id == sha256(b"1").hexdigest()
    assert first.review_date == datetime(2024, 1, 1, 17)
    assert (first.review_title, first.review_text, first.review_version, first.app_reference) == (
        "NAO_IDENTIFICADO", "NAO_INFORMADO", "1.0.0", "NAO_INFORMADO")
    assert (first.source_channel, first.source_system, first.segment, first.service_type,
            first.source_agent, first.user_agent) == (
        "external", "apple_reviews", "NA", "NA", "Itunes", "REVIEWS")
    assert (second.review_id, second.review_date, second.app_reference) == (None, None, "NU")


def test_unify_internal(spark):
    df = spark.createDataFrame([
        ("9", "app", datetime(2024, 1, 1), None, "", None, "web", None, None, None, None, "d"),
        (None, "app", None, 4, "   ", "3.1", None, "pf", "seguro", "UA", None, "d"),
        (None, "app", None, 4, None, "3.1", None, "pf", "seguro", "UA", None, "d")], INTERNAL)
    first, second, third = unify_internal(df).collect()
    assert first.review_id == sha256(b"9:app").hexdigest()
    assert (first.review_rating, first.review_text, first.review_version, first.segment,
            first.service_type, first.source_agent) == (
        0, "NAO_INFORMADO", "1.0.0", "NA", "NA", "NAO_INFORMADO")
    assert second.review_id == sha256(b"app").hexdigest()  # no client: the app alone
    assert (second.review_text, second.segment, second.app_reference) == ("   ", "PF", "APP")
    assert third.review_text == "NAO_INFORMADO"


def test_union_fills_missing_columns(spark):
    union = union_sources(spark.sql("SELECT 1 AS a, 'x' AS b"), spark.sql("SELECT 2 AS a, 3 AS c"),
                          spark.sql("SELECT 1 AS a, 'x' AS b"))
    assert sorted(rows(union), key=str) == [(1, "x", None), (1, "x", None), (2, None, 3)]


REVIEWS = ("review_id STRING, client_id STRING, source_system STRING, app_reference STRING,"
           " review_date TIMESTAMP, review_rating INT, review_text STRING")
DAY = [datetime(2024, 1, d) for d in range(1, 10)]


def reviews(spark, *data):
    return spark.createDataFrame(list(data), REVIEWS)


def test_newest_row_of_a_key_survives(spark):
    df = reviews(
        spark, ("a", "1", "s", "x", DAY[0], 5, "old"), ("a", "1", "s", "x", DAY[1], 1, "new"),
        ("a", "1", "s", "x", None, 2, "undated"), ("a", "2", "s", "x", DAY[0], 3, "other"),
        ("b", None, "s", "x", DAY[0], 3, "p"), ("b", None, "s", "x", DAY[0], 3, "q"))
    kept = dedup_reviews(df.repartition(4, "review_text"))
    assert sorted(r.review_text for r in kept.collect()) == ["new", "other", "q"]
    assert kept.columns == df.columns


def test_rows_without_client(spark):
    df = reviews(spark, ("h", None, "s", "x", DAY[0], 3, "p"), ("h", None, "s", "x", DAY[1], 3, "q"),
                 ("h", None, "s", "x", DAY[1], 3, "q"), ("h", "1", "s", "x", DAY[1], 3, "r"))
    def texts(**how):
        return sorted(r.review_text for r in dedup_reviews(df, **how).collect())
    assert texts() == ["q", "r"]
    assert texts(null_clients="keep") == ["p", "q", "r"]
    assert texts(null_clients="reject") == ["r"]
    with pytest.raises(ValueError):
        dedup_reviews(df, null_clients="guess")


def test_dedup_reduces_before_the_shuffle(spark):
    plan = plan_of(dedup_reviews(reviews(spark, ("a", "1", "s", "x", DAY[0], 5, "t"))))
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below
    assert plan.count("Exchange") == 1


def test_one_row_per_key(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 700).cast("string"))
        .alias("review_id"), F.lit("c").alias("client_id"), F.lit("s").alias("source_system"),
        F.lit("a").alias("app_reference"), F.timestamp_seconds(F.col("id") % 10).alias("review_date"),
        F.lit(1).alias("review_rating"), F.col("id").cast("string").alias("review_text"))
    kept = dedup_reviews(df)
    assert kept.count() == kept.select("review_id").distinct().count() == df.select(
        "review_id").distinct().count()


def test_rating_range(spark):
    df = reviews(spark, *[(str(i), "1", "s", "x", DAY[0], r, "t")
                          for i, r in enumerate([None, 0, 1, 5, 6])])
    assert sorted(r.review_rating for r in filter_rating(df).collect()) == [1, 5]


def test_rules_dedup_first_unless_told_otherwise(spark):
    df = reviews(spark, ("a", "1", "s", "x", DAY[0], 4, "valid"), ("a", "1", "s", "x", DAY[1], 0, "not"))
    config = FlowConfig("t", rules=(Rule("min_value", "2"), Rule("max_value", "4")))
    assert rows(apply_review_rules(df, config)) == []
    assert apply_review_rules(df, config, filter_first=True).first().review_text == "valid"


def test_clean_reviews(spark):
    df = spark.createDataFrame(
        [(" 12.3-4 ", "agência ", "apple_reviews", "Olá 👍", " ç ", " cartão  x ", "keep")],
        "client_id STRING, source_channel STRING, source_system STRING, review_title STRING,"
        " review_text STRING, service_type STRING, user_agent STRING")
    row = clean_reviews(df).first()
    assert (row.client_id, row.source_channel, row.source_system, row.review_title, row.review_text,
            row.service_type, row.user_agent) == (
        "1234", "AGENCIA", "APPLE_REVIEWS", "OLA", "C", "_CARTAO_X_", "keep")
    assert clean_reviews(df, anonymize_client=True).first().client_id == sha256(b"1234").hexdigest()
    assert clean_reviews(df, legacy_map=True).first().review_text == "U"
    assert clean_reviews(df).columns == df.columns


def kpi_input(spark, *ratings, day=datetime(2024, 3, 5)):
    return spark.createDataFrame(
        [(day, r, "1", "PF", "S", "A") for r in ratings],
        "review_date TIMESTAMP, review_rating INT, review_version STRING, segment STRING,"
        " service_type STRING, app_reference STRING")


def test_kpis(spark):
    kpis = review_kpis(prepare_for_kpis(kpi_input(spark, 5, 5, 4, 3, 2, 5, None, 1)))
    assert rows(kpis) == [("2024", "03", "1", "PF", "S", "A", 7, 3.6, 1.0, 5.0, 0.0)]
    assert [f.dataType.simpleString() for f in kpis.schema.fields] == (
        ["string"] * 6 + ["bigint"] + ["double"] * 4)


@pytest.mark.parametrize("ratings, average, score", [
    ([5] * 9, 5.0, 1.0), ([1], 1.0, -1.0), ([4], 4.0, 0.0), ([2, 2, 2, 3], 2.3, -1.0),
    ([5, 4, 4, 4, 4, 4, 4, 4], 4.1, 0.13), ([3, 4, 4, 4, 4, 4, 4, 4], 3.9, -0.13)])
def test_rounding_is_half_away_from_zero(spark, ratings, average, score):
    row = review_kpis(prepare_for_kpis(kpi_input(spark, *ratings))).first()
    assert (row.average_rating, row.nps_score) == (average, score)
    assert -1 <= row.nps_score <= 1


def test_undated_rows_drop_out(spark):
    assert rows(prepare_for_kpis(kpi_input(spark, 5, day=None))) == []


def test_kpis_shuffle_once(spark):
    plan = plan_of(review_kpis(prepare_for_kpis(kpi_input(spark, 5))))
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2


def test_sentiment(spark):
    sentiment = sentiment_kpis(kpi_input(spark, 5, 4, 3, 2, 1, 1, None))
    assert rows(sentiment) == [("202403", "S", "A", 6, 2, 3, 1, 2.7, -0.17)]
