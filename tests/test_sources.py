from __future__ import annotations

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.config import ColumnSpec, FlowConfig, build_schema
from reviewlake.sinks import export_documents, write_partitions
from reviewlake.sources import (
    app_folder,
    flatten_feed,
    landing_paths,
    read_feed_pages,
    read_flow_source,
    read_landing,
    read_partitioned,
    scan_days_back,
    scan_month,
    select_tagged,
)
from reviewlake.sources.feed import FEED_FIELDS
from tests.conftest import plan_of, rows

SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("client", T.StructType([T.StructField("segment", T.StringType())])),
    T.StructField("at", T.TimestampType())])


def land(path: str, *objects) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.writelines(json.dumps(o, ensure_ascii=False) + "\n" for o in objects)


def test_paths():
    assert landing_paths("r/", "2024-01-01") == ["r/2024-01-01"]
    assert landing_paths("r", " 2024-01-01 ", ["", None, "  "]) == ["r/2024-01-01"]
    assert landing_paths("r", ["d1", "d2"], ["a", " b "]) == ["r/d1/a", "r/d1/b", "r/d2/a", "r/d2/b"]


def test_day_and_app_are_read_recursively(spark, lake):
    land(f"{lake}/d1/a/x.json", {"id": 1, "client": {"segment": "pf"}})
    land(f"{lake}/d1/b/deep/y.json", {"id": 2}, {"id": "x"})
    land(f"{lake}/d2/a/z.json", {"id": 4})

    def ids(*args):
        df = read_landing(spark, "JSON", SCHEMA, landing_paths(lake, *args))
        return sorted((r.id for r in df.collect()), key=str)

    assert ids("d1", ["a"]) == [1]
    assert ids("d1") == [1, 2, None]  # an unreadable value is NULL, its row stays
    assert ids(["d1", "d2", "d3"], ["a"]) == [1, 4]
    nested = read_landing(spark, "json", SCHEMA, landing_paths(lake, "d1", ["a"]))
    assert nested.select("client.segment").first()[0] == "pf"


def test_missing_folder_is_empty_and_typed(spark, lake):
    df = read_landing(spark, "json", SCHEMA, [f"{lake}/nowhere"])
    assert df.schema == SCHEMA and df.isEmpty()


def test_other_errors_are_raised(spark, lake):
    land(f"{lake}/d1/x.json", {"id": 1})
    with pytest.raises(Exception, match="nosuchformat"):
        read_landing(spark, "nosuchformat", SCHEMA, [f"{lake}/d1"])


def test_csv_has_a_header(spark, lake):
    os.makedirs(f"{lake}/d1")
    with open(f"{lake}/d1/x.csv", "w", encoding="utf-8") as file:
        file.write('id,name\n1,"a, ""b"""\nx,c\n')
    schema = build_schema([ColumnSpec("id", "INT"), ColumnSpec("name")])
    read = read_landing(spark, "csv", schema, [f"{lake}/d1"], {"escape": '"'})
    assert rows(read) == [(1, 'a, "b"'), (None, "c")]


def test_flow_source_uses_the_configured_directory(spark, lake):
    land(f"{lake}/in/reviews/d1/app/x.json", {"id": 7})
    config = FlowConfig("t", expected=(ColumnSpec("id", "INT"),),
                        source={"format": "json", "directory": "in/reviews/"})
    assert rows(read_flow_source(spark, config, lake, "d1", ["app"])) == [(7,)]
    assert rows(read_flow_source(spark, config, lake, "d2")) == []


ENTRY = {
    "author": {"uri": {"label": "u"}, "name": {"label": "Zé"}, "label": ""},
    "updated": {"label": "2024-01-01T00:00:00-07:00"}, "im:rating": {"label": "5"},
    "im:version": {"label": "1.2"}, "id": {"label": "99"}, "title": {"label": "t"},
    "content": {"label": "c", "attributes": {"type": "text"}},
    "link": {"attributes": {"rel": "related", "href": "h"}}, "im:voteSum": {"label": "3"},
    "im:contentType": {"attributes": {"term": "Application", "label": "Application"}},
    "im:voteCount": {"label": "4"},
}
FLAT = ("u", "Zé", "", "2024-01-01T00:00:00-07:00", "5", "1.2", "99", "t", "c", "text", "related",
        "h", "3", "Application", "Application", "4")


@pytest.mark.parametrize("multiline", [False, True])
def test_feed_pages(spark, lake, multiline):
    """Several entries, one bare entry, an entry with gaps, and a page without entries."""
    pages = [{"feed": {"entry": [ENTRY, ENTRY]}}, {"feed": {"entry": ENTRY}},
             {"feed": {"entry": [{"id": {"label": "1"}}]}}, {"feed": {"title": "none"}}, {}]
    for i, page in enumerate(pages):
        with open(f"{lake}/{i}.json", "w", encoding="utf-8") as file:
            json.dump(page, file, indent=2 if multiline else None)
    df = flatten_feed(read_feed_pages(spark, lake, multiline=multiline))
    assert df.columns == list(FEED_FIELDS)
    gaps = tuple("1" if name == "review_id" else None for name in FEED_FIELDS)
    assert sorted(rows(df), key=str) == sorted([FLAT, FLAT, FLAT, gaps], key=str)


def test_export_keeps_letters_nulls_and_micros(spark, lake):
    df = spark.sql("SELECT 'x' AS _id, 'ação' AS text, CAST(NULL AS STRING) AS gap,"
                   " TIMESTAMP '2024-01-01 00:00:00.123456' AS at")
    assert export_documents(df, f"{lake}/out") == 1
    part = next(f for f in os.listdir(f"{lake}/out") if f.endswith(".json"))
    with open(f"{lake}/out/{part}", encoding="utf-8") as file:
        line = file.read()
    assert "ação" in line
    assert json.loads(line) == {"text": "ação", "gap": None, "at": "2024-01-01T00:00:00.123456Z"}


def test_export_of_nothing(spark, lake):
    assert export_documents(spark.range(3).filter("id < 0"), f"{lake}/a") == 0
    assert export_documents(spark.createDataFrame([], "_id INT, a INT"), f"{lake}/b") == 0


def test_scans_prune_partitions(spark, lake):
    days = spark.createDataFrame(
        [(1, "2023-12-31"), (2, "2024-01-01"), (3, "2024-01-31"), (4, None)], "id INT, date_load STRING")
    write_partitions(days.na.drop(), lake)
    table = read_partitioned(spark, lake, ["date_load"])
    recent = scan_days_back(table, date(2024, 1, 31), 30)
    assert sorted(r.id for r in recent.collect()) == [2, 3]
    assert "PartitionFilters: [isnotnull(date_load" in plan_of(recent)
    assert "cast(date_load" not in plan_of(recent)


def test_month_scan(spark, lake):
    months = spark.createDataFrame([(1, "202401"), (2, "202402")], "id INT, date_load STRING")
    write_partitions(months, lake)
    found = scan_month(read_partitioned(spark, lake, ["date_load"]), "2024-02-29")
    assert rows(found) == [(2, "202402")]
    assert "PartitionFilters: [isnotnull(date_load" in plan_of(found)
    with pytest.raises(ValueError, match="date_load"):
        scan_month(months.drop("date_load"), "2024-02-29")


def test_partition_values_stay_text(spark, lake):
    spark.createDataFrame([(1, "01")], "id INT, month STRING").write.partitionBy("month").parquet(
        f"{lake}/t")
    assert rows(read_partitioned(spark, f"{lake}/t", ["month"])) == [(1, "01")]


def test_select_tagged(spark):
    df = spark.range(1).select(F.lit(1).alias("a"), F.lit(2).alias("b"), F.lit("d").alias("date_load"))
    assert select_tagged(df, ["b"], "t").columns == ["b", "source_table", "date_load"]
    assert select_tagged(df, ["date_load", "a"], "t").columns == ["a", "source_table", "date_load"]
    with pytest.raises(ValueError, match=r"lacks required columns: \['x'\]"):
        select_tagged(df, ["a", "x"], "t")


def test_unreadable_pages_are_errors_or_set_aside(spark, lake):
    from reviewlake.sources import read_feed_pages, unreadable_pages

    good = '{"feed": {"entry": [{"id": {"label": "1"}}, {"id": {"label": "2"}}]}}'
    os.makedirs(lake, exist_ok=True)
    for name, text in (("a", good), ("b", good[:40]), ("c", '{"feed": {}}')):
        with open(f"{lake}/{name}.json", "w") as file:
            file.write(text)
    pages = read_feed_pages(spark, lake)
    with pytest.raises(Exception, match="unreadable feed page"):
        flatten_feed(pages).collect()
    assert [r.review_id for r in flatten_feed(pages, "quarantine").collect()] == ["1", "2"]
    assert [r.page for r in unreadable_pages(pages).collect()] == [good[:40]]


def test_the_app_lies_below_the_base(spark):
    path = "file:/lake/2024-02-10/feed/reviews/2024-02-10/alpha/p.json"
    df = spark.createDataFrame([(path,)], "path STRING")
    folder = app_folder(F.col("path"), "2024-02-10", "file:///lake/2024-02-10/feed/reviews")
    assert df.select(folder).first()[0] == "alpha"


def test_checked_scans_prune_partitions(spark, sf_dir):
    from __spark_entry__ import queries

    for name in ("scan_month", "scan_days_pruned"):
        plan = queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
        assert "date_load" in filters and "cast" not in filters.lower()
