from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from reviewlake.config import ColumnSpec, FlowConfig, Rule, build_schema, resolve_type
from reviewlake.sources import (
    config_from_documents,
    explode_rules,
    latest_config,
    load_flow_config,
    type_config_strings,
)
from reviewlake.sources.control import control_schema
from tests.conftest import rows


@pytest.mark.parametrize("name, expected", [
    ("STRING", T.StringType()), (" int ", T.IntegerType()), ("Integer", T.IntegerType()),
    ("long", T.LongType()), ("BIGINT", T.LongType()), ("double", T.DoubleType()),
    ("FLOAT", T.DoubleType()), ("boolean", T.BooleanType()), ("date", T.DateType()),
    ("timestamp", T.TimestampType()), ("decimal(10, 2)", T.DecimalType(10, 2)),
    ("DECIMAL", T.DecimalType(38, 18)), ("decimal(x)", T.DecimalType(38, 18)),
    ("", T.StringType()), (None, T.StringType()), ("geometry", T.StringType()),
])
def test_resolve_type(spark, name, expected):
    assert resolve_type(name) == expected


def test_resolve_nested_type(spark):
    assert resolve_type("array<struct<a: int>>") == T.ArrayType(
        T.StructType([T.StructField("a", T.IntegerType())]))


def test_dotted_names_become_structs():
    columns = [ColumnSpec("id", "BIGINT"), ColumnSpec("client.segment"),
               ColumnSpec("client.address.city"), ColumnSpec("client.score", "INT")]
    assert build_schema(columns).simpleString() == (
        "struct<id:bigint,client:struct<segment:string,address:struct<city:string>,score:int>>")
    assert build_schema(columns, nested=False).fieldNames()[1] == "client.segment"
    assert all(f.nullable for f in build_schema(columns).fields)


@pytest.mark.parametrize("names", [("client", "client.segment"), ("client.segment", "client")])
def test_value_and_struct_of_one_name_conflict(names):
    with pytest.raises(ValueError, match="both as value and as struct"):
        build_schema(ColumnSpec(n) for n in names)


def control_row(version, modified="2024-01-01 00:00:00", **changes):
    from datetime import datetime
    row = dict(
        version=version, source_layer="raw", table_name_target="reviews",
        schema_expected=[("id", "BIGINT", "")],
        schema_target=[("id", "BIGINT", True, False), ("month", "STRING", False, True)],
        schema_depara=[("source_id", "id")],
        rule_control=[("not_empty", "false", None), ("min_value", "2", None),
                      ("not_empty", "True", "id")],
        source_config={"format": "json", "directory": "in"}, target_config={"mode": "append"},
        fallback_config=None, last_modified=datetime.fromisoformat(modified))
    return tuple({**row, **changes}.values())


def test_latest_version_wins(spark):
    control = spark.createDataFrame(
        [control_row(1.0), control_row(1.1), control_row(1.1, "2024-03-01 00:00:00"),
         control_row(9.0, table_name_target="other")], control_schema())
    newest = latest_config(control).filter("table_name_target = 'reviews'")
    assert [(r.version, r.last_modified.month) for r in newest.collect()] == [(1.1, 3)]
    config = load_flow_config(control, "raw", "reviews")
    assert config.version == 1.1
    assert config.primary_key == ["id"] and config.zorder_columns == ["month"]
    assert config.mapping == {"id": "source_id"}
    assert config.rule("not_empty", "false") == "True" and config.rule_is_true("not_empty")
    assert config.required_columns == ["id"]
    assert config.rule("min_value", "1") == "2" and config.rule("max_value", "5") == "5"
    assert config.source["format"] == "json" and config.fallback == {}


def test_unknown_flow_is_an_error(spark):
    control = spark.createDataFrame([control_row(1.0)], control_schema())
    with pytest.raises(LookupError, match="nowhere"):
        load_flow_config(control, "raw", "nowhere")


def test_last_rule_of_a_name_wins(spark):
    control = spark.createDataFrame([control_row(1.0)], control_schema())
    assert sorted(rows(explode_rules(control))) == [
        ("raw", "reviews", "min_value", "2"), ("raw", "reviews", "not_empty", "True")]
    assert rows(explode_rules(spark.createDataFrame(
        [control_row(1.0, rule_control=None), control_row(1.0, rule_control=[])],
        control_schema()))) == []


DOCUMENT = {"flow_config": {
    "metadata": {"version": "1.1", "last_modified": "<unset>"},
    "data_layers": {"source_layer": "raw", "target_table": "feedback"},
    "schemas": {
        "schema_expected": [{"name_column": "client.segment", "type_column": "STRING", "other": ""}],
        "schema_target": [{"name_column": "client_segment", "type_column": "STRING"}]},
    "column_mapping": [{"source_column": "client.segment", "target_column": "client_segment"}],
    "control_rules": [{"rule": "not_empty", "value": "true"}],
    "configurations": {"source_config": {"format": "json", "directory": "x/"},
                       "target_config": {"mode": "append"},
                       "fallback_config": {"create_empty_if_missing": "true"}}}}


def test_document_becomes_a_control_row(spark):
    documents = spark.createDataFrame([(json.dumps(DOCUMENT),)], "document STRING")
    config = FlowConfig.from_row(config_from_documents(documents).first())
    assert config.version == 1.1 and config.last_modified is None
    assert config.target_table == "feedback"
    assert config.expected_schema.simpleString() == "struct<client:struct<segment:string>>"
    assert config.rules == (Rule("not_empty", "true", None),)
    assert config.required_columns == []
    assert config.fallback == {"create_empty_if_missing": "true"}


def test_json_strings_become_typed_columns(spark):
    d = DOCUMENT["flow_config"]
    row = ("1.1", "raw", "feedback", json.dumps(d["schemas"]["schema_expected"]),
           json.dumps(d["schemas"]["schema_target"]), json.dumps(d["column_mapping"]),
           json.dumps(d["control_rules"]), '[["format","json"],["directory","x/"]]', "[]", None,
           "2024-01-01")
    names = ("version source_layer table_name_target schema_expected schema_target schema_depara "
             "rule_control source_config target_config fallback_config last_modified").split()
    typed = type_config_strings(spark.createDataFrame([row], ", ".join(f"{n} STRING" for n in names)))
    config = FlowConfig.from_row(typed.first())
    assert config.source == {"format": "json", "directory": "x/"}
    assert config.sink == {} and config.fallback == {}
    assert config.mapping == {"client_segment": "client.segment"}
    assert config.last_modified.year == 2024
