import json

import pytest
from pyspark.sql import types as T

from rillhouse.functions.messages import CDC_DATA, cdc_data_schema, log_schema
from rillhouse.functions.types import (SchemaError, dimension_meta, fields_of, load_schema_file,
                                       parse_type, schema_from_json)


def test_both_vocabularies():
    assert parse_type("bool") == parse_type("boolean") == T.BooleanType()
    assert parse_type("datetime") == parse_type("timestamp?") == T.TimestampType()
    assert parse_type("date") == T.DateType()


def test_nested_map_value_splits_at_top_level():
    kind = parse_type("map<string, map<int,array<double>>>")
    assert kind == T.MapType(T.StringType(),
                             T.MapType(T.IntegerType(), T.ArrayType(T.DoubleType())))


@pytest.mark.parametrize("text", ["map", "array", "decimal", "map<string>", "nowhere_struct"])
def test_unknown_types_are_refused(text):
    with pytest.raises(SchemaError):
        parse_type(text)


def test_struct_may_not_contain_itself():
    with pytest.raises(SchemaError):
        parse_type("a", {"a": [("x", "array<a>")]})


def test_schema_file_with_named_structs(tmp_path):
    text = json.dumps({"topic": "t", "schema": [
        {"name": "MAIN", "columns": [{"name": "id", "type": "string"},
                                     {"name": "items", "type": "array<item>?"}]},
        {"name": "item", "columns": [{"name": "n", "type": "int?"}]}]})
    path = tmp_path / "t.json"
    path.write_text(text)
    declared = load_schema_file(str(path))
    assert declared.topic == "t"
    assert declared == schema_from_json(text)
    assert declared.schema()["items"].dataType.elementType == declared.schema("item")
    assert [f.nullable for f in declared.schema()] == [False, True]


def test_fields_of_keeps_commas_inside_brackets():
    assert fields_of("a map<string,string>?, b int") == [("a", "map<string,string>?"), ("b", "int")]


def test_declared_messages_parse():
    for table in CDC_DATA:
        assert len(cdc_data_schema(table).fields) >= 3
    assert log_schema()["displays"].dataType.elementType["pos_id"].dataType == T.StringType()


def test_config_row():
    row = {"source_table": "s", "sink_table": "d", "row_key": "id", "partitionBy": None,
           "schema": '[{"name":"id","type":"string"},{"name":"at","type":"datetime?"}]',
           "column_family": "info", "to_hbase": 1}
    meta = dimension_meta(row)
    assert meta.keyed_store and meta.schema["at"].dataType == T.TimestampType()
    with pytest.raises(SchemaError):
        dimension_meta({**row, "row_key": "nope"})
