import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.operators.flatten import flatten
from entityframe.operators.infer import (
    SchemaConflict,
    infer_schema,
    merge_schemas,
    parse_records,
    schema_paths,
    union_entities,
    variant_type,
)


def texts(spark, *records):
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "id int, json string")


def ddl(text):
    return T.StructType.fromDDL(text)


def test_types_and_nesting(spark):
    df = texts(spark, {"n": 1, "s": "x", "b": True, "f": 2.5, "o": {"a": {"b": [1, 2]}}})
    assert infer_schema(df, "json") == ddl(
        "b boolean, f double, n bigint, o struct<a: struct<b: array<bigint>>>, s string"
    )


def test_fractions_can_stay_decimal(spark):
    df = texts(spark, {"amt": 100.99}, {"amt": 5.123})
    schema = infer_schema(df, "json", decimals=True)
    assert schema == ddl("amt decimal(6,3)")
    assert [r.amt for r in parse_records(df, "json", schema).collect()] == [
        Decimal("100.990"),
        Decimal("5.123"),
    ]


def test_elements_that_differ_are_merged(spark):
    df = texts(spark, {"l": [{"a": 1}, {"b": "x"}]}, {"l": [{"c": True}]}, {"l": []})
    assert infer_schema(df, "json") == ddl("l array<struct<a: bigint, b: string, c: boolean>>")


def test_null_gives_way_to_any_later_value(spark):
    df = texts(spark, {"x": None, "y": [], "z": {}}, {"x": [{"y": 1}], "y": ["t"], "z": {"w": 1}})
    assert infer_schema(df, "json") == ddl(
        "x array<struct<y: bigint>>, y array<string>, z struct<w: bigint>"
    )


def test_unknown_stays_unknown_and_is_read_as_text(spark):
    df = texts(spark, {"x": None, "y": [], "z": {}, "k": 1})
    schema = infer_schema(df, "json")
    assert schema["x"].dataType == T.NullType()
    assert schema["y"].dataType == T.ArrayType(T.NullType())
    assert schema["z"].dataType == T.StructType([])
    later = infer_schema(texts(spark, {"x": {"v": 1}, "y": [2], "z": {"w": "s"}, "k": 2}), "json")
    assert merge_schemas(schema, later) == merge_schemas(later, schema) == later
    (row,) = parse_records(df, "json", schema, keep=["id"]).collect()
    assert row.asDict() == {"id": 0, "k": 1, "x": None, "y": [], "z": "{}"}


def test_first_rows_only_see_their_own_shape(spark):
    df = texts(spark, {"x": None, "k": 1}, {"x": {"v": 1}, "k": 2})
    assert infer_schema(df, "json", sample_rows=1, order_by=["id"])["x"].dataType == T.NullType()
    assert infer_schema(df, "json", sample_rows=2, order_by=["id"]) == infer_schema(df, "json")


def test_conflicts_fail_and_name_the_field(spark):
    df = texts(spark, {"a": {"b": [1]}}, {"a": {"b": [{"c": 1}]}})
    with pytest.raises(SchemaConflict, match=r"a\.b\[\]"):
        infer_schema(df, "json")
    schema = infer_schema(df, "json", on_conflict="string")
    assert schema == ddl("a struct<b: array<string>>")
    assert [r.a.b for r in parse_records(df, "json", schema).collect()] == [["1"], ['{"c":1}']]


def test_no_rows_and_no_objects_fail(spark):
    with pytest.raises(SchemaConflict, match="explicit schema"):
        infer_schema(texts(spark), "json")
    with pytest.raises(SchemaConflict, match="JSON objects"):
        infer_schema(texts(spark, [1, 2]), "json")


def test_field_names_with_punctuation(spark):
    df = texts(spark, {"a.b": 1, "c`d": {"e f": "x"}, "g:h,<i>": [2]})
    schema = infer_schema(df, "json")
    assert schema.names == ["a.b", "c`d", "g:h,<i>"]
    flat = flatten(parse_records(df, "json", schema), keep_nested=False, expand_arrays=True)
    assert tuple(flat.first()) == (1, "x", 2)
    assert flat.columns == ["a.b", "c`d_e f", "g:h,<i>_0"]


def test_variant_schema_text(spark):
    assert variant_type("OBJECT<`x y`: ARRAY<OBJECT<>>, d: DECIMAL(21,1)>", decimals=True) == T.StructType(
        [
            T.StructField("x y", T.ArrayType(T.StructType([]))),
            T.StructField("d", T.DecimalType(21, 1)),
        ]
    )


def test_merge_is_a_union_and_widens(spark):
    left = ddl("a int, s struct<x: int>, l array<struct<p: int>>, d decimal(5,2), f float")
    right = ddl("s struct<y: string>, l array<struct<q: int>>, a bigint, d decimal(6,4), f double, z date")
    assert merge_schemas(left, right) == ddl(
        """a bigint, s struct<x: int, y: string>, l array<struct<p: int, q: int>>,
        d decimal(7,4), f double, z date"""
    )
    with pytest.raises(SchemaConflict, match="s.x is int in one schema and string in another"):
        merge_schemas(left, ddl("s struct<x: string>"))


def test_union_of_entities_fills_fields_at_any_depth(spark):
    one = spark.createDataFrame([(1, (2,))], "k int, s struct<x: int>")
    two = spark.createDataFrame([(("y",), 3)], "s struct<y: string>, z int")
    got = union_entities(one, two).select("k", "s.x", "s.y", "z").collect()
    assert sorted(map(tuple, got), key=repr) == [(1, 2, None, None), (None, None, "y", 3)]


def test_paths_of_a_schema(spark):
    assert schema_paths(ddl("a struct<b: array<struct<c: int>>, d: array<array<string>>>, e struct<>")) == [
        ("a.b[].c", "int"),
        ("a.d[][]", "string"),
        ("e", "struct<>"),
    ]


def test_bad_json_fails(spark):
    df = spark.createDataFrame([("{",)], "json string")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        infer_schema(df, "json")
    assert df.select(F.col("json")).count() == 1
