"""What the plans must look like: pruned, pushed down, partitioned and free of Python."""

import re

import pytest
from pyspark.sql import functions as F

from entityframe.operators.flatten import flatten, largest_sizes
from entityframe.plans.queries import QUERIES
from entityframe.plans.records import invoices
from entityframe.sources.landing import shared_dir

# Python runs only where a Python data source is the feature.
PYTHON_SOURCES = {"format_load", "format_load_expanded"}


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def nested(spark, data):
    path = shared_dir(spark, "plans")
    invoices(spark, data).write.parquet(path)
    return spark.read.parquet(path)


def read_schema(df):
    return re.findall(r"ReadSchema: (.*)", plan(df))


def test_flat_columns_read_only_their_leaves(nested):
    flat = flatten(nested, expand_arrays=True, array_sizes={"line": 3})
    got = flat.select("line_2_l_partkey", "customer_ref_nation_name")
    assert read_schema(got) == [
        "struct<customer_ref:struct<nation:struct<name:string>>,line:array<struct<l_partkey:bigint>>>"
    ]
    assert "Exchange" not in plan(got)


def test_filters_on_flat_names_reach_the_scan(nested):
    flat = flatten(nested).where("customer_ref_value = 3")
    assert "EqualTo(customer_ref.value,3)" in plan(flat)


def test_array_widths_are_counted_from_one_leaf(nested):
    sizes = largest_sizes(nested.schema)
    got = nested.agg(*(F.max(size) for _, size in sizes))
    assert read_schema(got) == ["struct<line:array<struct<l_linenumber:int>>>"]


def test_nested_array_widths_prune_the_outer_elements(spark):
    path = shared_dir(spark, "plans-nested")
    df = spark.createDataFrame(
        [(1, [(7, "x", [(1, "p")])])], "id int, o array<struct<k: int, t: string, l: array<struct<a: int, b: string>>>>"
    )
    df.write.parquet(path)
    df = spark.read.parquet(path)
    (_, size) = largest_sizes(df.schema)[1]
    assert read_schema(df.agg(F.max(size))) == [
        "struct<o:array<struct<l:array<struct<a:int,b:string>>>>>"
    ]


def test_numbering_uses_one_shuffle_and_no_single_task(spark, data):
    text = plan(QUERIES["page_assign"](spark, data))
    assert len(re.findall(r"\) Exchange", text)) == 1
    assert "SinglePartition" not in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_flagship_shuffles_lines_once_and_prunes(spark, data):
    text = plan(QUERIES["sql_over_entity"](spark, data))
    assert len(re.findall(r"hashpartitioning\(l_orderkey", text)) == 1
    assert "l_discount" not in text and "o_totalprice" not in text


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_and_no_cross_product(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    if name not in PYTHON_SOURCES:
        assert not re.search(r"EvalPython|InPandas|InArrow|PythonDataSource|PythonRDD", text)
