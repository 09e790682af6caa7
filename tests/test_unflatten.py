"""Flat columns back to records: random records, ambiguous ones, and what cannot be rebuilt."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.functions.paths import FlattenError
from entityframe.operators.flatten import flatten
from entityframe.operators.unflatten import unflatten

DDL = """id int, ref struct<a_b: int, c: struct<d: string, e: array<int>>>, line array<struct<p: int,
  tags: array<string>, q: struct<r: double>>>, grid array<array<int>>, `odd name.x` struct<`y z`: int>"""


def value(rng, dtype):
    if rng.random() < 0.3:
        return None
    if isinstance(dtype, T.StructType):
        return tuple(value(rng, f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return [value(rng, dtype.elementType) for _ in range(rng.randrange(4))]
    return {"int": rng.randrange(9), "string": rng.choice("xyz"), "double": rng.random()}[dtype.simpleString()]


def normal(v):
    """What flat columns can tell: no empty structs or arrays, nothing after the last value."""
    if isinstance(v, tuple):
        v = tuple(map(normal, v))
        return None if all(x is None for x in v) else v
    if isinstance(v, list):
        v = [normal(x) for x in v]
        while v and v[-1] is None:
            v.pop()
        return v or None
    return v


def plain(v):
    if isinstance(v, (tuple, T.Row)):
        return tuple(map(plain, v))
    return [plain(x) for x in v] if isinstance(v, list) else v


@pytest.mark.parametrize("keep_nested", [True, False])
def test_random_records_come_back(spark, keep_nested):
    rng = random.Random(8)
    schema = T.StructType.fromDDL(DDL)
    rows = [(i, *(value(rng, f.dataType) for f in schema.fields[1:])) for i in range(300)]
    df = spark.createDataFrame(rows, schema)
    back = unflatten(flatten(df, expand_arrays=True, keep_nested=keep_nested))
    assert back.dtypes == df.dtypes
    got = {r.id: plain(r) for r in back.collect()}
    assert got == {r[0]: (r[0], *map(normal, r[1:])) for r in rows}


def test_arrays_that_were_not_expanded_and_further_columns_stay(spark):
    df = spark.createDataFrame([(1, (2, [3, 4]))], "id int, s struct<a: int, l: array<int>>")
    flat = flatten(df, array_sizes={"s.l": 0}, keep_nested=False).withColumn("more", F.lit("x"))
    assert [tuple(r) for r in unflatten(flat).collect()] == [(1, (2, [3, 4]), "x")]
    assert unflatten(df).collect() == df.collect()
    assert "Exchange" not in unflatten(flat)._jdf.queryExecution().executedPlan().toString()


def test_columns_that_contradict_each_other_are_refused(spark):
    def frame(*paths):
        cols = [F.lit(1).alias(f"c{i}", metadata={"source_path": p}) for i, p in enumerate(paths)]
        return spark.range(1).select(*cols)

    for paths, message in (
        (('["a"]', '["a"]'), "a is given twice"),
        (('["a"]', '["a", "b"]'), r"a\.b lies below c0"),
        (('["a", "b"]', '["a", 0]'), "both a field and an element"),
        (('["a", 1]',), "element 0 has no columns"),
    ):
        with pytest.raises(FlattenError, match=message):
            unflatten(frame(*paths))
