import collections
import random

import pytest
from pyspark.sql import functions as F

from entityframe.operators.flatten import array_profile, flatten
from entityframe.operators.parts import elements, with_offsets
from entityframe.options import OptionError
from entityframe.plans import records
from entityframe.sources import format as entity_format
from entityframe.sources.landing import shared_dir, write_landing
from entityframe.sources.reader import EntityReader

FIELDS = ["a", "b"]


def hot_rows(spark, seed=3):
    rng = random.Random(seed)
    rows = [(1 if i % 3 == 0 else rng.randrange(40), rng.randrange(6), float(rng.randrange(4))) for i in range(2000)]
    return rows, spark.createDataFrame(rows, "k int, a int, b double").repartition(5)


def expected_parts(rows, part_size):
    groups = collections.defaultdict(list)
    for k, *fields in rows:
        groups[k].append(tuple(fields))
    return {
        (k, at // part_size): sorted(members)[at : at + part_size]
        for k, members in groups.items()
        for at in range(0, len(members), part_size)
    }


def large_of(df, part_size):
    return records.large_groups(records.group_sizes(df, "k"), "k", part_size)


@pytest.mark.parametrize("part_size", [1, 7, 64, 5000])
def test_groups_with_copies_are_cut_into_whole_parts(spark, part_size):
    rows, df = hot_rows(spark)
    large = large_of(df, part_size)
    if part_size == 64:
        assert [r.k for r in large.collect()] == [1]
    assert (large is None) == (part_size == 5000)
    got = records.nest(df, "k", FIELDS, "members", part_size, large=large).collect()
    assert {(r.k, r.part_no): [tuple(m) for m in r.members] for r in got} == expected_parts(
        rows, part_size
    )
    assert len(got) == len({(r.k, r.part_no) for r in got})


def test_a_large_group_without_a_key(spark):
    rows = [(None if i % 2 else i, i % 4, float(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, a int, b double")
    large = large_of(df, 10)
    assert [r.k for r in large.collect()] == [None]
    got = records.nest(df, "k", FIELDS, "members", 10, large=large).collect()
    assert {(r.k, r.part_no): [tuple(m) for m in r.members] for r in got} == expected_parts(rows, 10)


@pytest.mark.parametrize("derived", [True, False])
@pytest.mark.parametrize("part_size", [9, 5000])
def test_unique_members_keep_array_fields(spark, part_size, derived):
    df = spark.range(300).select(
        (F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)).alias("k"),
        "id",
        F.array("id", F.col("id") + 1).alias("items"),
    )
    got = records.nest(
        df,
        "k",
        ["items", "id"],
        "members",
        part_size,
        unique_by=["id"],
        large=large_of(df, part_size),
        derived=derived,
    ).collect()
    members = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r.k, r.part_no)):
        assert len(r.members) <= part_size
        members[r.k] += [m.id for m in r.members]
        assert all(m["items"] == [m.id, m.id + 1] for m in r.members)
    assert members == {
        k: [i for i in range(300) if (0 if i % 3 == 0 else i % 7) == k] for k in members
    }
    assert sum(map(len, members.values())) == 300


@pytest.mark.parametrize("size", [1, 3, 100])
def test_parts_rejoin_to_the_same_invoices(spark, data, monkeypatch, size):
    monkeypatch.setattr(records, "table", hot_table)
    lines = collections.defaultdict(list)
    for r in hot_table(spark, data, "lineitem").select("l_orderkey", *records.LINE_FIELDS).collect():
        lines[r[0]].append(tuple(r[1:]))
    got = collections.defaultdict(dict)
    for r in records.invoices(spark, data, part_size=size).select("o_orderkey", "part_no", "line").collect():
        assert r.part_no not in got[r.o_orderkey]
        assert r.line is None or len(r.line) <= size
        got[r.o_orderkey][r.part_no] = [tuple(m) for m in r.line or []]
    orders = [r[0] for r in hot_table(spark, data, "orders").select("o_orderkey").collect()]
    assert set(got) == set(orders)
    for order, parts in got.items():
        assert sorted(parts) == list(range(len(parts)))
        assert sum((parts[i] for i in range(len(parts))), []) == sorted(lines[order])


def hot_table(spark, sf_dir, name):
    """A third of all lines in one order, a third of all orders with one customer; copies kept."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name == "lineitem":
        hot = F.pmod(F.xxhash64("*"), F.lit(3)) == 0
        return df.withColumn("l_orderkey", F.when(hot, F.lit(7)).otherwise(F.col("l_orderkey")))
    if name == "orders":
        hot = F.col("o_orderkey") % 3 == 0
        return df.withColumn("o_custkey", F.when(hot, F.lit(11)).otherwise(F.col("o_custkey")))
    return df


def test_a_group_of_250_is_one_record_of_250(spark, data, monkeypatch):
    def wide_table(session, sf_dir, name):
        df = session.read.parquet(f"{sf_dir}/{name}.parquet")
        if name == "lineitem":
            df = df.where("l_orderkey <> 7").limit(500).union(
                df.where("l_linenumber = 1").limit(250).withColumn("l_orderkey", F.lit(7).cast("bigint")).select(df.columns)
            )
        return df

    monkeypatch.setattr(records, "table", wide_table)
    sizes = {r.path: r.max_size for r in array_profile(records.invoices(spark, data)).collect()}
    assert sizes == {"line": 250}
    wide = flatten(records.invoices(spark, data).select("o_orderkey", "line"), expand_arrays=True, max_flat_columns=2000)
    assert wide.where("o_orderkey = 7 and line_249_l_partkey is not null").count() == 1


def test_accounts_hold_every_order_part_once(spark, data, monkeypatch):
    monkeypatch.setattr(records, "table", hot_table)
    inv = records.invoices(spark, data, part_size=5).collect()
    orders = collections.defaultdict(list)
    for order, customer in sorted({(r.o_orderkey, r.customer_ref.value) for r in inv}):
        orders[customer].append(order)
    lines = {(r.o_orderkey, r.line_offset): [tuple(m) for m in r.line or []] for r in inv}
    acc = records.accounts(spark, data, part_size=6, line_part_size=5).collect()
    customers = {r[0] for r in hot_table(spark, data, "customer").select("c_custkey").collect()}
    assert {r.c_custkey for r in acc} == customers
    assert {r.c_custkey for r in acc if r.order is None} == customers - set(orders)
    assert max(len(r.order or []) for r in acc) == 6
    assert len(acc) == len({(r.c_custkey, r.order_offset, r.line_offset) for r in acc})
    seen = {}
    for r in acc:
        for i, o in enumerate(r.order or []):
            # Each order has its place among its customer's, however many parts its lines are in.
            assert orders[r.c_custkey][r.order_offset + i] == o.o_orderkey
            assert (o.o_orderkey, r.line_offset) not in seen
            seen[o.o_orderkey, r.line_offset] = [tuple(m) for m in o.line or []]
    assert seen == lines


def true_sizes(spark, data):
    lines = hot_table(spark, data, "lineitem").groupBy("l_orderkey").count()
    orders = hot_table(spark, data, "orders").groupBy("o_custkey").count()
    return {
        "line": lines.agg(F.max("count")).first()[0],
        "order": orders.agg(F.max("count")).first()[0],
    }


@pytest.mark.parametrize("size", [3, 50, 10_000])
def test_sizes_and_indexes_are_those_of_the_whole_group(spark, data, monkeypatch, size):
    monkeypatch.setattr(records, "table", hot_table)
    true = true_sizes(spark, data)
    assert true["line"] > 1000 and true["order"] > 300
    inv = records.invoices(spark, data, part_size=size)
    assert {r.path: r.max_size for r in array_profile(inv, {("line",): "line_offset"}).collect()} == {"line": true["line"]}
    acc = records.accounts(spark, data, part_size=size, line_part_size=size)
    offsets = {("order",): "order_offset", ("order", "line"): "line_offset"}
    got = {r.path: r.max_size for r in array_profile(acc, offsets).collect()}
    assert got == {"order": true["order"], "order.line": true["line"]}
    assert inv.agg(F.max("line_size")).first()[0] == true["line"]

    # Column line_120 is the 121st line of the order, in whichever part it lies.
    narrow = inv.select("o_orderkey", "line_offset", "line").where("o_orderkey = 7")
    wide = flatten(narrow, expand_arrays=True, array_sizes={"line": 121}, array_offsets={"line": "line_offset"})
    ordered = sorted(
        tuple(r) for r in hot_table(spark, data, "lineitem").where("l_orderkey = 7").select(*records.LINE_FIELDS).collect()
    )
    for i in (0, 2, 3, 7, 120):
        names = [f"line_{i}_{f}" for f in records.LINE_FIELDS]
        found = [tuple(r) for r in wide.where(f"line_{i}_l_partkey is not null").select(*names).collect()]
        assert found == [ordered[i]]


def test_nested_indexes_across_parts(spark, data, monkeypatch):
    monkeypatch.setattr(records, "table", hot_table)
    acc = records.accounts(spark, data, part_size=2, line_part_size=2)
    offsets = {("order",): "order_offset", ("order", "line"): "line_offset"}
    flat = flatten(acc, expand_arrays=True, array_sizes={"order": 5, "order.line": 4}, array_offsets=offsets)
    whole = records.accounts(spark, data)
    plain = flatten(whole, expand_arrays=True, array_sizes={"order": 5, "order.line": 4})
    names = [f"order_{i}_line_{j}_l_partkey" for i in range(5) for j in range(4)]
    cells = [F.max(n).alias(n) for n in names]

    def cells_of(df):
        return sorted(map(tuple, df.groupBy("c_custkey").agg(*cells).collect()))

    assert cells_of(flat) == cells_of(plain)
    assert flat.agg(*(F.max(n) for n in names)).first()[-1] is not None


@pytest.mark.parametrize("buckets_rows", [1, 400])
def test_offsets_of_uneven_parts(spark, buckets_rows):
    rng = random.Random(buckets_rows)
    rows = [(k, p, [rng.randrange(9)] * rng.choice([0, 1, 4, 30])) for k in (1, 2, None) for p in range(buckets_rows)]
    rows += [(5, 1, None), (5, 0, [7]), (5, 2, [8, 9])]
    df = spark.createDataFrame(rows, "k int, p int, a array<int>").repartition(3)
    got = with_offsets(df, ["k"], ["p"], "a", "a_offset").collect()
    expected, before = {}, collections.Counter()
    for k, p, a in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        expected[k, p] = before[k]
        before[k] += len(a or [])
    assert {(r.k, r.p): r.a_offset for r in got} == expected and len(got) == len(rows)
    at = elements(spark.createDataFrame(got), "a", "a_offset").where("k = 5").collect()
    assert sorted((r.element_index, r.element) for r in at) == [(0, 7), (1, 8), (2, 9)]
    with pytest.raises(OptionError, match="already"):
        with_offsets(df, ["k"], ["p"], "a", "P")


def test_landed_parts_are_read_with_their_places(spark):
    rows = [(1, 0, [10, 11]), (1, 2, [12, 13]), (1, 4, [14]), (2, 0, [20])]
    df = spark.createDataFrame(rows, "id int, before int, tag array<int>")
    root = shared_dir(spark, "parts")
    write_landing(df, root, "e", "C", ["id", "before"], array_offsets={"tag": "before"})
    reader = EntityReader(spark).options(path=root, companyId="C", entity="e", expandArrays=True)
    got = {(r.id, r.before): [r[f"tag_{i}"] for i in range(5)] for r in reader.load().collect()}
    assert reader.load().columns == ["id", "before", "tag", *(f"tag_{i}" for i in range(5))]
    assert got == {
        (1, 0): [10, 11, None, None, None],
        (1, 2): [None, None, 12, 13, None],
        (1, 4): [None] * 4 + [14],
        (2, 0): [20] + [None] * 4,
    }
    entity_format.register(spark)
    with pytest.raises(Exception, match="EntityReader"):
        spark.read.format("entity_pages").options(companyId="C", entity="e", expandArrays=True).load(root).schema
    for bad in ({"tags": "before"}, {"tag": "tag"}, {"tag": "nothing"}):
        with pytest.raises(OptionError, match="arrayOffsets"):
            flatten(df, expand_arrays=True, array_sizes={"tag": 2}, array_offsets=bad)
