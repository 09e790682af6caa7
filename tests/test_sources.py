import datetime
import decimal
import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from compare import ROOT
from entityframe.options import OptionError
from entityframe.plans import records
from entityframe.sources import format as entity_format
from entityframe.sources import paging
from entityframe.sources.landing import shared_dir, write_landing
from entityframe.sources.reader import EntityReader, companies


def numbered(spark, count):
    return spark.range(count).withColumn("v", F.col("id") * 2)


# --- paging --------------------------------------------------------------------------------


def test_pages_of_2501_rows(spark):
    got = paging.page_manifest(spark, 2501).orderBy("page_no").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1000), (1, 1001, 1000), (2, 2001, 501)]


def test_batches_of_30001_rows(spark):
    got = paging.batch_manifest(spark, 30001).orderBy("batch_no").collect()
    assert [tuple(r) for r in got] == [(0, 30, 30000), (1, 1, 1)]
    assert paging.page_manifest(spark, 30001).count() == 31


def test_nothing_to_page(spark):
    assert paging.page_manifest(spark, 0).count() == 0
    assert paging.batch_manifest(spark, 0).count() == 0
    assert paging.assign_pages(numbered(spark, 0), ["id"]).count() == 0


def test_manifest_is_made_in_parallel(spark):
    assert paging.page_manifest(spark, 10**13).rdd.getNumPartitions() > 1


def test_assignment_agrees_with_the_manifest(spark):
    paged = paging.assign_pages(numbered(spark, 2501), ["id"], 100, 10)
    counts = paged.groupBy("page_no").agg(
        F.min("position").alias("start_position"), F.count("*").alias("max_results")
    )
    assert counts.exceptAll(paging.page_manifest(spark, 2501, 100)).count() == 0
    batches = paged.groupBy("batch_no").agg(
        F.count_distinct("page_no").alias("pages"), F.count("*").alias("row_count")
    )
    assert batches.exceptAll(paging.batch_manifest(spark, 2501, 100, 10)).count() == 0


def test_count_and_envelope(spark):
    assert paging.entity_count(numbered(spark, 7)).first()[0] == 7
    assert tuple(paging.scan_envelope(numbered(spark, 7)).first()) == (1, 7, 7)


def test_sample(spark):
    df = numbered(spark, 50)
    assert [r.id for r in paging.sample_records(df, ["id"], 2).collect()] == [0, 1]
    assert paging.sample_records(df, [], "all").count() == 50


# --- landing and reading -------------------------------------------------------------------


@pytest.fixture(scope="module")
def landed(spark):
    """Two companies and both environments of ``item``; ids that look like numbers."""
    root = shared_dir(spark, "test")
    items = numbered(spark, 1000).withColumn(
        "tags", F.when(F.col("id") % 3 != 0, F.slice(F.array(F.lit("a"), F.lit("b")), 1, F.col("id").cast("int") % 3))
    )
    company = F.format_string("%03d", F.when(F.col("id") % 3 == 0, 7).otherwise(1))
    write_landing(items, root, "item", company, ["id"], page_size=50, batch_size=2, batches_per_file=1)
    write_landing(items.where("id < 5"), root, "item", "001", ["id"], production=True)
    return root


def reader(spark, root, company="001", **options):
    return EntityReader(spark).options(path=root, companyId=company, entity="item", **options)


def test_each_company_is_paged_on_its_own(spark, landed):
    for company, rest in (("007", [0]), ("001", [1, 2])):
        expected = [i for i in range(1000) if i % 3 in rest]
        pages = paging.reassemble(reader(spark, landed, company).pages())
        got = [(r.page_no * 50 + r.pos_in_page, r.id) for r in pages.collect()]
        assert got == list(enumerate(expected))


def test_environments_are_separate(spark, landed):
    assert reader(spark, landed, production=True).load().count() == 5


def test_company_filter_prunes_directories(spark, landed):
    schema = reader(spark, landed).record_schema()
    df = companies(spark, landed, "item", schema).where("env = 'sandbox' and company_id = '007'")
    assert df.count() == 334
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(company_id" in plan or "company_id" in plan.split("PartitionFilters")[1].split("]")[0]
    assert {r[0] for r in df.select("table_name").distinct().collect()} == {"007:item"}


def test_landing_again_replaces_the_pages(spark):
    root = shared_dir(spark, "again")
    for count in (20, 12):
        write_landing(numbered(spark, count), root, "item", "9", ["id"])
    assert reader(spark, root, "9").load().count() == 12


def test_an_empty_entity_keeps_its_landed_schema(spark):
    root = shared_dir(spark, "empty")
    write_landing(spark.range(0).withColumn("l", F.array("id")), root, "item", "1", ["id"])
    got = reader(spark, root, "1", expandArrays=True, keepNested=False).load()
    assert got.columns == ["id", "l"] and got.count() == 0
    entity_format.register(spark)
    loaded = spark.read.format("entity_pages").options(companyId="1", entity="item").load(root)
    assert loaded.columns == ["id", "l"] and loaded.count() == 0


def test_reader_counts_and_plans_pages(spark, landed):
    load = reader(spark, landed, pageSize=100, batchSize=4)
    assert tuple(load.envelope().first()) == (1, 666, 666)
    assert load.page_manifest().count() == 7
    assert [tuple(r) for r in load.batch_manifest().orderBy("batch_no").collect()] == [
        (0, 4, 400),
        (1, 3, 266),
    ]


def test_reader_flattens(spark, landed):
    df = reader(spark, landed, expandArrays="true", keepNested="false").load()
    assert df.columns == ["id", "v", "tags_0", "tags_1"]
    assert tuple(df.where("id = 2").first()) == (2, 4, "a", "b")
    first = reader(
        spark, landed, expandArrays=True, arraySizes="first", orderBy="id", keepNested=False
    ).load()
    assert first.columns == ["id", "v", "tags_0"]


def test_widths_come_from_the_landing_without_a_job(spark, landed):
    spark.sparkContext.setJobGroup("widths", "")
    load = reader(spark, landed, expandArrays=True)
    ids = spark.sparkContext.statusTracker().getJobIdsForGroup
    load.load()
    tasks = sum(
        spark.sparkContext.statusTracker().getStageInfo(stage).numTasks
        for job in ids("widths")
        for stage in spark.sparkContext.statusTracker().getJobInfo(job).stageIds
    )
    assert tasks <= 4  # manifest lookups only


def test_first_by_another_key_is_looked_up(spark, landed):
    options = dict(expandArrays=True, arraySizes="first", keepNested=False)
    assert reader(spark, landed, **options).load().columns == ["id", "v", "tags_0"]
    by_tags = reader(spark, landed, orderBy="tags,id", **options).load()
    assert by_tags.columns == ["id", "v", "tags_0"]
    company7 = reader(spark, landed, "007", **options).load()
    assert company7.columns == ["id", "v", "tags"]


def test_explicit_schema_fills_missing_fields(spark, landed):
    df = reader(spark, landed).schema("id bigint, memo string").load()
    assert df.columns == ["id", "memo"]
    assert df.where("memo is not null").count() == 0


def test_view(spark, landed):
    name = reader(spark, landed).load_view()
    assert name == "t_001_item"
    assert spark.sql(f"select count(*) from {name}").first()[0] == 666


def test_missing_options_and_entities(spark, landed):
    with pytest.raises(OptionError, match="path"):
        EntityReader(spark).option("companyId", "1").load()
    with pytest.raises(OptionError, match="companyId"):
        EntityReader(spark).option("path", landed).load()
    with pytest.raises(OptionError, match="999:item"):
        reader(spark, landed, "999").load()


def test_clashing_record_fields_are_refused(spark):
    with pytest.raises(OptionError, match="page_no"):
        write_landing(spark.range(3).withColumn("Page_No", F.lit(1)), "/none", "x", "1", ["id"])


def test_names_that_cannot_be_directories_are_refused(spark):
    root = shared_dir(spark, "names")
    with pytest.raises(OptionError, match="company id '../x'"):
        write_landing(spark.range(3), root, "item", "../x", ["id"])
    with pytest.raises(OptionError, match="entity 'a/b'"):
        EntityReader(spark).options(path=root, companyId="1", entity="a/b").load()
    for company in (F.lit("a:b"), F.lit(None)):
        with pytest.raises(Exception, match="no directory can be named after company id (a:b|null)"):
            write_landing(spark.range(3), root, "item", company, ["id"])


# --- registered format ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def invoices(spark, data):
    root = shared_dir(spark, "test-invoice")
    typed = records.invoices(spark, data).withColumns(
        {
            "due": F.when(F.col("o_orderkey") % 5 != 0, F.to_date("o_orderdate")),
            "at": F.timestamp_micros(F.col("o_orderkey") * 1_234_567 - 500_000_001),
            "amt": F.col("o_totalprice").cast("decimal(14,3)"),
            "log": F.when(
                F.col("o_orderkey") % 4 != 0,
                F.struct(
                    F.array(F.struct(F.to_date("o_orderdate").alias("d"), F.lit(None).cast("int").alias("n"))).alias("e")
                ),
            ),
        }
    )
    write_landing(typed, root, "invoice", "5", ["o_orderkey", "part_no"], page_size=100, batch_size=2, batches_per_file=1, derived=True)
    return root


OPTIONS = [
    {},
    {"expandStructs": "false"},
    {"expandArrays": "true"},
    {"expandArrays": "true", "arraySizes": "first", "orderBy": "o_orderkey,part_no"},
    {"expandArrays": "true", "keepNested": "false", "arraySizes": '{"line": 2, "log.e": 0}'},
    {"dates": "native"},
    {"decimalType": "decimal(10,0)"},
]


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_format_equals_the_native_reader(spark, invoices, options):
    entity_format.register(spark)
    base = {"companyId": "5", "entity": "invoice", **options}
    native = EntityReader(spark).options(path=invoices, **base).load()
    loaded = spark.read.format("entity_pages").options(**base).load(invoices)
    assert loaded.columns == native.columns
    assert [f.dataType.simpleString() for f in loaded.schema] == [
        f.dataType.simpleString() for f in native.schema
    ]
    assert loaded.exceptAll(native).count() == 0
    assert loaded.count() == native.count() > 0


def random_value(rng, dtype):
    if rng.random() < 0.2:
        return None
    if isinstance(dtype, T.StructType):
        return tuple(random_value(rng, f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return [random_value(rng, dtype.elementType) for _ in range(rng.randrange(4))]
    if isinstance(dtype, T.MapType):
        return {k: random_value(rng, dtype.valueType) for k in "ab"[: rng.randrange(3)]}
    moment = datetime.datetime(1969, 12, 31, 23) + datetime.timedelta(microseconds=rng.randrange(10**10))
    return {
        "int": rng.randrange(-9, 9),
        "string": rng.choice(["", "x", "y_z"]),
        "boolean": rng.random() < 0.5,
        "double": rng.random(),
        "decimal(9,4)": decimal.Decimal(rng.randrange(-(10**9), 10**9)).scaleb(-4),
        "date": moment.date(),
        "timestamp_ntz": moment,
        "binary": b"\x00z",
    }[dtype.simpleString()]


@pytest.mark.parametrize("extra", [{}, {"dates": "native"}, {"decimalType": "decimal(6,1)"}], ids=str)
def test_format_equals_the_native_reader_on_random_records(spark, extra):
    rng = random.Random(5)
    leaf = "n: int, s: string, b: boolean, d: double, m: decimal(9,4), t: date, z: timestamp_ntz, y: binary"
    ddl = f"id int, r struct<{leaf}, l: array<struct<{leaf}>>, k: map<string, int>>, a array<array<struct<{leaf}>>>, p array<date>"
    schema = T.StructType.fromDDL(ddl)
    rows = [(i, *(random_value(rng, f.dataType) for f in schema.fields[1:])) for i in range(200)]
    root = shared_dir(spark, "random")
    write_landing(
        spark.createDataFrame(rows, schema), root, "item", "1", ["id"], page_size=20, batch_size=1, batches_per_file=1
    )
    entity_format.register(spark)
    for expand in ({}, {"expandArrays": "true", "keepNested": "false"}):
        options = {"companyId": "1", "entity": "item", **expand, **extra}
        loaded = spark.read.format("entity_pages").options(**options).load(root)
        native = EntityReader(spark).options(path=root, **options).load()
        assert loaded.dtypes == native.dtypes
        assert sorted(map(repr, loaded.collect())) == sorted(map(repr, native.collect()))


def test_format_reads_files_in_parallel(spark, invoices):
    loaded = spark.read.format("entity_pages").options(companyId="5", entity="invoice").load(invoices)
    assert loaded.rdd.getNumPartitions() > 1


def test_format_with_a_stated_schema(spark, invoices):
    loaded = (
        spark.read.format("entity_pages")
        .options(companyId="5", entity="invoice")
        .schema("memo string, customer_ref_name string, o_orderkey bigint")
        .load(invoices)
    )
    assert loaded.where("memo is null and customer_ref_name is not null").count() == loaded.count()


def test_format_works_where_the_package_is_not_installed(invoices, tmp_path):
    script = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
from entityframe.sources.format import register
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
register(spark)
df = spark.read.format("entity_pages").options(companyId="5", entity="invoice", expandArrays="true").load({invoices!r})
print("rows", df.count() > 0, len(df.columns) > 20)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "rows True True" in done.stdout, done.stderr[-2000:]


def test_manifest_states_what_was_landed(spark, invoices):
    from entityframe.options import ScanOptions

    state = entity_format.read_state(
        ScanOptions.from_options({"path": invoices, "companyId": "5", "entity": "invoice"})
    )
    assert state.page_size == 100 and state.batch_size == 2 and state.version == 1
    assert state.order_by == "o_orderkey,part_no"
    assert {tuple(e["path"]) for e in json.loads(state.max_sizes)} == {("line",), ("log", "e")}


# --- JSON pages ----------------------------------------------------------------------------


def test_json_lines_are_inferred_over_all_records(spark):
    root = shared_dir(spark, "json")
    lines = ['{"id": 1, "ref": null}', '{"id": 2, "ref": {"v": 5}, "tags": ["a", "b"]}', '{"id": 3, "tags": []}']
    for company, rows in (("01", lines), ("1", lines[:1])):
        spark.createDataFrame([(x,) for x in rows], "value string").repartition(2).write.text(
            f"{root}/item/env=sandbox/company_id={company}"
        )
    load = lambda company, **more: reader(
        spark, root, company, fileFormat="json", expandArrays=True, keepNested=False, **more
    ).load()
    got = load("01")
    assert got.columns == ["id", "ref_v", "tags_0", "tags_1"]
    assert sorted(map(tuple, got.collect())) == [(1, None, None, None), (2, 5, "a", "b"), (3, None, None, None)]
    assert load("1").columns == ["id", "ref"]
    assert load("1", schema="id bigint, ref struct<v: int>").columns == ["id", "ref_v"]
    with pytest.raises(OptionError, match="2:item"):
        load("2")


def test_json_null_and_blank_lines_do_not_end_the_read(spark):
    root = shared_dir(spark, "json-null")
    rows = ['{"id": 1}', "null", "", '{"id": 2}']
    spark.createDataFrame([(x,) for x in rows], "value string").coalesce(1).write.text(
        f"{root}/item/env=sandbox/company_id=1"
    )
    got = reader(spark, root, "1", fileFormat="json").load()
    assert sorted(map(tuple, got.collect()), key=repr) == [(1,), (2,), (None,)]


def test_json_schema_from_the_first_records_by_key(spark):
    root = shared_dir(spark, "json-first")
    rows = ['{"id": 10, "x": 1}', '{"id": 9, "y": 2}', '{"id": 11, "z": 3}']
    spark.createDataFrame([(x,) for x in rows], "value string").write.text(
        f"{root}/item/env=sandbox/company_id=1"
    )
    load = lambda **more: reader(spark, root, "1", fileFormat="json", **more).load()
    assert load(sampleRows=1, orderBy="id").columns == ["id", "y"]
    assert load(sampleRows=2, orderBy="id").columns == ["id", "x", "y"]
    assert load().columns == ["id", "x", "y", "z"]
    with pytest.raises(OptionError, match="orderBy"):
        load(sampleRows=1)


def test_json_fractions_are_exact_under_a_stated_decimal_type(spark):
    root = shared_dir(spark, "json-decimal")
    spark.createDataFrame([('{"amt": 100.99}',), ('{"amt": 5.123}',)], "value string").write.text(
        f"{root}/item/env=sandbox/company_id=1"
    )
    load = lambda **more: reader(spark, root, "1", fileFormat="json", **more).load()
    assert load().dtypes == [("amt", "double")]
    assert load(decimalType="source").dtypes == [("amt", "decimal(6,3)")]
    whole = load(decimalType="decimal(10,0)")
    assert whole.dtypes == [("amt", "decimal(10,0)")]
    assert sorted(int(r.amt) for r in whole.collect()) == [5, 101]
