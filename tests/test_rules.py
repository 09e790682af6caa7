"""Rules across modules: companies landed together and apart, JSON answers, inference, widths."""

import json

import pytest
from pyspark.sql import functions as F

from entityframe import EntityReader, write_landing
from entityframe.functions.numbering import number_rows
from entityframe.operators.infer import SchemaConflict, infer_schema, union_entities
from entityframe.options import OptionError
from entityframe.sources import format as entity_format
from entityframe.sources import log
from entityframe.sources.landing import entity_path, shared_dir, tenant_path


def reader(spark, root, entity="e", company="C", **options):
    return EntityReader(spark).options(path=root, companyId=company, entity=entity, **options)


def json_lines(spark, purpose, lines, entity="e"):
    root = shared_dir(spark, purpose)
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(tenant_path(root, entity, "sandbox", "C"))
    return root


def test_three_companies_two_landings_keep_their_own_schema(spark):
    root = shared_dir(spark, "three")
    secret = spark.range(5).withColumn("secret", F.lit("s"))
    write_landing(secret, root, "e", F.lit("C"), ["id"], page_size=2)
    others = spark.range(10).withColumn("other", F.lit(1)).withColumn("co", F.when(F.col("id") < 5, "A").otherwise("B"))
    write_landing(others, root, "e", F.col("co"), ["id"], page_size=3)
    assert reader(spark, root).load().columns == ["id", "secret"]
    assert reader(spark, root, company="A").load().columns == ["id", "other", "co"]
    for company, size, rows in (("C", 2, 5), ("A", 3, 5), ("B", 3, 5)):
        state = log.company_state(spark, entity_path(root, "e"), "sandbox", company)
        assert (state.page_size, state.records) == (size, rows)


def test_landing_no_rows_by_company_lands_nothing(spark):
    root = shared_dir(spark, "none")
    write_landing(spark.range(0), root, "e", F.lit("C"), ["id"])
    with pytest.raises(OptionError, match="no pages"):
        reader(spark, root).load()


def test_a_frame_that_changes_between_reads_is_refused(spark):
    root = shared_dir(spark, "changing")
    drawn = F.expr("cast(reflect('java.lang.Math', 'random') as double)")
    changing = spark.range(3000).select((F.col("id") + 3000 * F.floor(drawn * 10**6)).alias("id"))
    with pytest.raises(Exception, match="positions are not|not unique"):
        write_landing(changing, root, "e", "C", ["id"])


def answer(start, rows, total):
    entities = [{"id": i, "tags": ["a"] * (i % 3)} for i in rows]
    return json.dumps({"entities": entities, "startPosition": start, "maxResults": len(entities), "totalCount": total})


def test_api_answers_are_pages(spark):
    root = json_lines(spark, "answers", [answer(3, [30, 40], 5), answer(1, [10, 20], 5), answer(5, [50], 5)])
    r = reader(spark, root, fileFormat="json", jsonPages=True, pageSize=2)
    got = r.pages().orderBy("page_no", "pos_in_page").collect()
    assert [(x.id, x.page_no, x.pos_in_page) for x in got] == [(10, 0, 0), (20, 0, 1), (30, 1, 0), (40, 1, 1), (50, 2, 0)]
    assert tuple(r.envelope().first()) == (1, 5, 5)
    assert r.load().columns == ["id", "tags"]


def test_an_answer_without_a_total_is_a_single_record(spark):
    root = json_lines(spark, "single", ['{"entities": [{"id": 1}]}'])
    assert tuple(reader(spark, root, fileFormat="json", jsonPages=True).envelope().first()) == (1, 1, 1)


def test_wide_numbers_keep_their_digits(spark):
    lines = ['{"a": 12345678901234567890, "b": 1234567890123456.78, "c": 1.5}']
    (row,) = reader(spark, json_lines(spark, "wide", lines), fileFormat="json", decimalType="source").load().collect()
    assert (str(row.a), str(row.b)) == ("12345678901234567890", "1234567890123456.78")
    df = spark.createDataFrame([(x,) for x in lines], "j string")
    assert infer_schema(df, "j")["c"].dataType.simpleString() == "double"


def test_names_that_differ_by_case_are_refused_or_kept_apart(spark):
    df = spark.createDataFrame([('{"x": {"Id": 1}}',), ('{"x": {"id": 2}}',)], "j string")
    with pytest.raises(SchemaConflict, match="x has both Id and id"):
        infer_schema(df, "j")
    with pytest.raises(SchemaConflict, match="Id and id"):
        union_entities(spark.range(1).withColumnRenamed("id", "Id"), spark.range(1))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert [f.name for f in infer_schema(df, "j")["x"].dataType.fields] == ["Id", "id"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_one_drifting_field_is_read_as_text(spark):
    root = json_lines(spark, "drift", ['{"id": 1, "v": 5}', '{"id": 2, "v": {"w": 1}}'])
    with pytest.raises(SchemaConflict, match="v has values"):
        reader(spark, root, fileFormat="json").load()
    got = reader(spark, root, fileFormat="json", onConflict="string").load().orderBy("id").collect()
    assert [r.v for r in got] == ["5", '{"w":1}']
    with pytest.raises(OptionError, match="onConflict"):
        reader(spark, root, onConflict="maybe").load()


def test_samples_skip_null_records_and_put_missing_keys_last(spark):
    root = json_lines(spark, "sample", ["null", '{"other": 1}', '{"id": 2, "late": 1}', '{"id": 1, "early": "x"}'])
    r = reader(spark, root, fileFormat="json", sampleRows=1, orderBy="id")
    assert r.record_schema().fieldNames() == ["early", "id"]


def test_a_stated_schema_reads_an_entity_that_was_never_landed(spark):
    root = shared_dir(spark, "never")
    r = reader(spark, root, schema="id bigint, ref struct<value: bigint>, tags array<string>", expandArrays=True)
    assert r.load().columns[:4] == ["id", "ref", "tags", "ref_value"] and r.load().count() == 0
    assert reader(spark, root, schema="id bigint", fileFormat="json").load().count() == 0
    with pytest.raises(OptionError, match="no pages"):
        reader(spark, root).load()


def test_a_schema_is_inferred_once_per_reader(spark):
    root = json_lines(spark, "once", ['{"id": 1}', '{"id": 2}'])
    r = reader(spark, root, fileFormat="json")
    calls = []
    infer = r._infer_json
    r._infer_json = lambda: calls.append(1) or infer()
    r.pages(), r.envelope(), r.page_manifest(), r.load()
    assert len(calls) == 1


@pytest.mark.parametrize("expand", ["true", "false"])
def test_both_readers_agree_on_arrays_that_are_always_empty(spark, expand):
    root = shared_dir(spark, "empty-array")
    rows = spark.range(4).select(
        "id", F.struct(F.array().cast("array<struct<a:int>>").alias("line"), F.lit(1).alias("n")).alias("detail")
    )
    write_landing(rows, root, "e", "C", ["id"])
    entity_format.register(spark)
    native = reader(spark, root, expandArrays=expand).load()
    other = spark.read.format("entity_pages").options(companyId="C", entity="e", expandArrays=expand).load(root)
    assert native.columns == other.columns == ["id", "detail", "detail_line", "detail_n"]
    assert sorted(map(str, native.collect())) == sorted(map(str, other.collect()))


def test_the_format_refuses_the_first_record_by_another_key(spark):
    root = shared_dir(spark, "another-key")
    write_landing(spark.range(3).select("id", (-F.col("id")).alias("k"), F.array("id").alias("t")), root, "e", "C", ["id"])
    entity_format.register(spark)
    options = {"companyId": "C", "entity": "e", "expandArrays": "true", "arraySizes": "first"}
    assert "t_0" in spark.read.format("entity_pages").options(**options, orderBy="id").load(root).columns
    with pytest.raises(Exception, match="EntityReader"):
        spark.read.format("entity_pages").options(**options, orderBy="k").load(root)


def test_numbering_deals_rows_evenly_and_in_order(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = number_rows(spark.range(160_000).repartition(7), ["id"], buckets=256)
        tasks = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.min("position").alias("a"), F.max("position").alias("b")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(t.n for t in tasks) <= 1.3 * 160_000 / 16
    assert all(t.b - t.a + 1 == t.n for t in tasks)
