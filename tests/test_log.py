"""Landings as a log: appends, snapshots, landings that break off or meet, and what is read of them."""

import pytest
from pyspark.sql import functions as F

from entityframe import EntityReader, write_landing
from entityframe.operators.infer import SchemaConflict
from entityframe.options import OptionError
from entityframe.sources import format as entity_format
from entityframe.sources import landing, log
from entityframe.sources.landing import entity_path, shared_dir
from entityframe.sources.reader import companies, view_name


def reader(spark, root, company="C", **options):
    return EntityReader(spark).options(**({"path": root, "companyId": company, "entity": "e"} | options))


def ids(spark, first, last, **columns):
    return spark.range(first, last).withColumns({n: F.lit(v) for n, v in columns.items()})


def placed(r, page_size):
    rows = r.pages().orderBy("page_no", "pos_in_page").collect()
    assert [x.page_no * page_size + x.pos_in_page for x in rows] == list(range(len(rows)))
    return [x.id for x in rows]


def test_appended_records_follow_and_schemas_merge(spark):
    root = shared_dir(spark, "append")
    assert write_landing(ids(spark, 100, 125), root, "e", "C", ["id"], page_size=10) == 1
    new = ids(spark, 0, 17, note="x", tags=["a"])
    assert write_landing(new, root, "e", "C", ["id"], page_size=10, mode="append") == 2
    assert placed(reader(spark, root), 10) == [*range(100, 125), *range(17)]
    assert reader(spark, root).load().columns == ["id", "note", "tags"]
    assert reader(spark, root).load().where("note = 'x' and tags[0] = 'a'").count() == 17
    assert reader(spark, root, expandArrays=True, keepNested=False).load().columns == ["id", "note", "tags_0"]
    assert placed(reader(spark, root, version=1), 10) == list(range(100, 125))
    assert reader(spark, root, version=1).load().columns == ["id"]
    write_landing(ids(spark, 7, 9), root, "e", "C", ["id"], page_size=10)
    assert placed(reader(spark, root), 10) == [7, 8] and len(placed(reader(spark, root, version=2), 10)) == 42
    with pytest.raises(SchemaConflict, match="id is bigint"):
        write_landing(spark.createDataFrame([("a",)], "id string"), root, "e", "C", ["id"], mode="append")
    with pytest.raises(OptionError, match="mode"):
        write_landing(ids(spark, 0, 1), root, "e", "C", ["id"], mode="merge")
    assert len(placed(reader(spark, root), 10)) == 2


def test_each_company_is_appended_to_on_its_own(spark):
    root = shared_dir(spark, "append-many")
    company = F.format_string("%02d", F.col("id") % 3)
    write_landing(ids(spark, 0, 50), root, "e", company, ["id"], page_size=7)
    more = F.when(F.col("id") % 2 == 0, "00").otherwise("09")
    write_landing(ids(spark, 60, 80), root, "e", more, ["id"], page_size=7, mode="append")
    assert placed(reader(spark, root, "00"), 7) == [i for i in range(50) if i % 3 == 0] + list(range(60, 80, 2))
    assert placed(reader(spark, root, "01"), 7) == [i for i in range(50) if i % 3 == 1]
    assert placed(reader(spark, root, "09"), 7) == list(range(61, 80, 2))
    write_landing(ids(spark, 90, 95), root, "e", F.lit("01"), ["id"], page_size=7)
    every = companies(spark, root, "e", reader(spark, root, "00").record_schema())
    found = {r.company_id: r["n"] for r in every.groupBy("company_id").agg(F.count("*").alias("n")).collect()}
    assert found == {"00": 27, "01": 5, "02": 16, "09": 10}
    earlier = companies(spark, root, "e", reader(spark, root, "00").record_schema(), version=1)
    assert earlier.count() == 50
    with pytest.raises(SchemaConflict, match="id is bigint"):
        write_landing(spark.createDataFrame([("a",)], "id string"), root, "e", F.lit("02"), ["id"], mode="append")


@pytest.mark.parametrize("mode", ["append", "replace"])
def test_a_landing_that_breaks_off_is_not_seen(spark, monkeypatch, mode):
    root = shared_dir(spark, "broken")
    write_landing(ids(spark, 0, 20), root, "e", "C", ["id"], page_size=10)

    def fail(*_):
        raise RuntimeError("power went off")

    for step in ("publish", "MANIFEST"):
        with monkeypatch.context() as broken:
            # Between the pages and the manifest, and between the manifest and the log.
            broken.setattr(log, step, fail if step == "publish" else "/proc/nowhere\0")
            with pytest.raises(Exception):
                write_landing(ids(spark, 50, 60, other=1), root, "e", "C", ["id"], page_size=10, mode=mode)
        assert placed(reader(spark, root), 10) == list(range(20))
        assert reader(spark, root).load().columns == ["id"]
        assert companies(spark, root, "e", reader(spark, root).record_schema()).count() == 20
    entity_format.register(spark)
    assert spark.read.format("entity_pages").options(companyId="C", entity="e").load(root).count() == 20
    write_landing(ids(spark, 50, 60), root, "e", "C", ["id"], page_size=10, mode=mode)
    assert len(placed(reader(spark, root), 10)) == (30 if mode == "append" else 10)


def test_of_two_landings_that_meet_one_fails(spark, monkeypatch):
    root = shared_dir(spark, "meet")
    write_landing(ids(spark, 0, 5), root, "e", "C", ["id"])
    publish = log.publish

    def late(session, base, env, name, mode, after):
        monkeypatch.setattr(log, "publish", publish)
        write_landing(ids(spark, 10, 13), root, "e", "C", ["id"], mode="append")
        return publish(session, base, env, name, mode, after)

    monkeypatch.setattr(log, "publish", late)
    with pytest.raises(log.LandingConflict, match="taken"):
        write_landing(ids(spark, 20, 30), root, "e", "C", ["id"], mode="append")
    assert placed(reader(spark, root), 1000) == [0, 1, 2, 3, 4, 10, 11, 12]
    names = log.Files(spark, root).names(f"{log.log_path(entity_path(root, 'e'), 'sandbox')}/*")
    assert [n.rsplit("/", 1)[-1] for n in names if not n.rsplit("/", 1)[-1].startswith(".")] == [log.entry_name(1), log.entry_name(2)]


def test_the_format_reads_the_log(spark):
    root = shared_dir(spark, "format-log")
    write_landing(ids(spark, 0, 20, tags=["a"]), root, "e", "C", ["id"], page_size=10)
    write_landing(ids(spark, 20, 25, note="n"), root, "e", "C", ["id"], page_size=10, mode="append")
    entity_format.register(spark)
    for options in ({}, {"version": "1"}, {"expandArrays": "true", "keepNested": "false"}):
        loaded = spark.read.format("entity_pages").options(companyId="C", entity="e", **options).load(root)
        native = reader(spark, root, **options).load()
        assert loaded.dtypes == native.dtypes
        assert sorted(map(str, loaded.collect())) == sorted(map(str, native.collect()))


def test_a_sample_reads_the_pages_it_needs(spark):
    root = shared_dir(spark, "sample")
    write_landing(ids(spark, 0, 500), root, "e", "C", ["id"], page_size=10, batch_size=2, batches_per_file=1)
    got = reader(spark, root).sample(25)
    assert [r.id for r in got.collect()] == list(range(25))
    assert "LessThanOrEqual(page_no,2)" in got._jdf.queryExecution().executedPlan().toString()
    assert reader(spark, root).sample(900).count() == 500


def test_many_companies_are_landed_without_a_list_of_them(spark, monkeypatch):
    root = shared_dir(spark, "many")
    monkeypatch.setattr(landing, "tenant_path", None)  # a path per company would need it
    company = F.format_string("c%04d", F.col("id") % 700)
    write_landing(ids(spark, 0, 2100), root, "e", company, ["id"])
    monkeypatch.undo()
    assert placed(reader(spark, root, "c0699"), 1000) == [699, 1399, 2099]
    counted = log.counted_landings(spark, entity_path(root, "e"), "sandbox")
    assert counted.count() == 700 and counted.agg(F.sum("records")).first()[0] == 2100


def test_view_names_tell_names_apart(spark):
    def name(company, entity):
        return view_name(reader(spark, "/r", company, entity=entity).scan_options)

    assert name("001", "item") == "t_001_item"
    names = [name("1.2", "a"), name("1_2", "a"), name("1-2", "a"), name("1", "2_a"), name("1", "2a")]
    assert len(set(names)) == 5 and all(n.isidentifier() for n in names)
