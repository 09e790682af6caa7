"""Landed API answers against plain sets of positions: coverage, faults, repeats, one parse."""

import json
import random

import pytest
from pyspark.sql import functions as F

from entityframe.options import OptionError
from entityframe.sources import answers as api
from entityframe.sources.answers import AnswerError
from entityframe.sources.landing import shared_dir, tenant_path
from entityframe.sources.reader import EntityReader


def land(spark, lines, purpose="answers"):
    root = shared_dir(spark, purpose)
    where = tenant_path(root, "e", "sandbox", "C")
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(2).write.text(where)
    return root


def reader(spark, root, **options):
    always = {"path": root, "companyId": "C", "entity": "e", "fileFormat": "json", "jsonPages": True, "pageSize": 10}
    return EntityReader(spark).options(**(always | options))


def answer(start, ids, total=None):
    return json.dumps({"entities": [{"id": i} for i in ids], "startPosition": start, "totalCount": total})


def frame(spark, intervals, total):
    rows = [(s, n, total, None, None) for s, n in intervals]
    kinds = "start bigint, n bigint, total_count bigint, problem string, entities array<variant>"
    return spark.createDataFrame(rows, kinds)


def expected(intervals, total):
    times = {}
    for s, n in intervals:
        for p in range(s, s + n):
            times[p] = times.get(p, 0) + 1
    last = max(times, default=0)
    top = total or 0
    return {
        "gap": {p for p in range(1, last) if p not in times},
        "overlap": {p for p, n in times.items() if n > 1},
        "short": set(range(last + 1, top + 1)),
        "beyond": {p for p in times if total is not None and p > top} | set(range(top + 1, last + 1) if total is not None else ()),
    }


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("buckets", (1, 7))
def test_coverage_equals_sets_of_positions(spark, seed, buckets):
    rng = random.Random(seed)
    intervals = [(rng.randint(1, 150), rng.choice([0, 1, 3, 10, 10, 25])) for _ in range(rng.randint(0, 40))]
    intervals += intervals[:4] * rng.randint(0, 3)
    total = rng.choice([None, 0, 60, 140, 300])
    got = {"gap": [], "overlap": [], "short": [], "beyond": []}
    for r in api.coverage(frame(spark, intervals, total), buckets).collect():
        assert r["records"] == r["last"] - r["first"] + 1
        got[r["kind"]] += range(r["first"], r["last"] + 1)
    for kind, positions in expected(intervals, total).items():
        assert sorted(got[kind]) == sorted(positions), kind


def test_an_entity_answered_whole_has_no_rows(spark):
    assert api.coverage(frame(spark, [(1, 10), (11, 10), (21, 3)], 23)).count() == 0
    assert api.coverage(frame(spark, [], None)).count() == 0


def test_answers_of_one_start_are_one_row_before_they_are_sorted(spark):
    many = spark.range(5000).select(
        F.lit(1).cast("bigint").alias("start"), (F.col("id") % 3 + 5).alias("n"), F.lit(7).cast("bigint").alias("total_count")
    )
    (row,) = api.sweep(many).collect()
    assert (row.start, row["end"], row.second) == (1, 8, 8)
    assert [tuple(r) for r in api.coverage(many).collect()] == [("overlap", 1, 7, 7)]


def test_gaps_and_repeats_fail_unless_allowed(spark):
    lines = [answer(1, range(1, 11), 25), answer(6, range(6, 16), 25), answer(16, range(16, 26), 25), answer(16, range(16, 26), 25)]
    root = land(spark, lines)
    with pytest.raises(AnswerError, match="overlap at positions 6 to 10; overlap at positions 16 to 25"):
        reader(spark, root).load()
    got = reader(spark, root, answers="distinct").pages().orderBy("page_no", "pos_in_page").collect()
    assert [r.id for r in got] == list(range(1, 26))
    assert [r.page_no * 10 + r.pos_in_page + 1 for r in got] == list(range(1, 26))
    assert reader(spark, root, answers="any").load().count() == 40
    short = land(spark, [answer(1, [1, 2], 9), answer(5, [5], 9)])
    for how in ("whole", "distinct"):
        with pytest.raises(AnswerError, match="gap at positions 3 to 4; short at positions 6 to 9"):
            reader(spark, short, answers=how).load()
    with pytest.raises(OptionError, match="answers must be"):
        reader(spark, short, answers="some").load()


def test_faulty_answers_are_named_not_lost(spark):
    good = answer(1, [1, 2], 2)
    for line, message in (
        ('{"fault": {"error": "expired"}}', "1 x fault: .*expired"),
        ('{"entities": {"id": 3}, "totalCount": 2}', "entities is not an array"),
        ('{"entities": [{"id": 3}', "not JSON"),
        ('{"other": 1}', "no entities"),
        ('{"entities": [{"id": 0}], "startPosition": 0}', "starts before 1"),
    ):
        root = land(spark, [good, line])
        with pytest.raises(AnswerError, match=message):
            reader(spark, root).load()
        r = reader(spark, root, answers="any")
        assert sorted(x.id for x in r.load().collect()) == [1, 2]
        assert [x.answers for x in api.faults(r.answers()).collect()] == [1]


def test_totals_come_from_the_answers(spark):
    def envelope(*lines):
        return tuple(reader(spark, land(spark, lines)).envelope().first())

    assert envelope('{"entities": [], "totalCount": 0}') == (1, 0, 0)
    assert envelope('{"totalCount": 5}', answer(1, [1, 2, 3, 4, 5], 5)) == (1, 5, 5)
    assert envelope('{"entities": [{"id": 1}]}') == (1, 1, 1)
    assert envelope('{"maxResults": 0, "startPosition": 1}', '{"entities": null, "totalCount": 0}') == (1, 0, 0)


def test_answers_are_parsed_once_and_records_come_from_variants(spark):
    lines = [json.dumps({"entities": [{"id": i, "a": [{"b": "x"}], "n": i + 0.5}], "startPosition": i}) for i in range(1, 31)]
    r = reader(spark, land(spark, lines))
    loaded = r.load()
    plan = loaded._jdf.queryExecution().toString()
    assert "parse_json" not in plan and "from_json" not in plan and "value" not in loaded.columns
    assert r.record_schema().simpleString() == "struct<a:array<struct<b:string>>,id:bigint,n:double>"
    assert sorted(x.n for x in loaded.collect()) == [i + 0.5 for i in range(1, 31)]
    strict = reader(spark, r.scan_options.path, schema="id bigint, n bigint").load()
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        strict.collect()


def test_of_two_answers_the_longer_one_that_begins_first_counts(spark):
    lines = [answer(1, [1, 2, 3]), answer(1, [91, 92, 93, 94]), answer(3, [73, 74, 75, 76]), answer(4, [84]), answer(7, [7])]
    got = reader(spark, land(spark, lines), answers="distinct").pages().orderBy("pos_in_page").collect()
    assert [r.id for r in got] == [91, 92, 93, 94, 75, 76, 7]


# --- lines that cannot be read -----------------------------------------------------------------


def test_unreadable_lines_are_set_aside_with_their_place(spark, tmp_path):
    root = str(tmp_path)
    folder = tmp_path / "e" / "env=sandbox" / "company_id=C"
    folder.mkdir(parents=True)
    lines = []
    for i in range(400):
        lines.append({5: "{", 77: '{"id": "x"}', 200: "null", 201: "", 399: "[1]"}.get(i, f'{{"id": {i}, "v": {{"w": "é{i}"}}}}'))
    (folder / "a.json").write_text("\n".join(lines) + "\n")
    (folder / "b.json").write_text('{"id": 1000}\nnope\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")  # many blocks of one file
    try:
        r = reader(spark, root, jsonPages="false", onUnreadable="reject", schema="id bigint, v struct<w: string>")
        rejected = sorted((x.file.rsplit("/", 1)[-1], x.line, x.problem) for x in r.rejects().collect())
        assert rejected == [
            ("a.json", 6, "not JSON"),
            ("a.json", 78, "not a record of the schema"),
            ("a.json", 400, "not a record of the schema"),
            ("b.json", 2, "not JSON"),
        ]
        loaded = r.load()
        rows = loaded.collect()
        assert len(rows) == 397 and r.counts() == {"records": 397, "rejected": 4}
        assert sum(x.id is None for x in rows) == 1  # the null record
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        reader(spark, root, jsonPages="false", schema="id bigint").load().collect()


def test_the_schema_is_inferred_from_what_can_be_read(spark):
    root = land(spark, ['{"id": 1, "_corrupt": "kept"}', "{", '{"id": 2}'])
    r = reader(spark, root, jsonPages="false", onUnreadable="reject")
    assert sorted((x.id, x._corrupt) for x in r.load().collect()) == [(1, "kept"), (2, None)]
    assert [(x.problem, x.text) for x in r.rejects().collect()] == [("not JSON", "{")]
    with pytest.raises(OptionError, match="onUnreadable"):
        reader(spark, root, onUnreadable="drop").load()
    with pytest.raises(OptionError, match="rejects are kept"):
        reader(spark, root).rejects()
