"""What JSON records hold, kept file by file, against one pass over all files."""

import json
import os
import random

import pytest

from entityframe.operators.infer import SchemaConflict, infer_schema
from entityframe.sources import log, observed
from entityframe.sources.landing import entity_path, shared_dir, tenant_path
from entityframe.sources.observed import Observations
from entityframe.sources.reader import EntityReader


class Landed:
    def __init__(self, spark):
        self.spark, self.root = spark, shared_dir(spark, "observed")
        self.where = tenant_path(self.root, "item", "sandbox", "1")
        os.makedirs(self.where)

    def write(self, name, *records):
        with open(f"{self.where}/{name}", "w") as file:
            file.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records)

    def reader(self, **options):
        always = {"path": self.root, "companyId": "1", "entity": "item", "fileFormat": "json"}
        return EntityReader(self.spark).options(**(always | options))

    def one_pass(self, **how):
        return infer_schema(self.spark.read.text(self.where), "value", **how)


@pytest.fixture
def landed(spark):
    return Landed(spark)


@pytest.fixture
def passes(monkeypatch):
    """The files that each pass over records reads."""
    seen, lines_of = [], Observations._lines

    def lines(self, files, everything):
        found = lines_of(self, files, everything)
        seen.append(sorted(os.path.basename(name) for name in found.inputFiles()))
        return found

    monkeypatch.setattr(Observations, "_lines", lines)
    return seen


def test_a_second_reader_looks_at_new_files_alone(spark, landed, passes):
    landed.write("a.json", {"id": 1, "x": None}, {"id": 2, "x": {"y": "t"}})
    landed.write("b.json", {"id": 3, "z": [1]})
    first = landed.reader().record_schema()
    assert passes == [["a.json", "b.json"]]
    assert landed.reader().record_schema() == first == landed.one_pass()
    assert len(passes) == 1
    landed.write("c.json", {"id": 4, "new": True})
    assert landed.reader().record_schema() == landed.one_pass()
    assert passes[1:] == [["c.json"]]
    # A file that has changed takes those along that were looked at together with it.
    landed.write("b.json", {"id": 3, "z": ["longer"]})
    assert landed.reader().record_schema() == landed.one_pass()
    assert passes[2:] == [["a.json", "b.json"]]
    os.remove(f"{landed.where}/c.json")
    assert landed.reader().record_schema() == landed.one_pass()
    assert len(passes) == 3 and "new" not in landed.reader().record_schema().names


def test_jobs_of_a_second_reader(spark, landed):
    landed.write("a.json", {"id": 1, "amount": 1234567890123456.5})
    context, jobs = spark.sparkContext, []
    for name in ("first reader", "second reader"):
        context.setJobGroup(name, name)
        landed.reader().record_schema()
        jobs.append(len(context.statusTracker().getJobIdsForGroup(name)))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] > jobs[1] == 1  # the list of files


def test_digits_are_looked_at_again_where_files_together_need_it(landed, passes):
    landed.write("a.json", {"v": 1}, {"w": 1.5})
    landed.reader().record_schema()
    landed.write("b.json", {"v": 2.5})
    # Neither file needs more than a double holds; whole numbers beside fractions might.
    assert landed.reader().record_schema() == landed.one_pass()
    assert passes == [["a.json"], ["b.json"], ["a.json", "b.json"]]
    landed.write("c.json", '{"v": 12345678901234567.25}')
    assert landed.reader().record_schema() == landed.one_pass()
    assert passes[3:] == [["c.json"], ["c.json"]]
    assert landed.reader().record_schema() == landed.one_pass() and len(passes) == 5


def random_value(rng, depth=0):
    kind = rng.randrange(9 if depth < 2 else 7)
    if kind == 7:
        return {rng.choice("abé"): random_value(rng, depth + 1) for _ in range(rng.randrange(3))}
    if kind == 8:
        return [random_value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return [None, None, rng.randrange(50), 10**17 + 1, 1.25, "t", 1234567890.123456789][kind]


@pytest.mark.parametrize("seed", range(6))
def test_increments_agree_with_one_pass(landed, seed):
    rng = random.Random(seed)
    for i in range(4):
        landed.write(f"{i}.json", *({k: random_value(rng) for k in "abc"} for _ in range(2)))
        # As text, where values have no common form.
        got = landed.reader(onConflict="string").record_schema()
        assert got == landed.one_pass(on_conflict="string"), i
        assert landed.reader(onConflict="string", decimalType="source").record_schema() == landed.one_pass(
            on_conflict="string", decimals=True
        )


def test_conflicts_are_errors_of_every_reader(landed):
    landed.write("a.json", {"v": 1})
    assert landed.reader().record_schema().names == ["v"]
    landed.write("b.json", {"v": {"x": 1}})
    for _ in range(2):
        with pytest.raises(SchemaConflict, match="v has values"):
            landed.reader().record_schema()


def test_unreadable_lines_fail_until_they_are_mended(landed):
    landed.write("a.json", {"v": 1}, "{broken")
    assert landed.reader(onUnreadable="reject").record_schema().names == ["v"]
    for _ in range(2):  # nothing is kept of a pass that failed, nor taken from one that left lines out
        with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|broken"):
            landed.reader().record_schema()
    landed.write("a.json", {"v": 1}, {"w": 2})
    assert landed.reader().record_schema().names == ["v", "w"]


def test_no_files_and_no_rows(landed):
    for _ in range(2):
        with pytest.raises(SchemaConflict, match="no rows"):
            landed.reader().record_schema()
        landed.write("a.json", "")
    assert landed.reader(schema="v int").load().count() == 0


def test_two_readers_at_once(spark, landed):
    landed.write("a.json", {"v": 1})
    base = entity_path(landed.root, "item")
    one, two = (Observations(spark, base, landed.where, False) for _ in range(2))
    version, known = one._latest()
    assert two.schema("fail", False).names == ["v"]
    one._publish(version + 1, known)  # the number is taken: the other's stays
    assert [len(i.files) for i in two._latest()[1]] == [1]
    assert len(log.Files(spark, base).names(f"{one._folder}/*")) == 1


def test_the_last_versions_stay(spark, landed, monkeypatch):
    monkeypatch.setattr(observed, "KEPT", 2)
    for i in range(4):
        landed.write(f"{i}.json", {f"f{i}": i})
        assert landed.reader().record_schema() == landed.one_pass()
    base = entity_path(landed.root, "item")
    one = Observations(spark, base, landed.where, False)
    assert len(log.Files(spark, base).names(f"{one._folder}/*")) == 2
    version, known = one._latest()
    assert version == 4 and len(known) == 4


def test_file_names_are_no_patterns(landed):
    landed.write("a.json", {"v": 1})
    landed.reader().record_schema()
    landed.write("[a]*.json", {"w": 1})
    assert landed.reader().record_schema().names == ["v", "w"]


def test_prints_are_those_of_the_files(spark, landed):
    landed.write("a.json", {"v": 1})
    landed.write("_hidden.json", {"v": 1})
    ((path, length, time),) = observed.file_prints(spark, landed.where)
    assert os.path.basename(path) == "a.json" and length == os.path.getsize(f"{landed.where}/a.json")
    assert abs(time / 1e6 - os.path.getmtime(f"{landed.where}/a.json")) < 0.01
