"""The pipeline's stages against brute force, each on its own input."""

import random

import pytest
from pyspark.sql import functions as F
from test_decontaminate import brute as contaminated
from test_dedup import links, prose
from test_line_dedup import brute as without_repeated_lines

import corpus_pipeline

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(2)
    folder = str(tmp_path_factory.mktemp("corpus"))
    item = prose(rng, 40)
    rows, labels = [], []
    for i in range(400):
        text, kind = prose(rng, rng.randint(10, 150)), rng.choice(["good"] * 7 + ["junk", "toxic"])
        if i % 4 == 0:
            text += "\nA line that is repeated in a hundred of these documents.\nend"
        if i % 37 == 5:
            text += " " + item
        if i % 23 == 7 and rows:
            text, kind = rows[-1][1] + " more", labels[-1][3]
        elif kind == "junk":
            text = "!! ".join(text.upper().split())
        elif kind == "toxic":
            text += " slurone slurtwo slurthree slurone"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(kind != "junk"), int(kind == "toxic"), kind))
    rows += [(500, None, None, None, None), (501, "", "en", "s1", 0), (502, rows[0][1], "en", "s0", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([x[:3] for x in labels], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, {x[0]: x[3] for x in labels}, item


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_each_stage_on_what_the_one_before_kept(spark, sf_dir):
    folder, kinds, item = sf_dir
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    good = corpus_pipeline.stage(stages["quality_classifier"](spark, docs, folder), "test")
    kept = {r.doc_id for r in good.collect()}
    assert sum(kinds.get(i) == "good" for i in kept) / sum(k == "good" for k in kinds.values()) > 0.97
    assert sum(i in kept for i, k in kinds.items() if k != "good") < 0.1 * sum(k != "good" for k in kinds.values())

    lines = corpus_pipeline.stage(stages["line_dedup"](spark, good, folder), "test")
    want = [(i, t) for i, t, _, _ in without_repeated_lines(rows_of(good))]
    assert sorted(((i, t or "") for i, t in rows_of(lines)), key=repr) == sorted(want, key=repr)
    assert lines.where("text is not null and n_chars <> length(text)").where(F.col("doc_id") < 500).count() == 0

    near = corpus_pipeline.stage(stages["ngram_jaccard_join"](spark, lines, folder), "test")
    firsts = {i for i, _, c in links(rows_of(lines), 5, 80) if i == c}
    assert rows_of(near) == [r for r in rows_of(lines) if r[0] in firsts]
    assert near.count() < lines.count()

    clean = corpus_pipeline.stage(stages["benchmark_decontamination"](spark, near, folder), "test")
    assert rows_of(clean) == [r for r in rows_of(near) if not contaminated(r[1], [(1, item)])[3]]
    assert 0 < clean.count() < near.count()

    packed = stages["best_fit_packing"](spark, clean, folder).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in rows_of(clean)}
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).drop("sequence_id", "offset").collect())) == sorted(
        (r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed
    )
    for frame in (good, lines, near, clean):
        assert frame.columns == docs.columns


def test_one_row_of_repeated_rows_stays(spark, sf_dir):
    rows = [(1, "some words that are repeated as a whole", "en", "s", 3)] * 3 + [(2, "", "en", "s", 0)] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    got = corpus_pipeline.near_duplicates(spark, docs, sf_dir[0]).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 2]


def test_empty_documents(spark, sf_dir):
    docs = spark.createDataFrame([], SCHEMA)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs, sf_dir[0]).collect() == []
