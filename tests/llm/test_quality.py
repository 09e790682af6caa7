import random

import pytest

from entityframe.llm import quality
from entityframe.llm.quality import good_labels, score_quality

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, keep string"


def corpus(n, seed=0):
    """(row, label): prose, shouted junk, and prose with slurs."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randint(20, 200))) + "."
        kind = rng.choice(["good"] * 6 + ["junk", "toxic"])
        if kind == "junk":
            text = "!! ".join(text.upper().split())
        if kind == "toxic":
            text += " ".join(rng.choices(["slurone", "slurtwo", "slurthree"], k=4))
            text = text.replace(".", ". ")
        rows.append(((i, text, rng.choice(["en", "fr"]), f"s{i % 5}", len(text), "x"), kind))
    return rows


def frames(spark, rows, labelled):
    docs = spark.createDataFrame([r for r, _ in rows], SCHEMA)
    labels = [(r[0], int(k != "junk"), int(k == "toxic")) for r, k in rows[:labelled]]
    return docs, good_labels(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_held_out_accuracy(spark):
    rows = corpus(1500)
    docs, labels = frames(spark, rows, 900)
    got = {r.doc_id: r for r in score_quality(docs, labels).collect()}
    held = [(got[r[0]], kind == "good") for r, kind in rows[900:]]
    assert sum(g.keep == good for g, good in held) / len(held) > 0.95
    clean = [g.keep for g, good in held if good]
    assert sum(clean) / len(clean) > 0.97
    assert all(0 <= g.quality_score <= 1 for g in got.values())


def test_odd_documents_and_columns(spark):
    rows = corpus(300)
    docs, labels = frames(spark, rows, 300)
    odd = [(1000, None, None, None, None, None), (1001, "", "", "", -5, "x"), (None, "text", "en", "s1", 4, "x"),
           (1002, "word " * 50_000, "xx", "new", 0, "x"), rows[0][0], rows[0][0]]
    scored = score_quality(docs.union(spark.createDataFrame(odd, SCHEMA)), labels)
    assert scored.columns[:5] == docs.columns[:5] and scored.columns.count("keep") == 1
    got = scored.collect()
    assert len(got) == 306 and all(r.keep is not None and r.quality_score is not None for r in got)
    assert len({r.quality_score for r in got if r.doc_id == 0}) == 1


@pytest.mark.parametrize("labelled", [0, 5])
def test_nothing_to_learn_from_keeps_everything(spark, labelled):
    docs, labels = frames(spark, corpus(40), labelled)
    assert all(r.keep and r.quality_score is None for r in score_quality(docs, labels).collect())
    assert score_quality(docs.limit(0), labels).collect() == []


def test_samples_are_bounded(spark):
    rows = corpus(600)
    docs, labels = frames(spark, rows, 600)
    scored = score_quality(docs, labels, max_labelled=200, max_unlabelled=50).collect()
    assert len(scored) == 600 and sum(r.keep == (k == "good") for r, (_, k) in zip(sorted(scored), rows)) > 520


def test_all_unlabelled_documents_may_teach(spark, monkeypatch):
    rows = corpus(600)
    docs, labels = frames(spark, rows, 560)
    repeated = docs.where("doc_id = 570").crossJoin(spark.range(300).select()).select(docs.columns)
    trained, begin = [], quality.TextClassifier.__init__

    def spy(self, texts, y):
        trained.append(len(texts))
        begin(self, texts, y)

    monkeypatch.setattr(quality.TextClassifier, "__init__", spy)
    scored = score_quality(docs.union(repeated), labels, max_unlabelled=48).collect()
    assert len(scored) == 900
    # 448 labelled rows train. Of 601 ids, 40 are unlabelled; a sample of 48 of all rows holds few of them.
    assert trained[0] == 448 and 448 + 12 <= trained[-1] <= 448 + 24
