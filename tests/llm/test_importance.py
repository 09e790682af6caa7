"""Runs, weights and ranks against a plain count of every feature."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from entityframe.llm.importance import (
    Runs,
    bucket_counts,
    joined_runs,
    noise,
    op11_importance_resampling,
    resample,
    score_documents,
    shift,
    stretches,
)

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = WORDS.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def buckets_of(text):
    return [zlib.crc32(f.encode()) % 10000 for f in features(text)[1]]


def brute(rows, targets):
    own, other = Counter(), Counter()
    for _, text in rows:
        own.update(buckets_of(text))
    for text in targets:
        other.update(buckets_of(text))
    s, t = sum(own.values()), sum(other.values())

    def gain(b):
        return math.floor(1000 * math.log((other[b] + 1) * (s + 10000) / ((own[b] + 1) * (t + 10000))))

    out = []
    for key, text in rows:
        weight = sum(map(gain, buckets_of(text)))
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        words, runs = features(text)
        out.append([key, len(runs), weight, score, None, len(words)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for i, row in enumerate(able[: 5 * len(able) // 100]):
        row[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def table(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_query_equals_brute_force(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    targets = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    assert table(op11_importance_resampling(spark, data)) == brute(docs, targets)


def test_edge_rows(spark, docs_of):
    rng = random.Random(3)
    bits = ["a", "B", "é", "日本", "1", " ", "\n", "_", "\x00", "ÿ", "İ", "x" * 70, "y" * 300]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 90)))) for i in range(300)]
    rows += [(300, None), (301, ""), (None, "word " * 30), (None, "other " * 25), (5, rows[5][1]), (302, "same text " * 20)]
    rows += [(302, "same text " * 20)] * 3
    target = [("A b a",), (None,), ("日本 é é",)]
    frame = spark.createDataFrame(target, "text string")
    assert table(score_documents(docs_of(rows), frame)) == brute(rows, [t for (t,) in target])
    empty = frame.limit(0)
    assert table(score_documents(docs_of(rows), empty)) == brute(rows, [])
    assert table(score_documents(docs_of([]), frame)) == []


def test_drawn_rows_come_whole(spark, docs_of):
    rows = [(i, f"word{i % 7} " * 30) for i in range(100)] + [(None, "few")]
    frame = spark.createDataFrame([("word3 word3",)], "text string")
    docs = docs_of(rows)
    ranks = score_documents(docs, frame).where("rank is not null").collect()
    got = resample(docs, frame)
    assert got.columns == docs.columns and sorted(r.rank for r in ranks) == [1, 2, 3, 4, 5]
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in ranks)


@pytest.mark.parametrize("limit", (1, 7, 40, 1000))
def test_long_texts_in_stretches_count_alike(limit):
    rng = random.Random(limit)
    for _ in range(60):
        text = "".join(rng.choices(["ab", "c", " ", " - ", "é", "d" * 50], k=rng.randint(0, 60)))
        total = Counter()
        for _, _, runs in joined_runs([text, "zz", None, text], limit=limit):
            for bucket, valid in zip(runs.buckets, runs.valid):
                total.update(bucket[valid].tolist())
        assert total == Counter(buckets_of(text) * 2 + buckets_of("zz"))
        data = text.encode()
        assert sum(len(p) for p, _ in stretches(data, limit)) >= len(data)


def test_runs_do_not_cross_texts():
    runs = Runs(b"a b\xffc\xff\xffd e f\xff")
    assert [int(v.sum()) for v in runs.valid] == [6, 3, 1]
    assert runs.first.tolist() == [0, 2, 3, 3, 6]


def test_shifted_crcs():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 1000):
        a, b = rng.bytes(9), rng.bytes(n)
        assert int(shift(np.array([zlib.crc32(a)]), np.array([n]))[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_counts_are_added_before_the_shuffle(spark):
    texts = spark.createDataFrame([("one two",)] * 5000, "text string").repartition(2)
    rows = bucket_counts(texts).collect()
    assert sorted(r.n for r in rows) == [5000] * 3
    assert noise(1) == noise("1")
