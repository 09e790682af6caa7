"""Codes and codebooks against SQL and against a plain loop over every entry."""

import hashlib
import math

import numpy as np
import pytest
from compare import connect, spark_table, sql_table

from entityframe.llm import vector_codes
from entityframe.llm.vector_codes import OP12_SQL, Book, compress_vectors, op12_vector_codes

SCHEMA = "vec_id bigint, embedding array<double>, label string, code string, _salt int"


def brute(rows):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = len(kept[0][1])
    part = -(-width // 8)

    def whole(x):
        big = abs(x) >= 2.0**53
        return max(-(2**62), min(2**62, int(x) * 4096 if big else math.floor(4096 * x)))

    vectors = {}
    for n, r in enumerate(kept):
        if len(r[1]) == width:
            v = [whole(x) for x in r[1]] + [0] * (8 * part - width)
            vectors[n] = [v[p * part : (p + 1) * part] for p in range(8)]
    books = [[vectors[n][p] for n in list(vectors)[:16]] for p in range(8)]

    def nearest(p, w):
        return min((sum((a - b) ** 2 for a, b in zip(w, e)), k) for k, e in enumerate(books[p]))

    for _ in range(6):
        for p in range(8):
            groups = {}
            for v in vectors.values():
                groups.setdefault(nearest(p, v[p])[1], []).append(v[p])
            for k, own in groups.items():
                books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, by_label = [], {}
    for n, r in enumerate(kept):
        code = error = None
        if n in vectors:
            best = [nearest(p, vectors[n][p]) for p in range(8)]
            code = "".join(f"{k:02x}" for _, k in best)
            error = min(sum(d for d, _ in best), 2**63 - 1)
            by_label[r[2]] = by_label.get(r[2], 0) + error
        out.append((r[0], code, error, r[2]))
    totals = {k: min(v, 2**63 - 1) for k, v in by_label.items()}
    return sorted(((i, c, e, totals.get(lb), digest) for i, c, e, lb in out), key=repr)


def check(spark, rows, parts=3):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    got = compress_vectors(frame).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_query_equals_its_sql_and_brute_force(spark, data):
    got = op12_vector_codes(spark, data)
    assert spark_table(got) == sql_table(connect(data), OP12_SQL)
    table = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    want = brute([(r.vec_id, r.embedding, r.label) for r in table])
    assert sorted(map(tuple, got.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr) == want


def test_edge_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16).tolist(), "abc"[i % 3]) for i in range(60)]
    rows += [(2, rows[2][1], "a"), (2, rows[3][1], None), (None, rows[4][1], None), (None, rows[4][1], None)]
    rows += [(70, None, "a"), (71, [None] * 16, "a"), (72, [math.nan] * 16, "b"), (73, [math.inf] + [0.0] * 15, "b")]
    rows += [(74, [], "a"), (75, [1.0] * 8, "a"), (76, [1.0] * 8, "only"), (77, [0.0] * 16, "z"), (78, [-0.0] * 16, "z")]
    check(spark, rows)


def test_few_vectors_and_odd_widths(spark):
    rng = np.random.default_rng(6)
    check(spark, [(i, rng.normal(size=11).tolist(), None) for i in range(9)])
    check(spark, [(i, [0.5, -0.5, 0.25], "t") for i in range(40)])
    check(spark, [])
    check(spark, [(1, None, "a"), (2, [math.nan], None)])


def test_components_of_any_size(spark):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=8) * 10.0 ** rng.integers(-3, 18)).tolist(), "ab"[i % 2]) for i in range(50)]
    rows += [(60, [1e308] * 8, "c"), (61, [-1e308, 1.0] * 4, "c")]
    check(spark, rows)


def test_one_label_of_most_rows(spark):
    rows = [(i, [float(i % 5), 0.0, 1.0, 2.0, 3.0, 4.0, 5.0, float(i % 3)], None if i % 3 else "hot") for i in range(400)]
    check(spark, rows, 5)


@pytest.mark.parametrize("seed", range(4))
def test_cells_leave_out_only_entries_that_lose(seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-4096, 4096, (12, 4))
    parts = centres[rng.integers(0, 12, 3000)] + rng.integers(-300, 300, (3000, 4))
    parts[::7] = parts[0]
    book = Book(np.concatenate([centres[:10], centres[:3], parts[:3]]).astype(np.int64))
    code, error = book.assign(parts)
    distance = ((parts[:, None, :] - book.entries[None]) ** 2).sum(2)
    assert (code == distance.argmin(1)).all() and (error == distance.min(1)).all()
    assert book.evaluated < 0.5 * distance.size
    first = book.evaluated
    again, _ = book.assign(parts)
    assert (again == code).all() and book.evaluated == 2 * first


def test_forgotten_cells_change_nothing(monkeypatch):
    rng = np.random.default_rng(9)
    parts = rng.integers(-9000, 9000, (500, 3))
    book = Book(parts[:16].copy())
    want = book.assign(parts)
    monkeypatch.setattr(vector_codes, "CACHED_CELLS", 3)
    for chunk in np.array_split(np.arange(500), 9):
        code, error = book.assign(parts[chunk])
        assert (code == want[0][chunk]).all() and (error == want[1][chunk]).all()
