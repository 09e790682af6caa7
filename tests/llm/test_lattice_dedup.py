import numpy as np
import pytest

from entityframe.llm.lattice_dedup import decode_e8, link_vectors

SCHEMA = "vec_id bigint, embedding array<float>, kept string"


def brute(rows, least=0.95):
    ids, vectors = [], []
    for i, v in rows:
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            ids.append(i)
            vectors.append(np.asarray(v, np.float32).astype(float))
    x = np.array(vectors)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= least
    return ids, linked & ~np.eye(len(ids), dtype=bool)


def test_recall_against_all_pairs_and_no_false_link(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((400, 64))
    noise = rng.standard_normal((400, 64)) / 8
    size = np.linalg.norm(base, axis=1, keepdims=True)
    # Cosines from just below the threshold to almost one.
    near = base / size + noise * rng.uniform(0.02, 0.36, (400, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near, base[:20]]))]
    got = {r.vec_id: r for r in link_vectors(spark.createDataFrame([(i, v, "") for i, v in rows], SCHEMA)).collect()}
    ids, linked = brute(rows)
    counts = dict(zip(ids, linked.sum(axis=1)))
    assert all(got[i].n_links <= counts[i] for i in ids)
    assert sum(r.n_links for r in got.values()) >= 0.95 * linked.sum() > 0
    for i, r in got.items():
        assert r.kept == (r.component_id == i) and r.component_id <= i


@pytest.mark.parametrize("size", [16, 64, 384])
def test_recall_of_pairs_next_to_the_threshold(spark, size):
    rng = np.random.default_rng(size)
    x, y = rng.standard_normal((2, 1500, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    cosine = rng.uniform(0.9501, 0.9525, (1500, 1))
    near = cosine * x + np.sqrt(1 - cosine**2) * y
    rows = [(i, v.tolist(), "") for i, v in enumerate(np.concatenate([x, near]))]
    got = {r.vec_id: r for r in link_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    linked = brute([(i, v) for i, v, _ in rows])[1]
    found = sum(got[1500 + i].component_id == got[i].component_id for i in range(1500))
    assert found >= 0.92 * 1500
    assert linked.sum() >= sum(r.n_links for r in got.values()) >= 0.92 * linked.sum()


def test_vectors_that_link_nothing_copies_and_repeated_rows(spark):
    v, nan, inf = [0.5] * 8, float("nan"), float("inf")
    rows = [(1, v), (2, v), (3, [x * 3 for x in v]), (4, None), (5, []), (6, [0.0] * 8), (7, [nan] + v[1:]), (8, [inf] + v[1:]),
            (9, [None] + v[1:]), (10, v[:7]), (11, [-x for x in v]), (2, v), (None, v), (12, [1e-30] * 8), (13, [-0.0] * 8)]
    got = link_vectors(spark.createDataFrame([(i, x, "") for i, x in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert by[1] == (3, 1, True) and by[2] == by[3] == by[12] == (3, 1, False)
    assert all(by[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 13))
    assert link_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("seed", [0, 1])
def test_decoding_finds_the_nearest_lattice_point(seed):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-2, 2, (300, 8))
    one, two = (p / 2 for p in decode_e8(x))
    for p in (one, two):
        whole = np.all(p == np.rint(p), axis=1) | np.all(p != np.rint(p), axis=1)
        assert whole.all() and (p.sum(axis=1) % 2 == 0).all()
    near, next_near = ((p - x) ** 2 for p in (one, two))
    assert (near.sum(axis=1) <= 1 + 1e-9).all()  # the covering radius of E8
    assert (near.sum(axis=1) <= next_near.sum(axis=1)).all()
    steps = [s * (np.eye(8)[i] + t * np.eye(8)[j]) for i in range(8) for j in range(i) for s in (1, -1) for t in (1, -1)]
    for step in steps:
        assert (near.sum(axis=1) <= ((one + step - x) ** 2).sum(axis=1) + 1e-9).all()
