"""Exact substrings, similar passages and similar documents against brute force."""

import random
import re
import tracemalloc

import numpy as np
import pytest

from entityframe.llm import compact_windows, shared
from entityframe.llm.compact_windows import find_passages
from entityframe.llm.graph import components
from entityframe.llm.jaccard_join import link_components
from entityframe.llm.suffix_dedup import common_prefix_groups, find_repeats


@pytest.fixture(params=["one block", "many blocks"])
def blocks(request, monkeypatch):
    if request.param == "many blocks":
        monkeypatch.setattr(shared, "BLOCK_BYTES", 3000)
        monkeypatch.setattr(shared, "KEYS_PER_BUCKET", 100)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    passage, line = prose(rng, 70), "A notice that is in very many of the documents here."
    rows = []
    for i in range(60):
        text = prose(rng, rng.randint(0, 90))
        if i % 3 == 0:
            text += " " + line
        if i % 5 == 0:
            text = text[: len(text) // 2] + passage + text[len(text) // 2 :]
        rows.append((i * 7 % 61, text))
    base = prose(rng, 120).split()
    for i in range(12):  # near copies, each a little further from the first
        base = base[:]
        base[rng.randrange(len(base))] = f"new{i}"
        rows.append((100 + i, " ".join(base)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "two words"), (204, "TWO  words"), (205, "é" * 120), (206, "xé" + "é" * 120),
             (207, "a" * 3000), (208, "a" * 49), (209, "a" * 50), (210, rows[0][1]), (210, rows[0][1]), (211, "one two three")]
    return rows


def repeats(rows, n=50):
    first = {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        for p in range(len(raw) - n + 1):
            first.setdefault(raw[p : p + n], i)
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - n + 1):
            if first[raw[p : p + n]] < i:
                gone[p : p + n] = b"\1" * n
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out.append((i, len(raw), spans, bytes(c for c, g in zip(raw, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_repeats(docs_of, blocks, seed):
    rows = corpus(seed)
    got = find_repeats(docs_of(rows, 3)).collect()
    assert sorted((r.doc_id, r.n_bytes, [tuple(s) for s in r.removed], bytes(r.kept)) for r in got) == repeats(rows)


def test_a_row_without_an_id_comes_last(docs_of):
    text = "the same text of well over fifty bytes, found in both of the two rows"
    got = {r.doc_id: bytes(r.kept) for r in find_repeats(docs_of([(None, text), (9, text)])).collect()}
    assert got == {9: text.encode(), None: b""}


def test_groups_of_equal_prefixes():
    rng = np.random.default_rng(0)
    for size in (1, 2, 30, 300):
        for letters in (1, 2, 5):
            text = rng.integers(2, 2 + letters, size).astype(np.uint16)
            order, opens = common_prefix_groups(text, 6)
            group = np.cumsum(opens)
            seen = {}
            for place, g in zip(order, group):
                prefix = tuple(text[place : place + 6])
                assert len(prefix) < 6 or seen.setdefault(prefix, g) == g
            assert len(set(seen.values())) == len(seen)


def test_compact_windows_equal_their_definition():
    rng = np.random.default_rng(0)
    for _ in range(40):
        n = int(rng.integers(1, 60))
        parts = np.r_[0, np.sort(rng.integers(0, n + 1, 2)), n]
        v = rng.integers(0, 12, n).astype(np.uint64)
        want = []
        for a, b in zip(parts[:-1], parts[1:]):
            for c in range(a, b):
                left, right = c, c
                while left > a and v[left - 1] > v[c]:
                    left -= 1
                while right < b - 1 and v[right + 1] >= v[c]:
                    right += 1
                if right - left + 1 >= 5:
                    want.append((left, c, right))
        assert sorted(zip(*(x.tolist() for x in compact_windows.compact_windows(v, parts, 5)))) == sorted(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_similar_passages(docs_of, blocks, seed):
    rows = corpus(seed)
    got = {}
    for r in find_passages(docs_of(rows, 3)).collect():
        got.setdefault(r.doc_id, r)
    first = {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        for p in range(len(w) - 49):
            first.setdefault(tuple(w[p : p + 50]), i)
    for i, text in rows:
        w = words(text)
        removed = {k for a, b in got[i].spans for k in range(a, b)}
        assert got[i].n_words == len(w)
        # Exact repeats of fifty words are similar passages; words at the edge that only a
        # document other than the two met has in common may stay.
        for p in range(len(w) - 49):
            if first[tuple(w[p : p + 50])] < i:
                assert len(set(range(p, p + 50)) - removed) <= 3, i
        assert all(s < i for s in got[i].sources)
        kept = [x for k, x in enumerate(w) if k not in removed]
        assert re.sub(r"\s+", "", lower(got[i].kept)) == "".join(kept)
    clean = [i for i, t in rows if i < 61 and len(words(t)) >= 50]
    assert sum(bool(got[i].spans) for i in clean) <= len(clean) // 2
    assert all(got[i].spans for i in range(101, 112))


def test_an_edited_passage_is_found_and_a_different_one_is_not(docs_of):
    rng = random.Random(8)
    a, b = prose(rng, 160, 5000).split(), prose(rng, 160, 5000)
    edited = a[:]
    edited[40], edited[90] = "changed", "words"
    got = {r.doc_id: r for r in find_passages(docs_of([(1, " ".join(a)), (2, " ".join(edited)), (3, b)])).collect()}
    assert got[2].sources == [1] and sum(e - s for s, e in map(tuple, got[2].spans)) >= 150
    assert got[1].spans == got[3].spans == []


@pytest.mark.parametrize("holders", [0, 2, 4, 20])
@pytest.mark.parametrize("part", [49, 40, 30])
def test_an_exact_repeat_is_found_behind_documents_that_hold_parts_of_it(docs_of, holders, part):
    rng = random.Random(holders * 100 + part)
    rows, last = [], []
    for _ in range(20):
        passage = prose(rng, 60, 5000).split()
        for k in range(2 + holders):
            begin = rng.randint(0, 60 - part)
            held = passage if k in (1, 1 + holders) else passage[begin : begin + part]
            text = [prose(rng, 80, 5000), " ".join(held), prose(rng, 80, 5000)]
            rows.append((len(rows), " ".join(text)))
        last.append(len(rows) - 1)
    # The first document of each passage holds a part; the whole lies in the second and in the last.
    rows = [(i, t) for i, t in rows if holders or i % 2 == 0 or i in last]
    if not holders:
        rows = [(i, rows[i | 1][1] if i % 2 == 0 else t) for i, t in rows]
    got = {r.doc_id: sum(e - s for s, e in map(tuple, r.spans)) for r in find_passages(docs_of(rows, 3)).collect()}
    found = [got[i] for i in last]
    assert all(n >= 40 for n in found), found
    if part < 49:
        assert sum(n > 0 for n in got.values()) == 20


@pytest.mark.parametrize("place", [0, 25, 49])
def test_a_passage_with_one_word_changed_is_found(docs_of, place):
    rng, rows = random.Random(place), []
    for i in range(20):
        passage = prose(rng, 50, 5000).split()
        rows.append((2 * i, " ".join(passage)))
        passage[place] = "changed"
        rows.append((2 * i + 1, " ".join(passage)))
    got = {r.doc_id: r.spans for r in find_passages(docs_of(rows, 3)).collect()}
    assert not any(got[i] for i in range(0, 40, 2))
    assert sum(bool(got[i]) for i in range(1, 40, 2)) >= (19 if place in (0, 49) else 17)


def similar_by_brute_force(rows, length=46, percent=80):
    """(document, passage) of ``length`` shingles that are similar to one of an earlier document."""
    grams = {}
    for i, text in rows:
        w = words(text)
        grams[i] = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    out = []
    for b in sorted(grams):
        for p in range(len(grams[b]) - length + 1):
            two = set(grams[b][p : p + length])
            for a in sorted(grams):
                if a >= b or len(two.intersection(grams[a])) * 100 < percent * len(two):
                    continue
                passages = (set(grams[a][q : q + length]) for q in range(len(grams[a]) - length + 1))
                if any(100 * len(one & two) >= percent * len(one | two) for one in passages):
                    out.append((b, p))
                    break
    return out


def test_similar_passages_against_brute_force(docs_of):
    rng, rows = random.Random(4), []
    for _ in range(12):
        passage = prose(rng, rng.randint(50, 90), 5000).split()
        for k in range(5):
            held = passage[:]
            for _ in range(k % 3):
                held[rng.randrange(len(held))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join([prose(rng, 40, 5000), *held, prose(rng, 40, 5000)])))
    want = similar_by_brute_force(rows)
    got = {r.doc_id: {k for s, e in map(tuple, r.spans) for k in range(s, e)} for r in find_passages(docs_of(rows, 3)).collect()}
    # A passage is caught if nine tenths of its words go.
    caught = [len(got[b] & set(range(p, p + 50))) >= 45 for b, p in want]
    assert len(want) > 300 and sum(caught) >= 0.9 * len(want), (sum(caught), len(want))
    assert not any(got[i] for i in range(0, len(rows), 5))


def links(rows, n, percent):
    sets = {}
    for i, text in rows:
        w = words(text)
        grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
        sets.setdefault(i, []).append(grams)
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[:x]:
            for p in sets[i]:
                for q in sets[j]:
                    if p and q and 100 * len(p & q) >= percent * len(p | q) and root(i) != root(j):
                        a, b = sorted((root(i), root(j)))
                        parent[b] = a
    return sorted((i, len(g), root(i)) for i, text in rows for g in [sets[i].pop()])


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80), (1, 50)])
def test_linked_documents(docs_of, blocks, n, percent):
    rows = corpus(3)
    want = links(rows, n, percent)
    got = link_components(docs_of(rows, 3), n, percent).collect()
    assert sorted(map(tuple, got)) == want
    assert any(c != i for i, _, c in want)


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 140)} | {i: 200 for i in (200, 201, 202)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_empty_tables(docs_of):
    none = docs_of([])
    assert find_repeats(none).collect() == find_passages(none).collect() == link_components(none).collect() == []


def test_an_edited_passage_is_found_behind_documents_that_hold_parts_of_it(docs_of):
    rng, rows, edited = random.Random(5), [], []
    for _ in range(10):
        passage = prose(rng, 60, 5000).split()
        for k in range(12):
            begin = rng.randint(0, 20)
            held = passage if k == 6 else passage[begin : begin + 40]
            if k == 11:
                held = passage[:]
                held[30] = "changed"
                edited.append(len(rows))
            rows.append((len(rows), " ".join([prose(rng, 80, 5000), *held, prose(rng, 80, 5000)])))
    # The whole passage lies only in the middle document; those around it hold 40 of its words.
    got = {r.doc_id: r for r in find_passages(docs_of(rows, 3)).collect()}
    found = [sum(e - s for s, e in map(tuple, got[i].spans)) for i in edited]
    assert all(n >= 55 for n in found), found
    assert all(i - 5 in got[i].sources for i in edited)


def windows_of_a_crowd(rng, n_docs, functions, keys):
    """Windows of documents under shared keys, some of a few neighbouring keys in the same order."""
    rows = []
    for doc in range(n_docs):
        for h in range(functions):
            for k in rng.sample(range(keys), rng.randint(1, keys)):
                at = 60 * k + rng.randint(0, 3)
                rows.append((h * keys + k + 1, doc, h, at, at + 20, at + 50 + rng.randint(0, 9)))
    return np.array(rows, compact_windows.WINDOW)


def requests_by_part(windows, parts):
    given = {}
    for part, *crowds in compact_windows.crowds_of(windows, windows["doc"] % parts):
        given[part] = compact_windows.requests_of(*crowds)
    return sorted(tuple(q)[:6] for found in given.values() for q in found.tolist())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_requests_do_not_depend_on_parts_or_on_what_else_meets(seed):
    windows = windows_of_a_crowd(random.Random(seed), 12, 6, 4)
    got = requests_by_part(windows, 1)
    assert got and got == requests_by_part(windows, 5)
    alone = []
    for b in range(12):
        for a in range(b):
            alone += requests_by_part(windows[np.isin(windows["doc"], (a, b))], 1)
    assert got == sorted(alone)


def test_documents_that_meet_by_chance_take_no_memory_a_pair():
    # All documents share one key of each of three functions, too few for a passage: 13 million meetings.
    n = 3000
    windows = np.concatenate([np.array([(h + 1, doc, h, 0, 9, 60) for doc in range(n)], compact_windows.WINDOW) for h in range(3)])
    tracemalloc.start()
    assert requests_by_part(windows, 4) == []
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6, peak
