"""Ids against the unmodified tokenizer, exact round trips, and limits that bind."""

import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from entityframe.llm.vector_packing import (
    Limits,
    WordTokenizer,
    chat_examples,
    cut_points,
    op13_vector_packing,
    pack_conversations,
    pack_documents,
    place,
    segments,
    tokenizer_path,
)

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　​﻿"
TEXTS = [
    "", None, "  ", "a  B\n\n c", "It's we'll 's  's x's'tt !'s  're\t x", "x<|endoftext|>y <|startoftext|> Z", "12 3rd ²½",
    "é ́e Å İstanbul ΣΑΣ", "ünïcode — “quotes” 日本語 العربية 👩‍👩‍👧", *(f"a{c}b 'S{c}t" for c in SPACES),
]


@pytest.fixture(scope="module")
def plain():
    one = Tokenizer.from_file(tokenizer_path())
    return lambda text: one.encode(text or "", add_special_tokens=False).ids


def test_batches_equal_the_tokenizer_text_by_text(plain):
    rng = random.Random(2)
    bits = [*SPACES, "a", "É", "é", "́", "日", "1", "٣", "!", "'", "'s", "'LL", "re", "_", "👍", "<|endoftext|>", "<|", "␀", "␁"]
    texts = TEXTS + ["".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(800)]
    usual = [*"ab'sÉÿ×÷-–9!<>| \n", "'S", "'re", "It's", "ß", "’", "..."]
    texts += ["".join(rng.choices(usual, k=rng.randint(1, 25))) for _ in range(800)]
    ids, off = WordTokenizer(tokenizer_path()).encode([t or "" for t in texts])
    for i, text in enumerate(texts):
        assert ids[off[i] : off[i + 1]].tolist() == plain(text), repr(text)


def test_segments_lose_nothing():
    for text in ("", "abc", "ab cd ef " * 50, "x" * 300, "x" * 90 + " " + "y" * 90):
        parts = list(segments(text, 40))
        assert "".join(parts) == text and [w for p in parts for w in p.split()] == text.split()


def check_round_trip(rows, got, expected, limits):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    padded = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(own) <= limits.segments
        padded += 0 if at & (at - 1) == 0 else limits.tokens - at
    for key, ids in expected.items():
        own = sorted(pieces[key], key=lambda r: r.start)
        flat = [i for r in own for i in struct.unpack(f"<{r.length}I", r.ids)]
        assert flat == ids, key
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        assert {r.doc_tokens for r in own} == {len(ids)}
    assert set(pieces) == set(expected)
    return padded


def test_documents_are_an_exact_round_trip(docs_of, plain):
    rows = list(enumerate(TEXTS)) + [(100, "word " * 9000), (101, "ab" * 3000), (102, "z 12 " * 300_000)]
    got = pack_documents(docs_of(rows)).collect()
    padded = check_round_trip(rows, got, {i: plain(t) + [1] for i, t in rows}, Limits())
    assert padded < 16 * len({r.sequence_id for r in got})
    assert pack_documents(docs_of([])).collect() == []


def test_repeated_rows_and_null_ids_are_packed_once_each(docs_of, plain):
    rows = [(None, "one two three")] * 30 + [(7, "same text")] * 20
    got = pack_documents(docs_of(rows)).collect()
    assert sum(r.length for r in got if r.doc_id is None) == 30 * (len(plain("one two three")) + 1)
    assert sum(r.length for r in got if r.doc_id == 7) == 20 * (len(plain("same text")) + 1)


def test_query_keeps_every_id_and_pads_little(spark, data, plain):
    got = op13_vector_packing(spark, data).collect()
    docs = {r.doc_id: plain(r.text) + [1] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    size, pieces = defaultdict(int), defaultdict(int)
    for r in got:
        part = docs[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r.ids_crc32
        assert len(part) == r.length and r.doc_tokens == len(docs[r.doc_id])
        size[r.sequence_id] += r.length
        pieces[r.doc_id] += r.length
    assert pieces == {i: len(ids) for i, ids in docs.items()}
    padded = sum(2048 - n for n in size.values() if n & (n - 1))
    assert max(size.values()) <= 2048 and padded <= 0.005 * sum(size.values())


def test_cut_points_keep_to_both_limits():
    limits = Limits(tokens=8, loss=3)
    loss = np.array([0] * 5 + [1] * 7 + [0] * 9)
    assert cut_points(loss, 21, limits) == [8, 11, 19, 21]
    assert cut_points(np.ones(7), 7, limits) == [3, 6, 7]
    assert cut_points(None, 7, limits) == [3, 6, 7]


@pytest.mark.parametrize("seed", range(3))
def test_all_limits_hold_where_they_bind(seed):
    rng = np.random.default_rng(seed)
    limits = Limits(tokens=256, segments=6, loss=90, shortest_cut=4)
    masks, tokens = [], []
    for _ in range(600):
        n = int(rng.integers(1, 200))
        mask = (rng.random(n) < rng.random() * 0.8).astype(np.uint8)
        end = cut_points(mask, n, limits)[0]
        masks.append(mask[:end])
        tokens.append(end)
    out = place(np.array(tokens), masks, limits)
    seen = [np.zeros(n, int) for n in tokens]
    for own in out:
        assert sum(n for _, _, n in own) <= 256 and len(own) <= 6
        assert sum(int(masks[i][a : a + n].sum()) for i, a, n in own) <= 90
        for i, a, n in own:
            seen[i][a : a + n] += 1
    assert all((s == 1).all() for s in seen)
    bound = max(sum(tokens) / 256, sum(int(m.sum()) for m in masks) / 90, len(tokens) / 6)
    assert len(out) <= 1.12 * bound + 12


def test_the_dot_product_chooses():
    # After (60 tokens, 1 of loss) much loss is left: (40, 30) points that way, (40, 2) does not.
    masks = [np.r_[np.ones(k), np.zeros(n - k)].astype(np.uint8) for n, k in ((60, 1), (40, 2), (40, 30), (60, 30))]
    out = place(np.array([60, 40, 40, 60]), masks, Limits(100, 4, 32))
    assert sorted(sorted(i for i, _, _ in own) for own in out[:2]) == [[0, 2], [1, 3]]


def test_conversations_bear_loss_in_answers_only(spark, plain):
    rows = [(1, 0, "user", "hello there"), (1, 1, "assistant", "general reply"), (2, 0, None, None), (None, 0, "assistant", "x")]
    rows += [(3, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(150)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").repartition(3)
    limits = Limits(tokens=128, segments=8, loss=48)
    got = pack_conversations(turns, limits).collect()
    loss_in, ids_of = defaultdict(int), defaultdict(int)
    for r in got:
        assert len(r.loss) == r.length == len(r.ids) // 4
        loss_in[r.sequence_id] += sum(r.loss)
        ids_of[r.doc_id] += r.length
    assert max(loss_in.values()) <= 48
    want = defaultdict(int)
    for conv, _, role, text in rows:
        want[conv] += len(plain(text)) + 1
    assert ids_of == want
    assert sum(loss_in.values()) == sum(len(plain(t)) + 1 for _, _, role, t in rows if role == "assistant")
    assert chat_examples(turns.limit(0)).count() == 0
