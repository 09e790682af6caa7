import base64
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from entityframe.llm.packing import (
    BatchTokenizer,
    pack,
    pack_documents,
    pack_lengths,
    tokenize_pieces,
    tokenizer_path,
)

TEXTS = [
    "", None, "a  b\n\n c", "it's we'll 's  's x's'tt !'s  're\t x  ", "  ", " x", "don't  \n 12 3rd ²½", " <|endoftext|> x",
    "ünïcode — “quotes” 日本語  العربية 👩‍👩‍👧 é", "\r\n\r\n\x0b   x  y", "I'M 'S 'Ve ''s '",
]


@pytest.fixture(scope="module")
def plain():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    one = Tokenizer.from_file(tokenizer_path())

    def encode(text):
        ids = one.encode(text or "", add_special_tokens=False).ids
        assert "<|endoftext|>" in (text or "") or ids == other.encode_ordinary(text or "")
        return ids

    return encode


def test_batches_equal_the_tokenizer_text_by_text(plain):
    rng = random.Random(1)
    pieces = [" ", "  ", "\n", "a", "é", "日", "1", "٣", "!", "'", "'s", "'ll", "re", "\t", "_", "👍", "<|endoftext|>", "Ab"]
    texts = TEXTS + ["".join(rng.choices(pieces, k=rng.randint(1, 25))) for _ in range(800)]
    ids, off = BatchTokenizer(tokenizer_path()).encode([t or "" for t in texts])
    for i, text in enumerate(texts):
        assert ids[off[i] : off[i + 1]].tolist() == plain(text), text


def test_pieces_and_places_are_an_exact_round_trip(docs_of, plain):
    rows = list(enumerate(TEXTS)) + [(50, "word " * 5000), (51, "x" * 3000), (3, TEXTS[3])]
    got = pack_documents(docs_of(rows)).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, text in rows:
        ids = plain(text) + [2]
        own = sorted(pieces[i], key=lambda r: (r.start, r.piece))
        own = own[:: 2 if i == 3 else 1]
        assert [r.piece for r in own] == list(range(len(own)))
        assert sum(r.length for r in own) == len(ids) and (len(own) == 1 or len(ids) > 1024)
        assert all(r.length == 1024 for r in own[1:])
        for r in own:
            part = ids[r.start : r.start + r.length]
            assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r.ids_crc32
    for rows_of in sequences.values():
        at = 0
        for r in sorted(rows_of, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert pack_documents(docs_of([])).collect() == []


def test_added_tokens_are_those_of_the_tokenizer(plain):
    texts = ["<|endoftext|>", " <|endoftext|> x", "a<|endoftext|><|endoftext|> b", "<|endoftext|", "", "x"]
    ids, off = BatchTokenizer(tokenizer_path()).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [plain(t) for t in texts]
    assert plain(texts[1]) == [220, 50256, 2124]


def test_copies_and_rows_without_an_id_spread_over_groups(spark):
    rows = [(None, 0, 0, 5, 1)] * 3000 + [(4, 0, 0, 7, 2)] * 3000
    pieces = spark.createDataFrame(rows, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    packed = pack(pieces.repartition(4), group_rows=500).collect()
    groups = Counter((r.doc_id, r.sequence_id >> 32) for r in packed)
    assert len(packed) == 6000 and max(groups.values()) <= 600 and len({g for _, g in groups}) == 12


def test_ids_are_kept_on_request(docs_of, plain):
    rows = tokenize_pieces(docs_of([(1, "some words")]), with_ids=True).collect()
    assert rows[0].ids == plain("some words") + [2]


@pytest.mark.parametrize("seed", range(4))
def test_bins_are_few(seed):
    lengths = np.random.default_rng(seed).integers(1, 1025, 6000)
    bins, offsets, made = pack_lengths(lengths)
    used = np.bincount(bins, weights=lengths, minlength=made)
    assert used.max() <= 1024 and (used > 0).all()
    assert made <= 1.02 * -(-lengths.sum() // 1024)


def test_perfect_fits_leave_no_gap():
    lengths = np.array([600, 424, 1024, 512, 512, 1, 1023, 700, 324])
    assert pack_lengths(lengths)[2] == 5


def test_text_chunks_hold_only_a_chunk_of_a_batch():
    import tracemalloc

    import pyarrow as pa

    from entityframe.llm.packing import _text_chunks

    limit = 1 << 16
    texts = pa.array([None if i % 7 == 0 else f"{i} " * 300 for i in range(4000)])  # about 16 limits
    tracemalloc.start()
    seen = []
    for first, part in _text_chunks(texts, limit):
        seen.append((first, len(part), hash(part[0]), hash(part[-1])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    rows = [t or "" for t in texts.to_pylist()]
    assert peak < sum(map(len, rows)) / 4
    assert [f for f, _, _, _ in seen] == [0, *np.cumsum([n for _, n, _, _ in seen])[:-1].tolist()]
    assert sum(n for _, n, _, _ in seen) == len(rows)
    assert all(hash(rows[f]) == a and hash(rows[f + n - 1]) == b for f, n, a, b in seen)
