"""Tokenised documents packed into fixed-length sequences by the sum-of-squares rule."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityframe.llm.store import stage
from entityframe.llm.text import range_hashes

SEQUENCE = 1024
END_ID = 2
PIECES_PER_GROUP = 20_000
CHUNK_CHARS = 1 << 19
CACHED_PIECES = 300_000
TOKENIZER = "byte_bpe_50k.json"

_SPACE, _LETTER, _NUMBER, _OTHER, _UNSEEN = 0, 1, 2, 3, 255


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_symbols() -> dict[int, str]:
    """The character a byte-level vocabulary writes each byte as: visible ones are themselves."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(others)}


_SYMBOLS = _byte_symbols()


def _as_symbols(piece: str) -> str:
    return piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(_SYMBOLS)


class BatchTokenizer:
    """Ids of many texts, equal to encoding each text alone.

    A byte-level BPE vocabulary is applied to pieces of the text (words with
    the space before them, numbers, marks, white space). The pieces are found
    for all texts at once, and the tokenizer sees each distinct piece once. The
    kind of a character is asked of the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = added
        longest_first = sorted(map(re.escape, added), key=len, reverse=True)
        self.added_pattern = re.compile(f"({'|'.join(longest_first)})") if added else None
        self.kinds = np.full(0x110000, _UNSEEN, np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.at = np.zeros(1, np.int64)

    def _learn(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kinds[points]
        if (kinds == _UNSEEN).any():
            split = self.tokenizer.pre_tokenizer.pre_tokenize_str
            for point in np.unique(points[kinds == _UNSEEN]):
                c, kind = chr(point), _SPACE
                for probe, is_kind in (("a", _LETTER), ("1", _NUMBER), ("!", _OTHER)):
                    if len(split(probe + c + probe)) == 1:
                        kind = is_kind
                self.kinds[point] = kind
            kinds = self.kinds[points]
        return kinds

    def _starts(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where pieces start. ``first``: where texts start, without empty ones."""
        kinds = self._learn(points)
        n = len(points)
        run = np.ones(n, bool)
        run[1:] = kinds[1:] != kinds[:-1]
        run[first] = True
        begin = np.flatnonzero(run)
        end = np.append(begin[1:], n)
        new_text = np.zeros(n + 1, bool)
        new_text[first] = True
        new_text[n] = True
        kind = kinds[begin]
        cut = run.copy()
        # White space before something else gives up its last character, and a blank joins what follows.
        space = kind == _SPACE
        inner = space & ~new_text[end]
        cut[end[inner] - 1] = True
        joined = inner & (points[end - 1] == 32)
        cut[end[joined]] = False
        # 's 't 'm 'd 're 've 'll, where a piece starts at the mark.
        mark = np.flatnonzero(
            (kind[:-1] == _OTHER)
            & (end[:-1] - begin[:-1] == 1)
            & (points[begin[:-1]] == 39)
            & cut[begin[:-1]]
            & (kind[1:] == _LETTER)
            & ~new_text[begin[1:]]
        )
        if len(mark):
            at, stop = begin[mark + 1], end[mark + 1]
            one = points[at]
            two = points[np.minimum(at + 1, n - 1)]
            size = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
            long = at + 1 < stop
            for a, b in ("re", "ve", "ll"):
                size[long & (one == ord(a)) & (two == ord(b))] = 2
            found = size > 0
            cut[at[found]] = False
            rest = (at + size)[found]
            cut[rest[rest < stop[found]]] = True
        return np.flatnonzero(cut)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin.

        As in the tokenizer, the vocabulary's added tokens are found first, and what lies between
        them is encoded on its own.
        """
        pattern = self.added_pattern
        if pattern is None or not any(pattern.search(t) for t in texts):
            return self._encode_plain(texts)
        parts = [pattern.split(t) for t in texts]  # every second one is an added token
        ids, off = self._encode_plain([p for own in parts for p in own[::2]])
        out, sizes, at = [], [], 0
        for own in parts:
            size = 0
            for k, part in enumerate(own):
                if k % 2:
                    piece = np.array([self.added[part]], np.uint32)
                else:
                    piece, at = ids[off[at] : off[at + 1]], at + 1
                out.append(piece)
                size += len(piece)
            sizes.append(size)
        return np.concatenate(out), np.concatenate([[0], np.cumsum(sizes)])

    def _encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        off = np.concatenate([[0], np.cumsum(sizes)])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(points):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        starts = self._starts(points, off[:-1][sizes > 0])
        ends = np.append(starts[1:], len(points))
        keys = range_hashes(points.astype(np.uint64) + np.uint64(1), starts, ends)
        unique, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.slots) > CACHED_PIECES:
            self._forget()
        get = self.slots.get
        slot = np.array([get(k, -1) for k in unique.tolist()], np.int64)
        new = np.flatnonzero(slot < 0)
        if len(new):
            a, b = starts[where[new]].tolist(), ends[where[new]].tolist()
            model = self.tokenizer.model.tokenize
            encoded = [[t.id for t in model(_as_symbols(joined[i:j]))] for i, j in zip(a, b)]
            slot[new] = np.arange(len(new)) + len(self.slots)
            self.slots.update(zip(unique[new].tolist(), slot[new].tolist()))
            counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
            flat = np.fromiter((i for ids in encoded for i in ids), np.uint32, int(counts.sum()))
            if self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + len(flat), np.uint32)])
            self.ids[self.used : self.used + len(flat)] = flat
            self.at = np.concatenate([self.at, self.used + np.cumsum(counts)])
            self.used += len(flat)
        slot = slot[inverse]
        counts = self.at[slot + 1] - self.at[slot]
        total = np.concatenate([[0], np.cumsum(counts)])
        out = self.ids[np.repeat(self.at[slot] - total[:-1], counts) + np.arange(total[-1])]
        return out, total[np.searchsorted(starts, off)]


_TOKENIZERS: dict[str, BatchTokenizer] = {}


def batch_tokenizer(path: str) -> BatchTokenizer:
    """One per worker process, with what it has seen."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = BatchTokenizer(path)
    return _TOKENIZERS[path]


def _text_chunks(texts: pa.Array, limit: int | None = None) -> Iterator[tuple[int, list[str]]]:
    """Rows of ``texts`` in turn, about ``limit`` characters at a time: only those become Python strings."""
    limit = limit or CHUNK_CHARS
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).tolist()
    first, size = 0, 0
    for i, length in enumerate(sizes):
        size += length
        if size >= limit or i + 1 == len(sizes):
            yield first, [t or "" for t in texts.slice(first, i + 1 - first).to_pylist()]
            first, size = i + 1, 0


def cut_lengths(total: int, size: int) -> list[int]:
    """Lengths of a document's pieces: the first one takes the rest, the others are full."""
    head = total % size or size
    return [head] + [size] * ((total - head) // size)


def tokenize_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    size: int = SEQUENCE,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` (and ``ids`` if asked for)."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = batch_tokenizer(path)
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for first, texts in _text_chunks(batch.column(1)):
                ids, off = tokenizer.encode(texts)
                rows: list[tuple] = []
                for i in range(len(texts)):
                    own = np.append(ids[off[i] : off[i + 1]], np.uint32(end_id))
                    at = 0
                    for k, length in enumerate(cut_lengths(len(own), size)):
                        data = own[at : at + length].astype("<u4").tobytes()
                        row = (ids_of[first + i], k, at, length, zlib.crc32(data))
                        rows.append((*row, own[at : at + length].tolist()) if with_ids else row)
                        at += length
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                if with_ids:
                    names, kinds = [*names, "ids"], [*kinds, pa.list_(pa.int64())]
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], names=names
                )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    if with_ids:
        schema += ", ids array<bigint>"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def pack_lengths(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, and the number of bins.

    Pieces come longest first. Each goes where the sum over gaps of the squared
    number of open bins with that gap becomes smallest. Bins still open at the
    end are emptied and their pieces placed once more into the tightest gap
    that takes them, as no later piece needs a variety of gaps any more.
    """
    bins, offsets, made = _place(lengths, size, squares=True)
    full = np.bincount(bins, weights=lengths, minlength=made) == size
    loose = np.flatnonzero(~full[bins]) if made else np.zeros(0, np.int64)
    again, again_offsets, again_made = _place(lengths[loose], size, squares=False)
    closed = int(full.sum())
    if closed + again_made < made:
        number = np.cumsum(full) - 1
        bins = number[bins]
        bins[loose], offsets[loose] = closed + again, again_offsets
        made = closed + again_made
    return bins, offsets, made


def _place(lengths: np.ndarray, size: int, squares: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """Longest first, into an open bin of some gap or a new bin; ties take the smallest gap.

    A bin that takes a piece leaves the class of its gap and enters that of
    what remains; full bins are closed.
    """
    order = np.argsort(-lengths, kind="stable")
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]
    count = np.zeros(size + 1, np.int64)
    never = np.iinfo(np.int64).max // 2
    step = np.full(size + 1, 2, np.int64)
    step[0] = 1
    bins, offsets, made = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i, s in zip(order.tolist(), lengths[order].tolist()):
        left, now = count[: size + 1 - s], count[s:]
        if squares:
            change = np.where(now > 0, 2 * (left - now) + step[: size + 1 - s], never)
            fresh = 2 * int(count[size - s]) + 1 if s < size else 0
        else:
            change, fresh = np.where(now > 0, 0, never), 1
        best = int(change.argmin())
        if change[best] <= fresh:
            gap = best + s
            bin_no = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, bin_no, made = size, made, made + 1
        bins[i], offsets[i] = bin_no, size - gap
        if gap > s:
            open_bins[gap - s].append(bin_no)
            count[gap - s] += 1
    return bins, offsets, made


def pack(pieces: DataFrame, size: int = SEQUENCE, group_rows: int = PIECES_PER_GROUP) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; no sequence is longer than ``size``.

    Pieces, which should be a written table, are dealt in turn into groups of about ``group_rows``,
    each packed by one task, so memory and time per task stay the same at any size and copies of a
    row, or rows without an id, do not meet in one group. What a
    group wastes is a few sequences, far below one in a hundred.
    """
    groups = max(1, -(-pieces.count() // group_rows))
    dealt = pieces.withColumn(
        "_group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("bigint")
    )

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        lengths = table.column("length").to_numpy()
        bins, offsets, _ = pack_lengths(lengths, size)
        group = table.column("_group")[0].as_py()
        out = table.drop_columns(["_group"])
        out = out.append_column("sequence_id", pa.array((group << 32) + bins))
        return out.append_column("offset", pa.array(offsets))

    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    return dealt.groupBy("_group").applyInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Documents tokenised, closed with the end id, cut and packed: one row per piece.

    Only documents of more than ``size`` ids are cut; their first piece takes
    the rest and may be shorter. A null or empty text is the end id alone.
    Repeated rows are packed once each. Other columns play no part; an empty
    table gives an empty result.
    """
    pieces = stage(tokenize_pieces(docs, id_col, text_col, **options), "pieces")
    return pack(pieces, options.get("size", SEQUENCE))


def op5_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs)
