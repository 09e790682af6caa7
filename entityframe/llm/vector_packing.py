"""Training examples packed under limits on tokens, segments and loss-bearing tokens at once.

An example is a vector of demands. A sequence is filled by the dot-product rule:
of all examples that still fit, the one whose demands point most in the
direction of what the sequence has left comes next.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityframe.functions.numbering import column, number_rows, whole_div

END_ID = 1
TOKENIZER = "word_bpe_49k.json"
GROUP_BYTES = 8 << 20
ROW_BYTES = 64  # what a row weighs beside its text when groups are sized
CHUNK_CHARS = 1 << 20
PIECES_PER_CALL = 200
CACHED_WORDS = 300_000
CACHED_IDS = 4_000_000
ROWS_PER_BATCH = 2_000
TURNS_PER_EXAMPLE = 64


class Limits(NamedTuple):
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048
    shortest_cut: int = 16  # a gap below it is padded rather than filled with a stump


# Characters that Python's split takes for white space and the vocabulary does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_SURE_SPACE = re.compile("[ \t\n\r]+")
# Texts of these characters alone, in lower case, fall into the pieces below: what the
# vocabulary's own pattern and normal form make of them. The added tokens start with <|.
_UNUSUAL = re.compile("[^\t\n\r -~\u00c0-\u00ff\u2010-\u2027]|<[|]")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


class WordTokenizer:
    """Ids of many texts, equal to encoding each text alone.

    The vocabulary drops white space and never joins across it, so the tokenizer
    sees each distinct word once; in texts of usual characters, each distinct piece of a word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.at = np.zeros(1, np.int64)

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces from few calls; the last id of each closes a word, and no other does."""
        parts: list[int] = []
        for i in range(0, len(pieces), PIECES_PER_CALL):
            parts += self.tokenizer.encode(" ".join(pieces[i : i + PIECES_PER_CALL]), add_special_tokens=False).ids
        flat = np.array(parts, np.uint32)
        ends = np.flatnonzero(self.closes[flat])
        if len(ends) != len(pieces):
            raise ValueError("the vocabulary does not close each word with one id")
        return flat, np.diff(np.concatenate([[-1], ends]))

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter((i for ids in encoded for i in ids), np.uint32, int(counts.sum())), counts

    def _slots_of(self, words: list[str], encode) -> np.ndarray:
        slot = np.fromiter(map(self.slots.get, words, repeat(-1)), np.int64, len(words))
        unseen = np.flatnonzero(slot < 0)
        if len(unseen):
            new = list(dict.fromkeys(words[i] for i in unseen.tolist()))
            flat, counts = encode(new)
            if self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + len(flat), np.uint32)])
            self.ids[self.used : self.used + len(flat)] = flat
            self.slots.update(zip(new, range(len(self.at) - 1, len(self.at) - 1 + len(new))))
            self.at = np.concatenate([self.at, self.used + np.cumsum(counts)])
            self.used += len(flat)
            slot[unseen] = [self.slots[words[i]] for i in unseen.tolist()]
        return slot

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin."""
        if len(self.slots) > CACHED_WORDS or self.used > CACHED_IDS:
            self._forget()
        usual: list[str] = []
        other: list[str] = []
        edges: list[tuple[bool, int]] = []  # of each text: where its pieces or words end
        for text in texts:
            if _UNUSUAL.search(text):
                other += _SURE_SPACE.split(text) if _NOT_SPACE.search(text) else text.split()
                edges.append((True, len(other)))
            else:
                usual += _PIECES.findall(text.lower())
                edges.append((False, len(usual)))
        whole, part = self._slots_of(usual, self._encode_pieces), self._slots_of(other, self._encode_words)
        if len(other):
            # Back into the order of the texts.
            pieces, a, b = [], 0, 0
            for unusual, end in edges:
                pieces.append(part[b:end] if unusual else whole[a:end])
                a, b = (a, end) if unusual else (end, b)
            slot = np.concatenate(pieces)
            sizes = [len(p) for p in pieces]
        else:
            slot, sizes = whole, np.diff([0, *(end for _, end in edges)])
        counts = self.at[slot + 1] - self.at[slot]
        total = np.concatenate([[0], np.cumsum(counts)])
        out = self.ids[np.repeat(self.at[slot] - total[:-1], counts) + np.arange(total[-1])]
        return out, total[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]


def segments(text: str, limit: int = CHUNK_CHARS) -> Iterator[str]:
    """A long text in stretches that end at white space."""
    first = 0
    while len(text) - first > limit:
        last = max(text.rfind(c, first + 1, first + limit) for c in " \n\t")
        if last < 0:
            found = _SURE_SPACE.search(text, first + limit)
            if not found:
                break
            last = found.start()
        yield text[first:last]
        first = last
    yield text[first:] if first else text


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process, with what it has seen."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _encode_all(tokenizer: WordTokenizer, texts: list[str | None]) -> Iterator[np.ndarray]:
    """The ids of each text, a megabyte of characters at a time."""
    part, size = [], 0
    for text in [*texts, None]:
        text = text or ""
        if part and size + len(text) > CHUNK_CHARS:
            ids, off = tokenizer.encode(part)
            yield from (ids[a:b] for a, b in zip(off[:-1], off[1:]))
            part, size = [], 0
        if len(text) > CHUNK_CHARS:
            yield np.concatenate([tokenizer.encode([s])[0] for s in segments(text)])
        else:
            part.append(text)
            size += len(text)
    ids, off = tokenizer.encode(part[:-1])  # the last one only closes the list
    yield from (ids[a:b] for a, b in zip(off[:-1], off[1:]))


def cut_points(loss: np.ndarray | None, total: int, limits: Limits) -> list[int]:
    """Ends of the fewest pieces of an example, in order, that alone keep to the limits."""
    if loss is None:
        step = min(limits.tokens, limits.loss)
        return [*range(step, total, step), total]
    so_far = np.concatenate([[0], np.cumsum(loss != 0)])
    ends, at = [], 0
    while at < total:
        most = int(np.searchsorted(so_far, so_far[at] + limits.loss, "right")) - 1
        at = min(at + limits.tokens, most, total)
        ends.append(at)
    return ends


def _binary(values: np.ndarray, dtype: str) -> bytes:
    return np.ascontiguousarray(values, dtype).tobytes()


PIECE = "start bigint, doc_tokens bigint, ids binary, loss binary"


def _piece_batches(examples, id_type, limits: Limits) -> Iterator[pa.RecordBatch]:
    """``examples``: (id, ids, loss or None)."""
    rows: list[tuple] = []

    def batch():
        kinds = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "doc_tokens", "ids", "loss"])

    for key, ids, loss in examples:
        at = 0
        for end in cut_points(loss, len(ids), limits):
            own = None if loss is None else _binary(loss[at:end], "u1")
            rows.append((key, at, len(ids), _binary(ids[at:end], "<u4"), own))
            at = end
            if len(rows) >= ROWS_PER_BATCH:
                yield batch()
                rows = []
    if rows:
        yield batch()


def document_examples(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
    limits: Limits = Limits(),
) -> DataFrame:
    """Documents as ids and an end id, every one bearing loss: one row per piece that alone fits.

    ``loss`` is null, which means that all ids bear loss. A null or empty text is the end id alone.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            encoded = _encode_all(tokenizer, batch.column(1).to_pylist())
            closed = (np.append(ids, np.uint32(end_id)) for ids in encoded)
            rows = ((key, ids, None) for key, ids in zip(batch.column(0).to_pylist(), closed))
            yield from _piece_batches(rows, batch.schema.field(0).type, limits)

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, {PIECE}")


def chat_examples(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    answers: tuple[str, ...] = ("assistant",),
    path: str | None = None,
    end_id: int = END_ID,
    limits: Limits = Limits(),
) -> DataFrame:
    """Conversations as ids, each turn closed with the end id; only ``answers`` bear loss.

    Turns are in order of ``turn_col``; turns of one number by role, text and then as read.
    A conversation of more than 64 turns is several examples, so that one of any
    length is never collected whole. A null role bears no loss, a null text is the end id alone.
    """
    path = path or tokenizer_path()
    names = {"doc_id": id_col, "turn": turn_col, "role": role_col, "text": text_col}
    frame = turns.select(*(column(c).alias(n) for n, c in names.items()))
    frame = frame.withColumn("row", F.monotonically_increasing_id())
    placed = number_rows(frame, ["turn", "role", "text", "row"], ["doc_id"], into="place")
    block = whole_div(F.col("place") - 1, TURNS_PER_EXAMPLE).alias("block")
    one = F.struct("place", F.coalesce(F.col("role").isin(*answers), F.lit(False)).alias("answer"), "text")
    talks = placed.groupBy("doc_id", block).agg(F.array_sort(F.collect_list(one)).alias("turns"))
    talks = talks.select("doc_id", F.col("turns.text").alias("texts"), F.col("turns.answer").alias("answer"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            texts, answers_of = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            encoded = _encode_all(tokenizer, [t for talk in texts for t in talk])

            def example(flags):
                ids = [np.append(next(encoded), np.uint32(end_id)) for _ in flags]
                loss = np.repeat(np.array(flags, np.uint8), [len(own) for own in ids])
                return np.concatenate(ids), loss

            rows = ((key, *example(flags)) for key, flags in zip(batch.column(0).to_pylist(), answers_of))
            yield from _piece_batches(rows, batch.schema.field(0).type, limits)

    kind = turns.schema[id_col].dataType.simpleString()
    return talks.mapInArrow(run, f"doc_id {kind}, {PIECE}")


class _Classes:
    """Examples of equal demands, counted; a class keeps a stack of (example, first id in it)."""

    def __init__(self, tokens: np.ndarray, loss: np.ndarray):
        pairs, inverse = np.unique(np.stack([tokens, loss], 1), axis=0, return_inverse=True)
        self.known = {tuple(p): c for c, p in enumerate(pairs.tolist())}
        self.tokens, self.loss = pairs[:, 0].astype(np.float64), pairs[:, 1].astype(np.float64)
        self.stacks: list[list[tuple[int, int]]] = [[] for _ in pairs]
        for i in range(len(tokens) - 1, -1, -1):
            self.stacks[inverse[i]].append((i, 0))
        self.open = np.ones(len(pairs), bool)
        self.left = len(tokens)

    def take(self, c: int) -> tuple[int, int]:
        item = self.stacks[c].pop()
        self.open[c] = bool(self.stacks[c])
        self.left -= 1
        return item

    def put(self, tokens: int, loss: int, item: tuple[int, int]) -> None:
        c = self.known.setdefault((tokens, loss), len(self.stacks))
        if c == len(self.stacks):
            self.stacks.append([])
            self.tokens, self.loss = np.append(self.tokens, tokens), np.append(self.loss, loss)
            self.open = np.append(self.open, False)
        self.stacks[c].append(item)
        self.open[c] = True
        self.left += 1


def place(tokens: np.ndarray, masks: list[np.ndarray | None], limits: Limits) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (example, first id in it, number of ids), in order.

    Each example alone keeps to the limits. The sequence being filled takes, of all
    that fit, the example of the largest dot product of its demands with what is left,
    both as shares of the limits and weighted by the mean demand. Where none
    fits whole, the longest is cut to the gap and its rest goes back. The last
    sequence is cut at powers of two.
    """
    before = [None if m is None else np.concatenate([[0], np.cumsum(m != 0)]) for m in masks]

    def loss_of(i: int, a: int, b: int) -> int:
        return b - a if before[i] is None else int(before[i][b] - before[i][a])

    demands = np.array([loss_of(i, 0, int(n)) for i, n in enumerate(tokens)], np.int64)
    waiting = _Classes(np.asarray(tokens, np.int64), demands)
    caps = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
    mean = np.array([tokens.mean(), 1.0, demands.mean()]) if len(tokens) else np.ones(3)
    weight = mean / caps / caps**2
    out = []
    while waiting.left:
        own, gap, slots, loss = [], limits.tokens, limits.segments, limits.loss
        while gap and slots and waiting.left:
            fits = waiting.open & (waiting.tokens <= gap) & (waiting.loss <= loss)
            if fits.any():
                product = weight[0] * gap * waiting.tokens + weight[2] * loss * waiting.loss
                c = int(np.where(fits, product + weight[1] * slots, -1.0).argmax())
                length = int(waiting.tokens[c])
                i, at = waiting.take(c)
            else:
                c = int(np.where(waiting.open, waiting.tokens, -1.0).argmax())
                i, at = waiting.stacks[c][-1]
                whole, length = int(waiting.tokens[c]), min(gap, int(waiting.tokens[c]))
                if before[i] is None:
                    length = min(length, loss)
                else:
                    length = min(length, int(np.searchsorted(before[i], before[i][at] + loss, "right")) - 1 - at)
                if length < limits.shortest_cut:
                    break
                waiting.take(c)
                if length < whole:
                    rest = at + length
                    waiting.put(whole - length, loss_of(i, rest, at + whole), (i, rest))
            own.append((i, at, length))
            gap, slots, loss = gap - length, slots - 1, loss - loss_of(i, at, at + length)
        out.append(own)
    return out[:-1] + _at_powers(out[-1], limits.tokens) if out else out


def _at_powers(sequence: list[tuple[int, int, int]], full: int) -> list[list[tuple[int, int, int]]]:
    """A sequence cut so that each part's length is a power of two and nothing is padded."""
    total = sum(length for _, _, length in sequence)
    if total == full:
        return [sequence]
    out = []
    for bit in range(total.bit_length() - 1, -1, -1):
        want, own = total & (1 << bit), []
        while want:
            i, at, length = sequence[0]
            part = min(want, length)
            own.append((i, at, part))
            want -= part
            sequence = ([(i, at + part, length - part)] if part < length else []) + sequence[1:]
        if own:
            out.append(own)
    return out


def pack_examples(examples: DataFrame, groups: int, limits: Limits = Limits()) -> DataFrame:
    """Rows of ``document_examples`` or ``chat_examples`` placed into sequences.

    Returns ``doc_id, start, length, doc_tokens, sequence_id, offset, ids, loss``, one row per
    piece. Rows are dealt in turn into ``groups``, each packed by one task, so
    copies of one row or a null id never meet in one place. A sequence keeps to all
    limits; each id of an example is in one piece.
    """
    dealt = examples.withColumn("_group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("bigint"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending")])
        ids = [np.frombuffer(b, "<u4") for b in table.column("ids").to_pylist()]
        masks = [None if b is None else np.frombuffer(b, np.uint8) for b in table.column("loss").to_pylist()]
        sequences = place(np.fromiter(map(len, ids), np.int64, len(ids)), masks, limits)
        rows, group = [], table.column("_group")[0].as_py()
        for number, own in enumerate(sequences):
            offset = 0
            for i, at, length in own:
                loss = None if masks[i] is None else masks[i][at : at + length].tobytes()
                rows.append((i, at, length, (group << 32) + number, offset, ids[i][at : at + length].tobytes(), loss))
                offset += length
        which, at, length, number, offset, parts, loss = zip(*rows)
        which = pa.array(which)
        starts = table.column("start").take(which).to_numpy() + np.array(at)
        return pa.table(
            {
                "doc_id": table.column("doc_id").take(which),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "doc_tokens": table.column("doc_tokens").take(which),
                "sequence_id": pa.array(number, pa.int64()),
                "offset": pa.array(offset, pa.int64()),
                "ids": pa.array(parts, pa.binary()),
                "loss": pa.array(loss, pa.binary()),
            }
        )

    kind = examples.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
        "offset bigint, ids binary, loss binary"
    )
    return dealt.groupBy("_group").applyInArrow(run, schema)


def group_count(texts: DataFrame, text_col: str = "text", group_bytes: int = GROUP_BYTES) -> int:
    """Groups of about eight megabytes of text, rows without text weighed too."""
    weight = F.coalesce(F.octet_length(column(text_col)), F.lit(0)) + ROW_BYTES
    total = texts.agg(F.sum(weight.cast("bigint")).alias("b")).first()["b"] or 0
    return max(1, -(-total // group_bytes))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Whole documents packed. Repeated rows are packed once each; null ids stay null.

    Other columns play no part, and an empty table gives an empty result.
    """
    examples = document_examples(docs, id_col, text_col, limits=limits)
    return pack_examples(examples, group_count(docs, text_col), limits)


def pack_conversations(turns: DataFrame, limits: Limits = Limits(), **names) -> DataFrame:
    """Conversations packed, ``doc_id`` being the conversation's; ``loss`` marks the ids of answers."""
    groups = group_count(turns, names.get("text_col", "text"))
    return pack_examples(chat_examples(turns, limits=limits, **names), groups, limits)


def op13_vector_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    packed = pack_documents(docs)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
