"""Exact substring deduplication across documents by suffix order and a Burrows-Wheeler transform.

Every byte inside a string of 50 bytes that also starts in a document with a
smaller id is removed. All strings of 50 bytes ("windows") are judged:

1. A window's key is the smallest hash among its 20-byte grams, so equal windows
   have equal keys. Neighbouring windows mostly share theirs: a run of windows
   with one key is a fragment of some seventy bytes. Keys that only one document
   holds are dropped (``shared.py``), and with them most of the text.
2. Fragments are dealt by key. A bucket sorts the suffixes of its distinct
   fragments and derives which share their first 50 bytes level by level: a
   suffix and the one sorted before it agree on one more byte than the two
   suffixes after their first bytes do. Common prefixes thus come in
   increasing length, breadth first, and the expansion stops at 50. Each group
   of equal windows learns the smallest document it is in.
3. That document goes back, per window, to the blocks the fragments came from,
   where a window is removed from every larger document.

The text is shuffled once, and that exchange serves all three steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityframe.llm import shared
from entityframe.llm.text import (
    BYTE_VALUES,
    CHUNK_BYTES,
    blob,
    byte_view,
    chunks,
    mix,
    powers,
    sliding_min,
)

MIN_BYTES = 50
GRAM = 20
BYTES_PER_KEY = 15.0
# Buckets of fragments are this many times finer than those of keys.
FINER_BITS = 4
LAST = np.iinfo(np.int64).max

FRAGMENTS = """bucket int, block int, keys binary, sizes binary, bytes binary,
               smallest binary, largest binary"""
REPLY = "block int, fragments binary, documents binary, lengths binary"


class _Hashes:
    """Hashes of any byte ranges of one part."""

    def __init__(self, buf: np.ndarray):
        power, self.inverse = powers(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[buf] * power[: len(buf)], out=self.sums[1:])

    def grams(self, n: int) -> np.ndarray:
        return mix((self.sums[n:] - self.sums[:-n]) * self.inverse[: len(self.sums) - n])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _parts(buf: np.ndarray, off: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, bytes, offsets) of whole short texts together, or of overlapping parts of a long one.

    Parts are cut by their place in the text, so a text is always cut alike.
    """
    for a, b in chunks(off):
        size = off[b] - off[a]
        if b - a > 1 or size <= CHUNK_BYTES + length:
            yield int(off[a]), buf[off[a] : off[b]], off[a : b + 1] - off[a]
            continue
        for at in range(0, int(size) - length + 1, CHUNK_BYTES):
            part = buf[off[a] + at : min(off[b], off[a] + at + CHUNK_BYTES + length - 1)]
            yield int(off[a]) + at, part, np.array([0, len(part)], np.int64)


def fragments(buf: np.ndarray, off: np.ndarray, length: int = MIN_BYTES, gram: int = GRAM):
    """(starts, ends, keys, names) of the runs of windows with one key.

    Bytes ``start:end`` hold the run; the name is a hash of them.
    """
    none = np.zeros(0, np.int64)
    out = [(none, none, none.view(np.uint64), none.view(np.uint64))]
    for base, part, ends in _parts(buf, off, length):
        if len(part) < length:
            continue
        hashes = _Hashes(part)
        key = sliding_min(hashes.grams(gram), length - gram + 1)
        key = np.maximum(key, np.uint64(1))
        stop = np.repeat(ends[1:], np.diff(ends))[: len(key)]
        key[np.arange(len(key)) + length > stop] = 0  # windows end inside their text
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        new[ends[:-1][ends[:-1] < len(key)]] = True
        at = np.flatnonzero(new)
        till = np.append(at[1:], len(key))
        real = key[at] > 0
        at, till = at[real], till[real]
        till = till + length - 1
        # Smallest hashes crowd near zero; scrambled again they fall evenly into buckets.
        out.append((base + at, base + till, mix(key[at]), hashes.ranges(at, till)))
    return tuple(np.concatenate(column) for column in zip(*out))


def _document_of(starts: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.searchsorted(off, starts, "right") - 1


def common_prefix_groups(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``text`` and, for each place in it, whether a new group begins there.

    Suffixes of one group agree on their first ``length`` values.
    """
    n = len(text)
    order, rank = _suffix_order(text, length)
    # The suffix after the first value: the inverse of the transform's last-to-first step.
    after = np.append(rank, n)[order + 1]  # n: nothing follows
    first = text[order]
    opens = np.ones(n + 1, bool)
    opens[1:n] = first[1:] != first[:-1]
    waiting = np.flatnonzero(~opens[:n])
    mine, before = after[waiting], after[waiting - 1]
    for _ in range(1, length):
        group = np.cumsum(opens)
        parted = group[mine] != group[before]
        opens[waiting[parted]] = True
        waiting, mine, before = waiting[~parted], mine[~parted], before[~parted]
        if not len(waiting):
            break
    return order, opens[:n]


def _suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes ordered by at least their first ``depth`` values (1..511), by doubling."""
    n = len(text)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(8, np.uint64)])
    key = np.zeros(n, np.uint64)
    for k in range(7):
        key = (key << np.uint64(9)) | padded[k : k + n]
    known = 7
    order = np.argsort(key)
    while True:
        ordered = key[order]
        step = np.zeros(n, np.uint64)
        step[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(step)
        if known >= depth or (n and rank[order[-1]] == n - 1):
            break
        following = np.zeros(n, np.uint64)
        following[: max(0, n - known)] = rank[known:] + np.uint64(1)
        key = (rank << np.uint64(32)) | following
        order = np.argsort(key)
        known *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of all ranges ``start : start + size`` in a row."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def smallest_documents(data: np.ndarray, sizes: np.ndarray, smallest: np.ndarray, length: int) -> np.ndarray:
    """For each window of each fragment, the smallest document that any equal window is in."""
    windows = sizes - length + 1
    # One separator after each fragment; no window reaches it.
    at = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.ones(int((sizes + 1).sum()), np.uint16)
    text[_ragged(at, sizes)] = data.astype(np.uint16) + 2
    document = np.full(len(text), LAST, np.int64)
    place = _ragged(at, windows)
    document[place] = np.repeat(smallest, windows)
    order, opens = common_prefix_groups(text, length)
    begin = np.flatnonzero(opens)
    least = np.minimum.reduceat(document[order], begin)
    document[order] = np.repeat(least, np.diff(np.append(begin, len(text))))
    return document[place]


def _blobs(table: pa.Table, name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(b, kind) for b in table.column(name).to_pylist()]


def find_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = MIN_BYTES
) -> DataFrame:
    """``doc_id, n_bytes, removed, kept`` per row: removed byte runs (start, end), and the bytes left.

    A byte goes if some ``length``-byte string over it also starts in a
    document with a smaller id; strings are judged on the whole input, and
    never reach across documents. A null text is empty. Rows of one id are one
    document, so they never remove from each other; a row without an id comes
    after all others and is returned with a null id. Texts shorter than
    ``length`` stay whole. An empty table gives an empty result. Cuts may fall
    inside a character, so what is left is bytes. Other columns play no part.

    Scale: a block holds about four megabytes of text, a bucket some hundred
    thousand fragments, whatever the size of the input. Equal fragments of a
    block travel once, so a passage in a third of all documents weighs no more
    in its bucket than there are blocks.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(LAST))).alias("doc"),
        F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8").alias("text"),
    )
    deal = shared.plan(rows, "text", BYTES_PER_KEY)
    finer = deal._replace(bits=deal.bits + FINER_BITS)
    dealt = rows.withColumn("block", shared.block_of("doc", deal)).repartition("block")

    def send_keys(table: pa.Table) -> pa.Table:
        buf, off = byte_view(table.column("text"))
        starts, _, keys, _ = fragments(buf, off, length)
        # Rows of one id are one document.
        owner = table.column("doc").to_numpy()[_document_of(starts, off)]
        keys = shared.cut(keys, deal)
        order = np.lexsort((owner, keys))
        keys, owner = keys[order], owner[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        keys, counts = shared.count_keys(keys[new])
        return shared.send(table.column("block")[0].as_py(), keys, counts, deal)

    def send_fragments(table: pa.Table, answer: pa.Table) -> pa.Table:
        buf, off = byte_view(table.column("text"))
        held = shared.Held(answer)
        out: dict[str, list] = {
            name: [] for name in ("bucket", "keys", "sizes", "bytes", "smallest", "largest")
        }
        if len(held.keys) and len(buf):
            starts, ends, keys, names = fragments(buf, off, length)
            many = held.documents(shared.cut(keys, deal)) > 1
            starts, ends, keys, names = starts[many], ends[many], keys[many], names[many]
            owner = table.column("doc").to_numpy()[_document_of(starts, off)]
            name, first, which = np.unique(names, return_index=True, return_inverse=True)
            smallest = np.full(len(name), LAST, np.int64)
            largest = np.zeros(len(name), np.int64) + np.iinfo(np.int64).min
            np.minimum.at(smallest, which, owner)
            np.maximum.at(largest, which, owner)
            bucket = (keys[first] >> np.uint64(64 - finer.bits)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            first, bucket = first[order], bucket[order]
            short_keys = keys[first].astype(np.uint32)
            starts, sizes = starts[first], ends[first] - starts[first]
            data = buf[_ragged(starts, sizes)]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            edges = np.append(np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket))
            for a, b in zip(edges[:-1], edges[1:]) if len(bucket) else ():
                out["bucket"].append(int(bucket[a]))
                out["keys"].append(blob(short_keys[a:b]))
                out["sizes"].append(blob(sizes[a:b].astype(np.uint32)))
                out["bytes"].append(blob(data[ends[a] : ends[b]]))
                out["smallest"].append(blob(smallest[order[a:b]]))
                out["largest"].append(blob(largest[order[a:b]]))
        block = table.column("block")[0].as_py() if table.num_rows else None
        columns = {"bucket": pa.array(out.pop("bucket"), pa.int32())}
        columns["block"] = pa.array([block] * len(columns["bucket"]), pa.int32())
        return pa.table(columns | {k: pa.array(v, pa.binary()) for k, v in out.items()})

    def compare(table: pa.Table) -> pa.Table:
        sizes = _blobs(table, "sizes", np.uint32)
        edges = np.concatenate([[0], np.cumsum([len(s) for s in sizes])])
        size = np.concatenate(sizes).astype(np.int64)
        data = np.concatenate(_blobs(table, "bytes", np.uint8))
        smallest = np.concatenate(_blobs(table, "smallest", np.int64))
        largest = np.concatenate(_blobs(table, "largest", np.int64))
        ends = np.cumsum(size)
        parts = zip(_blobs(table, "bytes", np.uint8), sizes)
        hashes = np.concatenate([_names(part, own) for part, own in parts])
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        least = np.full(len(first), LAST, np.int64)
        np.minimum.at(least, which, smallest)
        own, begin = size[first], (ends - size)[first]
        windows = own - length + 1
        at = np.cumsum(windows) - windows
        found = np.repeat(least, windows)
        # Equal windows have equal keys: a key with one fragment has nothing else to compare.
        _, of_key, alike = np.unique(
            np.concatenate(_blobs(table, "keys", np.uint32))[first], return_inverse=True, return_counts=True
        )
        several = np.flatnonzero(alike[of_key] > 1)
        if len(several):
            part = data[_ragged(begin[several], own[several])]
            found[_ragged(at[several], windows[several])] = smallest_documents(
                part, own[several], least[several], length
            )
        # Only fragments with something to remove go back.
        lowest = np.minimum.reduceat(found, at)
        wanted = lowest[which] < largest
        out = []
        for i, block in enumerate(table.column("block").to_pylist()):
            mine = np.arange(edges[i], edges[i + 1])[wanted[edges[i] : edges[i + 1]]]
            if not len(mine):
                continue
            values = found[_ragged(at[which[mine]], windows[which[mine]])]
            new = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
            runs = np.diff(np.append(new, len(values)))
            out.append((block, blob(hashes[mine]), blob(values[new]), blob(runs.astype(np.uint32))))
        columns = list(zip(*out)) or [[], [], [], []]
        return pa.table(
            {
                "block": pa.array(columns[0], pa.int32()),
                "fragments": pa.array(columns[1], pa.binary()),
                "documents": pa.array(columns[2], pa.binary()),
                "lengths": pa.array(columns[3], pa.binary()),
            }
        )

    def remove(table: pa.Table, reply: pa.Table) -> pa.Table:
        buf, off = byte_view(table.column("text"))
        doc = table.column("doc").to_numpy()
        gone = np.zeros(len(buf), bool)
        if reply.num_rows and len(buf):
            names = np.concatenate(_blobs(reply, "fragments", np.uint64))
            values = np.repeat(
                np.concatenate(_blobs(reply, "documents", np.int64)),
                np.concatenate(_blobs(reply, "lengths", np.uint32)),
            )
            starts, ends, _, hashes = fragments(buf, off, length)
            order = np.argsort(hashes, kind="stable")
            # A fragment's windows are as many as its bytes tell; any of its copies says how many.
            at = order[np.searchsorted(hashes[order], names)]
            counts = ends[at] - starts[at] - length + 1
            first = np.cumsum(counts) - counts
            by_name = np.argsort(names)
            place = np.minimum(np.searchsorted(names[by_name], hashes), len(names) - 1)
            mine = np.flatnonzero(names[by_name][place] == hashes)
            which = by_name[place[mine]]
            window = _ragged(starts[mine], counts[which])
            owner = np.repeat(doc[_document_of(starts[mine], off)], counts[which])
            window = window[values[_ragged(first[which], counts[which])] < owner]
            change = np.zeros(len(buf) + 1, np.int32)
            np.add.at(change, window, 1)
            np.add.at(change, window + length, -1)
            gone = np.cumsum(change[:-1]) > 0
        kept, removed = [], []
        for a, b in zip(off[:-1], off[1:]):
            part = gone[a:b]
            kept.append(buf[a:b][~part].tobytes())
            edge = np.flatnonzero(np.diff(np.concatenate([[0], part.view(np.int8), [0]])))
            removed.append([{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc": table.column("doc"),
                "n_bytes": pa.array(np.diff(off)),
                "removed": pa.array(removed, span),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    blocks = dealt.groupBy("block")
    answers = shared.answer(blocks.applyInArrow(send_keys, shared.SENT))
    sent = blocks.cogroup(answers.groupBy("block")).applyInArrow(send_fragments, FRAGMENTS)
    replies = sent.groupBy("bucket").applyInArrow(compare, REPLY)
    judged = blocks.cogroup(replies.groupBy("block")).applyInArrow(
        remove,
        "doc bigint, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary",
    )
    doc = F.when(F.col("doc") != F.lit(int(LAST)), F.col("doc")).cast(kind)
    return judged.select(doc.alias(id_col), "n_bytes", "removed", "kept")


def _names(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes.astype(np.int64))
    return _Hashes(data).ranges(ends - sizes, ends)


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    removed = F.col("removed")
    size = F.aggregate(removed, F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return find_repeats(docs).select(
        "doc_id",
        "n_bytes",
        size.alias("n_removed"),
        F.size(removed).cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
