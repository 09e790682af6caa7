"""Documents linked by the Jaccard similarity of their word shingles: a grouped prefix join.

Shingles are ordered by how many documents hold them, rarest first. Two sets as
similar as asked share one of the first ``size - ceil(t * size) + 1`` of this
order, and a shingle that one document holds links nothing, so most documents
drop out at once. Documents with the same set, and after that those with the
same prefix and size, form one group; groups meet on prefix shingles and are
filtered by size and position; their members are then verified on whole sets.

Within a prefix shingle each group first meets one other (a star). Only where
a shingle's documents are not yet connected do the pairs across components
follow, so a group of a thousand near copies never makes a million pairs, and
no component that any link makes is lost.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityframe.llm import shared
from entityframe.llm.graph import components
from entityframe.llm.store import stage
from entityframe.llm.text import Words, blob, byte_table, byte_view, chunks, shingles

SETS = """doc_id {id}, n_shingles bigint, set_key binary, prefix_key binary,
          skipped int, prefix array<bigint>, shingles binary"""
BYTES_PER_SHINGLE = 6.0


def needed(size, percent: int):
    """Smallest overlap of a set of ``size`` with one at least as similar as ``percent``."""
    return -(-size * percent // 100)


def _sets_of(table: pa.Table, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct shingle hashes) of each text."""
    buf, off = byte_view(table.column("text"))
    words = byte_table("nonspace")
    for a, b in chunks(off):
        base = off[a]
        keys, first = shingles(Words(buf[base : off[b]], off[a : b + 1] - base, words), n)
        for i in range(b - a):
            yield a + i, keys[first[i] : first[i + 1]]


def shingle_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): size, and of rows that may link, the prefix and the set."""
    deal = shared.plan(docs, "text", BYTES_PER_SHINGLE)
    dealt = docs.withColumn("block", shared.block_of("doc_id", deal)).repartition("block")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def send(table: pa.Table) -> pa.Table:
        parts = [shared.cut(keys, deal) for _, keys in _sets_of(table, n)]
        keys, counts = shared.count_keys(np.concatenate([np.zeros(0, np.uint64), *parts]))
        return shared.send(table.column("block")[0].as_py(), keys, counts, deal)

    def build(table: pa.Table, held: pa.Table) -> pa.Table:
        known = shared.Held(held)
        sizes, set_keys, prefix_keys, skipped, prefixes, blobs = [], [], [], [], [], []
        for _, keys in _sets_of(table, n):
            size = len(keys)
            holders = known.documents(shared.cut(keys, deal))
            order = np.lexsort((keys, holders))
            first = order[: size - needed(size, percent) + 1] if size else order
            alone = int((holders[first] == 1).sum())
            prefix = keys[first[alone:]]
            sizes.append(size)
            if len(prefix):
                raw = blob(keys)
                set_keys.append(hashlib.blake2b(raw, digest_size=16).digest())
                prefix_keys.append(hashlib.blake2b(blob(keys[first]), digest_size=16).digest())
                skipped.append(alone)
                prefixes.append(prefix.astype(np.int64))
                blobs.append(raw)
            else:
                for column in (set_keys, prefix_keys, skipped, prefixes, blobs):
                    column.append(None)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_shingles": pa.array(sizes, pa.int64()),
                "set_key": pa.array(set_keys, pa.binary()),
                "prefix_key": pa.array(prefix_keys, pa.binary()),
                "skipped": pa.array(skipped, pa.int32()),
                "prefix": pa.array(prefixes, pa.list_(pa.int64())),
                "shingles": pa.array(blobs, pa.binary()),
            }
        )

    answers = shared.answer(dealt.groupBy("block").applyInArrow(send, shared.SENT))
    return (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(build, SETS.format(id=kind))
    )


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose sets are as similar as ``percent``."""
    whole = sets.select("doc_id", "shingles")
    one = whole.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a"))
    two = whole.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("of_a"), batch.column("of_b")):
                p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                both = int((q[at] == p).sum())
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = sets.schema["doc_id"].dataType.simpleString()
    return (
        pairs.join(two, "b").join(one, "a").mapInArrow(run, f"a {kind}, b {kind}")
    )


def _size_class(percent: int):
    return F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(100 / percent)).cast("int")


def link_components(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs`` (doc_id, text).

    A word is a run without ASCII white space, A-Z in lower case; a document's
    set has its distinct ``n``-word shingles, or its whole sequence if it has
    fewer words. Two documents link when the overlap is at least ``percent``
    of the union; ``component_id`` is the smallest id reachable by links.

    Without words, or without text, the set is empty and links nothing.
    Repeated rows are one document and each row is returned; rows of one id
    with different texts are one document with the links of both. A row
    without an id has no component. An empty table gives an empty result.
    Other columns play no part.
    """
    sets = stage(shingle_sets(docs.select("doc_id", "text"), n, percent), "sets")
    may = sets.where("set_key is not null and doc_id is not null")
    same = may.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    unit = stage(
        may.join(same, "set_key")
        .where("doc_id = rep")
        .dropDuplicates(["set_key"])
        .select("doc_id", "n_shingles", "prefix_key", "skipped", "prefix", "shingles"),
        "units",
    )
    group = unit.groupBy("prefix_key", "n_shingles").agg(
        F.min("doc_id").alias("gid"),
        F.min("skipped").alias("skipped"),
    )
    member = unit.select("doc_id", "prefix_key", "n_shingles").join(
        group.select("prefix_key", "n_shingles", "gid"), ["prefix_key", "n_shingles"]
    )
    posting = unit.select(
        "doc_id",
        "n_shingles",
        _size_class(percent).alias("class"),
        "prefix_key",
        "skipped",
        F.posexplode("prefix").alias("i", "token"),
    )
    heads = posting.join(
        group.select("prefix_key", "n_shingles", F.col("gid").alias("doc_id")),
        ["prefix_key", "n_shingles", "doc_id"],
        "left_semi",
    )
    pivots = heads.groupBy("token", "class").agg(F.min("doc_id").alias("a"))
    stars = (
        heads.join(pivots, ["token", "class"])
        .where("a < doc_id")
        .select("a", F.col("doc_id").alias("b"))
        .union(member.where("gid < doc_id").select(F.col("gid").alias("a"), F.col("doc_id").alias("b")))
        .distinct()
    )
    links = stage(verify(stars, unit, percent), "links")
    open_rows = _open(posting, components(links))
    open_rows = open_rows.join(unit.select("doc_id", "prefix"), "doc_id")
    x, y = open_rows.alias("x"), open_rows.alias("y")
    # Sets of s and r elements need an overlap of at least p (s + r) / (100 + p). Before a common
    # shingle only shared ones can match, from it on no more than either set has left.
    sizes = F.col("x.n_shingles") + F.col("y.n_shingles")
    most = F.least("x.i", "y.i") + F.least(
        F.col("x.n_shingles") - F.col("x.skipped") - F.col("x.i"),
        F.col("y.n_shingles") - F.col("y.skipped") - F.col("y.i"),
    )
    # A pair comes from the first prefix shingle it has in common. One of its prefixes matches
    # inside the other only; what follows that prefix is the most that can be added.
    earlier = F.arrays_overlap(
        F.slice("x.prefix", F.lit(1), F.col("x.i")), F.slice("y.prefix", F.lit(1), F.col("y.i"))
    )
    later = F.greatest(
        F.floor((F.col("x.n_shingles") * percent + 99) / 100),
        F.floor((F.col("y.n_shingles") * percent + 99) / 100),
    ) - 1
    whole = F.size(F.array_intersect("x.prefix", "y.prefix")) + later
    across = (
        x.join(
            y,
            (F.col("x.token") == F.col("y.token"))
            & (F.col("x.doc_id") < F.col("y.doc_id"))
            & (F.col("x.component") != F.col("y.component"))
            & (F.col("x.n_shingles") * 100 >= F.col("y.n_shingles") * percent)
            & (F.col("y.n_shingles") * 100 >= F.col("x.n_shingles") * percent)
            & (most * (100 + percent) >= sizes * percent)
            & ~F.coalesce(earlier, F.lit(False))
            & (whole * (100 + percent) >= sizes * percent),
        )
        .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
        .distinct()
    )
    crossing = verify(across, unit, percent)
    final = components(links.union(crossing)).withColumnRenamed("node", "rep")
    class_of = same.join(final, "rep", "left").select(
        "set_key", F.coalesce("component", "rep").alias("component_id")
    )
    return (
        sets.select("doc_id", "n_shingles", "set_key")
        .join(class_of, "set_key", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def _open(posting: DataFrame, joined: DataFrame) -> DataFrame:
    """Postings, with components, of the shingles whose documents are in more than one."""
    placed = posting.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        *posting.columns, F.coalesce("component", "doc_id").alias("component")
    )
    split = (
        placed.groupBy("token")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"))
        .where("x < y")
        .select("token")
    )
    return stage(placed.join(split, "token"), "open")


def op7_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return link_components(docs)
