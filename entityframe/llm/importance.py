"""Documents drawn by how likely a target corpus is to hold their n-grams, relative to their own corpus.

Features are runs of 1 to 3 words hashed into buckets. Each batch of texts is
joined with separator sentinels and one regex pass finds all words; sorted
document offsets tell which runs cross documents, and those are left out before
the buckets are counted. The CRC of a run follows from those of its words.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityframe.functions.numbering import column, number_rows
from entityframe.llm.store import stage

BUCKETS = 10_000
LONGEST_RUN = 3
MIN_WORDS = 20
PERCENT = 5
SEED = "42"
CHUNK_BYTES = 2 << 20
TABLE_LENGTHS = 64

# 0xFF is in no UTF-8 text, so it can stand between two.
SENTINEL = b"\xff"
_WORDS = re.compile(rb"[0-9a-z\x80-\xfe]+|\xff")
_BREAK = re.compile(rb"[^0-9a-z\x80-\xfe]")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_POLYNOMIAL = 0xEDB88320


@lru_cache(maxsize=1)
def _shift_tables() -> np.ndarray:
    """What a CRC becomes when 0 to 64 bytes follow it: by length, by byte of the CRC."""
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = np.where(state & 1, (state >> 1) ^ np.uint32(_POLYNOMIAL), state >> 1)
    one_byte = state
    low = np.arange(256, dtype=np.uint32)
    tables = np.stack([low << np.uint32(8 * k) for k in range(4)])
    out = [tables]
    for _ in range(TABLE_LENGTHS):
        tables = one_byte[tables & np.uint32(255)] ^ (tables >> np.uint32(8))
        out.append(tables)
    return np.ascontiguousarray(np.stack(out)).reshape(-1)


def shift(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``crc`` moved by ``length`` bytes: crc(a + b) is this of crc(a) and len(b), xor crc(b)."""
    tables = _shift_tables()
    crc, length = crc.astype(np.uint32), length.astype(np.int64).copy()
    while True:
        step = np.minimum(length, TABLE_LENGTHS)
        base = step << 10
        moved = tables[base + (crc & 255)]
        for k in range(1, 4):
            moved = moved ^ tables[base + (k << 8) + ((crc >> np.uint32(8 * k)) & 255)]
        crc = moved
        length -= step
        if not length.any():
            return crc


class Runs:
    """Buckets of all runs of some joined texts: ``buckets[n - 1][i]`` is that of the n words up to word i.

    ``valid[n - 1]`` leaves out runs that cross texts or lie in the first ``skip``
    words, and ``first[d]`` is where text d's words begin.
    """

    def __init__(self, joined: bytes, buckets: int = BUCKETS, skip: int = 0):
        words = _WORDS.findall(joined)
        crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        length = np.fromiter(map(len, words), np.int64, len(words))
        is_end = (length == 1) & (crc == zlib.crc32(SENTINEL))
        ends = np.flatnonzero(is_end) - np.arange(int(is_end.sum()))
        crc, length = crc[~is_end], length[~is_end]
        n = len(crc)
        self.first = np.concatenate([[0], ends])
        document = np.searchsorted(ends, np.arange(n), "right")
        spaced = shift(np.full(n, zlib.crc32(b" "), np.uint32), length) ^ crc
        run, ok = crc, np.arange(n) >= skip
        self.buckets, self.valid = [run % np.uint32(buckets)], [ok]
        for size in range(2, LONGEST_RUN + 1):
            longer = np.zeros(n, np.uint32)
            inside = np.zeros(n, bool)
            if n >= size:
                longer[1:] = shift(run[:-1], length[1:] + 1) ^ spaced[1:]
                inside[size - 1 :] = document[size - 1 :] == document[: n - size + 1]
            run = longer
            self.buckets.append(run % np.uint32(buckets))
            self.valid.append(inside & ok)


def stretches(text: bytes, limit: int = CHUNK_BYTES) -> Iterator[tuple[bytes, int]]:
    """A long text in stretches, each led by the last words of the one before, and how many these are."""
    at, carried = 0, []
    while at < len(text):
        end = at + limit
        if end < len(text):
            found = _BREAK.search(text, end)
            end = found.start() if found else len(text)
        part = b" ".join([*carried, text[at:end]])
        yield part, len(carried)
        at = end
        # Enough of the tail for the words that the next stretch's runs may start with.
        cut, words = part, []
        for _ in range(LONGEST_RUN - 1):
            stop = len(cut)
            while stop and _BREAK.match(cut, stop - 1):
                stop -= 1
            start = stop
            while start and not _BREAK.match(cut, start - 1):
                start -= 1
            if start == stop:
                break
            words.insert(0, cut[start:stop])
            cut = cut[:start]
        carried = words


def joined_runs(texts: list[str | None], buckets: int = BUCKETS, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Runs]]:
    """(first text, number of texts, runs) for stretches of about ``limit`` bytes; a longer text comes in parts."""
    first, part, size = 0, [], 0

    def flush():
        return first, len(part), Runs(b"".join(t + SENTINEL for t in part), buckets)

    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
        if part and size + len(data) > limit:
            yield flush()
            first, part, size = i, [], 0
        if len(data) > limit:
            for stretch, skip in stretches(data, limit):
                yield i, 1, Runs(stretch + SENTINEL, buckets, skip)
            first = i + 1
        else:
            part.append(data)
            size += len(data)
    if part:
        yield flush()


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how many runs of all texts fall into each bucket that has any.

    Every task adds up its own rows before anything is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, runs in joined_runs(batch.column(0).to_pylist(), buckets):
                for bucket, valid in zip(runs.buckets, runs.valid):
                    total += np.bincount(bucket[valid], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], names=["bucket", "n"]
        )

    parts = texts.select(column(text_col).cast("string").alias("text")).mapInArrow(run, "bucket int, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS) -> list[int]:
    """The gain of each bucket; the counts behind it are one small row per bucket."""
    own, other = np.zeros(buckets, object), np.zeros(buckets, object)
    for counts, frame, name in ((own, docs, text_col), (other, target, target_col)):
        for row in bucket_counts(frame, name, buckets).collect():
            counts[row["bucket"]] = row["n"]
    all_own, all_other = sum(own) + buckets, sum(other) + buckets
    return [
        math.floor(1000 * math.log(float(t + 1) * float(all_own) / (float(s + 1) * float(all_other))))
        for s, t in zip(own.tolist(), other.tolist())
    ]


def noise(key: object, seed: str = SEED) -> int:
    """A fixed Gumbel draw in thousandths, from the seed and the id (a null id: nothing after the colon)."""
    text = f"{seed}:{'' if key is None else key}".encode()
    h = int(hashlib.sha256(text).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def importance_scores(
    docs: DataFrame,
    gains: list[int],
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = SEED,
) -> DataFrame:
    """``doc_id, text_key, n_words, n_features, weight, score`` of every row, in one pass without a shuffle."""
    buckets = len(gains)
    table = np.array(gains, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            words, features, weight = (np.zeros(rows, np.int64) for _ in range(3))
            for first, n, runs in joined_runs(batch.column(2).to_pylist(), buckets):
                count = np.zeros(len(runs.valid[0]) + 1, np.int64)
                gain = count.copy()
                for bucket, valid in zip(runs.buckets, runs.valid):
                    count[1:] += valid
                    gain[1:] += np.where(valid, table[bucket], 0)
                single = np.concatenate([[0], np.cumsum(runs.valid[0])])
                count, gain = np.cumsum(count), np.cumsum(gain)
                a, b = runs.first[:-1], runs.first[1:]
                place = slice(first, first + n)
                words[place] += single[b] - single[a]
                features[place] += count[b] - count[a]
                weight[place] += gain[b] - gain[a]
            draws = np.fromiter((noise(k, seed) for k in batch.column(0).to_pylist()), np.int64, rows)
            columns = [pa.array(c, pa.int64()) for c in (words, features, weight, weight + draws)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)

    names = ["doc_id", "text_key", "n_words", "n_features", "weight", "score"]
    kind = docs.schema[id_col].dataType.simpleString()
    text = column(text_col).cast("string")
    narrow = docs.select(column(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return narrow.mapInArrow(
        run, f"doc_id {kind}, text_key bigint, n_words bigint, n_features bigint, weight bigint, score bigint"
    )


def draw(scores: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scores`` with ``rank``: the highest scores among rows of enough words, the others null.

    Of N such rows ``percent * N // 100`` are drawn. Ties go to the smaller id, a null id
    first, then to fewer features; rows equal in all of these are numbered as they are read.
    ``scores`` is read several times: pass a written table.
    """
    enough = F.col("n_words") >= min_words
    wanted = percent * scores.where(enough).count() // 100
    rows = scores.withColumn("row", F.monotonically_increasing_id()).withColumn("below", -F.col("score"))
    placed = number_rows(rows.where(enough), ["below", "doc_id", "n_features", "row"], into="place")
    rank = F.when(F.col("place") <= wanted, F.col("place"))
    others = scores.where(~enough).withColumn("rank", F.lit(None).cast("bigint"))
    return placed.withColumn("rank", rank).select(*others.columns).unionByName(others)


def score_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its features, weight, score and rank.

    Null and empty texts have no features and weight 0. Repeated rows count and are
    ranked once each. Other columns play no part. An empty target gives gains
    from ``docs`` alone, an empty ``docs`` an empty result.
    """
    gains = bucket_gains(docs, target, text_col, target_col)
    return draw(stage(importance_scores(docs, gains, id_col, text_col), "importance"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """The drawn rows of ``docs``, all their columns as they are.

    Rows of one id and text that differ in other columns are drawn together.
    """
    drawn = score_documents(docs, target, id_col, text_col, target_col).where("rank is not null")
    keys = drawn.select(F.col("doc_id").alias("_drawn_id"), F.col("text_key").alias("_drawn_key")).distinct()
    key = F.xxhash64(column(text_col).cast("string"))
    return docs.join(keys, column(id_col).eqNullSafe(F.col("_drawn_id")) & (key == F.col("_drawn_key")), "left_semi")


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    return score_documents(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
