"""Benchmark decontamination by winnowing.

A window is 13 consecutive words of a benchmark item. Of every window, the
smallest hash of its 5-word grams is a fingerprint; the same rule picks
fingerprints from the documents, so a document that holds a window holds that
fingerprint at the same place of it. Matching places are extended word by word
to both sides, and only whole equal windows count.

An item of fewer words is one window of its own length; each such length is
winnowed by the same rule with the grams that fit into it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.llm.store import stage
from entityframe.llm.text import Words, byte_table, byte_view, chunks, gram_hashes, winnow

WINDOW = 13
GRAM = 5
# Benchmarks up to this size go to every task; larger ones are joined on fingerprints.
MAX_LOCAL_BYTES = 32 << 20
PAIRS_AT_ONCE = 200_000


class Fingerprints:
    """The windows of one length of some items: fingerprints, and where each is."""

    def __init__(self, words: Words, items: np.ndarray, window: int, gram: int):
        self.window, self.gram = window, min(gram, window)
        self.width = window - self.gram + 1
        self.words = words.hash
        item = np.repeat(np.arange(len(words.first) - 1), words.count())
        self.first, self.last = words.first[:-1][item], words.first[1:][item]
        self.item = item
        places = [
            np.zeros(0, np.int64),
            *(
                words.first[i] + pick(words.hash[words.first[i] : words.first[i + 1]], self)
                for i in items
            ),
        ]
        place = np.concatenate(places)
        hashes = gram_hashes(self.words, self.gram)[place] if len(place) else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.place = hashes[order], place[order]


def pick(words: np.ndarray, rule) -> np.ndarray:
    """Places of the fingerprints of one text."""
    return np.flatnonzero(winnow(gram_hashes(words, rule.gram), rule.width))


class Benchmark:
    """All items, ready to be looked up."""

    def __init__(self, ids: list, texts, window: int = WINDOW, gram: int = GRAM):
        self.ids = [str(i) for i in ids]
        buf, off = byte_view(texts)
        words = Words(buf, off, byte_table("alnum"))
        counts = words.count()
        self.rules = []
        for n in sorted({min(int(c), window) for c in counts if c}, reverse=True):
            items = np.flatnonzero(counts >= window if n == window else counts == n)
            self.rules.append(Fingerprints(words, items, n, gram))

    def hits(self, words: np.ndarray, rule: Fingerprints, text_of: np.ndarray, first, last):
        """(word marks, text, item) of all whole equal windows between the texts and the items.

        ``text_of``, ``first``, ``last``: for each word its text and where that begins and ends.
        """
        grams = gram_hashes(words, rule.gram)
        marks = np.zeros(len(words) + 1, np.int64)
        texts, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if not len(grams) or not len(rule.hashes):
            return marks[:-1], texts[0], items[0]
        low = np.minimum(np.searchsorted(rule.hashes, grams), len(rule.hashes) - 1)
        at = np.flatnonzero(rule.hashes[low] == grams)
        if not len(at):
            return marks[:-1], texts[0], items[0]
        at = at[self._picked(grams, rule, first, last, np.unique(first[at]))[at]]
        low = low[at]
        high = np.searchsorted(rule.hashes, grams[at], "right")
        size = high - low
        ends = np.cumsum(size)
        done = 0
        while done < len(at):
            stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS_AT_ONCE)))
            part = slice(done, stop)
            n = size[part]
            mine = np.repeat(at[part], n)
            theirs = rule.place[np.repeat(low[part] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            self._extend(words, rule, text_of, first, last, mine, theirs, marks, texts, items)
            done = stop
        return np.cumsum(marks)[:-1] > 0, np.concatenate(texts), np.concatenate(items)

    @staticmethod
    def _picked(grams, rule, first, last, begins):
        """Places that are the smallest of some window inside their own text, of texts with a match."""
        picked = np.zeros(len(grams), bool)
        for a in begins:
            b = max(a, last[a] - rule.gram + 1)
            picked[a:b] = winnow(grams[a:b], rule.width)
        return picked

    @staticmethod
    def _extend(words, rule, text_of, first, last, mine, theirs, marks, texts, items):
        n = rule.window
        equal_right = np.zeros(len(mine), np.int64)
        alive = np.ones(len(mine), bool)
        for k in range(n):
            i, j = mine + k, theirs + k
            ok = alive & (i < last[mine]) & (j < rule.last[theirs])
            idx = np.flatnonzero(ok)
            ok[idx] = words[i[idx]] == rule.words[j[idx]]
            alive = ok
            equal_right += ok
        equal_left = np.zeros(len(mine), np.int64)
        alive = equal_right >= rule.gram
        for k in range(1, n):
            i, j = mine - k, theirs - k
            ok = alive & (i >= first[mine]) & (j >= rule.first[theirs])
            idx = np.flatnonzero(ok)
            ok[idx] = words[i[idx]] == rule.words[j[idx]]
            alive = ok
            equal_left += ok
        whole = np.flatnonzero((equal_right >= rule.gram) & (equal_left + equal_right >= n))
        np.add.at(marks, mine[whole] - equal_left[whole], 1)
        np.add.at(marks, mine[whole] + equal_right[whole], -1)
        texts.append(text_of[mine[whole]])
        items.append(rule.item[theirs[whole]])

    def judge(self, column) -> list[tuple[int, int, list[str], np.ndarray, np.ndarray]]:
        """Of each text: words, hit words, sorted ids of its items, and hit spans as byte ranges."""
        buf, off = byte_view(column)
        out = []
        table = byte_table("alnum")
        for a, b in chunks(off):
            base = off[a]
            words = Words(buf[base : off[b]], off[a : b + 1] - base, table)
            counts = words.count()
            text_of = np.repeat(np.arange(b - a), counts)
            first, last = words.first[:-1][text_of], words.first[1:][text_of]
            hit = np.zeros(len(words.hash), bool)
            texts, items = [], []
            for rule in self.rules:
                marks, t, i = self.hits(words.hash, rule, text_of, first, last)
                hit |= marks.astype(bool)
                texts.append(t)
                items.append(i)
            pairs = np.zeros((0, 2), np.int64)
            if texts and sum(map(len, texts)):
                pairs = np.unique(np.stack([np.concatenate(texts), np.concatenate(items)], 1), axis=0)
            where = np.searchsorted(pairs[:, 0], np.arange(b - a + 1))
            for k in range(b - a):
                own = slice(words.first[k], words.first[k + 1])
                names = sorted({self.ids[i] for i in pairs[where[k] : where[k + 1], 1]})
                begin = base - off[a + k] + words.start[own][hit[own]]
                end = base - off[a + k] + words.end[own][hit[own]]
                out.append((int(counts[k]), int(hit[own].sum()), names, begin, end))
        return out


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    max_local_bytes: int = MAX_LOCAL_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words, n_hit, item_ids, contaminated``, replacing columns so named.

    ``benchmark`` has item_id and text. A word is a run of a-z, 0-9 and
    non-ASCII characters after A-Z are put in lower case. A document word
    inside any occurrence of a window is hit; a document is contaminated if it
    has hits and they are at least a twentieth of its words. ``item_ids`` are
    the items with a window in the document, as strings, sorted.

    A null or empty text has no words. Rows are judged one by one, so repeated
    rows get the same result; equal items are all named. Items of one id are named once, and
    those without an id are named None. An empty benchmark
    hits nothing; empty documents give an empty result.

    The benchmark goes to every task only while its measured size is at most
    ``max_local_bytes``. A larger one is joined to the documents on
    fingerprints, and only the items found there are compared with a document.
    """
    name = F.coalesce(F.col("item_id").cast("string"), F.lit("None"))
    items = benchmark.select(name.alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text") + 16).alias("b")).first()["b"] or 0
    docs = docs.drop("n_words", "n_hit", "item_ids", "contaminated")
    judged = "n_words bigint, n_hit bigint, item_ids array<string>, contaminated boolean"
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(judged).fields])
    if size > max_local_bytes:
        return _by_join(docs, items, text_col, window, gram, schema)
    table = items.toArrow()  # at most max_local_bytes
    ids, texts = table.column(0).to_pylist(), table.column(1).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = Benchmark(ids, texts, window, gram)
        for batch in batches:
            yield _with_judgement(batch, bench.judge(batch.column(text_col)))

    return docs.mapInArrow(run, schema)


def _with_judgement(batch: pa.RecordBatch, judged: list[tuple]) -> pa.RecordBatch:
    words, hit = [j[0] for j in judged], [j[1] for j in judged]
    columns = [
        pa.array(words, pa.int64()),
        pa.array(hit, pa.int64()),
        pa.array([j[2] for j in judged], pa.list_(pa.string())),
        pa.array([h > 0 and 20 * h >= w for w, h in zip(words, hit)], pa.bool_()),
    ]
    names = [*batch.schema.names, "n_words", "n_hit", "item_ids", "contaminated"]
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names)


def _by_join(docs, items, text_col, window, gram, schema) -> DataFrame:
    """Fingerprints of both sides are joined; each pair found is compared on its own."""
    lengths = [
        r["n"]
        for r in items.select(
            F.least(F.size(_words(F.col("text"))), F.lit(window)).alias("n")
        ).where("n > 0").distinct().collect()  # at most as many as a window has words
    ]
    # A key of its own for each item: ids may be repeated, or missing.
    items = stage(items.withColumn("_item_key", F.monotonically_increasing_id()), "items")
    keyed = docs.withColumn("_text_key", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    texts = keyed.groupBy("_text_key").agg(F.first(F.col(text_col)).alias("_text"))

    def prints(frame: DataFrame, key: str, text: str, exact: bool) -> DataFrame:
        kind = frame.schema[key].dataType.simpleString()

        def run(batches):
            table = byte_table("alnum")
            for batch in batches:
                buf, off = byte_view(batch.column(1))
                words = Words(buf, off, table)
                keys, rule_no, marks = [], [], []
                names = batch.column(0).to_pylist()
                for i, n in enumerate(words.count().tolist()):
                    own = words.hash[words.first[i] : words.first[i + 1]]
                    mine = [min(n, window)] if exact else [k for k in lengths if k <= n]
                    for k in filter(None, mine):
                        g = min(gram, k)
                        grams = gram_hashes(own, g)
                        got = np.unique(grams[winnow(grams, k - g + 1)]).astype(np.int64)
                        keys += [names[i]] * len(got)
                        rule_no += [k] * len(got)
                        marks += got.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, batch.schema.field(0).type), pa.array(rule_no, pa.int32()), pa.array(marks, pa.int64())],
                    names=[key, "rule", "print"],
                )

        return frame.select(key, text).mapInArrow(run, f"`{key}` {kind}, rule int, print bigint")

    found = (
        prints(texts, "_text_key", "_text", False)
        .join(prints(items, "_item_key", "text", True), ["rule", "print"])
        .select("_text_key", "_item_key")
        .distinct()
    )
    pairs = found.join(texts, "_text_key").join(items, "_item_key")

    def compare(batches):
        for batch in batches:
            keys, hits = batch.column("_text_key").to_pylist(), []
            for i in range(len(keys)):
                one = Benchmark(
                    [batch.column("item_id")[i].as_py()], batch.column("text").slice(i, 1), window, gram
                )
                hits.append(one.judge(batch.column("_text").slice(i, 1))[0])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys),
                    pa.array([h[2][0] if h[2] else None for h in hits], pa.string()),
                    pa.array([h[3].tolist() for h in hits], pa.list_(pa.int64())),
                ],
                names=["_text_key", "item", "places"],
            )

    judged = (
        pairs.select("_text_key", "_text", "item_id", "text")
        .mapInArrow(compare, "_text_key string, item string, places array<bigint>")
        .where("item is not null")
        .groupBy("_text_key")
        .agg(
            F.array_sort(F.collect_set("item")).alias("item_ids"),
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("bigint").alias("n_hit"),
        )
    )
    n_words = F.size(_words(F.col(text_col))).cast("bigint")
    hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return (
        keyed.join(judged, "_text_key", "left")
        .withColumns({"n_words": n_words, "n_hit": hit})
        .select(
            *(F.col(f"`{name}`") for name in docs.columns),
            "n_words",
            "n_hit",
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        )
    )


def _words(text):
    return F.regexp_extract_all(
        F.coalesce(text, F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0)
    )


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )
