"""URL filtering against a sorted array of 64-bit digests.

A rule is a host and a path prefix. Its digest is xxhash64 of ``host + path``.
The list is an array of sorted digests beside the full strings. For each URL
the strings of all rules that could fit it (each parent host with each path
prefix of a length that some rule has) are hashed and looked up by binary
search, and a hit counts only if the stored string is the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.llm.line_dedup import ascii_lower
from entityframe.llm.store import shared_path, stage

# Lists up to this size are copied to every node; larger ones are dealt out by digest.
MAX_LOCAL_BYTES = 64 << 20
ENTRIES_PER_SHARD = 500_000

RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def url_parts(url):
    """Host (A-Z in lower case) and path of a URL column; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return ascii_lower(host), path


class DigestList:
    """Sorted digests, and of each its rule as ``host + path``, its verdict and its rank."""

    def __init__(self, digests, offsets, strings, blocks):
        self.digests, self.offsets, self.strings, self.blocks = digests, offsets, strings, blocks

    @classmethod
    def build(cls, rules: list[tuple[str, str, str]]) -> "DigestList":
        """Hosts come with A-Z in lower case. A rule twice with both verdicts blocks."""
        verdicts: dict[bytes, bool] = {}
        for host, path, verdict in rules:
            key = (host + path).encode()
            verdicts[key] = verdicts.get(key, False) or verdict == "block"
        keys = sorted(verdicts, key=lambda k: (xxhash.xxh64_intdigest(k), k))
        digests = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        offsets = np.cumsum([0, *map(len, keys)], dtype=np.int64)
        blocks = np.array([verdicts[k] for k in keys], np.uint8)
        return cls(digests, offsets, b"".join(keys), blocks)

    def to_bytes(self) -> bytes:
        n = np.array([len(self.digests)], np.int64)
        parts = (n, self.digests, self.offsets, self.blocks)
        return b"".join(p.tobytes() for p in parts) + bytes(self.strings)

    @classmethod
    def view(cls, data) -> "DigestList":
        """From bytes or a memory map, without copying."""
        data = np.asarray(data)
        n = int(data[:8].view(np.int64)[0])
        a, b = 8 + 8 * n, 16 + 16 * n
        return cls(
            data[8:a].view(np.uint64), data[a:b].view(np.int64), data[b + n :], data[b : b + n]
        )

    def probe(self, keys: list[bytes]) -> np.ndarray:
        """Index of the entry equal to each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.digests):
            return out
        wanted = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        at = np.searchsorted(self.digests, wanted)
        todo = np.flatnonzero(at < len(self.digests))
        while len(todo):  # further rounds only where different strings share a digest
            todo = todo[at[todo] < len(self.digests)]
            todo = todo[self.digests[at[todo]] == wanted[todo]]
            same = np.array([self.string(at[i]) == keys[i] for i in todo], bool)
            out[todo[same]] = at[todo[same]]
            todo = todo[~same]
            at[todo] += 1
        return out

    def string(self, i: int) -> bytes:
        return bytes(self.strings[self.offsets[i] : self.offsets[i + 1]])


def candidates(host: str, path: str, lengths: list[int]) -> list[tuple[str, str]]:
    """(host, path prefix) of every rule that could fit, best first: longest host, then path."""
    labels = host.split(".")
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    fits = [n for n in lengths if n <= len(path)]
    return [(h, path[:n]) for h in hosts if h for n in fits]


def _longest(pair: tuple[str, str]) -> tuple[int, int]:
    return len(pair[0]) + len(pair[1]), len(pair[0])


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    default: str = "allow",
    max_local_bytes: int = MAX_LOCAL_BYTES,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``, replacing columns so named.

    ``rules`` has host, path and verdict (``allow`` or ``block``); A-Z in hosts count as lower case. A rule fits
    its host and all subdomains if the URL's path starts with the rule's path;
    the longest string wins, and the longer host among equals. Without a rule,
    ``rule`` is null and the verdict is ``default``: the URL is not on the list.

    A null URL or one without ``://`` has an empty host and path. Repeated rows
    are judged alike, an empty table gives an empty result, an empty rule list
    leaves the default.

    The list goes to every node as one memory-mapped file only while its
    measured size is at most ``max_local_bytes``. A larger one is cut into
    shards by digest, and each distinct rule string that some URL asks for visits one of them once.
    """
    spark = pages.sparkSession
    rules = rules.select(
        ascii_lower(F.coalesce("host", F.lit(""))).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "verdict",
    )
    sized = rules.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length("host") + F.octet_length("path") + 32).alias("bytes"),
        F.collect_set(F.length("path")).alias("lengths"),  # at most one per path length
    ).first()
    lengths = sorted(sized["lengths"], reverse=True)
    host, path = url_parts(F.col(url_col))
    split = pages.withColumns({"host": host, "path": path})
    if (sized["bytes"] or 0) <= max_local_bytes:
        return _probe_local(spark, split, rules, lengths, default)
    return _probe_shards(split, rules, int(sized["n"]), lengths, default)


def _probe_local(spark: SparkSession, pages, rules, lengths, default) -> DataFrame:
    """The file is published once and mapped by every worker."""
    listed = DigestList.build([tuple(r) for r in rules.collect()])  # at most max_local_bytes
    name = f"digests-{uuid.uuid4().hex}"
    path = shared_path(spark, "digests") + "/" + name
    _write(spark, path, listed.to_bytes())
    spark.sparkContext.addFile(path)
    # Spark may read a frame as text of any type; a struct keeps other columns as they are.
    schema = T.StructType(
        [f for f in pages.schema.fields if f.name not in ("rule", "verdict")]
        + [T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]
    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = DigestList.view(np.memmap(SparkFiles.get(name), np.uint8, "r"))
        for batch in batches:
            table = batch.drop_columns([c for c in ("rule", "verdict") if c in batch.schema.names])
            hosts, paths = table.column("host").to_pylist(), table.column("path").to_pylist()
            keys, owners = [], []
            for i, (h, p) in enumerate(zip(hosts, paths)):
                for pair in candidates(h, p, lengths):
                    keys.append(pair)
                    owners.append(i)
            at = found.probe([(h + p).encode() for h, p in keys])
            best: dict[int, tuple] = {}
            for j in np.flatnonzero(at >= 0):
                rank = _longest(keys[j])
                if owners[j] not in best or rank > best[owners[j]][0]:
                    best[owners[j]] = rank, "".join(keys[j]), bool(found.blocks[at[j]])
            rule = [best[i][1] if i in best else None for i in range(len(hosts))]
            verdict = [
                ("block" if best[i][2] else "allow") if i in best else default
                for i in range(len(hosts))
            ]
            yield pa.RecordBatch.from_arrays(
                [*table.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=[*table.schema.names, "rule", "verdict"],
            )

    return pages.mapInArrow(probe, schema)


def _candidate_pairs(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """``host, path, h, p``: every rule that could fit a URL, as ``candidates`` gives them."""
    labels = F.split("host", r"\.")
    hosts = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    fits = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path"))
    return (
        urls.select("host", "path", F.explode(F.filter(hosts, lambda h: h != "")).alias("h"))
        .select("host", "path", "h", F.explode(fits).alias("n"))
        .select("host", "path", "h", F.expr("left(path, n)").alias("p"))
    )


def _probe_shards(pages, rules, n, lengths, default) -> DataFrame:
    """Digest shards meet the distinct strings asked for; what they hold is joined back to the URLs.

    However many URLs ask for one string, it is looked up once.
    """
    shards = max(1, -(-n // ENTRIES_PER_SHARD))
    shard = F.pmod(F.xxhash64(F.concat("host", "path")), F.lit(shards)).alias("shard")
    entries = rules.select("host", "path", "verdict", shard)
    pairs = _candidate_pairs(pages.select("host", "path").distinct(), lengths)
    asked = pairs.select("h", "p").distinct()
    asked = asked.withColumn("shard", F.pmod(F.xxhash64(F.concat("h", "p")), F.lit(shards)))

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        listed = DigestList.build([tuple(r.values()) for r in left.select([0, 1, 2]).to_pylist()])
        h, p = right.column("h").to_pylist(), right.column("p").to_pylist()
        at = listed.probe([(a + b).encode() for a, b in zip(h, p)])
        hit = np.flatnonzero(at >= 0)
        return pa.table(
            {
                "h": right.column("h").take(pa.array(hit)),
                "p": right.column("p").take(pa.array(hit)),
                "blocks": pa.array(listed.blocks[at[hit]].astype(bool)),
            }
        )

    hits = (
        entries.groupBy("shard")
        .cogroup(asked.groupBy("shard"))
        .applyInArrow(probe, "h string, p string, blocks boolean")
    )
    best = pairs.join(hits, ["h", "p"]).groupBy("host", "path").agg(
        F.max_by(
            F.struct(F.concat("h", "p").alias("rule"), "blocks"),
            F.struct(F.length(F.concat("h", "p")), F.length("h")),
        ).alias("best")
    )
    kept = pages.drop("rule", "verdict")
    order = [f"`{name}`" for name in kept.columns]
    return kept.join(best, ["host", "path"], "left").select(
        *order,
        F.col("best.rule").alias("rule"),
        F.when(F.col("best").isNull(), F.lit(default))
        .when(F.col("best.blocks"), "block")
        .otherwise("allow")
        .alias("verdict"),
    )


def _write(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file through Spark's own file system layer."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return filter_urls(pages, rules).drop("url")


def _sql_case(what: int) -> str:
    """Longest rule first."""
    cases = []
    for host, path, verdict in sorted(RULES, key=lambda r: -len(r[0] + r[1])):
        value = host + path if what == 0 else verdict
        cases.append(
            f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}')"
            f" then '{value}'"
        )
    return f"case {' '.join(cases)} else {'null' if what == 0 else chr(39) + 'allow' + chr(39)} end"


OP1_SQL = f"""
with rest as (
  select page_id, case when instr(coalesce(url, ''), '://') > 0
                       then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages),
parts as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as h,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
  from rest),
hosts as (
  select page_id, path, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host
  from parts)
select page_id, host, path, {_sql_case(0)} as rule, {_sql_case(1)} as verdict from hosts
"""
