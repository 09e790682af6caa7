"""Which hashed keys occur in more than one document, without a row per key.

Documents are dealt into blocks by id. A block sends its distinct keys, cut
into buckets by their top bits, as binary arrays of the next 32 bits with the
number of its documents that hold each; a bucket adds these up and answers each
block with the keys that at least two documents hold. A key that a thousand
documents of a block hold travels once, so a frequent key weighs no more than
the number of blocks. Cutting keys off can only make a key look shared that is
not: callers use the answer to leave work out, never to decide.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityframe.llm.text import blob

BLOCK_BYTES = 4 << 20
KEYS_PER_BUCKET = 1 << 21
SENT = "bucket int, block int, keys binary, counts binary"
ANSWER = "block int, bucket int, keys binary, counts binary"


class Deal(NamedTuple):
    blocks: int
    bits: int  # log2 of the number of buckets


def plan(docs: DataFrame, text_col: str, bytes_per_key: float) -> Deal:
    """Blocks of about four megabytes; buckets of about two million keys."""
    size = docs.agg(F.sum(F.octet_length(text_col) + 8).alias("b")).first()["b"] or 0
    keys = size / bytes_per_key
    bits = max(4, math.ceil(math.log2(max(1, keys / KEYS_PER_BUCKET))))
    return Deal(max(1, math.ceil(size / BLOCK_BYTES)), min(bits, 24))


def block_of(id_col: str, deal: Deal) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(deal.blocks)).cast("int")


def cut(keys: np.ndarray, deal: Deal) -> np.ndarray:
    """Bucket and the 32 bits sent, as one number."""
    return keys >> np.uint64(32 - deal.bits)


def count_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cut keys and how many times each is given, once per document that holds it."""
    unique, counts = np.unique(keys, return_counts=True)
    return unique, np.minimum(counts, 65535).astype(np.uint16)


def send(block: int, keys: np.ndarray, counts: np.ndarray, deal: Deal) -> pa.Table:
    """Rows of SENT; ``keys`` are distinct, cut and sorted."""
    bucket = (keys >> np.uint64(32)).astype(np.int64)
    edges = np.searchsorted(bucket, np.arange((1 << deal.bits) + 1))
    low = keys.astype(np.uint32)
    full = np.flatnonzero(np.diff(edges))
    return pa.table(
        {
            "bucket": pa.array(full, pa.int32()),
            "block": pa.array(np.full(len(full), block), pa.int32()),
            "keys": pa.array([blob(low[edges[i] : edges[i + 1]]) for i in full], pa.binary()),
            "counts": pa.array([blob(counts[edges[i] : edges[i + 1]]) for i in full], pa.binary()),
        }
    )


def answer(sent: DataFrame) -> DataFrame:
    """Rows of ANSWER: of each block, the keys that two or more documents hold, and how many do."""

    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(b, np.uint32) for b in table.column("keys").to_pylist()]
        given = [np.frombuffer(b, np.uint16) for b in table.column("counts").to_pylist()]
        edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        keys = np.concatenate(parts)
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        first = np.flatnonzero(new)
        sums = np.add.reduceat(np.concatenate(given)[order].astype(np.int64), first)
        total = np.zeros(len(keys), np.uint32)
        total[order] = np.repeat(np.minimum(sums, 1 << 31), np.diff(np.append(first, len(keys))))
        rows = []
        for i, block in enumerate(table.column("block").to_pylist()):
            counts = total[edges[i] : edges[i + 1]]
            held = counts > 1
            if held.any():
                rows.append((block, blob(parts[i][held]), blob(counts[held])))
        bucket = table.column("bucket")[0].as_py()
        return pa.table(
            {
                "block": pa.array([r[0] for r in rows], pa.int32()),
                "bucket": pa.array([bucket] * len(rows), pa.int32()),
                "keys": pa.array([r[1] for r in rows], pa.binary()),
                "counts": pa.array([r[2] for r in rows], pa.binary()),
            }
        )

    return sent.groupBy("bucket").applyInArrow(run, ANSWER)


class Held:
    """A block's answer, ready to be asked."""

    def __init__(self, table: pa.Table):
        rows = sorted(
            zip(
                table.column("bucket").to_pylist(),
                table.column("keys").to_pylist(),
                table.column("counts").to_pylist(),
            )
        )
        keys = [
            (np.uint64(bucket) << np.uint64(32)) | np.frombuffer(k, np.uint32).astype(np.uint64)
            for bucket, k, _ in rows
        ]
        self.keys = np.concatenate([np.zeros(0, np.uint64), *keys])
        self.counts = np.concatenate(
            [np.zeros(0, np.uint32), *(np.frombuffer(c, np.uint32) for _, _, c in rows)]
        )

    def documents(self, keys: np.ndarray) -> np.ndarray:
        """How many documents hold each cut key; 1 for those that only its own does."""
        out = np.ones(len(keys), np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            same = self.keys[at] == keys
            out[same] = self.counts[at[same]]
        return out
