"""Words and hashes of many texts at once, as numpy passes over UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
CHUNK_BYTES = 1 << 19


def byte_view(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = max(first + 1, min(last, n))
        yield first, last
        first = last


def byte_table(words: str) -> np.ndarray:
    """What a byte becomes (A-Z in lower case), or 0 where it ends a word.

    ``words``: "alnum" takes a-z, 0-9 and all bytes of non-ASCII characters,
    "nonspace" all but ASCII white space.
    """
    code = np.arange(256)
    lower = np.where((code >= 65) & (code <= 90), code + 32, code)
    if words == "alnum":
        ok = (code >= 128) | ((lower >= 97) & (lower <= 122)) | ((code >= 48) & (code <= 57))
    else:
        ok = (code != 32) & ((code < 9) | (code > 13))
    return np.where(ok, lower + 1, 0).astype(np.uint16)


_largest = CHUNK_BYTES * 2


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        steps = np.full(size, base, U64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=U64))
    return tuple(out)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``size`` of each."""
    global _largest
    _largest = max(_largest, 1 << int(size - 1).bit_length())
    return _powers(_largest)


BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 512, dtype=np.int64).astype(U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
    x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``values[start:end]`` (polynomial, scrambled)."""
    power, inverse = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(raw + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


class Words:
    """The words of some texts: ``hash``, byte ``start`` and ``end``, and ``first[i]``, where text i's begin."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, table: np.ndarray):
        low = table[buf]
        inside = low > 0
        # 0 before and after; a text's first byte always starts anew.
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        begin = off[:-1][off[:-1] < off[1:]]
        opens[begin] = inside[begin]
        before = begin[begin > 0] - 1
        closes[before] = inside[before]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.hash = range_hashes(BYTE_VALUES[low], self.start, self.end)
        self.first = np.searchsorted(self.start, off)

    def count(self) -> np.ndarray:
        return np.diff(self.first)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of ``n`` values, also of runs across texts, which callers leave out."""
    if len(words) < n:
        return np.zeros(0, U64)
    out = np.zeros(len(words) - n + 1, U64)
    for i in range(n):
        out = mix(out * U64(_BASE) + words[i : len(words) - n + 1 + i])
    return out


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingle hashes of each text, sorted within it, and where each text's begin.

    A text of fewer words has one shingle, its whole sequence; one without words has none.
    """
    counts = words.count()
    grams = gram_hashes(words.hash, n)
    text = np.repeat(np.arange(len(counts)), counts)
    whole = np.arange(len(grams)) + n <= words.first[text[: len(grams)] + 1] if len(grams) else None
    keys, owner = (grams[whole], text[: len(grams)][whole]) if len(grams) else (grams, text[:0])
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        few = range_hashes(words.hash, words.first[short], words.first[short + 1])
        keys, owner = np.concatenate([keys, few]), np.concatenate([owner, short])
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[new], owner[new]
    return keys, np.searchsorted(owner, np.arange(len(counts) + 1))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring values."""
    return _sliding(x, width, np.minimum)


def sliding_max(x: np.ndarray, width: int) -> np.ndarray:
    return _sliding(x, width, np.maximum)


def _sliding(x, width, best):
    have = 1
    while have < width:
        step = min(have, width - have)
        x = best(x[:-step], x[step:])
        have += step
    return x


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Which values are the smallest of some window of ``width``; ties are all taken.

    Of any ``width`` neighbouring values at least one is taken, and which ones
    depends on the window alone, so equal windows agree.
    """
    if len(hashes) < width:
        return np.zeros(len(hashes), bool)
    least = sliding_min(hashes, width)
    edge = np.zeros(width - 1, hashes.dtype)
    around = sliding_max(np.concatenate([edge, least, edge]), width)
    return hashes == around


def blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()
