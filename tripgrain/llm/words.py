"""Words of text columns as numpy arrays: boundaries and hashes of many documents at once.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. UTF-8 text may be cut there safely,
and A-Z may be lower-cased bytewise. Hashes are sums of random table entries times powers of an odd
base, modulo 2**64 and mixed; two lanes give 128 independent bits. They depend on nothing but the
bytes, so a task that runs again gives the same values.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of text that are worked on at once.
SLICE_BYTES = 4 << 20
_LONG_WORD = 1 << 16
_BLOCK = 1 << 16

_random = np.random.default_rng(1809)
_TABLES = _random.integers(0, 2**64, (2, 256), dtype=np.uint64)
_BASES = [int(x) | 1 for x in _random.integers(0, 2**64, 4, dtype=np.uint64)]
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers_of: dict[int, np.ndarray] = {}


class Words(NamedTuple):
    data: np.ndarray  # bytes
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray  # the text of each word
    first: np.ndarray  # per text the number of its first word, and the number of words at the end

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def _powers(base: int, n: int) -> np.ndarray:
    have = _powers_of.get(base)
    if have is None or len(have) < n:
        have = np.full(1 << max(12, int(n - 1).bit_length()), base, np.uint64)
        have[0] = 1
        have = _powers_of[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def text_slices(texts: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) with about ``most`` bytes each; one long text stays whole. NULL becomes empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        yield at, texts.slice(at, end - at)
        at = end


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of an array of texts without NULL."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8)[low:high] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - low
    if lower:
        data = _LOWER[data]
    word = _IS_WORD[data]
    start, end = word.copy(), word.copy()
    if len(word):
        start[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        edges = offsets[:-1][offsets[:-1] < len(word)]
        start[edges] = word[edges]
        edges = offsets[1:][offsets[1:] > 0] - 1
        end[edges] = word[edges]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    first = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(data, starts, ends, row, first)


def word_hashes(words: Words, lane: int = 0) -> np.ndarray:
    """One uint64 per word."""
    table, base = _TABLES[lane], _BASES[lane]
    inverse = pow(base, -1, 2**64)
    out = np.empty(len(words.starts), np.uint64)
    todo = [(a, min(a + _BLOCK, len(out))) for a in range(0, len(out), _BLOCK)]
    while todo:
        a, b = todo.pop()
        low, high = int(words.starts[a]), int(words.ends[b - 1])
        if high - low > 16 * _BLOCK:
            if b - a > 1:
                todo += [(a, (a + b) // 2), ((a + b) // 2, b)]
            continue  # one long word: below
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[words.data[low:high]] * _powers(base, high - low), out=sums[1:])
        s, e = words.starts[a:b] - low, words.ends[a:b] - low
        out[a:b] = (sums[e] - sums[s]) * _powers(inverse, high - low)[s]
    out = mix(out)
    for i in np.flatnonzero(words.ends - words.starts > _LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(words.bytes_of(i), digest_size=8, key=bytes([lane])).digest(), "little")
    return out


def gram_hashes(hashes: np.ndarray, first: np.ndarray, n: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(number of the first word, hash) of every run of ``n`` words inside one text."""
    counts = np.maximum(np.diff(first) - (n - 1), 0)
    at = np.repeat(first[:-1] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    if len(at) == 0:
        return at, np.zeros(0, np.uint64)
    base = _BASES[2 + lane]
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(base, len(hashes)), out=sums[1:])
    return at, mix((sums[at + n] - sums[at]) * _powers(pow(base, -1, 2**64), len(hashes))[at])


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def chunk_of(key: Column, total: int, each: int) -> Column:
    """A chunk number from a key; chunks hold about ``each`` of ``total`` bytes."""
    return F.pmod(F.xxhash64(key), F.lit(max(1, -(-total // each))))
