"""Exact removal of repeated passages, with a count-min sketch before the exact grouping.

A window is a run of ``WINDOW`` words of one document. A word goes when a window over it also starts
in a document with a smaller doc_id.

Texts are dealt into chunks of a few MB, once; every pass reads the same shuffled chunks.

1. Each chunk counts its windows in a sparse partial sketch of two rows of cells. Slices of the
   sketch are merged by adding counts; what goes back to a chunk is one bit per cell that it uses:
   more than one window in it. Counts are only ever too high, so no repeated window is lost.
2. Windows whose cells all have that bit are grouped exactly by 96 bits of hash; a chunk sends each of
   them once, with its smallest doc_id, so copies of one passage are one entry per chunk. What goes back
   is one bit: a smaller doc_id exists elsewhere.
3. The chunk cuts its texts.

Sketch, slices, buckets and chunks grow in number with the text and keep their size; nothing is
broadcast and nothing passes the driver but the total length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgrain.llm.words import SPACE, chunk_of, gram_hashes, split_words, text_bytes, text_slices, word_hashes

WINDOW = 13
CHUNK_BYTES = 8 << 20
SLICE_BITS = 22
#: Rows of the sketch: odd multipliers that pick the cell.
ROWS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Candidates that one bucket of the exact grouping holds, about.
BUCKET_ROWS = 1 << 21
_NO_ID = np.iinfo(np.int64).max
_BITS = "_llm_chunk long, kind int, part int, bits binary"


def _windows(texts: pa.Array, n: int):
    words = split_words(texts)
    at, low = gram_hashes(word_hashes(words, 0), words.first, n, 0)
    return words, at, low


def _cells(low: np.ndarray, row: int, bits: int) -> np.ndarray:
    cells = (low * np.uint64(ROWS[row])) >> np.uint64(64 - bits)
    return cells.astype(np.uint32) if bits <= 32 else cells


def _slice(cells: np.ndarray) -> np.ndarray:
    return (cells >> cells.dtype.type(SLICE_BITS)).astype(np.int64)


def _twice(cells: np.ndarray) -> np.ndarray:
    """Sorted cells, each at most twice."""
    cells = np.sort(cells)
    return cells[np.r_[np.ones(min(2, len(cells)), bool), cells[2:] != cells[:-2]]]


def _pack_sorted(values: np.ndarray) -> bytes:
    steps = np.diff(values, prepend=values[:1] * 0).astype(np.uint32)
    narrow = len(steps) == 0 or int(steps.max()) < 65536
    return bytes([int(narrow)]) + steps.astype(np.uint16 if narrow else np.uint32).tobytes()


def _unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, np.uint16 if blob[0] else np.uint32, offset=1), dtype=np.int64)


def _parts(sorted_high: np.ndarray):
    """(part, from, to) of a sorted array of part numbers."""
    edges = np.flatnonzero(np.diff(sorted_high)) + 1
    for a, b in zip(np.r_[0, edges], np.r_[edges, len(sorted_high)]):
        if b > a:
            yield int(sorted_high[a]), int(a), int(b)


class _Job:
    """The functions of the three passes, with their sizes."""

    def __init__(self, n: int, bits: int, buckets: int):
        self.n, self.bits, self.buckets = n, bits, buckets

    def count(self, chunk: pa.Table) -> pa.Table:
        number, out = chunk["_llm_chunk"][0].as_py(), []
        low = [_windows(t, self.n)[2] for _, t in text_slices(chunk["text"])]
        low = np.concatenate(low or [np.zeros(0, np.uint64)])
        for row in range(len(ROWS)):
            cells = _twice(_cells(low, row, self.bits))
            for part, a, b in _parts(_slice(cells)):
                inside = (cells[a:b] & cells.dtype.type((1 << SLICE_BITS) - 1)).astype(np.int64)
                out.append((part * len(ROWS) + row, number, _pack_sorted(inside)))
        return _table(out, ("slice", "_llm_chunk", "cells"), (pa.int32(), pa.int64(), pa.binary()))

    def merge(self, part: pa.Table) -> pa.Table:
        counts, out = np.zeros(1 << SLICE_BITS, np.uint8), []
        cells = [_unpack_sorted(b.as_py()) for b in part["cells"]]
        for c in cells:
            new = np.diff(c, prepend=-1) > 0
            for at in (c[new], c[~new]):
                counts[at] = np.minimum(counts[at] + 1, 2)
        number = part["slice"][0].as_py()
        for chunk, c in zip(part["_llm_chunk"].to_pylist(), cells):
            out.append((chunk, 0, number, np.packbits(counts[c[np.diff(c, prepend=-1) > 0]] > 1).tobytes()))
        return _table(out, ("_llm_chunk", "kind", "part", "bits"), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))

    def candidates(self, chunk: pa.Table, bits: pa.Table):
        """Windows of the chunk whose cells are all used more than once: row, first word, two hashes."""
        flags = _bits_of(bits, 0)
        rows, ats, lows, highs = [], [], [], []
        for first, texts in text_slices(chunk["text"]):
            words, at, low = _windows(texts, self.n)
            high = gram_hashes(word_hashes(words, 1), words.first, self.n, 1)[1] >> np.uint64(32)
            rows.append(words.row[at] + first)
            ats.append(at - words.first[words.row[at]])
            lows.append(low)
            highs.append(high.astype(np.uint32))
        if not lows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        row, at, low, high = (np.concatenate(x) for x in (rows, ats, lows, highs))
        for k in range(len(ROWS)):
            mine = _cells(low, k, self.bits)
            order = np.argsort(mine)
            cells = mine[order]
            new = np.ones(len(cells), bool)
            new[1:] = cells[1:] != cells[:-1]
            cells = cells[new]
            hit = [np.zeros(0, bool)]
            for part, a, b in _parts(_slice(cells)):
                hit.append(np.unpackbits(flags[part * len(ROWS) + k], count=b - a).astype(bool))
            keep = np.empty(len(mine), bool)
            keep[order] = np.concatenate(hit)[np.cumsum(new) - 1]
            held = keep if k == 0 else held & keep
        return row[held], at[held], low[held], high[held]

    def keys(self, chunk: pa.Table, bits: pa.Table):
        """Candidates, and the chunk's own keys among them: order, key of each in order, smallest id per key, bucket per key."""
        row, at, low, high = self.candidates(chunk, bits)
        ids = chunk["doc_id"].fill_null(_NO_ID).to_numpy().astype(np.int64)[row]
        order = np.lexsort((ids, high, low))
        low, high, ids = low[order], high[order], ids[order]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        bucket = ((low[new] >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(np.int64)
        return row[order], at[order], ids, np.cumsum(new) - 1, low[new], high[new], ids[new], bucket

    def send(self, key, chunk: pa.Table, bits: pa.Table) -> pa.Table:
        out = []
        if chunk.num_rows:
            *_, low, high, least, bucket = self.keys(chunk, bits)
            base = int(least.min()) if len(least) else 0
            narrow = len(least) and int(least.max()) - base < 2**32
            for part, a, b in _parts(bucket):
                ids = (least[a:b] - base).astype(np.uint32) if narrow else least[a:b]
                out.append((part, key[0].as_py(), base if narrow else None, low[a:b].tobytes(), high[a:b].tobytes(), ids.tobytes()))
        return _table(out, ("bucket", "_llm_chunk", "base", "low", "high", "ids"),
                      (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))

    def group(self, bucket: pa.Table) -> pa.Table:
        low = [np.frombuffer(x.as_py(), np.uint64) for x in bucket["low"]]
        high = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in bucket["high"]])
        ids = np.concatenate([
            np.frombuffer(x.as_py(), np.int64) if b is None else np.frombuffer(x.as_py(), np.uint32) + np.int64(b)
            for x, b in zip(bucket["ids"], bucket["base"].to_pylist())
        ])
        ends = np.cumsum([len(x) for x in low])
        low = np.concatenate(low)
        order = np.lexsort((ids, high, low))
        new = np.ones(len(low), bool)
        new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
        least = np.empty(len(low), np.int64)
        least[order] = ids[order][np.maximum.accumulate(np.where(new, np.arange(len(low)), 0))]
        smaller, number = least < ids, bucket["bucket"][0].as_py()
        out = [(c, 1, number, np.packbits(smaller[e - n : e]).tobytes())
               for c, e, n in zip(bucket["_llm_chunk"].to_pylist(), ends, np.diff(ends, prepend=0))]
        return _table(out, ("_llm_chunk", "kind", "part", "bits"), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))

    def cut(self, key, chunk: pa.Table, bits: pa.Table, carry: list[str]) -> pa.Table:
        texts, n_words, n_removed = [], [], []
        if chunk.num_rows:
            row, at, ids, of, *_, least, bucket = self.keys(chunk, bits)
            flags = _bits_of(bits, 1)
            smaller = [np.zeros(0, bool)]
            for part, a, b in _parts(bucket):
                smaller.append(np.unpackbits(flags[part], count=b - a).astype(bool))
            gone = np.concatenate(smaller)[of] | (ids > least[of]) if len(of) else np.zeros(0, bool)
            row, at = row[gone], at[gone]
            order = np.lexsort((at, row))
            row, at = row[order], at[order]
            for first, some in text_slices(chunk["text"]):
                words = split_words(some)
                a, b = np.searchsorted(row, (first, first + len(some)))
                cover = np.zeros(len(words.starts) + 1, np.int64)
                begin = words.first[row[a:b] - first] + at[a:b]
                np.add.at(cover, begin, 1)
                np.add.at(cover, begin + self.n, -1)
                covered = np.cumsum(cover)[:-1] > 0
                for i in range(len(some)):
                    f, t = words.first[i], words.first[i + 1]
                    n_words.append(int(t - f))
                    n_removed.append(int(covered[f:t].sum()))
                    texts.append(_without(words, f, t, covered[f:t], some[i].as_py()) if n_removed[-1] else some[i].as_py())
        columns = {"doc_id": chunk["doc_id"], "text": pa.array(texts, pa.string()),
                   "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
        return pa.table(columns | {c: chunk[c] for c in carry})


def _without(words, first: int, last: int, covered: np.ndarray, text: str) -> str:
    """The text without covered words and the space behind each run of them."""
    raw = text.encode()
    begin = words.starts[first:last]
    origin = int(begin[0]) - (len(raw) - len(raw.lstrip(b" \t\n\v\f\r")))
    begin = begin - origin
    edge = np.diff(covered.astype(np.int8), prepend=0, append=0)
    cuts, at = [], 0
    for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
        cuts.append(raw[at : begin[s]])
        at = int(begin[e]) if e < len(begin) else len(raw)
    return b"".join([*cuts, raw[at:]]).decode()


def _bits_of(bits: pa.Table, kind: int) -> dict[int, np.ndarray]:
    return {p: np.frombuffer(b, np.uint8)
            for k, p, b in zip(bits["kind"].to_pylist(), bits["part"].to_pylist(), bits["bits"].to_pylist()) if k == kind}


def _table(rows: list[tuple], names: tuple[str, ...], kinds: tuple[pa.DataType, ...]) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.table({n: pa.array(list(c), k) for n, k, c in zip(names, kinds, columns)})


def remove_repeats(
    docs: DataFrame, carry: tuple[str, ...] = (), window: int = WINDOW,
    chunk_bytes: int = CHUNK_BYTES, total: int | None = None,
) -> DataFrame:
    """``docs`` (doc_id, text) without repeated words: doc_id, text, n_words, n_removed, then ``carry``.

    One row per input row. NULL or empty text: empty, no words. Texts with fewer words than a window stay
    whole. Rows that share a doc_id do not count as repeats of each other; a NULL doc_id counts as larger
    than every other. Whitespace behind kept words stays. Columns not in ``carry`` are ignored; a carried
    column may not be called like one of the four. An empty table gives none.
    """
    total = text_bytes(docs) if total is None else total
    cells = max(1 << 16, total // 3)  # about two per word, in each row
    bits = max(SLICE_BITS, int(cells).bit_length())
    job = _Job(window, bits, max(1, -(-total // (16 * BUCKET_ROWS))))
    kept = list(carry)
    texts = docs.select("doc_id", "text", *kept).withColumn(
        "_llm_chunk", chunk_of(F.col("doc_id"), total, chunk_bytes)
    )
    grouped = texts.groupBy("_llm_chunk")
    used = grouped.applyInArrow(lambda chunk: job.count(chunk), "slice int, _llm_chunk long, cells binary")
    many = used.groupBy("slice").applyInArrow(lambda part: job.merge(part), _BITS)
    sent = grouped.cogroup(many.groupBy("_llm_chunk")).applyInArrow(
        lambda key, left, right: job.send(key, left, right), "bucket int, _llm_chunk long, base long, low binary, high binary, ids binary"
    )
    exact = sent.groupBy("bucket").applyInArrow(lambda bucket: job.group(bucket), _BITS)
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), *(docs.schema[c] for c in kept),
    ])
    return grouped.cogroup(many.unionByName(exact).groupBy("_llm_chunk")).applyInArrow(
        lambda key, left, right: job.cut(key, left, right, kept), schema
    )


def normal_words(text) -> F.Column:
    """Words joined by one space."""
    return F.array_join(F.array_remove(F.split(text, SPACE), ""), " ")
