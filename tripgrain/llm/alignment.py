"""Two tokenizers' tokens of the same texts, cut into groups at the bytes where both end a token.

A byte-level vocabulary (A) and a sentence-piece vocabulary (B) cover the same bytes. Every token points to
the farthest-right token that overlaps it, a token that ends where one of the other side ends points to
that end. Doubling the pointers, for all tokens of half a MB at once, leads each to the last token of its
group, whose number labels the group.

1. One pass over the texts, part by part. Units (a word with the white space before it, which neither vocabulary
   merges over) are encoded once per worker. Each slice of texts is a chunk: it keeps its distinct linked pairs
   with their number of documents, and per text the pairs as numbers in that list with their links.
2. The chunks' lists are summed per pair, and the highest count per A id is found, as plain aggregations.
3. Counts return to the chunks, one row per pair and chunk, and each text adds up its own.

Texts are neither shuffled nor encoded twice. A chunk's list is bounded by its slice, counts are spread by pair.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgrain.llm.words import Words, text_slices, word_hashes
from tripgrain.session import freeze

SLICE_BYTES = 4 << 20
#: Bytes of a slice's texts that are aligned at once.
PART_BYTES = 1 << 19
#: Units that a worker remembers, at most.
REMEMBER = 600_000
#: Bytes of new units that are encoded in one call.
TOGETHER = 1 << 16
#: Groups with more links than this are reduced to their distinct ids first.
BIG_GROUP = 1 << 12
_WHITE = b" \n\t\r\v\f"
_DIGITS = 6
_START = b" a"


def _byte_letters() -> dict[str, int]:
    """The letter of each byte in a byte-level vocabulary: itself where it prints, else the next free code point."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = sorted(set(range(256)) - plain)
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count in turn."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


class _Side:
    """A vocabulary: ids of bytes that begin with white space, and the bytes of ids."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.digits = np.zeros((len(pieces), _DIGITS), np.uint8)
        for i in range(len(pieces)):
            text = str(i).encode()
            self.digits[i, : len(text)] = np.frombuffer(text, np.uint8)
        self.width = (self.digits > 0).sum(axis=1)

    def ids(self, raw: bytes) -> np.ndarray:
        raise NotImplementedError

    def cuts(self, raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """ids of ``raw`` and how many of them lie before each of ``ends``; None where bytes or places differ."""
        ids = self.ids(raw)
        if b"".join(map(self.pieces.__getitem__, ids.tolist())) != raw:
            return None
        at = np.cumsum(self.length[ids])
        before = np.searchsorted(at, ends)
        return (ids, before + 1) if len(at) and (at[np.minimum(before, len(at) - 1)] == ends).all() else None


class _Bytes(_Side):
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path)
        self._model.encode_special_tokens = True
        letters = _byte_letters()
        added = {i: x.content for i, x in self._model.get_added_tokens_decoder().items()}
        pieces = [b""] * self._model.get_vocab_size()
        for token, i in self._model.get_vocab().items():
            pieces[i] = added[i].encode() if i in added else bytes(letters[c] for c in token)
        super().__init__(pieces)

    def ids(self, raw: bytes) -> np.ndarray:
        return np.array(self._model.encode(raw.decode(), add_special_tokens=False).ids, np.int64)


class _Pieces(_Side):
    """Pieces of a model that puts a space before the text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=path)
        super().__init__([
            bytes([int(self._model.id_to_piece(i)[3:5], 16)]) if self._model.is_byte(i)
            else self._model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self._model.vocab_size())
        ])

    def ids(self, raw: bytes) -> np.ndarray:
        return np.array(self._model.encode(raw[1:].decode(), num_threads=1), np.int64)


class Pair:
    """Both vocabularies, and the units a worker knows."""

    def __init__(self, path_a: str, path_b: str):
        self.sides = (_Bytes(path_a), _Pieces(path_b))
        self._cut = [c for c in b" \n" if not any(
            x == c and p[i] not in _WHITE for p in self.sides[1].pieces for i, x in enumerate(p[1:]))]
        self._forget()

    def _forget(self) -> None:
        self._hash = np.zeros(0, np.uint64)  # sorted; _at: number of each
        self._at = np.zeros(0, np.int64)
        self._good = np.zeros(0, bool)
        self._flat = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self._ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
        """Units of texts, cut before white space that follows a character which is surely none; which bytes end such."""
        safe = (data > 0x20) & (data != 0x7F)
        behind = lambda n: np.r_[np.zeros(n, np.uint8), data][: len(data)]
        safe &= ~((data >= 0x80) & ((behind(1) == 0xC2) | ((behind(2) >= 0xE1) & (behind(2) <= 0xE3))))
        cut = np.isin(data, np.array(self._cut, np.uint8))
        cut[1:] &= safe[:-1]
        cut[:1] = False
        cut[offsets[:-1][offsets[:-1] < len(data)]] = False
        begins = offsets[:-1][np.diff(offsets) > 0]
        starts = np.sort(np.r_[np.flatnonzero(cut), begins])
        ends = np.r_[starts[1:], len(data)] if len(starts) else starts
        first = np.searchsorted(starts, offsets)
        return Words(data, starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), first), safe

    def _both(self, units: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Per vocabulary the ids of units behind a word, and how many each has; None where they can't be told apart."""
        raw = _START + b"".join(units)
        ends = np.cumsum([len(_START), *map(len, units)])
        both = [side.cuts(raw, ends) for side in self.sides]
        if None in both:
            return None
        return [(ids[before[0] : before[-1]].astype(np.int32), np.diff(before)) for ids, before in both]

    def _encode(self, words: Words, together: np.ndarray, alone: np.ndarray) -> None:
        """Remember the ids of new units, in this order; those that end in white space are encoded one by one."""
        flat, many, good = [[x] for x in self._flat], [[], []], [self._good]
        size = np.cumsum(words.ends[together] - words.starts[together])
        batches, at = [], 0
        while at < len(together):
            end = min(len(together), int(np.searchsorted(size, (size[at - 1] if at else 0) + TOGETHER)) + 1)
            batches.append(together[at:end])
            at = end
        for batch in [*batches, *alone.reshape(-1, 1)]:
            units = [words.bytes_of(i) for i in batch]
            found = self._both(units)
            known = np.full(len(units), found is not None)
            if found is not None:
                parts = [found]
            elif len(units) == 1:
                parts = [None]
            else:
                parts = [self._both([unit]) for unit in units]
                known = np.array([part is not None for part in parts])
            good.append(known)
            for s in range(2):
                for part in parts:
                    flat[s].append(part[s][0] if part else np.zeros(0, np.int32))
                    many[s].append(part[s][1] if part else np.zeros(1, np.int64))
        self._good = np.concatenate(good)
        for s in range(2):
            self._flat[s] = np.concatenate(flat[s])
            self._ends[s] = np.r_[self._ends[s], self._ends[s][-1] + np.cumsum(np.concatenate(many[s]))]

    def known(self, words: Words, safe: np.ndarray) -> np.ndarray:
        """The number of each unit, after what is new has been encoded."""
        if len(self._good) > REMEMBER:
            self._forget()
        distinct, first, back = np.unique(word_hashes(words), return_index=True, return_inverse=True)
        place = np.searchsorted(self._hash, distinct)
        new = np.ones(len(distinct), bool)
        new[place < len(self._hash)] = self._hash[place[place < len(self._hash)]] != distinct[place < len(self._hash)]
        if new.any():
            example, hashes = first[new], distinct[new]
            plain = safe[words.ends[example] - 1]
            number = len(self._good) + np.arange(len(example))
            self._encode(words, example[plain], example[~plain])
            hashes = np.r_[self._hash, hashes[plain], hashes[~plain]]
            order = np.argsort(hashes, kind="stable")
            self._hash = hashes[order]
            self._at = np.r_[self._at, number][order]
        return self._at[np.searchsorted(self._hash, distinct)][back]

    def tokens(self, numbers: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units one after the other, and how many each has."""
        begin, end = self._ends[s][numbers], self._ends[s][numbers + 1]
        return self._flat[s][np.repeat(begin, end - begin) + _ranges(end - begin)].astype(np.int64), end - begin

    def good(self, numbers: np.ndarray) -> np.ndarray:
        return self._good[numbers]


_pairs: dict[tuple[str, str], Pair] = {}


def _pair(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


def label_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and B token, numbered from 0, from the byte ends of both covers of the same bytes."""
    n_a = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)  # the B token on an A token's last byte
    over_b = np.searchsorted(ends_a, ends_b)
    last = ends_a[over_b] == ends_b
    point = np.r_[n_a + over_a, np.where(last, n_a + np.arange(len(ends_b)), over_b)]
    final = np.r_[np.zeros(n_a, bool), last]
    while not final[point].all():
        point = point[point]
    group = (np.cumsum(last) - 1)[point - n_a]
    return group[:n_a], group[n_a:]


def _links(a, b, group_a, group_b, n_a, n_b, doc, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc * span**2 + a * span + b, number of links) of all linked pairs, distinct and in order."""
    first_b = np.cumsum(n_b) - n_b
    small = (n_a * n_b <= BIG_GROUP)[group_a]
    of, many = group_a[small], n_b[group_a[small]]
    right = np.repeat(first_b[of], many) + _ranges(many)
    keys = np.repeat((doc[of] * span + a[small]) * span, many) + b[right]
    keys, n = np.unique(keys, return_counts=True)
    parts = [(keys, n)]
    first_a = np.cumsum(n_a) - n_a
    for g in np.flatnonzero(n_a * n_b > BIG_GROUP):
        ids_a, times_a = np.unique(a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        ids_b, times_b = np.unique(b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        parts.append((((doc[g] * span + ids_a[:, None]) * span + ids_b).ravel(), np.outer(times_a, times_b).ravel()))
    if len(parts) == 1:
        return keys, n
    keys, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[new], np.add.reduceat(n, new)


def _written(pair: Pair, a, b, group_a, group_b, n_a, n_b, last_group: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The groups as text one after the other, and where each group ends in it."""
    total = len(a) + len(b)
    text = np.zeros((total, _DIGITS + 1), np.uint8)
    width = np.empty(total, np.int64)
    in_a, in_b = np.cumsum(n_a), np.cumsum(n_b)
    place_a = np.arange(len(a)) + (in_b - n_b)[group_a]
    place_b = np.arange(len(b)) + in_a[group_b]
    for side, ids, place, ends, mark in zip(pair.sides, (a, b), (place_a, place_b), (in_a, in_b), b"|;"):
        sign = np.full(len(ids), ord(","), np.uint8)
        sign[ends - 1] = mark
        if mark == ord(";"):
            sign[ends[last_group] - 1] = 0
        text[place, :_DIGITS] = side.digits[ids]
        text[place, _DIGITS] = sign
        width[place] = side.width[ids] + (sign > 0)
    flat = text.ravel()
    return flat[flat > 0].tobytes(), np.cumsum(width)[in_a + in_b - 1]


def _narrow(values: np.ndarray) -> bytes:
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if not len(values) or int(values.max()) <= np.iinfo(k).max)
    return kind.encode() + values.astype(kind).tobytes()


def _wide(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, blob[:3].decode(), offset=3).astype(np.int64)


def _span(pair: Pair) -> int:
    return max(len(side.pieces) for side in pair.sides)


_EMPTY = (0, 0, 0, 0, "", b"<u1", b"<u1")


def _part(pair: Pair, texts: pa.Array) -> tuple[list[tuple], np.ndarray, list[np.ndarray]]:
    """Per text (n_a, n_b, n_groups, n_links, groups, nothing, links); the distinct pairs, and each text's among them."""
    n = len(texts)
    spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(
        pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
    _, offsets, data = spaced.buffers()
    offsets = np.frombuffer(offsets, np.int64)[spaced.offset : spaced.offset + n + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    words, safe = pair.units(data, offsets - offsets[0])
    none = [_EMPTY] * n, np.zeros(0, np.int64), [np.zeros(0, np.int32)] * n
    if not len(words.starts):
        return none
    numbers = pair.known(words, safe)
    bad = np.zeros(n, bool)
    bad[words.row[~pair.good(numbers)]] = True
    keep = ~bad[words.row]
    numbers, row = numbers[keep], words.row[keep]
    (a, count_a), (b, count_b) = (pair.tokens(numbers, s) for s in range(2))
    if not len(a):
        return none
    group_a, group_b = label_groups(*(np.cumsum(side.length[ids]) for side, ids in zip(pair.sides, (a, b))))
    n_a, n_b = np.bincount(group_a), np.bincount(group_b)
    doc = np.repeat(row, count_a)[np.cumsum(n_a) - 1]
    edges = np.searchsorted(doc, np.arange(n + 1))
    have = np.diff(edges) > 0
    text, text_ends = _written(pair, a, b, group_a, group_b, n_a, n_b, edges[1:][have] - 1)
    span = _span(pair)
    keys, links = _links(a, b, group_a, group_b, n_a, n_b, doc, span)
    distinct, code = np.unique(keys % (span * span), return_inverse=True)
    cuts = np.searchsorted(keys, np.arange(n + 1) * (span * span))
    sums = [np.r_[0, np.cumsum(x)] for x in (n_a, n_b, n_a * n_b)]
    text_ends = np.r_[0, text_ends]
    out = []
    for i in range(n):
        if not have[i]:
            out.append(_EMPTY)
            continue
        f, t = edges[i], edges[i + 1]
        out.append((
            *(int(x[t] - x[f]) for x in sums[:2]), int(t - f), int(sums[2][t] - sums[2][f]),
            hashlib.sha256(text[text_ends[f] : text_ends[t]]).hexdigest(), b"", _narrow(links[cuts[i] : cuts[i + 1]]),
        ))
    return out, distinct, np.split(code.astype(np.int32), cuts[1:-1])


def _chunk(pair: Pair, texts: pa.Array) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """Per text (n_a, n_b, n_groups, n_links, groups, pairs, links); then the distinct pairs and their texts.

    The texts are aligned part by part, so that only the pairs of a part are there as wide numbers.
    """
    parts = [_part(pair, some) for _, some in text_slices(texts, PART_BYTES)]
    distinct = np.unique(np.concatenate([pairs for _, pairs, _ in parts] or [np.zeros(0, np.int64)]))
    docs = np.zeros(len(distinct), np.int64)
    out = []
    for rows, pairs, codes in parts:
        place = np.searchsorted(distinct, pairs)
        docs[place] += np.bincount(np.concatenate(codes), minlength=len(pairs))
        out += [(*row[:5], _narrow(place[code]), row[6]) for row, code in zip(rows, codes)]
    return out, distinct, docs


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_STORED = pa.schema([
    *((c, pa.int64()) for c in _COUNTS), ("groups_sha256", pa.string()), ("codes", pa.binary()), ("links", pa.binary()),
])


def _align(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    """Rows of texts, and per chunk one more row that holds its pairs."""
    pair, task, number = _pair(path_a, path_b), TaskContext.get().partitionId(), 0
    for batch in batches:
        for first, texts in text_slices(batch["text"], SLICE_BYTES):
            rows, pairs, docs = _chunk(pair, texts)
            ids = batch["doc_id"].slice(first, len(texts))
            columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), _STORED)]
            chunk = (task << 32) + number
            number += 1
            lists = (pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk] * len(texts), pa.int64()), ids, *columns, *(pa.nulls(len(texts), k) for k in lists)],
                ["chunk", "doc_id", *_STORED.names, "pair", "docs"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.nulls(1, ids.type), *(pa.nulls(1, f.type) for f in _STORED),
                 *(pa.array([x], k) for x, k in zip((pairs, docs), lists))],
                ["chunk", "doc_id", *_STORED.names, "pair", "docs"])


def _add_up(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """Each text's links with the highest count of their A id, and the sum of its links' counts."""
    order = np.argsort(counts["pair"].to_numpy())
    n, best = counts["n"].to_numpy()[order], counts["best"].to_numpy()[order].astype(np.int64)
    n_best, total = [], []
    for codes, links in zip(rows["codes"], rows["links"]):
        code, times = _wide(codes.as_py()), _wide(links.as_py())
        n_best.append(int((best[code] * times).sum()))
        total.append(int((n[code] * times).sum()))
    return pa.table({
        "doc_id": rows["doc_id"], **{c: rows[c] for c in _COUNTS},
        "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64()), "groups_sha256": rows["groups_sha256"],
    })


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Groups and links of the two tokenizers' tokens: one row per row of ``docs`` (doc_id, text).

    Columns: doc_id; n_a, n_b, the tokens of a byte-level vocabulary for the text behind a space and of a
    sentence-piece vocabulary for the text; n_groups; n_links, the A-B pairs of tokens in one group; n_best, the
    links whose id pair is in as many documents as any pair of its A id; count_sum, the documents of the links'
    pairs added up; groups_sha256 of the groups written as ``a1,a2|b1;a3|b2,b3``. The strings of special tokens
    are plain text.

    A NULL or empty text, and one whose tokens' bytes differ from it (such as one with U+2581), has no tokens:
    zeros, and an empty string in place of the hash. Repeated rows, and rows with NULL or equal doc_ids, are
    documents of their own. Other columns are ignored whatever their names. An empty table gives none. A text of any
    length is cut into tokens as a whole; units are told apart by 64-bit hashes.
    """
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in _COUNTS),
        T.StructField("groups_sha256", T.StringType()), T.StructField("codes", T.BinaryType()),
        T.StructField("links", T.BinaryType()), T.StructField("pair", T.ArrayType(T.LongType())),
        T.StructField("docs", T.ArrayType(T.LongType())),
    ])
    stored = freeze(docs.select("doc_id", "text").mapInArrow(lambda batches: _align(batches, path_a, path_b), schema))
    span = _span(_pair(path_a, path_b))
    lists = stored.where("pair IS NOT NULL").select("chunk", F.explode(F.arrays_zip("pair", "docs")).alias("x"))
    lists = lists.select("chunk", "x.pair", "x.docs")
    counts = lists.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.expr(f"pair div {span}"))
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    known = counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    answers = lists.select(F.col("chunk").alias("of"), "pair").join(known, "pair")
    rows = stored.where("pair IS NULL").drop("pair", "docs")
    out = T.StructType([
        docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in (*_COUNTS, "n_best", "count_sum")),
        T.StructField("groups_sha256", T.StringType()),
    ])
    return rows.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(
        lambda left, right: _add_up(left, right), out)
