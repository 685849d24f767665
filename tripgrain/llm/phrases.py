"""Phrases of several words that occur more often together than their parts would by chance, per language.

A word with fewer than ``least`` occurrences is in no phrase with as many, so texts are first written as
numbers of frequent words. Runs of up to ``LONGEST`` of them go into a HAT-trie: a shallow trie over word
numbers whose leaves are hash containers of key ranges. A container that grows too large bursts: its range
is halved, or, when it holds one word only, a trie node of the next word takes its place. When a task's trie
is full, whole subtrees leave it as sorted runs.

1. Texts become chunks of local word numbers with the chunk's words and counts: one pass, without a shuffle.
2. Blocks of the chunks' words meet by hash. Each language's words are added up there; frequent ones get numbers,
   which return to the chunks in blocks as well.
3. Each task counts its chunks' windows of ``LONGEST`` words, stopped at the end of a piece or before a rare word.
   Every phrase is the beginning of a window, so each place is stored once for all lengths.
4. Runs are merged per prefix partition. A prefix is two words, and further words while all before are very
   frequent; it has at most ``PART_WORDS`` windows, so partitions are bounded. Counts of shorter phrases, which
   several partitions share, are added up.
5. Cuts, scores and containment are joins of the frequent phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripgrain.llm.words import mix, split_words, text_bytes, text_slices, word_hashes
from tripgrain.operators.joins import lookup_join
from tripgrain.session import freeze

LONGEST = 5
LEAST = 100
TOP = 2000
SLICE_BYTES = 8 << 20
#: Bytes of a slice whose words are found at once, and places of a chunk whose windows are made at once.
PART_BYTES, PART_PLACES = 1 << 20, 1 << 17
#: Bytes of text whose words meet in one block, about.
BLOCK_BYTES = 16 << 20
#: Entries of a container that bursts, and of a task's trie that is full.
BURST, FULL = 1 << 16, 1 << 20
#: Trie nodes stand for the first words of a window only, so many at most.
DEEPEST = 2
#: Windows of one prefix partition, about, and of one prefix at most.
PART_WORDS = 2_000_000
#: Groups that a language's best phrases are first sought in.
BEST_GROUPS = 64
_BARRIER = np.zeros(256, bool)
_BARRIER[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_ZSTD = pa.Codec("zstd", compression_level=1)
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)

Keys = tuple[np.ndarray, np.ndarray, np.ndarray]  # words 1 and 2, 3 and 4, and 5, as 32 bits each; 0 is none


# --- chunks of local word numbers ---


def _pack(values: np.ndarray) -> bytes:
    """Numbers from 0 on as compressed planes of bytes."""
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(values).to_bytes(8, "little") + bytes([width]) + _ZSTD.compress(planes, asbytes=True)


def _unpack(blob: bytes) -> np.ndarray:
    n, width = int.from_bytes(blob[:8], "little"), blob[8]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(_ZSTD.decompress(blob[9:], n * width, asbytes=True), np.uint8).reshape(width, n).T
    return out.view("<i8").ravel()


_Found = tuple[int, np.ndarray, np.ndarray, list[str], np.ndarray]


def _slice_words(texts: pa.Array, langs: np.ndarray) -> Iterator[_Found]:
    """Per language of a slice: language, local numbers with 0 between pieces, and of number 1 on hash, word and count."""
    parts: dict[int, list[tuple]] = {}
    for start, some in text_slices(texts, PART_BYTES):
        for one, *found in _part_words(some, langs[start : start + len(some)]):
            parts.setdefault(one, []).append(found)
    for one in sorted(parts):
        numbers, hashes, words, n = zip(*parts.pop(one))
        ends = np.cumsum([0, *map(len, hashes)])
        distinct, first, back = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        counts = np.bincount(back, np.concatenate(n), len(distinct)).astype(np.int64)
        ids = np.concatenate([np.r_[0, back[a:b] + 1].astype(np.int32)[x] for x, a, b in zip(numbers, ends, ends[1:])])
        of = np.searchsorted(ends, first, "right") - 1
        yield one, ids, distinct, [words[k][i] for k, i in zip(of.tolist(), (first - ends[of]).tolist())], counts


def _part_words(texts: pa.Array, langs: np.ndarray) -> Iterator[_Found]:
    """As ``_slice_words``, of a part."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    ends_piece = _BARRIER[raw]  # of this slice, not of the batch that it shares its bytes with
    barriers = np.flatnonzero(ends_piece)
    cut = np.where(ends_piece, np.uint8(0x0A), raw)
    texts = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(cut)])
    words = split_words(texts, lower=True)
    del raw, ends_piece, cut, texts
    if not len(words.starts):
        return
    new = np.ones(len(words.starts), bool)
    new[1:] = (np.diff(words.row) > 0) | (
        np.searchsorted(barriers, words.starts[1:]) > np.searchsorted(barriers, words.ends[:-1]))
    hashes = word_hashes(words)
    lang = langs[words.row]
    for one in np.unique(lang):
        mine = np.flatnonzero(lang == one)
        distinct, first, back, n = np.unique(hashes[mine], return_index=True, return_inverse=True, return_counts=True)
        numbers = np.zeros(len(mine) + int(new[mine].sum()), np.int32)
        numbers[np.arange(len(mine)) + np.cumsum(new[mine])] = back + 1
        yield int(one), numbers, distinct, [words.bytes_of(i).decode() for i in mine[first]], n


_CHUNK = pa.schema([
    ("chunk", pa.int64()), ("lang", pa.string()), ("ids", pa.binary()), ("total", pa.int64()),
    ("block", pa.int64()), ("first", pa.int64()), ("words", pa.list_(pa.string())), ("n", pa.binary()),
])
_CHUNK_DDL = "chunk long, lang string, ids binary, total long, block long, first long, words array<string>, n binary"


def _chunks(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    """Per slice and language one row with the numbers of its text and one per block of its words."""
    task, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        names = batch["lang"].dictionary_encode()
        langs, names = names.indices.to_numpy(zero_copy_only=False), names.dictionary.to_pylist()
        for start, texts in text_slices(batch["text"], SLICE_BYTES):
            for lang, ids, hashes, words, n in _slice_words(texts, langs[start : start + len(texts)]):
                chunk = (task << 32) + number
                number += 1
                rows = [(chunk, names[lang], _pack(ids), int(n.sum()), None, None, None, None)]
                block = (hashes >> _HALF) * np.uint64(blocks) >> _HALF
                edges = np.flatnonzero(np.diff(block.astype(np.int64), prepend=-1))
                for a, b in zip(edges.tolist(), np.r_[edges[1:], len(n)].tolist()):
                    rows.append((chunk, names[lang], None, None, int(block[a]), a + 1, words[a:b], _pack(n[a:b])))
                del ids, hashes, words, n, block
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CHUNK)], schema=_CHUNK)
                del rows


_NUMBERED = pa.schema([
    ("lang", pa.string()), ("word", pa.string()), ("f", pa.int64()), ("number", pa.int64()),
    ("chunk", pa.int64()), ("places", pa.binary()), ("numbers", pa.binary()),
])
_NUMBERED_DDL = "lang string, word string, f long, number long, chunk long, places binary, numbers binary"


def _number(rows: pa.Table, blocks: int, least: int, hot: int) -> pa.Table:
    """A block's frequent words with their numbers (odd: more than ``hot``), then per chunk the numbers of its words."""
    sizes = pc.list_value_length(rows["words"]).to_numpy()
    langs = rows["lang"].combine_chunks().dictionary_encode()
    every = pa.table({
        "lang": np.repeat(langs.indices.to_numpy(), sizes), "word": pc.list_flatten(rows["words"]),
        "f": np.concatenate([_unpack(x.as_py()) for x in rows["n"]]),
    }).combine_chunks()
    key = pc.binary_join_element_wise(pc.cast(every["lang"], pa.string()), every["word"], " ").combine_chunks().dictionary_encode()
    code = key.indices.to_numpy()
    f = np.zeros(len(key.dictionary), np.int64)
    np.add.at(f, code, every["f"].to_numpy())
    frequent = np.flatnonzero(f >= least)
    order = pc.sort_indices(key.dictionary.take(pa.array(frequent))).to_numpy()
    frequent = frequent[order]
    number = np.zeros(len(f), np.int64)
    block = rows["block"][0].as_py()
    number[frequent] = ((np.arange(len(frequent)) + 1) * blocks + block) * 2 + (f[frequent] > hot)
    if len(frequent) and number[frequent].max() >= 1 << 32:
        raise OverflowError("more frequent words than numbers")
    example = np.zeros(len(f), np.int64)
    example[code] = np.arange(len(code))
    of = pa.array(example[frequent])
    words = pa.table([
        langs.dictionary.take(every["lang"].take(of)), every["word"].take(of), pa.array(f[frequent]), pa.array(number[frequent]),
        *(pa.nulls(len(frequent), _NUMBERED.field(c).type) for c in ("chunk", "places", "numbers")),
    ], schema=_NUMBERED)
    numbers, edges, back = number[code], np.r_[0, np.cumsum(sizes)], []
    for i, (chunk, first) in enumerate(zip(rows["chunk"].to_pylist(), rows["first"].to_pylist())):
        mine = numbers[edges[i] : edges[i + 1]]
        at = np.flatnonzero(mine)
        if len(at):
            back.append((chunk, _pack(at + first), _pack(mine[at])))
    chunks, places, packed = zip(*back) if back else ((), (), ())
    return pa.concat_tables([words, pa.table([
        *(pa.nulls(len(chunks), _NUMBERED.field(c).type) for c in ("lang", "word", "f", "number")),
        pa.array(chunks, pa.int64()), pa.array(places, pa.binary()), pa.array(packed, pa.binary()),
    ], schema=_NUMBERED)])


# --- the trie ---


def _word(keys: Keys, depth: int) -> np.ndarray:
    pair = keys[depth // 2]
    return pair if depth == 4 else pair & _LOW if depth % 2 else pair >> _HALF


def _take(keys: Keys, at) -> Keys:
    return keys[0][at], keys[1][at], keys[2][at]


def _sorted(keys: Keys, n: np.ndarray) -> tuple[Keys, np.ndarray]:
    """Distinct keys in order, with their counts added."""
    order = np.lexsort(keys[::-1])
    keys, n = _take(keys, order), n[order]
    new = np.ones(len(n), bool)
    new[1:] = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1]) | (keys[2][1:] != keys[2][:-1])
    at = np.flatnonzero(new)
    return _take(keys, at), np.add.reduceat(n, at) if len(at) else n


class Container:
    """A hash table of keys with counts, half full at most, that takes many keys at once."""

    def __init__(self) -> None:
        self.used = 0
        self._make(1 << 8)

    def _make(self, slots: int) -> None:
        self._keys = tuple(np.zeros(slots, np.uint64) for _ in range(3))
        self._n = np.zeros(slots, np.int64)

    def entries(self) -> tuple[Keys, np.ndarray]:
        """Distinct keys in order, and their counts."""
        at = np.flatnonzero(self._n)
        return _sorted(_take(self._keys, at), self._n[at])

    def add(self, keys: Keys, n: np.ndarray) -> None:
        """``keys`` are distinct."""
        if 2 * (self.used + len(n)) > len(self._n):
            at = np.flatnonzero(self._n)
            old, counts = _take(self._keys, at), self._n[at]
            self._make(1 << int(2 * (self.used + len(n)) - 1).bit_length())
            self.used = 0
            self._put(old, counts)
        self._put(keys, n)

    def _put(self, keys: Keys, n: np.ndarray) -> None:
        mask = np.int64(len(self._n) - 1)
        slot = (mix(keys[0] ^ mix(keys[1] ^ mix(keys[2]))) >> np.uint64(1)).astype(np.int64) & mask
        todo = np.arange(len(n))
        claim = np.empty(len(self._n), np.int64)
        while len(todo):
            here = slot[todo]
            free = self._n[here] == 0
            claim[here[free]] = todo[free]  # the last one to write a free slot has it
            won = np.flatnonzero(free)
            won = won[claim[here[won]] == todo[won]]
            for mine, given in zip(self._keys, keys):
                mine[here[won]] = given[todo[won]]
            self.used += len(won)
            same = np.ones(len(todo), bool)
            for mine, given in zip(self._keys, keys):
                same &= mine[here] == given[todo]
            same &= ~free | np.isin(np.arange(len(todo)), won, assume_unique=True)
            self._n[here[same]] += n[todo[same]]
            todo = todo[~same]
            slot[todo] = (slot[todo] + 1) & mask


class Trie:
    """A node: ranges of the word at ``depth``, each with a container, or one word with a node of the next."""

    def __init__(self, depth: int = 0):
        self.depth = depth
        self.begin = [0]  # first word of each range
        self.children: list[Trie | Container] = [Container()]

    @property
    def used(self) -> int:
        return sum(child.used for child in self.children)

    def entries(self) -> tuple[Keys, np.ndarray]:
        keys, n = zip(*(child.entries() for child in self.children))
        return tuple(np.concatenate(k) for k in zip(*keys)), np.concatenate(n)

    def add(self, keys: Keys, n: np.ndarray) -> None:
        """``keys`` are distinct and in order."""
        if not len(n):
            return
        child = np.searchsorted(np.array(self.begin, np.uint64), _word(keys, self.depth), "right") - 1
        edges = np.flatnonzero(np.diff(child, prepend=-1))
        for a, b in zip(edges[::-1].tolist(), np.r_[edges[1:], len(child)][::-1].tolist()):
            at = int(child[a])
            one = self.children[at]
            one.add(_take(keys, slice(a, b)), n[a:b])
            while isinstance(one, Container) and one.used > BURST and self._burst(at):
                one = self.children[at]

    def _burst(self, at: int) -> bool:
        keys, n = self.children[at].entries()
        words = _word(keys, self.depth)
        low, high = int(words[0]), int(words[-1])
        if low < high:
            middle = max(int(words[len(words) // 2]), low + 1)
            cut = int(np.searchsorted(words, np.uint64(middle)))
            parts = [(self.begin[at], slice(0, cut)), (middle, slice(cut, None))]
            made = [Container() for _ in parts]
        elif self.depth < DEEPEST:
            end = self.begin[at + 1] if at + 1 < len(self.begin) else 1 << 32
            parts = [(low, slice(0, None))] + ([(low + 1, slice(0, 0))] if low + 1 < end else [])
            made = [Trie(self.depth + 1)] + [Container() for _ in parts[1:]]
            if self.begin[at] < low:
                parts, made = [(self.begin[at], slice(0, 0)), *parts], [Container(), *made]
        else:
            return False  # the deepest containers grow
        for (_, part), one in zip(parts, made):
            one.add(_take(keys, part), n[part])
        self.begin[at : at + 1] = [first for first, _ in parts]
        self.children[at : at + 1] = made
        return True

    def spill(self, left: int) -> tuple[Keys, np.ndarray]:
        """A sorted run of the largest subtrees, which are emptied, until at most ``left`` entries stay."""
        stay, out = self.used, []
        for at in sorted(range(len(self.children)), key=lambda i: -self.children[i].used):
            if stay <= left:
                break
            stay -= self.children[at].used
            out.append(at)
        runs = [[np.zeros(0, np.uint64)] for _ in range(3)] + [[np.zeros(0, np.int64)]]
        for at in sorted(out):
            keys, n = self.children[at].entries()
            self.children[at] = Container()
            for column, more in zip(runs, (*keys, n)):
                column.append(more)
        *keys, n = (np.concatenate(runs.pop(0)) for _ in range(4))
        return tuple(keys), n


# --- windows, runs and their merge ---


def windows(stream: np.ndarray, size: int | None = None) -> Keys:
    """Windows that begin at each place of a stream of word numbers (0: a barrier), or its first ``size``, and have two words at least."""
    size = len(stream) if size is None else size
    stream = np.r_[stream[: size + LONGEST - 1], np.zeros(max(0, size + LONGEST - 1 - len(stream)), np.int64)].astype(np.uint64)
    words = [stream[k : k + size] for k in range(LONGEST)]
    for k in range(1, LONGEST):
        words[k] = np.where(words[k - 1] > 0, words[k], np.uint64(0))
    at = np.flatnonzero(words[1] > 0)
    words = [w[at] for w in words]
    return words[0] << _HALF | words[1], words[2] << _HALF | words[3], words[4]


def prefix_words(keys: Keys) -> np.ndarray:
    """How many words of each window pick its partition: two, and one more while all before are hot (odd numbers)."""
    out = np.full(len(keys[0]), 2)
    hot = ((_word(keys, 0) & _word(keys, 1)) & np.uint64(1)).astype(bool)
    for depth in range(2, LONGEST):
        out[hot] = depth + 1
        hot &= (_word(keys, depth) & np.uint64(1)).astype(bool)
    return out


def _partition(keys: Keys, parts: int) -> np.ndarray:
    depth = prefix_words(keys)
    h = mix(keys[0])
    for k in range(2, LONGEST):
        h = np.where(depth > k, mix(h ^ _word(keys, k)), h)
    return ((h >> _HALF) * np.uint64(parts) >> _HALF).astype(np.int64)


_RUN = pa.schema([("part", pa.int64()), *((f"w{k}", pa.binary()) for k in range(LONGEST)), ("n", pa.binary())])
_RUN_DDL = "part long, " + ", ".join(f"w{k} binary" for k in range(LONGEST)) + ", n binary"


def _runs(keys: Keys, n: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """A sorted run, one row per prefix partition."""
    part = _partition(keys, parts)
    order = np.argsort(part, kind="stable")
    part = part[order]
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.r_[edges, len(part)]
    for at in range(0, len(edges), 256):
        cuts = ends[at : at + 257]
        here = order[cuts[0] : cuts[-1]]
        some, cuts = _take(keys, here), (cuts - cuts[0]).tolist()
        yield pa.RecordBatch.from_arrays([
            pa.array(part[edges[at : at + 256]]),
            *(pa.array([_pack(c[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()) for c in (_word(some, k) for k in range(LONGEST))),
            pa.array([_pack(n[here[a:b]]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
        ], schema=_RUN)


def _count(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """The windows of all chunks of a task, as runs."""
    trie = Trie()
    for batch in batches:
        for ids, numbers in zip(batch["ids"], batch["numbers"]):
            local = _unpack(ids.as_py())
            table = np.zeros(int(local.max()) + 1, np.int64)
            for block in numbers.as_py():
                table[_unpack(block["places"])] = _unpack(block["numbers"])
            stream = table[local].astype(np.uint32)
            del local, table
            for a in range(0, len(stream), PART_PLACES):
                keys = windows(stream[a : a + PART_PLACES + LONGEST - 1], min(PART_PLACES, len(stream) - a))
                trie.add(*_sorted(keys, np.ones(len(keys[0]), np.int64)))
                if trie.used > FULL:
                    yield from _runs(*trie.spill(FULL // 2), parts)
    yield from _runs(*trie.spill(0), parts)


def _merge(rows: pa.Table, least: int) -> pa.Table:
    """Phrases of a prefix partition: the words as 4 bytes each and their count here.

    Rare phrases go where the partition has all their windows.
    """
    def words(k: int) -> np.ndarray:
        return np.concatenate([_unpack(x.as_py()).astype(np.uint32) for x in rows[f"w{k}"]])

    n = np.concatenate([_unpack(x.as_py()) for x in rows["n"]])
    keys = tuple(words(k).astype(np.uint64) << _HALF | words(k + 1) for k in (0, 2)) + (words(4).astype(np.uint64),)
    keys, n = _sorted(keys, n)
    depth = prefix_words(keys).astype(np.int8)
    sums = np.r_[0, np.cumsum(n)]
    new = np.zeros(len(n), bool)
    new[:1] = True
    new[1:] = keys[0][1:] != keys[0][:-1]
    out, counts = [], []
    for k in range(1, LONGEST):
        word = _word(keys, k)
        new[1:] |= word[1:] != word[:-1]
        at = np.flatnonzero(new)
        count = np.diff(sums[np.r_[at, len(n)]])
        keep = (word[at] > 0) & ((count >= least) | (depth[at] > k + 1))
        kept = _take(keys, at[keep])
        raw = np.stack([_word(kept, j) for j in range(k + 1)], axis=1).astype(">u4").tobytes()
        out += [raw[i : i + 4 * (k + 1)] for i in range(0, len(raw), 4 * (k + 1))]
        counts.append(count[keep])
    return pa.table({"key": pa.array(out, pa.binary()), "f": pa.array(np.concatenate(counts), pa.int64())})


# --- the job ---


def _binary(number) -> F.Column:
    return F.unhex(F.lpad(F.hex(number), 8, "0"))


def count_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Frequent words (lang, word, f, n, key) and phrases of 2 to 5 of them (key, f) with ``least`` occurrences.

    A key is 4 bytes per word; n counts all words of the language. Both are stored.
    """
    blocks = max(1, -(-text_bytes(docs) // BLOCK_BYTES))
    chunks = freeze(docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang")).mapInArrow(
        lambda batches: _chunks(batches, blocks), _CHUNK_DDL))
    texts = chunks.where("ids IS NOT NULL").select("chunk", "lang", "ids", "total")
    totals = freeze(texts.groupBy("lang").agg(F.sum("total").alias("n")))
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = PART_WORDS
    met = chunks.where("ids IS NULL").select("chunk", "lang", "block", "first", "words", "n")
    numbered = freeze(met.repartition(blocks, "block").groupBy("block").applyInArrow(
        lambda rows: _number(rows, blocks, least, hot), _NUMBERED_DDL))
    words = freeze(lookup_join(numbered.where("chunk IS NULL").select("lang", "word", "f", "number"), totals, ["lang"], ["word"]).select(
        "lang", "word", "f", "n", _binary(F.col("number")).alias("key")))
    numbers = numbered.where("chunk IS NOT NULL").groupBy("chunk").agg(
        F.collect_list(F.struct("places", "numbers")).alias("numbers"))
    parts = max(1, -(-total // PART_WORDS))
    runs = texts.select("chunk", "ids").join(numbers, "chunk").select("ids", "numbers").mapInArrow(
        lambda batches: _count(batches, parts), _RUN_DDL)
    merged = runs.repartition(parts, "part").groupBy("part").applyInArrow(lambda rows: _merge(rows, least), "key binary, f long")
    phrases = freeze(merged.groupBy("key").agg(F.sum("f").alias("f")).where(F.col("f") >= least))
    return words, phrases


def _part(key: str, first, count) -> F.Column:
    return F.substring(F.col(key), first * 4 + 1, count * 4)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = 100) -> DataFrame:
    """The ``top`` best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts of ``docs`` (text, lang) are lower-cased in A-Z and cut at ``.,;:!?`` and line ends into pieces, these at
    spaces and tabs into words. A phrase is 2 to 5 words of one piece that occur ``least`` times or more in the language (a).
    Of its cuts into a first part (l occurrences) and a rest (r), the one with the lowest 1000 * a * n // (l * r)
    counts, of equal ones the shortest first part; n is all words of the language. A phrase goes if a longer one
    contains it with ``share`` percent of its occurrences. Order: score and a falling, phrase rising by bytes.

    NULL lang is ``und``; NULL and empty texts have no words; repeated rows count again. Ties have one order, since a
    language has a phrase once. Other columns are ignored whatever their names. An empty table gives none. Within a chunk
    words are told apart by 64-bit hashes; whole words are compared between chunks.
    """
    words, phrases = count_phrases(docs, least)
    size = F.expr("cast(length(key) / 4 as int)")
    counts = words.select("key", "f").unionByName(phrases)
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "key", F.col("f").alias("a"), "k", _part("key", F.lit(0), F.col("k")).alias("left"),
        _part("key", F.col("k"), size - F.col("k")).alias("right"))
    every = cuts = cuts.withColumn("_first", _part("key", F.lit(0), F.lit(1)))
    for on, table in (
        ("left", counts.select(F.col("key").alias("left"), F.col("f").alias("l"))),
        ("right", counts.select(F.col("key").alias("right"), F.col("f").alias("r"))),
        ("_first", words.select(F.col("key").alias("_first"), "lang", "n")),
    ):
        cuts = lookup_join(cuts, table, [on], ["key", "k"], heat=every)
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    cuts = cuts.withColumn("_above", F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n")).withColumn("_below", wide("l") * wide("r"))
    scored = cuts.groupBy("key").agg(
        F.first("lang").alias("lang"), F.first("a").alias("a"), F.first("n").alias("n"),
        F.min(F.struct(F.expr("_above div _below").alias("score"), "k", "l", "r")).alias("_cut"))
    longer = phrases.where(size > 2)
    around = longer.select(_part("key", F.lit(0), size - 1).alias("key"), "f").unionByName(
        longer.select(_part("key", F.lit(1), size - 1).alias("key"), "f")).groupBy("key").agg(F.max("f").alias("_around"))
    kept = scored.join(around, "key", "left").where(F.col("_around").isNull() | (100 * F.col("_around") < share * F.col("a")))
    spell = lambda table: table.select("key", F.posexplode(F.sequence(F.lit(0), size - 1)).alias("place", "_i")).select(
        "key", "place", _part("key", F.col("place"), F.lit(1)).alias("_word"))
    spelled = lookup_join(
        spell(kept), words.select(F.col("key").alias("_word"), "word"), ["_word"], ["key", "place"], heat=spell(phrases),
    ).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("_words"))
    spelled = spelled.select("key", F.array_join("_words.word", " ").alias("phrase"))
    rows = kept.join(spelled, "key").select(
        "lang", "phrase", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), "n", F.col("_cut.score").alias("score"))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    group = F.pmod(F.xxhash64("phrase"), F.lit(BEST_GROUPS))
    first = rows.withColumn("_group", group).withColumn("_place", F.row_number().over(
        Window.partitionBy("lang", "_group").orderBy(*order))).where(F.col("_place") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
