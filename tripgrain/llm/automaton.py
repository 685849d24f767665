"""Language-model scores by a weighted backoff automaton.

Tokens are words (A-Z lower-cased) and one end per text. The unigram model is exact and additive for
every word of the corpus. Of longer n-grams all stay that occur ``LEAST`` times in the training texts, at every
size of the corpus; as an n-gram is never more frequent than its parts, only n-grams of parts that stayed are counted.

Each n-gram that others extend is a state. An arc from a state carries the discounted log-probability of
a word; the failure arc leads to the state without the oldest word and carries the weight that makes
the probabilities of all words add up to one. All tokens of a chunk are scored at once, order by order: where
the state has the arc its weight counts, else the failure weight is added to what the state below gave.

1. Texts become chunks of local word numbers with the hashes of the chunk's words: one pass, without a shuffle,
   stored. No text is moved after it.
2. A chunk sends each distinct word once with its training count to the word's bucket; the sums go back to the
   chunk in the same order. Words that stay get numbers there, frequent ones small numbers.
3. Order by order, a chunk sends its states and its distinct n-grams whose parts stayed to the bucket of
   the state, and gets their counts and failure weights back. States are sent as differences in order of their
   keys, n-grams as the numbers of their last words. A state with more than ``HOT`` occurrences is
   spread over several buckets; the weights of these, at most training tokens / ``HOT``, are summed on the driver.
4. The chunk, with the counts and weights of all it holds, has its own part of the automaton and scores its texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.words import mix, split_words, text_bytes, text_slices, word_hashes
from tripgrain.session import freeze, remove, scratch_path

ORDER = 3
#: Occurrences of an n-gram that stays, at every size.
LEAST = 2
#: Share of all training tokens that an n-gram must also make up: none.
SHARE = 0.0
DISCOUNT = 0.5
CHUNK_BYTES = 8 << 20
#: Distinct words that one bucket holds, about, if each word of the corpus were new.
BUCKET_BYTES = 32 << 20
#: The same for longer n-grams.
GRAM_BUCKET_BYTES = 16 << 20
#: Occurrences above which the n-grams that extend a state are spread over buckets.
HOT = 1 << 20
#: The end of a text as a token.
END = np.uint64(0x5EED0E4D)
_HALF, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)
#: Packed bytes from which on they are compressed.
_COMPRESSED = 128
_ZSTD = pa.Codec("zstd", compression_level=3)
_CHUNK = pa.schema([
    ("_llm_chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())), ("sizes", pa.binary()),
    ("words", pa.int64()), ("place", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary()), ("part", pa.string()),
])
_CHUNK_DDL = "_llm_chunk long, doc_ids array<long>, train array<boolean>, sizes binary, words long, place binary, keys binary, counts binary, part string"
_WORDS = "bucket int, _llm_chunk long, n int, keys binary, counts binary"
_SENT = "bucket int, _llm_chunk long, states int, keys binary, known binary, below binary, sizes binary, n int, grams binary, counts binary, lower binary"
_BACK = "_llm_chunk long, bucket int, level int, n int, counts binary, numbers binary, weights binary, keys binary, held binary, under binary"


class Tokens(NamedTuple):
    hashes: np.ndarray
    first: np.ndarray  # per text its first token, and the number of tokens


def tokens(texts: pa.Array) -> Tokens:
    words = split_words(texts, lower=True)
    n = len(words.first) - 1
    first = words.first + np.arange(n + 1)
    out = np.full(first[-1], END, np.uint64)
    ends = np.zeros(len(out), bool)
    ends[first[1:] - 1] = True
    out[~ends] = word_hashes(words)
    return Tokens(out, first)


def all_tokens(texts) -> Tokens:
    parts = [tokens(t) for _, t in text_slices(texts)]
    if not parts:
        return Tokens(np.zeros(0, np.uint64), np.zeros(1, np.int64))
    starts = np.cumsum([0, *(len(p.hashes) for p in parts)])
    first = [p.first[:-1] + s for p, s in zip(parts, starts)]
    return Tokens(np.concatenate([p.hashes for p in parts]), np.concatenate([*first, starts[-1:]]))


def _buckets(keys: np.ndarray, n: int):
    """(bucket, from, to) of sorted hashes."""
    edges = np.searchsorted((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32), np.arange(n + 1, dtype=np.uint64))
    for b in range(n):
        if edges[b + 1] > edges[b]:
            yield b, int(edges[b]), int(edges[b + 1])


def _pack(values: np.ndarray) -> bytes:
    """Unsigned values in as few bytes each as hold the largest, first all lowest bytes; many are compressed."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    if len(planes) < _COMPRESSED:
        return bytes([width]) + planes
    return bytes([width + 8]) + _ZSTD.compress(planes, asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    """``n`` packed values."""
    out, width = np.zeros((n, 8), np.uint8), data[0]
    planes = data[1:]
    if width > 8:
        width -= 8
        planes = _ZSTD.decompress(planes, n * width, asbytes=True)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<i8")


def _pack_keys(keys: np.ndarray) -> bytes:
    """Keys in order: differences of the upper halves, and of the lower ones where the upper are the same."""
    high, low = keys >> _HALF, keys & _LOW
    new = np.diff(high, prepend=np.uint64(0))
    step = low.copy()
    step[1:] -= np.where(new[1:] == 0, low[:-1], np.uint64(0))
    first = _pack(new)
    return len(first).to_bytes(4, "little") + first + _pack(step)


def _unpack_keys(data: bytes, n: int) -> np.ndarray:
    size = int.from_bytes(data[:4], "little")
    new, step = _unpack(data[4 : 4 + size], n), _unpack(data[4 + size :], n)
    start = np.flatnonzero((new > 0) | (np.arange(n) == 0))
    sums = np.cumsum(step)
    low = sums - np.repeat(sums[start] - step[start], np.diff(np.r_[start, n]))
    return np.cumsum(new).astype(np.uint64) << _HALF | low.astype(np.uint64)


def _pack_weights(values: np.ndarray) -> bytes:
    """Numbers, NaN as a bit."""
    there = ~np.isnan(values)
    return np.packbits(there).tobytes() + _pack(values[there].astype("<f8").view("<u8"))


def _unpack_weights(data: bytes, n: int) -> np.ndarray:
    bits = -(-n // 8)
    there = np.unpackbits(np.frombuffer(data, np.uint8, bits), count=n).astype(bool)
    out = np.full(n, np.nan)
    out[there] = _unpack(data[bits:], int(there.sum())).view("<f8")
    return out


def _joined(state: np.ndarray, word: np.ndarray, order: int) -> np.ndarray:
    """Keys of n-grams from those of their states and the numbers of their last words: both numbers, or a hash."""
    return state << _HALF | word if order == 2 else mix(state * np.uint64(0x9FB21C651E98DF25) + word)


def _home(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(keys) >> _HALF) * np.uint64(buckets) >> _HALF).astype(np.int64)


def _stored(df: DataFrame) -> DataFrame:
    """``freeze``, and the shuffle files of the job go with its end, so that those of the orders do not add up."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        return freeze(df.select("*"))
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.table({name: pa.array(list(c), kinds[kind]) for c, (name, kind) in zip(columns, fields)})


class Chunk(NamedTuple):
    number: int
    first: np.ndarray  # per text its first token, and the number of tokens
    place: np.ndarray  # of each token, its word among the chunk's words
    words: int
    train: np.ndarray


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Texts in chunks of about ``chunk_bytes``: a row with the place of each token among the chunk's words, which are
    in order of their hashes, and one with these hashes and their training counts."""
    task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

    def stored() -> pa.RecordBatch:
        found = [all_tokens(texts) for _, texts in held]
        keys, place = np.unique(np.concatenate([f.hashes for f in found]), return_inverse=True)
        sizes = np.concatenate([np.diff(f.first) for f in found])
        rows = pa.Table.from_batches([part for part, _ in held]).combine_chunks()
        train = rows["train"].to_numpy()
        counts = np.bincount(place[np.repeat(train, sizes)], minlength=len(keys))
        chunk = (task << 32) + number
        two = [
            (chunk, rows["doc_id"].cast(pa.int64()).to_pylist(), train, _pack(sizes), len(keys), _pack(place), None, None, "texts"),
            (chunk, None, None, None, len(keys), None, keys.tobytes(), _pack(counts), "words"),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*two), _CHUNK)], schema=_CHUNK)

    for batch in batches:
        for start, texts in text_slices(batch["text"], chunk_bytes):
            part, more = batch.select(["doc_id", "train"]).slice(start, len(texts)), pc.sum(pc.binary_length(texts)).as_py()
            if held and size + more > chunk_bytes:
                yield stored()
                number, held, size = number + 1, [], 0
            held.append((part, texts))
            size += more
    if held:
        yield stored()


def _read(chunk: pa.Table) -> Chunk:
    train = chunk["train"][0].values.to_numpy(zero_copy_only=False).astype(bool)
    first = np.r_[0, np.cumsum(_unpack(chunk["sizes"][0].as_py(), len(train)))]
    place = _unpack(chunk["place"][0].as_py(), int(first[-1]))
    return Chunk(chunk["_llm_chunk"][0].as_py(), first, place, chunk["words"][0].as_py(), train)


def _send(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, keys, counts in zip(*(batch[c].to_pylist() for c in ("_llm_chunk", "keys", "counts"))):
            keys = np.frombuffer(keys, np.uint64)
            counts = _unpack(counts, len(keys))
            rows = [(b, number, y - x, keys[x:y].tobytes(), _pack(counts[x:y])) for b, x, y in _buckets(keys, buckets)]
            yield from _table(rows, _WORDS).to_batches()


def _sum(bucket: pa.Table, buckets: int) -> pa.Table:
    """Counts over all chunks and numbers of words that may stay, back to each chunk; a row without chunk has the bucket's training tokens and known words."""
    sizes = bucket["n"].to_pylist()
    names, place = np.unique(np.concatenate([np.frombuffer(b, np.uint64) for b in bucket["keys"].to_pylist()]), return_inverse=True)
    counts = np.concatenate([_unpack(b, n) for b, n in zip(bucket["counts"].to_pylist(), sizes)])
    total = np.bincount(place, counts, len(names)).astype(np.int64)
    number = bucket["bucket"][0].as_py()
    order = np.argsort(-total, kind="stable")[: int((total >= LEAST).sum())]
    numbers = np.zeros(len(names), np.int64)
    numbers[order] = (np.arange(len(order)) + 1) * buckets + number
    if len(order) and numbers[order[-1]] >= 1 << 32:
        raise OverflowError("more words than numbers")
    rows, x = [], 0
    for c, n in zip(bucket["_llm_chunk"].to_pylist(), sizes):
        mine, x = place[x : x + n], x + n
        rows.append((c, number, 1, n, _pack(total[mine]), _pack(numbers[mine]), None, None, None, None))
    rows.append((None, number, 1, 0, np.array([total.sum(), (total > 0).sum()], "<i8").tobytes(), None, None, None, None, None))
    return _table(rows, _BACK)


class Level(NamedTuple):
    """N-grams of one order in a chunk: ``at`` has each token's n-gram or -1, ``state`` the state before it or -1."""

    at: np.ndarray
    keys: np.ndarray
    counts: np.ndarray  # in all training texts; 0 of n-grams that did not stay
    state: np.ndarray
    weights: np.ndarray  # failure weight of each n-gram of the order below as a state, NaN where none extends it


class Asked(NamedTuple):
    """What a chunk asks about one order: n-grams, and states in buckets; both in the order of their buckets."""

    at: np.ndarray  # each token's n-gram or -1
    state: np.ndarray  # each token's state, an n-gram of the order below, or -1
    keys: np.ndarray
    last: np.ndarray  # number of each n-gram's last word
    entry: np.ndarray  # of each n-gram, its state and bucket
    lower: np.ndarray  # of each n-gram, the one without its first word
    states: np.ndarray  # of each entry, its state; in a bucket in order of their keys
    bucket: np.ndarray  # of each entry


def _ask(chunk: Chunk, words: Level, below: Level, order: int, least: float, buckets: int, hot: int) -> Asked:
    inside = np.ones(len(below.at), bool)
    inside[chunk.first[:-1]] = False  # the first token of a text extends nothing
    before = np.r_[-1, below.at[:-1]]
    stays = np.r_[below.counts >= least, False]  # place -1 is none
    state = np.where(inside & stays[before], before, -1)
    ok = (state >= 0) & stays[below.at]
    codes, place = np.unique(state[ok] * len(words.keys) + words.at[ok], return_inverse=True)
    mine = codes // max(1, len(words.keys))
    last = words.keys[codes % max(1, len(words.keys))]
    keys = _joined(below.keys[mine], last, order)
    lower = np.empty(len(codes), np.int64)
    lower[place] = below.at[ok]
    used = np.zeros(len(below.keys), bool)
    used[state[state >= 0]] = True
    used = np.flatnonzero(used)
    used = used[np.argsort(below.keys[used])]
    rank = np.empty(len(below.keys), np.int64)
    rank[used] = np.arange(len(used))
    home, mine = _home(below.keys[used], buckets), rank[mine]
    spread = below.counts[used] // hot + 1
    bucket = home[mine]
    wide = np.flatnonzero(spread[mine] > 1)
    bucket[wide] = (bucket[wide] + (mix(keys[wide]) % spread[mine[wide]].astype(np.uint64)).astype(np.int64)) % buckets
    # every state once in its home, also if nothing here extends it, and wherever else its n-grams are
    entries = home * len(used) + np.arange(len(used))
    if len(wide):
        entries = np.r_[entries, bucket[wide] * len(used) + mine[wide]]
    pairs, at = np.unique(entries, return_inverse=True)
    entry = at[mine]
    if len(wide):
        entry[wide] = at[len(used) :]
    placed = np.argsort(entry * len(entry) + np.arange(len(entry)))
    back = np.empty(len(placed), np.int64)
    back[placed] = np.arange(len(placed))
    out = np.full(len(state), -1)
    out[ok] = back[place]
    return Asked(out, state, keys[placed], last[placed], entry[placed], lower[placed], used[pairs % max(1, len(used))], pairs // max(1, len(used)))


def _levels(chunk: pa.Table, back: pa.Table, order: int, least: float, buckets: int, hot: int, weights: list[dict]):
    """(chunk, levels of the orders that ``back`` knows, what is asked of the next one up to ``order``)."""
    mine = _read(chunk)
    known: dict[int, list] = {}
    for level, *row in zip(*(back[c].to_pylist() for c in ("level", "bucket", "n", "counts", "numbers", "weights"))):
        known.setdefault(level, []).append(row)
    first = sorted(known.get(1, []), key=lambda r: r[0])
    counts = np.concatenate([np.zeros(0, np.int64), *(_unpack(c, n) for _, n, c, _, _ in first)])
    keys = np.concatenate([np.zeros(0, np.int64), *(_unpack(x, n) for _, n, _, x, _ in first)]).astype(np.uint64)
    levels = [Level(mine.place, keys, counts, np.full(len(mine.place), -1), np.zeros(0))]
    for k in range(2, order + 1):
        below = levels[-1]
        asked = _ask(mine, levels[0], below, k, least, buckets, hot)
        if k - 2 >= len(weights):
            return mine, levels, asked
        each = np.bincount(asked.bucket[asked.entry], minlength=buckets)
        of = {b: (n, c, w) for b, n, c, _, w in known.get(k, [])}
        at = np.unique(asked.bucket).tolist()
        counts = np.concatenate([np.zeros(0, np.int64), *(_unpack(of[b][1], int(each[b])) for b in at)])
        got = np.concatenate([np.zeros(0), *(_unpack_weights(of[b][2], of[b][0]) for b in at)])
        failure = np.full(len(below.keys), np.nan)
        failure[asked.states] = got
        wide = np.unique(asked.states[below.counts[asked.states] >= hot])
        failure[wide] = [weights[k - 2].get(key, np.nan) for key in below.keys[wide].tolist()]
        levels.append(Level(asked.at, asked.keys, counts, asked.state, failure))
    return mine, levels, None


def _send_grams(chunk: pa.Table, back: pa.Table, order: int, least: float, buckets: int, hot: int, weights: list[dict]) -> pa.Table:
    mine, levels, asked = _levels(chunk, back, order, least, buckets, hot, weights)
    below = levels[-1]
    train = np.repeat(mine.train, np.diff(mine.first)) & (asked.at >= 0)
    counts = np.bincount(asked.at[train], minlength=len(asked.keys))
    sizes = np.bincount(asked.entry, minlength=len(asked.states))
    under = np.zeros(len(below.keys), np.int64)  # occurrences of each state without its first word
    if len(levels) > 1:
        some = below.at >= 0
        under[below.at[some]] = levels[-2].counts[levels[-2].at[some]]
    lower, ends = below.counts[asked.lower], np.r_[0, np.cumsum(sizes)]
    edges = np.searchsorted(asked.bucket, np.arange(buckets + 1))
    rows = []
    for b in np.unique(asked.bucket).tolist():
        x, y = int(edges[b]), int(edges[b + 1])
        states, g, h = asked.states[x:y], int(ends[x]), int(ends[y])
        rows.append((b, mine.number, y - x, _pack_keys(below.keys[states]), _pack(below.counts[states]), _pack(under[states]),
                     _pack(sizes[x:y]), h - g, _pack(asked.last[g:h]), _pack(counts[g:h]), _pack(lower[g:h])))
    return _table(rows, _SENT)


def _sum_grams(bucket: pa.Table, order: int, least: float, hot: int, n: int, v: int) -> pa.Table:
    """Counts and failure weights back to each chunk; a row without chunk has this bucket's part of the states that are spread."""
    some, most = bucket["states"].to_pylist(), bucket["n"].to_pylist()

    def all_of(column: str, sizes: list[int], read=_unpack) -> np.ndarray:
        return np.concatenate([read(b, n) for b, n in zip(bucket[column].to_pylist(), sizes)])

    def each(place: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
        """The value of each of ``n`` things; wherever a thing is, it has the same."""
        out = np.empty(n, np.int64)
        out[place] = values
        return out

    states, at = np.unique(all_of("keys", some, _unpack_keys), return_inverse=True)
    count, under = each(at, len(states), all_of("known", some)), each(at, len(states), all_of("below", some))
    of = np.repeat(at, all_of("sizes", some))
    words = all_of("grams", most).astype(np.uint64)
    names, place = np.unique(_joined(states[of], words, order), return_inverse=True)
    total = np.bincount(place, all_of("counts", most), len(names)).astype(np.int64)
    total[total < least] = 0
    state = each(place, len(names), of)
    lower = each(place, len(names), all_of("lower", most))
    below = (lower + 0.5) / (n + 0.5 * (v + 1)) if order == 2 else (lower - DISCOUNT) / np.maximum(under[state], 1)
    stays = total > 0
    held = np.bincount(state[stays], (total[stays] - DISCOUNT) / count[state[stays]], len(states))
    left = np.bincount(state[stays], below[stays], len(states))
    extended = np.bincount(state[stays], minlength=len(states)) > 0
    failure = np.where(extended, _failure(held, left), np.nan)
    number, rows = bucket["bucket"][0].as_py(), []
    x = y = 0
    for chunk, k, g in zip(bucket["_llm_chunk"].to_pylist(), some, most):
        rows.append((chunk, number, order, k, _pack(total[place[y : y + g]]), None, _pack_weights(failure[at[x : x + k]]), None, None, None))
        x, y = x + k, y + g
    wide = extended & (count >= hot)
    if wide.any():
        rows.append((None, number, order, 0, None, None, None, states[wide].tobytes(), held[wide].tobytes(), left[wide].tobytes()))
    return _table(rows, _BACK)


def _failure(held, below):
    return np.log10((1 - held) / np.maximum(1 - below, 1e-12))


def _spread_weights(sums: DataFrame) -> dict[int, float]:
    """Failure weights of the states that are spread over buckets."""
    parts: dict[int, list[float]] = {}
    for r in sorted(sums.where("_llm_chunk IS NULL").collect(), key=lambda r: r.bucket):
        columns = (np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["held"]), np.frombuffer(r["under"]))
        for key, held, below in zip(*(c.tolist() for c in columns)):
            have = parts.setdefault(key, [0.0, 0.0])
            have[0], have[1] = have[0] + held, have[1] + below
    return {key: float(_failure(*have)) for key, have in parts.items()}


def _score(chunk: pa.Table, back: pa.Table, order: int, least: float, buckets: int, hot: int, weights: list[dict], n: int, v: int) -> pa.Table:
    mine, levels, _ = _levels(chunk, back, order, least, buckets, hot, weights)
    counts, place = levels[0].counts, levels[0].at
    alone = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))[place]
    value = alone.copy()
    for below, level in zip(levels, levels[1:]):
        failure = np.r_[level.weights, np.nan][level.state]
        isstate = ~np.isnan(failure)
        total = np.r_[level.counts, 0][level.at]
        arc = isstate & (total > 0)
        value = np.where(isstate, value + failure, value)
        value[arc] = np.log10((total[arc] - DISCOUNT) / below.counts[level.state[arc]])
    base, score, known = (np.add.reduceat(x, mine.first[:-1]) for x in (alone, value, (counts > 0)[place].astype(np.int64)))
    return pa.table({
        "doc_id": chunk["doc_ids"][0].values, "train": chunk["train"][0].values, "n_tokens": pa.array(np.diff(mine.first), pa.int64()),
        "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array([n] * len(base), pa.int64()),
        "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64())})


def score_texts(docs: DataFrame, train: Column, order: int = ORDER, share: float = SHARE, chunk_bytes: int = CHUNK_BYTES,
                gram_bucket_bytes: int = GRAM_BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """Scores of ``docs`` (doc_id, text): doc_id, train, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` says which rows the model learns from. One row per row; NULL and empty texts are the end token
    alone. Rows that share a doc_id or have none are texts of their own. Other columns are ignored. Without
    training rows every token has the same probability; an empty table gives none.
    """
    total = text_bytes(docs)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    buckets, wide = max(1, -(-total // BUCKET_BYTES)), max(1, -(-total // gram_bucket_bytes))
    spark, folder = docs.sparkSession, scratch_path(docs.sparkSession, "chunks")
    rows.mapInArrow(lambda batches: _chunks(batches, chunk_bytes), _CHUNK_DDL).write.partitionBy("part").parquet(folder)
    every = spark.read.schema(_CHUNK_DDL).parquet(folder)
    words = every.where("part = 'words'").select("_llm_chunk", "keys", "counts")
    sums = _stored(words.mapInArrow(lambda batches: _send(batches, buckets), _WORDS).groupBy("bucket").applyInArrow(
        lambda bucket: _sum(bucket, buckets), _BACK))
    remove(spark, f"{folder}/part=words")
    chunks = every.where("part = 'texts'").select("_llm_chunk", "doc_ids", "train", "sizes", "words", "place")
    asking = chunks.drop("doc_ids").groupBy("_llm_chunk")
    found = [np.frombuffer(r["counts"], "<i8").tolist() for r in sums.where("_llm_chunk IS NULL").select("counts").collect()]
    n, v = sum(a for a, _ in found), sum(b for _, b in found)
    least, weights = max(LEAST, share * n), []
    back = sums.where("_llm_chunk IS NOT NULL").select("_llm_chunk", "bucket", "level", "n", "counts", "numbers", "weights")

    def sender(k: int, have: list[dict]):
        return lambda chunk, mine: _send_grams(chunk, mine, k, least, wide, hot, have)

    def summer(k: int):
        return lambda bucket: _sum_grams(bucket, k, least, hot, n, v)

    for k in range(2, order + 1):
        sent = asking.cogroup(back.groupBy("_llm_chunk")).applyInArrow(sender(k, list(weights)), _SENT)
        sums = _stored(sent.groupBy("bucket").applyInArrow(summer(k), _BACK))
        weights.append(_spread_weights(sums))
        back = back.unionByName(sums.where("_llm_chunk IS NOT NULL").select("_llm_chunk", "bucket", "level", "n", "counts", "numbers", "weights"))
    return chunks.groupBy("_llm_chunk").cogroup(back.groupBy("_llm_chunk")).applyInArrow(
        lambda chunk, mine: _score(chunk, mine, order, least, wide, hot, weights, n, v),
        "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
