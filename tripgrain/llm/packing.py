"""Packing documents into sequences of fixed length by a grouping genetic algorithm.

Documents become token ids plus an end id; only those longer than a sequence are cut, the first piece
taking what is left over. Pieces are dealt by hash into shards of about ``SHARD_PIECES``. Each shard is
packed by several islands, each a population of whole packings in one group of rows:

* a child takes the best-filled bins of one parent whole, then those bins of the other that
  share no piece with them, and best-fits the displaced pieces, largest first;
* the worse half of an island gives way to children, every generation, until ``STALL`` generations bring
  no better packing, ``GENERATIONS`` are over, or no fewer sequences could hold the tokens;
* after each epoch the best packing of an island is copied to the next island of its shard, as rows.

A packing is a row (one bin number per piece), so an epoch is a grouping and no state stays in a worker.
Fitness is the number of sequences, then the mean squared fill. Shards differ only by their last
bin or so, which is one sequence in some thousands.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.tokens import encoder
from tripgrain.session import freeze

LENGTH = 2048
END = 0
SHARD_PIECES = 8192
ISLANDS, PEOPLE, EPOCHS, GENERATIONS, STALL = 2, 4, 2, 24, 6
#: Tasks that islands are dealt to, at most.
ISLAND_TASKS = 4096
#: Share of the first parent's bins that a child takes, best-filled first.
INJECT = 0.6
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, spot long"


def token_pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, markers: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, spot) per piece; ``spot`` tells rows apart for dealing."""
    def cut(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        encode = encoder(path, word_level=False, markers=markers).encode
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            rows = []
            texts = batch.column("text").to_pylist()
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                ids += tail
                n = len(ids) // 4
                first = (n - 1) % length + 1
                edges = [0, *range(first, n + 1, length)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    crc = zlib.crc32(ids[4 * a : 4 * b])
                    rows.append((doc, k, a, b - a, crc, part << 40 | number))
                    number += 1
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "spot"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, _PIECES)


def best_fit(sizes: np.ndarray, pieces, bins: list[list[int]], room: list[int], length: int) -> None:
    """Put ``pieces`` into the fullest bin they fit in, opening bins as needed; ``bins`` and ``room`` grow."""
    free = sorted((r, b) for b, r in enumerate(room) if r > 0)
    for p in pieces:
        size = int(sizes[p])
        at = bisect_left(free, (size, -1))
        if at < len(free):
            left, b = free.pop(at)
            bins[b].append(p)
        else:
            b, left = len(bins), length
            bins.append([p])
            room.append(length)
        room[b] = left - size
        if room[b]:
            insort(free, (room[b], b))


def packed(sizes: np.ndarray, order, length: int) -> np.ndarray:
    bins: list[list[int]] = []
    best_fit(sizes, order, bins, [], length)
    return _numbers(bins, len(sizes))


def _numbers(bins: list[list[int]], n: int) -> np.ndarray:
    out = np.empty(n, np.int32)
    for b, pieces in enumerate(bins):
        out[pieces] = b
    return out


def fitness(sizes: np.ndarray, bins: np.ndarray, length: int) -> tuple[int, float]:
    """Smaller is better: sequences, then minus the mean squared fill."""
    fill = np.bincount(bins, sizes) / length if len(bins) else np.zeros(0)
    return len(fill), -float((fill**2).mean()) if len(fill) else 0.0


def crossover(sizes: np.ndarray, one: np.ndarray, two: np.ndarray, length: int, rng) -> np.ndarray:
    """A child of two packings."""
    fill = np.bincount(one, sizes)
    ranked = np.argsort(-(fill + rng.random(len(fill))), kind="stable")
    taken = np.zeros(len(fill), bool)
    taken[ranked[: max(1, int(len(fill) * INJECT * rng.uniform(0.7, 1.3)))]] = True
    inside = taken[one]
    # bins of the other parent that hold a piece already taken are broken up
    broken = np.zeros(int(two.max()) + 1, bool)
    broken[two[inside]] = True
    number = np.full(len(one), -1, np.int64)
    number[inside] = one[inside]
    whole = ~broken[two] & ~inside
    number[whole] = two[whole] + len(fill)
    kept = number >= 0
    names, number[kept] = np.unique(number[kept], return_inverse=True)
    room = (length - np.bincount(number[kept], sizes[kept], len(names))).astype(int).tolist()
    loose = np.flatnonzero(~kept)
    loose = loose[np.argsort(-(sizes[loose] * rng.uniform(0.9, 1.1, len(loose))), kind="stable")]
    child: list[list[int]] = [[] for _ in names]
    best_fit(sizes, loose.tolist(), child, room, length)
    for b, pieces in enumerate(child):
        number[pieces] = b
    return number.astype(np.int32)


def _sizes(group: pa.Table) -> np.ndarray:
    return np.frombuffer(group["sizes"][0].as_py(), np.int32).astype(np.int64)


def _people(shard, island, blob, packings) -> pa.Table:
    return pa.table({"shard": pa.array([shard] * len(packings), pa.int64()), "island": pa.array([island] * len(packings), pa.int32()),
                     "sizes": pa.array([blob] * len(packings), pa.binary()),
                     "bins": pa.array([p.astype(np.int32).tobytes() for p in packings], pa.binary())})


def _settle(key, group: pa.Table, length: int) -> pa.Table:
    """A first population: best fit in falling order of size, disturbed differently for each."""
    shard, island = (k.as_py() for k in key)
    sizes, rng = _sizes(group), np.random.default_rng([abs(shard), island, 1])
    noise = [0.0 if island == 0 and i == 0 else 0.04 * (1 + i) for i in range(PEOPLE)]
    orders = [np.argsort(-(sizes * rng.uniform(1 - x, 1 + x, len(sizes))), kind="stable") for x in noise]
    return _people(shard, island, group["sizes"][0].as_py(), [packed(sizes, o.tolist(), length) for o in orders])


def _epoch(key, group: pa.Table, length: int, epoch: int) -> pa.Table:
    """Some generations on one island."""
    shard, island = (k.as_py() for k in key)
    sizes, rng = _sizes(group), np.random.default_rng([abs(shard), island, 2 + epoch])
    people = [np.frombuffer(b, np.int32) for b in sorted(group["bins"].to_pylist())]
    return _people(shard, island, group["sizes"][0].as_py(), evolve(sizes, people, length, rng))


def evolve(sizes: np.ndarray, people: list[np.ndarray], length: int, rng) -> list[np.ndarray]:
    """The best ``PEOPLE`` packings after some generations, best first."""
    def rank(p):
        return fitness(sizes, p, length)

    people = sorted(people, key=rank)[:PEOPLE]
    least = -(-int(sizes.sum()) // length)
    best, since = rank(people[0]), 0
    for _ in range(GENERATIONS if len(people) > 1 else 0):
        if best[0] <= least or since == STALL:
            break
        for _ in range(max(1, PEOPLE // 2)):
            a, b = rng.permutation(PEOPLE if len(people) > PEOPLE else len(people))[:2]
            people.append(crossover(sizes, people[a], people[b], length, rng))
        people = sorted(people, key=rank)[:PEOPLE]
        since = 0 if rank(people[0]) < best else since + 1
        best = min(best, rank(people[0]))
    return people


def _generations(length: int, epoch: int):
    return lambda key, group: _epoch(key, group, length, epoch)


def _elite(people: DataFrame, length: int) -> DataFrame:
    """People and, on the next island, a copy of each island's best one."""
    def spread(batches):
        for batch in batches:
            best: dict = {}
            rows = batch.to_pylist()
            for r in rows:
                key = fitness(np.frombuffer(r["sizes"], np.int32), np.frombuffer(r["bins"], np.int32), length)
                at = (r["shard"], r["island"])
                if at not in best or key < best[at][0]:
                    best[at] = (key, r)
            rows += [r | {"island": (r["island"] + 1) % ISLANDS} for _, r in best.values()]
            yield pa.RecordBatch.from_pylist(rows, batch.schema)

    return people.mapInArrow(spread, people.schema)


def _assign(shard: pa.Table, people: pa.Table, length: int) -> pa.Table:
    """The pieces of a shard with their places in its best packing."""
    order = _order(shard)
    shard = shard.take(pa.array(order))
    sizes = shard["length"].to_numpy()
    number = np.arange(len(sizes), dtype=np.int64)  # full pieces: a sequence each
    small = np.flatnonzero(sizes < length)
    base = int(shard["shard"][0].as_py()) << 32
    if len(small):
        best = min((np.frombuffer(b, np.int32) for b in people["bins"].to_pylist()),
                   key=lambda p: (fitness(sizes[small], p, length), p.tobytes()))
        number[small] = best + len(sizes)
    sort = np.argsort(number, kind="stable")
    ends = np.cumsum(sizes[sort])
    new = np.ones(len(sort), bool)
    new[1:] = np.diff(number[sort]) != 0
    begin = np.maximum.accumulate(np.where(new, ends - sizes[sort], 0))
    offset = np.empty(len(sort), np.int64)
    offset[sort] = ends - sizes[sort] - begin
    return pa.table({c: shard[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
                    | {"sequence_id": pa.array(number + base), "offset": pa.array(offset)})


def _order(shard: pa.Table) -> np.ndarray:
    """Pieces of a shard in an order that does not depend on how rows arrived."""
    ids = shard["doc_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
    return np.lexsort((shard["ids_crc32"].to_numpy(), shard["piece"].to_numpy(), ids, shard["length"].to_numpy()))


def _gather(key, group: pa.Table, length: int) -> pa.Table:
    """The sizes below a whole sequence of one shard, once per island."""
    sizes = group["length"].to_numpy()[_order(group)]
    blob = sizes[sizes < length].astype(np.int32).tobytes()
    shard = key[0].as_py()
    return pa.table({"shard": pa.array([shard] * ISLANDS, pa.int64()), "island": pa.array(range(ISLANDS), pa.int32()),
                     "sizes": pa.array([blob] * ISLANDS, pa.binary())})


def pack(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, shard_pieces: int = SHARD_PIECES,
         markers: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) packed: doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece.

    NULL and empty texts are the end id alone. Every row is a document of its own, also where rows share a
    doc_id or it is NULL (the result then has several pieces of one name, each in its own place). With ``markers``
    special tokens that stand in a text have their own ids. Other columns are ignored; an empty table gives none.
    """
    pieces = freeze(token_pieces(docs, path, length, end, markers))
    shards = max(1, -(-pieces.count() // shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("spot"), F.lit(shards))).drop("spot")
    people = dealt.groupBy("shard").applyInArrow(
        lambda key, group: _gather(key, group, length), "shard long, island int, sizes binary")
    schema = "shard long, island int, sizes binary, bins binary"
    # few bytes and much work: by number, since sizes would put all islands into one task
    tasks = min(shards * ISLANDS, ISLAND_TASKS)

    def islands(rows):
        return rows.repartition(tasks, "shard", "island").groupBy("shard", "island")

    people = freeze(islands(people).applyInArrow(lambda key, group: _settle(key, group, length), schema))
    for epoch in range(EPOCHS):
        moved = _elite(people, length) if epoch else people
        people = freeze(islands(moved).applyInArrow(_generations(length, epoch), schema))
    return dealt.groupBy("shard").cogroup(people.groupBy("shard")).applyInArrow(
        lambda shard, people: _assign(shard, people, length),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
