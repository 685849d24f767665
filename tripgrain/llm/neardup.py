"""Near duplicates: b-bit MinHash signatures, band candidates, links confirmed on full shingle sets.

1. Every text gives its shingle set; of the set only its size, a digest, the band keys of its minima and
   the low bits of the minima, packed, are stored. Equal sets become one class, stood for by its
   smallest doc_id, before anything is compared.
2. Members of a band bucket meet the bucket's smallest id first (a star, not all pairs). The packed
   signatures give a collision-corrected similarity by bit counts; what may reach the threshold is
   confirmed on the full sets.
3. After the first components are known, only pairs of one bucket that lie in different components
   are left. Inside blocks of a bucket they are estimated, confirmed on the full sets, and a spanning
   forest of the links comes out: no link between components is skipped, no pair leaves its block.

Groups to confirm are cut into pieces by shingles, so a document that thousands resemble is many tasks.
With 32 bands of 4 rows a link of similarity 0.75 is missed with probability 5e-6, and the estimate
rejects one with probability 2e-5; both fall steeply above 0.75.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.words import gram_hashes, mix, split_words, text_slices, word_hashes
from tripgrain.session import freeze

SHINGLE = 5
BANDS, ROWS, LOW_BITS = 32, 4, 4
#: Minima in the packed signature; the bands use the first ones.
HASHES = 512
#: Similarity in percent at which two sets are linked.
THRESHOLD = 75
#: An estimate may lie so much below the similarity: over four standard deviations.
MARGIN = 0.085
#: Members of a bucket that are compared with each other in one task, about.
BLOCK = 1024
#: Shingles of such members, about.
BLOCK_SHINGLES = 1_000_000
#: Rounds of stars before the pairs that are left.
STARS = 2
#: Shingles of the members confirmed in one task.
PIECE_SHINGLES = 400_000

_random = np.random.default_rng(97)
_A = _random.integers(0, 2**64, HASHES, dtype=np.uint64) | np.uint64(1)
_B = _random.integers(0, 2**64, HASHES, dtype=np.uint64)
_BAND = _random.integers(0, 2**64, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer than ``k`` words are one shingle, none is empty."""
    out = []
    for _, some in text_slices(texts):
        words = split_words(some, lower=True)
        hashes, counts = word_hashes(words), np.diff(words.first)
        at, grams = gram_hashes(hashes, words.first, k)
        ends = np.searchsorted(at, words.first)
        short = {n: gram_hashes(hashes, words.first, n) for n in range(1, k) if (counts == n).any()}
        for i, n in enumerate(counts):
            if n >= k:
                out.append(np.unique(grams[ends[i] : ends[i + 1]]))
            elif n:
                place = np.searchsorted(short[n][0], words.first[i])
                out.append(mix(short[n][1][place : place + 1] + np.uint64(n)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def minima(shingles: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, 2**64 - 1, np.uint64)
    for a in range(0, len(shingles), 512):
        least = np.minimum(least, (shingles[a : a + 512, None] * _A + _B).min(axis=0))
    return least


def _sign(batches):
    for batch in batches:
        columns: tuple[list, ...] = ([], [], [], [])
        for found in shingle_sets(batch.column("text")):
            low = minima(found)
            bands = mix((low[: BANDS * ROWS].reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
            nibbles = (low & np.uint64(15)).astype(np.uint8).reshape(-1, 2)
            packed = (nibbles[:, 0] | (nibbles[:, 1] << 4)).view(np.int64)
            columns[0].append(len(found))
            columns[1].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            columns[2].append(packed)
            columns[3].append(bands.view(np.int64))
        flat = lambda rows, n: pa.ListArray.from_arrays(
            pa.array(np.arange(len(rows) + 1, dtype=np.int32) * n), pa.array(np.concatenate(rows or [np.zeros(0, np.int64)])))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()),
             flat(columns[2], HASHES // 16), flat(columns[3], BANDS)],
            ["doc_id", "n_shingles", "digest", "sig", "bands"])


def similarity(a: Column, b: Column) -> Column:
    """Estimate from two packed signatures: share of equal low bits, corrected for chance.

    A loop over the words, not one term per word, which the driver would copy with every step of planning.
    """
    def unequal(x: Column) -> Column:
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))

    words = F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))
    equal = 1 - F.aggregate(words, F.lit(0), lambda n, x: n + unequal(x)) / HASHES
    chance = 2.0**-LOW_BITS
    return (equal - chance) / (1 - chance)


def _linked(key, group: pa.Table) -> pa.Table:
    """Members of the group whose set reaches the threshold with a set of its centre."""
    sets = shingle_sets(group["text"])
    ids, centre = group["id"].to_pylist(), group["centre"].to_pylist()
    hubs = [s for s, c in zip(sets, centre) if c]
    linked = []
    for i, s, c in zip(ids, sets, centre):
        if c or not len(s):
            continue
        for h in hubs:
            both = len(np.intersect1d(s, h, assume_unique=True))
            if 100 * both >= THRESHOLD * (len(s) + len(h) - both):
                linked.append(i)
                break
    n = len(linked)
    return pa.table({"u": pa.array(linked, pa.int64()), "v": pa.array([key[0].as_py()] * n, pa.int64())})


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (u, v) among candidate pairs (a, b); ``texts`` has id, text, n_shingles."""
    size = texts.groupBy(F.col("id").alias("a")).agg(F.max("n_shingles").alias("n"))
    load = pairs.join(size, "a").groupBy("b").agg(F.ceil(F.sum("n") / PIECE_SHINGLES).alias("pieces"))
    dealt = pairs.join(load, "b").withColumn("piece", F.pmod(F.xxhash64("a"), "pieces"))
    centres = load.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    members = dealt.join(texts.select(F.col("id").alias("a"), "text"), "a").select(
        "b", "piece", F.col("a").alias("id"), "text", F.lit(False).alias("centre"))
    hubs = centres.join(texts.select(F.col("id").alias("b"), "text"), "b").select(
        "b", "piece", F.col("b").alias("id"), "text", F.lit(True).alias("centre"))
    return members.unionByName(hubs).groupBy("b", "piece").applyInArrow(
        lambda key, group: _linked(key, group), "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every vertex of ``links`` (u, v): the smallest id that can be reached.

    Alternating large-star and small-star steps, each an aggregation and a join; stored between rounds.
    """
    edges = freeze(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = freeze(small.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        state = now


def _pairs(band: int, group: pa.Table, inside: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Row numbers of likely pairs between the two blocks of a group, members of different parts only.

    One row comes with all its partners. A pair that shares several buckets comes in the first of them.
    """
    block, part, ids = (group[c].to_numpy() for c in ("block", "part", "id"))
    flat = lambda c: group[c].combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1)
    sig, bands = flat("sig"), flat("bands")
    left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    names, sizes = np.unique(part, return_counts=True)
    main = names[np.argmax(sizes)]
    for some, others in ((left[part[left] != main], right), (left[part[left] == main], right[part[right] != main])):
        for at in range(0, len(some) if len(others) else 0, 32):
            rows = some[at : at + 32]
            x = sig[rows, None, :] ^ sig[None, others, :]
            x |= (x >> 1) & 0x7777777777777777
            x |= (x >> 2) & 0x3333333333333333
            equal = 1 - np.bitwise_count(x & 0x1111111111111111).sum(axis=2, dtype=np.int64) / HASHES
            likely = (equal - 2.0**-LOW_BITS) / (1 - 2.0**-LOW_BITS) >= THRESHOLD / 100 - MARGIN
            likely &= part[rows][:, None] != part[others]
            if inside:
                likely &= ids[rows][:, None] > ids[others]
            for row, chosen in zip(rows, likely):
                met = others[chosen]
                met = met[bands[row][(bands[met] == bands[row]).argmax(axis=1)] == band]
                if len(met):
                    yield row, met


def _alone(group: pa.Table, one: int, two: int) -> bool:
    """One of the two blocks has no row here: nothing to compare."""
    return one != two and len(np.unique(group["block"].to_numpy())) < 2


def _block_members(key, group: pa.Table) -> pa.Table:
    """The members that a likely pair of the group has; the pairs themselves do not leave the task."""
    band, one, two = (k.as_py() for k in key)
    seen = np.zeros(group.num_rows, bool)
    if not _alone(group, one, two):
        for row, met in _pairs(band, group, one == two):
            seen[row] = True
            seen[met] = True
    return group.filter(pa.array(seen))


def _block_links(key, group: pa.Table) -> pa.Table:
    """A spanning forest of the links between parts in the group, confirmed on the full sets.

    A pair whose ends are connected by then is not looked at, and every link given out connects two
    parts that were apart, so there are fewer of them than members.
    """
    band, one, two = (k.as_py() for k in key)
    u: list[int] = []
    v: list[int] = []
    if not _alone(group, one, two):
        sets = shingle_sets(group["text"])
        size = np.array([len(s) for s in sets])
        start = np.concatenate([[0], np.cumsum(size)])
        names, words = np.unique(np.concatenate(sets), return_inverse=True)
        ids, part = group["id"].to_numpy(), group["part"].to_numpy().copy()
        mark = np.zeros(len(names), bool)
        for row, met in _pairs(band, group, one == two):
            own = words[start[row] : start[row + 1]]
            mark[own] = True
            met = met[size[met] > 0] if size[row] else met[:0]  # an id may have rows without words too
            for at in range(0, len(met), 256):
                some = met[at : at + 256]
                some = some[part[some] != part[row]]
                if not len(some):
                    continue
                both = np.add.reduceat(
                    mark[np.concatenate([words[start[m] : start[m + 1]] for m in some])],
                    np.concatenate([[0], np.cumsum(size[some])[:-1]]), dtype=np.int64)
                for m in some[100 * both >= THRESHOLD * (size[row] + size[some] - both)]:
                    if part[m] != part[row]:
                        u.append(int(ids[m]))
                        v.append(int(ids[row]))
                        part[part == part[m]] = part[row]
            mark[own] = False
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _across(divided: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (u, v) that join different parts of a bucket; large buckets are compared block by block.

    A block holds about ``BLOCK`` members and ``BLOCK_SHINGLES`` shingles. Signatures choose its members
    that may have a link, only their texts are sent to be confirmed, and at most one link per member comes out.
    """
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("mass") / BLOCK_SHINGLES)).cast("int")
    member = divided.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = member.select("band", "id", "part", "block", other.alias("_other")).select(
        "band", F.least("block", "_other").alias("one"), F.greatest("block", "_other").alias("two"), "block", "id", "part")
    signed = dealt.join(classes.select("id", "sig", "bands"), "id").select(
        "band", "one", "two", "block", "id", "part", "sig", "bands")
    columns = "band long, one int, two int, block int, id long, part long, sig array<long>, bands array<long>"
    chosen = signed.groupBy("band", "one", "two").applyInArrow(lambda key, group: _block_members(key, group), columns)
    return chosen.join(texts.select("id", "text"), "id").groupBy("band", "one", "two").applyInArrow(
        lambda key, group: _block_links(key, group), "u long, v long")


def _divided(weighed: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows (band, id, n, mass, weight, part) of buckets that hold more than one component."""
    member = weighed.join(joined, "id", "left").select("band", "id", "n", "mass", "weight", F.coalesce("component", "id").alias("part"))
    mixed = member.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    return freeze(member.join(mixed.select("band"), "band", "left_semi"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Words are lower-cased (A-Z). Documents without words (NULL, empty, only space) have no shingles, are
    linked with nothing and kept. Rows with words that share a doc_id are one vertex and share a component. A NULL
    doc_id joins no group: component_id NULL, kept. An empty table gives none; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = freeze(docs.mapInArrow(_sign, "doc_id long, n_shingles long, digest binary, sig array<long>, bands array<long>"))
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.any_value("sig").alias("sig"), F.any_value("bands").alias("bands"),
        F.any_value("n_shingles").alias("n_shingles"))
    classes = freeze(classes)
    banded = classes.select("id", "n_shingles", F.explode("bands").alias("band"))
    crowd = banded.groupBy("band").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("mass")).where("n > 1")
    shared = freeze(banded.drop("n_shingles").join(crowd, "band"))
    central = freeze(shared.groupBy("id").agg(F.sum("n").alias("weight")))
    met = central.select("id")
    texts = freeze(
        docs.join(met.withColumnRenamed("id", "doc_id"), "doc_id")
        .join(some.join(met.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
              .groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles")), "doc_id")
        .select(F.col("doc_id").alias("id"), "text", "n_shingles").distinct())
    signs = classes.select("id", "sig")

    def likely(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose estimate may reach the threshold, with it."""
        return (pairs.join(signs.select(F.col("id").alias("a"), F.col("sig").alias("_a")), "a")
                .join(signs.select(F.col("id").alias("b"), F.col("sig").alias("_b")), "b")
                .select("a", "b", similarity(F.col("_a"), F.col("_b")).alias("likely"))
                .where(F.col("likely") >= THRESHOLD / 100 - MARGIN))

    # stars around the member that shares most buckets with others; again where a bucket is still divided
    weighed = freeze(shared.join(central, "id").select("band", "id", "n", "mass", "weight"))
    joined, links, divided = None, None, weighed.withColumn("part", F.col("id"))
    for _ in range(STARS):
        hubs = divided.groupBy("band").agg(F.max_by(F.struct("id", "part"), F.struct("weight", -F.col("id"))).alias("hub"))
        pairs = divided.join(hubs, "band").where("part <> hub.part").select(
            F.col("id").alias("a"), F.col("hub.id").alias("b")).distinct()
        best = freeze(likely(pairs).groupBy("a").agg(F.max_by("b", F.struct("likely", -F.col("b"))).alias("b")))  # read three times
        found = _confirm(best, texts)
        links = freeze(found if links is None else links.union(found))
        joined = freeze(components(links))
        divided = _divided(weighed, joined)
    more = freeze(_across(divided, classes, texts))
    joined = components(links.union(more)) if more.limit(1).count() else joined

    grouped = some.select("digest").distinct().join(classes.select("digest", "id"), "digest").join(joined, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component_id"))
    found = signed.select("doc_id", "n_shingles", "digest").join(grouped, "digest", "left")
    own = F.when(F.col("doc_id").isNull(), None).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
