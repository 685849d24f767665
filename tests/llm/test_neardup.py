from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripgrain.llm import neardup


def sets(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    s = [(d, sets(t)) for d, t in docs]
    parent = {d: d for d, _ in docs if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(s):
        for b, y in s[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted([(d, len(x), None if d is None else root(d), d is None or root(d) == d) for d, x in s], key=repr)


def run(rows, docs):
    df = rows(docs, "doc_id long, text string").selectExpr("*", "1 AS digest", "2 AS id")
    return sorted([tuple(r) for r in neardup.near_duplicates(df).collect()], key=repr)


def test_edge_cases(rows):
    docs = [(9, "A b c"), (4, "a B c"), (7, "a b"), (1, None), (2, ""), (3, " \n"), (None, "a b c"), (None, None),
            (12, "one two three four five"), (12, "one two three four five"), (11, "one two three four five"), (20, "y" * 100_000)]
    assert run(rows, docs) == brute(docs)


def test_empty_table(rows):
    assert run(rows, []) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_variants_equal_brute_force(rows, monkeypatch, seed):
    monkeypatch.setattr(neardup, "PIECE_SHINGLES", 700)
    r = random.Random(seed)
    docs, n = [], 0
    for _ in range(12):
        base = [f"w{r.randrange(10_000)}" for _ in range(r.choice([8, 60, 200]))]
        for _ in range(r.choice([1, 5, 25])):
            w = list(base)
            for _ in range(r.randrange(0, max(2, len(w) // 25))):
                w[r.randrange(len(w))] = f"v{r.randrange(10_000)}"
            docs.append((n * 7 % 10_007, " ".join(w)))
            n += 1
    assert run(rows, docs) == brute(docs)


def test_chain_is_one_component(rows):
    links = rows([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100)], "u long, v long")
    found = {r.id: r.component for r in neardup.components(links).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def near_copies(n, seed=5):
    """Texts that differ from one base in some words: some pairs are links, others fall short, one component."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randrange(1, 4)):
            w[r.randrange(len(w))] = f"v{r.randrange(10_000)}"
        docs.append((i, " ".join(w)))
    return docs


def signed(rows, docs):
    df = rows(docs, "doc_id long, text string")
    found = df.mapInArrow(neardup._sign, "doc_id long, n_shingles long, digest binary, sig array<long>, bands array<long>")
    return df.selectExpr("doc_id AS id", "text"), found.withColumnRenamed("doc_id", "id")


@pytest.mark.parametrize("block", [1024, 64])
def test_blocks_give_out_fewer_links_than_members(rows, monkeypatch, block):
    """Every text its own part, as if no star had met: the blocks' forests hold all components."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    docs = near_copies(400)
    texts, classes = signed(rows, docs)
    banded = classes.selectExpr("id", "n_shingles", "explode(bands) AS band")
    crowd = banded.groupBy("band").agg(F.count("id").alias("n"), F.sum("n_shingles").alias("mass")).where("n > 1")
    divided = banded.drop("n_shingles").join(crowd, "band").withColumn("part", F.col("id"))
    links = neardup._across(divided, classes, texts)
    found = [(r.u, r.v) for r in links.collect()]
    blocks = -(-400 // block)
    assert len(found) < neardup.BANDS * 400 * blocks
    s = dict((d, sets(t)) for d, t in docs)
    assert all(100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b]) for a, b in found)
    joined = {r.id: r.component for r in neardup.components(rows(found, "u long, v long")).collect()}
    assert [joined.get(d, d) for d, _ in docs] == [r[2] for r in brute(docs)]


def test_one_block_gives_a_forest():
    """In one bucket each link joins two parts that were apart."""
    docs = near_copies(300)
    batch = pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in docs], "text": [t for _, t in docs]})
    signed = next(neardup._sign([batch]))
    band = signed["bands"][0][0].as_py()
    keep = [i for i in range(300) if signed["bands"][i][0].as_py() == band]
    group = pa.table({
        "block": pa.array([0] * len(keep), pa.int32()), "id": pa.array(keep, pa.int64()), "part": pa.array(keep, pa.int64()),
        "sig": signed["sig"].take(pa.array(keep)), "bands": signed["bands"].take(pa.array(keep)),
        "text": pa.array([docs[i][1] for i in keep])})
    key = [pa.scalar(band), pa.scalar(0), pa.scalar(0)]
    assert len(keep) > 100 and neardup._block_members(key, group).num_rows == len(keep)
    assert neardup._block_links(key, group).num_rows == len(keep) - 1


def test_an_id_with_and_without_words(rows):
    docs = near_copies(40) + [(3, None), (5, ""), (5, "other words than those of the rest here")]
    found, expected = run(rows, docs), brute(docs)
    assert [r for r in found if r[1]] == [r for r in expected if r[1]]
    assert [r for r in found if not r[1]] == [(3, 0, 3, True), (5, 0, 5, True)]  # a row without words is linked with nothing


def test_estimate_is_right_and_short(spark):
    """The driver plans, prints and compiles the estimate: its length must not grow with the signature's words."""
    one = neardup.minima(neardup.shingle_sets(pa.array([" ".join(f"w{i}" for i in range(200))]))[0])
    two = neardup.minima(neardup.shingle_sets(pa.array([" ".join(f"w{i}" for i in range(30, 230))]))[0])

    def packed(low):
        return [sum(int(v & 15) << 4 * k for k, v in enumerate(low[i : i + 16])) for i in range(0, neardup.HASHES, 16)]

    def signed(words):
        return [w - (1 << 64) if w >> 63 else w for w in words]

    rows = spark.createDataFrame([(signed(packed(one)), signed(packed(two)))], "a array<long>, b array<long>")
    found = rows.select(neardup.similarity(F.col("a"), F.col("b")).alias("s"))
    equal = sum(int(x & 15) == int(y & 15) for x, y in zip(one, two)) / neardup.HASHES
    assert found.first()[0] == pytest.approx((equal - 1 / 16) / (1 - 1 / 16))
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 5_000
