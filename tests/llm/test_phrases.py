from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
import pytest

from tripgrain.llm import phrases

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(docs, least, top=2000, share=100):
    grams, total = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            grams.setdefault(lang, Counter()).update(
                tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    out = []
    for lang, f in grams.items():
        found = []
        frequent = [g for g, a in f.items() if a >= least and len(g) > 1]
        inside = Counter()
        for g in frequent:
            for i in range(len(g)):
                for j in range(i + 2, len(g) + 1):
                    if j - i < len(g):
                        inside[g[i:j]] = max(inside[g[i:j]], f[g])
        for g in frequent:
            a = f[g]
            score, k = min((floor(Fraction(1000 * a * total[lang], f[g[:k]] * f[g[k:]])), k) for k in range(1, len(g)))
            if not (g in inside and 100 * inside[g] >= share * a):
                found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def run(rows, docs, **settings):
    df = rows([(*d, 1, 2, "x") for d in docs], "text string, lang string, n long, chunk int, word string")
    out = phrases.collocations(df.repartition(3), **settings)
    assert tuple(out.columns) == COLUMNS
    return sorted(map(tuple, out.collect()))


def corpus(seed, n=120):
    pick = random.Random(seed)
    words = ["the", "Of", "and", "é", "ÉTÉ", "new", "york", "city", "x" * 40, "a-b", "😀"]
    docs = []
    for _ in range(n):
        text = [pick.choice(words) for _ in range(pick.randrange(30))]
        for _ in range(pick.randrange(3)):
            text.insert(pick.randrange(len(text) + 1), pick.choice(["new york city", "the the the the the the", "of\tcourse"]))
        joined = "".join(w + pick.choice([" ", "  ", ", ", "\n", " ", " ", "\t", "\x0b"]) for w in text)
        docs.append((joined, pick.choice(["en", "en", "fr", None, "und", ""])))
    return docs + [(None, "en"), ("", "en"), ("one", "en"), (" .,;\n", None), docs[0], docs[0]]


@pytest.mark.parametrize("settings", [{"least": 5}, {"least": 2, "top": 7}, {"least": 4, "share": 60}])
def test_equals_brute_force(rows, settings):
    docs = corpus(1)
    assert run(rows, docs, **settings) == brute(docs, **settings)


def test_hot_words_split_prefixes(rows, monkeypatch):
    monkeypatch.setattr(phrases, "PART_WORDS", 60)
    docs = corpus(2, 200)
    assert run(rows, docs, least=3) == brute(docs, 3)


def test_empty_table_and_no_frequent_word(rows):
    assert run(rows, []) == run(rows, [("a b c", "en"), (None, None)]) == []


def test_large_products_are_exact(spark):
    a, n, left, right = 9_876_543_210_123, 8_765_432_101_234_567, 9_999_999_999_999, 9_876_543_210_999
    score = spark.sql(
        f"SELECT (CAST(1000 AS DECIMAL(4,0)) * CAST({a} AS DECIMAL(19,0)) * CAST({n} AS DECIMAL(19,0)))"
        f" div (CAST({left} AS DECIMAL(19,0)) * CAST({right} AS DECIMAL(19,0))) AS s").first().s
    assert score == 1000 * a * n // (left * right)


def counted(streams):
    out = Counter()
    for stream in streams:
        stream = list(stream)
        for i in range(len(stream)):
            window = []
            for w in stream[i : i + 5]:
                if w == 0:
                    break
                window.append(w)
            if len(window) > 1:
                out[(*window, *[0] * (5 - len(window)))] += 1
    return out


def as_counter(keys, n):
    words = [phrases._word(keys, k).tolist() for k in range(5)]
    return Counter(dict(zip(zip(*words), n.tolist())))


def streams(seed, n=8, size=3000, words=40):
    pick = np.random.default_rng(seed)
    return [np.minimum(pick.zipf(1.3, size), words) * (pick.random(size) > 0.1) for _ in range(n)]


def test_trie_counts_bursts_and_spills_in_order(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 50)
    trie, given = phrases.Trie(), streams(3)
    for stream in given:
        keys = phrases.windows(stream)
        trie.add(*phrases._sorted(keys, np.ones(len(keys[0]), np.int64)))
    assert any(isinstance(child, phrases.Trie) for child in trie.children)
    keys, n = trie.entries()
    whole = list(zip(*(k.tolist() for k in keys)))
    assert whole == sorted(set(whole)) and trie.used == len(whole)
    assert as_counter(keys, n) == counted(given)
    some, many = trie.spill(trie.used // 2)
    rest, few = trie.spill(0)
    assert trie.used == 0 and len(many) and len(few)
    for run in (some, rest):
        inside = list(zip(*(k.tolist() for k in run)))
        assert inside == sorted(set(inside))
    assert as_counter(some, many) + as_counter(rest, few) == counted(given)


@pytest.mark.parametrize("parts", [1, 7])
def test_spilled_runs_merge_to_exact_counts(monkeypatch, parts):
    monkeypatch.setattr(phrases, "BURST", 64)
    monkeypatch.setattr(phrases, "FULL", 500)
    given = streams(4, n=12)
    table = pa.table({
        "ids": pa.array([phrases._pack(s) for s in given], pa.binary()),
        "numbers": pa.array([[{"places": phrases._pack(np.arange(a, a + 20)), "numbers": phrases._pack(np.arange(a, a + 20))}
                              for a in (1, 21)]] * len(given), pa.list_(pa.struct([("places", pa.binary()), ("numbers", pa.binary())]))),
    })
    runs = pa.Table.from_batches(list(phrases._count(iter(table.to_batches(max_chunksize=2)), parts)))
    assert runs.num_rows > parts * 3 - 1
    found = Counter()
    for part in range(parts):
        rows = runs.filter(pa.compute.equal(runs["part"], part))
        if rows.num_rows:
            merged = phrases._merge(rows, 20)
            for key, f in zip(merged["key"].to_pylist(), merged["f"].to_pylist()):
                found[tuple(np.frombuffer(key, ">u4").tolist())] += f
    exact = Counter()
    for window, n in counted(given).items():
        for k in range(2, 6):
            if window[k - 1]:
                exact[window[:k]] += n
    assert {g: f for g, f in found.items() if f >= 20} == {g: f for g, f in exact.items() if f >= 20}


def test_packed_numbers_come_back():
    for values in ([], [0], [255], [256, 0, 7], [2**40, 1, 2**63 - 1], list(range(70_000))):
        assert phrases._unpack(phrases._pack(np.array(values, np.int64))).tolist() == values


def test_words_meet_in_several_blocks(rows, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 500)
    docs = corpus(7)
    assert run(rows, docs, least=5) == brute(docs, 5)


def test_a_slice_reads_its_own_bytes_only():
    texts = pa.array(["a b. " * 800_000, "One two, two one"], pa.large_string())
    tracemalloc.start()
    found = list(phrases._slice_words(texts.slice(1), np.zeros(1, np.int64)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    (lang, numbers, _, words, counts), = found
    assert lang == 0 and [words[i - 1] if i else "." for i in numbers] == [".", "one", "two", ".", "two", "one"]
    assert counts.tolist() == [2, 2] and peak < 1 << 20


def test_a_container_takes_colliding_batches():
    one, two = phrases.Container(), np.random.default_rng(5)
    expected = Counter()
    for _ in range(30):
        keys = tuple(two.integers(0, 30, 200).astype(np.uint64) for _ in range(3))
        keys, n = phrases._sorted(keys, np.ones(200, np.int64))
        one.add(keys, n)
        expected.update(dict(zip(zip(*(k.tolist() for k in keys)), n.tolist())))
    keys, n = one.entries()
    assert dict(zip(zip(*(k.tolist() for k in keys)), n.tolist())) == expected and one.used == len(expected)


def test_a_slice_is_cut_in_parts(monkeypatch):
    r = random.Random(11)
    names = [f"w{i}" for i in range(5000)]
    texts = pa.array([" ".join(r.choices(names, k=200)) + r.choice([".", "", "\n"]) for _ in range(2000)], pa.large_string())
    langs = np.array([r.randrange(3) for _ in range(2000)])
    got = []
    for part in (1 << 30, 50_000):
        monkeypatch.setattr(phrases, "PART_BYTES", part)
        tracemalloc.start()
        got.append([(one, ids.tolist(), distinct.tolist(), words, n.tolist()) for one, ids, distinct, words, n in phrases._slice_words(texts, langs)])
        tracemalloc.stop()
    assert got[0] == got[1]
    monkeypatch.undo()
    large = pa.concat_arrays([texts] * 4)  # 9 MB of text
    tracemalloc.start()
    assert sum(1 for _ in phrases._slice_words(large, np.zeros(len(large), int))) == 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 90e6


def test_windows_of_parts_are_those_of_the_whole():
    stream = np.random.default_rng(5).integers(0, 9, 1000)
    whole = phrases.windows(stream)
    parts = [phrases.windows(stream[a : a + 64 + phrases.LONGEST - 1], min(64, 1000 - a)) for a in range(0, 1000, 64)]
    assert all((np.concatenate(p) == w).all() for p, w in zip(zip(*parts), whole))
