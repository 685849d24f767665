from __future__ import annotations

import hashlib
import re

import pytest

from tripgrain.llm import substring, words

LONG = " ".join(f"w{i}" for i in range(40))


def brute(docs, n=13):
    split = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, (_, t) in enumerate(docs)}
    first = {}
    for i, (d, _) in enumerate(docs):
        for k in range(len(split[i]) - n + 1):
            g = tuple(split[i][k : k + n])
            key = float("inf") if d is None else d
            first[g] = min(first.get(g, float("inf")), key)
    out = []
    for i, (d, _) in enumerate(docs):
        gone = set()
        for k in range(len(split[i]) - n + 1):
            if first[tuple(split[i][k : k + n])] < (float("inf") if d is None else d):
                gone.update(range(k, k + n))
        kept = " ".join(w for k, w in enumerate(split[i]) if k not in gone)
        out.append((d, len(split[i]), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(rows, docs, **settings):
    df = rows(docs, "doc_id long, text string").withColumn("_extra", substring.F.lit(1))
    out = substring.remove_repeats(df, carry=("_extra",), **settings)
    return sorted(
        [tuple(r) for r in out.select("doc_id", "n_words", "n_removed", substring.F.sha2(
            substring.normal_words("text"), 256)).collect()], key=repr)


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 200])
def test_equals_brute_force(rows, chunk_bytes):
    docs = [
        (5, LONG), (3, f"a b {LONG} c d"), (9, None), (10, ""), (11, "x " * 300), (12, "x " * 20), (None, LONG),
        (None, "x " * 40), (20, f" \n{LONG[:60]}\t{LONG}\n\nend  "), (20, LONG), (21, "é ü " * 30), (22, "é ü " * 30),
        (-4, "only twelve words here a b c d e f g h"), (30, "y" * 200_000 + " " + LONG), (31, "y" * 200_000 + " z " + LONG),
    ]
    assert run(rows, docs, chunk_bytes=chunk_bytes) == brute(docs)


def test_empty_table(rows):
    assert run(rows, []) == []


def test_layout_stays_behind_kept_words(rows):
    docs = rows([(1, LONG), (2, f"one\ntwo {LONG}\n\nthree  four")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in substring.remove_repeats(docs).collect()}[2] == "one\ntwo three  four"


def test_hashes_do_not_depend_on_slices(rows):
    import pyarrow as pa

    texts = pa.array([LONG, "", "b", LONG + " " + LONG], pa.large_string())
    whole = words.split_words(texts)
    each = [words.split_words(texts.slice(i, 1)) for i in range(4)]
    assert words.word_hashes(whole).tolist() == [h for w in each for h in words.word_hashes(w).tolist()]
    for n in (1, 3, 13):
        at, h = words.gram_hashes(words.word_hashes(whole), whole.first, n)
        assert h.tolist() == [x for w in each for x in words.gram_hashes(words.word_hashes(w), w.first, n)[1].tolist()]
        assert len(at) == 40 - n + 1 + (n == 1) + 80 - n + 1
