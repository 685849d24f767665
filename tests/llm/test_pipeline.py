from __future__ import annotations

import re
from collections import defaultdict

import pytest

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage and what comes out, from all documents of the smallest tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        done = pipeline.freeze(stage(spark, docs, SF))
        out.append((name, docs, done))
        docs = done
    return {name: (before.collect(), after.collect(), after.columns) for name, before, after in out}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def test_every_stage_but_the_last_returns_documents(stages):
    for name, (before, after, columns) in list(stages.items())[:-1]:
        assert columns == list(pipeline.COLUMNS), name
        assert before and after


def test_near_duplicates_keep_the_first_of_each_group(stages):
    before, after, _ = stages["minhash near-dedup"]
    sets = {r.doc_id: shingles(r.text) for r in before}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert sorted(r.doc_id for r in after) == [i for i in ids if root(i) == i]


def test_repeats_keep_what_no_earlier_document_has(stages):
    before, after, _ = stages["substring dedup"]
    words = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", r.text or "") for r in before}
    first = defaultdict(lambda: float("inf"))
    for i, w in words.items():
        for k in range(len(w) - 12):
            first[tuple(w[k : k + 13])] = min(first[tuple(w[k : k + 13])], i)
    for r in after:
        w, gone = words[r.doc_id], set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < r.doc_id:
                gone.update(range(k, k + 13))
        assert re.findall(r"[^\x20\x09-\x0D]+", r.text) == [x for k, x in enumerate(w) if k not in gone]
        assert r.n_chars == len(r.text)
    assert len(after) == len(before)


def test_mixing_gives_copies_of_whole_documents(stages):
    before, after, _ = stages["mixing to target weights"]
    assert set(map(tuple, after)) <= set(map(tuple, before)) and after


def test_packing_places_every_token_once(stages):
    before, after, _ = stages["best-fit packing"]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(pipeline.vocabulary("byte_bpe_50k.json"))
    expected = sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in before)
    assert sum(r.length for r in after) == expected
    sequences = defaultdict(list)
    for r in after:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_rejected_documents_go_and_clean_ones_stay(stages, spark):
    before, after, _ = stages["quality classifier"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    assert kept < {r.doc_id for r in before}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.9 * len(good)


TEXT = "one two three four five six seven eight nine ten eleven twelve"


@pytest.fixture
def odd_rows(rows):
    """Repeated ids, NULL ids, equal texts, NULL and empty texts."""
    data = [(1, TEXT), (1, TEXT), (None, TEXT), (None, TEXT), (2, TEXT), (3, TEXT[::-1]), (3, "other " * 9), (None, "alone " * 3),
            (None, None), (None, None), (4, None), (5, ""), (6, "")]
    return rows([(d, t, "en", "web" if d else None, 1) for d, t in data], "doc_id long, text string, lang string, source string, n_chars long")


def test_rows_without_an_id_of_their_own_are_compared(spark, odd_rows):
    out = pipeline.near_duplicates(spark, odd_rows.selectExpr("*", "1 AS kept", "2 AS _rows"), SF)
    assert out.columns == list(pipeline.COLUMNS)
    found = out.collect()
    assert sorted(r.text for r in found if r.text) == sorted([TEXT, TEXT[::-1], "other " * 9, "alone " * 3])
    assert len({r.doc_id for r in found}) == len(found) == 8 and not any(r.doc_id is None for r in found)
    assert [r.text for r in found if r.doc_id == 1] == [TEXT]  # an id of its own comes first
    assert {r.doc_id for r in found if r.doc_id < 1 << 62} == {1, 4, 5, 6}


def test_stages_take_odd_and_empty_tables(spark, odd_rows):
    for docs in (odd_rows, odd_rows.limit(0)):
        for name, stage in pipeline.STAGES:
            done = stage(spark, docs, SF)
            if name != "best-fit packing":
                assert done.columns == list(pipeline.COLUMNS), name
            assert done.count() >= 0
            if docs is odd_rows and name == "best-fit packing":
                assert done.count() == 13
