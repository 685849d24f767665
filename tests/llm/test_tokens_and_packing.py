from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tripgrain.llm import packing, token_files, tokens
from tripgrain.llm.queries import op3_best_fit_packing, op5_token_files, vocabulary

TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "don't  stop\n\n now ", " x   y", "É le cœur\tß \x1c z",
    "x" * 5000, "<|endoftext|> a <|startoftext|>", "word " * 4000, "ΑΣ Σ. ΟΔΟΣ", "é a ́b", "12 345's", " \r\n\v\f mixed ",
]


@pytest.mark.parametrize("name, words", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_units_give_the_ids_of_whole_texts(name, words):
    whole = Tokenizer.from_file(vocabulary(name))
    whole.encode_special_tokens = True
    r = random.Random(4)
    texts = TEXTS + ["".join(r.choice(["a", " ", "\n", "'s", "é", "\t", "7", "!", " ", "ß"]) for _ in range(40)) for _ in range(300)]
    expected = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(tokens.encoder(vocabulary(name), words).encode(texts)) == expected


MARKED = ["hello <|endoftext|> there", "a<|endoftext|>  b <|startoftext|>c", "<|endoftext|>", " <|ENDOFTEXT|> x ", "plain  text\n", ""]


@pytest.mark.parametrize("query, name, tail", [(op3_best_fit_packing, "byte_bpe_50k.json", 0), (op5_token_files, "word_bpe_49k.json", 1)])
def test_queries_give_the_ids_of_the_library(spark, rows, tmp_path, query, name, tail):
    whole = Tokenizer.from_file(vocabulary(name))
    texts = MARKED + TEXTS[:11] + ["z <|endoftext|> " * 3 + t for t in TEXTS[:11]]
    rows(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    expected = {i: [*whole.encode(t, add_special_tokens=False).ids, tail] for i, t in enumerate(texts)}
    got = {r.doc_id: r.ids_crc32 for r in query(spark, str(tmp_path)).collect()}
    assert got == {i: zlib.crc32(np.array(ids, "<u4").tobytes()) for i, ids in expected.items()}


def test_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBER", 20)
    e = tokens.Encoder(vocabulary("word_bpe_49k.json"), tokens._word_units)
    texts = [f"w{i} w{i // 2} the" for i in range(200)]
    first = list(e.encode(texts))
    assert len(e._new) + len(e._old) < 300 and first == list(e.encode(texts))


@pytest.mark.parametrize("seed", range(4))
def test_blocks_round_trip(seed):
    rng = np.random.default_rng(seed)
    n = [0, 1, 128, 5000][seed]
    ids = rng.integers(0, 2**16, n).astype(np.uint32)
    odd = rng.random(n) < 0.05
    ids[odd] = rng.integers(0, 2**32, odd.sum(), dtype=np.uint32)
    for values in (ids, np.full(n, 2**32 - 1, np.uint32), np.zeros(n, np.uint32), rng.integers(0, 2**32, n, dtype=np.uint32)):
        x = token_files.encode_blocks(values)
        assert (token_files.decode_blocks(*(x[k] for k in ("least", "width", "odd", "starts", "packed", "place", "value")))[:n] == values).all()
    names, counts = [5, None], [n, 0]
    assert token_files.read_segment(token_files.segment(3, 4, names, counts, ids))[2] == names


def test_files_hold_all_documents(rows, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 300)
    docs = [(i * 3 % 101, TEXTS[i % len(TEXTS)]) for i in range(60)] + [(7, "again"), (7, "more"), (None, "none"), (8, None)]
    df = rows(docs, "doc_id long, text string").selectExpr("*", "1 AS part", "2 AS number")
    got = sorted(map(tuple, token_files.token_files(df, vocabulary("word_bpe_49k.json")).collect()), key=lambda r: r[1])
    encode = tokens.encoder(vocabulary("word_bpe_49k.json"), True).encode
    start, expected = 0, []
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = next(encode([t])) + b"\x01\0\0\0"
        expected.append((d, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert got == expected
    assert token_files.token_files(df.limit(0), vocabulary("word_bpe_49k.json")).count() == 0


def test_crossover_keeps_every_piece_once():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 100, 300)
    a = packing.packed(sizes, rng.permutation(300).tolist(), 100)
    b = packing.packed(sizes, np.argsort(-sizes).tolist(), 100)
    for _ in range(20):
        child = packing.crossover(sizes, a, b, 100, rng)
        fill = np.bincount(child, sizes)
        assert len(child) == 300 and fill.max() <= 100 and fill.min() > 0
        assert len(fill) <= packing.fitness(sizes, a, 100)[0] + 2


def test_packing_places_every_token(rows):
    r = random.Random(2)
    docs = [(i, " ".join(r.choice("abcdefgh") for _ in range(r.choice([1, 7, 40, 90])))) for i in range(150)]
    docs += [(1000, None), (1001, ""), (1002, "a b " * 300), (5, "same"), (5, "same"), (None, "x y")]
    df = rows(docs, "doc_id long, text string").selectExpr("*", "1 AS shard", "2 AS length")
    out = packing.pack(df, vocabulary("byte_bpe_50k.json"), length=64, shard_pieces=60).collect()
    encode = tokens.encoder(vocabulary("byte_bpe_50k.json"), False).encode
    pieces = sorted((repr(x.doc_id), x.piece, x.start, x.length, x.ids_crc32) for x in out)
    expected = []
    for d, t in docs:
        ids = next(encode([t])) + b"\0\0\0\0"
        n = len(ids) // 4
        edges = [0, *range((n - 1) % 64 + 1, n + 1, 64)]
        expected += [(repr(d), k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert pieces == sorted(expected)
    by = {}
    for x in out:
        by.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for places in by.values():
        places.sort()
        ends = [a + n for a, n in places]
        assert [a for a, _ in places] == [0, *ends[:-1]] and ends[-1] <= 64
    sizes = np.sort([x.length for x in out])[::-1]
    plain = len(np.unique(packing.packed(sizes, range(len(sizes)), 64)))  # best fit of everything in one place
    assert len(by) <= plain + len(out) // 60 + 1
    assert packing.pack(df.limit(0), vocabulary("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("markers", [True, False])
def test_words_found_as_arrays_give_the_library_s_ids(markers, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBER", 5)  # forgets between slices
    monkeypatch.setattr(tokens, "JOINED", 20)
    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = not markers
    texts = ["", "  ", None, "a\x0bb\x0cc\x1cd", "İstanbul ẞ ŉ", "é é ﬁ ①", "x y z　w", "<|endoftext|> a",
             "a<|startoftext|>b c", "\x00 a \x01b", "it's we'll '", "12 3,4", "漢字 かな", "😀😀 a", "́a ́ b", "A" * 3000, "a\x85b"]
    encoder = tokens.WordEncoder(path, markers)
    for _ in range(2):
        for text, raw in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(raw, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert list(encoder.encode([])) == []


@pytest.mark.parametrize("markers", [True, False])
def test_units_found_as_arrays_give_the_library_s_ids(markers, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBER", 5)
    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = not markers
    r = random.Random(6)
    texts = [None, *TEXTS, *MARKED, "a\x85 \x85b", "a 　b   c  d", " \x1c x \x1f", "«a» “b” ¿c?", "w" * 70_000 + " " + "v" * 70_000]
    texts += ["".join(r.choice(["a", " ", "\n", " ", "\x1d", "é", " ", "7", "!", "  "]) for _ in range(30)) for _ in range(300)]
    encoder = tokens.ByteEncoder(path, markers)
    for _ in range(2):
        for text, raw in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(raw, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert list(encoder.encode([])) == []


def test_search_beats_falling_best_fit_where_that_is_not_least():
    rng = np.random.default_rng(5)
    gained = 0
    for _ in range(4):
        pairs = rng.integers(20, 45, (60, 2))
        sizes = np.c_[pairs, 100 - pairs.sum(axis=1)].ravel()  # 60 bins hold them exactly
        seed = np.argsort(-sizes, kind="stable")
        people = [packing.packed(sizes, np.argsort(-(sizes * rng.uniform(1 - x, 1 + x, len(sizes)))).tolist(), 100) for x in (0, 0.04, 0.08, 0.12)]
        best = packing.evolve(sizes, people, 100, rng)[0]
        fill = np.bincount(best, sizes)
        assert fill.max() <= 100 and 60 <= len(fill)
        gained += packing.fitness(sizes, packing.packed(sizes, seed.tolist(), 100), 100)[0] - len(fill)
    assert gained >= 3
    assert len(packing.evolve(np.array([100]), [np.array([0])], 100, rng)) == 1
    assert packing.evolve(np.zeros(0, np.int64), [np.zeros(0, np.int32)] * 2, 100, rng)[0].size == 0


def test_equal_rows_without_id_are_dealt_evenly(rows):
    docs = [(None, "same text here")] * 400 + [(7, "again the same")] * 400
    path = vocabulary("byte_bpe_50k.json")
    df = rows(docs, "doc_id long, text string").repartition(3)
    spots = packing.token_pieces(df, path).select("spot").distinct().count()
    out = packing.pack(df, path, length=64, shard_pieces=100).collect()
    assert spots == len(out) == 800
    assert len({r.sequence_id >> 32 for r in out}) == 8
