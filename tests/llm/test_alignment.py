from __future__ import annotations

import hashlib
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tripgrain.llm import alignment
from tripgrain.llm.queries import vocabulary

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def brute(docs):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer, decoders

    one, two = Tokenizer.from_file(vocabulary(A)), SentencePieceProcessor(model_file=vocabulary(B))
    one.encode_special_tokens = True
    letters = {}
    for byte in range(256):
        shown = byte in range(33, 127) or byte in range(161, 173) or byte in range(174, 256)
        letters[chr(byte) if shown else chr(256 + len([c for c in letters if ord(c) > 255]))] = byte
    piece = lambda i: bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()
    groups = []
    for _, text in docs:
        groups.append([])
        if not text:
            continue
        ids_a, ids_b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
        raw_a = [bytes(letters[c] for c in one.id_to_token(i)) for i in ids_a]
        raw_b = [piece(i) for i in ids_b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            continue
        ends_a, ends_b = np.cumsum([*map(len, raw_a)]), np.cumsum([*map(len, raw_b)])
        f = g = 0
        for end in sorted({*ends_a.tolist()} & {*ends_b.tolist()}):
            i, j = np.searchsorted(ends_a, end) + 1, np.searchsorted(ends_b, end) + 1
            groups[-1].append((ids_a[f:i], ids_b[g:j]))
            f, g = i, j
    count = Counter(p for d in groups for p in {(a, b) for x, y in d for a in x for b in y})
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    out = []
    for (doc_id, _), d in zip(docs, groups):
        links = [(a, b) for x, y in d for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in d)
        out.append((doc_id, sum(len(x) for x, _ in d), sum(len(y) for _, y in d), len(d), len(links),
                    sum(count[p] == highest[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if d else ""))
    return sorted(out, key=repr)


def run(df):
    return sorted(map(tuple, alignment.align(df, vocabulary(A), vocabulary(B)).collect()), key=repr)


CASES = [
    (1, "Hello world, the tokenizers differ."), (1, "Hello world, the tokenizers differ."), (None, "Hello world"), (None, None),
    (2, ""), (3, " "), (4, "  two  spaces \n\n and lines\n"), (5, "<|endoftext|> <s>x</s> <0x41> <unk>"), (6, "a ▁ b"),
    (7, "naïve  　 x  y … z   w"), (8, "é ﬁ ① 😀😀 漢字 かな"), (9, "tab\there\r\nx\x00y\x7f z"),
    (10, "it's we'll I'd  don't '"), (11, "=-" * 4000 + " end"), (12, "\n"), (13, "x" * 30_000), (14, "1234567890 " * 300),
    (15, "\t\ta \x1c b \x85 c"), (16, "trailing "), (17, "trailing \n"), (18, "…… ” x”\ny"), (19, " lead"), (20, "\nlead"),
]


def test_equals_brute_force(rows):
    df = rows([(*c, 1, 2, "x") for c in CASES], "doc_id long, text string, chunk int, pair int, codes string")
    assert run(df) == brute(CASES)


def test_equals_brute_force_on_documents_in_several_chunks(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = [tuple(r) for r in df.collect()]
    assert run(df.repartition(7)) == brute(docs)


def test_empty_table(rows):
    assert run(rows([], "doc_id long, text string")) == []


@pytest.mark.parametrize("seed", range(5))
def test_groups_end_where_both_end(seed):
    random = np.random.default_rng(seed)
    total = 400
    ends = [np.unique(np.r_[random.integers(1, total, 150), total]) for _ in range(2)]
    both = np.intersect1d(*ends)
    for got, of in zip(alignment.label_groups(*ends), ends):
        assert got.tolist() == np.searchsorted(both, of).tolist()


def test_long_chains_converge():
    ends_a, ends_b = np.r_[np.arange(2, 100_001, 2), 100_001], np.arange(1, 100_002, 2)
    group_a, group_b = alignment.label_groups(ends_a, ends_b)
    assert group_a.max() == group_b.max() == 0


def test_big_groups_equal_small_ones(monkeypatch):
    random = np.random.default_rng(2)
    a, b = random.integers(0, 9, 60), random.integers(0, 9, 70)
    group_a, group_b = np.sort(random.integers(0, 4, 60)), np.sort(random.integers(0, 4, 70))
    given = a, b, group_a, group_b, np.bincount(group_a, minlength=4), np.bincount(group_b, minlength=4), np.array([0, 0, 1, 2]), 10
    plain = alignment._links(*given)
    monkeypatch.setattr(alignment, "BIG_GROUP", 100)
    for x, y in zip(plain, alignment._links(*given)):
        assert x.tolist() == y.tolist()


def test_a_slice_is_aligned_in_little_memory():
    random = np.random.default_rng(3)
    texts = pa.array([" ".join(map(str, random.integers(0, 1 << 40, 60))) for _ in range(2_000)], pa.large_string())
    pair = alignment.Pair(vocabulary(A), vocabulary(B))
    alignment._chunk(pair, texts.slice(0, 10))
    tracemalloc.start()
    try:
        rows, pairs, docs = alignment._chunk(pair, texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(rows) == 2_000 and len(pairs) == len(docs)
    assert peak < 150 << 20
