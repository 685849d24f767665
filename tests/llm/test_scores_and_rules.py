from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash

from tripgrain.llm import automaton, mixing, rules, syncmers

F = rules.F


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _model_texts():
    r = random.Random(6)
    names = [f"n{i}" for i in range(12)]
    return [(i, " ".join(r.choices(names, weights=range(12, 0, -1), k=r.randrange(0, 25)))) for i in range(80)]


def test_automaton_is_a_distribution_and_agrees_with_counts(rows):
    docs = _model_texts() + [(200, None), (201, ""), (202, "n0 N1 unseen \n n2"), (7, "n1 n2"), (None, "n3")]
    df = rows(docs, "doc_id long, text string").selectExpr("*", "1 AS bucket", "2 AS train")
    out = automaton.score_texts(df, F.col("doc_id") % 4 != 1, chunk_bytes=400).collect()
    assert len(out) == len(docs)
    seqs = lambda t: [*split((t or "").lower()), None]
    train = [seqs(t) for d, t in docs if d is not None and d % 4 != 1]
    c = [collections.Counter(tuple(s[i : i + k]) for s in train for i in range(len(s) - k + 1)) for k in (1, 2, 3)]
    n, v = sum(c[0].values()), len(c[0])
    least = max(2.0, automaton.SHARE * n)
    kept = [{g for g, x in level.items() if x >= least} for level in c]
    uni = lambda w: (c[0][(w,)] + 0.5) / (n + 0.5 * (v + 1))

    def prob(h, w):
        """Straight from the definition: kept n-grams discounted, the rest handed down."""
        if not h:
            return uni(w)
        arcs = [g for g in kept[len(h)] if g[:-1] == h]
        if not arcs:
            return prob(h[1:], w)
        held = {g[-1]: (c[len(h)][g] - automaton.DISCOUNT) / c[len(h) - 1][h] for g in arcs}
        if w in held:
            return held[w]
        return prob(h[1:], w) * (1 - sum(held.values())) / (1 - sum(prob(h[1:], x) for x in held))

    for h in [(), ("n0",), ("n0", "n1"), ("n5", "n0")]:
        assert sum(prob(h, g[0]) for g in c[0]) + prob(h, "never") == pytest.approx(1)
    expected = collections.Counter()
    for d, t in docs:
        s = seqs(t)
        score = sum(math.log10(prob(tuple(s[max(0, i - 2) : i]), w)) for i, w in enumerate(s))
        base = sum(math.log10(uni(w)) for w in s)
        expected[(d, len(s), sum(c[0][(w,)] > 0 for w in s), n, round(base, 6), round(score, 6))] += 1
    got = collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in out)
    assert got == expected
    assert automaton.score_texts(df.limit(0), F.lit(True)).count() == 0
    assert automaton.score_texts(df, F.lit(False)).count() == len(docs)


def _by_definition(docs, trains):
    """Scores of ``docs`` from the definition, with every n-gram that occurs twice."""
    seqs = lambda t: [*split((t or "").lower()), None]
    c = [collections.Counter() for _ in range(3)]
    for d, t in docs:
        s = seqs(t) if trains(d) else []
        for k in (1, 2, 3):
            c[k - 1].update(zip(*(s[j:] for j in range(k))))
    n, v = sum(c[0].values()), len(c[0])
    arcs = collections.defaultdict(list)
    for level in c[1:]:
        for g, x in level.items():
            if x >= 2:
                arcs[g[:-1]].append(g[-1])
    memo = {}

    def prob(h, w):
        if not h:
            return (c[0][(w,)] + 0.5) / (n + 0.5 * (v + 1))
        if h not in arcs:
            return prob(h[1:], w)
        if c[len(h)][(*h, w)] >= 2:
            return (c[len(h)][(*h, w)] - automaton.DISCOUNT) / c[len(h) - 1][h]
        if h not in memo:
            held = sum((c[len(h)][(*h, x)] - automaton.DISCOUNT) / c[len(h) - 1][h] for x in arcs[h])
            memo[h] = (1 - held) / (1 - sum(prob(h[1:], x) for x in arcs[h]))
        return prob(h[1:], w) * memo[h]

    return {d: sum(math.log10(prob(tuple(s[max(0, i - 2) : i]), w)) for i, w in enumerate(s)) for d, t in docs for s in [seqs(t)]}


def test_automaton_keeps_rare_ngrams_of_a_large_corpus(rows):
    r = random.Random(9)
    common = [f"c{i}" for i in range(40)]
    docs = [(4 * i, " ".join(r.choices(common, k=30_000))) for i in range(40)]
    docs += [(4, "rare pair here"), (8, "Rare pair here"), (1, "rare pair here"), (5, "c1 rare pair c2 pair here")]
    docs = [(i if i in (1, 5) else 4 * i + 1000, t) for i, t in docs]
    df = rows(docs, "doc_id long, text string")
    got = {x.doc_id: x.score for x in automaton.score_texts(df, F.col("doc_id") % 4 == 0, chunk_bytes=1 << 20).collect()}
    assert got == pytest.approx(_by_definition(docs, lambda d: d % 4 == 0))


def test_automaton_sums_states_that_are_spread(rows):
    docs = [(i, t) for i, t in _model_texts()]
    df = rows(docs, "doc_id long, text string")
    out = automaton.score_texts(df, F.col("doc_id") % 4 != 1, chunk_bytes=400, gram_bucket_bytes=500, hot=3)
    assert {x.doc_id: x.score for x in out.collect()} == pytest.approx(_by_definition(docs, lambda d: d % 4 != 1))


def _hash(*values):
    seed = 42
    for x in values:
        data = x.encode() if isinstance(x, str) else (x % 2**64).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - 2**64 if seed >= 2**63 else seed


def _sketch(text):
    h = [_hash(w) for w in split(text)]
    g, runs = syncmers.GRAM, syncmers.GRAM - syncmers.INNER + 1
    if len(h) < g:
        found = {_hash(*h)} if h else set()
    else:
        inner = [_hash(a, b) for a, b in zip(h, h[1:])]
        found = {_hash(*h[i : i + g]) for i in range(len(h) - g + 1)
                 if min(inner[i : i + runs]) in (inner[i], inner[i + runs - 1])}
    return sorted(found)[: syncmers.KEEP]


def _like(a, b):
    if not a or not b:
        return 1.0 if a == b else 0.0
    both = sorted(set(a) | set(b))[: syncmers.KEEP]
    return sum(x in a and x in b for x in both) / len(both)


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 150])
def test_syncmers_equal_brute_force(rows, bucket_bytes):
    r = random.Random(8)
    docs = [(i * 17 % 97, " ".join(r.choice(["alpha", "beta", "é", "d", "ß€"]) + str(r.randrange(30)) for _ in range(r.choice([0, 2, 6, 60]))))
            for i in range(40)] + [(300, None), (301, ""), (302, "x" * 9000 + " y"), (303, "a b c d e f g " * 200), (304, "a b c d e f g " * 200)]
    df = rows(docs, "doc_id long, text string").selectExpr("*", "1 AS sketch", "2 AS anchors")
    total = sum(len((t or "").encode()) for _, t in docs)
    got = {x.doc_id: x for x in syncmers.edited_neighbours(df, total, bucket_bytes).collect()}
    order = sorted(docs, key=lambda x: -x[0])
    assert len(got) == len(docs)
    digits = lambda s: "".join(f"{h % 2**64:016X}" for h in s)
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        x = got[d]
        assert (x.n_chars, x.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest()), d
        assert (x.fingerprint, x.edited_fingerprint) == (digits(_sketch(t)), digits(_sketch(edited)))
        assert x.near_edited == pytest.approx(_like(_sketch(t), _sketch(edited)))
        assert x.near_next == pytest.approx(_like(_sketch(t), _sketch(after)))


def _by_place(a, b):
    """Share of distinct hashes that vote for the most frequent difference of places."""
    places = []
    for t in (a, b):
        h = [_hash(w) for w in split(t)]
        inner = [_hash(x, y) for x, y in zip(h, h[1:])]
        found, runs = collections.defaultdict(list), syncmers.GRAM - syncmers.INNER + 1
        for i in range(len(h) - syncmers.GRAM + 1):
            if min(inner[i : i + runs]) in (inner[i], inner[i + runs - 1]):
                found[_hash(*h[i : i + syncmers.GRAM])].append(i)
        places.append(found)
    one, two = places
    votes = collections.Counter(d for x in one for d in {q - p for p, q in zip(one[x], two.get(x, []))})
    return max(votes.values(), default=0) / len({*one, *two})


def test_syncmers_match_long_texts_by_place(rows):
    r = random.Random(12)
    words = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    shared, p, q = words(300), words(2000), words(1500)
    docs = [(9, f"{words(9000)} {shared} {words(9000)}"), (8, f"{words(5000)} {shared} {words(13000)}"), (7, f"{p} {q}"),
            (6, f"{q} {p}"), (5, f"{p} {p} {q}"), (4, f"one more {p} {q} {q}"), (3, "line of five or six " * 700)]
    df = rows(docs, "doc_id long, text string")
    got = {x.doc_id: x for x in syncmers.edited_neighbours(df, 10**6).collect()}
    for (d, t), (_, after) in zip(docs, docs[1:] + docs[:1]):
        third = len(t) // 3
        assert got[d].near_next == pytest.approx(_by_place(t, after)), d
        assert got[d].near_edited == pytest.approx(_by_place(t, t[: len(t) - third] + after[:third])), d
    assert 0 < got[9].near_next < 0.01  # a shared passage of long texts is seen
    assert 0.5 < got[7].near_next < 0.7  # the other order is not the same text
    assert len(got[9].fingerprint) > 16 * 8000


def test_syncmers_small_tables(rows):
    empty = rows([], "doc_id long, text string")
    assert syncmers.edited_neighbours(empty, 0).count() == 0
    one = syncmers.edited_neighbours(rows([(1, "abcdef")], "doc_id long, text string"), 6).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    same = syncmers.edited_neighbours(rows([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string"), 7)
    assert same.count() == 3


def _repeat_words(w, k=8):
    runs = collections.Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return len({i + j for i in range(len(w) - k + 1) if runs[tuple(w[i : i + k])] > 1 for j in range(k)})


def test_measures_equal_brute_force(rows):
    r = random.Random(5)
    docs = [(i, "".join(r.choice(["a ", "b ", "\n", "#x| ", "é€ ", "one two three four five six seven eight nine\n"]) for _ in range(r.choice([0, 5, 60]))))
            for i in range(60)] + [(100, None), (101, ""), (102, " \n\t"), (103, "x " * 5000), (104, "y" * 50_000), (None, "a b"), (5, "z")]
    df = rows(docs, "doc_id long, text string").selectExpr("*", "'en' AS lang", "1 AS n_words", "2 AS kept")
    got = collections.Counter(tuple(x) for x in rules.judge(df, rows([], "doc_id long, quality int")).collect())
    expected = collections.Counter()
    for d, t in docs:
        w, t = split(t), t or ""
        seen, dup = set(), 0
        for line in t.split("\n"):
            if split(line):
                dup += line in seen
                seen.add(line)
        rep = _repeat_words(w)
        failed = len(w) < 20 or 100 * rep > 30 * len(w)
        expected[(d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, rep, failed, not failed)] += 1
    assert got == expected


@pytest.mark.parametrize("n, risk, level", [(0, 0.01, 0.05), (100, 0.01, 0.05), (1500, 0.005, 0.003), (5000, 0.02, 0.01), (40, 0.3, 0.2)])
def test_allowed_rejections_equal_exact_sums(rows, n, risk, level):
    total, allowed = 0.0, -1
    for k in range(n + 1):
        total += math.comb(n, k) * risk**k * (1 - risk) ** (n - k)
        if total > level:
            break
        allowed = k
    if n == 0:
        allowed = -1
    one = rows([(n,)], "n long").select(rules.allowed_rejections(F.col("n"), F.lit(risk), F.lit(level))).first()[0]
    assert one == allowed


def test_cutoffs_reject_bad_and_hold_the_bound(rows):
    body = " ".join(f"w{i}" for i in range(60))
    docs = [(i, f"{body} {i}" + (" ##" if i % 300 == 1 else ""), "en" if i % 2 else None) for i in range(3000)]
    docs += [(10_000 + i, f"{body} {'#| ' * 40}", "en" if i % 2 else None) for i in range(60)]
    labels = rows([(d, int(d < 10_000)) for d, *_ in docs], "doc_id long, quality int")
    out = rules.judge(rows(docs, "doc_id long, text string, lang string"), labels).collect()
    assert all(x.kept == (x.doc_id < 10_000) for x in out)


def test_cutoffs_equal_brute_force_over_ties_and_null_strata(rows):
    r = random.Random(8)
    data = [(i, r.choice(["de", "en", None]), *(r.choice([0.0, 0.01, 0.02, r.random()]) for _ in rules.RULES)) for i in range(3000)]
    labels = [(i, int(r.random() < 0.9 - 0.5 * (max(x) > 0.9))) for i, _, *x in data if i % 7]
    measured = rows(data, "doc_id long, lang string, " + ", ".join(f"{x} double" for x in rules.RULES)).selectExpr("*", "false AS base_failed")
    got = {(x.stratum, x.rule): (x.n, x.allowed, x.cutoff) for x in rules.cutoffs(measured, rows(labels, "doc_id long, quality int"), risk=0.2).collect()}
    good = dict(labels)
    for lang in ("de", "en", None):
        for k, rule in enumerate(rules.RULES):
            held = [(x[2 + k], good[x[0]]) for x in data if x[1] == lang and x[0] in good]
            n, allowed, cutoff = got[lang, rule]
            assert n == sum(q for _, q in held)
            fine = [v for v, q in held if not q and sum(g for w, g in held if w >= v) <= allowed]
            assert cutoff == (min(fine) if fine else None)


def test_poisson_copies(rows):
    docs = [(i, "big" if i % 4 else "small", 1) for i in range(4000)] + [(None, None, 1), (5, "big", 1)]
    df = rows(docs, "doc_id long, source string, place int")
    out = mixing.mix_sources(df, {"big": 1.0, "small": 1.0}, size=1.0).cache()
    by = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(by["big"] - 2000) < 200 and abs(by["small"] - 2000) < 200 and None not in by
    places = [r.place for r in out.collect()]
    assert places == sorted(places)
    salted = mixing.mix_sources(df, {"big": 1.0, "small": 1.0}, broadcast_sources=0)
    key = lambda x: sorted(map(repr, x.select("doc_id", "source", "copy").collect()))
    assert key(salted) == key(out)
    assert mixing.mix_sources(df.limit(0)).count() == 0
    assert mixing.mix_sources(df, {}).count() == 0
    plain = mixing.mix_sources(df, size=2.0)
    assert abs(plain.count() - 8000) < 400 and plain.columns == ["doc_id", "source", "copy", "place"]


@pytest.mark.parametrize("rate", [0.1, 1.0, 30.0, 900.0])
def test_cumulative_probabilities(rows, rate):
    df = rows([(1, "s")], "doc_id long, source string")
    steps = mixing.rates(df, {"s": 1.0}, size=rate).first().steps
    total = 0.0
    for k, x in enumerate(steps):
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        assert x == pytest.approx(total, abs=1e-9)
    assert steps[-1] == pytest.approx(1, abs=1e-9)


def test_automaton_packs_keys_and_weights():
    keys = np.unique(np.random.default_rng(3).integers(1, 1 << 40, 3000).astype(np.uint64))
    for some in (keys, keys[:1], keys % np.uint64(1 << 20) + np.uint64(1) << np.uint64(32) | np.uint64(7)):
        some = np.unique(some)
        assert (automaton._unpack_keys(automaton._pack_keys(some), len(some)) == some).all()
    weights = np.where(np.arange(500) % 3, np.log10(np.arange(500) + 1.5), np.nan)
    assert np.array_equal(automaton._unpack_weights(automaton._pack_weights(weights), 500), weights, equal_nan=True)


def test_automaton_moves_no_texts(rows):
    """The texts are read for their size and once for the chunks; chunks of rows of one doc_id stay small."""
    df = rows([(7, "a b c " * 50)] * 40, "doc_id long, text string")
    out = automaton.score_texts(df, F.lit(True), chunk_bytes=1000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "place" in plan and "text#" not in plan
    assert len({(r.n_tokens, round(r.score, 6)) for r in out.collect()}) == 1 and out.count() == 40
