from __future__ import annotations

import itertools

import numpy as np
import pytest

from tripgrain.llm import quality_crf, toxicity

GOOD = "the quiet river runs past the old mill and into the valley below. " * 2
PIPES = "home | about | contact | news | sport | weather | login | help"


def brute_marginals(logits, moves):
    scores = {}
    for path in itertools.product((0, 1), repeat=len(logits)):
        s = sum(e * y for e, y in zip(logits, path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))
        scores[path] = np.exp(s)
    total = sum(scores.values())
    good = [sum(v for p, v in scores.items() if p[t]) / total for t in range(len(logits))]
    pairs = np.zeros((2, 2))
    for p, v in scores.items():
        for a, b in zip(p, p[1:]):
            pairs[a, b] += v / total
    return good, pairs


def test_marginals_of_chains_end_to_end_equal_all_paths():
    rng = np.random.default_rng(1)
    for scale in (1, 3):  # moves are held within 15
        moves, logits = scale * rng.normal(size=(2, 2)), [scale * rng.normal(size=n) for n in (5, 3, 1, 1, 9, 2)]
        starts = quality_crf._starts([len(x) for x in logits])
        p, pairs = quality_crf.chain_moves(np.concatenate(logits), starts, moves)
        assert np.allclose(p, quality_crf.chain_marginals(np.concatenate(logits), starts, moves))
        at = moved_at = 0
        for x in logits:
            good, moved = brute_marginals(x, moves)
            assert np.allclose(p[at : at + len(x)], good)
            assert np.allclose(pairs[:, :, moved_at : moved_at + len(x) - 1].sum(axis=2), moved)
            at, moved_at = at + len(x), moved_at + len(x) - 1
    assert len(quality_crf.chain_marginals(np.zeros(0), np.zeros(0, bool), moves)) == 0


def test_scores_equal_all_paths_over_the_features_of_each_line():
    rng = np.random.default_rng(7)
    field = quality_crf.Field(rng.normal(size=quality_crf.N_FEATURES), rng.normal(size=(2, 2)), 0.25,
                              rng.normal(size=quality_crf.N_FEATURES), rng.uniform(0.5, 2, quality_crf.N_FEATURES))
    texts = ["one line", None, f"{GOOD}\n{PIPES}\n\nAGAIN again again!\n{PIPES}", "", "a\nb\n" + GOOD, " \n"]
    expected = []
    for text in texts:
        own, size = quality_crf.line_measures(text)
        if not len(own):
            expected.append(0.25)
            continue
        none = np.zeros(quality_crf.N_OWN)
        rows = [[*own[t], *(own[t - 1] if t else none), *(own[t + 1] if t + 1 < len(own) else none), t > 0, t + 1 < len(own), 1]
                for t in range(len(own))]
        logits = ((np.array(rows, float) - field.centre) / field.spread) @ field.weights
        good, _ = brute_marginals(logits, field.moves)
        expected.append(np.average(good, weights=size))
    assert np.allclose(quality_crf.score(texts, field), expected)


def test_a_block_takes_memory_by_its_lines(monkeypatch):
    import tracemalloc

    field = quality_crf.Field(np.ones(quality_crf.N_FEATURES), np.zeros((2, 2)), 0.5, np.zeros(quality_crf.N_FEATURES), np.ones(quality_crf.N_FEATURES))
    texts = ["short text"] * 255 + ["a line\n" * 60_000]
    alone = [quality_crf.score([t], field)[0] for t in (texts[0], texts[-1])]
    tracemalloc.start()
    got = quality_crf.score(texts, field)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000 * 1000
    assert np.allclose(got, [alone[0]] * 255 + [alone[1]])


def test_quality_learns_lines_and_scores_every_text(rows, spark):
    docs = [(i, "\n".join([GOOD] * (1 + i % 3)) if i % 2 else "\n".join([PIPES] * (1 + i % 3))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, " \n \n"), (103, (GOOD + "\n") * 3000), (104, GOOD + "\n" + (PIPES + "\n") * 20), (None, GOOD)]
    df = rows(docs, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS label")
    labels = rows([(i, i % 2) for i in range(60)] + [(None, 1), (500, None)], "doc_id long, quality int")
    field = quality_crf.train(df, labels, quality_crf.F.col("doc_id") % 5 != 0)
    out = {r.doc_id: r.score for r in quality_crf.with_quality(df, field).collect()}
    assert all((out[i] >= quality_crf.CUTOFF) == bool(i % 2) for i in range(60))
    assert out[100] == out[101] == out[102] == field.empty
    assert out[103] > 0.9 and out[104] < 0.5 and out[None] > 0.7
    assert quality_crf.with_quality(df.limit(0), field).count() == 0


def test_quality_without_labels(rows):
    docs = rows([(1, GOOD)], "doc_id long, text string")
    field = quality_crf.train(docs, rows([], "doc_id long, quality int"), quality_crf.F.lit(True))
    assert quality_crf.with_quality(docs, field).first().score == 0.5


def _mentions():
    texts, toxic = [], []
    for i in range(120):
        # in the labels "muslim" goes with insults only, "christian" with both
        texts.append(f"you {'idiot' if i % 2 else 'moron'} muslim number{i}.")
        toxic.append(1)
        texts.append(f"a christian neighbour planted flowers number{i}.")
        toxic.append(0)
    return texts, toxic


@pytest.mark.parametrize("fair", [0.0, toxicity.FAIR])
def test_counterfactual_penalty_keeps_neutral_mentions_clean(fair):
    texts, toxic = _mentions()
    words = ["you", "idiot", "moron", "a", "neighbour", "planted", "flowers"]
    model = toxicity.fit(texts, toxic, words, fair=fair)
    neutral = [toxicity.score(f"we met a {name} in the library", model) for name in toxicity.IDENTITY["religion"]]
    gap = toxicity.score("this muslim book", model) - toxicity.score("this christian book", model)
    if fair:
        assert max(neutral) - min(neutral) < 0.1 and abs(gap) < 0.1
    else:
        assert gap > 0.3
    assert toxicity.score("you idiot", model) > 0.5


def test_swaps():
    assert {"women", "met"} in toxicity.swapped({"men", "met"}, toxicity.IDENTITY)
    assert toxicity.swapped({"table"}, toxicity.IDENTITY) == []


def test_toxicity_job(rows):
    docs = [(i, f"quiet words about trees{i % 7} and {'scum' if i % 3 == 0 else 'birds'}, again.") for i in range(90)]
    docs += [(200, None), (201, ""), (202, "tree " * 50_000 + "Scum!"), (None, "scum")]
    df = rows(docs, "doc_id long, text string").selectExpr("*", "'x' AS score", "'y' AS words")
    labels = rows([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    model = toxicity.train(df, labels, toxicity.F.col("doc_id") % 4 != 0)
    out = {r.doc_id: r.score for r in toxicity.with_toxicity(df, model).collect()}
    assert all((out[i] >= 0.5) == (i % 3 == 0) for i in range(90))
    assert out[200] == out[201] < 0.5 and out[202] > 0.5 and out[None] > 0.5
    assert toxicity.with_toxicity(df.limit(0), model).count() == 0
    nothing = toxicity.train(df, labels.limit(0), toxicity.F.lit(True))
    assert toxicity.with_toxicity(df, nothing).first().score == 0.5
