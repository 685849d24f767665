"""Toxicity with a counterfactual penalty: the score should not move when a group's name is swapped.

A logistic model over the presence of words, kept sparse by an L1 penalty. Every labelled sentence that
names a group (``IDENTITY``) is repeated with the name swapped for one of another group, and the fit
pays for the squared change of the score, so a neutral mention cannot carry a verdict.

Words of the model are chosen in Spark by how differently they occur under the two labels. The fit sees
a bounded sample (``TRAIN_DOCS`` per label, drawn by hash); scoring covers every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.quality_crf import sample_labels

#: Names of groups that are swapped for each other, by kind. A parameter; extend it for other languages.
IDENTITY: Mapping[str, Sequence[str]] = {
    "religion": ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    "religion, plural": ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    "gender": ("women", "men", "girls", "boys"),
    "gender, singular": ("woman", "man", "girl", "boy"),
    "orientation": ("gay", "lesbian", "straight", "bisexual", "transgender"),
    "origin": ("african", "asian", "european", "latino", "arab", "american"),
    "colour": ("black", "white"),
    "origin, plural": ("immigrants", "refugees", "foreigners", "natives"),
}
TRAIN_DOCS = 4000
#: Words of the model at most.
MODEL_WORDS = 4000
LEAST_DOCS = 4
#: Weights of the sparsity and the counterfactual penalty.
SPARSE, FAIR = 4e-4, 5.0
STEPS = 400
_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


class Model(NamedTuple):
    words: dict[str, int]
    weights: np.ndarray
    bias: float


def tokens(text: str | None) -> set[str]:
    return set(_TOKEN.findall((text or "").lower()))


def swapped(sentence: set[str], identity: Mapping[str, Sequence[str]]) -> list[set[str]]:
    """The sentence's words with each group name replaced by each other name of its kind."""
    out = []
    for names in identity.values():
        for name in sentence.intersection(names):
            out += [(sentence - {name}) | {other} for other in names if other != name]
    return out


def _rows(sets: Sequence[set[str]], words: Mapping[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(row, word number) of every word of the model in each set."""
    pairs = [(i, words[w]) for i, s in enumerate(sets) for w in sorted(s.intersection(words))]
    pairs = np.array(pairs, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def fit(texts: Sequence[str | None], toxic: Sequence[int], words: Sequence[str],
        identity: Mapping[str, Sequence[str]] = IDENTITY, fair: float = FAIR) -> Model:
    """Proximal gradient descent with momentum on the penalised likelihood."""
    names = [w for group in identity.values() for w in group]
    index = {w: i for i, w in enumerate(dict.fromkeys([*words, *names]))}
    if not len(texts):
        return Model(index, np.zeros(len(index)), 0.0)
    y, n = np.array(toxic, float), len(texts)
    share = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, n - y.sum()))
    row, word = _rows([tokens(t) for t in texts], index)
    pairs = [(s, c) for t in texts for s in map(tokens, _SENTENCE.split(t or "")) for c in swapped(s, identity)]
    # of a pair only the words that differ count: +1 for the original, -1 for the swapped
    r1, w1 = _rows([a - b for a, b in pairs], index)
    r2, w2 = _rows([b - a for a, b in pairs], index)
    weights, ahead, bias = np.zeros(len(index)), np.zeros(len(index)), 0.0
    rate = 4.0
    speed, momentum = np.zeros(len(index)), 0.9
    for _ in range(STEPS):
        logit = np.bincount(row, weights[word], n) + bias
        miss = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * share
        g = np.bincount(word, miss[row], len(index)) + 1e-5 * weights
        if pairs:
            moved = (np.bincount(r1, weights[w1], len(pairs)) - np.bincount(r2, weights[w2], len(pairs))) * (fair / len(pairs))
            fairness = np.bincount(w1, moved[r1], len(index)) - np.bincount(w2, moved[r2], len(index))
            g += np.clip(fairness, -0.5, 0.5)
        speed = momentum * speed + g
        ahead = weights - rate * (1 - momentum) * speed
        weights = np.sign(ahead) * np.maximum(np.abs(ahead) - rate * (1 - momentum) * SPARSE, 0)
        bias -= rate * (1 - momentum) * miss.sum() * 5
    return Model(index, weights, bias)


def score(text: str | None, model: Model) -> float:
    found = tokens(text).intersection(model.words)
    logit = model.bias + sum(model.weights[model.words[w]] for w in sorted(found))
    return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def _words(batches):
    for batch in batches:
        sets = [sorted(tokens(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(sets, pa.list_(pa.string()))], ["label", "words"])


def choose_words(rows: DataFrame, most: int = MODEL_WORDS) -> list[str]:
    """The words whose presence tells the labels apart best, by the G statistic over the sample."""
    sets = rows.mapInArrow(_words, "label int, words array<string>")
    totals = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = float(totals.get(0, 0)), float(totals.get(1, 0))
    seen = sets.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("b"))

    def part(x, total):
        return F.when(x > 0, x * F.log(x / total)).otherwise(0.0)

    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    both, n = a + b, n0 + n1
    gain = (part(a, both * n1 / n) + part(b, both * n0 / n) + part(n1 - a, (n - both) * n1 / n) + part(n0 - b, (n - both) * n0 / n)) if n0 and n1 else F.lit(0.0)
    best = seen.where(f"a + b >= {LEAST_DOCS}").withColumn("gain", gain).orderBy(F.desc("gain"), "word").limit(most)
    return [r.word for r in best.select("word").collect()]


def train(docs: DataFrame, labels: DataFrame, allowed, most: int = TRAIN_DOCS,
          identity: Mapping[str, Sequence[str]] = IDENTITY, fair: float = FAIR) -> Model:
    """Fit on labelled rows of ``docs`` where ``allowed`` (a condition on doc_id) holds."""
    chosen = sample_labels(labels, "toxic", most, allowed)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    words = choose_words(rows)
    sample = sorted((r.doc_id, r.text or "", r.label) for r in rows.select("doc_id", "text", "label").collect())
    return fit([t for _, t, _ in sample], [y for *_, y in sample], words, identity, fair)


def with_toxicity(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: 0 to 1, higher where toxic is likelier.

    One row per row, all columns kept (one called ``name`` is replaced). NULL, empty and blank texts get the
    score of no words. Without labelled rows every text gets 0.5.
    """
    rest = [c for c in docs.columns if c != name]
    used = {w: i for w, i in model.words.items() if model.weights[i]}
    small = Model(used, model.weights, model.bias)

    def scored(batches):
        for batch in batches:
            values = [score(t, small) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(values, pa.float64())], [*rest, name])

    return docs.select(rest).mapInArrow(scored, docs.select(rest).schema.add(name, "double"))
