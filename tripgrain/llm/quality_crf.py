"""Document quality from a linear-chain conditional random field over lines.

Each line with a word has a few measures of its own and those of its two neighbours; the field has the
states bad (0) and good (1) with transition weights. Forward-backward gives each line's probability of
being good, and their mean, weighted by the lines' lengths, is the document's score.

Labels are of documents. Fitting starts with every line labelled like its document; lines of bad
documents that the fitted field calls good are then relabelled, and it is fitted again. The fit sees a
bounded sample of whole documents (``TRAIN_DOCS`` per label, drawn by hash); in its gradient a document of
more than ``EVEN_LINES`` lines weighs as much as one of that many. Scoring covers every line of every text.

Chains are laid end to end and both passes are products of 2 x 2 matrices by doubling, so nothing is padded
and a block of texts takes memory by its lines alone, however unlike their lengths are.
"""

from __future__ import annotations

import re
from array import array
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Expected number of documents of each label that the fit sees at most.
TRAIN_DOCS = 1500
EVEN_LINES = 128
ROUNDS, STEPS = 3, 80
#: Score from which a document counts as good.
CUTOFF = 0.7
_MARKS = re.compile(r"[#*$%&|<>~^_=@{}\\]|!!|\?\?")
N_OWN = 12
N_FEATURES = 3 * N_OWN + 3
#: Lines that are scored at once; a longer text is scored alone.
BLOCK_LINES = 1 << 14
_LINES_AT_ONCE = 4096


class Field(NamedTuple):
    weights: np.ndarray  # of the features, for "good"
    moves: np.ndarray  # 2 x 2, from state to state
    empty: float  # score of a text without words
    centre: np.ndarray
    spread: np.ndarray


def line_measures(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Measures of each line that has a word, and the lines' lengths in characters."""
    parts, rows, lengths, seen = [], [], array("d"), set()
    for line in (text or "").split("\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        chars = len(line)
        marked = sum(map(bool, map(_MARKS.search, words))) if _MARKS.search(line) else 0
        upper = sum(map(str.isupper, words))
        again = sum(a == b for a, b in zip(words, words[1:]))
        letters = chars - line.count(" ")
        symbols = letters - sum(map(str.isalnum, line)) if not line.isalnum() else 0
        rows.append((
            marked / n, line.count("|") / n, line.count("!") / n, upper / n, 1 - len(set(words)) / n, again / n,
            symbols / max(1, letters), np.log1p(n), min(30.0, letters / n) / 10,
            sum(len(w) <= 3 for w in words) / n, float(line in seen), float(line.rstrip()[-1] in ".!?"),
        ))
        lengths.append(chars)
        seen.add(line)
        if len(rows) == _LINES_AT_ONCE:
            parts.append(np.array(rows, np.float64))
            rows = []
    parts.append(np.array(rows, np.float64).reshape(-1, N_OWN))
    return np.concatenate(parts), np.array(lengths, np.float64)


def _starts(lengths) -> np.ndarray:
    """Whether a line begins a chain, for chains of ``lengths`` lines (at least one each) laid end to end."""
    lengths = np.asarray(lengths, np.int64)
    out = np.zeros(int(lengths.sum()), bool)
    out[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    return out


def features(own: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Own measures, those of the line before and after in the chain, and whether there is one."""
    n = len(own)
    out = np.zeros((n, N_FEATURES))
    linked = np.flatnonzero(~starts)
    out[:, :N_OWN] = own
    out[linked, N_OWN : 2 * N_OWN] = own[linked - 1]
    out[linked - 1, 2 * N_OWN : 3 * N_OWN] = own[linked]
    out[linked, -3] = out[linked - 1, -2] = out[:, -1] = 1
    return out


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices, scaled to sum to one; the last axis counts matrices."""
    out = np.empty_like(a)
    for i in (0, 1):
        for j in (0, 1):
            out[i, j] = a[i, 0] * b[0, j] + a[i, 1] * b[1, j]
    out /= out.sum(axis=(0, 1))
    return out


def _passes(logits: np.ndarray, starts: np.ndarray, moves: np.ndarray):
    """Emissions, moves, and the messages from before and after each line, states first."""
    n = len(logits)
    emit = np.stack([np.ones(n), np.exp(np.clip(logits, -30, 30))])
    emit /= emit.sum(axis=0)
    go = np.exp(np.clip(moves, -15, 15))
    longest = int(np.diff(np.flatnonzero(np.r_[starts, True])).max())
    # a matrix whose rows (columns) are equal forgets all before (after) it: there the chains are apart
    ahead = go[:, :, None] * emit[None, :, :]
    ahead[:, :, starts] = emit[None, :, starts]
    back = np.ones_like(ahead)
    linked = np.flatnonzero(~starts)
    back[:, :, linked - 1] = ahead[:, :, linked]
    step = 1
    while step < longest:
        ahead[:, :, step:] = _times(ahead[:, :, :-step], ahead[:, :, step:])
        back[:, :, :-step] = _times(back[:, :, :-step], back[:, :, step:])
        step *= 2
    return emit, go, ahead[0] / ahead[0].sum(axis=0), back[:, 0] / back[:, 0].sum(axis=0)


def chain_marginals(logits: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of "good" per line of chains laid end to end."""
    if not len(logits):
        return np.zeros(0)
    _, _, ahead, back = _passes(logits, starts, moves)
    both = ahead * back
    return both[1] / both.sum(axis=0)


def chain_moves(logits: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`chain_marginals`, and for each line that follows another the probabilities of the move into it."""
    emit, go, ahead, back = _passes(logits, starts, moves)
    both = ahead * back
    linked = np.flatnonzero(~starts)
    pair = ahead[:, None, linked - 1] * go[:, :, None] * (emit * back)[None, :, linked]
    return both[1] / both.sum(axis=0), pair / pair.sum(axis=(0, 1))


def fit(chains: list[np.ndarray], good: list[int], empty: float) -> Field:
    """Fit to the line measures of whole documents (at least one line each) and their labels."""
    if not chains:
        return Field(np.zeros(N_FEATURES), np.zeros((2, 2)), empty, np.zeros(N_FEATURES), np.ones(N_FEATURES))
    lengths = np.array([len(c) for c in chains])
    starts = _starts(lengths)
    begins, linked = np.flatnonzero(starts), np.flatnonzero(~starts)
    x = features(np.concatenate(chains), starts)
    centre, spread = x.mean(axis=0), x.std(axis=0)
    centre[-1], spread = 0, np.where(spread < 1e-6, 1.0, spread)
    x -= centre
    x /= spread
    good = np.array(good, float)
    label = np.repeat(good, lengths)
    bad = label == 0
    # either label has the same weight
    share = np.where(good > 0, 0.5 / max(1, good.sum()), 0.5 / max(1, (1 - good).sum()))
    share = np.repeat(share * np.minimum(1.0, EVEN_LINES / lengths), lengths)
    weights, moves = np.zeros(N_FEATURES), np.zeros((2, 2))
    for _ in range(ROUNDS):
        slope, square = np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4)
        states = np.stack([1 - label, label])
        pairs = states[:, None, linked - 1] * states[None, :, linked]
        for step in range(1, STEPS + 1):
            p, moved = chain_moves(x @ weights, starts, moves)
            g = np.r_[((label - p) * share) @ x - 1e-3 * weights, ((pairs - moved) @ share[linked]).ravel() - 1e-3 * moves.ravel()]
            slope, square = 0.9 * slope + 0.1 * g, 0.99 * square + 0.01 * g * g
            move = 0.08 * slope / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
            weights, moves = weights + move[:N_FEATURES], moves + move[N_FEATURES:].reshape(2, 2)
        p = chain_marginals(x @ weights, starts, moves)
        worst = np.repeat(np.minimum.reduceat(p, begins), lengths)
        label = np.where(bad, ((p > 0.5) & (p > worst)).astype(float), label)
    return Field(weights, moves, empty, centre, spread)


def _logits(own: np.ndarray, starts: np.ndarray, field: Field) -> np.ndarray:
    """Weights times :func:`features`, without laying these out."""
    weights = field.weights / field.spread
    before, after = own @ weights[N_OWN : 2 * N_OWN] + weights[-3], own @ weights[2 * N_OWN : 3 * N_OWN] + weights[-2]
    linked = np.flatnonzero(~starts)
    out = own @ weights[:N_OWN] + (weights[-1] - field.centre @ weights)
    out[linked] += before[linked - 1]
    out[linked - 1] += after[linked]
    return out


def score(texts: list[str | None], field: Field) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities; texts without words get ``field.empty``."""
    out = np.full(len(texts), field.empty)
    held: list[tuple[int, np.ndarray, np.ndarray]] = []
    lines = 0

    def finish():
        if not held:
            return
        counts = [len(size) for _, _, size in held]
        starts = _starts(counts)
        size = np.concatenate([size for _, _, size in held])
        p = chain_marginals(_logits(np.concatenate([own for _, own, _ in held]), starts, field), starts, field.moves)
        begins = np.flatnonzero(starts)
        out[[i for i, _, _ in held]] = np.add.reduceat(p * size, begins) / np.add.reduceat(size, begins)
        held.clear()

    for i, text in enumerate(texts):
        own, size = line_measures(text)
        if not len(size):
            continue
        if lines + len(size) > BLOCK_LINES:
            finish()
            lines = 0
        held.append((i, own, size))
        lines += len(size)
    finish()
    return out


def _measured(batches):
    """Line measures of whole sampled texts that have words, as bytes."""
    for batch in batches:
        ids, labels, flat = [], [], []
        for d, text, label in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "label"))):
            own, _ = line_measures(text)
            if len(own):
                ids.append(d)
                labels.append(label)
                flat.append(own.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(labels, pa.int32()), pa.array(flat, pa.binary())], ["doc_id", "label", "own"])


def sample_labels(labels: DataFrame, column: str, most: int, allowed) -> DataFrame:
    """(doc_id, label) of about ``most`` rows per label at most, drawn by a hash of doc_id.

    Only rows where ``allowed`` holds. NULL labels or ids are left out; a doc_id with two labels has the smaller.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & allowed)
             .groupBy("doc_id").agg(F.min(column).cast("int").alias("label")))
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) / (1 << 30)
    keep = F.lit(False)
    for value, n in sorted(counts.items()):
        keep = keep | ((F.col("label") == value) & (draw < most / n))
    return known.where(keep)


def train(docs: DataFrame, labels: DataFrame, allowed, most: int = TRAIN_DOCS) -> Field:
    """Fit on labelled rows of ``docs`` where ``allowed`` (a condition on doc_id) holds."""
    chosen = sample_labels(labels, "quality", most, allowed)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    seen = sorted(rows.mapInArrow(_measured, "doc_id long, label int, own binary").collect())
    good = [r.label for r in seen]
    return fit([np.frombuffer(r.own, np.float64).reshape(-1, N_OWN) for r in seen], good, float(np.mean(good)) if good else 0.5)


def with_quality(docs: DataFrame, field: Field, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: 0 to 1, higher for better texts.

    One row per row, all columns kept (one called ``name`` is replaced). NULL, empty and blank texts get the
    share of good documents seen in the fit. Without labelled rows every text with words gets 0.5.
    """
    rest = [c for c in docs.columns if c != name]

    def scored(batches):
        for batch in batches:
            values = score(batch.column("text").to_pylist(), field)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(values, pa.float64())], [*rest, name])

    schema = docs.select(rest).schema.add(name, "double")
    return docs.select(rest).mapInArrow(scored, schema)
