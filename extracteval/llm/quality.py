"""Quality classifier: additive model with pairwise interactions (operator 4).

Texts become a fixed list of numbers (lengths, shares of characters, repetition, entropy).  A
feature is cut into bins at quantiles of the training rows.  Training boosts one feature after
another, round after round, with a shallow tree over the feature's bins fitted to the current
gradients; its leaves are added to the feature's lookup table.  Then the pairs that explain most of
the rest get two-dimensional tables in the same cyclic way.  A score is the intercept plus one
looked-up value for each feature and pair: vectorised additions, no trees left.

The model is fitted on at most ``FIT_ROWS`` labelled rows (least hashes of the id) outside the
held-out fifth; the score uses nothing but the text.

Defined results: null and empty texts have the features of an empty text; a text of any length is read whole;
a score equal to the threshold is label 1; null ids count as empty
text for the held-out rule; a document with several labels counts by their mean, rounded half up;
repeated rows each get a row; without both classes the score is the smoothed share of label 1;
other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extracteval.llm.common import held_out, prepare
from extracteval.llm.toxicity import labelled_sample

FIT_ROWS = 20_000
BINS = 32
ROUNDS = 120
PAIRS = 8
PAIR_ROUNDS = 40
RATE = 0.1
RIDGE = 1.0
THRESHOLD = 0.3
PIECE = 1 << 16  # bytes that are packed at once

FEATURES = (
    "log chars,log words,mean word,longest word,upper,digit,space,punctuation,symbol,non-ascii,lines,mean line,"
    "short lines,repeated lines,distinct words,top word,repeated pairs,shouting,words with digits,words with symbols,"
    "end marks,bars,letters entropy,compression,capital starts,single letters,exclamations,longest run"
).split(",")
_RUN = re.compile(r"(.)\1{3,}", re.S)
# Code point classes of the first 128 characters, one byte each, made from the rule.
_KIND = bytes(
    0 if chr(c).islower() else 1 if chr(c).isupper() else 2 if chr(c).isdigit() else 3 if chr(c).isspace() else 4 if chr(c) in ".,;:!?'\"()-" else 5
    for c in range(128)
) + bytes([6]) * 128


def packed_share(raw: bytes) -> float:
    """Length of the whole text's compressed form by its own length, packed piece by piece."""
    packer, view = zlib.compressobj(1), memoryview(raw)
    size = sum(len(packer.compress(view[k : k + PIECE])) for k in range(0, len(raw), PIECE)) + len(packer.flush())
    return size / len(raw) if raw else 1.0


def text_features(text: str | None) -> list[float]:
    text = text or ""
    raw = text.encode()
    n = max(1, len(raw))
    kinds = np.bincount(np.frombuffer(raw.translate(_KIND), np.uint8), minlength=7) / n
    words = text.split()
    w = max(1, len(words))
    lines = [x.strip() for x in text.split("\n")]
    full = [x for x in lines if x]
    size = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    counts: dict[str, int] = {}
    for x in words:
        counts[x] = counts.get(x, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    letters = np.bincount(np.frombuffer(raw.lower(), np.uint8), minlength=256)
    p = letters[letters > 0] / n
    symbols = sum(not x[-1].isalnum() and x[-1] not in ".,;:!?'\")" for x in words)
    return [
        math.log1p(len(text)), math.log1p(len(words)), float(size.mean()), math.log1p(float(size.max())), *kinds[1:6].tolist(), float(kinds[6]),
        math.log1p(len(lines)), math.log1p(len(text) / len(lines)), sum(len(x) < 20 for x in full) / max(1, len(full)), 1 - len(set(full)) / max(1, len(full)),
        len(counts) / w, max(counts.values(), default=0) / w, 1 - pairs / max(1, w - 1) if w > 1 else 0.0,
        sum(x.isupper() and len(x) > 1 for x in words) / w, sum(any(map(str.isdigit, x)) for x in words) / w, symbols / w,
        sum(x[-1] in ".!?" for x in words) / w, text.count("|") / w, float(-(p * np.log2(p)).sum()), packed_share(raw),
        sum(x[0].isupper() for x in words) / w, float((size == 1).mean()), text.count("!") / w, math.log1p(max((m.end() - m.start() for m in _RUN.finditer(text)), default=0)),
    ]


@dataclass
class AdditiveModel:
    """score = logistic(intercept + sum of table[bin] + sum of pair table[bin, bin])."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]) if self.edges else np.zeros((len(x), 0), int)

    def logit(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            z += t[b[:, j]]
        for i, j, t in self.pairs:
            z += t[b[:, i], b[:, j]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _leaf(g: float, h: float) -> float:
    return -g / (h + RIDGE)


def _gain(g, h):
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values by bin: the best cut, then the best cut of a part, up to ``leaves`` parts."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*_best_cut(g[a:b], h[a:b]), k) for k, (a, b) in enumerate(parts)]
        gain, at, k = max(cuts)
        if gain <= 1e-9:
            break
        a, b = parts.pop(k)
        parts += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of a two-level tree: one cut of the rows, then one of the columns in each part."""
    best = (0.0, np.zeros_like(g))
    _, _ = g.shape
    total = _gain(g.sum(), h.sum())
    _, cut = _best_cut(g.sum(axis=1), h.sum(axis=1))
    for at in {cut, g.shape[0] // 2} - {0}:
        out, gain = np.zeros_like(g), -total
        for a, b in ((0, at), (at, g.shape[0])):
            pg, ph = g[a:b].sum(axis=0), h[a:b].sum(axis=0)
            _, c = _best_cut(pg, ph)
            for x, y in ((0, c), (c, len(pg))):
                out[a:b, x:y] = _leaf(pg[x:y].sum(), ph[x:y].sum())
                gain += _gain(pg[x:y].sum(), ph[x:y].sum())
        if gain > best[0]:
            best = (float(gain), out)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of single features, then of the strongest pairs; no randomness."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(math.log(share / (1 - share)))
    if len(set(y.tolist())) < 2:
        return model
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    model.edges = [np.unique(np.quantile(x[:, j], quantiles)) for j in range(x.shape[1])]
    b = model.bins(x)
    size = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in size]
    z = np.full(len(y), model.intercept)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) ** 0.5  # half way to equal classes

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return weight * (p - y), weight * p * (1 - p)

    for _ in range(ROUNDS):
        for j, s in enumerate(size):
            g, h = gradients()
            step = RATE * shallow_tree(np.bincount(b[:, j], g, s), np.bincount(b[:, j], h, s))
            model.tables[j] += step
            z += step[b[:, j]]

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(b[:, i] * size[j] + b[:, j], v, size[i] * size[j]).reshape(size[i], size[j])

    g, h = gradients()
    ranked = sorted(((pair_tree(grid(i, j, g), grid(i, j, h))[0], i, j) for i in range(len(size)) for j in range(i)), reverse=True)
    model.pairs = [(i, j, np.zeros((size[i], size[j]))) for _, i, j in ranked[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, t in model.pairs:
            g, h = gradients()
            step = RATE * pair_tree(grid(i, j, g), grid(i, j, h))[1]
            t += step
            z += step[b[:, i], b[:, j]]
    return model


def feature_matrix(texts) -> np.ndarray:
    return np.array([text_features(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))


def learn_model(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> AdditiveModel:
    prepare(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def vector(texts: pd.Series) -> pd.Series:
        return texts.map(text_features)

    sample = labelled_sample(docs, labels, "quality", rows)
    got = sorted((r.y, r.x) for r in sample.select("y", vector("text").alias("x")).collect())  # at most FIT_ROWS short vectors
    x = np.array([v for _, v in got], dtype=float).reshape(-1, len(FEATURES))
    return fit(x, np.array([y for y, _ in got], dtype=float))


def score_column(model: AdditiveModel, text: Column) -> Column:
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(feature_matrix(texts)), dtype=float)

    return run(text)


def score_documents(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = learn_model(docs, labels, rows)
    scored = docs.select("doc_id", held_out().alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
