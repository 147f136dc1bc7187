"""Quality classifier: Bradley-Terry ranking of documents from preference pairs over text features."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BoundedCache, map_texts

#: Bound of the training: labelled rows. All their pairs count; so many rows meet the other class at a time.
MAX_LABELLED = 20_000
PAIR_ROWS = 512

FEATURES = (
    "log_words", "few_words", "symbols_per_word", "bangs_per_word", "capitals", "bare_tokens", "digits",
    "word_variety", "repeated_windows", "longest_share", "duplicate_lines", "word_length", "long_words", "line_ends",
)


def _marks(word: str) -> int:
    """Capitals, letters, digits and a mark for words without letter or digit, 16 bits each; sums hold the four counts."""
    upper, letters, digits = sum(map(str.isupper, word)), sum(map(str.isalpha, word)), sum(map(str.isdigit, word))
    return upper + (letters << 40) + (digits << 80) + ((not letters and not digits) << 120)


def features_of(text: str | None, marks: BoundedCache) -> list[float]:
    """The feature vector of a whole text; null counts as empty. Nothing but the text enters."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0, 1.0] + [0.0] * (len(FEATURES) - 2)
    total, mask = sum(map(marks.__getitem__, words)), (1 << 40) - 1
    upper, letters, digits, bare = total & mask, total >> 40 & mask, total >> 80 & mask, total >> 120
    chars = max(1, len(text))
    counts = Counter(words)
    distinct = counts.keys()
    windows = max(1, n - 2)
    repeated = 1 - len(set(zip(words, words[1:], words[2:]))) / windows if n > 2 else 0.0
    lines = [x for x in text.split("\n") if x.strip()]
    symbols = sum(map(text.count, "#*$%&|<>{}~^\\"))
    top = max(counts.values()) / n if n > 10 else 0.0
    return [
        np.log1p(n) / 10,
        float(n < 10),
        min(2.0, symbols / n),
        min(2.0, text.count("!") / n),
        upper / max(1, letters),
        bare / n,
        digits / chars,
        len(distinct) / n ** 0.9 if n > 30 else 1.0,
        repeated,
        top,
        1 - len(set(lines)) / max(1, len(lines)),
        min(3.0, chars / n / 6),
        sum(len(w) > 40 for w in distinct) / n,
        min(2.0, len(lines) / n),
    ]


def feature_maker():
    marks = BoundedCache(_marks)

    def make(texts):
        out = [features_of(t, marks) for t in texts]
        marks.trim()
        return {"features": out}

    return make


@dataclass(frozen=True)
class Ranker:
    """score = 1 / (1 + exp(-(w·x - threshold))); threshold is a quantile of the training rows' w·x."""

    weights: tuple[float, ...]
    threshold: float
    quantile: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.asarray(x, float).reshape(-1, len(self.weights)) @ np.array(self.weights) - self.threshold
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _pair_sums(good: np.ndarray, bad: np.ndarray, w: np.ndarray, penalty: float) -> tuple[float, np.ndarray, np.ndarray]:
    """The mean of log(1 + exp(-w·(better - worse))) over every pair, plus penalty |w|², with its gradient and Hessian.

    Pairs are taken a block at a time. Sums over a block's pairs are sums over its rows, weighted by the row and column sums
    of the pairs' probabilities.
    """
    loss, gradient, hessian = 0.0, np.zeros(len(w)), np.zeros((len(w), len(w)))
    zb, bad32 = (bad @ w).astype(np.float32), bad.astype(np.float32)
    for at in range(0, len(good), PAIR_ROWS):
        part = good[at : at + PAIR_ROWS]
        p = (part @ w).astype(np.float32)[:, None] - zb[None, :]  # w·(better - worse)
        np.clip(p, -80, 80, out=p)
        np.exp(p, out=p)
        p += 1
        np.reciprocal(p, out=p)  # the probability that the pair is the other way round
        loss -= float(np.log1p(-np.minimum(p, np.float32(1 - 1e-7))).sum(dtype=np.float64))
        gradient += p.sum(0, dtype=np.float64) @ bad - p.sum(1, dtype=np.float64) @ part
        p -= p * p
        mixed = part.T @ (p @ bad32)
        hessian += (part.T * p.sum(1, dtype=np.float64)) @ part + (bad.T * p.sum(0, dtype=np.float64)) @ bad - mixed - mixed.T
    n = len(good) * len(bad)
    return loss / n + penalty * float(w @ w), gradient / n + 2 * penalty * w, hessian / n + 2 * penalty * np.eye(len(w))


def fit(x: np.ndarray, labels: np.ndarray, penalty: float = 1e-3, warm_rows: int = 1000, tolerance: float = 1e-4) -> Ranker:
    """Fit by Newton's method on the mean of log(1 + exp(-w·(better - worse))) + penalty |w|² over every pair of a good and a bad row.

    The first steps run on the pairs of at most warm_rows rows of each class, evenly spread, to start near the end; the steps
    after them take every pair. A step is halved until the loss does not grow, and the last is one that moves no weight by
    more than the tolerance (times the greatest weight).
    With one class only (or no rows) there are no pairs: weights 0 and a threshold that gives every text that class
    (0.5 without rows). The threshold is the quantile of training scores with the fewest errors (the middle of ties).
    """
    x, labels = np.asarray(x, float).reshape(-1, len(FEATURES)), np.asarray(labels, int)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return Ranker(tuple(w), 0.0 if len(good) == len(bad) else -2.0 if len(good) else 2.0, 0.0)
    spread = lambda rows: rows[np.linspace(0, len(rows) - 1, min(len(rows), warm_rows)).astype(int)]
    for one, two in ((x[spread(good)], x[spread(bad)]), (x[good], x[bad])):
        loss, gradient, hessian = _pair_sums(one, two, w, penalty)
        moving = True
        while moving:
            step = np.linalg.solve(hessian, gradient)
            moving = np.abs(step).max() > tolerance * max(1.0, np.abs(w).max())
            while moving:
                new = _pair_sums(one, two, w - step, penalty)
                if new[0] <= loss:
                    w, (loss, gradient, hessian) = w - step, new
                    break
                step = step / 2
                moving = np.abs(step).max() > tolerance * max(1.0, np.abs(w).max())
    s = x @ w
    order = np.argsort(s, kind="stable")
    # errors if the first k rows of the order are predicted 0
    errors = np.concatenate([[0], np.cumsum(np.where(labels[order] == 1, 1, -1))]) + len(bad)
    cuts = np.concatenate([[True], s[order][1:] > s[order][:-1], [True]])  # never between equal scores
    best = np.flatnonzero(cuts & (errors == errors[cuts].min()))
    k = int(best[len(best) // 2])
    ranked = s[order]
    threshold = ranked[0] - 1 if k == 0 else ranked[-1] + 1 if k == len(s) else (ranked[k - 1] + ranked[k]) / 2
    return Ranker(tuple(w), float(threshold), k / len(s))


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", key: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED) -> Ranker:
    """Fit on at most `max_labelled` labelled rows, those with the least hash of their id (a stated, bounded sample).

    usable: condition on the label rows' key. Rows with a null key or label take no part; of repeated labels the least
    counts. The chosen label rows are bounded by max_labelled, so they are broadcast.
    """
    chosen = (
        labels.select(F.col(key).alias("__key"), F.col(label).alias("__label"))
        .where(F.col("__key").isNotNull() & F.col("__label").isNotNull())
        .groupBy("__key").agg(F.min("__label").alias("__label"))
        .withColumn(key, F.col("__key")).where(usable).drop(key)
        .orderBy(F.xxhash64("__key"), "__key").limit(max_labelled)
    )
    joined = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__key")
    rows = map_texts(joined, feature_maker, [("features", T.ArrayType(T.DoubleType()))], "__text", ["__key", "__label"])
    got = rows.orderBy(F.xxhash64("__key"), "__key", "features").limit(max_labelled).select("__label", "features").collect()
    return fit(np.array([r[1] for r in got], float), np.array([r[0] for r in got], int))


def score(docs: DataFrame, model: Ranker, text: str = "text", cutoff: float = 0.5) -> DataFrame:
    """Add score (0 to 1; null and empty texts too) and predicted (1 where score >= cutoff) to every row.

    Input columns of these names give way; the others stay, and repeated rows stay.
    """

    def make():
        features = feature_maker()

        def run(texts):
            s = model.scores(features(texts)["features"])
            return {"score": s, "predicted": (s >= cutoff).astype("int32")}

        return run

    return map_texts(docs, make, [("score", T.DoubleType()), ("predicted", T.IntegerType())], text)
