"""Quality classifier: Bradley-Terry pairwise ranking of documents.

A document's worth is a linear function of features of its text. Pairs (better, worse) of labelled documents are
learnt by logistic loss on the difference of their features, which is the Bradley-Terry model with a linear worth. A
quantile of the worths of the training documents then becomes the threshold, and the logistic function of the distance
to it the score.

Nulls and empty texts have the features of an empty text and so a score as any other; repeated rows score alike, and so
do ties. Without rows of both classes every text gets one score; an empty table of documents gives no rows. Texts are
read whole. A column named as the score is replaced, all others are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import labelled_sample

#: Training rows of each class, at most; pairs drawn in all; step size and rounds of the fit; penalty on weights.
PER_CLASS, PAIRS, ROUNDS, STEP, RIDGE = 4000, 40_000, 400, 0.5, 1e-3

_UPPER, _LOWER, _DIGIT, _SPACE, _HIGH = range(5)
_CLASS = np.full(256, 9, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[[9, 10, 11, 12, 13, 32]], _CLASS[128:] = _UPPER, _LOWER, _DIGIT, _SPACE, _HIGH
_MARKS = (b"!", b"|", b"#", b"$", b"%", b"&", b"*", b"<", b"{", b"=", b"_", b"@", b"/", b".", b",", b"\n")
_VOWELS = np.zeros(256, bool)
_VOWELS[[ord(c) for c in "aeiouyAEIOUY"]] = True


def features(text: str | None) -> list[float]:
    """Shares of kinds of characters and marks, word shapes, and repetition at the level of words and lines."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = len(raw)
    code = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(_CLASS[code], minlength=10) / max(n, 1)
    words = raw.split()
    k = len(words)
    lower = raw.lower().split()
    size = np.fromiter(map(len, words), np.int64, k) if k else np.zeros(1, np.int64)
    distinct = len(set(lower))
    same = sum(a == b for a, b in zip(lower, lower[1:]))
    pairs = list(zip(lower, lower[1:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = kinds[_UPPER] + kinds[_LOWER] + kinds[_HIGH]
    ends = sum(w[-1:].isalnum() or w[-1] > 127 for w in words) / max(k, 1)
    caps = sum(w.isupper() and len(w) > 1 for w in words) / max(k, 1)
    return [
        *kinds[[_UPPER, _LOWER, _DIGIT, _SPACE, _HIGH, 9]],
        *(min(raw.count(m) / max(k, 1), 2.0) for m in _MARKS),
        kinds[_UPPER] / max(letters, 1e-6) if letters else 0.0,
        np.log1p(k) / 10,
        min(size.mean(), 40) / 10,
        min(size.std(), 40) / 10,
        min(size.max(), 200) / 50,
        distinct / max(k, 1),
        distinct / max(k, 1) ** 0.7,
        same / max(k, 1),
        len(set(pairs)) / max(len(pairs), 1),
        len(set(lines)) / max(len(lines), 1),
        min(len(lines) / max(k, 1), 1.0),
        ends,
        caps,
        float(_VOWELS[code].mean()) if n else 0.0,
        float(k == 0),
        float(0 < k < 5),
    ]


@dataclass(frozen=True)
class BradleyTerry:
    """Weights of the worth on standardised features, the threshold and the scale of the score."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float
    quantile: float

    def worth(self, x: np.ndarray) -> np.ndarray:
        """The worth of each row of features; standardised features are held within 6 deviations."""
        return np.clip((x - self.mean) / self.spread, -6, 6) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.worth(x) - self.threshold) * self.scale, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> BradleyTerry:
    """Learn worths from random (better, worse) pairs; the threshold is the best of the quantiles of training worths.

    With one class only, or no rows, every document gets the same worth; the score is then 0.5 throughout, or the
    lone class's side of it.
    """
    x = np.asarray(x, float).reshape(len(y), -1) if len(y) else np.zeros((0, len(features(""))))
    mean, spread = (x.mean(0), x.std(0)) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    spread = np.where(spread < 1e-9, 1.0, spread)
    better, worse = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(better) or not len(worse):
        side = 0.0 if not len(y) else (-1.0 if y[0] == 1 else 1.0)
        return BradleyTerry(mean, spread, np.zeros(x.shape[1]), side, 2.0, 0.5)
    z = np.clip((x - mean) / spread, -6, 6)
    draw = np.random.default_rng(seed)
    diff = z[draw.choice(better, pairs)] - z[draw.choice(worse, pairs)]
    w, momentum = np.zeros(z.shape[1]), np.zeros(z.shape[1])
    for _ in range(ROUNDS):
        pull = 1 / (1 + np.exp(np.clip(diff @ w, -40, 40)))
        momentum = 0.9 * momentum + pull @ diff / pairs - RIDGE * w
        w = w + STEP * 0.2 * momentum
    worth = z @ w
    best = max((((worth >= (t := np.quantile(worth, q))) == y)[y == 0].mean() / 2 + ((worth >= t) == y)[y == 1].mean() / 2, -abs(q - len(worse) / len(y)), q) for q in np.linspace(0.005, 0.995, 199))[2]
    low = worth[y == 0]
    high = worth[y == 1]
    threshold = float(np.quantile(worth, best))
    below, above = worth[worth < threshold], worth[worth >= threshold]
    if len(below) and len(above):  # the quantile falls between two documents; halve the gap
        threshold = float((below.max() + above.min()) / 2)
    return BradleyTerry(mean, spread, w, threshold, float(4 / max(np.median(high) - np.median(low), 1e-6)), float(best))


def feature_column(text: Column | str) -> Column:
    """Features of each text, in Arrow batches."""

    @F.pandas_udf(ArrayType(DoubleType()))
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(features(t), float) for t in texts])

    return of(text)


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, per_class: int = PER_CLASS) -> BradleyTerry:
    """Fit on at most per_class labelled rows of each class, none of them held out; texts stay on the executors."""
    rows = labelled_sample(docs, labels, "quality", modulus, held_out, per_class)
    got = rows.select("doc_id", "label", feature_column("text").alias("x")).toPandas().sort_values("doc_id")
    return fit(np.stack(got.x.to_numpy()) if len(got) else np.zeros((0, 1)), got.label.to_numpy())


def score_column(model: BradleyTerry, text: Column | str) -> Column:
    """The score of each text, from 0 to 1."""

    @F.pandas_udf(DoubleType())
    def of(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.array([features(t) for t in texts])))

    return of(text)


def score_quality(docs: DataFrame, model: BradleyTerry, text: str = "text", score: str = "score") -> DataFrame:
    """All rows and columns of docs with a column of scores, which replaces one of that name."""
    return docs.withColumn(score, score_column(model, text))


def keep_quality(docs: DataFrame, model: BradleyTerry, text: str = "text", at_least: float = 0.5) -> DataFrame:
    """The rows whose score is at_least or more, with the columns they had."""
    return docs.where(score_column(model, text) >= at_least)


def query(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    scored = score_quality(docs.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
