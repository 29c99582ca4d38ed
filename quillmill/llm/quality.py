"""Quality scores by positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives and unlabelled texts are enough: labels of bad texts are never read. With class prior c, the risk
of a scorer g under the logistic loss is  c R_p(g, 1) + max(0, R_u(g, 0) - c R_p(g, 0)).  The prior is estimated
from the two samples: the smallest ratio, over score thresholds, of the share of unlabelled texts above it to the
share of positives above it, with a margin for the size of the samples. The scorer is a logistic function of dense
statistics of the whole text, so a score is the estimated probability of a good text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import plus, ship, staged

_SYMBOLS = np.frombuffer(b"#*$%&|<>@^~_=+\\/{}[]", np.uint8)
_STOPS = np.frombuffer(b".,;:", np.uint8)
_MARKS = np.frombuffer(b"!?", np.uint8)


def features_of(text: str | None) -> np.ndarray:
    """Statistics of a whole text; those of an empty one are zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.zeros(16, np.float32)
    n, size = len(words), len(raw)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    distinct, repeats = len(set(words)), sum(map(eq, words, words[1:]))
    letters = seen[65:91].sum() + seen[97:123].sum() + seen[128:].sum()
    return np.array(
        [
            math.log(n), math.log(size / n), math.log(distinct), distinct / n, repeats / n, seen[65:91].sum() / size, seen[48:58].sum() / size, letters / size,
            min(4, seen[_SYMBOLS].sum() / n), min(2, seen[_MARKS].sum() / n), min(2, seen[_STOPS].sum() / n), min(2, seen[124] / n), min(1, seen[10] / n), seen[128:].sum() / size, seen.max() / size, math.log(n) * distinct / n,
        ],
        np.float32,
    )


def features(text: Column) -> Column:
    """The statistics as bytes of 32-bit floats: one small binary value a row."""

    @F.pandas_udf("binary")
    def measured(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([features_of(t).tobytes() for t in batch], dtype=object)

    return measured(text)


def _matrix(values) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float32).reshape(len(values), -1).astype(np.float64)


@dataclass
class Scorer:
    """A fitted logistic scorer; without weights each text gets the prior."""

    prior: float
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.spread, -6, 6)
        return np.hstack([z, np.abs(z), np.ones((len(z), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.design(x) @ self.weights, -30, 30)))


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, sure: float = 0.05) -> float:
    """The share of positives among the unlabelled, from scores of both samples."""
    cuts = np.unique(np.quantile(positive, np.linspace(0, 0.98, 99)))
    above_p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    margin = math.sqrt(math.log(4 / sure) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    best = np.argmin((above_u + margin) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.02, 0.98))


def _fitted(p: np.ndarray, u: np.ndarray, prior: float, steps: int, rate: float, decay: float) -> np.ndarray:
    """Weights that minimise the non-negative risk by adaptive gradient steps over both samples at once."""
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    w, m, v = np.zeros(p.shape[1]), np.zeros(p.shape[1]), np.zeros(p.shape[1])
    for t in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        grad_positive = prior * (p * (sigmoid(zp) - 1)[:, None]).mean(0)
        grad_negative = (u * sigmoid(zu)[:, None]).mean(0) - prior * (p * sigmoid(zp)[:, None]).mean(0)
        grad = (grad_positive + grad_negative if negative >= 0 else -grad_negative) + decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 400, rate: float = 0.05, decay: float = 1e-3) -> Scorer:
    if not len(positive) or not len(unlabelled):
        return Scorer(0.5)
    centre, spread = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    scorer = Scorer(0.5, centre, spread)
    p, u = scorer.design(positive), scorer.design(unlabelled)
    first = _fitted(p, u, 0.5, steps // 2, rate, decay)  # tells the two samples apart, for the prior
    scorer.prior = estimated_prior(p @ first, u @ first)
    scorer.weights = _fitted(p, u, scorer.prior, steps, rate, decay)
    return scorer


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the key as text, modulo 5, is 0. A null key is kept from it."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def score_quality(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", cut: float = 0.3, sample: int = 20_000) -> DataFrame:
    """df with held_out, score (0 to 1) and predicted (1 from `cut` on).

    Positives are rows of df that have the label 1 and are not held out; unlabelled are rows of df. At most
    `sample` of each, the first by a hash of the key, are fitted; every row is scored by its whole text. A null or
    empty text is scored like a text whose statistics are zeros. Without positives each score is 0.5. Null labels and
    null keys are not learned from; repeated rows are scored alike; an empty table gives an empty one. Columns of df
    with a name of the result are replaced. One pass over the texts.
    """
    ship(df.sparkSession)
    rows = staged(plus(df, _features=features(df[f"`{text}`"])), "quality")
    return _scored(rows, labels, key, label, cut, sample)


def _place() -> Column:
    """A place in [0, 1) by a hash of the key."""
    return F.pmod(F.xxhash64(F.lit("fit"), "k"), F.lit(1 << 31)) / float(1 << 31)


def _low(rows: DataFrame, most: int) -> DataFrame:
    """The rows with the lowest places, about `most` of them; so no task sends more than its share to the driver."""
    return rows.where(_place() < most / max(1, rows.count()))


def _first(rows: DataFrame, sample: int) -> list:
    return rows.orderBy(_place(), "k", "_features").limit(sample).select("_features").collect()


def _scored(rows: DataFrame, labels: DataFrame, key: str, label: str, cut: float, sample: int) -> DataFrame:
    keyed = rows.select(rows[f"`{key}`"].alias("k"), "_features").where("k IS NOT NULL")
    good = labels.where(labels[f"`{label}`"] == 1).select(labels[f"`{key}`"].alias("k")).where("k IS NOT NULL").where(~held_out(F.col("k"))).distinct()
    positive = _first(keyed.join(_low(good, 4 * sample), "k", "left_semi"), sample)
    unlabelled = _first(_low(keyed, 2 * sample), sample)
    scorer = fit(*(_matrix([r[0] for r in x]) if x else np.zeros((0, 16)) for x in (positive, unlabelled)))
    shared = rows.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def scores(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in values:
            yield pd.Series(shared.value.score(_matrix(list(batch))) if len(batch) else [], dtype="float64")

    out = plus(rows, held_out=held_out(rows[f"`{key}`"]), score=scores(rows["_features"])).drop("_features")
    return plus(out, predicted=(out.score >= cut).cast("int"))


def keep_good(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", cut: float = 0.3, sample: int = 20_000) -> DataFrame:
    """The rows of df that score_quality predicts to be good, with the columns of df."""
    if {"held_out", "score", "predicted", "_features"} & {c.lower() for c in df.columns}:
        kept = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
        return score_quality(kept, labels.withColumnRenamed(key, "k"), "k", "t", label, cut, sample).where("predicted = 1").select("_row.*")
    return score_quality(df, labels, key, text, label, cut, sample).where("predicted = 1").select(*[f"`{c}`" for c in df.columns])
