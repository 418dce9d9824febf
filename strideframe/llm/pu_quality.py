"""Text quality by positive-unlabelled learning.

Trusted positives are labelled rows of good quality; the unlabelled set is a sample of
labelled rows whose labels are not looked at. With the class prior p, the share of good
rows among all labelled ones, the classifier minimises the non-negative unbiased risk

    p * E_pos[loss(+)] + max(0, E_unl[loss(-)] - p * E_pos[loss(-)])

by gradient steps; where the second part turns negative, a step goes the other way,
which keeps the model from fitting the unlabelled rows as negatives. The loss is
logistic, so the output is a probability.

Features are shares of a text: its word shapes, hashed, and a few counts. The model
is fitted on samples of bounded size; every whole text is scored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm.common import bounded_sample, cut, without
from strideframe.llm.toxicity import fold

#: Labelled rows in each fitting sample, by the hash of their id.
POSITIVE_ROWS = 6_000
UNLABELLED_ROWS = 12_000
SHAPE_BUCKETS = 256
HELD_OUT = fold(3, 1)

_SHAPE = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else 32 if b in b" \t\n\x0b\f\r" else b for b in range(256)
)
COUNTS = 14
SIZE = SHAPE_BUCKETS + COUNTS


def shapes(text: str) -> list[bytes]:
    """Words as shapes: letters a or A, digits 0, and repeats of a sign once."""
    raw = np.frombuffer(text.encode().translate(_SHAPE), dtype=np.uint8)
    if not len(raw):
        return []
    keep = np.ones(len(raw), dtype=bool)
    keep[1:] = raw[1:] != raw[:-1]
    return raw[keep].tobytes().split()


def vector(text: str | None) -> np.ndarray:
    """Features of a whole text, null as empty."""
    text = text or ""
    out = np.zeros(SIZE, dtype=np.float32)
    words = text.split()
    n = max(len(words), 1)
    own = shapes(text)
    for shape, k in Counter(own).items():
        out[zlib.crc32(shape) % SHAPE_BUCKETS] += math.sqrt(k / max(len(own), 1))
    raw = text.encode()
    size = max(len(raw), 1)
    kinds = Counter(raw.translate(_SHAPE))
    lines = text.split("\n")
    out[SHAPE_BUCKETS:] = (
        kinds[65] / size,
        kinds[97] / size,
        kinds[48] / size,
        kinds[32] / size,
        1 - (kinds[65] + kinds[97] + kinds[48] + kinds[32]) / size,
        len(set(words)) / n,
        len(set(lines)) / len(lines),
        sum(map(len, words)) / n / 10,
        math.log1p(len(words)) / 10,
        math.log1p(len(lines)) / 5,
        n / len(lines) / 100,
        Counter(words).most_common(1)[0][1] / n if words else 0.0,
        float(len(words) < 20),
        float(not words),
    )
    return out


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.02, ridge: float = 1e-3, seed: int = 7) -> QualityModel:
    """Minimise the non-negative risk with Adam over mini-batches."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    rng = np.random.default_rng(seed)
    w, m, v = (np.zeros(p.shape[1] + 1) for _ in range(3))
    w[-1] = math.log(prior / (1 - prior))
    size = 1024

    def grads(x: np.ndarray, sign: float) -> tuple[float, np.ndarray]:
        z = np.clip(x @ w[:-1] + w[-1], -30, 30)
        pull = -sign / (1 + np.exp(sign * z))
        return float(np.logaddexp(0, -sign * z).mean()), np.append(x.T @ pull, pull.sum()) / len(x)

    for t in range(1, steps + 1):
        a = p[rng.integers(0, len(p), min(size, len(p)))]
        b = u[rng.integers(0, len(u), min(size, len(u)))]
        _, plus = grads(a, 1.0)
        as_negative, minus = grads(a, -1.0)
        among, of_unlabelled = grads(b, -1.0)
        negative_part = of_unlabelled - prior * minus
        g = prior * plus + negative_part if among - prior * as_negative >= 0 else -negative_part
        g = g + ridge * np.append(w[:-1], 0.0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (0.5 * (1 + math.cos(math.pi * t / steps)))
        w = w - step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return QualityModel(mean, scale, w[:-1], float(w[-1]), prior)


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", held_out=HELD_OUT) -> QualityModel | None:
    """Fit on labelled rows outside the held-out fold: a sample of the positives, and a sample
    of all of them without their labels.

    None where there is no positive. The prior is the share of positives among all
    labelled rows of the fold, kept between 0.02 and 0.98.
    """
    named = labels.select(F.col(id).cast("long").alias("i"), F.col(label).cast("int").alias("y")).where("i IS NOT NULL AND y IS NOT NULL")
    named = cut(named.where(~held_out(F.col("i"))).groupBy("i").agg(F.max("y").alias("y")), "quality-labels")
    prior = named.agg(F.avg(F.col("y").cast("double"))).first()[0]
    if not prior:
        return None
    prior = min(max(prior, 0.02), 0.98)
    texts = docs.select(F.col(f"`{id}`").cast("long").alias("i"), F.col(f"`{text}`").alias("text")).where("i IS NOT NULL")
    plain = bounded_sample(named.select("i"), "i", UNLABELLED_ROWS)
    trusted = bounded_sample(named.where("y = 1").select("i"), "i", POSITIVE_ROWS)
    chosen = cut(
        plain.withColumn("trusted", F.lit(False)).unionByName(trusted.withColumn("trusted", F.lit(True))), "quality-sample-ids"
    )
    # at most UNLABELLED_ROWS + POSITIVE_ROWS rows
    sample = texts.join(F.broadcast(chosen), "i").select("trusted", _vectors("text").alias("x")).toPandas()
    x = np.stack([np.frombuffer(b, dtype=np.float32) for b in sample["x"]]).astype(np.float64) if len(sample) else np.zeros((0, SIZE))
    trust = sample["trusted"].to_numpy(dtype=bool)
    if not trust.any() or trust.all():
        return None
    return fit_pu(x[trust], x[~trust], prior)


def _vectors(text: str):
    @F.pandas_udf("binary")
    def vectors(texts: pd.Series) -> pd.Series:
        return pd.Series([vector(t).tobytes() for t in texts])

    return vectors(text)


def with_quality(docs: DataFrame, model: QualityModel | None, text: str = "text", score: str = "quality_score") -> DataFrame:
    """Add the probability of good quality in ``score``, written over a column of that name.

    Null and empty texts are scored as a text without words; without a model all get 0.5.
    """

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        if model is None or not len(texts):
            return pd.Series([0.5] * len(texts))
        out = [model.probability(np.stack([vector(t) for t in texts[i : i + 512]]).astype(np.float64)) for i in range(0, len(texts), 512)]
        return pd.Series(np.concatenate(out))

    value = probability(F.col(f"`{text}`"))
    return without(docs, score).select("*", value.alias(score)) if score != text else docs.withColumn(text, value)
