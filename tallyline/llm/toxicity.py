"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text: the set of its words, adjacent pairs and pairs with one
word between (skip-grams), hashed to 2^BITS places.  FTRL-proximal keeps a
learning rate per coordinate, and its L1 term leaves most weights exactly 0,
so the model is a short list of (place, weight) that is broadcast.

Training takes at most TRAIN_ROWS labelled rows and TRAIN_BYTES of text (both
documented bounds) in one executor task; scoring reads every whole text.

Defined results: null and empty text score the sigmoid of the bias.  With no
labelled rows at all, or one class only, the model still scores: the bias is
what FTRL makes of the rows seen, 0.5 for none.  Rows are scored one by one.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from .common import map_texts, words_of
from .training import fit_in_one_task, labelled

BITS = 20
TRAIN_ROWS, TRAIN_BYTES, EPOCHS = 8192, 48_000_000, 4
ALPHA, BETA, L1_PER_ROW, L2 = 1.0, 1.0, 0.003, 0.01
TOXIC_WEIGHT = 2.0                    # a toxic row counts as so many


def features(text: bytes | None) -> np.ndarray:
    """Hashed places of the words, adjacent pairs and skip-pairs, repeats included."""
    words = words_of(text)
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        a, b = h * np.uint64(0x9E3779B97F4A7C15), h * np.uint64(0xC2B2AE3D27D4EB4F)
        every = np.concatenate([a, a[:-1] + (b[1:] << np.uint64(1)), a[:-2] + (b[2:] << np.uint64(2)) + np.uint64(7)])
        every = every * np.uint64(0xD6E8FEB86659FD93)
    return (every >> np.uint64(64 - BITS)).astype(np.int64)


def fit(rows: list[tuple[bytes, int]], epochs: int = EPOCHS) -> bytes:
    """Train; the model as .npz bytes: places, weights, bias."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    data = [(np.unique(features(t)), float(y)) for t, y in rows]
    l1, bias_z, bias_n = L1_PER_ROW * len(rows), 0.0, 0.0

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(epochs):
        for at, y in data:
            w = weights(z[at], n[at])
            bias = -bias_z / ((BETA + bias_n ** 0.5) / ALPHA)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - y
            g *= TOXIC_WEIGHT if y else 1.0
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
            bias_z += g - ((bias_n + g * g) ** 0.5 - bias_n ** 0.5) / ALPHA * bias
            bias_n += g * g
    w = weights(z, n)
    places = np.flatnonzero(w)
    out = io.BytesIO()
    np.savez(out, places=places, weights=w[places], bias=-bias_z / ((BETA + bias_n ** 0.5) / ALPHA))
    return out.getvalue()


def scorer(model: bytes) -> Callable[[list], list]:
    m = np.load(io.BytesIO(model))
    dense, bias = np.zeros(1 << BITS), float(m["bias"])
    dense[m["places"]] = m["weights"]

    def one(text):
        at = features(text)
        at = np.unique(at[dense[at] != 0.0])                # few places carry a weight
        return float(1.0 / (1.0 + np.exp(-np.clip(dense[at].sum() + bias, -35, 35))))

    return lambda batch: [[one(t) for t in batch]]


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = TRAIN_ROWS,
          max_bytes: int = TRAIN_BYTES) -> bytes:
    return fit_in_one_task(labelled(docs, labels, label_col, rows, max_bytes), fit)


def score(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """(id, score, predicted) for every row of `df`."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    out = map_texts(df, [id_col], text_col, [StructField("score", DoubleType())], lambda: scorer(shared.value))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
