"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into chunks of CHUNK bytes that overlap by STEP
bytes.  Bytes are embedded and FILTERS learned filters of width 8 slide over
each chunk in steps of STEP = 4 bytes, so windows start at every fourth byte of
the whole text, and each of those lies in some chunk.  Filters are max-pooled
per chunk; the mean and the maximum over a document's chunks go into one
logistic unit.  Back-propagation follows the pooled maxima only, so a training
step is cheap.

Training takes at most TRAIN_ROWS labelled rows and TRAIN_BYTES of text (both
documented bounds) in one executor task; scoring reads every whole text.  Both
convolve at most SLICE chunks at a time, whatever the texts' lengths: 15 MB of
intermediate arrays.  Beside those a worker holds, per chunk of the batch of
texts in hand (scoring: 4 MB or one text; training: BATCH_DOCS texts), the
chunk's bytes and 24 pooled numbers, in training also the 24 windows they come
from: 0.6 and 0.9 kB for half a kB of text.

Defined results: null and empty text are one chunk of zero bytes and score
what the network says of it.  With no labelled rows the score is 0.5 for all.
Rows are scored one by one, so repeated rows get equal scores and no ties are
broken.  A text of any length is scored whole.  Only the columns named are read,
so extra columns of any name do no harm.
"""

import io
from collections.abc import Callable
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from .common import map_texts, tidy
from .training import fit_in_one_task, labelled

STEP, EMBED, FILTERS = 4, 6, 24
WIDTH = 2 * STEP                      # a filter spans two steps
CHUNK = 512
TRAIN_ROWS, TRAIN_BYTES, EPOCHS = 4096, 24_000_000, 6
BATCH_DOCS, RATE, SEED = 64, 0.01, 11
SLICE = 256                           # chunks convolved at a time


def chunks(text: bytes | None) -> np.ndarray:
    """(n, CHUNK) bytes: chunks overlapping by STEP, zero-padded at the end."""
    raw = np.frombuffer(text or b"", np.uint8)
    n = max(1, -(-(len(raw) - STEP) // (CHUNK - STEP)))
    padded = np.zeros(n * (CHUNK - STEP) + STEP, np.uint8)
    padded[:len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::CHUNK - STEP]


def _convolve(x: np.ndarray, emb: np.ndarray, w: np.ndarray) -> np.ndarray:
    """(n, windows, filters).  w: (2 * STEP * EMBED, filters); a window is two neighbouring blocks of STEP bytes."""
    blocks = emb[x].reshape(len(x), CHUNK // STEP, STEP * EMBED)
    half = STEP * EMBED
    return (blocks @ w[:half])[:, :-1] + (blocks @ w[half:])[:, 1:]


def _pool(x, p):
    return _convolve(x, p["emb"], p["w"]).max(axis=1) + p["b"]


def _init(rng: np.random.Generator) -> dict[str, np.ndarray]:
    return {"emb": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "w": rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32),
            "b": np.zeros(FILTERS, np.float32),
            "v": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), "c": np.zeros(1, np.float32)}


def _slices(n: int) -> list[slice]:
    return [slice(i, min(i + SLICE, n)) for i in range(0, n, SLICE)]


def _gradients(p, x, first, y):
    """Gradients of the mean logistic loss; `first`: each document's first row in x."""
    n = np.diff(np.append(first, len(x)))
    own = np.repeat(np.arange(len(first)), n)
    h = np.empty((len(x), FILTERS), p["w"].dtype)
    seen = np.empty((len(x), FILTERS, WIDTH), np.uint8)                  # the bytes under each pooled maximum
    for k in _slices(len(x)):
        conv = _convolve(x[k], p["emb"], p["w"])
        at = conv.argmax(axis=1)
        h[k] = np.maximum(np.take_along_axis(conv, at[:, None], 1)[:, 0] + p["b"], 0)
        seen[k] = np.take_along_axis(x[k], (at * STEP).repeat(WIDTH, 1) + np.tile(np.arange(WIDTH), FILTERS), 1) \
            .reshape(-1, FILTERS, WIDTH)
    mean, top = np.add.reduceat(h, first) / n[:, None], np.maximum.reduceat(h, first)
    logit = np.hstack([mean, top]) @ p["v"] + p["c"]
    d = (1 / (1 + np.exp(-np.clip(logit, -35, 35))) - y) / len(y)
    g = {"v": np.hstack([mean, top]).T @ d, "c": np.array([d.sum()]), "b": np.zeros(FILTERS),
         "w": np.zeros(p["w"].shape), "emb": np.zeros(p["emb"].shape)}
    for k in _slices(len(x)):
        doc = own[k]
        dh = (d / n)[doc, None] * p["v"][:FILTERS] + d[doc, None] * p["v"][FILTERS:] * (h[k] == top[doc])
        dh = (dh * (h[k] > 0)).astype(np.float32)
        g["b"] += dh.sum(0)
        e = p["emb"][seen[k]].reshape(len(doc), FILTERS, WIDTH * EMBED)
        g["w"] += np.einsum("nf,nfk->kf", dh, e)
        back = (dh[:, :, None] * p["w"].T[None]).reshape(-1, EMBED)
        g["emb"] += np.stack([np.bincount(seen[k].ravel(), back[:, i], 256) for i in range(EMBED)], 1)
    return g


def fit(rows: list[tuple[bytes, int]], epochs: int = EPOCHS) -> bytes:
    """Train with Adam; the parameters as .npz bytes."""
    rng = np.random.default_rng(SEED)
    p = _init(rng)
    if not rows:
        p["v"][:] = 0
    data = [chunks(t) for t, _ in rows]
    y = np.array([v for _, v in rows], np.float64)
    m = {k: np.zeros(v.shape) for k, v in p.items()}
    s = {k: np.zeros(v.shape) for k, v in p.items()}
    t = 0
    for epoch in range(epochs if rows else 0):
        order = rng.permutation(len(rows))
        for i in range(0, len(rows), BATCH_DOCS):
            ids = order[i:i + BATCH_DOCS]
            first = np.cumsum([0, *(len(data[j]) for j in ids[:-1])])
            g = _gradients(p, np.concatenate([data[j] for j in ids]), first, y[ids])
            t += 1
            rate = RATE * (1 - epoch / epochs)
            for k in p:
                m[k] += 0.1 * (g[k] - m[k])
                s[k] += 0.001 * (g[k] ** 2 - s[k])
                p[k] -= (rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    out = io.BytesIO()
    np.savez(out, **p)
    return out.getvalue()


def scorer(model: bytes) -> Callable[[list], list]:
    p = dict(np.load(io.BytesIO(model)))

    def batch(texts):
        parts = [chunks(t) for t in texts]
        first = np.cumsum([0, *(len(c) for c in parts[:-1])])
        h = np.empty((sum(map(len, parts)), FILTERS), np.float32)
        held = np.empty((SLICE, CHUNK), np.uint8)
        done = n = 0
        for c in parts:                                     # slices are filled across texts, never over SLICE chunks
            at = 0
            while at < len(c):
                more = min(SLICE - n, len(c) - at)
                held[n:n + more] = c[at:at + more]
                at, n = at + more, n + more
                if n == SLICE:
                    h[done:done + n] = _pool(held, p)
                    done, n = done + n, 0
        if n:
            h[done:] = _pool(held[:n], p)
        h = np.maximum(h, 0)
        count = np.diff(np.append(first, len(h)))
        both = np.hstack([np.add.reduceat(h, first) / count[:, None], np.maximum.reduceat(h, first)])
        return [(1 / (1 + np.exp(-np.clip(both.astype(np.float64) @ p["v"] + p["c"], -35, 35)))).tolist()]

    return lambda texts: batch(texts) if texts else [[]]


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = TRAIN_ROWS,
          max_bytes: int = TRAIN_BYTES) -> bytes:
    return fit_in_one_task(labelled(docs, labels, label_col, rows, max_bytes), fit)


def score_column(spark: SparkSession, model: bytes, text: Column) -> Column:
    """The score as a column expression, so that a filter moves only the text to Python."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tidy()
        fn = scorer(shared.value)
        for s in batches:
            yield pd.Series(fn(s.tolist())[0], dtype="float64")

    return run(text.cast("string").cast("binary"))


def score(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.3) -> DataFrame:
    """(id, score, predicted) for every row of `df`."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    out = map_texts(df, [id_col], text_col, [StructField("score", DoubleType())], lambda: scorer(shared.value))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
