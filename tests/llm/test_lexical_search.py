import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tallyline.llm import lexical_search as S
from util import docs_frame, empty, words


def brute(docs, items, k=20):
    """[(item, rank, doc, score)] by scoring every document in full."""
    own = [(d, words(t)) for d, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in own), sum(len(w) for _, w in own)
    counts = [Counter(w) for _, w in own]
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for (d, w), c in zip(own, counts):
            if not w:
                continue
            m = 75 + 25 * len(w) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in words(text) if c[t])
            if s > 0:
                scores.append((-s, d is None, d, s))
        scores.sort(key=lambda x: x[:2] + (x[2] or 0,))
        out += [(item, r, x[2], x[3]) for r, x in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def ask(docs, items, **options):
    return sorted((tuple(r) for r in S.search(docs, items, **options).collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(12)
    vocab = [f"v{i}" for i in range(60)] + ["É", "ß", "x9"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    docs = [(i, " ".join(rng.choices(vocab, weights, k=rng.choice([0, 1, 5, 30, 200])))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(30)] + [(2000, None), (2001, "..."), (None, docs[5][1])]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 2, 8, 40])))) for i in range(25)]
    items += [(90, docs[3][1]), (91, None), (92, ""), (93, "nowhere to be found"), (None, "v1 V1 v2"), (94, "v1 " * 50)]
    return docs, items


@pytest.mark.parametrize("block", [8192, 37])
@pytest.mark.parametrize("group_bytes", [S.GROUP_BYTES, 400])            # one group of queries, and many
def test_against_full_scores(ready, corpus, monkeypatch, block, group_bytes):
    monkeypatch.setattr(S, "BLOCK_DOCS", block)
    docs, items = corpus
    d = ready.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = ready.createDataFrame(items, "item_id long, text string")
    assert ask(d, q, group_bytes=group_bytes) == brute(docs, items)
    if block == 37:
        assert ask(d, q, k=3, group_bytes=group_bytes) == brute(docs, items, 3)


def test_reading_stops_early_with_exact_bounds():
    """Documents that cannot reach the k-th lower bound are left before the lists' ends, and scores stay exact."""
    rng = np.random.default_rng(4)
    docs, terms = 3000, 12
    held = rng.random((docs, terms)) < 0.3
    held[:5] = True
    tf = np.where(held, rng.integers(1, 4, (docs, terms)), 0)
    tf[:5] = 60
    lengths = np.full(docs, 100)
    rows, cols = np.nonzero(held)
    weights = rng.integers(100, 9000, terms)
    block = S.Block(list(range(docs)), lengths, held.sum(1), cols.astype(np.int32), tf[rows, cols], weights, docs, 100 * docs)
    m = 75 + 25 * lengths * docs // (100 * docs)
    full = (weights * (S.SCALE * tf // (1000 * tf + 12 * m[:, None]))).sum(1)
    got = block.best([(t, 1) for t in range(terms)], 5)
    assert got == sorted(((i, int(full[i])) for i in range(docs)), key=lambda x: (-x[1], x[0]))[:5]
    order = [block.entries(t)[1] for t in range(terms)]
    assert all((np.diff(x) <= 0).all() for x in order)                   # impact-sorted


def test_edges(ready):
    docs, items = docs_frame(ready), [(1, "one two three"), (2, "w1 w2 w976"), (2, "same text"), (2, "same text"), (3, None)]
    q = ready.createDataFrame([(i, t, 7, "x") for i, t in items], "item_id long, text string, score int, rank string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, items[:3])
    assert ask(docs, q) == want                                          # equal queries are one; clashing columns
    assert S.search(empty(ready), q).count() == 0 and S.search(docs, q.limit(0)).count() == 0


def test_a_document_that_a_third_of_all_rows_are(ready):
    d = ready.range(0, 6000, 1, 4).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"),
                                          F.when(F.col("id") % 3 == 0, "alpha beta").otherwise(F.concat(F.lit("alpha "), "id")).alias("text"))
    q = ready.createDataFrame([(1, "beta alpha")], "item_id long, text string")
    got = S.search(d, q).collect()
    assert [r.doc_id for r in got] == [5] * 20 and len({r.score for r in got}) == 1 and sorted(r.rank for r in got) == list(range(1, 21))
