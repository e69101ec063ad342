import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tallyline.llm import minhash as M
from tallyline.llm.components import components
from util import docs_frame, empty, read, tokens


def shingle_set(text):
    w = tokens(text)
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def brute(rows):
    """{id: (n_shingles, component)} by comparing every pair that shares a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    index = {}
    for i, s in sets.items():
        for g in s:
            index.setdefault(g, []).append(i)
    near = {}
    for ids in index.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                near[a, b] = near.get((a, b), 0) + 1
    for (a, b), both in near.items():
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_shingles_count_distinct_windows():
    for t in (None, "", " \n", "a", "a b c", "A b c d", "a b c d a b c d a b c d", "x " * 50, "É É e\x0bf\x1cg h"):
        assert len(M.shingles(t.encode() if t is not None else None)) == len(shingle_set(t)), t


def test_small_table_against_brute_force(ready):
    rows = read("sf0.001", "documents")
    docs = ready.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(M.near_duplicates(docs)) == brute(list(zip(rows.doc_id, rows.text)))


@pytest.mark.parametrize("large", [M.LARGE_BUCKET, 3, 10**9])
def test_near_copies_against_brute_force(ready, monkeypatch, large):
    """Near copies of a few texts, from one edit to many: links, non-links just below 0.8, chains."""
    monkeypatch.setattr(M, "LARGE_BUCKET", large)
    rng = random.Random(8)
    rows = []
    for base in range(3):
        text = [f"b{base}w{rng.randrange(400)}" for _ in range(60 + 50 * base)]
        for k in range(90):
            w = list(text)
            for _ in range(rng.randrange(0, 9)):
                w[rng.randrange(len(w))] = rng.choice([f"n{rng.randrange(10**6)}", f"c{rng.randrange(3)}"])
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + k, rows[k][1].upper()) for k in range(5)]
    rows += [(1000, "tiny one"), (1001, "Tiny  one"), (1002, "tiny two"), (1003, ""), (1004, None)]
    rng.shuffle(rows)
    docs = ready.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(M.near_duplicates(docs)) == brute(rows)


def test_chain_of_links_is_one_component(ready):
    words = [f"w{i}" for i in range(100)]
    rows = [(k, " ".join([f"x{j}" for j in range(2 * k)] + words[2 * k:])) for k in range(30)]
    docs = ready.createDataFrame(rows, "doc_id long, text string")
    got = result(M.near_duplicates(docs))
    assert got == brute(rows) and {c for _, c in got.values()} == {0}


def test_signatures_estimate_jaccard():
    sign = M.signer()
    words = [f"q{i}" for i in range(203)]
    texts = [" ".join(words).encode(), " ".join(words[:183] + [f"z{i}" for i in range(20)]).encode()]
    a, b = (np.unpackbits(np.array(x, np.int64).view(np.uint8))[:M.LANES] for x in sign(texts)[3])
    assert abs((a != b).mean() - (1 - 180 / 220) / 2) < 0.08


def test_components(ready):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(500, 600)]
    pairs = [(min(p), max(p)) for p in pairs if p[0] != p[1]]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = components(ready.createDataFrame(pairs, "a long, b long"))
    assert {r.node: r.comp for r in got.collect()} == {x: find(x) for x in root}
    assert components(ready.createDataFrame([], "a long, b long")).count() == 0


def test_edges(ready):
    docs = docs_frame(ready)
    rows = M.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert (by[0].n_shingles, by[0].component_id, by[0].kept) == (0, 0, True)
    assert by[6].component_id == 5 and not by[6].kept          # equal texts
    assert by[12].component_id == 11                           # long near copy
    assert [r.kept for r in rows if r.doc_id == 4] == [True, True]
    null = [r for r in rows if r.doc_id is None]
    assert len(null) == 1 and null[0].component_id is None and null[0].kept and null[0].n_shingles == 4
    assert M.near_duplicates(empty(ready)).count() == 0


def test_one_text_a_third_of_all_rows(ready):
    docs = ready.range(3000).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 3 == 0, F.lit("the very same words in a row")).otherwise(
        F.concat_ws(" ", *(F.xxhash64("id", F.lit(i)).cast("string") for i in range(8)))).alias("text"))
    got = M.near_duplicates(docs)
    assert got.filter("component_id = 0").count() == 1000 and got.filter("kept").count() == 2001


def test_recall_just_above_the_threshold(ready):
    """800 planted pairs of Jaccard 0.80 to 0.82, each of its own words, with the one-bit filter and without."""
    import random
    rng, rows, pairs = random.Random(31), [], 0
    for p in range(800):
        n = rng.randrange(120, 400)
        own = [f"w{p}x{i}" for i in range(n)]
        other, at = list(own), rng.randrange(20, n - 20)
        while True:                                          # replace words one after another until the similarity is reached
            a, b = ({tuple(t[i:i + 4]) for i in range(len(t) - 3)} for t in (own, other))
            if 100 * len(a & b) <= 82 * len(a | b):
                break
            other[at], at = f"y{p}x{at}", at + 1
            if at == n:
                at = 0
        if 100 * len(a & b) >= 80 * len(a | b):
            rows += [(2 * p, " ".join(own)), (2 * p + 1, " ".join(other))]
            pairs += 1
    docs = ready.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert pairs > 700
    for bits in (M.MAX_DIFFERING_BITS, None):
        got = {r.doc_id: r.component_id for r in M.near_duplicates(docs, differing_bits=bits).collect()}
        found = sum(got[i + 1] == i for i, _ in rows if i % 2 == 0)
        assert found == pairs                                # expected misses: 0.002
