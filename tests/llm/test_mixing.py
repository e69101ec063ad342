import pytest
from harness import duck_rows, spark_rows
from pyspark.sql import functions as F
from tallyline.llm import mixing as X
from tallyline.llm import oracles
from util import docs_frame, empty, tokens


def laws(rows):
    total, taken = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        total[r.target, r.source_size] = r.target
        taken[r.target, r.source_size] = taken.get((r.target, r.source_size), 0) + r.taken
    return total, taken


def fill(sizes):
    """Targets by reshared excess, source by source until none is above its cap."""
    weights, capped = [(3, 1, 2)[i % 3] for i in range(len(sizes))], set()
    budget = 1.5 * sum(sizes)
    while True:
        rest = budget - sum(2 * sizes[i] for i in capped)
        w = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        t = [2 * s if i in capped else rest * weights[i] / w for i, s in enumerate(sizes)]
        over = {i for i in range(len(sizes)) if i not in capped and t[i] > 2 * sizes[i]}
        if not over:
            return t
        capped |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 1, 500], [5], [0, 7, 0, 9], [3, 900, 2, 40, 1, 77, 0]])
def test_targets(ready, sizes):
    rows = X.targets(ready.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)],
                                           "source string, source_size long")).orderBy("pos").collect()
    assert [r.target for r in rows] == pytest.approx(fill(sizes))


@pytest.mark.parametrize("seed", range(6))
def test_quotas_are_sainte_lague(ready, seed):
    """Exactly the seats of a heap of highest quotients, with sources at, near and far below their caps."""
    import heapq
    import random
    rng = random.Random(seed)
    full = rng.choice([1.0, 0.9, 0.5])
    shards = []
    for p in range(4):
        share = [1.0, full, rng.random(), 0.0][p]
        for s in range(rng.randrange(1, 12)):
            b = rng.choice([1, 3, 50, 1000])
            shards.append((p, s, b, int(2 * b * X.UNIT * share)))
    rows = X.quotas(ready.createDataFrame(shards, "pos long, shard long, blocks long, want long")).collect()
    seats = (sum(w for *_, w in shards) + X.UNIT // 2) // X.UNIT
    got = {(p, s): 0 for p, s, _, _ in shards}
    heap = [(-w, p, s, 0, w, b) for p, s, b, w in shards if w]
    heapq.heapify(heap)
    for _ in range(seats):
        _, p, s, k, w, b = heapq.heappop(heap)
        got[p, s] += 1
        if k + 1 < 2 * b:
            heapq.heappush(heap, (-w / (2 * k + 3), p, s, k + 1, w, b))
    assert {(r.pos, r.shard): r.quota for r in rows} == got and sum(got.values()) == seats


def test_copies_of_one_document_are_many_shards(ready, monkeypatch):
    """A third of all rows are one row, of a null id in one source; a third more are empty."""
    import duckdb
    monkeypatch.setattr(X, "SHARD_WORDS", 2048)
    docs = ready.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("one").alias("source"),
        F.when(F.col("id") % 3 == 0, F.lit("the same seven words in every row")).when(F.col("id") % 3 == 1, F.repeat(
            F.lit("w "), (F.col("id") % 29).cast("int"))).alias("text"))
    sizes = []
    monkeypatch.setattr(X, "quotas", lambda s, f=X.quotas: (sizes.extend(r.words for r in s.collect()), f(s))[1])
    rows = X.mix(docs)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = duck_rows(con, oracles.op6_sainte_lague.replace("65536", "2048"))[1]
    assert sorted(spark_rows(rows)[1], key=str) == sorted(want, key=str)
    assert max(sizes) < 2 * 2048


def test_mix_comes_near_its_targets(ready):
    docs = ready.read.parquet("/root/testdata/sf0.01/documents.parquet")
    total, taken = laws(X.mix(docs).collect())
    for k, t in total.items():
        assert abs(taken[k] - t) <= max(2 * X.BLOCK, 0.005 * t)


def test_reruns_agree(ready):
    docs = ready.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b = (spark_rows(X.mix(d))[1] for d in (docs, docs.repartition(6)))
    assert sorted(a) == sorted(b)


def test_hot_source_and_nulls_against_the_oracle(ready):
    import duckdb
    docs = ready.range(5000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 5 == 0, None)
        .otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.when(F.col("id") % 11 > 0, F.repeat(F.lit("w "), (F.col("id") % 97).cast("int"))).alias("text"))
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert sorted(spark_rows(X.mix(docs))[1]) == sorted(duck_rows(con, oracles.op6_sainte_lague)[1])


def test_edges(ready):
    docs = docs_frame(ready)
    rows = X.mix(docs).collect()
    assert len(rows) == docs.count()
    laws(rows)
    by = {r.doc_id: r for r in rows}
    assert by[0].size == 0 and by[0].taken == 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.size == len(tokens(texts[r.doc_id])) for r in rows)
    assert X.mix(empty(ready)).count() == 0
    blank = ready.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.taken, r.target) for r in X.mix(blank).collect()] == [(0, 0.0)] * 2
