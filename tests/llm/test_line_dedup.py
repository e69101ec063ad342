import random

import pytest
from pyspark.sql import functions as F
from tallyline.llm import line_dedup as L
from util import LOWER, docs_frame, empty

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return line.strip(SPACE).translate(LOWER)


def brute(texts, min_docs=10, min_chars=1):
    lines = [(t or "").split("\n") for t in texts]
    held = {}
    for own in lines:
        for k in {key(x) for x in own}:
            held[k] = held.get(k, 0) + 1
    out = []
    for own in lines:
        kept = [x for x in own if len(key(x)) < min_chars or held[key(x)] < min_docs]
        out.append((len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def result(docs, batches, **options):
    common = L.common_lines(docs.sparkSession, batches, **options)
    return {r.doc_id: tuple(r)[1:] for r in L.drop_lines(docs, common).collect()}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    shared = [f"Line {i} of many" for i in range(12)] + ["ÉCOLE", "école", "İ", "a\x1fb"]
    out = []
    for i in range(300):
        own = [f"own {i} {j}" for j in range(rng.randrange(3))] + rng.sample(shared, rng.randrange(5)) + [""] * rng.randrange(2)
        own += ["everywhere"] * rng.randrange(3) + (["rare"] if i < 9 else []) + (["ten"] if i < 10 else []) + (["ten"] if i == 0 else [])
        own = [rng.choice([str.upper, str.lower, str])(x) if x.isascii() else x for x in own]
        out.append("\n".join(rng.choice(["", " ", "\t\r"]) + x + rng.choice(["", " "]) for x in rng.sample(own, len(own))))
    return out + [None, "", "\n", "everywhere\n" * 4000, "x" * 3_000_000 + "\neverywhere"]


@pytest.mark.parametrize("n,fanout", [(1, 4), (7, 2), (9, 3)])
def test_against_brute_force(ready, texts, n, fanout):
    docs = ready.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    batches = [docs.filter(F.col("doc_id") % n == k) for k in range(n)]
    got = result(docs, batches, fanout=fanout)
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_shuffle_join_and_other_thresholds(ready, texts, monkeypatch):
    docs = ready.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    monkeypatch.setattr(L, "BROADCAST_ROWS", 0)
    got = result(docs, [docs], min_docs=3, min_chars=5)
    assert [got[i] for i in range(len(texts))] == brute(texts, 3, 5)


def test_runs_are_levelled_sorted_and_settled_keys_are_not_counted_again(ready):
    runs = L.LineRuns(ready, min_docs=4, fanout=3)
    batch = lambda k: ready.createDataFrame([(f"common\nonly {k}",)] * 2, "text string")
    for k in range(10):
        runs.add(L.line_counts(batch(k)))
        assert all(n < 3 for n in runs.levels)
    assert runs.levels == [1, 0, 1]                                      # 10 batches = 101 in base 3
    hot = L.line_counts(batch(0)).join(L.line_counts(batch(1)), L.HASH, "left_semi").select(*L.HASH)
    held = [level.join(hot, L.HASH).collect() for level in runs.tables()]
    assert [r.n for rows in held for r in rows] == [6]                   # settled by the first compaction, not counted since
    # neither the anti-join of a batch nor a compaction moves a run: the batch's own aggregate is the only exchange
    plan = runs.unsettled(L.line_counts(batch(11)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("SortMergeJoin") == 2 and "LeftAnti" in plan
    compacted = runs.tables()[0].groupBy(*L.HASH).agg(F.sum("n"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in compacted and runs.common().count() == 1
    runs.close()
    assert not runs.tables()


def test_edges(ready):
    docs = docs_frame(ready)
    want = sorted(zip((str(r.doc_id) for r in docs.collect()), brute([r.text for r in docs.collect()], 2)), key=str)
    common = L.common_lines(ready, [docs], min_docs=2)
    got = sorted(((str(r.doc_id), tuple(r)[1:]) for r in L.drop_lines(docs, common).collect()), key=str)
    assert got == want                                                   # null ids, repeated rows, clashing columns
    assert L.drop_lines(empty(ready), L.common_lines(ready, [empty(ready)])).count() == 0
    assert L.common_lines(ready, []).count() == 0


def test_a_line_and_a_row_that_a_third_of_all_rows_hold(ready):
    hot = ready.range(0, 3000, 1, 4).selectExpr("7L AS doc_id", "'hot line\nkept' AS text")
    rest = ready.range(0, 6000, 1, 4).selectExpr("id + 100 AS doc_id", "concat('hot line\n', id) AS text")
    docs = hot.unionByName(rest)
    common = L.common_lines(ready, [docs], min_docs=3001)
    rows = L.drop_lines(docs, common)
    assert rows.count() == 9000 and rows.filter("n_dropped = 1 AND n_lines = 2").count() == 9000
    assert rows.filter("doc_id = 7 AND kept = 'kept'").count() == 3000


def test_main_path_is_native_and_batches_are_whole_files(ready, tmp_path):
    docs = docs_frame(ready)
    docs.repartition(5).write.parquet(f"{tmp_path}/a b.parquet")
    parts = L.file_batches(ready, f"{tmp_path}/a b.parquet", 3)
    assert len(parts) == 3 and sum(p.count() for p in parts) == docs.count()
    plan = L.drop_lines(docs, L.common_lines(ready, parts))._jdf.queryExecution().toString()
    plan += L.line_counts(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
