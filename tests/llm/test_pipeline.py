"""The pipeline's stages against brute force, on the small table and on edge cases."""

import zlib

import corpus_pipeline as P
import numpy as np
import pytest
from tallyline.llm import byte_cnn
from tallyline.llm.queries import tokenizer_path
from util import docs_frame, empty, read

from test_decontaminate import brute as leaked
from test_minhash import brute as near
from test_token_planes import direct

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


@pytest.fixture(scope="module")
def docs(ready):
    return ready.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts():
    d = read("sf0.001", "documents")
    return dict(zip(d.doc_id.tolist(), d.text.tolist()))


def test_stage_list():
    assert [n for n, _ in P.STAGES] == ["quality classifier", "MinHash near-dedup", "benchmark decontamination",
                                        "mixing sources to target weights", "token-ID / binary output"]
    assert P.ORACLE_SQL is None


def test_quality_keeps_what_the_score_keeps(ready, docs, texts):
    labels = read("sf0.001", "labels")
    use = labels[[zlib.crc32(str(i).encode()) % 5 != 0 for i in labels.doc_id]]
    got = P.quality(ready, docs, SF)
    assert got.columns == COLUMNS
    model = byte_cnn.train(docs, ready.read.parquet(f"{SF}/labels.parquet"))
    score = byte_cnn.scorer(model)([t.encode() for t in texts.values()])[0]
    assert ids(got) == sorted(i for i, s in zip(texts, score) if s >= P.QUALITY_THRESHOLD) and len(use) > 0


def test_near_dedup_keeps_the_first_of_each_component(ready, docs, texts):
    got = P.near_dedup(ready, docs, SF)
    assert got.columns == COLUMNS
    assert ids(got) == sorted(i for i, (_, c) in near(list(texts.items())).items() if i == c)


def test_decontamination_drops_leaks_only(ready, docs, texts):
    bench = read("sf0.001", "benchmark")
    items = list(zip(bench.item_id.tolist(), bench.text.tolist()))
    got = P.decontamination(ready, docs, SF)
    assert got.columns == COLUMNS
    assert ids(got) == sorted(i for i, t in texts.items() if not leaked(t, items)[4])


def test_mixture_comes_near_the_targets(ready):
    docs = ready.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = P.mixture(ready, docs, SF)
    assert got.columns == COLUMNS
    copies = got.groupBy("doc_id").count().toPandas()
    assert copies["count"].max() <= 2
    size = {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    words = sum(size[i] * n for i, n in zip(copies.doc_id, copies["count"]))
    assert abs(words / (1.5 * sum(size.values())) - 1) < 0.05
    assert ids(P.mixture(ready, docs.repartition(3), SF)) == ids(got)


def test_run_ends_in_token_files(ready):
    rows = P.run(ready, SF).orderBy("start").collect()
    texts = read("sf0.001", "documents").set_index("doc_id").text
    start = 0
    for r, want in zip(rows, direct([texts[r.doc_id] for r in rows])):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)
    assert 0 < len(rows) and tokenizer_path().endswith(".json") and np.all(np.diff([r.doc_id for r in rows]) >= 0)


def test_edges(ready):
    """Null ids and texts, repeated rows, clashing columns; an empty table through every stage."""
    frame = docs_frame(ready)
    for name, stage in P.STAGES[1:4]:
        assert stage(ready, frame, SF).columns == frame.columns, name
    kept = P.near_dedup(ready, frame, SF)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(
        (r.doc_id is None, r.doc_id or 0) for r in frame.collect() if r.doc_id not in (6, 12))
    assert P.decontamination(ready, frame, SF).count() == frame.count()
    nothing = empty(ready)
    for name, stage in P.STAGES:
        assert stage(ready, nothing, SF).count() == 0, name
