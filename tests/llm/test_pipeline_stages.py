"""The near-dedup stage as the pipeline runs it."""

import corpus_pipeline as P
import test_minhash
from pyspark.sql import functions as F
from util import docs_frame, read, tokens

SF = "/root/testdata/sf0.001"
STAGE = dict(P.STAGES)["MinHash near-dedup"]


def five_word_set(text):
    w = tokens(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_stage_links_on_five_words(ready, monkeypatch):
    """At four words two more documents of this table would be dropped."""
    d = read("sf0.001", "documents")
    rows = list(zip(d.doc_id.tolist(), d.text.tolist()))
    four = {i for i, (_, c) in test_minhash.brute(rows).items() if i == c}
    monkeypatch.setattr(test_minhash, "shingle_set", five_word_set)
    five = {i for i, (_, c) in test_minhash.brute(rows).items() if i == c}
    got = STAGE(ready, ready.read.parquet(f"{SF}/documents.parquet"), SF)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(five)
    assert five - four == {185, 192}


def test_stage_keeps_one_row_of_a_repeated_document(ready):
    """A repeated row, null-id copies of one text on a third of all rows, a table loaded twice; other columns differ."""
    frame = docs_frame(ready)
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in STAGE(ready, frame, SF).collect())
    assert kept == [(False, i) for i in range(14) if i not in (6, 12)] + [(True, 0)]

    hot = ready.range(900).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the very same words in a row")).otherwise(
            F.concat_ws(" ", *(F.xxhash64("id", F.lit(i)).cast("string") for i in range(8)))).alias("text"),
        F.concat(F.lit("s"), F.col("id") % 4).alias("source"), F.lit(None).cast("string").alias("lang"))
    for docs, n in ((hot, 601), (hot.unionAll(hot).repartition(5), 601)):
        got = STAGE(ready, docs, SF)
        assert got.columns == docs.columns
        rows = got.collect()
        assert len(rows) == n and len({r.doc_id for r in rows}) == n
        assert [r.source for r in rows if r.doc_id is None] == ["s0"]


def test_repeats_beyond_the_broadcast(ready, monkeypatch):
    monkeypatch.setattr(P, "BROADCAST_ROWS", 0)
    docs = docs_frame(ready)
    assert P.one_row_each(docs.unionAll(docs)).count() == 15


def test_columns_of_any_name_survive(ready):
    """Extra columns that bear the stages' own working names, in other case too, come back with their values."""
    names = ["__document", "__DOCUMENT_", "__times", "__copy", "__row", "id", "hash", "size", "taken", "kept"]
    docs = ready.read.parquet(f"{SF}/documents.parquet").select("*", *(
        F.concat(F.lit(f"{n} of "), "doc_id").alias(n) for n in names))
    for name, stage in P.STAGES[:4]:
        got = stage(ready, docs, SF)
        assert got.columns == docs.columns, name
        rows = got.collect()
        assert rows and all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in names), name


def test_run_leaves_only_its_output(ready, tmp_path, monkeypatch):
    import os

    from tallyline.llm import common
    monkeypatch.setattr(common, "checkpoint_dir", lambda spark: str(tmp_path))
    rows = P.run(ready, SF)
    left = sorted(os.listdir(tmp_path))
    assert rows.count() > 0 and len([x for x in left if x.startswith("llm-stage")]) == 1
    # what the last stage's lazy result reads is its own written output
    assert [x.split("-")[1] for x in left] == ["stage"], left
