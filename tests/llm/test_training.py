"""The labelled sample under repeated ids and large texts."""

import pytest
from pyspark.sql import functions as F
from tallyline.llm import byte_cnn
from tallyline.llm.common import held_out
from tallyline.llm.training import fit_in_one_task, labelled

SCHEMA = "doc_id long, quality int"


@pytest.fixture(scope="module")
def free(ready):
    """Ids that are not held out, in the order of the sample."""
    ids = ready.range(80).select(F.col("id").alias("doc_id")).filter(~held_out(F.col("doc_id")))
    return [r.doc_id for r in ids.orderBy(F.xxhash64(F.lit(17), "doc_id"), "doc_id").collect()]


def sample(docs, labels, rows, max_bytes):
    return [(r.y, r.text) for r in labelled(docs, labels, "quality", rows, max_bytes).orderBy("place").collect()]


def test_repeated_id_and_large_texts(ready, free):
    """The first id holds many rows, the second a text above the bound, the third one just below it."""
    hot, over, near, *rest = free
    rows = [(hot, "same text")] * 500 + [(hot, f"other text {i}") for i in range(30)]
    rows += [(over, "x" * 2001), (near, "y" * 1990)] + [(i, f"text {i}") for i in rest]
    docs = ready.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = ready.createDataFrame([(i, i % 2) for i in free], SCHEMA)
    got = sample(docs, labels, 1000, 2000)
    texts = [t for _, t in got]
    assert texts[1:1 + len(rest)] == [f"text {i}" for i in rest]         # every id's first text, in order
    others = {"same text", *(f"other text {i}" for i in range(30))}
    assert {texts[0], *texts[1 + len(rest):]} == others and len(texts) == len(rest) + 31
    assert sum(map(len, texts)) <= 2000
    assert [y for y, _ in got][1:1 + len(rest)] == [i % 2 for i in rest]
    few = sample(docs, labels, 20, 2000)                                 # 20 labels, two without a text that fits
    assert len(few) == 20 and len([t for _, t in few if t in others]) == 3
    assert labelled(docs, labels, "quality", 1000, 0).count() == 0


def test_rows_that_do_not_fit_are_passed_over(ready, free):
    size = {i: 30 if k == 20 else 5 for k, i in enumerate(free)}
    docs = ready.createDataFrame([(i, "z" * size[i]) for i in free], "doc_id long, text string")
    labels = ready.createDataFrame([(i, 1) for i in free], SCHEMA)
    got = sample(docs, labels, 1000, 480)
    assert len(free) > 22 and sum(len(t) for _, t in got) <= 480
    assert len([t for _, t in got if len(t) == 5]) == min(len(free) - 1, 96)
    tight = sample(docs, labels, 1000, 110)                               # 22 short texts fit, the long one does not
    assert [len(t) for _, t in tight] == [5] * 22


def test_one_task_sees_the_sample_in_order(ready, free):
    docs = ready.createDataFrame([(i, f"t{i}") for i in free for _ in range(3)], "doc_id long, text string")
    labels = ready.createDataFrame([(i, 1) for i in free], SCHEMA)
    seen = fit_in_one_task(labelled(docs, labels, "quality", 1000, 10**6), lambda rows: b" ".join(t for t, _ in rows))
    assert seen.decode().split() == [f"t{i}" for i in free]
    model = byte_cnn.train(docs, labels)
    assert model == byte_cnn.fit([(f"t{i}".encode(), 1) for i in free])
