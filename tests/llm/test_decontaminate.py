import hashlib
import random

import pytest
from tallyline.llm import decontaminate as D
from util import docs_frame, empty, words


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        n = min(10, len(b))
        wins = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(item)
    ids = sorted(str(i) for i in found if i is not None)
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(30)] + ["É", "ß"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 3, 7, 9, 10, 11, 14, 40])))) for i in range(40)]
    items += [(40, None), (41, items[5][1]), (None, "q r s t u v w x y z null item id"), (42, "Word")]
    texts = []
    for _ in range(120):
        t = rng.choices(vocab, k=rng.randrange(80))
        if rng.random() < 0.7:
            b = words(rng.choice(items)[1])
            i = rng.randrange(len(b) + 1)
            cut = b[i:i + rng.choice([9, 10, 15])]
            at = rng.randrange(len(t) + 1)
            t[at:at] = cut
        texts.append(", ".join(x.upper() if rng.random() < 0.2 else x for x in t))
    return items, texts + ["x q r s t u v w x y z null item id", "one WORD"]


@pytest.mark.parametrize("limit", [D.SET_LIMIT, 0])         # in-set test, and the join for large benchmarks
def test_against_brute_force(ready, cases, limit):
    items, texts = cases
    bench = ready.createDataFrame(items, "item_id long, text string")
    docs = ready.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in D.decontaminate(docs, bench, set_limit=limit).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute(t, items), (i, t)


@pytest.mark.parametrize("limit", [D.SET_LIMIT, 0])
def test_edges(ready, limit):
    docs = docs_frame(ready)
    items = [(1, "same text here"), (2, " ".join(f"w{i % 977}" for i in range(25_000, 25_030))), (3, None), (4, "")]
    bench = ready.createDataFrame(items, "item_id long, text string")
    rows = D.decontaminate(docs, bench, set_limit=limit).collect()
    want = sorted((str(r.doc_id), *brute(r.text, items)) for r in docs.collect())
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in rows) == want
    clean = D.decontaminate(docs, bench.limit(0), set_limit=limit)
    assert clean.count() == docs.count() and clean.filter("contaminated").isEmpty()
    assert D.decontaminate(empty(ready), bench, set_limit=limit).count() == 0


def test_main_path_is_native(ready):
    docs, bench = docs_frame(ready), ready.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = D.decontaminate(docs, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
