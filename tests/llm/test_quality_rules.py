from tallyline.llm import quality_rules as R
from util import TOKEN, docs_frame, empty, read


def brute(text):
    t = text or ""
    w = TOKEN.findall(t)
    places = {}
    for i in range(len(w) - 2):
        places.setdefault(tuple(w[i:i + 3]), []).append(i)
    lines = [x for x in t.split("\n") if TOKEN.search(x)]
    repeat = {j for at in places.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in R.SYMBOLS for c in t), len(lines) - len(set(lines)), len(repeat),
            len(w) < 50 or 100 * len(repeat) > 50 * len(w))


TEXTS = ["a b c a b c a b c", "a a a a a", "a b a b", "x\n\nx\n x\nx \n\x0b\n", "#*$%&|<> 😀😀", "word " * 60,
         "the cat sat on a mat and the dog of the house is in it with that " * 2 + "end " + " ".join(map(str, range(60)))]


def test_against_brute_force(ready):
    docs = docs_frame(ready).unionByName(docs_frame(ready, TEXTS, range(100, 100 + len(TEXTS))))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = R.quality_rules(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(texts[r.doc_id]), r
        assert not (r.kept and r.base_failed)
    assert R.quality_rules(empty(ready)).count() == 0


def test_thresholds_decide(ready):
    clean = " ".join(f"the word{i} and" for i in range(40))
    texts = [clean, clean.upper(), " ".join(w + "!!" for w in clean.split()), " ".join(w + "***" for w in clean.split()),
             " ".join(f"zzz{i}" for i in range(80)), " ".join("abcdefghijklmnopqrst" + str(i) for i in range(80))]
    docs = ready.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.kept for r in R.quality_rules(docs).collect()} == {0: True, 1: False, 2: False, 3: False,
                                                                           4: False, 5: False}


def test_clean_documents_stay(ready):
    got = R.quality_rules(ready.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    rows = got[~got.base_failed].merge(read("sf0.01", "labels").query("quality == 1 and toxic == 0"), on="doc_id")
    assert len(rows) > 200 and rows.kept.mean() > 0.995


def test_one_projection(ready):
    plan = R.quality_rules(docs_frame(ready))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow", "Aggregate", "Join"))
