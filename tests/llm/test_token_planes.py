import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyline.llm import token_planes as T
from tallyline.llm.queries import tokenizer_path
from util import EDGE_TEXTS, docs_frame, empty, read


def direct(texts):
    """Ids of whole texts by the library, the end id appended."""
    t = T.encoder_of(tokenizer_path()).tokenizer
    return [np.array(e.ids + [1], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def own(texts):
    return T.encoder_of(tokenizer_path()).batch([None if x is None else x.encode() for x in texts])


def test_ids_equal_the_library_on_whole_texts():
    texts = read("sf0.01", "documents").text.tolist() + EDGE_TEXTS
    for a, b in zip(own(texts), direct(texts)):
        assert a == b[:-1].tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aAbZ'\"*.<|>s t\ṉ̇İßé９½"), st.characters(
    exclude_categories=["Cs"])), max_size=30), max_size=4))
def test_ids_equal_the_library_on_any_text(texts):
    assert own(texts) == [b[:-1].tobytes() for b in direct(texts)]


def test_cache_is_bounded_and_harmless(monkeypatch):
    monkeypatch.setattr(T, "CACHE_PIECES", 10)
    e = T.PieceEncoder(tokenizer_path())
    assert e.by_piece
    texts = ["alpha beta, gamma!", "beta delta... alpha", "it's Alpha-beta"] * 3
    assert [e.batch([t.encode()])[0] for t in texts] == [b[:-1].tobytes() for b in direct(texts)]


def test_a_batch_looks_up_each_different_piece_once():
    class Counted(dict):
        asked = 0

        def __getitem__(self, key):
            self.asked += 1
            return super().__getitem__(key)

    e = T.PieceEncoder(tokenizer_path())
    e.known = Counted()
    texts = ["To be, or not to be. " * 500, "it's 10 to 1; \u00e9t\u00e9\n" * 500, None, ""] * 3
    made = e.batch([None if t is None else t.encode() for t in texts])
    assert made == [b[:-1].tobytes() for b in direct(texts)]
    assert e.known.asked < 100


def test_planes_are_the_bits_of_the_ids():
    ids = np.random.default_rng(1).integers(0, 1 << 17, 1003).astype("<u4")
    planes = [np.packbits((ids >> np.uint32(p) & 1).astype(np.uint8)).tobytes() for p in range(17)]
    assert [T.zstandard.ZstdDecompressor().decompress(b) for b in T.pack_block(ids)] == planes


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from([0, 1, 1 << 16]))
def test_block_round_trip(ids, top):
    ids = np.array([i % top if top else i for i in ids], "<u4")
    planes = T.pack_block(ids)
    assert len(planes) == (max(1, int(ids.max()).bit_length()) if len(ids) else 0)
    assert (T.unpack_block(planes, len(ids)) == ids).all()


def test_file_round_trip(monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 64)
    rng = np.random.default_rng(0)
    lengths = [0, 1, 64, 65, 500, 3]
    ids = rng.integers(0, 50_000, sum(lengths)).astype("<u4")
    back, docs, n = T.unpack_file(T.pack_file(ids, [5, None, -7, 2**60, 0, 9], lengths))
    assert (back == ids).all() and docs == [5, None, -7, 2**60, 0, 9] and n.tolist() == lengths


    file = T.PlaneFile(T.pack_file(ids, [5, None, -7, 2**60, 0, 9], lengths))
    stops = np.cumsum(lengths)
    for k, (n, stop) in enumerate(zip(lengths, stops)):                  # one document, one block at a time
        assert (file.ids_of_document(k) == ids[stop - n:stop]).all() and len(file.ids_of_document(k)) == n
    assert (file.ids_of_block(3) == ids[192:256]).all()


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    e = T.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["  Two  spaces, It's\n", "", "É日本"]
    want = [np.array(x.ids, "<u4").tobytes() for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert not e.by_piece and e.batch([t.encode() for t in texts]) == want


def test_copies_of_one_row_are_many_tasks(ready):
    hot = ready.range(0, 6000, 1, 6).selectExpr("7L AS doc_id", "'one text of which a third of all rows are copies' AS text")
    rest = ready.range(0, 12000, 1, 6).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    path = T.scratch(ready, "planes")
    T.write_files(hot.unionByName(rest), path, tokenizer_path())
    per_part = [r["n"] for r in ready.read.parquet(path).groupBy("part").agg({"n_docs": "sum"})
                .withColumnRenamed("sum(n_docs)", "n").collect()]
    assert sum(per_part) == 18000 and (len(per_part) == 1 or max(per_part) < 2 * sorted(per_part)[len(per_part) // 2])


def check(spark, docs, texts):
    """texts: (doc_id, text) in the order of the files."""
    rows = T.token_files(docs, tokenizer_path()).orderBy("start").collect()
    start = 0
    want = direct([t for _, t in texts])
    for r, (i, _), ids in zip(rows, texts, want):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(rows) == len(texts)


def test_small_table(ready, monkeypatch):
    d = read("sf0.001", "documents").sort_values("doc_id")
    check(ready, ready.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(7),
          list(zip(d.doc_id.tolist(), d.text.tolist())))


def test_edges(ready):
    docs = docs_frame(ready)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(ready, docs, sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)))
    assert T.token_files(empty(ready), tokenizer_path()).count() == 0
