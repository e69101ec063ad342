import zlib

import numpy as np
import pytest
from tallyline.llm import byte_cnn, toxicity
from util import auc, docs_frame, empty, read


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def rows():
    both = read("sf0.1", "documents").merge(read("sf0.1", "labels"), on="doc_id")
    both["raw"] = [t.encode() for t in both.text]
    out = both.doc_id.map(held_out)
    return both[~out], both[out]


def accuracy(module, column, rows, threshold):
    train, test = rows
    score = np.array(module.scorer(module.fit(list(zip(train.raw, train[column]))))(test.raw.tolist())[0])
    y = test[column].to_numpy()
    return auc(score, y), (score[y == 1] >= threshold).mean(), (score[y == 0] >= threshold).mean()


def test_toxicity_on_held_out_rows(rows):
    area, found, wrong = accuracy(toxicity, "toxic", rows, 0.5)
    assert area > 0.95 and found > 0.7 and wrong < 0.01


def test_quality_on_held_out_rows(rows):
    area, clean, bad = accuracy(byte_cnn, "quality", rows, 0.3)
    assert area > 0.97 and clean > 0.985 and bad < 0.4


def test_weights_are_few(rows):
    import io
    model = np.load(io.BytesIO(toxicity.fit(list(zip(rows[0].raw, rows[0].toxic)))))
    assert 0 < len(model["places"]) < 2000


def test_chunks_cover_every_window():
    for n in (0, 1, 7, 8, 511, 512, 513, 1020, 1021, 5000):
        raw = bytes(np.random.default_rng(n).integers(1, 256, n, np.uint8))
        got = byte_cnn.chunks(raw)
        held = {bytes(c[i:i + byte_cnn.WIDTH]) for c in got
                for i in range(0, byte_cnn.CHUNK - byte_cnn.WIDTH + 1, byte_cnn.STEP)}
        padded = raw + bytes(byte_cnn.CHUNK)
        assert all(padded[i:i + byte_cnn.WIDTH] in held for i in range(0, max(1, n - byte_cnn.WIDTH), byte_cnn.STEP))


def test_gradients_against_differences():
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in byte_cnn._init(rng).items()}
    parts = [byte_cnn.chunks(bytes(rng.integers(1, 256, n, np.uint8))) for n in (30, 1200, 700)]
    x, first, y = np.concatenate(parts), np.cumsum([0, len(parts[0]), len(parts[1])]), np.array([0.0, 1.0, 0.0])

    def loss():
        h = np.maximum(byte_cnn._pool(x, p), 0)
        n = np.diff(np.append(first, len(x)))
        z = np.hstack([np.add.reduceat(h, first) / n[:, None], np.maximum.reduceat(h, first)]) @ p["v"] + p["c"]
        return np.mean(np.log1p(np.exp(z)) - y * z)

    g = byte_cnn._gradients(p, x, first, y)
    for name in p:
        at = np.unravel_index(np.abs(g[name]).argmax(), p[name].shape)
        p[name][at] += 1e-6
        up = loss()
        p[name][at] -= 2e-6
        down = loss()
        p[name][at] += 1e-6
        assert abs((up - down) / 2e-6 - g[name][at]) < 1e-4 * max(1, abs(g[name][at]))


def test_forward_pass_against_a_slow_one():
    """Every window by plain loops, for texts of many lengths in one batch."""
    import io
    rng = np.random.default_rng(5)
    model = byte_cnn.fit([(bytes(rng.integers(32, 120, 700, np.uint8)), i % 2) for i in range(40)], epochs=1)
    p = np.load(io.BytesIO(model))
    texts = [bytes(rng.integers(0, 256, n, np.uint8)) for n in (0, 1, 7, 9, 511, 513, 1021, 140_000)] + [None]

    def slow(text):
        raw, step = text or b"", byte_cnn.CHUNK - byte_cnn.STEP
        pooled = []
        for start in range(0, max(1, len(raw) - byte_cnn.STEP), step):
            chunk = raw[start:start + byte_cnn.CHUNK].ljust(byte_cnn.CHUNK, b"\0")
            values = [p["emb"][list(chunk[i:i + byte_cnn.WIDTH])].reshape(-1) @ p["w"]
                      for i in range(0, byte_cnn.CHUNK - byte_cnn.WIDTH + 1, byte_cnn.STEP)]
            pooled.append(np.maximum(np.max(values, axis=0) + p["b"], 0))
        return 1 / (1 + np.exp(-(np.concatenate([np.mean(pooled, axis=0), np.max(pooled, axis=0)]) @ p["v"] + p["c"][0])))

    got = byte_cnn.scorer(model)(texts)[0]
    assert np.allclose(got, [slow(t) for t in texts], atol=1e-5)


def test_memory_does_not_grow_with_the_text():
    """A 30 MB text, and 64 texts of 1 MB in one training batch, stay below 200 MB beside the texts themselves."""
    import tracemalloc
    rng = np.random.default_rng(6)
    model = byte_cnn.fit([])
    big = rng.integers(32, 120, 30_000_000, np.uint8).tobytes()
    many = [(rng.integers(32, 120, 1_000_000, np.uint8).tobytes(), i % 2) for i in range(64)]
    for work in (lambda: byte_cnn.scorer(model)([big]), lambda: byte_cnn.fit(many, epochs=1)):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 200e6


def test_ftrl_against_a_slow_one():
    """Weights by the per-coordinate rule with dictionaries, and scores from them."""
    import io
    import math
    texts = [(f"good text number {i % 5} here", 0) for i in range(30)] + [(f"vile awful words {i % 4} there", 1) for i in range(30)]
    rows = [(t.encode(), y) for t, y in texts]
    z, n, zb, nb = {}, {}, 0.0, 0.0
    l1 = toxicity.L1_PER_ROW * len(rows)

    def weight(k):
        if abs(z.get(k, 0.0)) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((toxicity.BETA + math.sqrt(n[k])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(3):
        for raw, y in rows:
            places = sorted(set(toxicity.features(raw).tolist()))
            w, bias = {k: weight(k) for k in places}, -zb / ((toxicity.BETA + math.sqrt(nb)) / toxicity.ALPHA)
            g = (1 / (1 + math.exp(-(sum(w.values()) + bias))) - y) * (toxicity.TOXIC_WEIGHT if y else 1)
            for k in places:
                was = n.get(k, 0.0)
                z[k] = z.get(k, 0.0) + g - (math.sqrt(was + g * g) - math.sqrt(was)) / toxicity.ALPHA * w[k]
                n[k] = was + g * g
            zb, nb = zb + g - (math.sqrt(nb + g * g) - math.sqrt(nb)) / toxicity.ALPHA * bias, nb + g * g
    want = {k: weight(k) for k in z if weight(k)}
    model = np.load(io.BytesIO(toxicity.fit(rows, epochs=3)))
    assert dict(zip(model["places"].tolist(), model["weights"].tolist())) == pytest.approx(want, abs=1e-9) and want
    bias = -zb / ((toxicity.BETA + math.sqrt(nb)) / toxicity.ALPHA)
    for raw, score in zip([r for r, _ in rows], toxicity.scorer(toxicity.fit(rows, epochs=3))([r for r, _ in rows])[0]):
        total = sum(want.get(k, 0.0) for k in set(toxicity.features(raw).tolist())) + bias
        assert score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)


@pytest.mark.parametrize("module,column", [(toxicity, "toxic"), (byte_cnn, "quality")])
def test_edges(ready, module, column):
    docs = docs_frame(ready)
    labels = ready.createDataFrame([(i, i % 2, i % 2) for i in range(12)] + [(3, None, None), (None, 1, 1), (3, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    model = module.train(docs, labels, column)
    rows = module.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    same = [r.score for r in rows if r.doc_id in (5, 6)]
    assert same[0] == same[1]                           # equal texts, equal scores
    blank = {r.score for r in rows if r.doc_id in (0, 1)}
    assert len(blank) == 1                              # null is empty text
    assert module.score(empty(ready), model).count() == 0
    untrained = module.train(docs, labels.limit(0), column)
    assert {r.score for r in module.score(docs, untrained).collect()} == {0.5}


@pytest.mark.parametrize("module,column", [(toxicity, "toxic"), (byte_cnn, "quality")])
def test_held_out_labels_are_never_read(ready, module, column):
    docs = ready.createDataFrame([(i, f"text number {i} alpha beta") for i in range(60)], "doc_id long, text string")
    labels = [(i, i % 2, i % 2) for i in range(60)]
    flipped = [(i, 1 - q if held_out(i) else q, 1 - t if held_out(i) else t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    models = [module.train(docs, ready.createDataFrame(x, schema), column) for x in (labels, flipped)]
    raw = [f"text number {i} alpha beta".encode() for i in range(60)]
    assert module.scorer(models[0])(raw) == module.scorer(models[1])(raw)
