import random

from tallyline.llm import license_scan as L
from tallyline.llm.common import words_of
from util import docs_frame, empty, words


def brute(text):
    w = words(text)
    hits = [(i, label) for p, label in L.BASE_PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    return (len(w), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None),
            ",".join(sorted({label for _, label in hits})))


def test_words_match_the_pattern():
    for t in ("A-b C'séÉ 9x\x7f_y", "", "İI ß"):
        assert [x.decode() for x in words_of(t.encode())] == words(t)
    assert words_of(None) == []


def test_base_places_against_brute_force():
    rng = random.Random(4)
    vocab = " ".join(p for p, _ in L.BASE_PHRASES).split() + ["x", "License,"]
    texts = [" ".join(rng.choices(vocab, k=rng.randrange(60))) for _ in range(800)]
    texts += ["under the under the MIT License. Apache-License (version 2) cc-by-nc cc by by nc cc by nc"]
    got = L.scanner()([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert tuple(c[i] for c in got[:5]) == brute(t), t


def test_matching_statistics_against_brute_force():
    rng = random.Random(9)
    texts = [[b"a", b"b", b"a", b"c"], [b"b", b"a", b"b"], [b"c", b"c"]]
    a = L.Automaton(texts, [])
    subs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for v in range(1, len(a.size)):         # every state's longest string ends where `ends` says
        for t, end in a.ends[v].items():
            assert tuple(texts[t][end - a.size[v]:end]) in subs
    for _ in range(200):
        w = rng.choices([b"a", b"b", b"c", b"d"], k=12)
        runs = a.scan(w)[1]
        want = [(j, max(n for n in range(j + 1) if n == 0 or tuple(w[j - n:j]) in subs)) for j in range(1, 13)]
        longest = [(j, n) for k, (j, n) in enumerate(want)
                   if n >= L.MIN_RUN and (k + 1 == len(want) or want[k + 1][1] <= n)]
        assert [(e, n) for e, n, _, after in runs if after is None] == longest


def test_chained_spans_and_labels():
    notice = dict((label, t) for label, t in L.TEMPLATES)["bsd"]
    w = notice.split()
    broken = " ".join([*w[:9], "INSERTED", "words", *w[9:]])
    got = L.scanner()([f"x y {notice} z".encode(), broken.encode(), " ".join(w[:6]).encode()])
    labels, score, spans = got[5], got[6], got[7]
    assert labels == ["bsd", "bsd", ""]
    assert score[0] == 1.0 and score[1] == 1.0 and 0 < score[2] < L.MIN_COVER
    best = max(spans[0], key=lambda s: s["coverage"])
    assert (best["start"], best["end"]) == (2, 2 + len(w))
    assert all(0 <= s <= 1 for s in score)


def test_a_body_without_its_heading_is_labelled():
    from tallyline.llm.license_texts import BSD_2, ISC, MIT, ZLIB
    cut = [t.strip()[len(t) // 8:] for t in (MIT, BSD_2, ISC, ZLIB)]     # the opening sentence is gone
    got = L.scanner()([f"int main() {{}}\n{t}\nmore code".encode() for t in cut])
    assert got[5] == ["mit", "bsd", "isc", "zlib"]
    assert L.scanner()([MIT.encode()[:400]])[5] == ["mit"] and L.scanner()([MIT.encode()[500:800]])[5] == [""]


def test_labels_and_score_against_brute_force():
    """Runs by trying every substring, chains by trying every earlier run."""
    rng = random.Random(17)
    templates = [("one", "a b c d e f g h i j"), ("two", "d e f g x y a b c d"), ("one", "k l m n o p")]
    texts = [t.split() for _, t in templates]
    vocab = "a b c d e f g h i j k l m n o p x y zz".split()

    def slow(w):
        """Per template: its own matches that neither side extends, chained."""
        cover = {}
        for t, words_ in enumerate(texts):
            inside = lambda x: [i + len(x) for i in range(len(words_) - len(x) + 1) if words_[i:i + len(x)] == x]  # noqa: B023,E731
            of_all = [max(n for n in range(j + 1) if n == 0 or any(
                s[i:i + n] == w[j - n:j] for s in texts for i in range(len(s) - n + 1))) for j in range(len(w) + 1)]
            chains = []                                                  # (covered, end in text, end in template)
            for j, n in enumerate(of_all):                               # the longest match of all templates, if t has it and ends here
                if n >= L.MIN_RUN and inside(w[j - n:j]) and (
                        j == len(w) or of_all[j + 1] <= n or not inside(w[j - n:j + 1])):
                    at = inside(w[j - n:j])[0]
                    best = n
                    for covered, stop, upto in chains:
                        fresh = min(n, j - stop, at - upto)
                        if stop >= j - n - L.MAX_GAP and fresh > 0:
                            best = max(best, covered + fresh)
                    chains.append((best, j, at))
            if chains:
                cover[t] = min(max(c for c, _, _ in chains), len(words_)) / len(words_)
        return (",".join(sorted({templates[t][0] for t, c in cover.items() if c >= L.MIN_COVER})), max(cover.values(), default=0.0))

    docs = []
    for _ in range(300):
        w = rng.choice(texts) * rng.choice([1, 1, 2])
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(w))
            w = w[:i] + [rng.choice(vocab)] * rng.randrange(3) + w[i + rng.randrange(2):]
        docs.append(w + rng.choices(vocab, k=rng.randrange(8)))
    got = L.scanner(templates, ())([" ".join(w).encode() for w in docs])
    for i, w in enumerate(docs):
        assert (got[5][i], got[6][i]) == slow(w), w


def test_edges(ready):
    rows = L.license_scan(docs_frame(ready)).collect()
    assert len(rows) == docs_frame(ready).count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by[0].n_words, by[0].first_word, by[0].labels, by[0].score) == (0, None, "", 0.0)
    assert by[11].n_words == 30_000
    assert L.license_scan(empty(ready)).count() == 0
