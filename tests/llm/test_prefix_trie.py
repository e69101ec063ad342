import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from tallyline.llm import prefix_trie as P
from util import TOKEN

SCHEMA = "conv_id long, turn long, role string, text string, words int, depth string, pos string"


def sequences(log):
    out = {}
    for c, turn, role, text, *_ in log:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            out.setdefault(c, []).append((turn is not None, turn or 0, digest, (role, text)))
    return {c: [x[3] for x in sorted(rows, key=lambda x: x[:3])] for c, rows in out.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for prefix in members:
        if prefix:
            kids.setdefault(prefix[:-1], []).append(prefix)
    rows = {}

    def visit(prefix):
        stack, order = [prefix], []
        while stack:
            x = stack.pop()
            order.append(x)
            stack += kids.get(x, [])
        total = {}
        for x in reversed(order):
            own = (len(members[x]) - 1) * len(TOKEN.findall(x[-1][1])) if x else 0
            below = [total[y] for y in kids.get(x, [])]
            total[x] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
            ends = ",".join(str(c) for c in sorted(c for c in members[x] if len(convs[c]) == len(x)))
            rows[min(members[x]), len(x)] = (min(members[x[:-1]]) if x else None, len(members[x]), len(kids.get(x, [])),
                                            *total[x], hashlib.sha256(ends.encode()).hexdigest())

    if convs:
        visit(())
    return rows


def trie(spark, log, rebuild=True):
    turns = P.ordered(spark.createDataFrame([(*r, 1, "x", "y") for r in log], SCHEMA))
    convs = P.lengths(turns)
    rows = P.prefix_trie(*(P.rebuilt(turns, convs) if rebuild else (turns, convs))).collect()
    assert len({(r.conv_id, r.depth) for r in rows}) == len(rows)
    return {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}


@pytest.fixture(scope="module")
def log():
    rng = random.Random(21)
    says = [("user", f"hello there {i} " * i) for i in range(3)] + [(None, None), ("", ""), ("a", "b"), ("ab", "")]
    out = []
    for c in list(range(0, 90)) + [1000, 1010, 777_777_777_777]:
        n = rng.choice([1, 1, 2, 3, 5, 8, 9, 40])
        out += [(c, rng.choice([None, t]) if t < 2 else t, *rng.choice(says if t > 1 else says[:2])) for t in range(n)]
    out += [(None, 1, "user", "left out"), (33, 5, "a", "b"), (33, 5, "a", "b"), (33, 5, "a", "c")]
    out += [(c, t, "user", "same") for c in range(200, 260) for t in range(6)]          # a third: one sequence
    rng.shuffle(out)
    return out


def test_rebuilt_trie_against_brute_force(ready, log):
    assert trie(ready, log) == brute(rebuilt(sequences(log)))


def test_trie_as_logged_against_brute_force(ready, log):
    assert trie(ready, log, rebuild=False) == brute(sequences(log))


def test_long_conversation_takes_a_job_a_level(ready):
    """600 turns, a copy and a branch near the end; 10 levels."""
    log = [(1, t, "user", f"turn {t}") for t in range(600)] + [(2, t, "user", f"turn {t}") for t in range(600)]
    log += [(3, t, "user", f"turn {t}" if t < 590 else "other") for t in range(600)]
    got = trie(ready, log, rebuild=False)
    assert got == brute(sequences(log)) and len(got) == 1 + 600 + 10
    assert got[1, 0][1] == 3 and got[1, 590][2:4] == (2, 2)


def test_edges(ready):
    assert trie(ready, [(None, 1, "a", "b")]) == {}
    one = trie(ready, [(20, None, None, None)])
    assert one == brute(rebuilt({20: [("", "")]}))
    turnless = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4][:2]          # no base, first turns dropped
    log = [(c, 0, "user", "x") for c in turnless]
    assert trie(ready, log) == brute({c: [] for c in turnless}) and len(trie(ready, log)) == 1
    very_long = [(40, 0, "user", "word " * 400_000), (41, 0, "user", "word " * 400_000)]
    assert trie(ready, very_long, rebuild=False)[40, 1][4] == 400_000


def test_positions_of_one_hot_conversation(ready):
    """A conversation with most of all turns, all of one number: no gaps, no turn lost, ranges split it."""
    hot = ready.range(0, 5000, 1, 5).select(F.lit(9).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"),
                                           F.lit("user").alias("role"), F.lit("copy").alias("text"))
    rest = ready.range(100).select("id", F.lit(1).cast("long"), F.lit("user"), F.lit("t")).toDF(*hot.columns)
    got = P.ordered(hot.unionByName(rest)).filter("conv_id = 9")
    assert sorted(r.pos for r in got.collect()) == list(range(1, 5002))
