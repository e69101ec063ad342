"""P1-P6 against dense solves, whole-group sorts and brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tallyline.operators import evaluation as EV
from tallyline.operators import models as MO


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    out = []
    for i in range(900):
        a, b = rng.gauss(0, 1), rng.choice([0.0, 1.0])
        y = 1.5 + 2 * a - b + rng.gauss(0, 1)
        won = int(rng.random() < 1 / (1 + math.exp(-(0.3 + a - 0.5 * b))))
        out.append((i, ["x", "y", "z"][i % 3] if i % 9 else "x", 2000 + i % 5, a if i % 50 else None, b, 7.0, 3 * a + 7, y, won))
    return out, spark.createDataFrame(out, "id int, g string, season int, a double, b double, c double, d double, y double, won int")


def dense(rows, cols, y):
    known = [r for r in rows if all(r[c] is not None for c in cols)]
    x = np.array([[1.0, *(r[c] for c in cols)] for r in known])
    return x, np.array([r[y] for r in known], float)


def test_ols_equals_a_dense_solve(rows):
    data, df = rows
    got = {(r.g, r.term): r for r in MO.fit_ols(df, ["g"], ["a", "b"], "y").collect()}
    for g in "xyz":
        x, y = dense([r for r in data if r[1] == g], [3, 4], 7)
        beta, sse, *_ = np.linalg.lstsq(x, y, rcond=None)
        se = np.sqrt(sse[0] / (len(y) - 3) * np.diag(np.linalg.inv(x.T @ x)))
        for k, t in enumerate(["intercept", "a", "b"]):
            assert got[g, t].n == len(y) and got[g, t].rank == 3
            assert abs(got[g, t].coefficient - beta[k]) < 1e-9 and abs(got[g, t].std_error - se[k]) < 1e-9


def test_ols_dependent_and_constant_columns_are_null(rows):
    data, df = rows
    got = {r.term: r for r in MO.fit_ols(df, [], ["c", "a", "d", "b"], "y").collect()}
    assert got["c"].coefficient is None and got["d"].coefficient is None and {r.rank for r in got.values()} == {3}
    x, y = dense(data, [3, 4], 7)
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    assert np.allclose([got[t].coefficient for t in ("intercept", "a", "b")], beta, atol=1e-9)
    one = MO.fit_ols(df.filter("id = 1"), [], ["a"], "y").collect()
    assert one[0].rank == 1 and one[0].std_error is None and one[1].coefficient is None
    assert MO.fit_ols(df.limit(0), ["g"], ["a"], "y").count() == 0


def newton(x, y):
    b = np.zeros(x.shape[1])
    for _ in range(30):
        mu = 1 / (1 + np.exp(-x @ b))
        b += np.linalg.solve((x * (mu * (1 - mu))[:, None]).T @ x, x.T @ (y - mu))
    return b


def test_logit_equals_newton_and_separation_is_reported(spark, rows):
    data, df = rows
    got = {(r.g, r.term): r for r in MO.fit_logit(df, ["g"], ["a", "c", "b"], "won").collect()}
    for g in "xyz":
        want = newton(*dense([r for r in data if r[1] == g], [3, 4], 8))
        assert np.allclose([got[g, t].coefficient for t in ("intercept", "a", "b")], want, atol=1e-8)
        assert got[g, "c"].coefficient is None and got[g, "a"].status == "converged"
    parted = df.withColumn("won", F.when(F.col("g") == "x", (F.col("a") > 0).cast("int"))
                           .when(F.col("g") == "y", F.lit(1)).otherwise(F.col("won")))
    state = {(r.g, r.term): (r.status, r.coefficient is None) for r in MO.fit_logit(parted, ["g"], ["a"], "won").collect()}
    assert state["x", "a"] == state["y", "intercept"] == ("separated", True)
    assert state["z", "a"] == ("converged", False)


def test_walk_forward_sees_earlier_seasons_only(rows):
    data, df = rows
    got = {r.id: r for r in MO.walk_forward(df, "season", ["a", "b", "c"], "y", ["g"]).collect()}
    assert len(got) == len(data)
    for g in "xyz":
        for s in range(2000, 2005):
            before = [r for r in data if r[1] == g and r[2] < s]
            x, y = dense(before, [3, 4], 7)
            for r in (r for r in data if r[1] == g and r[2] == s):
                assert got[r[0]].n_train == len(y)
                if not before or r[3] is None:
                    assert got[r[0]].predicted is None
                else:
                    beta = np.linalg.lstsq(x, y, rcond=None)[0]
                    assert abs(got[r[0]].predicted - beta @ [1, r[3], r[4]]) < 1e-8


def test_power_ratings_equal_the_least_norm_solution(spark):
    """Two groups of teams that never meet, neutral sites, missing lines, a team against itself."""
    rng = random.Random(8)
    games = []
    for k in range(400):
        league = k % 2
        h, a = rng.sample(range(6), 2)
        games.append((1 + k % 3 // 2, f"{league}-{h}", f"{league}-{a}", rng.choice([True, False, None]),
                      round(rng.gauss(3 * (a - h), 2) * 2) / 2))
    games += [(1, "0-1", "0-1", False, 5.0), (1, "0-1", "0-2", False, None), (None, "0-1", "0-2", False, 1.0), (2, "lone", None, False, 3.0)]
    df = spark.createDataFrame(games, "season int, home_team string, away_team string, neutral_site boolean, mode_spread double")
    got = {(r.season, r.team): r for r in MO.power_rating(df).collect()}
    for s in (1, 2):
        own = [g for g in games if g[0] == s and g[4] is not None and g[1] != g[2] and g[2]]
        teams = sorted({t for g in own for t in g[1:3]})
        x = np.zeros((len(own), len(teams) + 1))
        for k, g in enumerate(own):
            x[k, teams.index(g[1])], x[k, teams.index(g[2])], x[k, -1] = 1, -1, 0 if g[3] else 1
        want = np.linalg.lstsq(x, np.array([-g[4] for g in own]), rcond=None)[0]
        assert {t for (y, t) in got if y == s} == set(teams)
        for k, t in enumerate(teams):
            assert abs(got[s, t].rating - want[k]) < 1e-7 and abs(got[s, t].home_edge - want[-1]) < 1e-7
            assert got[s, t].games == sum(t in g[1:3] for g in own)
    assert MO.power_rating(df.limit(0)).count() == 0


def test_equal_count_bins_equal_ntile(spark, monkeypatch):
    """A value that holds a third of the rows, few rows, NULLs; small sketch so that cells are coarse."""
    monkeypatch.setattr(EV, "CELLS", 8)
    rng = random.Random(6)
    rows = [(i, "g", 0.5 if i % 3 == 0 else rng.random()) for i in range(3000)] + [(i, "few", 0.1 * (i % 2)) for i in range(7)]
    rows += [(9001, "g", None), (9002, None, 0.3), (None, "g", 0.5), (None, "g", 0.5)]
    df = spark.createDataFrame(rows, "id int, g string, v double")
    got = EV.equal_count_bins(df, "v", "id", 10, ["g"]).collect()
    assert len(got) == len(rows) and all((r.bin is None) == (r.v is None or r.g is None) for r in got)
    for g in ("g", "few"):
        own = sorted(((r.v, hashlib.md5(str(r.id).encode()).hexdigest() if r.id is not None else "", r.bin) for r in got if r.g == g and r.v is not None))
        n, cut = divmod(len(own), 10)
        want = [b + 1 for b in range(10) for _ in range(n + (b < cut))]
        assert [x[2] for x in own] == want
    with pytest.raises(ValueError):
        EV.equal_count_bins(df, "v", "id", 10, [])


def test_asof_join_equals_brute_force(spark):
    """A key with a third of all rows, equal times, times before all quotes, NULLs, extra columns of the same names."""
    rng = random.Random(3)
    t0 = 1_700_000_000
    key = lambda: rng.choice([None, 1, 1, 1, 2, 3, 4])
    quotes = [(key(), t0 + rng.randrange(0, 400_000, 1000), k, rng.choice([None, float(k)])) for k in range(500)]
    asked = [(k, key(), rng.choice([None, t0 + rng.randrange(-50_000, 500_000, 500)]), "extra") for k in range(300)]
    asked += [(900 + k, 1, t0 + 200_000, "copy") for k in range(200)]
    q = spark.createDataFrame(quotes, "k int, s long, ord int, line double").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    a = spark.createDataFrame(asked, "id int, k int, s long, ord string").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.id: r for r in EV.asof_join(a, q, "k", "ts", "ts", ["line"], ["ord"]).collect()}
    assert len(got) == len(asked) and got[900].asDict().keys() == {"id", "k", "s", "ord", "ts", "line"}
    for i, k, s, _ in asked:
        known = [x for x in quotes if k is not None and s is not None and x[0] == k and x[1] <= s]
        want = max(known, key=lambda x: (x[1], x[2]))[3] if known else None
        assert got[i].line == want, (i, k, s)


def test_brier_and_reliability(spark):
    df = spark.createDataFrame([(i, 1, i / 100, i % 2) for i in range(100)] + [(200, 1, None, 1), (201, 1, 0.5, None)],
                               "id int, g int, p double, y int")
    b = EV.brier(df, "p", "y", ["g"]).first()
    assert b.n == 100 and abs(b.brier - sum((i / 100 - i % 2) ** 2 for i in range(100)) / 100) < 1e-12
    assert math.isfinite(b.log_loss)
    r = EV.reliability(df, "p", "y", "id", ["g"], 4).orderBy("bin").collect()
    assert [x.n for x in r] == [25] * 4 and r[0].lowest == 0 and r[3].highest == 0.99
