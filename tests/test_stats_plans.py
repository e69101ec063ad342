
import datetime as dt
import os
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from tallyline.plans import registry
from tallyline.operators import mutation as MU
from tallyline.operators import stats as ST
from tallyline.operators import windows as W
from tallyline.operators.longform import to_long

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- golden values

@pytest.fixture(scope="module")
def counts(spark):
    # the three rule buckets and the pooled record quoted by the reference
    return spark.createDataFrame([("rule1", 145, 243), ("rule4", 90, 142), ("rule8", 59, 98), ("ALL", 294, 483)],
                                 "rule string, wins bigint, n bigint")


def test_beta_posterior_golden(counts):
    post = {r.rule: r for r in ST.credible_interval(ST.beta_posterior(counts)).collect()}["ALL"]
    assert post.alpha == pytest.approx(335.9048, abs=1e-3)
    assert post.beta == pytest.approx(227.0952, abs=1e-3)
    assert post.posterior_mean == pytest.approx(0.59663, abs=1e-4)
    assert (post.lo_95, post.hi_95) == (pytest.approx(0.5558, abs=1e-4), pytest.approx(0.6368, abs=1e-4))
    assert (post.lo_75, post.hi_75) == (pytest.approx(0.5728, abs=1e-4), pytest.approx(0.6204, abs=1e-4))


def test_prob_at_least_golden(counts):
    p = {r.x: r.p_at_least for r in ST.prob_at_least(ST.beta_posterior(counts), [110 / 210, 0.597, 0.60])
         .filter("rule = 'ALL'").collect()}
    assert p[110 / 210] == pytest.approx(0.99975, abs=1e-4)
    assert p[0.597] == pytest.approx(0.4951, abs=1e-4)
    assert p[0.60] == pytest.approx(0.4375, abs=1e-4)


def test_partial_pooling_golden(counts):
    rules = counts.filter("rule != 'ALL'")
    out = {r.rule: r for r in ST.partial_pooling(rules).collect()}
    assert out["rule1"].theta_mean == pytest.approx(0.5978, abs=1e-3)
    assert out["rule4"].theta_mean == pytest.approx(0.6115, abs=1e-3)
    assert out["rule8"].theta_mean == pytest.approx(0.5991, abs=1e-3)
    assert out["rule1"].mu_mean == pytest.approx(0.382, abs=2e-3)
    assert out["rule1"].sigma_mean == pytest.approx(0.162, abs=3e-3)
    # shrinkage: posterior between pooled mean and raw rate
    assert 0.5 < out["rule4"].theta_mean < 90 / 142


def test_incomplete_beta_at_any_count():
    import numpy as np
    from tallyline.functions.beta import betainc, betaincinv
    for n in (1e1, 1e3, 5.9e3, 6.1e3, 1e5, 1e7, 1e8, 1e9, 1e10):
        assert abs(betainc(n / 2, n / 2, 0.5) - 0.5) < 1e-9, n
        q = betaincinv(0.6 * n, 0.4 * n, np.array([0.025, 0.975]))
        assert np.abs(betainc(0.6 * n, 0.4 * n, q) - [0.025, 0.975]).max() < 1e-6, n
    a, b = np.array([2999.0, 3001.0, 40.0]), np.array([5000.0, 5000.0, 1e6])        # both sides of the switch
    x = a / (a + b) * np.array([1.01, 1.01, 1.1])
    for ai, bi, xi in zip(a, b, x):
        t = np.linspace(0, min(1.0, 4 * xi), 2_000_001)[1:-1]
        f = np.exp((ai - 1) * np.log(t / (ai / (ai + bi))) + (bi - 1) * np.log((1 - t) / (bi / (ai + bi))))
        assert abs(float(betainc(ai, bi, xi)) - f[t <= xi].sum() / f.sum()) < 1e-3


def test_large_counts_density_is_normalised(spark):
    for n in (50.0, 1e6, 1e10):
        post = spark.createDataFrame([("r", 0.6 * n, 0.4 * n)], "rule string, alpha double, beta double")
        sd = (0.24 / n) ** 0.5
        d = ST.beta_density(post, max(0.0001, 0.6 - 10 * sd), min(0.9999, 0.6 + 10 * sd), 4001, digits=15).toPandas()
        h = (min(0.9999, 0.6 + 10 * sd) - max(0.0001, 0.6 - 10 * sd)) / 4000
        assert float(d["density"].sum() * h) == pytest.approx(1.0, abs=1e-6)


def _fine_pooling(rows, nu=220, nv=200, half=9.0):
    """Plain fine grid: the group's effect integrated over eta around its likelihood, posterior over (mu, sigma)."""
    import numpy as np
    mu0, out = float(np.log(ST.BREAKEVEN / (1 - ST.BREAKEVEN))), []
    u = np.linspace(-5, 5, nu)
    v = (np.arange(nv) + 0.5) * 5 / nv
    mu, sg = mu0 + 0.3 * u[:, None], 0.4 * v[None]
    lp = -0.5 * u[:, None] ** 2 - 0.5 * v[None] ** 2
    for w, n in rows:
        c, se = np.log(w / (n - w)), (1 / w + 1 / (n - w)) ** 0.5
        eta = c + se * np.linspace(-half, half, 1201)
        ll = w * (eta - np.logaddexp(0, eta)) - (n - w) * np.logaddexp(0, eta)
        ll -= ll.max()
        logs, first, second = (np.empty((nu, nv)) for _ in range(3))
        th = 1 / (1 + np.exp(-eta))
        for i in range(nu):
            z = (eta[None] - mu[i]) / sg.T
            g = ll - 0.5 * z * z
            top = g.max(1, keepdims=True)
            f = np.exp(g - top)
            s = f.sum(1)
            logs[i] = top[:, 0] + np.log(s) - np.log(sg[0])
            first[i], second[i] = f @ th / s, f @ (th * th) / s
        lp = lp + logs
        out.append(first)
    wt = np.exp(lp - lp.max())
    wt /= wt.sum()
    return [float((wt * m).sum()) for m in out], float((wt * mu).sum()), float((wt * sg).sum())


@pytest.mark.parametrize("n", [300, 30_000, 3_000_000])
def test_pooling_at_any_count(spark, n):
    rows = [(round(r * n), n) for r in (0.55, 0.61, 0.585, 0.64)]
    theta, mu, sigma = _fine_pooling(rows)
    df = spark.createDataFrame([(f"r{i}", w, k) for i, (w, k) in enumerate(rows)], "rule string, wins bigint, n bigint")
    got = {r.rule: r for r in ST.partial_pooling(df, digits=9).collect()}
    for i, t in enumerate(theta):
        assert got[f"r{i}"].theta_mean == pytest.approx(t, abs=1e-5)
    assert got["r0"].mu_mean == pytest.approx(mu, abs=2e-4) and got["r0"].sigma_mean == pytest.approx(sigma, abs=2e-4)


@pytest.mark.parametrize("n", [30, 3_000_000])
def test_hdi_is_the_shortest_interval(spark, n):
    import numpy as np
    rows = [(round(r * n), n) for r in (0.5, 0.6, 0.7)]
    df = spark.createDataFrame([(f"r{i}", w, k) for i, (w, k) in enumerate(rows)], "rule string, wins bigint, n bigint")
    fit = ST.Pooled(df, ST.BREAKEVEN, 0.3, 0.4)
    rng = np.random.default_rng(1)
    for r in ST.hdi(df, digits=12).collect():
        w, k = rows[int(r.rule[1:])]
        cell = rng.choice(len(fit.weight), 40_000, p=fit.weight)
        # sample the group's effect in each cell by weighting a wide set of draws
        c, se = np.log(w / (k - w)), (1 / w + 1 / (k - w)) ** 0.5
        sd = 1 / np.sqrt(1 / se ** 2 + 1 / fit.sigma[cell] ** 2)
        m = sd ** 2 * (c / se ** 2 + fit.mu[cell] / fit.sigma[cell] ** 2)
        eta = m + 1.3 * sd * rng.standard_normal(len(cell))
        lw = w * (eta - np.logaddexp(0, eta)) - (k - w) * np.logaddexp(0, eta) - 0.5 * ((eta - fit.mu[cell]) / fit.sigma[cell]) ** 2 \
            + 0.5 * ((eta - m) / (1.3 * sd)) ** 2
        logl = dict(fit.cells.filter((F.col("wins") == w) & (F.col("n") == k)).select("cell", "logl").collect())
        lw += np.log(sd) - np.log(fit.sigma[cell]) - np.array([logl[int(x)] for x in cell])
        wt = np.exp(lw - lw.max())
        th = 1 / (1 + np.exp(-eta))
        inside = wt[(th >= r.hdi_lo) & (th <= r.hdi_hi)].sum() / wt.sum()
        assert inside == pytest.approx(0.94, abs=0.01)
        o = np.argsort(th)
        cum = np.cumsum(wt[o]) / wt.sum()
        shortest = min(th[o][np.searchsorted(cum, q + 0.94)] - th[o][np.searchsorted(cum, q)] for q in np.linspace(0.005, 0.055, 41))
        assert r.hdi_hi - r.hdi_lo <= shortest * 1.02


def test_equal_groups_are_one_row_a_node(spark):
    rows = [(f"r{i}", 60 + i % 2, 100) for i in range(40)]
    df = spark.createDataFrame(rows, "rule string, wins bigint, n bigint")
    fit = ST.Pooled(df, ST.BREAKEVEN, 0.3, 0.4)
    assert fit.cells.count() == 2 * len(fit.mu) and {r[0] for r in fit.cells.select("times").distinct().collect()} == {20}
    single = spark.createDataFrame(rows[:1], df.schema).unionByName(df.filter("rule <> 'r0'"))
    got = {r.rule: r.theta_mean for r in ST.partial_pooling(single).collect()}
    assert len(got) == 40 and len(set(got.values())) == 2
    assert ST.hdi(df).count() == 40


def test_hdi_contains_mean(counts):
    rules = counts.filter("rule != 'ALL'")
    h = {r.rule: r for r in ST.hdi(rules).collect()}
    p = {r.rule: r.theta_mean for r in ST.partial_pooling(rules).collect()}
    for k in h:
        assert h[k].hdi_lo < p[k] < h[k].hdi_hi
        assert 0.05 < h[k].hdi_hi - h[k].hdi_lo < 0.2


@given(st.integers(1, 60), st.integers(0, 60))
@settings(max_examples=15, deadline=None)
def test_posterior_between_prior_and_rate(wins, extra):
    n = wins + extra
    a, b = ST.BREAKEVEN * 80 + wins, (1 - ST.BREAKEVEN) * 80 + (n - wins)
    mean, raw = a / (a + b), wins / n
    lo, hi = sorted([ST.BREAKEVEN, raw])
    assert lo - 1e-12 <= mean <= hi + 1e-12


# ---------------------------------------------------------------- plan shapes

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_h2h_plan_has_no_nested_loop(spark):
    plan = _plan(E.queries()["feat_h2h"](spark, SF))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_flagship_and_consensus_stay_in_jvm(spark):
    for key in ("feat_table_full", "odds_consensus", "join_longest_prefix", "fn_regex_html_rows"):
        plan = _plan(E.queries()[key](spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_team_rolling_single_exchange(spark):
    from tallyline.sources.fixtures import games_v
    from tallyline.plans.features import base_games
    df = W.team_rolling(to_long(base_games(games_v(spark, SF))))
    plan = _plan(df)
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") <= 2


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = E.queries()["src_incremental_cutoff"](spark, SF)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    vc = _plan(E.queries()["agg_value_counts"](spark, SF))
    assert "ReadSchema: struct<l_suppkey:bigint>" in vc


# ---------------------------------------------------------------- properties

@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 30)), min_size=1, max_size=12))
@settings(max_examples=8, deadline=None)
def test_upsert_idempotent(spark, rows):
    tgt = spark.createDataFrame([(i, float(i)) for i in range(4)], "id int, v double")
    src = spark.createDataFrame(list({k: (k, float(v)) for k, v in rows}.values()), "id int, v double")
    once = MU.merge_upsert(tgt, src, "id")
    twice = MU.merge_upsert(once, src, "id")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_rolling_ignores_later_scores(spark):
    from tallyline.sources.fixtures import games_v
    g = games_v(spark, SF).filter(F.col("home_classification") == "fbs")
    cut = dt.datetime(1998, 1, 1)
    changed = g.withColumn("home_points", F.when(F.col("start_ts") >= F.lit(cut), F.lit(99.0))
                           .otherwise(F.col("home_points")))
    cols = ["id", "side", "avg_points_l5", "season_win_pct", "games_played", "avg_points_l5_carryover"]
    a = W.team_rolling(to_long(g)).filter(F.col("start_ts") < F.lit(cut)).select(*cols)
    b = W.team_rolling(to_long(changed)).filter(F.col("start_ts") < F.lit(cut)).select(*cols)
    assert a.exceptAll(b).count() == 0


# ---------------------------------------------------------------- streaming

def test_files_out_of_order_lose_no_row_on_time(spark, tmp_path):
    """200 files in shuffled order of time; rows up to seven days late count, planted later ones are set aside."""
    import datetime as dt
    import random

    from tallyline.streaming import streams as SS
    rng, t0 = random.Random(5), dt.datetime(2024, 3, 1)
    rows = []
    for i in range(200):
        for _ in range(5):
            ts = t0 + dt.timedelta(days=i, hours=rng.randrange(24))
            rows.append((ts, rng.choice("ab"), 1.0, (ts + dt.timedelta(days=rng.choice([0, 0, 1, 7, 8, 30]))).date(), i))
    rows += [(None, "a", 1.0, dt.date(2024, 3, 1), 0), (t0, "a", 1.0, None, 0)]
    order = list(range(200))
    rng.shuffle(order)
    schema = "ts timestamp_ntz, k string, v double, landed date"
    for place, i in enumerate(order):
        spark.createDataFrame([r[:4] for r in rows if r[4] == i], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
        if place == 120:                                     # a first run, then the rest
            break
    def run():
        stream = SS.read_landing(spark, f"{tmp_path}/landing", spark.read.parquet(f"{tmp_path}/landing").schema, max_files=50)
        SS.late_corrections(stream, "ts", "landed", "k", "v", f"{tmp_path}/c", f"{tmp_path}/late", f"{tmp_path}/ckpt")
    run()
    rest = [r[:4] for r in rows if r[4] in order[121:]]
    spark.createDataFrame(rest, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
    run()
    got = SS.corrected_counts(spark, f"{tmp_path}/c", f"{tmp_path}/late", "ts", "k").collect()
    late = [r for r in rows if r[0] is None or r[3] is not None and (r[3] - r[0].date()).days > 7]
    assert spark.read.parquet(f"{tmp_path}/late").count() == len(late) == sum(r.n_refused for r in got)
    want = {}
    for r in rows:
        if r not in late:
            want[r[0].date(), r[1]] = want.get((r[0].date(), r[1]), 0) + 1
    assert {(r.window_start.date(), r.k): r.n for r in got if r.n} == want and sum(want.values()) + len(late) == len(rows)


def test_stream_dedup_writes_only_what_a_batch_carries(spark, tmp_path):
    """Later batches leave the files of earlier ones alone; a stream of another checkpoint adds to them."""
    import glob
    from tallyline.streaming import streams as SS
    schema = "k long, at int, v string, part long"
    land, keys, order = f"{tmp_path}/landing", ["k"], ["at", "v"]
    quotes = [[(1, 5, "a", 1), (1, 5, "b", 1), (2, 3, None, 0), (None, 1, "n", None)],
              [(1, 4, "c", 1), (2, 3, "x", 0), (3, 9, "y", 1)], [(1, 8, "d", 1), (None, 0, "m", None)]]
    run = lambda n: SS.stream_dedup(
        SS.read_landing(spark, land, spark.read.parquet(land).schema, max_files=1), keys, order,
        f"{tmp_path}/t", f"{tmp_path}/ckpt{n}", "part")
    seen = {}
    for n, rows in enumerate(quotes):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        run(0)
        files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/t/**/*.parquet", recursive=True)}
        assert seen.items() <= files.items() and len(files) > len(seen)
        seen = files
    got = lambda: sorted((tuple(r) for r in SS.first_quotes(spark, f"{tmp_path}/t", keys, order)
                          .select("k", "at", "v", "part").collect()), key=str)
    want = sorted([(1, 4, "c", 1), (2, 3, None, 0), (3, 9, "y", 1), (None, 0, "m", None)], key=str)
    assert got() == want
    spark.createDataFrame([(3, 1, "z", 1)], schema).write.mode("append").parquet(land)
    run(1)
    assert got() == sorted([(3, 1, "z", 1) if r[0] == 3 else r for r in want], key=str)


def test_late_data_dropped_after_watermark(spark):
    """Rows within the 7-day lateness are applied; older ones are dropped.
    Spark judges late rows against the watermark of the previous micro-batch
    (the late-event watermark trails the eviction watermark by one batch),
    hence three landing batches."""
    import time
    from tallyline.streaming import streams as SS
    root = tempfile.mkdtemp(prefix="tl-stream-")
    schema = "ts timestamp_ntz, k string, value double"
    batches = [[(dt.datetime(2024, 1, 20, 12), "a", 1.0), (dt.datetime(2024, 1, 10, 12), "a", 1.0)],
               [(dt.datetime(2024, 1, 19, 12), "a", 1.0)],
               [(dt.datetime(2024, 1, 5, 12), "a", 5.0),     # 15 days behind the max seen: dropped
                (dt.datetime(2024, 1, 18, 12), "a", 2.0)]]   # 2 days late: applied
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/landing/b={i}")
        time.sleep(1.1)                                      # distinct file times -> arrival order
    stream = SS.read_landing(spark, f"{root}/landing", spark.read.parquet(f"{root}/landing").schema, max_files=1)
    SS.windowed_upsert(SS.late_tolerant_counts(stream, "ts", "k", "value"), f"{root}/c",
                       ["window_start", "k"], f"{root}/ckpt")
    out = {r.window_start.day: (r.n, r.total) for r in spark.read.parquet(f"{root}/c").collect()}
    assert out == {20: (1, 1.0), 19: (1, 1.0), 10: (1, 1.0), 18: (1, 2.0)}
    assert os.path.isdir(f"{root}/ckpt/commits")


def test_no_cross_or_row_udf_anywhere(spark):
    """No registered query plans a nested-loop / cartesian join or a
    row-at-a-time Python UDF; Arrow UDFs only in the Beta-quantile queries."""
    arrow_ok = {"stat_credible_interval", "stat_prob_at_least", "udaf_beta_interval", "stat_hdi", "stat_partial_pooling"}
    for k, q in sorted(registry.QUERIES.items()):
        plan = _plan(q(spark, SF))        # sinks, streams and chains run while building; this is their last plan
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, k
        assert "BatchEvalPython" not in plan, k
        if k not in arrow_ok:
            assert "ArrowEvalPython" not in plan, k


@given(st.lists(st.sampled_from([-3.0, -2.5, -1.0, 0.0, 1.5]), min_size=1, max_size=9))
@settings(max_examples=10, deadline=None)
def test_mode_is_an_input(spark, vals):
    from tallyline.operators import aggregates as A
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(vals)], "k int, pos int, v double")
    m = A.mode_by_counts(df, "k", "v").collect()[0]["mode"]
    assert m in vals and vals.count(m) == max(vals.count(x) for x in vals)
    line = A.mode_or_median(df, "k", "v", ["pos"]).collect()[0]["line"]
    if len(set(vals)) < len(vals):
        assert line in vals


def test_feature_columns_are_shuffled_once_before_they_meet_their_game(spark):
    """strength of schedule and the leave-one-out figures do not drag the rolling features through their shuffles."""
    import re

    from pyspark.sql import functions as F
    from tallyline.operators import buckets as B
    from tallyline.operators.longform import to_long
    from tallyline.plans import features as FT

    made = spark.range(400).select(
        "id", (2020 + F.col("id") % 2).cast("int").alias("season"), (1 + F.col("id") % 15).cast("int").alias("week"),
        F.expr("timestamp_ntz'2020-09-01 00:00:00' + make_dt_interval(cast(id / 4 as int))").alias("start_ts"),
        F.when(F.col("id") % 29 != 0, F.col("id") % 5).alias("home_team"), (5 + F.col("id") % 4).alias("away_team"),
        F.when(F.col("id") % 13 != 0, (F.col("id") * 7 % 40).cast("double")).alias("home_points"),
        F.when(F.col("id") % 17 != 0, (F.col("id") * 11 % 40).cast("double")).alias("away_points"),
        (F.col("id") % 9 - 4).cast("double").alias("mode_spread"))
    plan = FT.team_features(made)._sc._jvm.PythonSQLUtils.explainString(
        FT.team_features(made)._jdf.queryExecution(), "formatted")
    shuffled = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert shuffled and sum("avg_points_l5_carryover" in cols for cols in shuffled) == 1

    # with every game twice as well: what the joins on (id, side) gave
    for base in (made, made.unionByName(made)):
        long = to_long(base)
        loo = B.leave_one_out(long)
        want = {(r.id, r.side): (r.p, r.a, r.w) for r in loo.groupBy("id", "side").agg(
            F.max("avg_points").alias("p"), F.max("avg_allowed").alias("a"), F.max("win_rate").alias("w")).collect()}
        copies = 1 if base is made else 4
        pct = {(r.id, r.side): r.v for r in B.team_rolling(long).join(loo.select("id", "side"), ["id", "side"])
               .groupBy("id", "side").agg(F.max("season_win_pct").alias("v")).collect()}
        seen, sos = {}, {}
        for r in sorted(loo.collect(), key=lambda r: (r.start_ts, r.id)):
            value = pct.get((r.id, "away" if r.side == "home" else "home"))
            for _ in range(copies // (2 if copies > 1 else 1)):
                held = seen.setdefault((r.team, r.season), [])
                held += [value] if value is not None else []
                was = sos.get((r.id, r.side), 0)
                sos[r.id, r.side] = max(was, len(held))
        rows = FT.team_features(base).collect()
        assert len(rows) == 400
        for r in rows:
            for s in ("home", "away"):
                got = (r[f"{s}_avg_points"], r[f"{s}_avg_allowed"], r[f"{s}_win_rate"])
                assert got == want.get((r.id, s), (None, None, None))
                assert r[f"{s}_sos_sample_size"] == sos.get((r.id, s))
