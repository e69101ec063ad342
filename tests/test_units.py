"""Operator units on small literal frames, one per semantics trap."""

import datetime as dt
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tallyline.functions import html as H
from tallyline.operators import aggregates as A
from tallyline.operators import grading as GR
from tallyline.operators import mutation as MU
from tallyline.operators import names as N
from tallyline.operators import windows as W
from tallyline.operators.h2h import h2h, h2h_features
from tallyline.operators.longform import to_long
from tallyline.sources import readers as R

D = dt.datetime


def games(spark, rows):
    cols = "id season week start_ts home_team away_team home_points away_points mode_spread".split()
    return spark.createDataFrame([Row(**dict(zip(cols, r))) for r in rows],
                                 "id long, season int, week int, start_ts timestamp_ntz, home_team long, "
                                 "away_team long, home_points double, away_points double, mode_spread double")


@pytest.fixture(scope="module")
def g(spark):
    return games(spark, [
        (1, 2020, 1, D(2020, 9, 1), 1, 2, 21.0, 14.0, -3.0),
        (2, 2020, 2, D(2020, 9, 8), 2, 1, 10.0, 30.0, None),    # unquoted
        (3, 2020, 3, D(2020, 9, 15), 1, 3, None, None, -7.0),   # unplayed
        (4, 2020, 3, D(2020, 9, 15), 2, 3, 17.0, 17.0, 0.0),    # same timestamp as 3 (tie)
        (5, 2021, 1, D(2021, 9, 1), 1, 2, 3.0, 7.0, 1.5),
        (6, 2021, 2, D(2021, 9, 9), 1, 2, 35.0, 0.0, -10.0),
    ])


def test_long_form_two_rows_and_nulls(g):
    long = {(r.id, r.side): r for r in to_long(g).collect()}
    assert len(long) == 12
    h, a = long[(1, "home")], long[(1, "away")]
    assert (h.won, a.won, h.margin, a.margin) == (1, 0, 7.0, 7.0)      # margin is unsigned (Q6)
    assert (h.spread, a.spread) == (-3.0, 3.0)
    assert h.beat_spread == 1 and a.beat_spread == 0                    # 7 > -3 (compat, Q1)
    assert long[(2, "home")].beat_spread is None                        # unquoted
    assert long[(3, "home")].won is None and long[(3, "home")].beat_spread is None


def test_rolling_first_row_and_tie_order(g):
    tr = {(r.id, r.team): r for r in W.team_rolling(to_long(g)).collect()}
    first = tr[(1, 1)]
    assert first.avg_points_l5 is None and first.games_played == 0
    # team 3 plays games 3 and 4 at the same timestamp: ordered by id
    assert tr[(3, 3)].games_played == 0 and tr[(4, 3)].games_played == 1
    # unscored game counts in games_played (F8) and in the QC counter
    assert tr[(4, 3)].unscored_games_in_l3_window == 1
    # carry-over crosses the season boundary, season window resets
    assert tr[(5, 1)].avg_points_l5 is None
    assert tr[(5, 1)].avg_points_l5_carryover == pytest.approx((21.0 + 30.0) / 2)


def test_rest_days_same_side(g):
    long = W.rest_days(to_long(g))
    rd = {(r.id, r.team): r.rest_days for r in long.collect()}
    assert rd[(1, 1)] is None            # first home game of the season
    assert rd[(3, 1)] == 14              # previous HOME game of team 1 (Q4)
    assert rd[(2, 1)] is None            # team 1's first away game


def test_h2h_defaults_and_lookback(spark):
    gg = games(spark, [
        (1, 2016, 1, D(2016, 9, 1), 1, 2, 10.0, 3.0, 0.0),    # 5 seasons back: outside lookback 3
        (2, 2018, 1, D(2018, 9, 1), 2, 1, 14.0, 7.0, 0.0),    # in range, team 2 won at home
        (3, 2019, 1, D(2019, 9, 1), 1, 2, None, None, 0.0),   # in range, unscored
        (4, 2021, 1, D(2021, 9, 1), 1, 2, 0.0, 0.0, 0.0),
        (5, 2021, 2, D(2021, 9, 8), 3, 4, 0.0, 0.0, 0.0),     # no prior meeting
    ])
    out = {r.id: r for r in h2h(gg).collect()}
    assert out[4].h2h_games == 2                                  # 2018, 2019
    assert out[4].home_h2h_win_rate == 0.0                         # team 1 won neither; unscored = 0
    assert out[4].home_h2h_avg_margin == -7.0                      # from team 1's view, scored only
    assert out[5].h2h_games == 0 and out[5].home_h2h_win_rate == 0.0   # Q3: 0.0, not 0.5
    feats = {r.id: r for r in h2h_features(gg).collect()}
    assert feats[5].home_h2h_avg_margin == 0.0


def test_h2h_symmetric_in_venue(spark):
    a = games(spark, [(1, 2019, 1, D(2019, 9, 1), 1, 2, 20.0, 10.0, 0.0),
                      (2, 2020, 1, D(2020, 9, 1), 1, 2, 0.0, 0.0, 0.0)])
    b = games(spark, [(1, 2019, 1, D(2019, 9, 1), 2, 1, 10.0, 20.0, 0.0),
                      (2, 2020, 1, D(2020, 9, 1), 1, 2, 0.0, 0.0, 0.0)])
    ra = [r for r in h2h(a).collect() if r.id == 2][0]
    rb = [r for r in h2h(b).collect() if r.id == 2][0]
    assert (ra.h2h_games, ra.home_h2h_win_rate, ra.home_h2h_avg_margin) == \
           (rb.h2h_games, rb.home_h2h_win_rate, rb.home_h2h_avg_margin) == (1, 1.0, 10.0)


def test_mode_min_tie_nulls_empty(spark):
    df = spark.createDataFrame([(1, "3.5"), (1, "3.0"), (1, "3.5"), (1, "3.0"), (1, None), (1, "bad"),
                                (2, None), (3, "-7")], "k int, v string")
    out = {r.k: r.mode_spread for r in A.mode_spread(df, "k", "v").collect()}
    assert out == {1: 3.0, 2: None, 3: -7.0}


def test_mode_by_counts_avg(spark):
    df = spark.createDataFrame([(1, 3.0), (1, 4.0), (1, 3.0), (1, 4.0), (1, 9.0)], "k int, v double")
    assert A.mode_by_counts(df, "k", "v", tie="avg").collect()[0]["mode"] == 3.5
    assert A.mode_by_counts(df, "k", "v", tie="min").collect()[0]["mode"] == 3.0


def test_mode_or_median(spark):
    df = spark.createDataFrame([
        (1, 1, -3.0), (1, 2, -2.5), (1, 3, -4.0),               # all distinct -> median
        (2, 1, 7.0),                                            # single -> itself
        (3, 1, 2.0), (3, 2, 1.0), (3, 3, 1.0), (3, 4, 2.0),     # tie -> first encountered (2.0)
        (4, 1, 1.0), (4, 2, 2.0), (4, 3, 3.0), (4, 4, 4.0)],    # even count median
        "k int, pos int, v double")
    out = {r.k: r.line for r in A.mode_or_median(df, "k", "v", ["pos"]).collect()}
    assert out == {1: -3.0, 2: 7.0, 3: 2.0, 4: 2.5}


def test_pick_line_preferred_and_fallback(spark):
    df = spark.createDataFrame([
        (1, 0, "a", -3.0, -2.0), (1, 1, "consensus", -3.5, -3.0),
        (2, 0, "a", -1.0, None), (2, 1, "consensus", None, 5.0),   # consensus spread NULL -> first line
        (3, 0, "a", None, None),                                  # nothing -> dropped
        (4, 0, "b", 2.0, 1.0)],
        "id int, pos int, provider string, spread double, spread_open double")
    out = {r.id: (r.mode_spread, r.mode_spread_open) for r in A.pick_line(df, "id", "pos").collect()}
    assert out == {1: (-3.5, -3.0), 2: (-1.0, None), 4: (2.0, 1.0)}


def test_pick_line_nested_python_literal(spark):
    text = spark.createDataFrame(
        [(7, "[{'provider': 'x', 'spread': '-4', 'spreadOpen': None}, "
             "{'provider': 'consensus', 'spread': None, 'spreadOpen': '-3'}]")], "id long, lines string")
    parsed = R.parse_lines(text)
    r = A.pick_line_nested(parsed).collect()[0]
    assert (r.mode_spread, r.mode_spread_open) == (-4.0, None)


def test_longest_prefix_names(spark):
    d = spark.createDataFrame([("Miami",), ("Miami (OH)",), ("Texas",), ("Texas A&M",)], "team string")
    n = spark.createDataFrame([("Miami (OH) RedHawks",), ("Miami Hurricanes",), ("Texas A&M Aggies",),
                               ("Nowhere State",), ("Texas",)], "name string")
    ov = spark.createDataFrame([("Nowhere State", "NWS")], "name string, canonical string")
    out = {r.name: (r.canonical, r.matched) for r in N.resolve_names(n, d, ov).collect()}
    assert out["Miami (OH) RedHawks"] == ("Miami (OH)", True)
    assert out["Miami Hurricanes"] == ("Miami", True)
    assert out["Texas A&M Aggies"] == ("Texas A&M", True)
    assert out["Nowhere State"] == ("NWS", True)
    assert out["Texas"] == ("Texas", False)          # equal to an entry: prefix needs a following space
    assert [r.name for r in N.unmatched_names(n, d, ov).collect()] == ["Texas"]


def test_merge_semantics(spark):
    tgt = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b"), (3, None, "c")], "id int, v double, s string")
    src = spark.createDataFrame([(2, None), (4, 4.0)], "id int, v double")
    up = {r.id: (r.v, r.s) for r in MU.merge_upsert(tgt, src, "id").collect()}
    assert up == {1: (1.0, "a"), 2: (None, "b"), 3: (None, "c"), 4: (4.0, None)}   # NULL overwrites; Q11
    keep = {r.id: r.v for r in MU.merge_upsert(tgt, src, "id", preserve_non_null=True).collect()}
    assert keep[2] == 2.0
    guarded = {r.id: r.v for r in MU.merge_update(tgt, src.withColumnRenamed("v", "w"), "id", {"v": "w"},
                                                   target_pred=F.col("v").isNull()).collect()}
    assert guarded == {1: 1.0, 2: 2.0, 3: None}
    assert MU.assert_unique(src.unionByName(src), "id").count() == 2


def test_null_predicates_keep_rows(spark):
    t = spark.createDataFrame([(1, 5), (2, None), (3, 20)], "id int, x int")
    assert sorted(r.id for r in MU.delete(t, F.col("x") > 10).collect()) == [1, 2]
    upd = {r.id: r.x for r in MU.update(t, F.col("x") > 1, {"x": F.lit(0)}).collect()}
    assert upd == {1: 0, 2: None, 3: 0}


def test_refresh_window_idempotent(spark):
    t = spark.createDataFrame([(1, "2024-01-10", 1.0), (2, "2024-02-20", 2.0)], "id int, gameday string, v double")
    s = spark.createDataFrame([(1, "2024-01-10", 9.0), (1, "2024-01-10", 9.0), (3, "2024-01-16", 3.0)],
                              "id int, gameday string, v double")
    once = MU.refresh_window(t, s, "gameday", "2024-01-15")
    twice = MU.refresh_window(once, s, "gameday", "2024-01-15")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.id: r.v for r in once.collect()} == {1: 9.0, 2: 2.0, 3: 3.0}


def test_known_corrections(spark):
    facts = spark.createDataFrame([(400763592, -4.0), (400876095, -8.5), (1, 3.0)], "id long, mode_spread double")
    reg = spark.createDataFrame([], "game_id long, verified_spread double")
    upd = spark.createDataFrame([(400763592, -7.0), (400876095, -5.5)], "game_id long, verified_spread double")
    _, out = MU.apply_corrections(facts, reg, upd)
    assert {r.id: r.mode_spread for r in out.collect()} == {400763592: -7.0, 400876095: -5.5, 1: 3.0}


def test_html_opening_value(spark):
    page = ("<table><tr><th>Date</th><th>x</th></tr>"
            "<tr><td>a</td><td>b</td><td>n/a</td><td>d</td><td>Open</td></tr>"          # unparsable -> next
            "<tr><td>a</td><td><b>b</b></td><td> -3.5 </td><td>d</td><td>Open</td></tr>"
            "<tr><td>a</td><td>b</td><td>PICK</td><td>d</td><td>Open</td></tr></table>")
    pick = "<table><tr><td>a</td><td>b</td><td>Pick</td><td>d</td><td>Open</td></tr></table>"
    few = "<table><tr><td>Open</td><td>-3</td><td>1</td></tr></table>"
    df = spark.createDataFrame([(1, page), (2, pick), (3, few)], "id int, html string")
    out = {r.id: r.v for r in df.select("id", H.opening_value(F.col("html")).alias("v")).collect()}
    assert out == {1: 3.5, 2: 0.0, 3: None}


def test_ats_orders(spark):
    df = spark.createDataFrame([(20, 20, -0.005), (20, 17, 3.0), (None, 3, 1.0)],
                               "home_score int, away_score int, spread_line double")
    rows = GR.grade_ats(df).collect()
    assert (rows[0].cover, rows[0].ats_result) == ("HOME", "PUSH")      # HOME before PUSH vs PUSH first
    assert (rows[1].cover, rows[1].ats_result, rows[1].home_covered) == ("PUSH", "PUSH", 0)
    assert rows[2].cover is None
    graded = GR.grade_scores(df.withColumn("total_line", F.lit(37.0))).collect()
    assert graded[1].spread_result == "push" and graded[1].over_under_result == "push"
    assert graded[2].game_result is None


def test_flatten_odds_fallbacks(spark):
    doc = ('{"id": "e1", "commence_time": "2024-09-01T17:00:00Z", "home_team": "H", "away_team": "A", '
           '"bookmakers": [{"key": "b1", "title": "B1", "last_update": "2024-08-30T10:00:00Z", "markets": ['
           '{"key": "h2h", "outcomes": [{"name": "H", "price": -150}, {"price": 130}]}]},'
           '{"key": "b2", "title": "B2", "last_update": "2024-08-30T11:00:00Z", "markets": []}]}')
    docs = spark.createDataFrame([(doc,)], "value string").select(
        F.from_json("value", R.ODDS_DOC).alias("d")).select("d.*")
    rows = R.flatten_odds(docs).collect()
    assert len(rows) == 2                                   # book without markets dropped
    assert {r.outcome_name for r in rows} == {"H", ""}      # missing name -> ''
    assert all(r.last_update is not None for r in rows)     # market falls back to book's last_update


def test_split_plan_equals_plain_windows_for_a_hot_team(spark):
    """One team holds 90 % of the rows; the split plan gives the plain window's answers, and no
    window partition holds more than one team's games of one bucket."""
    from tallyline.operators import buckets as B
    from tallyline.plans import features as FT
    from tallyline.sources.fixtures import games_v
    g = games_v(spark, "/root/testdata/sf0.001").withColumns({
        "home_team": F.when(F.col("id") % 20 < 17, F.lit(0)).otherwise(F.col("home_team")),
        "away_team": F.when(F.col("id") % 20 < 13, F.lit(1)).otherwise(F.col("away_team"))}) \
        .filter("home_team <> away_team")
    long = to_long(FT.base_games(g))
    for days in (3, 28, 400):
        a = B.team_rolling(long, days)
        b = W.team_rolling(W.rest_days(long)).select(*a.columns)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    loo = ["avg_points", "avg_allowed", "win_rate"]
    a = B.leave_one_out(long).select("id", "side", *loo)
    b = W.leave_one_out(long).select("id", "side", *loo)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    x = long.withColumn("v", F.col("margin") / 7)
    a = {(r.id, r.side): (r.m, r.n) for r in B.running_mean(x, "v", "m", "n").collect()}
    b = {(r.id, r.side): (r.m, r.n) for r in x.select(
        "*", *W.cumulative_incl("v", ("team", "season"), "m", "n")).collect()}
    assert a.keys() == b.keys()
    assert all(a[k][1] == b[k][1] and (a[k][0] or 0.0) == pytest.approx(b[k][0] or 0.0, rel=1e-12) for k in a)
    spread = B.with_bucket(long).groupBy("team", "season", "bucket").count().agg(F.max("count")).first()[0]
    assert spread < 0.05 * long.count()


def test_corrected_modes(spark, g):
    """Q1/Q2 switches: corrected cover test and earlier-games-only splits."""
    from tallyline.plans import features as FT
    rows = {r.id: r for r in g.select("id", *FT.grade_margin_cols("corrected")).collect()}
    assert rows[1].home_covered_spread == 1          # won by 7 as a 3-point favourite: 7 - 3 > 0
    assert rows[5].home_covered_spread == 0          # lost by 4 getting 1.5
    long = W.leave_one_out_corrected(to_long(g))
    loo = {(r.id, r.team): r.avg_points for r in long.collect()}
    assert loo[(1, 1)] is None                       # first home game: nothing earlier
    assert loo[(3, 1)] == 21.0                       # earlier home game only (not later ones)


def test_flagship_lineage_cut(spark):
    from tallyline.plans.features import feature_table
    from tallyline.plans.catalog_features import high_variance
    from tallyline.sources.fixtures import corrections_v, games_v
    sf = "/root/testdata/sf0.001"
    gg = games_v(spark, sf)
    a = feature_table(gg, high_variance(spark, sf), corrections_v(gg))
    b = feature_table(gg, high_variance(spark, sf), corrections_v(gg), cut_lineage=True)
    assert a.exceptAll(b).count() == 0 and b.count() == a.count()


def test_building_the_flagship_runs_no_job(spark):
    from tallyline.plans.catalog_features import feature_table_query
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "planning")
    try:
        feature_table_query(spark, "/root/testdata/sf0.001")
        # schema inference of the Parquet inputs may run a job each; nothing reads their rows
        assert len(tracker.getJobIdsForGroup("plan-only")) <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_python_literals_keep_quoted_words(spark):
    from tallyline.functions.scalar import parse_list
    schema = "array<struct<provider:string,spread:double,live:boolean>>"
    rows = [("[{'provider': 'None', 'spread': None, 'live': True}]",),
            ("""[{'provider': 'Caesars "True" NJ', 'spread': -3.5, 'live': False}]""",),
            ('[{"provider": "It\'s None, False", "spread": 1, "live": true}]',)]
    df = spark.createDataFrame(rows, "s string")
    got = [tuple(r.v[0]) for r in df.select(parse_list("s", schema).alias("v")).collect()]
    assert got == [("None", None, True), ('Caesars "True" NJ', -3.5, False), ("It's None, False", 1.0, True)]


def test_rescheduled_event_uses_all_its_quotes(spark):
    from tallyline.operators.consensus import consensus
    d = dt.datetime(2024, 1, 1)
    rows = [(1, d if k < 2 else d + dt.timedelta(days=1), "H", "A", f"b{k}", "spreads", "H", -110.0, p, d, k)
            for k, p in enumerate([-3.0, -3.0, -7.0])]
    q = spark.createDataFrame(rows, "event_id long, commence_time timestamp_ntz, home_team string, away_team string, "
                              "bookmaker string, market string, outcome_name string, outcome_price double, "
                              "outcome_point double, last_update timestamp_ntz, line_no int")
    got = consensus(q).collect()
    assert [(r.consensus_spread, r.spread_books) for r in got] == [(-3.0, 3)] * 2


def test_std_exactly_on_the_threshold(spark):
    from tallyline.operators.aggregates import dispersion
    rows = [(1, 0.5), (1, 3.5), (1, 0.5), (1, 3.5)] + [(2, 0.5), (2, 3.0), (2, 0.5), (2, 3.5)]
    got = dispersion(spark.createDataFrame(rows, "k int, v double"), "k", "v", min_std=1.5).collect()
    assert [(r.game_id, r.std_dev) for r in got] == [(1, 1.5)]


def test_partition_rewrites(spark, tmp_path):
    """A key that changes partition, a partition that empties, and a first load."""
    from tallyline.sources import tables as TB
    path, schema = str(tmp_path / "t"), "id int, v double, season int"
    make = lambda *rows: spark.createDataFrame(list(rows), schema)
    read = lambda: sorted(tuple(r) for r in spark.read.parquet(path).select("id", "v", "season").collect())
    assert TB.upsert_partitions(spark, path, make((1, 1.0, 2001), (2, 2.0, 2001), (3, 3.0, 2003)), "id") == [2001, 2003]
    assert TB.upsert_partitions(spark, path, make((3, 9.0, 2002), (4, 4.0, 2002)), "id") == [2002, 2003]
    assert read() == [(1, 1.0, 2001), (2, 2.0, 2001), (3, 9.0, 2002), (4, 4.0, 2002)]
    TB.rewrite_partitions(spark, path, {2001}, lambda cur: cur.filter("id > 5"))
    assert read() == [(3, 9.0, 2002), (4, 4.0, 2002)]
    with pytest.raises(ValueError):
        TB.rewrite_partitions(spark, path, {2002}, lambda cur: cur.withColumn("season", F.lit(1)))


def test_merge_reads_touched_partitions_only(spark, tmp_path):
    """With the data files of every untouched partition broken, a MERGE whose keys lie elsewhere still runs."""
    import glob
    from tallyline.sources import tables as TB
    path = str(tmp_path / "t")
    rows = spark.range(400).selectExpr("id", "0 AS v", "CAST(2000 + id % 8 AS INT) AS season")
    TB.create_partitioned(rows, path, "id")
    for season in (2001, 2002, 2004, 2005, 2006, 2007):
        for f in glob.glob(f"{path}/season={season}/*.parquet"):
            with open(f, "r+b") as h:
                h.write(b"broken!!")
                h.truncate(8)
    for crc in glob.glob(f"{path}/*/.*.crc"):
        import os
        os.remove(crc)
    src = spark.createDataFrame([(0, 1, 2000), (8, 1, 2003), (9000, 1, 2003)], "id long, v int, season int")
    assert TB.upsert_partitions(spark, path, src, "id") == [2000, 2003]
    got = {r.id: (r.v, r.season) for r in spark.read.parquet(path).filter("season IN (2000, 2003)").collect()}
    assert got[0] == (1, 2000) and got[8] == (1, 2003) and got[9000] == (1, 2003) and got[16] == (0, 2000) and len(got) == 101
    with pytest.raises(Exception):
        spark.read.parquet(path).agg({"v": "sum"}).collect()
    # a second move is found by the index, which holds one place a key again
    assert TB.upsert_partitions(spark, path, spark.createDataFrame([(8, 2, 2000)], "id long, v int, season int"), "id") == [2000, 2003]
    held = spark.read.parquet(f"{path}/_keys").filter("id IN (0, 8, 9000)").collect()
    assert sorted((r.id, r.key_part) for r in held) == [(0, 2000), (8, 2000), (9000, 2003)]


def test_key_index_is_written_for_new_and_moved_keys_only(spark, tmp_path, monkeypatch):
    """A MERGE in place leaves the index files alone; one that inserts adds a file to its keys' buckets, up to a bound."""
    import glob
    from tallyline.sources import tables as TB
    monkeypatch.setattr(TB.KeyIndex, "BUCKET_KEYS", 50)
    monkeypatch.setattr(TB.KeyIndex, "MAX_FILES", 2)
    path, schema = str(tmp_path / "t"), "id long, v int, season int"
    TB.create_partitioned(spark.range(400).selectExpr("id", "0 AS v", "CAST(2000 + id % 8 AS INT) AS season"), path, "id")
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/_keys/**/*.parquet", recursive=True)}
    first = files()
    assert len(first) == 8
    TB.upsert_partitions(spark, path, spark.range(400).selectExpr("id", "1 AS v", "CAST(2000 + id % 8 AS INT) AS season"), "id")
    assert files() == first
    assert TB.upsert_partitions(spark, path, spark.createDataFrame([(900, 1, 2000)], schema), "id") == [2000]
    assert first.items() < files().items() and len(files()) == 9
    for i in range(901, 904):
        TB.upsert_partitions(spark, path, spark.range(i * 100, i * 100 + 99).selectExpr("id", "1 AS v", "2001 AS season"), "id")
    assert len(files()) <= 16
    # a place too many, as a job lost before its clean-up leaves it, is found and cleaned
    index = TB.KeyIndex.of(spark, path, "season")
    index.add(spark.createDataFrame([(0, 0, 2005)], schema))
    assert TB.upsert_partitions(spark, path, spark.createDataFrame([(0, 7, 2000)], schema), "id") == [2000, 2005]
    held = spark.read.parquet(f"{path}/_keys")
    assert [r.key_part for r in held.filter("id = 0").collect()] == [2000] and held.count() == 400 + 1 + 3 * 99
    assert spark.read.parquet(path).agg({"v": "sum"}).first()[0] == 399 + 7 + 1 + 3 * 99


def test_live_lines_meet_in_all_shuffle_partitions(spark):
    """Events and lines too many to broadcast are joined where their hash puts them, however few bytes they take; more
    aggregates ride along."""
    from tallyline.operators import consensus as C
    schema = "event_id long, home_team string, away_team string, bookmaker string, market string, outcome_name string, " \
             "outcome_point double, line_no int, commence_time int"
    quotes = spark.createDataFrame([(e, "h", "a", f"b{n}", "spreads", "a", 1.0 + n % 2, n, e + n)
                                    for e in range(40) for n in range(3)], schema)
    teams = spark.createDataFrame([("h", "H"), ("a", "A")], "team string, abbr string")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        got = C.live_spread(quotes, teams, extra=[F.max("commence_time").alias("commence_time")])
        rows = got.collect()
        assert got.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set(limit, was)
    assert sorted((r.event_id, r.away_team_abbr, r.spread_line, r.num_books, r.commence_time) for r in rows) == [
        (e, "A", 1.0, 3, e + 2) for e in range(40)]
    assert "commence_time" not in C.live_spread(quotes, teams).columns


def test_partition_names_with_special_characters(spark, tmp_path):
    """Partitions that empty are found under the names they were written by."""
    from tallyline.sources import tables as TB
    path, schema = str(tmp_path / "a b"), "id int, v int, p string"
    names = ["x/y", "50%", "a:b", "é ü", None]
    TB.upsert_partitions(spark, path, spark.createDataFrame([(i, 0, n) for i, n in enumerate(names)] + [(None, 7, "x/y")], schema), "id", "p")
    TB.upsert_partitions(spark, path, spark.createDataFrame([(i, 1, "all") for i in range(5)], schema), "id", "p")
    got = sorted(((r.id, r.v, r.p) for r in spark.read.parquet(path).collect()), key=str)
    assert got == sorted([(i, 1, "all") for i in range(5)] + [(None, 7, "x/y")], key=str)


def test_ambiguous_merge_sources_raise(spark, tmp_path):
    from tallyline.operators import mutation as MU
    from tallyline.sources import tables as TB
    schema = "a int, b int, v int"
    tgt = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 1, 0)], schema)
    twice = spark.createDataFrame([(1, 1, 5), (1, 1, 6), (3, 1, 7)], schema)
    for merge in (lambda s: MU.merge_upsert(tgt, s, ["a", "b"]), lambda s: MU.merge_update(tgt, s, ["a", "b"], ["v"]),
                  lambda s: MU.fill_null(tgt, s, ["a", "b"], "v")):
        with pytest.raises(Exception, match="MERGE: 2 source rows for a = 1, b = 1"):
            merge(twice).collect()
    with pytest.raises(Exception, match="MERGE: 2 source rows"):
        TB.upsert_partitions(spark, str(tmp_path / "t"), twice, ["a"], "b")
    latest = MU.assert_unique(twice, ["a", "b"], dedupe_by=["v"])
    assert sorted((r.a, r.v) for r in MU.merge_update(tgt, latest, ["a", "b"], ["v"]).filter("a IS NOT NULL").collect()) == [(1, 6), (2, 0)]
    # rows with a NULL key match nothing and are all inserted
    nulls = spark.createDataFrame([(None, 1, 8), (None, 1, 9)], schema)
    assert sorted(r.v for r in MU.merge_upsert(tgt, nulls, ["a", "b"]).collect()) == [0, 0, 0, 8, 9]


def test_fixtures_reach_every_branch(spark):
    from tallyline.plans.catalog_features import feature_table_query
    sf = "/root/testdata/sf0.001"
    ft = feature_table_query(spark, sf)
    flags = ["is_conference_game", "is_neutral_site", "same_conference", "early_season", "late_season", "home_favored"]
    row = ft.agg(*(F.sum(c).alias(c) for c in flags), F.count("*").alias("n"), F.sum("attendance").alias("a")).first()
    assert all(0 < row[c] < row["n"] for c in flags) and row["a"] > 0
    assert {r[0] for r in ft.select("spread_data_quality").distinct().collect()} == {"NORMAL", "VERIFIED", "HIGH_VARIANCE"}
