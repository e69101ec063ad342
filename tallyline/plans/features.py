"""The game feature table (flagship query).

Plan shape (PLANS.md; checked in tests/test_stats_plans.py):

  games --filter(class)--> base
  base --inline(home,away)--> long          (one scan, 2 rows per game)
  long --Exchange (team, season, bucket)--> totals and last rows per bucket
        --> context and opening rows --union--> all frames F1-F8 in one
        Window stage per (team, season, bucket), with the season's totals
        for leave-one-out (F10)                      [operators/buckets.py]
  --Exchange hash(id)--> pivot to one row per game (hash aggregate)
  long, narrow --Exchange (team, season, bucket)--> pre-game season win%
  --Exchange hash(id)--> opponent's pre-game season win% (window on id)
  --Exchange (team, season, bucket)--> strength of schedule (F9)
  --Exchange hash(id)--> pivot, joined to the other features
  h2h: aggregate per (pair, season) -> range window -> equi join (no pairs)
  base join team feats join h2h join quality on id, sorted, then the derived columns

Building the plan runs no job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import utc_to_zone
from ..operators import buckets as B
from ..operators import windows as W
from ..operators.h2h import h2h_features
from ..operators.longform import pivot_sides, to_long

OPTIONAL_GAME_COLS = {
    "conference_game": "boolean",
    "neutral_site": "boolean",
    "attendance": "double",
    "home_conference": "string",
    "away_conference": "string",
}


def _ensure_cols(df: DataFrame, cols: dict) -> DataFrame:
    missing = {c: F.lit(None).cast(t) for c, t in cols.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def base_games(games: DataFrame, classification: str | None = "fbs") -> DataFrame:
    """J1 core: C7 class filter + target (`home_win`, NULL score -> 0)."""
    g = games if classification is None else games.filter(F.col("home_classification") == classification)
    return g.withColumn("home_win", F.when(F.col("home_points") > F.col("away_points"), 1).otherwise(0))


def base_games_with_rest(games: DataFrame, classification: str | None = "fbs") -> DataFrame:
    """J1 `feat_base_games` as a standalone query: base + F1 rest days per side
    (previous home game for the home team, previous away game for the away
    team, same season)."""
    b = base_games(games, classification)
    rest = pivot_sides(B.team_rolling(to_long(b)).select("id", "side", "rest_days"), "id", ["rest_days"])
    return b.join(rest, "id").select(*b.columns, "home_rest_days", "away_rest_days")


def location_splits(games: DataFrame, classification: str | None = "fbs") -> DataFrame:
    """J4 `feat_location_splits`: F10 for the home team at home and the away
    team on the road; one row per game."""
    b = base_games(games, classification)
    long = to_long(b).select("id", "season", "side", "team", "points_scored", "points_allowed")
    return pivot_sides(B.leave_one_out(long), "id", ["avg_points", "avg_allowed", "win_rate"])


def schedule_stage(base: DataFrame, mode: str = "compat") -> DataFrame:
    """What strength of schedule needs of every game and side, and no more:
    these rows are shuffled by team, by id and by team again."""
    long = to_long(base, mode=mode).select("id", "side", "team", "season", "week", "start_ts", "won")
    return B.season_so_far(long, "won", "season_win_pct").drop("won")


def with_sos(stage: DataFrame, min_week: int = 3, default: float = 0.5) -> DataFrame:
    """J5 `feat_sos`: opponent's pre-game season win% at this game (window on
    id: exactly two rows), then F9 running mean/count including the current
    opponent, then the week / sample gate.

    Rows without id, team or season have no schedule.  Where an id repeats, a
    row counts once for each row of its id and side."""
    pid = Window.partitionBy("id")
    located = F.col("team").isNotNull() & F.col("season").isNotNull()
    of = lambda s, c: F.when(F.col("side") == s, c)
    cols = {}
    for s in ("home", "away"):
        cols[f"_{s}_pct"] = F.when(F.max(of(s, located)).over(pid), F.max(of(s, F.col("season_win_pct"))).over(pid))
        cols[f"_{s}_rows"] = F.count(of(s, F.lit(1))).over(pid)
    mine = lambda a, b: F.when(F.col("side") == "home", F.col(a)).otherwise(F.col(b))
    s = stage.filter(F.col("id").isNotNull()).withColumns(cols).filter(located).select(
        "id", "side", "team", "season", "week", "start_ts", mine("_away_pct", "_home_pct").alias("opp_win_pct"),
        F.explode(F.array_repeat(F.lit(0), mine("_home_rows", "_away_rows").cast("int"))).alias("_copy")).drop("_copy")
    s = B.running_mean(s, "opp_win_pct", "sos_rating", "sos_sample_size")
    gate = (F.coalesce(F.col("sos_sample_size"), F.lit(0)) > 0) & (F.col("week") >= min_week)
    return s.withColumn("sos", F.when(gate, F.col("sos_rating")).otherwise(F.lit(default)))


def sos(games: DataFrame, classification: str | None = "fbs") -> DataFrame:
    """J5 as a standalone query: one row per game with both sides' SOS."""
    st = with_sos(schedule_stage(base_games(games, classification)))
    return pivot_sides(st.select("id", "side", "sos", "sos_rating", "sos_sample_size"), "id",
                       ["sos", "sos_sample_size"])


def _games_sides(base: DataFrame, cols: list[str], mode: str = "compat") -> DataFrame:
    """Per-team features pivoted to one row per game id; a side's are NULL where no row of it has a team and a season.

    The long rows are shuffled by id as they are, one side's columns each, and pivoted there."""
    long = B.team_figures(to_long(base, mode=mode)).select("id", "side", "located", *cols).filter("id IS NOT NULL")
    wide = pivot_sides(long.repartition("id"), "id", ["located", *cols])
    return wide.select("id", *(F.when(F.col(f"{s}_located"), F.col(f"{s}_{c}")).alias(f"{s}_{c}")
                               for s in ("home", "away") for c in cols))


def team_features(base: DataFrame, mode: str = "compat") -> DataFrame:
    """All per-team features pivoted to one row per game id.

    Strength of schedule goes to the games on its own narrow rows."""
    cols = ["rest_days", "avg_points", "avg_allowed", "win_rate", *W.TEAM_ROLLING_COLS]
    strength = with_sos(schedule_stage(base, mode)).select("id", "side", "sos", "sos_sample_size").repartition("id")
    return _games_sides(base, cols, mode).join(pivot_sides(strength, "id", ["sos", "sos_sample_size"]), "id", "left")


def spread_quality(disp: DataFrame, corrections: DataFrame, threshold: float = 5.0) -> DataFrame:
    """J7 `feat_spread_quality`: listed games -> VERIFIED if corrected, else
    HIGH_VARIANCE if std >= threshold, else NORMAL; corrections not listed
    are added with NULL variance as VERIFIED.

    The reference writes (listed LEFT JOIN corrections) UNION ALL
    (corrections LEFT ANTI listed), which scans both inputs twice; the same
    rows come from ONE full outer join on game_id (correction keys made
    distinct so nothing fans out)."""
    corr_ids = corrections.select("game_id").distinct().withColumn("_corr", F.lit(True))
    hv = disp.select("game_id", F.col("std_dev").alias("spread_variance"), F.lit(True).alias("_hv"))
    j = hv.join(corr_ids, "game_id", "full_outer")
    return j.select(
        "game_id", "spread_variance",
        F.when(F.col("_corr").isNotNull(), "VERIFIED")
         .when(F.col("spread_variance") >= threshold, "HIGH_VARIANCE")
         .otherwise("NORMAL").alias("spread_data_quality"))


def _c0(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def grade_margin_cols(mode: str = "compat") -> list[Column]:
    """J9 `feat_result_cfb` columns over home/away points and mode_spread."""
    m = F.col("home_points") - F.col("away_points")
    s = F.col("mode_spread")
    if mode == "compat":
        cover, push = m > s, m == s
    else:  # negative spread = home favoured: home covers when m + s > 0
        cover, push = (m + s) > 0, (m + s) == 0
    return [
        m.alias("actual_margin"),
        (m - s).alias("spread_result"),
        F.when(cover, 1).otherwise(0).alias("home_covered_spread"),
        F.when(push, 1).otherwise(0).alias("push"),
        F.when(push, F.lit("PUSH"))
         .when(cover, F.col("home_team").cast("string"))
         .otherwise(F.col("away_team").cast("string")).alias("team_covered"),
    ]


def context_cols() -> list[Column]:
    """J12 `feat_context`: flags, attendance default, Elo difference, season progress."""
    flag = lambda c: F.when(c, 1).otherwise(0)
    return [
        flag(F.col("conference_game")).alias("is_conference_game"),
        flag(F.col("neutral_site")).alias("is_neutral_site"),
        F.coalesce(F.col("attendance"), F.lit(0.0)).alias("attendance"),
        flag(F.col("home_conference") == F.col("away_conference")).alias("same_conference"),
        F.col("home_elo"), F.col("away_elo"),
        (F.col("home_elo") - F.col("away_elo")).alias("elo_diff"),
    ]


def season_cols() -> list[Column]:
    wk = F.col("week")
    return [
        (wk.cast("double") / F.lit(15.0)).alias("season_progress"),
        F.when(wk <= 4, 1).otherwise(0).alias("early_season"),
        F.when(wk >= 11, 1).otherwise(0).alias("late_season"),
    ]


def market_cols() -> list[Column]:
    """J15 `feat_market`."""
    s, o = F.col("mode_spread"), F.col("mode_spread_open")
    return [
        s, o,
        F.coalesce(s - o, F.lit(0.0)).alias("spread_movement"),
        F.when(s < 0, 1).otherwise(0).alias("home_favored"),
        F.abs(s).alias("spread_magnitude"),
    ]


def differential_cols() -> list[Column]:
    """J13 `feat_differentials` + J14 `feat_momentum_quality`."""
    d = lambda a, b: (_c0(a) - _c0(b))
    return [
        d("home_avg_points_l5", "away_avg_points_l5").alias("offense_diff_l5"),
        d("away_avg_allowed_l5", "home_avg_allowed_l5").alias("defense_diff_l5"),
        d("home_win_pct_l5", "away_win_pct_l5").alias("form_diff_l5"),
        d("home_avg_margin_l5", "away_avg_margin_l5").alias("margin_diff_l5"),
        d("home_win_pct_l3", "away_win_pct_l3").alias("momentum_diff"),
        F.when((_c0("home_unscored_games_in_l3_window") > 0) | (_c0("away_unscored_games_in_l3_window") > 0),
               "CORRUPTED").otherwise("CLEAN").alias("momentum_data_quality"),
        _c0("home_ats_pct_l5_carryover").alias("home_ats_l5_carryover"),
        _c0("away_ats_pct_l5_carryover").alias("away_ats_l5_carryover"),
        d("home_win_pct_l5_carryover", "away_win_pct_l5_carryover").alias("form_diff_l5_carryover"),
        d("home_avg_margin_l5_carryover", "away_avg_margin_l5_carryover").alias("margin_diff_l5_carryover"),
    ]


def form_cols() -> list[Column]:
    out = []
    for s in ("home", "away"):
        out += [_c0(f"{s}_avg_points_l5").alias(f"{s}_points_l5"),
                _c0(f"{s}_avg_allowed_l5").alias(f"{s}_allowed_l5"),
                _c0(f"{s}_avg_margin_l5").alias(f"{s}_margin_l5"),
                _c0(f"{s}_win_pct_l5").alias(f"{s}_win_pct_l5"),
                _c0(f"{s}_ats_pct_l5").alias(f"{s}_ats_l5")]
    for s in ("home", "away"):
        out += [_c0(f"{s}_avg_points_l3").alias(f"{s}_points_l3"),
                _c0(f"{s}_win_pct_l3").alias(f"{s}_win_pct_l3"),
                _c0(f"{s}_wins_l3").alias(f"{s}_wins_l3")]
    for s in ("home", "away"):
        out += [_c0(f"{s}_season_avg_points").alias(f"{s}_season_ppg"),
                _c0(f"{s}_season_avg_allowed").alias(f"{s}_season_papg"),
                _c0(f"{s}_season_win_pct").alias(f"{s}_season_win_pct")]
    out += [_c0("home_avg_points").alias("home_at_home_ppg"),
            _c0("home_win_rate").alias("home_at_home_win_rate"),
            _c0("away_avg_points").alias("away_on_road_ppg"),
            _c0("away_win_rate").alias("away_on_road_win_rate")]
    return out


def eligible(min_games: int = 3) -> Column:
    """C12 `filt_eligibility`."""
    scored = F.col("home_points").isNotNull() & (_c0("home_games_played") >= min_games) \
        & (_c0("away_games_played") >= min_games)
    future = F.col("home_points").isNull() & F.col("home_elo").isNotNull()
    return scored | future


def feature_table(games: DataFrame, disp: DataFrame, corrections: DataFrame,
                  classification: str = "fbs", tz: str = "America/Chicago",
                  quality_threshold: float = 5.0, mode: str = "compat",
                  sort: bool = True, cut_lineage: bool = False) -> DataFrame:
    """J16 `feat_table_full`: 82-column feature table (flagship).

    `cut_lineage=True` checkpoints the per-game team features (reliable
    checkpoint into `spark.checkpoint.dir`), so a lost executor late in the
    job re-reads them instead of recomputing every window stage."""
    games = _ensure_cols(games, OPTIONAL_GAME_COLS)
    base = base_games(games, classification)
    tf = team_features(base, mode)
    if cut_lineage:
        from ..session import checkpoint_dir
        checkpoint_dir(games.sparkSession)
        tf = tf.checkpoint(eager=True)
    hh = h2h_features(base)
    sq = spread_quality(disp, corrections, quality_threshold).withColumnRenamed("game_id", "id")
    local = utc_to_zone(F.col("start_ts"), tz)
    j = base.join(tf, "id", "left").join(hh, "id", "left").join(sq, "id", "left")
    rest_h = F.coalesce(F.col("home_rest_days"), F.lit(7))
    rest_a = F.coalesce(F.col("away_rest_days"), F.lit(7))
    sos_h, sos_a = F.col("home_sos"), F.col("away_sos")
    rows = j.filter(eligible())
    if sort:            # before the derived columns: the sort's exchange carries what they are made from
        rows = rows.orderBy("season", "week", "start_ts", "id")
    return rows.select(
        "id", "season", "week", "home_team", "away_team", "start_ts",
        local.alias("start_central"), local.cast("date").alias("game_date_central"),
        F.col("home_win").alias("target"),
        "home_points", "away_points",
        *grade_margin_cols(mode),
        *context_cols(),
        rest_h.alias("home_rest_days"), rest_a.alias("away_rest_days"),
        (rest_h - rest_a).alias("rest_advantage"),
        *form_cols(),
        *differential_cols(),
        F.coalesce(sos_h, F.lit(0.5)).alias("home_sos"),
        F.coalesce(sos_a, F.lit(0.5)).alias("away_sos"),
        (F.coalesce(sos_h, F.lit(0.5)) - F.coalesce(sos_a, F.lit(0.5))).alias("sos_diff"),
        _c0("home_sos_sample_size").alias("home_sos_games"),
        _c0("away_sos_sample_size").alias("away_sos_games"),
        F.coalesce("h2h_games_count", F.lit(0)).alias("h2h_games_count"),
        F.coalesce("home_h2h_win_rate", F.lit(0.5)).alias("home_h2h_win_rate"),
        F.coalesce("home_h2h_avg_margin", F.lit(0.0)).alias("home_h2h_avg_margin"),
        *market_cols(),
        F.coalesce("spread_variance", F.lit(0.0)).alias("spread_variance"),
        F.coalesce("spread_data_quality", F.lit("NORMAL")).alias("spread_data_quality"),
        *season_cols(),
        F.col("home_games_played"), F.col("away_games_played"),
    )


def eligible_rows(games: DataFrame, classification: str = "fbs", min_games: int = 3) -> DataFrame:
    """C12 as a query: games passing the eligibility filter, with games played."""
    base = base_games(games, classification)
    gp = _games_sides(base, ["games_played"])
    return base.join(gp, "id", "left").filter(eligible(min_games)).select(
        "id", "home_games_played", "away_games_played")
