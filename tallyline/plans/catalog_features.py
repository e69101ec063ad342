"""Registered queries: long form, windows, h2h, feature composites (H1, F*, J1-J16, C12, D4, E17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import buckets as B
from ..operators import windows as W
from ..operators.aggregates import dispersion
from ..operators.h2h import h2h, h2h_features, prior_meetings
from ..operators.longform import to_long
from ..sources.fixtures import corrections_v, games_v, odds_v
from . import features as FT
from . import oracle_features as O
from .registry import register

# ---------------------------------------------------------------- helpers

def _base(spark, sf):
    return FT.base_games(games_v(spark, sf))


def _long(spark, sf):
    return to_long(_base(spark, sf))


def high_variance(spark, sf, min_std=0.5, min_books=3):
    """QC input for J7/J16: spread quotes per game with >= 3 quotes and std >= 0.5."""
    o = odds_v(spark, sf).filter(F.col("market") == "spreads")
    return dispersion(o, "event_id", "outcome_point", min_std=min_std, min_books=min_books)


def feature_table_query(spark, sf):
    g = games_v(spark, sf)
    return FT.feature_table(g, high_variance(spark, sf), corrections_v(g))


register("feat_table_full", O.FEATURE_TABLE)(feature_table_query)


# ---------------------------------------------------------------- long form & windows

@register("set_unpivot_sides", O.LONG)
def q_unpivot(spark, sf):
    return _long(spark, sf)


@register("feat_team_games", O.LONG)
def q_team_games(spark, sf):
    return _long(spark, sf)


@register("win_lag_rest_days", O.sql(O.SCHEDULE, O.REST, select=O.by_game("rest", {"{}_rest_days": "days"})))
def q_rest(spark, sf):
    return FT.base_games_with_rest(games_v(spark, sf)).select("id", "home_rest_days", "away_rest_days")


def _roll_query(cols):
    def q(spark, sf):
        tr = B.team_rolling(_long(spark, sf))
        return tr.select("id", "side", "team", *cols)
    return q


_R5 = ["avg_points_l5", "avg_allowed_l5", "avg_margin_l5", "win_pct_l5", "ats_pct_l5"]
_R5C = [c + "_carryover" for c in _R5]
for _key, _cols in {
    "win_rolling_l5_season": _R5,
    "win_rolling_l5_carryover": _R5C,
    "win_rolling_l3": ["avg_points_l3", "win_pct_l3"],
    "win_expanding_std": ["season_avg_points", "season_avg_allowed", "season_win_pct"],
    "win_sum_case": ["wins_l3"],
    "win_qc_unscored": ["unscored_games_in_l3_window"],
    "win_games_played": ["games_played"],
    "feat_team_rolling": list(W.TEAM_ROLLING_COLS),
}.items():
    register(_key, O.recent(_cols))(_roll_query(_cols))


@register("win_sos_cumulative", O.sql(O.RECENT, O.STRENGTH, select=
          "SELECT id, team, rating AS sos_rating, sample AS sos_sample_size FROM strength"))
def q_sos_cum(spark, sf):
    st = FT.with_sos(FT.schedule_stage(_base(spark, sf)))
    return st.select("id", "team", "sos_rating", "sos_sample_size")


@register("join_opponent_inner", O.sql(O.RECENT, O.STRENGTH, select=
          "SELECT id, team, rival_pct AS opp_win_pct FROM strength"))
def q_opp(spark, sf):
    st = FT.with_sos(FT.schedule_stage(_base(spark, sf)))
    return st.select("id", "team", "opp_win_pct")


_LOO_SQL = O.sql(O.SCHEDULE, O.ELSEWHERE, select=O.by_game(
    "elsewhere", {"{}_avg_points": "points", "{}_avg_allowed": "allowed", "{}_win_rate": "wins"}))


@register("win_leave_one_out", _LOO_SQL)
def q_loo(spark, sf):
    return FT.location_splits(games_v(spark, sf))


@register("feat_location_splits", _LOO_SQL)
def q_loc(spark, sf):
    return FT.location_splits(games_v(spark, sf))


@register("feat_base_games", O.sql(O.SCHEDULE, O.REST, select=
          "SELECT fbs.*, ifnull(home_points > away_points, false)::INTEGER AS home_win, home_rest_days, away_rest_days "
          f"FROM fbs JOIN ({O.by_game('rest', {'{}_rest_days': 'days'})}) USING (id)"))
def q_base(spark, sf):
    return FT.base_games_with_rest(games_v(spark, sf))


@register("feat_sos", O.sql(O.RECENT, O.STRENGTH, select=
          "SELECT id, " + ", ".join(
              f"CASE WHEN week > 2 AND {s}_n > 0 THEN {s}_r ELSE 0.5 END AS {s}_sos, {s}_n AS {s}_sos_sample_size"
              for s in ("home", "away"))
          + f" FROM fbs JOIN ({O.by_game('strength', {'{}_r': 'rating', '{}_n': 'sample'})}) USING (id)"))
def q_sos(spark, sf):
    return FT.sos(games_v(spark, sf))


_H2H_RAW = O.sql(O.SCHEDULE, O.MEETINGS, select=
                 "SELECT id, n AS h2h_games, rate AS home_h2h_win_rate, gap AS home_h2h_avg_margin FROM meetings")


@register("agg_h2h", _H2H_RAW)
def q_h2h(spark, sf):
    return h2h(_base(spark, sf))


@register("join_h2h_theta", O.sql(O.SCHEDULE, O.MEETINGS, select="SELECT id, n AS h2h_games FROM meetings"))
def q_h2h_theta(spark, sf):
    return prior_meetings(_base(spark, sf))


@register("feat_h2h", O.sql(O.SCHEDULE, O.MEETINGS, select=
          "SELECT id, n AS h2h_games_count, rate AS home_h2h_win_rate, ifnull(gap, 0) AS home_h2h_avg_margin FROM meetings"))
def q_h2h_feat(spark, sf):
    return h2h_features(_base(spark, sf))


@register("feat_spread_quality", O.sql(O.DISPERSED, select="SELECT * FROM checked"))
def q_quality(spark, sf):
    g = games_v(spark, sf)
    return FT.spread_quality(high_variance(spark, sf), corrections_v(g))


# ---------------------------------------------------------------- projections of the feature table

def _feature_subset(cols):
    sql = f"SELECT id, {', '.join(cols)} FROM (\n{O.FEATURE_TABLE}\n) ft"

    def q(spark, sf):
        return feature_table_query(spark, sf).select("id", *cols)
    return sql, q


_SUBSETS = {
    "feat_result_cfb": ["actual_margin", "spread_result", "home_covered_spread", "push", "team_covered"],
    "feat_context": ["is_conference_game", "is_neutral_site", "attendance", "same_conference",
                     "home_elo", "away_elo", "elo_diff", "season_progress", "early_season", "late_season"],
    "feat_differentials": ["offense_diff_l5", "defense_diff_l5", "form_diff_l5", "margin_diff_l5",
                           "momentum_diff", "form_diff_l5_carryover", "margin_diff_l5_carryover"],
    "feat_momentum_quality": ["momentum_data_quality"],
    "feat_market": ["mode_spread", "mode_spread_open", "spread_movement", "home_favored", "spread_magnitude"],
    "proj_case_flags": ["is_conference_game", "is_neutral_site", "same_conference", "early_season",
                        "late_season", "home_favored"],
    "proj_defaults": ["home_rest_days", "away_rest_days", "home_points_l5", "away_points_l5", "home_sos",
                      "away_sos", "home_h2h_win_rate", "spread_variance", "spread_data_quality"],
    "join_left_composite": ["home_games_played", "away_games_played", "home_season_win_pct",
                            "away_season_win_pct", "home_sos_games", "away_sos_games"],
    "join_left_id_multi": ["home_at_home_ppg", "away_on_road_ppg", "h2h_games_count",
                           "home_h2h_avg_margin", "spread_data_quality"],
    "proj_select_alias": ["season", "week", "home_team", "away_team", "start_ts", "start_central",
                          "game_date_central", "target", "actual_margin", "rest_advantage"],
}
for _key, _cols in _SUBSETS.items():
    _sql, _q = _feature_subset(_cols)
    register(_key, _sql)(_q)


@register("filt_eligibility", O.sql(O.RECENT, select=
          "SELECT g.id, h.games_played AS home_games_played, a.games_played AS away_games_played FROM fbs AS g "
          "JOIN recent AS h ON h.id = g.id AND h.side = 'home' JOIN recent AS a ON a.id = g.id AND a.side = 'away' "
          f"WHERE {O.ELIGIBLE}"))
def q_eligible(spark, sf):
    return FT.eligible_rows(games_v(spark, sf))
