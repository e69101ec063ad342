"""DuckDB formulations of the feature queries, written from the stated semantics.

They work on lists, not windows: a team's whole schedule is one sorted list,
a game is a place in it, and every rolling figure is an average over a slice
of the list before that place.  Location splits are totals less the own row;
head-to-head and rest days are lateral look-ups into earlier games.
"""

from __future__ import annotations

from ..sources.fixtures import with_views

# One list element per team and game; `p` is the game's place in the schedule.
SCHEDULE = """
fbs AS (SELECT * FROM games_v WHERE home_classification = 'fbs'),
seen AS (
  SELECT id, season, week, start_ts, unnest([
    {side: 'home', team: home_team, rival: away_team, f: home_points, a: away_points, line: mode_spread},
    {side: 'away', team: away_team, rival: home_team, f: away_points, a: home_points, line: -mode_spread}
  ], recursive := true) FROM fbs),
rated AS (SELECT *, abs(f - a) AS gap, (f > a)::INTEGER AS w, (f - a > line)::INTEGER AS c FROM seen),
schedule AS (
  SELECT team, list({id: id, side: side, season: season, week: week, ts: start_ts, f: f, a: a, gap: gap, w: w, c: c}
                    ORDER BY start_ts, id) AS games FROM rated GROUP BY team),
place AS (SELECT team, games, unnest(games) AS g, generate_subscripts(games, 1) AS p FROM schedule),
past AS (
  SELECT team, g, games[greatest(1, p - 5):p - 1] AS any5,
    list_filter(games[1:p - 1], lambda x: x.season = g.season) AS own FROM place),
form AS (SELECT team, g, any5, own, own[-5:] AS own5, own[-3:] AS own3 FROM past)"""


def _mean(games: str, field: str) -> str:
    return f"list_avg(list_transform({games}, lambda x: x.{field}))"


# Fixed output names of the rolling features, with the slice and field each one averages.
_FIELDS = {"avg_points": "f", "avg_allowed": "a", "avg_margin": "gap", "win_pct": "w", "ats_pct": "c"}
ROLLING = {
    **{f"{n}_l5": _mean("own5", x) for n, x in _FIELDS.items()},
    **{f"{n}_l5_carryover": _mean("any5", x) for n, x in _FIELDS.items()},
    "avg_points_l3": _mean("own3", "f"), "win_pct_l3": _mean("own3", "w"),
    "season_avg_points": _mean("own", "f"), "season_avg_allowed": _mean("own", "a"), "season_win_pct": _mean("own", "w"),
    "wins_l3": "CASE WHEN len(own3) > 0 THEN len(list_filter(own3, lambda x: x.w = 1))::BIGINT END",
    "unscored_games_in_l3_window": "len(list_filter(own3, lambda x: x.f IS NULL OR x.a IS NULL))::BIGINT",
    "games_played": "len(own)::BIGINT",
}

RECENT = SCHEDULE + """,
recent AS (SELECT g.id AS id, g.side AS side, team, g.season AS season, g.week AS week, g.ts AS ts,
  """ + ",\n  ".join(f"{e} AS {n}" for n, e in ROLLING.items()) + " FROM form)"

# The rival's record before the game, averaged over the season so far including this game.
STRENGTH = """
met AS (
  SELECT m.id, m.team, m.season, m.ts, m.side, r.season_win_pct AS rival_pct
  FROM recent AS m JOIN recent AS r ON r.id = m.id AND r.side <> m.side),
chain AS (SELECT team, season, list({id: id, side: side, v: rival_pct} ORDER BY ts, id) AS l FROM met GROUP BY team, season),
strength AS (
  SELECT team, l[p].id AS id, l[p].side AS side, l[p].v AS rival_pct,
    list_avg(list_transform(l[1:p], lambda x: x.v)) AS rating,
    len(list_filter(l[1:p], lambda x: x.v IS NOT NULL))::BIGINT AS sample
  FROM (SELECT team, l, unnest(range(1, len(l) + 1)) AS p FROM chain))"""

# Days since the latest earlier game of the season on the same side.
REST = """
rest AS (
  SELECT m.id, m.side, date_diff('day', last.ts::DATE, m.start_ts::DATE)::INTEGER AS days
  FROM seen AS m LEFT JOIN LATERAL (
    SELECT max(e.start_ts) AS ts FROM seen AS e
    WHERE e.team = m.team AND e.side = m.side AND e.season = m.season AND (e.start_ts, e.id) < (m.start_ts, m.id)) AS last ON true)"""

# Totals of (team, side, season) less the game's own contribution.
ELSEWHERE = """
totals AS (
  SELECT team, side, season, sum(f) AS sf, count(f) AS nf, sum(a) AS sa, count(a) AS na, sum((f > a)::INTEGER) AS sw
  FROM seen GROUP BY team, side, season),
elsewhere AS (
  SELECT s.id, s.side, (sf - ifnull(f, 0)) / nullif(nf - (f IS NOT NULL)::INTEGER, 0) AS points,
    (sa - ifnull(a, 0)) / nullif(na - (a IS NOT NULL)::INTEGER, 0) AS allowed,
    (ifnull(sw, 0) - ifnull((f > a)::INTEGER, 0)) / nullif(nf - (f IS NOT NULL)::INTEGER, 0) AS wins
  FROM seen AS s JOIN totals USING (team, side, season))"""

# Meetings of the pair in the three seasons before; the rate is 0 without any.
MEETINGS = """
meetings AS (
  SELECT g.id, m.n, m.rate, m.gap FROM fbs AS g, LATERAL (
    SELECT count(*) AS n, ifnull(avg(ifnull(own > rival, false)::INTEGER), 0) AS rate, avg(own - rival) AS gap FROM (
      SELECT CASE WHEN e.home_team = g.home_team THEN e.home_points ELSE e.away_points END AS own,
             CASE WHEN e.home_team = g.home_team THEN e.away_points ELSE e.home_points END AS rival
      FROM fbs AS e
      WHERE least(e.home_team, e.away_team) = least(g.home_team, g.away_team)
        AND greatest(e.home_team, e.away_team) = greatest(g.home_team, g.away_team)
        AND e.season BETWEEN g.season - 3 AND g.season - 1)) AS m)"""

# Population variance of half-point quotes from exact sums: n * sum(x^2) - sum(x)^2 against n^2 / 4.
DISPERSED = """
dispersed AS (
  SELECT event_id AS game_id, round(sqrt(n * sxx - sx * sx) / n, 2) AS sd
  FROM (SELECT event_id, count(outcome_point) AS n, sum(outcome_point) AS sx, sum(outcome_point * outcome_point) AS sxx
        FROM odds_v WHERE market = 'spreads' GROUP BY event_id)
  WHERE n >= 3 AND 4 * (n * sxx - sx * sx) >= n * n),
checked AS (
  SELECT game_id, sd AS spread_variance, CASE
      WHEN c.game_id IS NOT NULL THEN 'VERIFIED' WHEN sd >= 5 THEN 'HIGH_VARIANCE' ELSE 'NORMAL' END AS spread_data_quality
  FROM dispersed FULL JOIN (SELECT DISTINCT game_id FROM corrections_v) AS c USING (game_id))"""


def sql(*parts: str, select: str) -> str:
    """One statement from the named parts, in order."""
    views = ["games_v"] + (["odds_v", "corrections_v"] if DISPERSED in parts else [])
    return with_views("WITH " + ",".join(p.lstrip("\n") for p in parts) + "\n" + select, *views)


LONG = sql(SCHEDULE, select="SELECT id, season, week, start_ts, side, team, rival AS opponent, f AS points_scored, "
           "a AS points_allowed, w AS won, gap AS margin, line AS spread, c AS beat_spread FROM rated")


def recent(columns: list[str]) -> str:
    return sql(RECENT, select=f"SELECT id, side, team, {', '.join(columns)} FROM recent")


def by_game(source: str, columns: dict[str, str]) -> str:
    """Both sides of `source` on one row per game: home_<name>, away_<name>."""
    picked = ", ".join(f"{s}.{c} AS {n.format(s)}" for s in ("home", "away") for n, c in columns.items())
    return (f"SELECT id, {picked} FROM (SELECT * FROM {source} WHERE side = 'home') AS home "
            f"JOIN (SELECT * FROM {source} WHERE side = 'away') AS away USING (id)")


def _features() -> str:
    """Select list of the feature table: the fixed 82 output names, in order, over the joined parts."""
    both = lambda text: [text.replace("@", s) for s in ("home", "away")]
    zero = lambda x: f"ifnull({x}, 0)"
    less = lambda x, y, n: f"{zero(x)} - {zero(y)} AS {n}"
    diff = lambda c, n: less(f"h.{c}", f"a.{c}", n)
    local = "timezone('America/Chicago', g.start_ts AT TIME ZONE 'UTC')"
    gap = "(g.home_points - g.away_points)"
    sos = lambda s: f"CASE WHEN g.week > 2 AND {s}.sample > 0 THEN {s}.rating ELSE 0.5 END"
    out = ["g.id, g.season, g.week, g.home_team, g.away_team, g.start_ts",
           f"{local} AS start_central, {local}::DATE AS game_date_central",
           "ifnull(g.home_points > g.away_points, false)::INTEGER AS target, g.home_points, g.away_points",
           f"{gap} AS actual_margin, {gap} - g.mode_spread AS spread_result",
           f"ifnull({gap} > g.mode_spread, false)::INTEGER AS home_covered_spread",
           f"ifnull({gap} = g.mode_spread, false)::INTEGER AS push",
           f"CASE sign({gap} - g.mode_spread) WHEN 0 THEN 'PUSH' WHEN 1 THEN g.home_team::VARCHAR "
           "ELSE g.away_team::VARCHAR END AS team_covered",
           "ifnull(g.conference_game, false)::INTEGER AS is_conference_game",
           "ifnull(g.neutral_site, false)::INTEGER AS is_neutral_site, ifnull(g.attendance, 0.0)::DOUBLE AS attendance",
           "ifnull(g.home_conference = g.away_conference, false)::INTEGER AS same_conference",
           "g.home_elo, g.away_elo, g.home_elo - g.away_elo AS elo_diff",
           "ifnull(hr.days, 7) AS home_rest_days, ifnull(ar.days, 7) AS away_rest_days",
           "ifnull(hr.days, 7) - ifnull(ar.days, 7) AS rest_advantage"]
    short = {"home": "h", "away": "a"}
    for names in ({"avg_points_l5": "points_l5", "avg_allowed_l5": "allowed_l5", "avg_margin_l5": "margin_l5",
                   "win_pct_l5": "win_pct_l5", "ats_pct_l5": "ats_l5"},
                  {"avg_points_l3": "points_l3", "win_pct_l3": "win_pct_l3", "wins_l3": "wins_l3"},
                  {"season_avg_points": "season_ppg", "season_avg_allowed": "season_papg",
                   "season_win_pct": "season_win_pct"}):
        for s in short:
            out += [f"{zero(f'{short[s]}.{c}')} AS {s}_{n}" for c, n in names.items()]
    out += [f"{zero('he.points')} AS home_at_home_ppg, {zero('he.wins')} AS home_at_home_win_rate",
            f"{zero('ae.points')} AS away_on_road_ppg, {zero('ae.wins')} AS away_on_road_win_rate",
            diff("avg_points_l5", "offense_diff_l5"), less("a.avg_allowed_l5", "h.avg_allowed_l5", "defense_diff_l5"),
            diff("win_pct_l5", "form_diff_l5"), diff("avg_margin_l5", "margin_diff_l5"),
            diff("win_pct_l3", "momentum_diff"),
            "CASE WHEN greatest(h.unscored_games_in_l3_window, a.unscored_games_in_l3_window) > 0 THEN 'CORRUPTED' "
            "ELSE 'CLEAN' END AS momentum_data_quality",
            f"{zero('h.ats_pct_l5_carryover')} AS home_ats_l5_carryover",
            f"{zero('a.ats_pct_l5_carryover')} AS away_ats_l5_carryover",
            diff("win_pct_l5_carryover", "form_diff_l5_carryover"),
            diff("avg_margin_l5_carryover", "margin_diff_l5_carryover"),
            f"{sos('hs')} AS home_sos, {sos('aws')} AS away_sos, ({sos('hs')}) - ({sos('aws')}) AS sos_diff",
            f"{zero('hs.sample')} AS home_sos_games, {zero('aws.sample')} AS away_sos_games",
            "m.n AS h2h_games_count, m.rate AS home_h2h_win_rate, ifnull(m.gap, 0) AS home_h2h_avg_margin",
            "g.mode_spread, g.mode_spread_open, ifnull(g.mode_spread - g.mode_spread_open, 0) AS spread_movement",
            "ifnull(g.mode_spread < 0, false)::INTEGER AS home_favored, abs(g.mode_spread) AS spread_magnitude",
            "ifnull(q.spread_variance, 0.0) AS spread_variance, ifnull(q.spread_data_quality, 'NORMAL') AS spread_data_quality",
            "g.week / 15.0::DOUBLE AS season_progress, (g.week <= 4)::INTEGER AS early_season, "
            "(g.week >= 11)::INTEGER AS late_season"]
    out += both("@.games_played AS @_games_played")
    return ",\n  ".join(out).replace("home.games_played", "h.games_played").replace("away.games_played", "a.games_played")


_SIDES = " ".join(f"JOIN {t} AS {x} ON {x}.id = g.id AND {x}.side = '{s}'" for t, xs in (
    ("recent", ("h", "a")), ("rest", ("hr", "ar")), ("elsewhere", ("he", "ae")), ("strength", ("hs", "aws")))
    for x, s in zip(xs, ("home", "away")))
ELIGIBLE = "CASE WHEN g.home_points IS NULL THEN g.home_elo IS NOT NULL ELSE least(h.games_played, a.games_played) >= 3 END"
FEATURE_TABLE = sql(
    RECENT, STRENGTH, REST, ELSEWHERE, MEETINGS, DISPERSED,
    select=f"SELECT {_features()}\nFROM fbs AS g {_SIDES} JOIN meetings AS m ON m.id = g.id "
           f"LEFT JOIN checked AS q ON q.game_id = g.id\nWHERE {ELIGIBLE}\nORDER BY g.season, g.week, g.start_ts, g.id")
