"""Registered queries: names as a feed writes them, and the live-odds write-back chain.

Fixture teams 0..36 carry the league's full names, others a name outside the
fixed maps; feed names are part names (resolved by prefix) or names of the
override map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import kickoff_local, url_for
from ..operators import consensus as C
from ..operators import joins as J
from ..operators import mutation as MU
from ..operators import names as N
from ..sources import dimensions as D
from ..sources.fixtures import dictionary_v, games_v, quotes_v, table, with_views
from .catalog_basic import BETTING_SQL, betting_view
from .catalog_quotes import CONSENSUS_CTE
from .registry import register

NFL_NAMES = [n for n, _ in D.NFL_TEAM_ABBR]
AS_OF = "1998-06-15"


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# ---------------------------------------------------------------- J17: three name columns with overrides

# A game's feed names are those of the part of its customer's number (home) and of half that number (away), so the
# names grow with the tables; every fifth part goes by a name of the override map.
FEED_NAMES_SQL = f"""feed_names AS (
  SELECT p_partkey, if(p_partkey % 5 = 0,
    {_sql_list(n for n, _ in D.CFB_NAME_OVERRIDES)}[(p_partkey % {len(D.CFB_NAME_OVERRIDES)})::INTEGER + 1], p_name) AS name
  FROM part),
raw_quotes AS (
  SELECT q.event_id, q.bookmaker, q.market, q.line_no, q.commence_time, q.outcome_price, q.outcome_point, q.last_update,
    h.name AS home_team, a.name AS away_team,
    CASE q.outcome_name WHEN q.home_team THEN h.name WHEN q.away_team THEN a.name ELSE q.outcome_name END AS outcome_name
  FROM quotes_v AS q JOIN orders ON o_orderkey = q.event_id
  JOIN feed_names AS h ON h.p_partkey = o_custkey JOIN feed_names AS a ON a.p_partkey = o_custkey // 2 + 1)"""


def feed_names(spark: SparkSession, sf: str) -> DataFrame:
    """(p_partkey, name): the names of the feed."""
    over = F.array(*[F.lit(n) for n, _ in D.CFB_NAME_OVERRIDES])
    pick = F.get(over, (F.col("p_partkey") % len(D.CFB_NAME_OVERRIDES)).cast("int"))
    return table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 5 == 0, pick).otherwise(F.col("p_name")).alias("name"))


def raw_quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Quotes whose three name columns are feed names."""
    n = feed_names(spark, sf)
    games = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("_home"), F.expr("o_custkey div 2 + 1").alias("_away"))
    games = games.join(n.select(F.col("p_partkey").alias("_home"), F.col("name").alias("_h")), "_home")
    games = games.join(n.select(F.col("p_partkey").alias("_away"), F.col("name").alias("_a")), "_away")
    q = quotes_v(spark, sf).join(games.select("event_id", "_h", "_a"), "event_id")
    name = (F.when(F.col("outcome_name") == F.col("home_team"), F.col("_h"))
            .when(F.col("outcome_name") == F.col("away_team"), F.col("_a")).otherwise(F.col("outcome_name")))
    return q.select("event_id", "bookmaker", "market", "line_no", "commence_time", "outcome_price", "outcome_point",
                    "last_update", F.col("_h").alias("home_team"), F.col("_a").alias("away_team"),
                    name.alias("outcome_name"))


_OVERRIDES_SQL = "overrides(name, canonical) AS (VALUES " + ", ".join(
    "('{}', '{}')".format(a.replace("'", "''"), b.replace("'", "''")) for a, b in D.CFB_NAME_OVERRIDES) + ")"
# A name's canonical form: its override, else the longest dictionary entry it begins with, else itself.
NORMAL_SQL = f"""{FEED_NAMES_SQL}, {_OVERRIDES_SQL},
said AS (SELECT home_team AS name FROM raw_quotes UNION SELECT away_team FROM raw_quotes UNION SELECT outcome_name FROM raw_quotes),
meant AS (
  SELECT name, coalesce(
    (SELECT any_value(canonical) FROM overrides AS o WHERE o.name = said.name),
    (SELECT max_by(team, length(team)) FROM dictionary_v AS d WHERE starts_with(said.name, d.team || ' ')), name) AS canonical
  FROM said)"""


def normalized_quotes(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["home_team", "away_team", "outcome_name"]
    return N.normalize_columns(raw_quotes(spark, sf), cols, dictionary_v(spark, sf), D.cfb_override_dim(spark))


@register("odds_normalize", with_views(f"""WITH {NORMAL_SQL}
SELECT q.event_id, q.bookmaker, q.market, q.line_no, h.canonical AS home_team_norm, a.canonical AS away_team_norm,
  o.canonical AS outcome_name_norm
FROM raw_quotes AS q JOIN meant AS h ON h.name = q.home_team JOIN meant AS a ON a.name = q.away_team
JOIN meant AS o ON o.name = q.outcome_name""", "quotes_v", "dictionary_v"))
def q_normalize(spark, sf):
    """Home, away and outcome names, override map first."""
    return normalized_quotes(spark, sf).select("event_id", "bookmaker", "market", "line_no", "home_team_norm",
                                               "away_team_norm", "outcome_name_norm")


@register("odds_consensus_normalized", with_views(f"""WITH {NORMAL_SQL},
clean AS (
  SELECT q.* REPLACE (h.canonical AS home_team, a.canonical AS away_team, o.canonical AS outcome_name)
  FROM raw_quotes AS q JOIN meant AS h ON h.name = q.home_team JOIN meant AS a ON a.name = q.away_team
  JOIN meant AS o ON o.name = q.outcome_name),
{CONSENSUS_CTE.replace("quotes_v", "clean")}
SELECT * FROM consensus""", "quotes_v", "dictionary_v"))
def q_consensus_normalized(spark, sf):
    """J17 feeding J19: the consensus of the normalised quotes."""
    q = normalized_quotes(spark, sf)
    q = q.select(*(c for c in q.columns if c not in ("home_team", "away_team", "outcome_name")
                   and not c.endswith("_norm")),
                 *(F.col(f"{c}_norm").alias(c) for c in ("home_team", "away_team", "outcome_name")))
    return C.consensus(q)


# ---------------------------------------------------------------- D15 / D16 on the league's own maps, page addresses

def team_name(team: Column) -> Column:
    names = F.array(*[F.lit(n) for n in NFL_NAMES])
    return F.coalesce(F.get(names, team.cast("int")), F.concat(F.lit("Team "), team.cast("string")))


_NAME_SQL = f"coalesce({_sql_list(NFL_NAMES)}[({{0}})::INTEGER + 1], 'Team ' || {{0}})"
_ABBR_SQL = f"{_sql_list(a for _, a in D.NFL_TEAM_ABBR)}[({{0}})::INTEGER + 1]"
# Round names of the page addresses; conference finals have no page.
ROUNDS = {"WC": "wild-card", "DIV": "divisional", "SB": "super-bowl"}
NO_PAGE = "CON"
PAGE = "matchup/%s-%s-%s-%d/spread-movement"
_TYPES = list(D.NFL_GAME_TYPES)


def page_address(away: Column, home: Column, game_type: Column, week: Column, season: Column) -> Column:
    """Address of a game's line page: by round in the play-offs, by week otherwise; NULL for rounds without one."""
    named = F.coalesce(*[F.when(game_type == t, F.lit(n)) for t, n in ROUNDS.items()],
                       F.concat(F.lit("week-"), week.cast("string")))
    return F.when(game_type != NO_PAGE, url_for(PAGE, away, home, named, season))


_NICKS_SQL = "nicks(abbr, nickname, since, until) AS (VALUES " + ", ".join(
    f"('{a}', '{n}', {f or 0}, {t or 9999})" for a, n, f, t in D.NFL_NICKNAMES) + ")"


@register("src_page_address", with_views(f"""WITH {_NICKS_SQL},
g AS (SELECT id, week, season + 24 AS season, {_ABBR_SQL.format('home_team')} AS home, {_ABBR_SQL.format('away_team')} AS away,
  {_sql_list(_TYPES)}[(id % {len(_TYPES)})::INTEGER + 1] AS game_type FROM games_v),
n AS (SELECT g.*, ifnull(h.nickname, lower(home)) AS hn, ifnull(a.nickname, lower(away)) AS an FROM g
  LEFT JOIN nicks AS h ON h.abbr = home AND season BETWEEN h.since AND h.until
  LEFT JOIN nicks AS a ON a.abbr = away AND season BETWEEN a.since AND a.until WHERE home IS NOT NULL AND away IS NOT NULL)
SELECT id, game_type, 'matchup/' || an || '-' || hn || '-' || CASE game_type WHEN 'WC' THEN 'wild-card' WHEN 'DIV' THEN 'divisional'
  WHEN 'SB' THEN 'super-bowl' WHEN 'REG' THEN 'week-' || week END || '-' || season || '/spread-movement' AS address FROM n""",
                                         "games_v"))
def q_page_address(spark, sf):
    """D15 and D16 on the fixed maps: full name to abbreviation (unknown names drop out), then the nickname of the season."""
    types = F.array(*[F.lit(t) for t in _TYPES])
    g = games_v(spark, sf).select(
        "id", "week", (F.col("season") + 24).alias("season"), team_name(F.col("home_team")).alias("home"),
        team_name(F.col("away_team")).alias("away"),
        F.get(types, (F.col("id") % len(_TYPES)).cast("int")).alias("game_type"))
    abbr = D.nfl_abbr_dim(spark)
    for side in ("home", "away"):
        g = J.lookup(g, abbr, side, "full_name", "abbr", f"{side}_abbr")
        g = J.lookup_effective(g, D.nfl_nickname_dim(spark), f"{side}_abbr", "season", name=f"{side}_nick")
    return g.select("id", "game_type", page_address(F.col("away_nick"), F.col("home_nick"), F.col("game_type"),
                                                    F.col("week"), F.col("season")).alias("address"))


# ---------------------------------------------------------------- live odds written back

def league_games(spark: SparkSession, sf: str) -> DataFrame:
    """Games by full names and abbreviations, kick-off text in league time; every fifth quoted game unplayed."""
    g = games_v(spark, sf)
    abbrs = F.array(*[F.lit(a) for _, a in D.NFL_TEAM_ABBR])
    played = F.col("id") % 5 != 0
    return g.select(
        "id", "season", "week", F.date_format("start_ts", "yyyy-MM-dd").alias("gameday"), F.lit("13:00").alias("gametime"),
        *(team_name(F.col(f"{s}_team")).alias(f"{s}_team") for s in ("home", "away")),
        *(F.get(abbrs, F.col(f"{s}_team").cast("int")).alias(f"{s}_team_abbr") for s in ("home", "away")),
        *(F.when(played, F.col(f"{s}_points")).alias(f"{s}_score") for s in ("home", "away")),
        F.col("mode_spread").alias("spread_line"))


LIVE_COLS = ["id", "season", "week", "gameday", "gametime", "home_team", "away_team", "home_team_abbr", "away_team_abbr",
             "home_score", "away_score", "spread_line"]


def live_lines(spark: SparkSession, sf: str) -> DataFrame:
    """J21 with kick-off: the live line per pair of teams, from the pair's latest event."""
    q = quotes_v(spark, sf)
    q = q.withColumns({
        "outcome_name": F.when(F.col("outcome_name") == F.col("home_team"), team_name(F.col("home_team")))
                         .when(F.col("outcome_name") == F.col("away_team"), team_name(F.col("away_team")))
                         .otherwise(F.col("outcome_name")),
        "home_team": team_name(F.col("home_team")), "away_team": team_name(F.col("away_team"))})
    teams = D.nfl_abbr_dim(spark).withColumnRenamed("full_name", "team")
    return C.live_spread(q, teams, extra=[F.max("commence_time").alias("commence_time")])


def write_back(live: DataFrame, historical: DataFrame, complete: DataFrame, enhanced: DataFrame, report: DataFrame,
               betting: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Live lines and kick-offs into the unplayed games of four tables: by names, by abbreviations, by game
    with the betting line and the central kick-off, and the report's window."""
    local = F.date_format(F.from_utc_timestamp(F.col("commence_time").cast("timestamp"), "America/New_York"), "HH:mm")
    src = live.withColumn("gametime", local)
    unplayed = F.col("home_score").isNull()

    def one_per(keys: list[str]) -> DataFrame:
        return MU.assert_unique(src.select(*keys, "commence_time", "event_id", "spread_line", "gametime"), keys,
                                dedupe_by=["commence_time", "event_id"]).select(*keys, "spread_line", "gametime")

    names, abbrs = ["away_team", "home_team"], ["away_team_abbr", "home_team_abbr"]
    historical = MU.merge_update(historical, one_per(names), names, ["spread_line", "gametime"], target_pred=unplayed)
    complete = MU.merge_update(complete, one_per(abbrs), abbrs, ["spread_line", "gametime"], target_pred=unplayed)
    open_games = complete.filter(unplayed).join(betting, ["season", "week", "gameday", "home_team_abbr", "away_team_abbr"])
    open_games = open_games.select(
        "id", "spread_line", "gametime", "bet_spread",
        kickoff_local(F.col("gameday"), F.coalesce("gametime", F.lit("12:00"))).alias("kickoff_central"))
    enhanced = MU.merge_update(enhanced, MU.assert_unique(open_games, "id", dedupe_by=["bet_spread"]), "id",
                               ["spread_line", "gametime", "kickoff_central", "bet_spread"])
    return historical, complete, enhanced, MU.refresh_window(report, enhanced, "gameday", as_of, 7, 7)


_EXTRA = {"kickoff_central": "timestamp_ntz", "bet_spread": "double"}
_GAMES_SQL = f"""league AS (
  SELECT id, season, week, strftime(start_ts, '%Y-%m-%d') AS gameday, '13:00' AS gametime,
    {_NAME_SQL.format('home_team')} AS home_team, {_NAME_SQL.format('away_team')} AS away_team,
    {_ABBR_SQL.format('home_team')} AS home_team_abbr, {_ABBR_SQL.format('away_team')} AS away_team_abbr,
    if(id % 5 <> 0, home_points, NULL) AS home_score, if(id % 5 <> 0, away_points, NULL) AS away_score,
    mode_spread AS spread_line
  FROM games_v)"""
# The live line of an event: its away-side quotes' mode (first met wins a tie), their median if all differ.
_LIVE_SQL = f"""live AS (
  SELECT event_id, commence_time, {_ABBR_SQL.format('home_team')} AS h, {_ABBR_SQL.format('away_team')} AS a, line,
    strftime(timezone('America/New_York', commence_time AT TIME ZONE 'UTC'), '%H:%M') AS kick
  FROM (
    SELECT event_id, any_value(commence_time) AS commence_time, any_value(home_team) AS home_team, any_value(away_team) AS away_team,
      if(max(n) = 1, median(point), arg_min(point, {{k: -n, p: first_met}})) AS line
    FROM (SELECT event_id, commence_time, home_team, away_team, outcome_point AS point, count(*) AS n,
            min({{b: bookmaker, l: line_no, p: outcome_point}}) AS first_met
          FROM quotes_v WHERE market = 'spreads' AND outcome_name = away_team AND outcome_point IS NOT NULL GROUP BY ALL)
    GROUP BY event_id)
  WHERE h IS NOT NULL AND a IS NOT NULL),
latest AS (SELECT h, a, arg_max(line, (commence_time, event_id)) AS line, arg_max(kick, (commence_time, event_id)) AS kick
  FROM live GROUP BY h, a)"""


@register("nfl_live_writeback", with_views(f"""WITH {_GAMES_SQL}, {_LIVE_SQL}, {BETTING_SQL},
bets AS (SELECT season, week, strftime(gameday, '%Y-%m-%d') AS gameday, {_ABBR_SQL.format('home_team')} AS home_team_abbr,
    {_ABBR_SQL.format('away_team')} AS away_team_abbr, max(bet_spread) AS bet FROM betting GROUP BY ALL),
now AS (
  SELECT g.* REPLACE (if(l.h IS NOT NULL, l.line, spread_line) AS spread_line, if(l.h IS NOT NULL, l.kick, gametime) AS gametime)
  FROM league AS g LEFT JOIN latest AS l ON l.h = home_team_abbr AND l.a = away_team_abbr AND home_score IS NULL)
SELECT g.* REPLACE (if(b.bet IS NOT NULL, n.spread_line, g.spread_line) AS spread_line,
    if(b.bet IS NOT NULL, n.gametime, g.gametime) AS gametime),
  if(b.bet IS NOT NULL, timezone('America/Chicago', timezone('America/New_York', (n.gameday || ' ' || n.gametime)::TIMESTAMP)), NULL)
    AS kickoff_central, b.bet AS bet_spread
FROM league AS g JOIN now AS n USING (id)
LEFT JOIN bets AS b ON g.home_score IS NULL AND b.season = g.season AND b.week = g.week AND b.gameday = g.gameday
  AND b.home_team_abbr = g.home_team_abbr AND b.away_team_abbr = g.away_team_abbr""", "quotes_v"))
def q_live_writeback(spark, sf):
    """The chain's enhanced table after the write-back."""
    return _written_back(spark, sf)[2].select(*LIVE_COLS, *_EXTRA)


def _written_back(spark, sf):
    g = league_games(spark, sf)
    abbrs = F.array(*[F.lit(a) for _, a in D.NFL_TEAM_ABBR])
    bet = betting_view(games_v(spark, sf)).select(
        "season", "week", F.date_format("gameday", "yyyy-MM-dd").alias("gameday"), "bet_spread",
        *(F.get(abbrs, F.col(f"{s}_team").cast("int")).alias(f"{s}_team_abbr") for s in ("home", "away")))
    enhanced = MU.add_columns(g, _EXTRA)
    return write_back(live_lines(spark, sf), g, g, enhanced, enhanced, bet, AS_OF)


@register("nfl_live_historical", with_views(f"""WITH {_GAMES_SQL}, {_LIVE_SQL},
named AS (SELECT home_team, away_team, arg_max(line, (commence_time, event_id)) AS line, arg_max(kick, (commence_time, event_id)) AS kick
  FROM live JOIN league ON league.id = live.event_id GROUP BY home_team, away_team)
SELECT g.* REPLACE (if(n.line IS NOT NULL, n.line, spread_line) AS spread_line, if(n.line IS NOT NULL, n.kick, gametime) AS gametime)
FROM league AS g LEFT JOIN named AS n
  ON n.home_team = g.home_team AND n.away_team = g.away_team AND g.home_score IS NULL""", "quotes_v"))
def q_live_historical(spark, sf):
    """The chain's first MERGE, on the pair of full names."""
    return _written_back(spark, sf)[0].select(*LIVE_COLS)
