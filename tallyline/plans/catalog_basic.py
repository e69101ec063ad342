"""Registered queries: sources, projections, filters, simple joins, sorts,
scalar functions, grouped summaries and QC checks
(A1-A2, A4-A10, C2-C11, C13, D1, D6-D9, D11, D13, D17, E1-E4, G1-G4, H2,
I1-I12, N1-N4, N6, J8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import scalar as S
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import names as N
from ..operators import quality as Q
from ..sources import dimensions as DIM
from ..sources import readers as R
from ..sources.fixtures import corrections_v, dictionary_v, games_v, names_v, odds_v, table, with_views
from .catalog_features import high_variance
from .catalog_quotes import RESOLVE_SQL
from .registry import alias, register

AS_OF = "2024-01-15"


def _g(sql, *views):
    return with_views(sql, "games_v", *views)


# ---------------------------------------------------------------- A1 / C4: JSON game records

def games_json(spark, sf):
    """Feed-shaped JSON text per game (text numbers; '' for unplayed points;
    flags omitted unless true)."""
    g = games_v(spark, sf)
    pts = lambda c: F.when(F.col(c).isNull(), F.lit("")).otherwise(F.col(c).cast("string"))
    doc = F.struct(
        F.col("id"), F.col("season"), F.col("week"), F.lit("regular").alias("seasonType"),
        F.date_format("start_ts", "yyyy-MM-dd'T'HH:mm:ss'.000Z'").alias("startDate"),
        F.when(F.col("home_points").isNotNull(), F.lit(True)).alias("completed"),
        F.col("home_team").alias("homeId"), F.concat(F.lit("T"), F.col("home_team").cast("string")).alias("homeTeam"),
        F.col("home_classification").alias("homeClassification"), pts("home_points").alias("homePoints"),
        F.col("home_elo").cast("string").alias("homePregameElo"),
        F.col("away_team").alias("awayId"), F.concat(F.lit("T"), F.col("away_team").cast("string")).alias("awayTeam"),
        pts("away_points").alias("awayPoints"), F.col("away_elo").cast("string").alias("awayPregameElo"))
    return g.select(F.to_json(doc).alias("value"))


GAMES_JSON_SQL = _g("""
SELECT CAST(id AS BIGINT) AS id, CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week,
  'regular' AS seasonType, strftime(start_ts, '%Y-%m-%dT%H:%M:%S.000Z') AS startDate,
  FALSE AS startTimeTBD, home_points IS NOT NULL AS completed, FALSE AS neutralSite, FALSE AS conferenceGame,
  CAST(NULL AS DOUBLE) AS attendance, CAST(NULL AS DOUBLE) AS venueId, CAST(NULL AS VARCHAR) AS venue,
  home_team AS homeId, 'T' || CAST(home_team AS VARCHAR) AS homeTeam, home_classification AS homeClassification,
  CAST(NULL AS VARCHAR) AS homeConference, home_points AS homePoints, CAST(NULL AS VARCHAR) AS homeLineScores,
  CAST(NULL AS DOUBLE) AS homePostgameWinProbability, home_elo AS homePregameElo, CAST(NULL AS DOUBLE) AS homePostgameElo,
  away_team AS awayId, 'T' || CAST(away_team AS VARCHAR) AS awayTeam, CAST(NULL AS VARCHAR) AS awayClassification,
  CAST(NULL AS VARCHAR) AS awayConference, away_points AS awayPoints, CAST(NULL AS VARCHAR) AS awayLineScores,
  CAST(NULL AS DOUBLE) AS awayPostgameWinProbability, away_elo AS awayPregameElo, CAST(NULL AS DOUBLE) AS awayPostgameElo,
  CAST(NULL AS DOUBLE) AS excitementIndex, CAST(NULL AS DOUBLE) AS highlights, CAST(NULL AS VARCHAR) AS notes,
  home_team AS homeTeamId, away_team AS awayTeamId, home_points AS homeScore, away_points AS awayScore,
  CAST(NULL AS DOUBLE) AS mode_spread, CAST(NULL AS DOUBLE) AS mode_spread_open
FROM games_v""")


@register("src_games_json", GAMES_JSON_SQL)
def q_games_json(spark, sf):
    return R.parse_games(games_json(spark, sf))


alias("proj_conform", "src_games_json")


# ---------------------------------------------------------------- A2: nested line lists as Python-literal text

LINE_ORDER = ["last_update", "line_no", "bookmaker", "outcome_price", "outcome_point"]


def lines_text(spark, sf):
    """Per game, its spread quotes as Python-literal list text (None for a
    missing open line, spreads as quoted text) - the backfill's stored shape."""
    o = odds_v(spark, sf).filter(F.col("market") == "spreads")
    item = F.format_string("{'provider': '%s', 'spread': '%s', 'spreadOpen': %s}", F.col("bookmaker"),
                           F.col("outcome_point").cast("string"),
                           F.when(F.col("outcome_name") == "away", F.lit("None"))
                            .otherwise(F.col("outcome_price").cast("string")))
    keyed = F.struct(*[F.col(c) for c in LINE_ORDER], item.alias("txt"))
    g = o.groupBy(F.col("event_id").alias("id")).agg(F.sort_array(F.collect_list(keyed)).alias("l"))
    return g.select("id", F.concat(F.lit("["), F.array_join(F.transform("l", lambda x: x["txt"]), ", "),
                                   F.lit("]")).alias("lines"))


@register("src_lines_nested", with_views(f"""
SELECT event_id AS id,
  CAST(ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY {', '.join(LINE_ORDER)}) - 1 AS INTEGER) AS pos,
  bookmaker AS provider, outcome_point AS spread,
  CASE WHEN outcome_name = 'away' THEN NULL ELSE outcome_price END AS spread_open
FROM odds_v WHERE market = 'spreads'""", "odds_v"))
def q_lines_nested(spark, sf):
    return R.explode_lines(R.parse_lines(lines_text(spark, sf)))


# ---------------------------------------------------------------- A4: CSV

def games_csv_lines(spark, sf):
    g = games_v(spark, sf)
    gtype = (F.when(F.col("week") == 1, "PRE").when(F.col("week") <= 11, "REG").when(F.col("week") == 12, "WC")
             .when(F.col("week") == 13, "DIV").when(F.col("week") == 14, "CON").otherwise("SB"))
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    fields = [F.concat(F.lit("G"), F.col("id").cast("string")), s("season"), gtype, s("week"),
              F.date_format("start_ts", "yyyy-MM-dd"), F.date_format("start_ts", "EEEE"), F.lit("13:00"),
              s("away_team"), F.coalesce(F.col("away_points").cast("int").cast("string"), F.lit("")),
              s("home_team"), F.coalesce(F.col("home_points").cast("int").cast("string"), F.lit("")),
              s("mode_spread")] + [F.lit("")] * 19
    return g.select(F.concat_ws(",", *fields).alias("value"))


_CSV_NULLS = ", ".join(
    f"CAST(NULL AS {'INTEGER' if c in ('result', 'total', 'overtime', 'div_game') else 'DOUBLE' if c in ('away_spread_odds', 'home_spread_odds', 'total_line', 'over_odds', 'under_odds', 'away_moneyline', 'home_moneyline', 'temp', 'wind') else 'VARCHAR'}) AS {c}"
    for c in R.NFL_CSV_COLUMNS[12:])


@register("src_csv_games", _g(f"""
SELECT * FROM (
SELECT 'G' || CAST(id AS VARCHAR) AS game_id, season,
  CASE WHEN week = 1 THEN 'PRE' WHEN week <= 11 THEN 'REG' WHEN week = 12 THEN 'WC'
       WHEN week = 13 THEN 'DIV' WHEN week = 14 THEN 'CON' ELSE 'SB' END AS game_type,
  week, strftime(start_ts, '%Y-%m-%d') AS gameday, dayname(start_ts) AS weekday, '13:00' AS gametime,
  CAST(away_team AS VARCHAR) AS away_team, CAST(away_points AS INTEGER) AS away_score,
  CAST(home_team AS VARCHAR) AS home_team, CAST(home_points AS INTEGER) AS home_score,
  mode_spread AS spread_line, {_CSV_NULLS}
FROM games_v) WHERE season >= 1996 AND game_type IN ('REG', 'WC', 'DIV', 'CON', 'SB')"""))
def q_csv(spark, sf):
    parsed = R.parse_csv_lines(games_csv_lines(spark, sf))
    return R.filter_nfl(parsed, first_season=1996)


# ---------------------------------------------------------------- A5-A10

@register("src_html_pages", "SELECT page_id, url, html FROM pages")
def q_pages(spark, sf):
    return R.read_pages(spark, f"{sf}/pages.parquet")


@register("src_table_scan", "SELECT * FROM orders")
def q_scan(spark, sf):
    return R.table(spark, f"{sf}/orders.parquet")


@register("src_rows_to_df", RESOLVE_SQL)
def q_rows_df(spark, sf):
    """A fixed dimension built from rows (the name-override map) feeding
    name resolution over the part names."""
    return N.resolve_names(names_v(spark, sf), dictionary_v(spark, sf), DIM.cfb_override_dim(spark))


@register("src_incremental_cutoff",
          f"SELECT event_id, ts, event_type FROM events WHERE ts >= CAST(DATE '{AS_OF}' - INTERVAL 7 DAY AS TIMESTAMP)")
def q_incremental(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return R.incremental(ev, "ts", AS_OF, 7)


@register("src_multi_season_union", _g("SELECT * FROM games_v"))
def q_union(spark, sf):
    g = games_v(spark, sf)
    pulls = [g.filter(F.col("season") < 1998), None, g.filter(F.col("season") >= 1998)]
    return R.union_seasons(pulls)


@register("src_temp_view", _g("SELECT season, COUNT(*) AS games, COUNT(mode_spread) AS quoted FROM games_v GROUP BY season"))
def q_temp_view(spark, sf):
    R.register(games_v(spark, sf), "games_v")
    return spark.sql("SELECT season, COUNT(*) AS games, COUNT(mode_spread) AS quoted FROM games_v GROUP BY season")


# ---------------------------------------------------------------- C: projections / filters

@register("proj_star_plus", _g("""
SELECT *, CASE WHEN home_points > away_points THEN 1 ELSE 0 END AS home_win,
  home_points - away_points AS margin, home_points + away_points AS total_points FROM games_v"""))
def q_star_plus(spark, sf):
    return games_v(spark, sf).withColumns({
        "home_win": F.when(F.col("home_points") > F.col("away_points"), 1).otherwise(0),
        "margin": F.col("home_points") - F.col("away_points"),
        "total_points": F.col("home_points") + F.col("away_points")})


@register("proj_drop", _g("""
SELECT * EXCLUDE (home_elo, away_elo) FROM games_v"""))
def q_drop(spark, sf):
    return games_v(spark, sf).drop("home_elo", "away_elo", "not_a_column")


@register("proj_safe_cast", """
SELECT p_partkey, TRY_CAST(NULLIF(trim(CAST(p_size AS VARCHAR)), '') AS DOUBLE) AS size_num,
  TRY_CAST(NULLIF(trim(p_brand), '') AS DOUBLE) AS brand_num,
  TRY_CAST(NULLIF(trim(split_part(p_name, ' ', 2)), '') AS DOUBLE) AS second_word_num
FROM part""")
def q_safe_cast(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", S.safe_double(F.col("p_size")).alias("size_num"),
                    S.safe_double(F.col("p_brand")).alias("brand_num"),
                    S.safe_double(F.split("p_name", " ", 2)[1]).alias("second_word_num"))


@register("proj_empty_to_null", """
SELECT doc_id, NULLIF(CASE WHEN lang = 'en' THEN '' ELSE lang END, '') AS lang, NULLIF(source, '') AS source
FROM documents""")
def q_empty_to_null(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("lang") == "en", F.lit("")).otherwise(F.col("lang")).alias("lang"), "source")
    return S.empty_to_null(d)


@register("filt_class", _g("SELECT * FROM games_v WHERE home_classification = 'fbs'"))
def q_class(spark, sf):
    return games_v(spark, sf).filter(F.col("home_classification") == "fbs")


@register("filt_null_tests", _g("""
SELECT id, season, home_points IS NULL AS unplayed, mode_spread IS NOT NULL AS quoted FROM games_v
WHERE home_points IS NULL OR mode_spread IS NULL"""))
def q_null_tests(spark, sf):
    g = games_v(spark, sf)
    return g.filter(F.col("home_points").isNull() | F.col("mode_spread").isNull()).select(
        "id", "season", F.col("home_points").isNull().alias("unplayed"),
        F.col("mode_spread").isNotNull().alias("quoted"))


@register("filt_between", _g("SELECT id, season FROM games_v WHERE season BETWEEN 1996 AND 1998"))
def q_between(spark, sf):
    return games_v(spark, sf).filter(F.col("season").between(1996, 1998)).select("id", "season")


@register("filt_in_list", _g("SELECT id, week FROM games_v WHERE week IN (1, 5, 9)"))
def q_in_list(spark, sf):
    return games_v(spark, sf).filter(F.col("week").isin(1, 5, 9)).select("id", "week")


@register("filt_date_window", f"""
SELECT event_id, ts FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '{AS_OF}' - INTERVAL 7 DAY AND DATE '{AS_OF}' + INTERVAL 7 DAY""")
def q_date_window(spark, sf):
    ev = table(spark, sf, "events")
    return ev.filter(S.date_window("ts", AS_OF, 7, 7)).select("event_id", "ts")


@register("filt_mod_sample", _g("SELECT id, season FROM games_v WHERE id % 1000 = 0"))
def q_mod_sample(spark, sf):
    """The reference's deterministic 1-in-1000 sample (a sampling
    operator; the sample is the feature)."""
    return games_v(spark, sf).filter((F.col("id") % 1000) == 0).select("id", "season")


# ---------------------------------------------------------------- D: joins

MODE_CTE = """m AS (SELECT event_id, outcome_point AS mode_spread FROM (
  SELECT event_id, outcome_point,
    ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY COUNT(*) DESC, outcome_point) AS rn
  FROM odds_v WHERE market = 'spreads' AND outcome_point IS NOT NULL GROUP BY event_id, outcome_point)
  WHERE rn = 1)"""


@register("join_left_key", _g(f"""WITH {MODE_CTE}
SELECT g.id, g.home_points, g.away_points, m.mode_spread AS line_mode
FROM games_v g LEFT JOIN m ON m.event_id = g.id""", "odds_v"))
def q_join_left(spark, sf):
    g = games_v(spark, sf).select("id", "home_points", "away_points")
    m = A.mode_spread(odds_v(spark, sf).filter(F.col("market") == "spreads"), "event_id", "outcome_point",
                      name="line_mode").withColumnRenamed("event_id", "id")
    return J.join_left(g, m, "id", ["line_mode"])


@register("join_left_case", _g("""
SELECT g.id, CASE WHEN c.game_id IS NOT NULL THEN 'VERIFIED' END AS flag
FROM games_v g LEFT JOIN corrections_v c ON c.game_id = g.id""", "corrections_v"))
def q_left_case(spark, sf):
    g = games_v(spark, sf)
    return J.flag_if_present(g.select("id"), corrections_v(g), "id", "game_id")


HV_CTE = """hv AS (SELECT event_id AS game_id FROM odds_v WHERE market = 'spreads' AND outcome_point IS NOT NULL
  GROUP BY event_id HAVING COUNT(outcome_point) >= 3 AND STDDEV_POP(outcome_point) >= 0.5 - 1e-9)"""


@register("join_left_anti", _g(f"""WITH {HV_CTE}
SELECT c.game_id, c.verified_spread FROM corrections_v c LEFT JOIN hv ON hv.game_id = c.game_id
WHERE hv.game_id IS NULL""", "odds_v", "corrections_v"))
def q_left_anti(spark, sf):
    g = games_v(spark, sf)
    return J.not_in(corrections_v(g), high_variance(spark, sf), "game_id")


def update_batch(games):
    """Update batch for MERGE tests: every 5th game re-scored (+1) plus the
    same games under new ids (inserts)."""
    upd = games.filter((F.col("id") % 5) == 0).withColumns(
        {"home_points": F.col("home_points") + 1, "away_points": F.col("away_points") + 1})
    ins = upd.withColumn("id", F.col("id") + 100000000)
    return upd.unionByName(ins)


UPDATE_BATCH_SQL = """batch AS (
  SELECT * REPLACE (home_points + 1 AS home_points, away_points + 1 AS away_points) FROM games_v WHERE id % 5 = 0
  UNION ALL
  SELECT * REPLACE (id + 100000000 AS id, home_points + 1 AS home_points, away_points + 1 AS away_points)
  FROM games_v WHERE id % 5 = 0)"""


@register("join_anti_ids", _g(f"WITH {UPDATE_BATCH_SQL}\nSELECT b.* FROM batch b WHERE b.id NOT IN (SELECT id FROM games_v)"))
def q_anti_ids(spark, sf):
    g = games_v(spark, sf)
    return J.not_in(update_batch(g), g, "id")


@register("join_semi_in", _g("SELECT id, season FROM games_v WHERE id IN (SELECT game_id FROM corrections_v)",
                             "corrections_v"))
def q_semi(spark, sf):
    g = games_v(spark, sf)
    return J.only_in(g, corrections_v(g), "id", "game_id").select("id", "season")


BETTING_SQL = """betting AS (
  SELECT season, week, CAST(start_ts AS DATE) AS gameday, home_team, away_team, mode_spread AS bet_spread
  FROM games_v WHERE mode_spread IS NOT NULL AND home_classification = 'fbs')"""


def betting_view(games):
    """Opaque 'betting analysis' input keyed by the 5 natural keys (Q14)."""
    return games.filter(F.col("mode_spread").isNotNull() & (F.col("home_classification") == "fbs")).select(
        "season", "week", F.to_date("start_ts").alias("gameday"), "home_team", "away_team",
        F.col("mode_spread").alias("bet_spread"))


@register("join_inner_5key", _g(f"""WITH {BETTING_SQL}
SELECT g.id, b.bet_spread FROM games_v g JOIN betting b
  ON g.season = b.season AND g.week = b.week AND CAST(g.start_ts AS DATE) = b.gameday
  AND g.home_team = b.home_team AND g.away_team = b.away_team"""))
def q_5key(spark, sf):
    g = games_v(spark, sf)
    gg = g.withColumn("gameday", F.to_date("start_ts"))
    return J.join_inner(gg, betting_view(g), ["season", "week", "gameday", "home_team", "away_team"]).select(
        "id", "bet_spread")


@register("join_inner_report", _g("""
SELECT g.id, g.season, g.home_team, g.away_team, g.mode_spread AS original_spread, c.verified_spread
FROM games_v g JOIN corrections_v c ON c.game_id = g.id""", "corrections_v"))
def q_report(spark, sf):
    g = games_v(spark, sf)
    c = corrections_v(g).withColumnRenamed("game_id", "id")
    return J.join_inner(g, c, ["id"]).select("id", "season", "home_team", "away_team",
                                             F.col("mode_spread").alias("original_spread"), "verified_spread")


@register("join_intersection", _g(f"""WITH {HV_CTE}
SELECT game_id FROM corrections_v WHERE game_id IN (SELECT game_id FROM hv)""", "odds_v", "corrections_v"))
def q_intersection(spark, sf):
    g = games_v(spark, sf)
    return J.only_in(corrections_v(g).select("game_id"), high_variance(spark, sf), "game_id")


alias("set_union_all", "feat_spread_quality")


# ---------------------------------------------------------------- J8 + E1-E4 + N

def flagged_games(spark, sf):
    g = games_v(spark, sf)
    return Q.flag_quality(g, high_variance(spark, sf), corrections_v(g))


FLAG_SQL = f"""{HV_CTE.replace('SELECT event_id AS game_id FROM', 'SELECT event_id AS game_id, ROUND(STDDEV_POP(outcome_point), 2) AS std_dev FROM')},
flagged AS (
  SELECT g.*, hv.std_dev AS spread_variance,
    CASE WHEN c.game_id IS NOT NULL THEN 'VERIFIED' WHEN hv.game_id IS NOT NULL THEN 'HIGH_VARIANCE'
         WHEN g.mode_spread IS NOT NULL THEN 'NORMAL' END AS spread_data_quality
  FROM games_v g LEFT JOIN hv ON hv.game_id = g.id LEFT JOIN corrections_v c ON c.game_id = g.id)"""


@register("feat_flag_quality_table", _g(f"WITH {FLAG_SQL}\nSELECT * FROM flagged", "odds_v", "corrections_v"))
def q_flag_table(spark, sf):
    return flagged_games(spark, sf)


@register("agg_by_quality", _g(f"""WITH {FLAG_SQL}
SELECT spread_data_quality, COUNT(*) AS n, AVG(spread_variance) AS avg_spread_variance,
  MAX(spread_variance) AS max_spread_variance,
  CASE spread_data_quality WHEN 'VERIFIED' THEN 0 WHEN 'HIGH_VARIANCE' THEN 1 WHEN 'NORMAL' THEN 2 ELSE 3 END
    AS class_rank
FROM flagged WHERE mode_spread IS NOT NULL GROUP BY spread_data_quality""", "odds_v", "corrections_v"))
def q_by_quality(spark, sf):
    f = flagged_games(spark, sf).filter(F.col("mode_spread").isNotNull())
    return A.by_class(f, "spread_data_quality", "spread_variance", Q.QUALITY_RANKS)


@register("sort_case_nulls_last", _g(f"""WITH {FLAG_SQL}
SELECT spread_data_quality, id, season, home_team, away_team, mode_spread,
  ROUND(spread_variance, 2) AS spread_variance
FROM flagged WHERE spread_data_quality IN ('VERIFIED', 'HIGH_VARIANCE')
ORDER BY CASE spread_data_quality WHEN 'VERIFIED' THEN 1 WHEN 'HIGH_VARIANCE' THEN 2 ELSE 3 END,
  spread_variance DESC NULLS LAST, id""", "odds_v", "corrections_v"))
def q_sort_case(spark, sf):
    f = flagged_games(spark, sf).filter(F.col("spread_data_quality").isin("VERIFIED", "HIGH_VARIANCE"))
    return (f.select("spread_data_quality", "id", "season", "home_team", "away_team", "mode_spread",
                     F.round("spread_variance", 2).alias("spread_variance"))
            .orderBy(Q.class_rank("spread_data_quality"), F.desc_nulls_last("spread_variance"), "id"))


@register("qc_flag_examples", _g(f"""WITH {FLAG_SQL}
SELECT spread_data_quality, id, season, home_team, away_team, mode_spread,
  ROUND(spread_variance, 2) AS spread_variance
FROM flagged
WHERE spread_data_quality IN ('VERIFIED', 'HIGH_VARIANCE') OR (spread_data_quality = 'NORMAL' AND id % 1000 = 0)
ORDER BY CASE spread_data_quality WHEN 'VERIFIED' THEN 1 WHEN 'HIGH_VARIANCE' THEN 2 WHEN 'NORMAL' THEN 3 END,
  spread_variance DESC NULLS LAST, id
LIMIT 20""", "odds_v", "corrections_v"))
def q_flag_examples(spark, sf):
    return Q.flag_examples(flagged_games(spark, sf))


@register("agg_coverage", _g("""
SELECT season, COUNT(*) AS n, COUNT(CASE WHEN mode_spread IS NOT NULL THEN 1 END) AS quoted,
  COUNT(CASE WHEN home_points IS NOT NULL THEN 1 END) AS scored,
  MIN(start_ts) AS first_start_ts, MAX(start_ts) AS last_start_ts
FROM games_v GROUP BY season"""))
def q_coverage(spark, sf):
    return A.coverage(games_v(spark, sf), "season",
                      {"quoted": F.col("mode_spread").isNotNull(), "scored": F.col("home_points").isNotNull()},
                      ts="start_ts")


@register("agg_pct", _g("""
SELECT season, ROUND(CAST(100 AS DOUBLE) * SUM(CASE WHEN mode_spread IS NOT NULL THEN 1 ELSE 0 END) / COUNT(*), 1)
  AS pct_quoted FROM games_v GROUP BY season"""))
def q_pct(spark, sf):
    return games_v(spark, sf).groupBy("season").agg(A.pct(F.col("mode_spread").isNotNull()).alias("pct_quoted"))


@register("agg_group_by_expr", _g("""
SELECT CASE WHEN home_points IS NULL THEN 'unplayed' ELSE 'played' END AS status, COUNT(*) AS n
FROM games_v GROUP BY 1"""))
def q_group_expr(spark, sf):
    g = games_v(spark, sf)
    return A.group_by_expr(g, F.when(F.col("home_points").isNull(), "unplayed").otherwise("played"), "status")


@register("qc_duplicate_ids", _g(f"""WITH {UPDATE_BATCH_SQL}
SELECT COUNT(*) AS duplicate_ids FROM batch WHERE id IN (SELECT id FROM games_v)"""))
def q_dup_ids(spark, sf):
    g = games_v(spark, sf)
    return Q.duplicate_ids(update_batch(g), g, "id")


@register("qc_schema", _g("""
SELECT 'id' AS "column", TRUE AS present, COUNT(id) AS non_null FROM games_v
UNION ALL SELECT 'home_points', TRUE, COUNT(home_points) FROM games_v
UNION ALL SELECT 'mode_spread', TRUE, COUNT(mode_spread) FROM games_v
UNION ALL SELECT 'spread_variance', FALSE, CAST(NULL AS BIGINT)"""))
def q_schema(spark, sf):
    return Q.check_schema(games_v(spark, sf), ["id", "home_points", "mode_spread", "spread_variance"])


@register("qc_populated", _g("""
SELECT CASE WHEN mode_spread IS NOT NULL THEN 'populated' ELSE 'NULL' END AS mode_spread_status,
  COUNT(*) AS game_count FROM games_v GROUP BY 1"""))
def q_populated(spark, sf):
    return Q.populated(games_v(spark, sf), "mode_spread")


@register("qc_coverage", _g("""
SELECT season, COUNT(*) AS total, COUNT(CASE WHEN mode_spread IS NOT NULL THEN 1 END) AS has_value,
  COUNT(CASE WHEN mode_spread IS NULL THEN 1 END) AS missing FROM games_v GROUP BY season"""))
def q_qc_coverage(spark, sf):
    return Q.coverage_by(games_v(spark, sf), "season", "mode_spread")


# ---------------------------------------------------------------- G: sorts / limits

@register("sort_multi", _g("SELECT id, season, week, start_ts FROM games_v ORDER BY season, week, start_ts, id"))
def q_sort(spark, sf):
    return games_v(spark, sf).select("id", "season", "week", "start_ts").orderBy("season", "week", "start_ts", "id")


@register("limit_n", _g("SELECT id, season, home_team FROM games_v ORDER BY id LIMIT 20"))
def q_limit(spark, sf):
    """LIMIT is the feature (a preview); ordered first so it is deterministic."""
    return games_v(spark, sf).select("id", "season", "home_team").orderBy("id").limit(20)


@register("topk", with_views("""
SELECT game_id, std_dev FROM (
  SELECT event_id AS game_id, ROUND(STDDEV_POP(outcome_point), 2) AS std_dev
  FROM odds_v WHERE market = 'spreads' AND outcome_point IS NOT NULL GROUP BY event_id
  HAVING COUNT(outcome_point) >= 3 AND STDDEV_POP(outcome_point) >= 0.5 - 1e-9)
ORDER BY std_dev DESC, game_id LIMIT 20""", "odds_v"))
def q_topk(spark, sf):
    """20 largest by std; ties keep the smallest id (deterministic)."""
    return high_variance(spark, sf).select("game_id", "std_dev").orderBy(F.desc("std_dev"), "game_id").limit(20)


# ---------------------------------------------------------------- I: scalar functions

@register("fn_dates", _g(f"""
SELECT id, CAST(date_diff('day', CAST(start_ts AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_to_as_of,
  CAST(start_ts AS DATE) AS game_date, CAST(CAST(start_ts AS DATE) - INTERVAL 7 DAY AS DATE) AS week_before,
  CAST(CAST(start_ts AS DATE) + INTERVAL 7 DAY AS DATE) AS week_after, CAST(year(start_ts) AS INTEGER) AS yr,
  CAST(substr(strftime(start_ts, '%Y-%m-%dT%H:%M:%S'), 1, 10) AS DATE) AS iso_day
FROM games_v"""))
def q_dates(spark, sf):
    g = games_v(spark, sf)
    return g.select("id", S.days_between(F.lit(AS_OF).cast("date"), "start_ts").alias("days_to_as_of"),
                    F.to_date("start_ts").alias("game_date"),
                    F.date_sub(F.to_date("start_ts"), 7).alias("week_before"),
                    F.date_add(F.to_date("start_ts"), 7).alias("week_after"),
                    F.year("start_ts").alias("yr"),
                    S.iso_date_prefix(F.date_format("start_ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("iso_day"))


@register("fn_utc_to_zone", """
SELECT event_id, timezone('America/Chicago', ts AT TIME ZONE 'UTC') AS local_ts,
  CAST(timezone('America/Chicago', ts AT TIME ZONE 'UTC') AS DATE) AS local_date FROM events""")
def q_utc_zone(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", S.utc_to_zone("ts", "America/Chicago").alias("local_ts"),
                     S.utc_to_zone_date("ts", "America/Chicago").alias("local_date"))


@register("fn_convert_timezone", _g("""
SELECT id, timezone('America/Chicago', timezone('America/New_York',
  strptime(strftime(start_ts, '%Y-%m-%d') || ' ' ||
           COALESCE(CASE WHEN id % 7 = 0 THEN NULL ELSE lpad(CAST(id % 24 AS VARCHAR), 2, '0') || ':'
                         || lpad(CAST(id % 60 AS VARCHAR), 2, '0') END, '12:00'), '%Y-%m-%d %H:%M'))) AS kickoff_central
FROM games_v"""))
def q_convert_tz(spark, sf):
    g = games_v(spark, sf)
    hhmm = F.when((F.col("id") % 7) != 0, F.format_string("%02d:%02d", F.col("id") % 24, F.col("id") % 60))
    return g.select("id", S.kickoff_local(F.to_date("start_ts"), hhmm).alias("kickoff_central"))


@register("fn_format_local_time", """
SELECT event_id, strftime(timezone('America/New_York', CAST(substr(strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'), 1, 19)
  AS TIMESTAMP) AT TIME ZONE 'UTC'), '%H:%M') AS local_hhmm FROM events""")
def q_local_time(spark, sf):
    ev = table(spark, sf, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return ev.select("event_id", S.local_hhmm(iso, "America/New_York").alias("local_hhmm"))


@register("fn_parse_iso_ts", """
SELECT event_id,
  CASE WHEN event_type = 'error' THEN NULL
       ELSE timezone('UTC', CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS TIMESTAMPTZ)) END AS parsed
FROM events""")
def q_parse_iso(spark, sf):
    ev = table(spark, sf, "events")
    txt = F.when(F.col("event_type") == "error", F.lit("")).otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    return ev.select("event_id", S.parse_iso(txt).cast("timestamp_ntz").alias("parsed"))


@register("fn_math", _g("""
SELECT id, ABS(home_points - away_points) AS abs_margin, ROUND(home_elo / 7, 2) AS elo_7,
  -mode_spread AS neg_spread, id % 7 AS id_mod, (home_points - away_points) / NULLIF(away_points, 0) AS ratio,
  ABS((home_points - mode_spread) - away_points) < 0.01 AS is_push
FROM games_v"""))
def q_math(spark, sf):
    g = games_v(spark, sf)
    return g.select("id", F.abs(F.col("home_points") - F.col("away_points")).alias("abs_margin"),
                    F.round(F.col("home_elo") / 7, 2).alias("elo_7"), (-F.col("mode_spread")).alias("neg_spread"),
                    (F.col("id") % 7).alias("id_mod"),
                    S.safe_div(F.col("home_points") - F.col("away_points"), "away_points").alias("ratio"),
                    S.close_to(F.col("home_points") - F.col("mode_spread"), "away_points").alias("is_push"))


@register("fn_conditional", _g("""
SELECT id, CASE WHEN home_points > away_points THEN 'home' WHEN home_points < away_points THEN 'away'
                WHEN home_points = away_points THEN 'tie' END AS winner,
  COALESCE(mode_spread, mode_spread_open, 0) AS any_line, NULLIF(week, 1) AS week_not_first
FROM games_v"""))
def q_conditional(spark, sf):
    g = games_v(spark, sf)
    hp, ap = F.col("home_points"), F.col("away_points")
    return g.select("id", F.when(hp > ap, "home").when(hp < ap, "away").when(hp == ap, "tie").alias("winner"),
                    F.coalesce("mode_spread", "mode_spread_open", F.lit(0.0)).alias("any_line"),
                    F.nullif(F.col("week"), F.lit(1)).alias("week_not_first"))


@register("fn_string", """
SELECT p_partkey, lower(p_name) || '-' || CAST(p_size AS VARCHAR) AS slug, substr(p_name, 1, 3) AS head,
  starts_with(p_name, 'small') AS is_small, trim('  ' || p_name || ' ') AS trimmed,
  contains(p_type, 'BRASS') AS brass,
  format('https://example.test/{}/week-{}', lower(replace(p_brand, '#', '')), p_size) AS url
FROM part""")
def q_string(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey",
                    F.concat(F.lower("p_name"), F.lit("-"), F.col("p_size").cast("string")).alias("slug"),
                    F.substring("p_name", 1, 3).alias("head"), F.col("p_name").startswith("small").alias("is_small"),
                    F.trim(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).alias("trimmed"),
                    F.col("p_type").contains("BRASS").alias("brass"),
                    S.url_for("https://example.test/%s/week-%d", F.lower(F.regexp_replace("p_brand", "#", "")),
                              F.col("p_size")).alias("url"))


def quote_pages(spark, sf):
    """Per event, an HTML table with one row per quote (in feed order):
    book | <b>market</b> | value | line | Open/Close.  Totals rows carry an
    unparsable value; h2h rows (no point) carry 'PICK'."""
    o = odds_v(spark, sf)
    val = (F.when(F.col("market") == "totals", F.lit("n/a"))
            .when(F.col("outcome_point").isNull(), F.lit("PICK"))
            .otherwise(F.col("outcome_point").cast("string")))
    label = F.when((F.col("line_no") % 2) == 1, F.lit("Open")).otherwise(F.lit("Close"))
    row = F.format_string("<tr class=\"r\"><td>%s</td><td><b>%s</b></td><td> %s </td><td>%d</td><th>%s</th></tr>",
                          F.col("bookmaker"), F.col("market"), val, F.col("line_no"), label)
    keyed = F.struct(*[F.col(c) for c in LINE_ORDER], row.alias("r"))
    g = o.groupBy("event_id").agg(F.sort_array(F.collect_list(keyed)).alias("rows"))
    return g.select("event_id", F.concat(F.lit("<html><table>"),
                                         F.array_join(F.transform("rows", lambda x: x["r"]), ""),
                                         F.lit("</table></html>")).alias("html"))


@register("fn_regex_html_rows", with_views(f"""
WITH r AS (
  SELECT event_id, line_no, market, outcome_point,
    ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY {', '.join(LINE_ORDER)}) AS rn
  FROM odds_v),
q AS (
  SELECT event_id, rn,
    CASE WHEN market = 'totals' THEN NULL WHEN outcome_point IS NULL THEN 0.0 ELSE -outcome_point END AS v
  FROM r WHERE rn <= 10 AND line_no % 2 = 1),
firsts AS (SELECT event_id, arg_min(v, rn) AS opening FROM q WHERE v IS NOT NULL GROUP BY event_id)
SELECT e.event_id, f.opening FROM (SELECT DISTINCT event_id FROM odds_v) e LEFT JOIN firsts f ON f.event_id = e.event_id
""", "odds_v"))
def q_html_rows(spark, sf):
    p = quote_pages(spark, sf)
    return p.select("event_id", H.opening_value(F.col("html")).alias("opening"))


@register("fn_regex_title", """
SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
  contains(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), 'the') AS redirected FROM pages""")
def q_title(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", H.page_title(F.col("html")).alias("title"),
                    H.is_redirect(F.col("html"), "the").alias("redirected"))


@register("fn_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  CAST(to_json([CAST(json_extract(props, '$.k') AS BIGINT), user_id]) AS VARCHAR) AS k_and_user FROM events""")
def q_json(spark, sf):
    ev = table(spark, sf, "events")
    parsed = F.from_json("props", "k BIGINT")
    return ev.select("event_id", parsed["k"].alias("k"),
                     F.to_json(F.array(parsed["k"], F.col("user_id"))).alias("k_and_user"))


@register("fn_array", with_views("""
SELECT event_id, COUNT(*) AS n_items, COUNT(outcome_point) AS n_points, MIN(outcome_point) AS min_point,
  MAX(outcome_point) AS max_point, AVG(outcome_point) AS mean_point FROM odds_v GROUP BY event_id""", "odds_v"))
def q_array(spark, sf):
    o = odds_v(spark, sf)
    g = o.groupBy("event_id").agg(F.collect_list(F.struct(F.col("line_no"), F.col("outcome_point"))).alias("items"))
    pts = F.transform("items", lambda x: x["outcome_point"])
    nn = S.non_null(pts)
    return g.select("event_id", F.size("items").cast("bigint").alias("n_items"),
                    F.size(nn).cast("bigint").alias("n_points"),
                    F.array_min(nn).alias("min_point"), F.array_max(nn).alias("max_point"),
                    S.array_mean(pts).alias("mean_point"))
