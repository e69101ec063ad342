"""Registered queries: sinks and table mutation (B1-B21), pro-league grading
and the sync chain (J10, J11, J22-J25)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as H
from ..operators import grading as GR
from ..operators import mutation as MU
from ..operators.aggregates import mode_spread
from ..operators.consensus import consensus
from ..session import checkpoint_dir
from ..sources.fixtures import corrections_v, games_v, odds_v, quotes_v, with_views
from ..sources import tables as TB
from .catalog_basic import BETTING_SQL, UPDATE_BATCH_SQL, betting_view, quote_pages, update_batch
from .catalog_quotes import CONSENSUS_CTE
from .registry import register

AS_OF_NFL = "1998-06-15"


def _g(sql, *views):
    return with_views(sql, "games_v", *views)


# ---------------------------------------------------------------- NFL-shaped fixture

NFL_SQL = """nfl AS (
  SELECT 'G' || CAST(id AS VARCHAR) AS game_id, id, season, week, strftime(start_ts, '%Y-%m-%d') AS gameday,
    '13:00' AS gametime, CAST(away_team AS VARCHAR) AS away_team, CAST(home_team AS VARCHAR) AS home_team,
    CAST(away_points AS INTEGER) AS away_score, CAST(home_points AS INTEGER) AS home_score,
    mode_spread AS spread_line, CAST(30 + id % 25 AS DOUBLE) AS total_line
  FROM games_v)"""


def nfl_v(spark, sf):
    g = games_v(spark, sf)
    return g.select(
        F.concat(F.lit("G"), F.col("id").cast("string")).alias("game_id"), "id", "season", "week",
        F.date_format("start_ts", "yyyy-MM-dd").alias("gameday"), F.lit("13:00").alias("gametime"),
        F.col("away_team").cast("string").alias("away_team"), F.col("home_team").cast("string").alias("home_team"),
        F.col("away_points").cast("int").alias("away_score"), F.col("home_points").cast("int").alias("home_score"),
        F.col("mode_spread").alias("spread_line"), (30 + F.col("id") % 25).cast("double").alias("total_line"))


NFL_COLS = ("game_id, id, season, week, gameday, gametime, away_team, home_team, away_score, home_score, "
            "spread_line, total_line")

# Results by list position: the sign of a difference picks the label; NULL scores or lines give NULL.
# Fixed value: an edge below 0.01 is a push.
_EDGE = "(home_score - spread_line - away_score)"
_LABEL = "[{0}][(sign({1}) + 2)::INTEGER]"
_PUSHED = f"(CASE WHEN abs({_EDGE}) < 0.01 THEN 0 ELSE {_EDGE} END)"
GRADE_SQL = ",\n  ".join([
    "home_score - away_score AS point_differential",
    "home_score + away_score AS total_points",
    _LABEL.format("'away_win', 'tie', 'home_win'", "home_score - away_score") + " AS game_result",
    _LABEL.format("'away_covered', 'push', 'home_covered'", _PUSHED) + " AS spread_result",
    _LABEL.format("'under', 'push', 'over'", "home_score + away_score - total_line") + " AS over_under_result"])
ATS_SQL = ",\n  ".join([
    f"({_EDGE} > 0)::INTEGER AS home_covered",
    f"if({_EDGE} > 0, 'HOME', if({_EDGE} > -0.01, 'PUSH', if({_EDGE} IS NOT NULL, 'AWAY', NULL))) AS cover",
    _LABEL.format("'AWAY_COVERED', 'PUSH', 'HOME_COVERED'", _PUSHED) + " AS ats_result"])


@register("feat_result_nfl", _g(f"WITH {NFL_SQL}\nSELECT {NFL_COLS}, {GRADE_SQL} FROM nfl"))
def q_grade(spark, sf):
    return GR.grade_scores(nfl_v(spark, sf))


@register("feat_ats_nfl", _g(f"WITH {NFL_SQL}\nSELECT {NFL_COLS}, {ATS_SQL} FROM nfl"))
def q_ats(spark, sf):
    return GR.grade_ats(nfl_v(spark, sf))


# opening line from the stored pages (I9), as the backfill job obtains it
OPENING_SQL = """r AS (
  SELECT event_id, line_no, market, outcome_point,
    ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY last_update, line_no, bookmaker, outcome_price, outcome_point) AS rn
  FROM odds_v),
q AS (SELECT event_id, rn,
        CASE WHEN market = 'totals' THEN NULL WHEN outcome_point IS NULL THEN 0.0 ELSE -outcome_point END AS v
      FROM r WHERE rn <= 10 AND line_no % 2 = 1),
opening AS (SELECT event_id, arg_min(v, rn) AS opening_spread FROM q WHERE v IS NOT NULL GROUP BY event_id)"""


def openings(spark, sf):
    p = quote_pages(spark, sf)
    return p.select(F.col("event_id").alias("id"), H.opening_value(F.col("html")).alias("opening_spread")) \
            .filter(F.col("opening_spread").isNotNull())


@register("line_movement", _g(f"""WITH {NFL_SQL}, {OPENING_SQL}
SELECT n.game_id, o.opening_spread, n.spread_line - o.opening_spread AS line_movement,
  -o.opening_spread AS home_line_open, o.opening_spread AS away_line_open,
  -n.spread_line AS home_line_close, n.spread_line AS away_line_close
FROM nfl n JOIN opening o ON o.event_id = n.id WHERE n.spread_line IS NOT NULL""", "odds_v"))
def q_line_move(spark, sf):
    n = nfl_v(spark, sf).filter(F.col("spread_line").isNotNull())
    j = n.join(openings(spark, sf), "id")
    return GR.line_movement(j).select("game_id", "opening_spread", "line_movement", "home_line_open",
                                      "away_line_open", "home_line_close", "away_line_close")


@register("report_need_backfill", _g(f"""WITH {NFL_SQL}, {OPENING_SQL}
SELECT season, COUNT(*) AS games_missing FROM (
  SELECT DISTINCT n.game_id, n.season FROM nfl n LEFT JOIN opening o ON o.event_id = n.id
  WHERE n.spread_line IS NOT NULL AND o.opening_spread IS NULL) GROUP BY season""", "odds_v"))
def q_need_backfill(spark, sf):
    n = nfl_v(spark, sf).filter(F.col("spread_line").isNotNull())
    missing = n.join(openings(spark, sf), "id", "left_anti").select("game_id", "season").distinct()
    return missing.groupBy("season").agg(F.count(F.lit(1)).alias("games_missing"))


@register("report_recent", _g(f"""WITH {NFL_SQL}
SELECT 'recent' AS section, gameday, gametime, away_team, home_team, away_score, home_score, spread_line FROM nfl
WHERE CAST(gameday AS DATE) >= DATE '{AS_OF_NFL}' - INTERVAL 7 DAY AND CAST(gameday AS DATE) <= DATE '{AS_OF_NFL}'
UNION ALL
SELECT 'upcoming', gameday, gametime, away_team, home_team, away_score, home_score, spread_line FROM nfl
WHERE home_score IS NULL AND spread_line IS NOT NULL AND season = 1998"""))
def q_recent(spark, sf):
    n = nfl_v(spark, sf)
    d = F.to_date("gameday")
    a = F.lit(AS_OF_NFL).cast("date")
    cols = ["gameday", "gametime", "away_team", "home_team", "away_score", "home_score", "spread_line"]
    recent = n.filter((d >= F.date_sub(a, 7)) & (d <= a)).select(F.lit("recent").alias("section"), *cols)
    upcoming = n.filter(F.col("home_score").isNull() & F.col("spread_line").isNotNull()
                        & (F.col("season") == 1998)).select(F.lit("upcoming").alias("section"), *cols)
    return recent.unionByName(upcoming).orderBy("section", "gameday", "gametime")


# ---------------------------------------------------------------- B1-B5, B19, B20 (sinks)

@register("sink_append", _g("SELECT * FROM games_v UNION ALL SELECT * FROM games_v"))
def q_append(spark, sf):
    path = TB.new_path(spark, "games")
    g = games_v(spark, sf)
    TB.append(g, path)
    TB.append(g, path)
    return spark.read.parquet(path)


@register("sink_overwrite", _g("SELECT * FROM games_v WHERE home_classification = 'fbs'"))
def q_overwrite(spark, sf):
    """The new state is computed from a table while another path is overwritten with it."""
    now, nxt = TB.new_path(spark, "games"), TB.new_path(spark, "games")
    g = games_v(spark, sf)
    g.write.parquet(now)
    g.limit(5).write.parquet(nxt)
    spark.read.parquet(now).filter(F.col("home_classification") == "fbs").write.mode("overwrite").parquet(nxt)
    return spark.read.parquet(nxt)


def _table_name(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


@register("sink_ctas", _g("SELECT season, COUNT(*) AS n, COUNT(mode_spread) AS quoted FROM games_v GROUP BY season"))
def q_ctas(spark, sf):
    g = games_v(spark, sf)
    df = g.groupBy("season").agg(F.count(F.lit(1)).alias("n"), F.count("mode_spread").alias("quoted"))
    name = _table_name("coverage")
    df.write.mode("overwrite").option("path", TB.new_path(spark, "coverage")).saveAsTable(name)
    return spark.table(name)


CORRECTIONS_SCHEMA = T.StructType([
    T.StructField("game_id", T.LongType(), False, {"comment": "game id"}),
    T.StructField("verified_spread", T.DoubleType(), True, {"comment": "verified closing spread"}),
    T.StructField("source", T.StringType(), True, {"comment": "where it was verified"}),
    T.StructField("date_corrected", T.DateType(), True, {"comment": "when"}),
    T.StructField("notes", T.StringType(), True, {"comment": "free text"}),
])


@register("sink_create_typed", _g("""
SELECT game_id, verified_spread, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS DATE) AS date_corrected,
  CAST(NULL AS VARCHAR) AS notes FROM corrections_v""", "corrections_v"))
def q_create_typed(spark, sf):
    name, path = _table_name("corrections"), TB.new_path(spark, "corrections")
    TB.create_typed(spark, name, CORRECTIONS_SCHEMA, path)
    TB.create_typed(spark, name, CORRECTIONS_SCHEMA, path)      # second call: nothing to do
    TB.insert_by_name(corrections_v(games_v(spark, sf)), name)
    return spark.table(name)


@register("sink_backup", _g("SELECT COUNT(*) AS count FROM games_v"))
def q_backup(spark, sf):
    path, backup = TB.new_path(spark, "games"), TB.new_path(spark, "games_backup")
    games_v(spark, sf).write.parquet(path)
    spark.read.parquet(path).write.parquet(backup)
    return spark.read.parquet(backup).groupBy().count()


UPSERT_SQL = f"""WITH {UPDATE_BATCH_SQL}
SELECT * FROM games_v WHERE id NOT IN (SELECT id FROM batch) UNION ALL SELECT * FROM batch"""


@register("create_or_merge", _g(UPSERT_SQL))
def q_create_or_merge(spark, sf):
    path = TB.new_path(spark, "games")
    g = games_v(spark, sf)
    TB.upsert_partitions(spark, path, g, "id")                # creates
    TB.upsert_partitions(spark, path, update_batch(g), "id")  # merges
    return spark.read.parquet(path).select(*g.columns)


@register("append_dedup", _g(f"""WITH {UPDATE_BATCH_SQL}
SELECT * FROM games_v UNION ALL SELECT * FROM batch WHERE id NOT IN (SELECT id FROM games_v)"""))
def q_append_dedup(spark, sf):
    path = TB.new_path(spark, "games")
    g = games_v(spark, sf)
    g.write.parquet(path)
    TB.append(MU.append_new(update_batch(g), spark.read.parquet(path), "id"), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- B6-B18, B21 (mutations)

@register("merge_upsert_all", _g(UPSERT_SQL))
def q_upsert(spark, sf):
    g = games_v(spark, sf)
    return MU.merge_upsert(g, update_batch(g), "id")


@register("merge_update_cols", _g("""
SELECT g.* REPLACE (CASE WHEN c.game_id IS NOT NULL THEN c.verified_spread ELSE g.mode_spread END AS mode_spread)
FROM games_v g LEFT JOIN corrections_v c ON c.game_id = g.id""", "corrections_v"))
def q_merge_update(spark, sf):
    g = games_v(spark, sf)
    src = corrections_v(g).withColumnRenamed("game_id", "id")
    return MU.merge_update(g, src, "id", {"mode_spread": "verified_spread"})


MODE_CTE = """m AS (SELECT event_id, outcome_point AS line_mode FROM (
  SELECT event_id, outcome_point,
    ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY COUNT(*) DESC, outcome_point) AS rn
  FROM odds_v WHERE market = 'spreads' AND outcome_point IS NOT NULL GROUP BY event_id, outcome_point)
  WHERE rn = 1)"""


@register("merge_update_guarded", _g(f"""WITH {MODE_CTE}
SELECT g.* REPLACE (CASE WHEN m.event_id IS NOT NULL AND g.home_points IS NULL THEN m.line_mode
                         ELSE g.mode_spread END AS mode_spread)
FROM games_v g LEFT JOIN m ON m.event_id = g.id""", "odds_v"))
def q_merge_guarded(spark, sf):
    g = games_v(spark, sf)
    m = mode_spread(odds_v(spark, sf).filter(F.col("market") == "spreads"), "event_id", "outcome_point",
                    name="line_mode").withColumnRenamed("event_id", "id")
    return MU.merge_update(g, m, "id", {"mode_spread": "line_mode"}, target_pred=F.col("home_points").isNull())


@register("merge_from_join", _g(f"""WITH {BETTING_SQL},
src AS (SELECT g.id, MAX(b.bet_spread) AS bet_spread FROM games_v g JOIN betting b
  ON g.season = b.season AND g.week = b.week AND CAST(g.start_ts AS DATE) = b.gameday
  AND g.home_team = b.home_team AND g.away_team = b.away_team GROUP BY g.id)
SELECT g.* REPLACE (CASE WHEN s.id IS NOT NULL THEN s.bet_spread ELSE g.mode_spread_open END AS mode_spread_open)
FROM games_v g LEFT JOIN src s ON s.id = g.id"""))
def q_merge_join(spark, sf):
    g = games_v(spark, sf)
    joined = (g.withColumn("gameday", F.to_date("start_ts"))
              .join(betting_view(g), ["season", "week", "gameday", "home_team", "away_team"])
              .select("id", "bet_spread"))
    src = MU.assert_unique(joined, "id", dedupe_by=["bet_spread"])
    return MU.merge_update(g, src, "id", {"mode_spread_open": "bet_spread"})


@register("merge_computed_set", _g(f"""WITH {NFL_SQL},
src AS (SELECT game_id, strftime(CAST(gameday AS DATE), '%d/%m/%Y') AS gameday_text, {ATS_SQL} FROM nfl)
SELECT n.*, s.gameday_text, s.home_covered, s.cover, s.ats_result FROM nfl n LEFT JOIN src s ON s.game_id = n.game_id"""))
def q_merge_computed(spark, sf):
    n = nfl_v(spark, sf)
    exprs = dict(GR.ats_columns())
    exprs["gameday_text"] = F.date_format(F.to_date("gameday"), "dd/MM/yyyy")
    return MU.merge_update(n, n, "game_id", exprs=exprs)


@register("merge_fill_null_only", _g(f"""WITH {CONSENSUS_CTE}
SELECT g.* REPLACE (COALESCE(g.mode_spread, c.consensus_spread) AS mode_spread)
FROM games_v g LEFT JOIN consensus c ON c.event_id = g.id""", "quotes_v"))
def q_fill_null(spark, sf):
    g = games_v(spark, sf)
    c = consensus(quotes_v(spark, sf)).select(F.col("event_id").alias("id"), "consensus_spread")
    return MU.fill_null(g, c, "id", "mode_spread", "consensus_spread")


@register("merge_ambiguity_check", _g("""
SELECT home_team, away_team, COUNT(*) AS n_rows FROM games_v WHERE home_points IS NULL
GROUP BY home_team, away_team HAVING COUNT(*) > 1"""))
def q_ambiguity(spark, sf):
    g = games_v(spark, sf).filter(F.col("home_points").isNull())
    return MU.assert_unique(g, ["home_team", "away_team"])


@register("update_where", _g("""
SELECT * REPLACE (CASE WHEN home_points > away_points THEN home_elo + 10 ELSE home_elo END AS home_elo) FROM games_v"""))
def q_update(spark, sf):
    g = games_v(spark, sf)
    return MU.update(g, F.col("home_points") > F.col("away_points"), {"home_elo": F.col("home_elo") + 10})


@register("update_where_in_subquery", _g("""
SELECT *, CASE WHEN id IN (SELECT game_id FROM corrections_v) THEN 'VERIFIED' END AS spread_data_quality
FROM games_v""", "corrections_v"))
def q_update_in(spark, sf):
    g = games_v(spark, sf)
    return MU.update_in(g, corrections_v(g), "id", {"spread_data_quality": F.lit("VERIFIED")}, keys_col="game_id")


@register("delete_where", _g("""
SELECT * FROM games_v WHERE NOT COALESCE(season BETWEEN 1996 AND 1997 AND home_points > 30, FALSE)"""))
def q_delete(spark, sf):
    g = games_v(spark, sf)
    return MU.delete(g, F.col("season").between(1996, 1997) & (F.col("home_points") > 30))


@register("insert_select", _g("""
SELECT * FROM games_v WHERE home_classification = 'fbs'
UNION ALL SELECT DISTINCT * FROM games_v WHERE home_classification = 'fcs'"""))
def q_insert(spark, sf):
    g = games_v(spark, sf)
    return MU.insert(g.filter(F.col("home_classification") == "fbs"),
                     g.filter(F.col("home_classification") == "fcs"), distinct=True)


@register("refresh_window", _g(f"""WITH {NFL_SQL},
src AS (SELECT * REPLACE (spread_line + 1 AS spread_line) FROM nfl)
SELECT * FROM nfl WHERE NOT COALESCE(CAST(gameday AS DATE) BETWEEN DATE '{AS_OF_NFL}' - INTERVAL 7 DAY
                                      AND DATE '{AS_OF_NFL}' + INTERVAL 7 DAY, FALSE)
UNION ALL
SELECT DISTINCT * FROM src WHERE CAST(gameday AS DATE) BETWEEN DATE '{AS_OF_NFL}' - INTERVAL 7 DAY
                                      AND DATE '{AS_OF_NFL}' + INTERVAL 7 DAY"""))
def q_refresh(spark, sf):
    n = nfl_v(spark, sf)
    src = n.withColumn("spread_line", F.col("spread_line") + 1)
    return MU.refresh_window(n, src, "gameday", AS_OF_NFL, 7, 7)


@register("alter_add_columns", _g("""
SELECT *, CAST(NULL AS DOUBLE) AS spread_variance, CAST(NULL AS VARCHAR) AS spread_data_quality FROM games_v"""))
def q_add_cols(spark, sf):
    g = games_v(spark, sf)
    return MU.add_columns(g, {"spread_variance": "double", "spread_data_quality": "string", "season": "int"})


@register("correction_upsert_apply", _g("""
WITH upd AS (
  SELECT game_id, verified_spread + 0.5 AS verified_spread FROM corrections_v WHERE game_id % 2 = 0
  UNION ALL
  SELECT id, mode_spread - 1 FROM games_v WHERE week = 15 AND mode_spread IS NOT NULL
    AND id NOT IN (SELECT game_id FROM corrections_v)),
reg AS (SELECT * FROM corrections_v WHERE game_id NOT IN (SELECT game_id FROM upd) UNION ALL SELECT * FROM upd)
SELECT g.* REPLACE (CASE WHEN r.game_id IS NOT NULL THEN r.verified_spread ELSE g.mode_spread END AS mode_spread)
FROM games_v g LEFT JOIN reg r ON r.game_id = g.id""", "corrections_v"))
def q_corrections(spark, sf):
    g = games_v(spark, sf)
    reg = corrections_v(g)
    upd = (reg.filter((F.col("game_id") % 2) == 0).withColumn("verified_spread", F.col("verified_spread") + 0.5)
           .unionByName(MU.append_new(
               g.filter((F.col("week") == 15) & F.col("mode_spread").isNotNull())
                .select(F.col("id").alias("game_id"), (F.col("mode_spread") - 1).alias("verified_spread")),
               reg, "game_id")))
    _, facts = MU.apply_corrections(g, reg, upd)
    return facts


# ---------------------------------------------------------------- J25 sync chain

NFL_STAGE_SQL = """staging AS (
  SELECT * REPLACE (home_score + 1 AS home_score, away_score + 1 AS away_score) FROM nfl WHERE id % 5 = 0
  UNION ALL
  SELECT * REPLACE ('N' || game_id AS game_id, id + 100000000 AS id) FROM nfl WHERE id % 5 = 0)"""


def nfl_staging(n):
    upd = n.filter((F.col("id") % 5) == 0).withColumns(
        {"home_score": F.col("home_score") + 1, "away_score": F.col("away_score") + 1})
    ins = n.filter((F.col("id") % 5) == 0).withColumns(
        {"game_id": F.concat(F.lit("N"), F.col("game_id")), "id": F.col("id") + 100000000})
    return upd.unionByName(ins)


REPORT_EXTRA = {"point_differential": "int", "total_points": "int", "game_result": "string",
                "spread_result": "string", "over_under_result": "string", "bet_spread": "double",
                "home_covered": "int", "cover": "string", "ats_result": "string"}
# Columns each stage takes over from the one before it.
COMPLETE_SYNC = ["spread_line", "total_line", "away_score", "home_score", "gametime", "gameday", "week"]
ENHANCED_SYNC = ["spread_line", "total_line", "away_score", "home_score", "gametime", "point_differential",
                 "total_points", "game_result", "spread_result", "over_under_result"]
COMPLETE_EXTRA = {"point_differential": "int", "total_points": "int", "game_result": "string",
                  "spread_result": "string", "over_under_result": "string"}


_INSIDE = f"abs(date_diff('day', DATE '{AS_OF_NFL}', n.gameday::DATE)) <= 7"


def enhanced_source(complete, betting):
    """Graded games with their betting line; of several lines of one game the largest."""
    src = (complete.withColumn("gameday_d", F.to_date("gameday"))
           .join(betting.withColumnRenamed("gameday", "gameday_d"),
                 ["season", "week", "gameday_d", "home_team", "away_team"]))
    return MU.assert_unique(src.select("game_id", *ENHANCED_SYNC, "bet_spread"), "game_id", dedupe_by=["bet_spread"])


def nfl_tables(spark, n):
    """The four stale season-partitioned tables of the sync chain (initial
    load; every table carries its derived columns from the start)."""
    root = f"{checkpoint_dir(spark)}/nfl-{uuid.uuid4().hex[:12]}"
    paths = {k: f"{root}/{k}" for k in ("historical", "complete", "enhanced", "report")}
    TB.create_partitioned(n, paths["historical"], "game_id")
    MU.add_columns(n, COMPLETE_EXTRA).write.partitionBy("season").parquet(paths["complete"])
    MU.add_columns(n, REPORT_EXTRA).write.partitionBy("season").parquet(paths["enhanced"])
    MU.add_columns(n, REPORT_EXTRA).write.partitionBy("season").parquet(paths["report"])
    return paths


def sync_partitioned(spark, paths: dict, source, betting, as_of, part_col: str = "season"):
    """J25 on season-partitioned tables: each stage rewrites only the seasons
    the day's source touches (the report: only the seasons inside the
    [as_of-7, as_of+7] window).  The touched seasons are a handful of values,
    collected as plan parameters."""
    rd = spark.read.parquet
    affected = set(TB.upsert_partitions(spark, paths["historical"], source, "game_id", part_col))

    def in_aff(df):
        return df.filter(F.col(part_col).isin(list(affected)))

    TB.rewrite_partitions(spark, paths["complete"], affected, lambda cur: GR.grade_scores(MU.merge_update(
        cur, in_aff(rd(paths["historical"])), "game_id", COMPLETE_SYNC)), part_col)

    def enhance(cur):
        return MU.merge_update(cur, enhanced_source(in_aff(rd(paths["complete"])), betting), "game_id",
                               [*ENHANCED_SYNC, "bet_spread"], exprs=GR.ats_columns())
    TB.rewrite_partitions(spark, paths["enhanced"], affected, enhance, part_col)
    a = F.lit(str(as_of)).cast("date")
    in_win = F.to_date("gameday").between(F.date_sub(a, 7), F.date_add(a, 7))
    window = set()
    for stage in ("enhanced", "report"):            # rows that enter the window and rows that leave it
        window |= TB.values_of(rd(paths[stage]).filter(in_win), part_col)
    TB.rewrite_partitions(spark, paths["report"], window, lambda cur: MU.refresh_window(
        cur, rd(paths["enhanced"]).filter(F.col(part_col).isin(list(window))), "gameday", as_of, 7, 7), part_col)
    return rd(paths["report"])


# The chain's end state game by game: a staged version of the game if there is one, graded, joined with the
# largest betting line of its names and day; games outside the window keep the stale report row.
@register("nfl_sync_chain", _g(f"""WITH {NFL_SQL}, {NFL_STAGE_SQL},
latest AS (
  SELECT n.* REPLACE (ifnull(s.game_id, n.game_id) AS game_id, if(s.game_id IS NULL, n.away_score, s.away_score) AS away_score,
    if(s.game_id IS NULL, n.home_score, s.home_score) AS home_score)
  FROM nfl AS n LEFT JOIN staging AS s USING (game_id)),
graded AS (SELECT *, {GRADE_SQL}, {ATS_SQL}, gameday::DATE AS day FROM latest),
bets AS (
  SELECT season, week, gameday AS day, home_team::VARCHAR AS home_team, away_team::VARCHAR AS away_team, max(bet_spread) AS bet
  FROM ({BETTING_SQL.split(' AS (', 1)[1][:-1]}) GROUP BY ALL),
found AS (SELECT game_id, bet FROM graded JOIN bets USING (season, week, day, home_team, away_team))
SELECT DISTINCT n.* EXCLUDE (spread_line, total_line, away_score, home_score, gametime),
  {", ".join(f"CASE WHEN {_INSIDE} AND f.game_id IS NOT NULL THEN g.{c} ELSE n.{c} END AS {c}"
             for c in ("spread_line", "total_line", "away_score", "home_score", "gametime"))},
  {", ".join(f"CASE WHEN {_INSIDE} AND f.game_id IS NOT NULL THEN {e} END AS {c}" for c, e in
             [*((c, f"g.{c}") for c in ("point_differential", "total_points", "game_result", "spread_result",
                                        "over_under_result")), ("bet_spread", "f.bet"),
              *((c, f"g.{c}") for c in ("home_covered", "cover", "ats_result"))])}
FROM nfl AS n JOIN graded AS g USING (game_id) LEFT JOIN found AS f USING (game_id)"""))
def q_sync(spark, sf):
    n = nfl_v(spark, sf)
    g = games_v(spark, sf)
    bet = betting_view(g).withColumns({"home_team": F.col("home_team").cast("string"),
                                       "away_team": F.col("away_team").cast("string")})
    paths = nfl_tables(spark, n)
    return sync_partitioned(spark, paths, nfl_staging(n), bet, AS_OF_NFL).select(*NFL_COLS.split(", "),
                                                                                *REPORT_EXTRA)


# ---------------------------------------------------------------- daily refresh (BASELINE's headline job)

REFRESH_AS_OF = "2001-07-20"
REFRESH_EXTRA = {"game_date": "date", "start_central": "timestamp_ntz", "game_date_central": "date"}


def refresh_inputs(spark, sf):
    """The day's pulls: every game of the seasons the 7-day window touches,
    re-scored (late score corrections), and the spread quotes as lines."""
    from ..sources.readers import seasons_to_scan
    g = games_v(spark, sf)
    pull = g.filter(F.col("season").isin(seasons_to_scan(REFRESH_AS_OF))).withColumns(
        {"home_points": F.col("home_points") + 1, "away_points": F.col("away_points") + 1})
    o = odds_v(spark, sf).filter(F.col("market") == "spreads")
    lines = o.select(F.col("event_id").alias("id"),
                     F.when(F.col("outcome_name") == "home", F.col("outcome_point")).alias("spread"),
                     F.when(F.col("outcome_name") == "away", F.col("outcome_point")).alias("spread_open"))
    return g, pull, lines


def _mode_sql(name, side):
    return f"""{name} AS (SELECT id, v FROM (
  SELECT event_id AS id, outcome_point AS v,
    ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY COUNT(*) DESC, outcome_point) AS rn
  FROM odds_v WHERE market = 'spreads' AND outcome_name = '{side}' GROUP BY event_id, outcome_point) WHERE rn = 1)"""


@register("daily_refresh", _g(f"""WITH pull AS (SELECT * EXCLUDE (mode_spread, mode_spread_open)
           REPLACE (home_points + 1 AS home_points, away_points + 1 AS away_points)
         FROM games_v WHERE season IN (2001) AND start_ts >= TIMESTAMP '2001-07-13 00:00:00'),
{_mode_sql('sp', 'home')}, {_mode_sql('op', 'away')},
lm AS (SELECT e.id, sp.v AS mode_spread, op.v AS mode_spread_open
       FROM (SELECT DISTINCT event_id AS id FROM odds_v WHERE market = 'spreads') e
       LEFT JOIN sp ON sp.id = e.id LEFT JOIN op ON op.id = e.id),
src AS (SELECT p.*, lm.mode_spread, lm.mode_spread_open, CAST(p.start_ts AS DATE) AS game_date,
          timezone('America/Chicago', p.start_ts AT TIME ZONE 'UTC') AS start_central,
          CAST(timezone('America/Chicago', p.start_ts AT TIME ZONE 'UTC') AS DATE) AS game_date_central
        FROM pull p LEFT JOIN lm ON lm.id = p.id)
SELECT *, CAST(NULL AS DATE) AS game_date, CAST(NULL AS TIMESTAMP) AS start_central,
  CAST(NULL AS DATE) AS game_date_central FROM games_v WHERE id NOT IN (SELECT id FROM src)
UNION ALL BY NAME SELECT * FROM src""", "odds_v"))
def q_daily_refresh(spark, sf):
    """Initial load of the season-partitioned fact table, then one day's
    incremental refresh (only the touched seasons are rewritten)."""
    from .refresh import daily_refresh
    g, pull, lines = refresh_inputs(spark, sf)
    path = f"{checkpoint_dir(spark)}/refresh-{uuid.uuid4().hex[:12]}/games"
    TB.create_partitioned(MU.add_columns(g, REFRESH_EXTRA), path, "id")
    daily_refresh(spark, path, pull, lines, REFRESH_AS_OF)
    return spark.read.parquet(path)
