"""Fixture views over the driver's test tables.

The driver ships TPC-H-shaped parquet (orders, lineitem, part, labels,
documents, pages, events).  These functions derive the contest-shaped
inputs the operators consume, as DataFrame expressions (Spark side), and
the same definitions as SQL text (`GAMES_V_SQL`, ...) for the DuckDB oracle.
Both derive every row from the given tables, so work grows with them.

games_v : one row per order = one game (40 teams, 7 seasons)
odds_v  : one row per line item = one bookmaker quote on a game
picks_v : labelled documents = binary outcomes per rule
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _half(c: Column) -> Column:
    return c / F.lit(2.0)


def games_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    unplayed = (k % 13) == 0
    unquoted = (k % 11) == 0
    dbl = "double"
    return o.select(
        k.alias("id"),
        F.year("o_orderdate").cast("int").alias("season"),
        (F.floor((F.dayofyear("o_orderdate") - 1) / F.lit(25.0)).cast("int") + 1).alias("week"),
        F.col("o_orderdate").alias("start_ts"),
        (cust % 40).alias("home_team"),
        ((cust % 40 + 1 + k % 39) % 40).alias("away_team"),
        F.when(~unplayed, (F.floor("o_totalprice").cast("bigint") % 60).cast(dbl)).alias("home_points"),
        F.when(~unplayed, (F.floor(F.col("o_totalprice") / 7).cast("bigint") % 60).cast(dbl)).alias("away_points"),
        F.when(~unquoted, _half((k * 7) % 57 - 28)).alias("mode_spread"),
        F.when(~unquoted, _half((k * 5) % 57 - 28)).alias("mode_spread_open"),
        F.when(F.col("o_orderpriority") == "5-LOW", "fcs").otherwise("fbs").alias("home_classification"),
        (1500 + (cust * 37) % 400).cast(dbl).alias("home_elo"),
        (1500 + (k * 53) % 400).cast(dbl).alias("away_elo"),
        F.when(k % 7 != 0, k % 3 == 0).alias("conference_game"),
        F.when(k % 5 != 0, k % 9 == 1).alias("neutral_site"),
        F.when(k % 4 != 0, (1000 + (k * 31) % 90000).cast(dbl)).alias("attendance"),
        F.concat(F.lit("conf"), (cust % 40 % 6).cast("string")).alias("home_conference"),
        F.when(k % 17 != 0, F.concat(F.lit("conf"), ((cust % 40 + 1 + k % 39) % 40 % 6).cast("string")))
         .alias("away_conference"),
    )


def odds_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    flag, ln = F.col("l_returnflag"), F.col("l_linenumber")
    return li.select(
        F.col("l_orderkey").alias("event_id"),
        F.concat(F.lit("book"), (F.col("l_suppkey") % 12).cast("string")).alias("bookmaker"),
        F.when(flag == "A", "spreads").when(flag == "N", "h2h").otherwise("totals").alias("market"),
        F.when(flag == "R", F.when(ln % 2 == 0, "Over").otherwise("Under"))
         .when(ln % 2 == 0, "home").otherwise("away").alias("outcome_name"),
        (100 + F.floor("l_extendedprice").cast("bigint") % 200).cast("double").alias("outcome_price"),
        F.when(flag != "N", _half((F.floor("l_quantity").cast("bigint") % 9 - 4)
                                  * F.when(F.col("l_orderkey") % 23 == 0, 8).otherwise(1))).alias("outcome_point"),
        F.col("l_shipdate").alias("last_update"),
        ln.alias("line_no"),
    )


def picks_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return (labels.join(docs, "doc_id")
            .select(F.col("source").alias("rule"), F.col("quality").alias("won")))


def quotes_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat quote table in the odds feed's shape (A3 output): each quote
    carries its event's kick-off and team names; 'home'/'away' outcomes are
    named by team, as the feed does."""
    o = odds_v(spark, sf_dir)
    g = games_v(spark, sf_dir).select(
        F.col("id").alias("event_id"), F.col("start_ts").alias("commence_time"),
        F.col("home_team").cast("string").alias("home_team"),
        F.col("away_team").cast("string").alias("away_team"))
    j = o.join(g, "event_id")
    name = (F.when(F.col("outcome_name") == "home", F.col("home_team"))
             .when(F.col("outcome_name") == "away", F.col("away_team"))
             .otherwise(F.col("outcome_name")))
    return j.select("event_id", "commence_time", "home_team", "away_team", "bookmaker", "market",
                    name.alias("outcome_name"), "outcome_price", "outcome_point", "last_update", "line_no")


def corrections_v(games: DataFrame) -> DataFrame:
    """Correction registry: a verified spread for every 97th quoted game."""
    return (games.filter(((F.col("id") % 97) == 0) & F.col("mode_spread").isNotNull())
            .select(F.col("id").alias("game_id"),
                    (F.col("mode_spread") + 3).alias("verified_spread")))


def names_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw names to normalise: the part names."""
    return table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))


def dictionary_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical name dictionary: distinct first words of the part names."""
    return (table(spark, sf_dir, "part")
            .select(F.split("p_name", " ", 2)[0].alias("team")).distinct())


# --------------------------------------------------------------------------
# SQL text of the same views, for the DuckDB oracle (and Spark SQL users).
# --------------------------------------------------------------------------

GAMES_V_SQL = """SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INT) AS season,
 CAST(floor((dayofyear(o_orderdate) - 1) / CAST(25 AS DOUBLE)) AS INT) + 1 AS week,
 o_orderdate AS start_ts,
 o_custkey % 40 AS home_team,
 (o_custkey % 40 + 1 + o_orderkey % 39) % 40 AS away_team,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 60 AS DOUBLE) END AS home_points,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(CAST(floor(o_totalprice / 7) AS BIGINT) % 60 AS DOUBLE) END AS away_points,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE ((o_orderkey * 7) % 57 - 28) / CAST(2 AS DOUBLE) END AS mode_spread,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE ((o_orderkey * 5) % 57 - 28) / CAST(2 AS DOUBLE) END AS mode_spread_open,
 CASE WHEN o_orderpriority = '5-LOW' THEN 'fcs' ELSE 'fbs' END AS home_classification,
 CAST(1500 + (o_custkey * 37) % 400 AS DOUBLE) AS home_elo,
 CAST(1500 + (o_orderkey * 53) % 400 AS DOUBLE) AS away_elo,
 CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 3 = 0 END AS conference_game,
 CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 9 = 1 END AS neutral_site,
 CASE WHEN o_orderkey % 4 <> 0 THEN CAST(1000 + (o_orderkey * 31) % 90000 AS DOUBLE) END AS attendance,
 'conf' || CAST(o_custkey % 40 % 6 AS VARCHAR(10)) AS home_conference,
 CASE WHEN o_orderkey % 17 <> 0
      THEN 'conf' || CAST((o_custkey % 40 + 1 + o_orderkey % 39) % 40 % 6 AS VARCHAR(10)) END AS away_conference
FROM orders"""

ODDS_V_SQL = """SELECT l_orderkey AS event_id,
 'book' || CAST(l_suppkey % 12 AS VARCHAR(10)) AS bookmaker,
 CASE l_returnflag WHEN 'A' THEN 'spreads' WHEN 'N' THEN 'h2h' ELSE 'totals' END AS market,
 CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'Over' ELSE 'Under' END
      WHEN l_linenumber % 2 = 0 THEN 'home' ELSE 'away' END AS outcome_name,
 CAST(100 + CAST(floor(l_extendedprice) AS BIGINT) % 200 AS DOUBLE) AS outcome_price,
 CASE WHEN l_returnflag = 'N' THEN NULL
      ELSE (CAST(floor(l_quantity) AS BIGINT) % 9 - 4) * CASE WHEN l_orderkey % 23 = 0 THEN 8 ELSE 1 END / CAST(2 AS DOUBLE)
 END AS outcome_point,
 l_shipdate AS last_update, l_linenumber AS line_no
FROM lineitem"""

PICKS_V_SQL = """SELECT d.source AS rule, l.quality AS won
FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""

CORRECTIONS_V_SQL = """SELECT id AS game_id, mode_spread + 3 AS verified_spread
FROM games_v WHERE id % 97 = 0 AND mode_spread IS NOT NULL"""

NAMES_V_SQL = "SELECT p_name AS name FROM part"

DICTIONARY_V_SQL = "SELECT DISTINCT split_part(p_name, ' ', 1) AS team FROM part"

QUOTES_V_SQL = """SELECT o.event_id, g.start_ts AS commence_time,
 CAST(g.home_team AS VARCHAR) AS home_team, CAST(g.away_team AS VARCHAR) AS away_team,
 o.bookmaker, o.market,
 CASE WHEN o.outcome_name = 'home' THEN CAST(g.home_team AS VARCHAR)
      WHEN o.outcome_name = 'away' THEN CAST(g.away_team AS VARCHAR)
      ELSE o.outcome_name END AS outcome_name,
 o.outcome_price, o.outcome_point, o.last_update, o.line_no
FROM odds_v o JOIN games_v g ON o.event_id = g.id"""

def with_views(sql: str, *views: str) -> str:
    """Prefix `sql` with the named fixture views as CTEs (oracle helper)."""
    defs = {
        "games_v": GAMES_V_SQL,
        "odds_v": ODDS_V_SQL,
        "picks_v": PICKS_V_SQL,
        "corrections_v": CORRECTIONS_V_SQL,
        "names_v": NAMES_V_SQL,
        "dictionary_v": DICTIONARY_V_SQL,
        "quotes_v": QUOTES_V_SQL,
    }
    deps = {"corrections_v": ["games_v"], "quotes_v": ["games_v", "odds_v"]}
    need: list[str] = []
    for v in views:
        for d in deps.get(v, []) + [v]:
            if d not in need:
                need.append(d)
    ctes = ",\n".join(f"{v} AS (\n{defs[v]}\n)" for v in need)
    body = sql.strip()
    if body[:5].upper() in ("WITH ", "WITH\n"):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
