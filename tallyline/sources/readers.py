"""A1-A10: sources.

Every reader takes an explicit schema (no inference pass over the data)
and returns a typed DataFrame.  Fetching from web APIs is out of scope:
landing files (JSON lines, CSV, stored pages) are the interface.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import parse_iso, parse_list

# ---------------------------------------------------------------- schemas

GAME_FLAGS = ("startTimeTBD", "completed", "neutralSite", "conferenceGame")

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _f(name, t):
    return T.StructField(name, t, True)


# Fixed values, down to NFL_CSV: the feeds' own keys and columns, in their order.
# Game record as the feed delivers it (raw JSON keys, numbers may be text).
GAME_JSON = T.StructType(
    [_f("id", _L), _f("season", _L), _f("week", _L), _f("seasonType", _S), _f("startDate", _S)]
    + [_f(c, _B) for c in GAME_FLAGS]
    + [_f("attendance", _S), _f("venueId", _S), _f("venue", _S)]
    + [f for side in ("home", "away") for f in (
        _f(f"{side}Id", _L), _f(f"{side}Team", _S), _f(f"{side}Classification", _S),
        _f(f"{side}Conference", _S), _f(f"{side}Points", _S), _f(f"{side}LineScores", T.ArrayType(_S)),
        _f(f"{side}PostgameWinProbability", _S), _f(f"{side}PregameElo", _S), _f(f"{side}PostgameElo", _S))]
    + [_f("excitementIndex", _S), _f("highlights", _S), _f("notes", _S)]
)

LINE = T.StructType([_f("provider", _S), _f("spread", _S), _f("spreadOpen", _S)])
LINES = T.ArrayType(LINE)
LINES_DOC = T.StructType([_f("id", _L), _f("homeScore", _D), _f("awayScore", _D), _f("lines", LINES)])

OUTCOME = T.StructType([_f("name", _S), _f("price", _D), _f("point", _D)])
MARKET = T.StructType([_f("key", _S), _f("last_update", _S), _f("outcomes", T.ArrayType(OUTCOME))])
BOOK = T.StructType([_f("key", _S), _f("title", _S), _f("last_update", _S), _f("markets", T.ArrayType(MARKET))])
ODDS_DOC = T.StructType([_f("id", _S), _f("commence_time", _S), _f("home_team", _S), _f("away_team", _S),
                         _f("bookmakers", T.ArrayType(BOOK))])

# Flat quote table (explicit StructType, 10 columns).
ODDS_RAW = T.StructType([
    _f("event_id", _S), _f("commence_time", T.TimestampType()), _f("home_team", _S), _f("away_team", _S),
    _f("bookmaker", _S), _f("market", _S), _f("outcome_name", _S), _f("outcome_price", _D),
    _f("outcome_point", _D), _f("last_update", T.TimestampType())])

NFL_CSV_COLUMNS = [
    "game_id", "season", "game_type", "week", "gameday", "weekday", "gametime",
    "away_team", "away_score", "home_team", "home_score",
    "spread_line", "away_spread_odds", "home_spread_odds",
    "total_line", "over_odds", "under_odds", "away_moneyline", "home_moneyline",
    "location", "result", "total", "overtime", "div_game", "roof", "surface", "temp", "wind",
    "away_qb_name", "home_qb_name", "stadium"]
_NFL_INT = {"season", "week", "away_score", "home_score", "result", "total", "overtime", "div_game"}
_NFL_DBL = {"spread_line", "away_spread_odds", "home_spread_odds", "total_line", "over_odds", "under_odds",
            "away_moneyline", "home_moneyline", "temp", "wind"}
NFL_CSV = T.StructType([
    _f(c, T.IntegerType() if c in _NFL_INT else _D if c in _NFL_DBL else _S) for c in NFL_CSV_COLUMNS])


# ---------------------------------------------------------------- A1 games

def _json_list_text(arr: Column) -> Column:
    """Numeric list -> JSON text in the stored format ('[7, 3, 0, 14]':
    comma + space separators); an empty or missing list -> NULL."""
    return F.when(F.size(arr) > 0, F.concat(F.lit("["), F.array_join(arr, ", "), F.lit("]")))


def conform_games(raw: DataFrame) -> DataFrame:
    """C4 `proj_conform` + C5: raw game records -> the 39-column fact schema.
    Flags default to false; numbers arriving as text are safe-cast (bad ->
    NULL); ids are duplicated into homeTeamId/awayTeamId and points into
    homeScore/awayScore; highlights forced to NULL; line scores kept as
    JSON text; mode spreads start NULL (filled by the lines job)."""
    dbl = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).try_cast("double")
    cols = [F.col("id").cast("bigint").alias("id"), F.col("season").cast("bigint").alias("season"),
            F.col("week").cast("bigint").alias("week"), F.col("seasonType"), F.col("startDate")]
    cols += [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in GAME_FLAGS]
    cols += [dbl("attendance").alias("attendance"), dbl("venueId").alias("venueId"), F.col("venue")]
    for s in ("home", "away"):
        cols += [F.col(f"{s}Id").cast("bigint").alias(f"{s}Id"), F.col(f"{s}Team"),
                 F.col(f"{s}Classification"), F.col(f"{s}Conference"), dbl(f"{s}Points").alias(f"{s}Points"),
                 _json_list_text(F.col(f"{s}LineScores")).alias(f"{s}LineScores"),
                 dbl(f"{s}PostgameWinProbability").alias(f"{s}PostgameWinProbability"),
                 dbl(f"{s}PregameElo").alias(f"{s}PregameElo"), dbl(f"{s}PostgameElo").alias(f"{s}PostgameElo")]
    cols += [dbl("excitementIndex").alias("excitementIndex"), F.lit(None).cast("double").alias("highlights"),
             F.col("notes"),
             F.col("homeId").cast("bigint").alias("homeTeamId"), F.col("awayId").cast("bigint").alias("awayTeamId"),
             dbl("homePoints").alias("homeScore"), dbl("awayPoints").alias("awayScore"),
             F.lit(None).cast("double").alias("mode_spread"), F.lit(None).cast("double").alias("mode_spread_open")]
    return raw.select(*cols)


def read_games(spark: SparkSession, path: str | Sequence[str], seasons: Iterable[int] | None = None) -> DataFrame:
    """A1 `src_games_json`: JSON-lines game records -> 39-column schema."""
    raw = spark.read.schema(GAME_JSON).json(path)
    if seasons is not None:
        raw = raw.filter(F.col("season").isin(list(seasons)))
    return conform_games(raw)


def parse_games(text: DataFrame, col: str = "value", seasons: Iterable[int] | None = None) -> DataFrame:
    """A1 over a column of JSON text (e.g. a landing table or a stream)."""
    raw = text.select(F.from_json(F.col(col), GAME_JSON).alias("g")).select("g.*")
    if seasons is not None:
        raw = raw.filter(F.col("season").isin(list(seasons)))
    return conform_games(raw)


# ---------------------------------------------------------------- A2 nested lines

def parse_lines(text: DataFrame, col: str = "lines", key: str = "id") -> DataFrame:
    """A2 `src_lines_nested`: lines text (JSON or Python-literal) -> typed
    array<struct<provider, spread, spreadOpen>>."""
    return text.select(F.col(key), parse_list(F.col(col), LINES).alias("lines"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A2 from JSON-lines files with a nested `lines` array."""
    return spark.read.schema(LINES_DOC).json(path)


def explode_lines(games: DataFrame, key: str = "id") -> DataFrame:
    """Nested lines -> flat (key, pos, provider, spread, spread_open) with the
    list position kept (for 'first listed' rules) and values safe-cast."""
    e = games.select(F.col(key), F.posexplode("lines").alias("pos", "l"))
    return e.select(key, "pos", F.col("l.provider").alias("provider"),
                    F.col("l.spread").try_cast("double").alias("spread"),
                    F.col("l.spreadOpen").try_cast("double").alias("spread_open"))


# ---------------------------------------------------------------- A3 odds documents

def flatten_odds(docs: DataFrame) -> DataFrame:
    """A3 `src_odds_flatten`: event -> bookmakers[] -> markets[] -> outcomes[]
    to the 10-column quote table.  Inner explodes drop books without
    markets and markets without outcomes (as nested loops do); the market
    last_update falls back to the book's; missing outcome name -> ''."""
    b = docs.select("id", "commence_time", "home_team", "away_team", F.explode("bookmakers").alias("b"))
    m = b.select("*", F.explode("b.markets").alias("m"))
    o = m.select("*", F.explode("m.outcomes").alias("o"))
    return o.select(
        F.col("id").alias("event_id"),
        parse_iso(F.col("commence_time")).alias("commence_time"),
        "home_team", "away_team",
        F.col("b.title").alias("bookmaker"),
        F.col("m.key").alias("market"),
        F.coalesce(F.col("o.name"), F.lit("")).alias("outcome_name"),
        F.col("o.price").cast("double").alias("outcome_price"),
        F.col("o.point").cast("double").alias("outcome_point"),
        parse_iso(F.coalesce(F.col("m.last_update"), F.col("b.last_update"))).alias("last_update"))


def read_odds(spark: SparkSession, path: str) -> DataFrame:
    return flatten_odds(spark.read.schema(ODDS_DOC).json(path))


# ---------------------------------------------------------------- A4 CSV

def filter_nfl(df: DataFrame, first_season: int = 2015,
               game_types: Sequence[str] = ("REG", "WC", "DIV", "CON", "SB")) -> DataFrame:
    return df.filter((F.col("season") >= first_season) & F.col("game_type").isin(list(game_types))) \
             .select(*NFL_CSV_COLUMNS)


def read_games_csv(spark: SparkSession, path: str, first_season: int = 2015,
                   game_types: Sequence[str] = ("REG", "WC", "DIV", "CON", "SB")) -> DataFrame:
    """A4 `src_csv_games`: header CSV with explicit schema, season and game
    type filter (pushed to the scan), 31 projected columns."""
    df = spark.read.schema(NFL_CSV).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return filter_nfl(df, first_season, game_types)


def parse_csv_lines(text: DataFrame, schema: T.StructType = NFL_CSV, col: str = "value") -> DataFrame:
    """A4 over a column of CSV lines (header lines removed by the caller)."""
    return text.select(F.from_csv(F.col(col), schema.simpleString()).alias("r")).select("r.*")


# ---------------------------------------------------------------- A5 pages

def read_pages(spark: SparkSession, path: str, parquet: bool = True) -> DataFrame:
    """A5 `src_html_pages`: stored pages as (page_id, url, html).  Parquet
    landing tables are read directly; raw files one page per file."""
    if parquet:
        return spark.read.parquet(path).select("page_id", "url", "html")
    t = spark.read.option("wholetext", True).text(path)
    return t.select(F.monotonically_increasing_id().alias("page_id"),
                    F.input_file_name().alias("url"), F.col("value").alias("html"))


# ---------------------------------------------------------------- A6-A10

def table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A6 `src_table_scan`: catalog table name, or a parquet path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def incremental(df: DataFrame, ts: str, as_of, lookback_days: int = 7) -> DataFrame:
    """A8 `src_incremental_cutoff`: rows with ts >= as_of - lookback (the past
    week for late corrections, plus everything later).  A bare-column
    predicate, so it reaches the Parquet scan / partition filter."""
    a = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    return df.filter(F.col(ts) >= F.date_sub(a, lookback_days).cast("timestamp_ntz")
                     if dict(df.dtypes).get(ts) == "timestamp_ntz"
                     else F.col(ts) >= F.date_sub(a, lookback_days))


def seasons_to_scan(as_of, lookback_days: int = 7) -> list[int]:
    """The seasons (years) touched by [as_of - lookback, as_of]."""
    import datetime as _dt
    d = _dt.date.fromisoformat(str(as_of))
    lo = d - _dt.timedelta(days=lookback_days)
    return sorted({lo.year, d.year})


def union_seasons(dfs: Iterable[DataFrame]) -> DataFrame | None:
    """A9 `src_multi_season_union`: concatenate per-season pulls by name;
    empty/None pulls are skipped (no count() job is spent finding them:
    an empty DataFrame contributes no rows)."""
    out = None
    for d in dfs:
        if d is None:
            continue
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def register(df: DataFrame, name: str) -> DataFrame:
    """A10 `src_temp_view`."""
    df.createOrReplaceTempView(name)
    return df
