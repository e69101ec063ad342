"""Consensus lines from flat bookmaker quotes.

The reference builds the consensus row from seven grouped branches and
seven LEFT JOINs on event_id.  Here it is two aggregates:

1. per (event, bookmaker): the surviving spread / total quote (deterministic
   de-duplication: latest by (last_update, price, point, line_no)), the
   book's best moneyline per side and which markets it quoted;
2. per event: mode of the per-book spread / total points (tie -> smallest),
   max moneylines, book counts; then the event's distinct attributes by join.

Both aggregates have a partial step, so an event with a huge number of quotes
is combined map-side; the second shuffle moves one row per (event, book).
Picking a survivor by a composite order and the mode are sort and object-hash
aggregates in Spark, not plain hash aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import mode_or_median, mode_value
from .joins import spread_out

ORDER = ("last_update", "outcome_price", "outcome_point", "line_no")


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER, latest: bool = True) -> DataFrame:
    """H4 `set_drop_duplicates`: one row per key, survivor = max (latest=True)
    or min of `order` - an aggregate, not a sort of the whole group."""
    others = [c for c in df.columns if c not in keys]
    pick = F.max_by if latest else F.min_by
    row = F.struct(*[F.col(c) for c in others])
    g = df.groupBy(*keys).agg(pick(row, _order_struct(order)).alias("_r"))
    return g.select(*keys, *[F.col("_r")[c].alias(c) for c in others])


def consensus(quotes: DataFrame, order: Sequence[str] = ORDER, home_col: str = "home_team",
              away_col: str = "away_team", name_col: str = "outcome_name") -> DataFrame:
    """J19 `odds_consensus`: one row per event (events without usable
    quotes kept), 11 columns.  Book counts are NULL (not 0) for a market
    the event has no quotes in, as the reference's LEFT JOINs give."""
    mk, nm = F.col("market"), F.col(name_col)
    is_spread = (mk == "spreads") & (nm == F.col(home_col))
    is_total = (mk == "totals") & (nm == "Over")
    ordk = _order_struct(order)
    # lines are a matter of the event alone; its attributes (several, if it was
    # rescheduled or renamed) are attached afterwards
    ev = ["event_id"]
    attributes = quotes.select("event_id", "commence_time", home_col, away_col).distinct()
    per_book = quotes.groupBy(*ev, "bookmaker").agg(
        F.max_by(F.when(is_spread, F.col("outcome_point")), F.when(is_spread, ordk)).alias("spread_pt"),
        F.max(F.when(is_spread, 1)).alias("has_spread"),
        F.max_by(F.when(is_total, F.col("outcome_point")), F.when(is_total, ordk)).alias("total_pt"),
        F.max(F.when(mk == "totals", 1)).alias("has_totals"),
        F.max(F.when(mk == "h2h", 1)).alias("has_h2h"),
        F.max(F.when((mk == "h2h") & (nm == F.col(home_col)), F.col("outcome_price"))).alias("home_ml"),
        F.max(F.when((mk == "h2h") & (nm == F.col(away_col)), F.col("outcome_price"))).alias("away_ml"),
    )
    out = per_book.groupBy(*ev).agg(
        mode_value(F.col("spread_pt")).alias("consensus_spread"),
        F.nullif(F.count("has_spread"), F.lit(0)).alias("spread_books"),
        F.max("home_ml").alias("consensus_home_ml"),
        F.max("away_ml").alias("consensus_away_ml"),
        F.nullif(F.count("has_h2h"), F.lit(0)).alias("h2h_books"),
        mode_value(F.col("total_pt")).alias("consensus_total"),
        F.nullif(F.count("has_totals"), F.lit(0)).alias("total_books"),
    )
    return attributes.join(out, "event_id").select("event_id", F.col("commence_time").alias("game_time"),
                      F.col(home_col).alias("home_team"), F.col(away_col).alias("away_team"),
                      "consensus_spread", "spread_books", "consensus_home_ml", "consensus_away_ml",
                      "h2h_books", "consensus_total", "total_books")


def quote_summary(cons: DataFrame) -> DataFrame:
    """N5 `qc_api_summary`: games, games with each market, mean books."""
    return cons.agg(
        F.count(F.lit(1)).alias("games"),
        F.count("consensus_spread").alias("games_with_spread"),
        F.count("consensus_home_ml").alias("games_with_h2h"),
        F.count("consensus_total").alias("games_with_total"),
        F.avg("spread_books").alias("avg_spread_books"),
        F.avg("h2h_books").alias("avg_h2h_books"),
        F.avg("total_books").alias("avg_total_books"))


def live_spread(quotes: DataFrame, teams: DataFrame, order: Sequence[str] = ("bookmaker", "line_no"),
                team_key: str = "team", abbr: str = "abbr", extra: Sequence[Column] = ()) -> DataFrame:
    """J21 `odds_live_spread`: per event, the away side's spread (mode, or
    median when all quotes differ; E9), the number of distinct books over
    all the event's quotes; unknown teams dropped (D15 inner lookup);
    events with no away-side spread quote dropped.  `extra` are more
    aggregates over all the event's quotes.  Events and lines are each spread
    over all shuffle partitions before they meet, so that no task holds the
    aggregates and the joins of one event range together."""
    t = teams.select(F.col(team_key).alias("_k"), F.col(abbr).alias("_abbr"))
    # one aggregate per event for its teams and book count (one pass)
    ev = quotes.groupBy("event_id").agg(F.min("home_team").alias("home_team"), F.min("away_team").alias("away_team"),
                                        F.count_distinct("bookmaker").alias("num_books"), *extra)
    more = [c for c in ev.columns if c not in ("event_id", "home_team", "away_team", "num_books")]
    ev = (ev.join(t.withColumnRenamed("_k", "home_team").withColumnRenamed("_abbr", "home_team_abbr"), "home_team")
            .join(t.withColumnRenamed("_k", "away_team").withColumnRenamed("_abbr", "away_team_abbr"), "away_team"))
    away_q = quotes.filter((F.col("market") == "spreads") & (F.col("outcome_name") == F.col("away_team")))
    line = mode_or_median(away_q, "event_id", "outcome_point", order, name="spread_line").drop("n_quotes")
    return (spread_out(ev, "event_id").join(spread_out(line, "event_id"), "event_id")
            .select("event_id", "away_team_abbr", "home_team_abbr", "away_team", "home_team",
                    "spread_line", "num_books", *more))
