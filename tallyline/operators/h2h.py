"""Head-to-head history of a pairing over prior seasons.

The reference writes this as a self LEFT JOIN with an OR of two pair
matches plus a season range, which Spark can only plan as a nested loop
join, and whose output grows with meetings^2.  Here the pairing is made
an unordered key (least, greatest) and every quantity the features need
is additive, so:

1. one partial+final aggregate per (pair, season)   - map-side combine, a
   hot pairing collapses to one row per season before the shuffle;
2. a RANGE window over seasons [s-lookback, s-1] on that small table;
3. an equi-join back to the games on (pair, season) - one row per key,
   so no fan-out; AQE may turn it into a broadcast at run time (checked
   size) and splits skewed game partitions.

No pair of games is ever materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _pair_cols(games: DataFrame) -> DataFrame:
    return games.withColumns({
        "pair_lo": F.least("home_team", "away_team"),
        "pair_hi": F.greatest("home_team", "away_team"),
    })


def pair_season_totals(games: DataFrame) -> DataFrame:
    """Per (pair, season): meetings, wins of each member, margin sum/count
    from the lower member's view."""
    g = _pair_cols(games)
    hp, ap = F.col("home_points"), F.col("away_points")
    lo_home = F.col("home_team") == F.col("pair_lo")
    lo_margin = F.when(lo_home, hp - ap).otherwise(ap - hp)
    lo_won = (lo_home & (hp > ap)) | (~lo_home & (ap > hp))
    hi_won = (~lo_home & (hp > ap)) | (lo_home & (ap > hp))
    return g.groupBy("pair_lo", "pair_hi", "season").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(lo_won, 1).otherwise(0)).alias("wins_lo"),
        F.sum(F.when(hi_won, 1).otherwise(0)).alias("wins_hi"),
        F.sum(lo_margin).alias("msum_lo"),
        F.count(lo_margin).alias("mcnt"),
    )


def prior_totals(games: DataFrame, lookback: int = 3) -> DataFrame:
    """Totals over seasons [s - lookback, s - 1] for each (pair, season)."""
    w = (Window.partitionBy("pair_lo", "pair_hi").orderBy("season")
         .rangeBetween(-lookback, -1))
    t = pair_season_totals(games)
    return t.select(
        "pair_lo", "pair_hi", "season",
        *[F.sum(c).over(w).alias(f"p_{c}") for c in ("n", "wins_lo", "wins_hi", "msum_lo", "mcnt")],
    )


def h2h(games: DataFrame, lookback: int = 3) -> DataFrame:
    """E17 `agg_h2h`: per game id -> h2h_games, home_h2h_win_rate,
    home_h2h_avg_margin (raw, before the J6 defaults).

    Q3 compat: with no prior meeting the reference's LEFT JOIN yields one
    NULL row whose CASE ... ELSE 0 averages to 0.0, so the win rate is 0.0
    (never NULL); unscored meetings count as non-wins; the margin average
    ignores them and is NULL without scored meetings.
    """
    g = _pair_cols(games).select("id", "season", "home_team", "pair_lo", "pair_hi")
    p = prior_totals(games, lookback)
    j = g.join(p, ["pair_lo", "pair_hi", "season"], "left")
    n = F.coalesce(F.col("p_n"), F.lit(0))
    home_is_lo = F.col("home_team") == F.col("pair_lo")
    wins = F.when(home_is_lo, F.col("p_wins_lo")).otherwise(F.col("p_wins_hi"))
    msum = F.when(home_is_lo, F.col("p_msum_lo")).otherwise(-F.col("p_msum_lo"))
    return j.select(
        "id",
        n.cast("bigint").alias("h2h_games"),
        F.when(n > 0, wins / n).otherwise(F.lit(0.0)).alias("home_h2h_win_rate"),
        (msum / F.nullif(F.col("p_mcnt"), F.lit(0))).alias("home_h2h_avg_margin"),
    )


def prior_meetings(games: DataFrame, lookback: int = 3) -> DataFrame:
    """D4 `join_h2h_theta` in aggregated form: per game, number of prior
    meetings of the two teams in either venue within the season range."""
    return h2h(games, lookback).select("id", "h2h_games")


def h2h_features(games: DataFrame, lookback: int = 3) -> DataFrame:
    """J6 `feat_h2h`: E17 plus the reference's COALESCE defaults."""
    return h2h(games, lookback).select(
        "id",
        F.col("h2h_games").alias("h2h_games_count"),
        F.coalesce("home_h2h_win_rate", F.lit(0.5)).alias("home_h2h_win_rate"),
        F.coalesce("home_h2h_avg_margin", F.lit(0.0)).alias("home_h2h_avg_margin"),
    )
