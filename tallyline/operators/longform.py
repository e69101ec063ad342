"""One game row -> two team rows (home view, away view).

Done with a single `inline(array(struct, struct))` projection, so the game
table is scanned once (the reference's UNION ALL scans it twice).  The
output carries `id` and `side`, so features computed in long form can be
joined back to the game on (id, side) without fan-out when a team has two
games at the same timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDES = ("home", "away")


def _won(scored: Column, allowed: Column) -> Column:
    return (F.when(scored.isNull() | allowed.isNull(), F.lit(None).cast("int"))
            .when(scored > allowed, 1).otherwise(0))


def _beat(scored: Column, allowed: Column, spread: Column, home_sign: bool,
          mode: str) -> Column:
    """Cover test in the team's own perspective.

    compat    : margin > spread_from_team_view (what the reference computes,
                SURVEY Q1)
    corrected : margin + spread_from_team_view > 0 (negative = favoured)
    """
    margin = scored - allowed
    test = margin > spread if mode == "compat" else (margin + spread) > 0
    return (F.when(scored.isNull() | allowed.isNull() | spread.isNull(), F.lit(None).cast("int"))
            .when(test, 1).otherwise(0))


def side_struct(side: str, mode: str = "compat", extra: dict | None = None) -> Column:
    me, other = (("home", "away") if side == "home" else ("away", "home"))
    scored, allowed = F.col(f"{me}_points"), F.col(f"{other}_points")
    line = F.col("mode_spread") if side == "home" else F.lit(-1) * F.col("mode_spread")
    fields = [
        F.lit(side).alias("side"),
        F.col(f"{me}_team").alias("team"),
        F.col(f"{other}_team").alias("opponent"),
        scored.alias("points_scored"),
        allowed.alias("points_allowed"),
        _won(scored, allowed).alias("won"),
        F.abs(scored - allowed).alias("margin"),
        line.alias("spread"),
        _beat(scored, allowed, line, side == "home", mode).alias("beat_spread"),
    ]
    for name, (home_expr, away_expr) in (extra or {}).items():
        fields.append((home_expr if side == "home" else away_expr).alias(name))
    return F.struct(*fields)


def to_long(games: DataFrame, keep=("id", "season", "week", "start_ts"),
            mode: str = "compat", extra: dict | None = None) -> DataFrame:
    """H1 `set_unpivot_sides` / J2 `feat_team_games`.

    games needs id, season, week, start_ts, home/away_team, home/away_points,
    mode_spread.  Output: keep + side, team, opponent, points_scored,
    points_allowed, won, margin (unsigned, Q6), spread (team view),
    beat_spread.
    """
    return games.select(*keep, F.inline(F.array(side_struct("home", mode, extra),
                                                  side_struct("away", mode, extra))))


def pivot_sides(long: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Long (key, side, cols...) -> one row per key with home_/away_ columns.

    A single hash aggregate on `key` (partial aggregation map-side)."""
    aggs = []
    for s in SIDES:
        for c in cols:
            aggs.append(F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{s}_{c}"))
    return long.groupBy(key).agg(*aggs)
