"""Grading results against the line (pro-league
conventions: `spread_line` > 0 means the home side is favoured, so home
covers when home_score - spread_line > away_score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .mutation import update


# Fixed value: an edge smaller than this is a push.
PUSH = 0.01


def edge() -> Column:
    """Points by which the home side beats the line; NULL without both scores and a line."""
    return F.col("home_score") - F.col("spread_line") - F.col("away_score")


def _by_sign(value: Column, below: str, even: str, above: str) -> Column:
    """A label for the sign of `value`, NULL for NULL."""
    return F.get(F.array(F.lit(below), F.lit(even), F.lit(above)), F.sign(value).cast("int") + 1)


def _pushed(value: Column, tol: float) -> Column:
    """`value`, 0 where it is a push."""
    return F.when(F.abs(value) < tol, F.lit(0.0)).otherwise(value)


def grade_scores(games: DataFrame, tol: float = PUSH) -> DataFrame:
    """J10 `feat_result_nfl`: differential, total, and the results of the game,
    against the line (a push within tol) and against the total, of the games
    that have both scores; other rows keep their old values."""
    difference, total = F.col("home_score") - F.col("away_score"), F.col("home_score") + F.col("away_score")
    return update(games, difference.isNotNull(), {
        "point_differential": difference, "total_points": total,
        "game_result": _by_sign(difference, "away_win", "tie", "home_win"),
        "spread_result": _by_sign(_pushed(edge(), tol), "away_covered", "push", "home_covered"),
        "over_under_result": _by_sign(total - F.col("total_line"), "under", "push", "over")})


def ats_columns(tol: float = PUSH) -> dict[str, Column]:
    """J11 `feat_ats_nfl` expressions (over source columns).  The two labels
    differ for an edge between 0 and tol: in `cover` any positive edge is HOME
    (and only a negative one within tol a PUSH), in `ats_result` it is a PUSH."""
    by = edge()
    positive_first = _by_sign(F.when(by > -tol, F.greatest(by, F.lit(0.0))).otherwise(by), "AWAY", "PUSH", "HOME")
    return {"home_covered": (by > 0).cast("int"), "cover": positive_first,
            "ats_result": _by_sign(_pushed(by, tol), "AWAY_COVERED", "PUSH", "HOME_COVERED")}


def grade_ats(games: DataFrame, tol: float = PUSH) -> DataFrame:
    return games.withColumns(ats_columns(tol))


def line_movement(df: DataFrame, opening: str = "opening_spread", closing: str = "spread_line") -> DataFrame:
    """J22 `line_movement`: movement = closing - opening; home/away open and
    close lines as -/+ of the away-perspective numbers."""
    o, c = F.col(opening), F.col(closing)
    return df.withColumns({
        "line_movement": c - o,
        "home_line_open": -o, "away_line_open": o,
        "home_line_close": -c, "away_line_close": c,
    })
