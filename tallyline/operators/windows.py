"""Per-team time-series features as window functions.

All specs here partition on `team` first, so Spark plans ONE hash exchange
on `team` for any mix of (team), (team, season), (team, side, season)
partitionings (hash(team) satisfies the clustering of each); each distinct
spec adds a sort, not a shuffle.  Order is always (ts, id): the reference
orders by time only, which makes ROWS frames non-deterministic on ties (Q9).

Frames are ROWS frames, so the window operator streams the sorted
partition and spills through Spark's external row buffer, but a partition is
one task.  The registered queries and the feature table use the split plan of
`operators.buckets`; these are the plain building blocks, and its yardstick in
the tests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = ("start_ts", "id")
UNB = Window.unboundedPreceding


def spec(by: Sequence[str], order: Sequence[str] = ORDER):
    return Window.partitionBy(*by).orderBy(*order)


def rolling_exprs(cols: Sequence[str], n: int, by: Sequence[str], suffix: str,
                  order: Sequence[str] = ORDER, names: dict | None = None) -> list[Column]:
    """AVG over the previous n rows, current row excluded."""
    w = spec(by, order).rowsBetween(-n, -1)
    names = names or {}
    return [F.avg(c).over(w).alias(names.get(c, f"{c}{suffix}")) for c in cols]


def rolling(long: DataFrame, cols: Sequence[str], n: int = 5,
            by: Sequence[str] = ("team", "season"), suffix: str | None = None) -> DataFrame:
    suffix = suffix or f"_l{n}"
    return long.select("*", *rolling_exprs(cols, n, by, suffix))


def expanding_exprs(cols: Sequence[str], by: Sequence[str], prefix: str = "season_avg_",
                    order: Sequence[str] = ORDER, names: dict | None = None) -> list[Column]:
    """AVG over all earlier rows of the partition."""
    w = spec(by, order).rowsBetween(UNB, -1)
    names = names or {}
    return [F.avg(c).over(w).alias(names.get(c, f"{prefix}{c}")) for c in cols]


def expanding(long: DataFrame, cols: Sequence[str], by: Sequence[str] = ("team", "season")) -> DataFrame:
    return long.select("*", *expanding_exprs(cols, by))


def rolling_sum_flag(flag: Column, n: int, by: Sequence[str], name: str,
                     order: Sequence[str] = ORDER) -> Column:
    """SUM(CASE WHEN flag = 1 THEN 1 ELSE 0 END) over previous n rows."""
    w = spec(by, order).rowsBetween(-n, -1)
    return F.sum(F.when(flag == 1, 1).otherwise(0)).over(w).alias(name)


def rolling_null_count(cols: Sequence[str], n: int, by: Sequence[str], name: str,
                       order: Sequence[str] = ORDER) -> Column:
    """number of earlier rows in the frame where any of `cols` is NULL."""
    w = spec(by, order).rowsBetween(-n, -1)
    anynull = None
    for c in cols:
        anynull = F.col(c).isNull() if anynull is None else (anynull | F.col(c).isNull())
    return F.count(F.when(anynull, 1)).over(w).alias(name)


def games_before(by: Sequence[str], name: str = "games_played",
                 order: Sequence[str] = ORDER) -> Column:
    """F8: COUNT(*) of earlier rows (unscored games included); first row 0."""
    w = spec(by, order).rowsBetween(UNB, -1)
    return F.count(F.lit(1)).over(w).alias(name)


def lag_days(ts: str, by: Sequence[str], name: str, order: Sequence[str] = ORDER) -> Column:
    """days since the previous row of the partition (NULL for the first)."""
    w = spec(by, order)
    return F.datediff(F.col(ts), F.lag(ts, 1).over(w)).alias(name)


def rest_days(long: DataFrame, default: int | None = None) -> DataFrame:
    """F1 `win_lag_rest_days` on the long form: days since the team's previous
    game on the same side (home after home, away after away) in the season
    (Q4, compat).  `default` replaces the first game's NULL (reference: 7)."""
    c = lag_days("start_ts", ("team", "side", "season"), "rest_days")
    if default is not None:
        c = F.coalesce(c, F.lit(default)).alias("rest_days")
    return long.select("*", c)


def cumulative_incl(col: str, by: Sequence[str], avg_name: str, count_name: str,
                    order: Sequence[str] = ORDER) -> list[Column]:
    """running AVG and COUNT of `col` up to and including the current row."""
    w = spec(by, order).rowsBetween(UNB, Window.currentRow)
    return [F.avg(col).over(w).alias(avg_name), F.count(col).over(w).alias(count_name)]


def leave_one_out_exprs(by: Sequence[str] = ("team", "side", "season"),
                        scored: str = "points_scored", allowed: str = "points_allowed",
                        prefix: str = "") -> list[Column]:
    """partition SUM/COUNT minus the own row (whole partition, so later
    games are seen: Q2 compat).  avg_points, avg_allowed, win_rate."""
    p = Window.partitionBy(*by)
    s, a = F.col(scored), F.col(allowed)
    own_s = F.when(s.isNotNull(), 1).otherwise(0)
    own_a = F.when(a.isNotNull(), 1).otherwise(0)
    win = F.when(s > a, 1).otherwise(0)
    n_s = F.count(s).over(p) - own_s
    n_a = F.count(a).over(p) - own_a
    return [
        ((F.sum(s).over(p) - F.coalesce(s, F.lit(0))) / F.nullif(n_s, F.lit(0))).alias(f"{prefix}avg_points"),
        ((F.sum(a).over(p) - F.coalesce(a, F.lit(0))) / F.nullif(n_a, F.lit(0))).alias(f"{prefix}avg_allowed"),
        ((F.sum(win).over(p) - win) / F.nullif(n_s, F.lit(0))).alias(f"{prefix}win_rate"),
    ]


def leave_one_out(long: DataFrame, by: Sequence[str] = ("team", "side", "season")) -> DataFrame:
    return long.select("*", *leave_one_out_exprs(by))


def leave_one_out_corrected(long: DataFrame, by: Sequence[str] = ("team", "side", "season")) -> DataFrame:
    """Q2 corrected: location averages over EARLIER games only."""
    w = spec(by).rowsBetween(UNB, -1)
    s, a = F.col("points_scored"), F.col("points_allowed")
    return long.select(
        "*",
        F.avg(s).over(w).alias("avg_points"),
        F.avg(a).over(w).alias("avg_allowed"),
        (F.sum(F.when(s > a, 1).otherwise(0)).over(w) / F.nullif(F.count(s).over(w), F.lit(0))).alias("win_rate"),
    )


ROLL5 = ("points_scored", "points_allowed", "margin", "won", "beat_spread")
ROLL5_NAMES = {"points_scored": "avg_points", "points_allowed": "avg_allowed",
               "margin": "avg_margin", "won": "win_pct", "beat_spread": "ats_pct"}


def team_rolling_exprs() -> list[Column]:
    """J3 `feat_team_rolling`: F2-F8 for one long-form row.

    The carry-over (team-only) window is ordered by (season, ts, id): the
    same rows in the same order as (ts, id) because a team's seasons do not
    interleave in time, and it lets Spark serve both the (team) and the
    (team, season) specs from ONE sort of the partition."""
    ts, t = ("team", "season"), ("team",)
    out = []
    out += rolling_exprs(ROLL5, 5, ts, "", names={c: f"{v}_l5" for c, v in ROLL5_NAMES.items()})
    out += rolling_exprs(ROLL5, 5, t, "", order=("season",) + ORDER,
                         names={c: f"{v}_l5_carryover" for c, v in ROLL5_NAMES.items()})
    out += rolling_exprs(("points_scored", "won"), 3, ts, "",
                         names={"points_scored": "avg_points_l3", "won": "win_pct_l3"})
    out += expanding_exprs(("points_scored", "points_allowed", "won"), ts,
                           names={"points_scored": "season_avg_points",
                                  "points_allowed": "season_avg_allowed",
                                  "won": "season_win_pct"})
    out.append(rolling_sum_flag(F.col("won"), 3, ts, "wins_l3"))
    out.append(rolling_null_count(("points_scored", "points_allowed"), 3, ts,
                                  "unscored_games_in_l3_window"))
    out.append(games_before(ts, "games_played"))
    return out


def team_rolling(long: DataFrame) -> DataFrame:
    return long.select("*", *team_rolling_exprs())


TEAM_ROLLING_COLS = (
    [f"{v}_l5" for v in ROLL5_NAMES.values()]
    + [f"{v}_l5_carryover" for v in ROLL5_NAMES.values()]
    + ["avg_points_l3", "win_pct_l3", "season_avg_points", "season_avg_allowed",
       "season_win_pct", "wins_l3", "unscored_games_in_l3_window", "games_played"]
)
