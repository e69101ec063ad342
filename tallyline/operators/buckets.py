"""Team features in which no window holds more than one team's games of one time bucket.

A team's schedule is cut into buckets of BUCKET_DAYS days, for every team
alike.  One aggregate per (team, season, bucket) gives its totals and its last
LOOKBACK rows; a window over those short rows (one per bucket) says what a
bucket needs from the ones before it:

* at most LOOKBACK earlier rows of the team, which join the bucket as context
  for the ROWS k PRECEDING frames;
* one opening row with the totals of the season's earlier buckets, which the
  running sums start from.

Context and opening rows are unioned with the bucket's own games, the frames
run per (team, season, bucket), and the added rows are filtered out.  So a team
that plays nine of ten games is spread over as many tasks as it has buckets.
Leave-one-out figures are totals less the own row; the opening row brings them too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import ROLL5, ROLL5_NAMES, UNB

BUCKET_DAYS, LOOKBACK = 28, 5
PART = ("team", "season", "bucket")
ORDER = ("start_ts", "id")
EXPANDING = {"points_scored": "season_avg_points", "points_allowed": "season_avg_allowed", "won": "season_win_pct"}


def with_bucket(df: DataFrame, days: int = BUCKET_DAYS) -> DataFrame:
    at = F.floor(F.datediff(F.to_date("start_ts"), F.lit("1970-01-01").cast("date")) / F.lit(days))
    return df.withColumn("bucket", F.coalesce(at, F.lit(-(1 << 31))))


def _before_season(c: str) -> Column:
    """Total of the season's earlier buckets (one row per bucket in the window)."""
    w = Window.partitionBy("team", "season").orderBy("bucket").rowsBetween(UNB, -1)
    return F.coalesce(F.sum(c).over(w), F.lit(0))


def _location_totals() -> dict[str, Column]:
    """F10's sums of a group of rows, by side: what leave_one_out() needs of the whole season."""
    s, a = F.col("points_scored"), F.col("points_allowed")
    made = {}
    for side in ("home", "away"):
        on = lambda c: F.when(F.col("side") == side, c)  # noqa: B023, E731
        made |= {f"{side}_s": F.sum(on(s)), f"{side}_ns": F.count(on(s)), f"{side}_a": F.sum(on(a)),
                 f"{side}_na": F.count(on(a)), f"{side}_w": F.sum(on(F.when(s > a, 1).otherwise(0)))}
    return made


def _others(total: Column, n: Column, own: Column) -> Column:
    """Mean over the other rows of a group, from the group's total and count."""
    return (total - F.coalesce(own, F.lit(0))) / F.nullif(n - F.when(own.isNotNull(), 1).otherwise(0), F.lit(0))


def _rolling_rows(long: DataFrame) -> DataFrame:
    """Own, context and opening rows of every bucket; `kind` orders them 0 opening, 1 context, 2 own."""
    last = F.row_number().over(Window.partitionBy(*PART).orderBy(*(F.desc(c) for c in ORDER)))
    row = F.struct(*ORDER, F.col("season").alias("row_season"), *ROLL5)
    flag = lambda c: F.when(F.col(c).isNotNull(), 1).otherwise(0)
    per = long.withColumn("_last", last).groupBy(*PART).agg(
        F.sort_array(F.collect_list(F.when(F.col("_last") <= LOOKBACK, row))).alias("tail"),
        F.count("*").alias("rows"), *(F.sum(F.coalesce(c, F.lit(0))).alias(f"sum_{c}") for c in EXPANDING),
        *(F.count(c).alias(f"cnt_{c}") for c in EXPANDING),
        *(F.max(F.when(F.col("side") == s, F.col("start_ts"))).alias(f"last_{s}") for s in ("home", "away")),
        *(c.alias(n) for n, c in _location_totals().items()))
    near = Window.partitionBy("team").orderBy("season", "bucket").rowsBetween(-LOOKBACK, -1)
    season = Window.partitionBy("team", "season").orderBy("bucket").rowsBetween(UNB, -1)
    sums = ["rows", *(f"{k}_{c}" for k in ("sum", "cnt") for c in EXPANDING)]
    ahead = per.select(
        *PART, F.flatten(F.collect_list("tail").over(near)).alias("tails"),
        *(_before_season(c).alias(c) for c in sums),
        *(F.max(f"last_{s}").over(season).alias(f"last_{s}") for s in ("home", "away")),
        *(F.sum(n).over(Window.partitionBy("team", "season")).alias(n) for n in _location_totals()))
    context = ahead.select(*PART, F.explode(F.slice(
        "tails", F.greatest(F.size("tails") - LOOKBACK + 1, F.lit(1)), LOOKBACK)).alias("t")) \
        .select(*PART, F.lit(1).alias("kind"), "t.*")
    opening = ahead.select(*PART, F.lit(0).alias("kind"), *sums, "last_home", "last_away", *_location_totals())
    own = long.select(
        *PART, F.lit(2).alias("kind"), *ORDER, F.col("season").alias("row_season"), *ROLL5, "side",
        F.lit(1).alias("rows"), *(F.coalesce(c, F.lit(0)).alias(f"sum_{c}") for c in EXPANDING),
        *(flag(c).alias(f"cnt_{c}") for c in EXPANDING),
        *(F.when(F.col("side") == s, F.col("start_ts")).alias(f"last_{s}") for s in ("home", "away")))
    return own.unionByName(context, allowMissingColumns=True).unionByName(opening, allowMissingColumns=True)


def team_rolling(long: DataFrame, days: int = BUCKET_DAYS) -> DataFrame:
    """(id, side, team, season, rest_days, features F2-F8): one row per long-form row."""
    return team_figures(long, days).drop("located", "avg_points", "avg_allowed", "win_rate")


def team_figures(long: DataFrame, days: int = BUCKET_DAYS) -> DataFrame:
    """(id, side, team, season, rest_days, features F2-F8, F10): one row per long-form row.

    `located` says that the row has a team and a season; F10 is NULL without."""
    rows = _rolling_rows(with_bucket(long, days))
    order = Window.partitionBy(*PART).orderBy("kind", "row_season", *ORDER)
    frame = lambda n: order.rowsBetween(-n, -1)
    sofar = order.rowsBetween(UNB, -1)
    same = F.col("row_season") == F.col("season")
    of_season = lambda c: F.when(same, F.col(c))
    unscored = F.col("points_scored").isNull() | F.col("points_allowed").isNull()
    previous = F.when(F.col("side") == "home", F.max("last_home").over(sofar)).otherwise(F.max("last_away").over(sofar))
    total = lambda c: F.sum(c).over(sofar)
    located = F.col("team").isNotNull() & F.col("season").isNotNull()
    here = lambda n: F.when(F.col("side") == "home", F.first(f"home_{n}").over(sofar)).otherwise(
        F.first(f"away_{n}").over(sofar))                    # of the opening row, which comes first
    s, a = F.col("points_scored"), F.col("points_allowed")
    own_win = F.when(s > a, 1).otherwise(0)
    n_s = F.nullif(here("ns") - F.when(s.isNotNull(), 1).otherwise(0), F.lit(0))
    return rows.select(
        *PART, "kind", "id", "side",
        F.datediff("start_ts", previous).alias("rest_days"),
        *(F.avg(of_season(c)).over(frame(5)).alias(f"{n}_l5") for c, n in ROLL5_NAMES.items()),
        *(F.avg(c).over(frame(5)).alias(f"{n}_l5_carryover") for c, n in ROLL5_NAMES.items()),
        F.avg(of_season("points_scored")).over(frame(3)).alias("avg_points_l3"),
        F.avg(of_season("won")).over(frame(3)).alias("win_pct_l3"),
        *(F.when(total(f"cnt_{c}") > 0, total(f"sum_{c}") / total(f"cnt_{c}")).alias(n) for c, n in EXPANDING.items()),
        F.sum(F.when(same, F.when(F.col("won") == 1, 1).otherwise(0))).over(frame(3)).alias("wins_l3"),
        F.count(F.when(same & unscored, 1)).over(frame(3)).alias("unscored_games_in_l3_window"),
        total("rows").alias("games_played"),
        located.alias("located"),
        F.when(located, _others(here("s"), here("ns"), s)).alias("avg_points"),
        F.when(located, _others(here("a"), here("na"), a)).alias("avg_allowed"),
        F.when(located, (here("w") - own_win) / n_s).alias("win_rate"),
    ).filter("kind = 2").drop("kind", "bucket")


def season_so_far(long: DataFrame, col: str, name: str, days: int = BUCKET_DAYS) -> DataFrame:
    """F5 of one column alone: `long` with the mean of `col` over the season's earlier rows."""
    x = with_bucket(long, days)
    per = x.groupBy(*PART).agg(F.sum(col).alias("_sum"), F.count(col).alias("_cnt"))
    opening = per.select(*PART, F.lit(0).alias("_kind"), _before_season("_sum").alias("_sum"),
                         _before_season("_cnt").alias("_cnt"))
    own = x.select("*", F.lit(1).alias("_kind"), F.coalesce(F.col(col), F.lit(0)).alias("_sum"),
                   F.when(F.col(col).isNotNull(), 1).otherwise(0).cast("bigint").alias("_cnt"))
    sofar = Window.partitionBy(*PART).orderBy("_kind", *ORDER).rowsBetween(UNB, -1)
    total = lambda c: F.sum(c).over(sofar)
    return (own.unionByName(opening, allowMissingColumns=True)
            .withColumn(name, F.when(total("_cnt") > 0, total("_sum") / total("_cnt")))
            .filter("_kind = 1").drop("_kind", "_sum", "_cnt", "bucket"))


def leave_one_out(long: DataFrame, by: Sequence[str] = ("team", "side", "season")) -> DataFrame:
    """F10 by totals: `long` with avg_points, avg_allowed, win_rate over the other rows of its group."""
    s, a = F.col("points_scored"), F.col("points_allowed")
    win = F.when(s > a, 1).otherwise(0)
    totals = long.groupBy(*by).agg(F.sum(s).alias("_s"), F.count(s).alias("_ns"), F.sum(a).alias("_a"),
                                   F.count(a).alias("_na"), F.sum(win).alias("_w"))
    n_s = F.nullif(F.col("_ns") - F.when(s.isNotNull(), 1).otherwise(0), F.lit(0))
    n_a = F.nullif(F.col("_na") - F.when(a.isNotNull(), 1).otherwise(0), F.lit(0))
    return long.join(totals, list(by)).select(
        *(F.col(c) for c in long.columns),
        ((F.col("_s") - F.coalesce(s, F.lit(0))) / n_s).alias("avg_points"),
        ((F.col("_a") - F.coalesce(a, F.lit(0))) / n_a).alias("avg_allowed"),
        ((F.col("_w") - win) / n_s).alias("win_rate"))


def running_mean(df: DataFrame, col: str, avg_name: str, count_name: str, days: int = BUCKET_DAYS) -> DataFrame:
    """running AVG and COUNT of `col` over the team's season up to and including the row.

    The opening rows hold something of every column, so that totals and rows are read from the same shuffles."""
    x = with_bucket(df, days)
    others = [c for c in df.columns if c not in PART]
    per = x.groupBy(*PART).agg(F.sum(col).alias("_sum"), F.count(col).alias("_cnt"),
                               *(F.max(c).alias(c) for c in others))
    opening = per.select(*PART, *others, F.lit(0).alias("_kind"), _before_season("_sum").alias("_sum"),
                         _before_season("_cnt").alias("_cnt"))
    own = x.select("*", F.lit(1).alias("_kind"), F.coalesce(F.col(col), F.lit(0.0)).alias("_sum"),
                   F.when(F.col(col).isNotNull(), 1).otherwise(0).cast("bigint").alias("_cnt"))
    upto = Window.partitionBy(*PART).orderBy("_kind", *ORDER).rowsBetween(UNB, Window.currentRow)
    total = lambda c: F.sum(c).over(upto)
    return (own.unionByName(opening, allowMissingColumns=True)
            .withColumns({avg_name: F.when(total("_cnt") > 0, total("_sum") / total("_cnt")),
                          count_name: total("_cnt")})
            .filter("_kind = 1").drop("_kind", "_sum", "_cnt", "bucket"))
