"""D1-D17 join helpers.

Join strategy is left to Catalyst/AQE: sort-merge by default, converted to
a broadcast hash join only when the measured (runtime) size of a side is
under `spark.sql.autoBroadcastJoinThreshold`.  Nothing here forces a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_out(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by number: AQE joins partitions by their compressed size, and rows that compress to a few
    bytes would meet by the million in one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def join_left(left: DataFrame, right: DataFrame, on: Sequence[str] | str, keep: Sequence[str] | None = None) -> DataFrame:
    """Left equi join; the right side is pre-projected to the key +
    `keep` columns so nothing collides and nothing unused is shuffled."""
    on = [on] if isinstance(on, str) else list(on)
    r = right if keep is None else right.select(*on, *keep)
    return left.join(r, on, "left")


def flag_if_present(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None,
                    label: str = "VERIFIED", name: str = "flag") -> DataFrame:
    """D6 `join_left_case`: matched -> label else NULL (keys de-duplicated so
    the left side never fans out)."""
    ok = other_key or key
    marks = other.select(F.col(ok).alias(key)).distinct().withColumn("_m", F.lit(True))
    return df.join(marks, key, "left").withColumn(name, F.when(F.col("_m"), F.lit(label))).drop("_m")


def not_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """D7 / D8 `left_anti`: rows whose key is absent from `other`."""
    ok = other_key or key
    return df.join(other.select(F.col(ok).alias(key)), key, "left_anti")


def only_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """D9 / D17 `left_semi`: rows whose key is present in `other`."""
    ok = other_key or key
    return df.join(other.select(F.col(ok).alias(key)), key, "left_semi")


def match_on_names_date(games: DataFrame, cons: DataFrame, tz: str | None = None) -> DataFrame:
    """D10 `join_inner_names_date`: equi join on both team names and the
    calendar date of kick-off (dates computed once per side, so the join
    keys are plain columns).  Consensus columns come back prefixed `c_`."""
    def day(c: Column) -> Column:
        return F.to_date(c if tz is None else F.from_utc_timestamp(c, tz))
    g = games.withColumns({"_h": F.col("home_team").cast("string"), "_a": F.col("away_team").cast("string"),
                           "_d": day(F.col("start_ts"))})
    c = cons.select(*[F.col(x).alias(f"c_{x}") for x in cons.columns])
    c = c.withColumns({"_h": F.col("c_home_team"), "_a": F.col("c_away_team"), "_d": day(F.col("c_game_time"))})
    return g.join(c, ["_h", "_a", "_d"]).drop("_h", "_a", "_d")


def join_inner(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D11 `join_inner_5key` / D13: multi-key inner equi join."""
    return left.join(right, list(keys), "inner")


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, name: str,
           required: bool = True) -> DataFrame:
    """D15 `join_dim_lookup`: attach `dim.value` as `name`; unknown keys drop
    the row when required (inner) else keep NULL."""
    d = dim.select(F.col(dim_key).alias(key), F.col(value).alias(name)).dropDuplicates([key])
    return df.join(d, key, "inner" if required else "left")


def lookup_effective(df: DataFrame, dim: DataFrame, key: str, at: str, dim_key: str = "abbr",
                     value: str = "nickname", name: str = "nickname",
                     default: Column | None = None) -> DataFrame:
    """D16 `join_dim_effective`: slowly changing dimension - equi on key plus
    `at BETWEEN valid_from AND valid_to` (NULL bound = open) as a join
    residual; no match -> default (lower(key))."""
    d = dim.select(F.col(dim_key).alias("_k"), F.col(value).alias("_v"), "valid_from", "valid_to")
    cond = ((F.col(key) == F.col("_k"))
            & (F.col("valid_from").isNull() | (F.col(at) >= F.col("valid_from")))
            & (F.col("valid_to").isNull() | (F.col(at) <= F.col("valid_to"))))
    dflt = default if default is not None else F.lower(F.col(key).cast("string"))
    return (df.join(d, cond, "left").withColumn(name, F.coalesce(F.col("_v"), dflt))
            .drop("_k", "_v", "valid_from", "valid_to"))
