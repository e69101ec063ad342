"""Grouped aggregates.

All of these are declarative `groupBy().agg()` plans: Spark runs a partial
aggregate before the shuffle, so a hot key (one game / book / season with a
large share of rows) is pre-combined on the map side and never collected
into one task.  The only array-building aggregates (E11 list, E12, E13)
gather per-game quote lists, which are bounded by books per game.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# E1 / N4
def coverage(df: DataFrame, by: Sequence[str] | str, conds: dict, ts: str | None = None) -> DataFrame:
    """Per group: count, one conditional count per predicate, min/max ts."""
    by = [by] if isinstance(by, str) else list(by)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count(F.when(c, 1)).alias(name) for name, c in conds.items()]
    if ts:
        aggs += [F.min(ts).alias(f"first_{ts}"), F.max(ts).alias(f"last_{ts}")]
    return df.groupBy(*by).agg(*aggs)


# E2
def pct(flag: Column, digits: int = 1) -> Column:
    """ROUND(100 * SUM(flag) / COUNT(*), digits) as a DOUBLE."""
    return F.round(F.lit(100.0) * F.sum(F.when(flag, 1).otherwise(0)) / F.count(F.lit(1)), digits)


# E3
def by_class(df: DataFrame, cls: str, val: str, ranks: Sequence[str]) -> DataFrame:
    """Per class: count, AVG and MAX of val, plus the custom class rank for G2."""
    rank = F.lit(len(ranks))
    for i, r in reversed(list(enumerate(ranks))):
        rank = F.when(F.col(cls) == r, i).otherwise(rank)
    return (df.groupBy(cls).agg(F.count(F.lit(1)).alias("n"), F.avg(val).alias(f"avg_{val}"),
                                F.max(val).alias(f"max_{val}"))
            .withColumn("class_rank", rank))


# E4
def group_by_expr(df: DataFrame, expr: Column, name: str) -> DataFrame:
    return df.groupBy(expr.alias(name)).agg(F.count(F.lit(1)).alias("n"))


# E5
def book_count(odds: DataFrame, markets: Sequence[str] = ("spreads", "h2h", "totals"),
               key: str = "event_id", book: str = "bookmaker") -> DataFrame:
    """Distinct books per event and market, one pass."""
    return odds.groupBy(key).agg(*[
        F.count_distinct(F.when(F.col("market") == m, F.col(book))).alias(f"{m}_books") for m in markets])


# E6
def best_price(odds: DataFrame, key: str = "event_id", market: str = "h2h",
               sides: Sequence[str] = ("home", "away")) -> DataFrame:
    """Per event and side, the MAX price (the reference's 'consensus' ML)."""
    m = F.col("market") == market
    return odds.groupBy(key).agg(*[
        F.max(F.when(m & (F.col("outcome_name") == s), F.col("outcome_price"))).alias(f"best_{s}_price")
        for s in sides])


# E7 / E8 / K2 / K3
def mode_value(val, tie: str = "min") -> Column:
    """Most frequent non-null value; tie -> smallest ('min').  Aggregate
    expression (ObjectHashAggregate with partial maps)."""
    if tie != "min":
        raise ValueError("mode_value supports tie='min'; use mode_by_counts for 'avg'")
    return F.mode(_c(val), True)


def mode_by_counts(df: DataFrame, key: str, val: str, tie: str = "min", name: str = "mode") -> DataFrame:
    """Mode via explicit (key, value) counts - partial aggregation at
    both levels, so even a huge group never holds a value map in one task.
    tie='min' -> smallest of the tied values, tie='avg' -> their average."""
    cnt = (df.filter(F.col(val).isNotNull()).groupBy(key, val).agg(F.count(F.lit(1)).alias("_n")))
    if tie == "min":
        return cnt.groupBy(key).agg(
            F.max_by(F.col(val), F.struct(F.col("_n"), -F.col(val))).alias(name))
    top = cnt.withColumn("_top", F.max("_n").over(Window.partitionBy(key)))
    return top.filter(F.col("_n") == F.col("_top")).groupBy(key).agg(F.avg(val).alias(name))


def mode_spread(df: DataFrame, key: str, val: str, name: str = "mode_spread") -> DataFrame:
    """E7 `agg_mode_min_tie`: NULL/unparsable ignored (safe cast), empty -> NULL."""
    v = F.col(val).cast("string").try_cast("double")
    return df.groupBy(key).agg(mode_value(v).alias(name))


# E9
def mode_or_median(df: DataFrame, key: str, val: str, order: Sequence[str],
                   name: str = "line") -> DataFrame:
    """Mode, but median when all values are distinct (one quote -> itself);
    several modes -> the one whose first occurrence (by `order`) is earliest.

    Two partial aggregates: per (key, value) count and first position, then
    per key the winner and the distinct/count test; median by percentile.
    """
    pos = F.struct(*[F.col(c) for c in order], F.col(val))
    v = df.filter(F.col(val).isNotNull())
    per_val = v.groupBy(key, val).agg(F.count(F.lit(1)).alias("_n"), F.min(pos).alias("_first"))
    # one pass over the quotes: the winner (max count, then earliest first
    # occurrence), the distinct/count test and the median - the median from
    # the per-value counts via percentile's frequency argument
    win = per_val.groupBy(key).agg(
        F.min_by(F.col(val), F.struct(-F.col("_n"), F.col("_first"))).alias("_mode"),
        F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_distinct"),
        F.percentile(F.col(val), 0.5, F.col("_n")).alias("_median"))
    return win.select(key, F.when(F.col("_distinct") == F.col("_total"), F.col("_median"))
                      .otherwise(F.col("_mode")).alias(name), F.col("_total").alias("n_quotes"))


# E10
def pick_line(flat: DataFrame, key: str, pos: str, preferred: str = "consensus",
              provider: str = "provider", spread: str = "spread", spread_open: str = "spread_open") -> DataFrame:
    """Per game: the first `preferred` provider's line; if absent or its
    spread is NULL, the FIRST listed line supplies both spread and open;
    rows with both NULL dropped.  Partial aggregates only (min_by)."""
    pair = F.struct(F.col(spread).alias("s"), F.col(spread_open).alias("o"))
    g = flat.groupBy(key).agg(
        F.min_by(pair, F.when(F.col(provider) == preferred, F.col(pos))).alias("_pref"),
        F.min_by(pair, F.col(pos)).alias("_first"))
    use_pref = F.col("_pref").isNotNull() & F.col("_pref.s").isNotNull()
    out = g.select(key,
                   F.when(use_pref, F.col("_pref.s")).otherwise(F.col("_first.s")).alias("mode_spread"),
                   F.when(use_pref, F.col("_pref.o")).otherwise(F.col("_first.o")).alias("mode_spread_open"))
    return out.filter(F.col("mode_spread").isNotNull() | F.col("mode_spread_open").isNotNull())


def pick_line_nested(games: DataFrame, lines: str = "lines", preferred: str = "consensus") -> DataFrame:
    """E10 on a nested lines array (no shuffle: pure array expressions)."""
    arr = F.col(lines)
    pref = F.try_element_at(F.filter(arr, lambda x: x["provider"] == preferred), F.lit(1))
    first = F.try_element_at(arr, F.lit(1))
    use_pref = pref.isNotNull() & pref["spread"].isNotNull()
    s = F.when(use_pref, pref["spread"]).otherwise(first["spread"])
    o = F.when(use_pref, pref["spreadOpen"]).otherwise(first["spreadOpen"])
    out = games.select("id", s.cast("string").try_cast("double").alias("mode_spread"),
                       o.cast("string").try_cast("double").alias("mode_spread_open"))
    return out.filter(F.col("mode_spread").isNotNull() | F.col("mode_spread_open").isNotNull())


# E11
def dispersion(df: DataFrame, key: str, val: str, min_std: float = 2.0, min_books: int = 3,
               provider: str | None = None, digits: int = 2) -> DataFrame:
    """Per game with >= min_books non-null quotes: population std, mean, min,
    max, range, count (+ sorted provider/value list); keep std >= min_std."""
    v = df.filter(F.col(val).isNotNull())
    aggs = [F.sum(val).alias("_sx"), F.sum(F.col(val) * F.col(val)).alias("_sxx"),
            F.avg(val).alias("_mean"), F.min(val).alias("min_spread"),
            F.max(val).alias("max_spread"), F.count(val).alias("sportsbook_count")]
    if provider:
        aggs.append(F.sort_array(F.collect_list(F.struct(F.col(provider), F.col(val)))).alias("quotes"))
    g = v.groupBy(key).agg(*aggs).filter(F.col("sportsbook_count") >= min_books)
    # n^2 * variance from sums, which are exact for half-point quotes: a std
    # that lies exactly on the threshold is kept
    n = F.col("sportsbook_count")
    scaled = n * F.col("_sxx") - F.col("_sx") * F.col("_sx")
    g = g.filter(scaled >= F.lit(min_std * min_std) * n * n) \
        .withColumn("_std", F.sqrt(F.greatest(scaled, F.lit(0.0))) / n)
    return g.select(
        F.col(key).alias("game_id"),
        F.round("_std", digits).alias("std_dev"),
        F.round("_mean", digits).alias("mean_spread"),
        "min_spread", "max_spread",
        F.round(F.col("max_spread") - F.col("min_spread"), digits).alias("spread_range"),
        "sportsbook_count", *(["quotes"] if provider else []))


# E12
def low_confidence(df: DataFrame, key: str, val: str, provider: str, max_books: int = 2) -> DataFrame:
    """Games with 1..max_books non-null quotes, with the providers of those
    quotes (one entry per quote, sorted for determinism).  Groups above the
    cap are dropped by HAVING before any list is kept."""
    v = df.filter(F.col(val).isNotNull())
    low = v.groupBy(key).agg(F.count(val).alias("sportsbook_count")).filter(
        F.col("sportsbook_count").between(1, max_books))
    lists = (v.join(low.select(key), key, "left_semi")
             .groupBy(key).agg(F.sort_array(F.collect_list(provider)).alias("providers")))
    return low.join(lists, key)


# E13
def collect(df: DataFrame, key: str, cols: Sequence[str], name: str = "items") -> DataFrame:
    """Values (or structs of several columns) per key, sorted for determinism."""
    item = F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)
    return df.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias(name))


# E14
def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(col))


# E15
def year_summary(df: DataFrame, date: str, val: str, digits: int = 2) -> DataFrame:
    return df.groupBy(F.year(date).alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(val), digits).alias(f"avg_{val}"),
        F.round(F.max(val), digits).alias(f"max_{val}"))


# E16 / N2-ish
def totals(df: DataFrame, cols: Sequence[str], minmax: str | None = None) -> DataFrame:
    """Total rows, non-null count per column, min/max of one column, one pass."""
    aggs = [F.count(F.lit(1)).alias("total_rows")] + [F.count(c).alias(f"{c}_non_null") for c in cols]
    if minmax:
        aggs += [F.min(minmax).alias(f"min_{minmax}"), F.max(minmax).alias(f"max_{minmax}")]
    return df.agg(*aggs)


# E18 / M5
def win_rate(df: DataFrame, by: str = "rule", won: str = "won", overall_label: str = "ALL") -> DataFrame:
    """wins, n, rate per group plus the overall row, one pass (ROLLUP)."""
    g = df.rollup(by).agg(F.sum(F.col(won).cast("bigint")).alias("wins"),
                          F.count(F.lit(1)).alias("n"),
                          F.grouping(by).alias("_g"))
    return g.select(F.when(F.col("_g") == 1, F.lit(overall_label)).otherwise(F.col(by)).alias(by),
                    "wins", "n", (F.col("wins") / F.col("n")).alias("rate"))
