"""Calibration of probabilities and closing line value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 256                           # cells of the value range in which rows are counted before any is sorted


def brier(df: DataFrame, p: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """P4 `eval_brier`: rows (by…, n, brier, log_loss, base_rate) of forecasts p of a 0/1 outcome y.

    Rows with a NULL in either take no part.  Probabilities are kept 1e-15 away from 0 and 1 in the log loss.
    """
    q, hit = F.least(F.greatest(F.col(p), F.lit(1e-15)), F.lit(1 - 1e-15)), F.col(y).cast("double")
    return df.dropna(subset=[p, y]).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col(p) - hit) * (F.col(p) - hit)).alias("brier"),
        F.avg(-(hit * F.log(q) + (1 - hit) * F.log(1 - q))).alias("log_loss"), F.avg(hit).alias("base_rate"))


def equal_count_bins(df: DataFrame, value: str, tie: str, bins: int, by: Sequence[str]) -> DataFrame:
    """Adds `bin`, 1 to `bins`: NTILE(bins) over (PARTITION BY by… ORDER BY value, md5(tie)), without sorting a group.

    A percentile sketch (mergeable, per group) cuts the value range into CELLS
    cells.  Values the sketch names, which every value with more than a cell's
    share of the rows is, are cells of their own, cut again by the first byte of
    the tie's MD5, so equal values are no hot cell.  Rows are counted per cell;
    running counts say in which cell each bin ends, and only those cells' rows
    (at most bins - 1 of them a group) are ranked.  NULL values and rows of a
    NULL group get a NULL bin.
    """
    by = list(by)
    if not by:
        raise ValueError("name the group columns")
    known = df.filter(F.col(value).isNotNull()).dropna(subset=by)
    v = F.col(value).cast("double")
    cuts = known.groupBy(*by).agg(F.array_sort(F.array_distinct(F.percentile_approx(
        v, [i / CELLS for i in range(CELLS + 1)], F.lit(50 * CELLS)))).alias("__cuts"))
    above = F.size(F.filter("__cuts", lambda c: c <= F.col("__v")))
    named = F.array_contains("__cuts", F.col("__v"))
    key = F.md5(F.col(tie).cast("string").cast("binary"))

    def placed(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({"__v": v, "__tie": F.coalesce(key, F.lit(""))})
        rows = rows.join(cuts, by)
        part = F.when(named, F.coalesce(F.conv(F.substring("__tie", 1, 2), 16, 10).cast("int"), F.lit(0))).otherwise(F.lit(0))
        return rows.withColumn("__cell", 512 * above + F.when(named, F.lit(0)).otherwise(F.lit(256)) + part).drop("__cuts")

    counts = placed(known.select(*by, value, tie)).groupBy(*by, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    order = Window.partitionBy(*by).orderBy("__cell")
    every = Window.partitionBy(*by)
    counts = counts.withColumns({"__before": F.sum("__n").over(order) - F.col("__n"), "__all": F.sum("__n").over(every)})
    # NTILE: the first all % bins bins have one row more
    short, long = F.expr(f"__all div {bins}"), F.expr(f"__all % {bins}")
    first, last = _tile(F.col("__before"), short, long), _tile(F.col("__before") + F.col("__n") - 1, short, long)
    counts = counts.select(*by, "__cell", "__before", "__all", first.alias("__first"), (first != last).alias("__split"))
    rows = placed(known)
    keys = [*by, "__cell"]
    rows = rows.join(counts, keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("__v", "__tie")) - 1
    within = rows.filter("__split").withColumn("bin", _tile(F.col("__before") + rank, F.expr(f"__all div {bins}"), F.expr(f"__all % {bins}")))
    whole = rows.filter("NOT __split").withColumn("bin", F.col("__first"))
    missing = F.col(value).isNull()
    for c in by:
        missing = missing | F.col(c).isNull()
    rest = df.filter(missing).withColumn("bin", F.lit(None).cast("int"))
    columns = [*df.columns, "bin"]
    return within.select(columns).unionByName(whole.select(columns)).unionByName(rest.select(columns))


def _tile(rank: Column, short: Column, long: Column) -> Column:
    """The NTILE of a 0-based rank: `long` tiles of short + 1 rows, then tiles of `short` rows."""
    in_long = long * (short + 1)
    return F.when(rank < in_long, F.floor(rank / (short + 1))).otherwise(
        long + F.floor((rank - in_long) / F.greatest(short, F.lit(1)))).cast("int") + 1


def reliability(df: DataFrame, p: str, y: str, tie: str, by: Sequence[str], bins: int = 10) -> DataFrame:
    """P4 `eval_reliability`: rows (by…, bin, n, mean_p, observed, lowest, highest) over bins of equal count.

    Equal forecasts are dealt to neighbouring bins by the MD5 of `tie`, as equal_count_bins() says.
    """
    binned = equal_count_bins(df.select(*by, p, y, tie).dropna(subset=[*by, p, y]), p, tie, bins, by)
    return binned.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_p"), F.avg(F.col(y).cast("double")).alias("observed"),
        F.min(p).alias("lowest"), F.max(p).alias("highest"))


def asof_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, values: Sequence[str],
              order: Sequence[str] = (), bucket_seconds: int = 86400) -> DataFrame:
    """Every row of `left` with `values` of the last row of `right` of its key at or before its time, else NULLs.

    Rows of `right` of equal key and time: the largest by `order`.  NULL keys
    and times match nothing.  No join compares times: times of both sides, one
    row each, are put in one sequence per key and time bucket, the last quote is
    carried along it, and buckets without an earlier quote take it from the
    bucket before (a window over one row a bucket).  A key that holds a third of
    all rows is cut by its buckets, and equal times are one row before any sort.
    """
    seconds = lambda ts: F.unix_seconds(F.col(ts).cast("timestamp"))
    bucket = lambda ts: F.floor(seconds(ts) / bucket_seconds)
    pick = F.struct(*(F.col(v) for v in values))
    ties = F.struct(*(F.col(o) for o in order)) if order else F.lit(0)
    quotes = right.filter(F.col(key).isNotNull() & F.col(right_ts).isNotNull()).groupBy(
        key, F.col(right_ts).alias("__ts"), bucket(right_ts).alias("__b")).agg(F.max_by(pick, ties).alias("__v"))
    asked = left.filter(F.col(key).isNotNull() & F.col(left_ts).isNotNull()).select(
        key, F.col(left_ts).alias("__ts"), bucket(left_ts).alias("__b")).distinct()
    both = quotes.select(key, "__b", "__ts", F.lit(0).alias("__side"), "__v").unionByName(
        asked.select(key, "__b", "__ts", F.lit(1).alias("__side")), allowMissingColumns=True)
    last = F.last("__v", ignorenulls=True)
    along = Window.partitionBy(key, "__b").orderBy("__ts", "__side").rowsBetween(Window.unboundedPreceding, 0)
    within = both.withColumn("__found", last.over(along)).filter("__side = 1")
    ends = both.groupBy(key, "__b").agg(F.max_by(F.when(F.col("__side") == 0, F.col("__v")), F.when(F.col("__side") == 0, F.col("__ts"))).alias("__v"))
    earlier = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(key, "__b", last.over(earlier).alias("__carried"))
    found = within.join(carried, [key, "__b"]).select(
        F.col(key).alias("__key"), "__ts", F.coalesce("__found", "__carried").alias("__found"))
    return left.join(found, (left[key] == found["__key"]) & (left[left_ts] == found["__ts"]), "left").select(
        *(left[c] for c in left.columns), *(F.col("__found")[v].alias(v) for v in values))


def closing_line_value(taken: DataFrame, quotes: DataFrame, key: str = "event_id", taken_at: str = "taken_at",
                       starts_at: str = "starts_at", quoted_at: str = "last_update", line: str = "line",
                       order: Sequence[str] = ()) -> DataFrame:
    """P5 `eval_clv`: adds taken_line and closing_line, the last quotes at or before the time taken and the start,
    and clv = closing_line - taken_line (NULL without either).  A line taken after the start closes at the start."""
    at_take = asof_join(taken, quotes, key, taken_at, quoted_at, [line], order).withColumnRenamed(line, "taken_line")
    at_start = asof_join(at_take, quotes, key, starts_at, quoted_at, [line], order).withColumnRenamed(line, "closing_line")
    return at_start.withColumn("clv", F.col("closing_line") - F.col("taken_line"))
