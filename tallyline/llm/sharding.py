"""Range sharding by sampled splitters.

The sort key of a record is (hash of its text, hash of its id, random salt), so
copies of a text are neighbours and every record can still be split from its
neighbours, copies of one row too.
A seeded sample draws each record with probability proportional to its size
(the expected number of rows is a parameter); quantiles of the sample's weight
are the range boundaries.  Exact sizes of the ranges follow from one
aggregate; ranges above twice the wanted size are sampled again and subdivided
until none is left that a new splitter would cut.  Within a range records are
put in key order; a record's shard is the sixteenth of all bytes its middle
falls into, so shards differ by no more than about one record's size.

The driver holds the splitters only: at most MAX_RANGES in the first round,
and SAMPLE_PER_RANGE sampled rows for each range that is (re)divided.

Defined results: null text has no bytes and the crc of empty text.  Null ids
are ordinary key values.  Rows equal in id and text are interchangeable: they
get neighbouring slots, which one gets which is left to the salt.  A text of
any length is one record, never cut.  Only the two columns named are read, so
extra columns of any name do no harm.  Fewer records than shards leave shards empty; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SHARDS, SEED = 16, 23
RANGE_BYTES = 64 << 20                # wanted size of a range, where MIN..MAX_RANGES allows it
MIN_RANGES, MAX_RANGES, SAMPLE_PER_RANGE = 256, 8192, 8

PARTS = ["k", "s", "c"]
Key = tuple[int, int, int]


def _range_of(splitters: list[Key]) -> Column:
    """Number of splitters at or below a row's key: one binary search for all rows of a batch."""
    sk, ss, sc = (np.array(x, np.int64) for x in zip(*splitters))

    @F.pandas_udf("int")
    def find(k: pd.Series, s: pd.Series, c: pd.Series) -> pd.Series:
        k, s, c = (x.to_numpy() for x in (k, s, c))
        low, high = np.zeros(len(k), np.int64), np.full(len(k), len(sk), np.int64)
        for _ in range(len(sk).bit_length()):
            mid = np.minimum((low + high) >> 1, len(sk) - 1)
            below = (sk[mid] < k) | (sk[mid] == k) & ((ss[mid] < s) | (ss[mid] == s) & (sc[mid] <= c))
            open_ = low < high
            low, high = np.where(open_ & below, mid + 1, low), np.where(open_ & ~below, mid, high)
        return pd.Series(low.astype(np.int32))

    return find(*PARTS)


def _sample(keys: DataFrame, weight: Column, rate: float, round_: int) -> list:
    """Rows drawn with probability rate * size (at most 1), with the weight each stands for."""
    u = F.pmod(F.xxhash64(F.lit(SEED + round_), *PARTS), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = keys.filter(u < weight * F.lit(rate))
    return drawn.select("range", *PARTS, F.greatest(weight, F.lit(1.0 / rate)).alias("w")).toPandas() \
        .sort_values(["range", *PARTS], kind="stable")


def _cuts(drawn: pd.DataFrame, pieces: int) -> list[Key]:
    """The keys at the quantiles of the sampled weight."""
    if len(drawn) == 0:
        return []
    reach = drawn["w"].cumsum().to_numpy()
    at = np.searchsorted(reach, reach[-1] * np.arange(1, pieces) / pieces)
    return sorted({tuple(int(drawn[p].iloc[i]) for p in PARTS) for i in np.minimum(at, len(drawn) - 1)})


def splitters(keys: DataFrame, total: int, ranges: int) -> list[Key]:
    """Boundaries of about `ranges` ranges of the key; none above twice the wanted size unless one key fills it."""
    wanted = max(1.0, total / ranges)
    found = _cuts(_sample(keys.withColumn("range", F.lit(0)), F.col("size"), ranges * SAMPLE_PER_RANGE / max(total, 1), 0),
                  ranges)
    round_ = 0
    while True:
        round_ += 1
        placed = keys.withColumn("range", _range_of(found) if found else F.lit(0))
        sums = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.max("size").alias("most"))
        over = {r["range"]: r["bytes"] for r in sums.filter(
            (F.col("bytes") > 2 * wanted) & (F.col("bytes") > 2 * F.col("most"))).toLocalIterator()}
        if not over:
            return found
        again = placed.filter(F.col("range").isin(list(over)))
        drawn = _sample(again, F.col("size"), SAMPLE_PER_RANGE / wanted, round_)
        more = {c for r, part in drawn.groupby("range") for c in _cuts(part, max(2, round(over[r] / wanted) + 1))}
        grown = sorted(more | set(found))
        if len(grown) == len(found):
            return found
        found = grown


def shard(df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
          range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row of `df`."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = stored(df.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("k"),
        F.xxhash64(F.lit(SEED), id_col).alias("s"), (F.rand(SEED) * F.lit(float(1 << 52))).cast("long").alias("c")), "keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    ranges = int(min(max(MIN_RANGES, total // range_bytes), MAX_RANGES))
    found = splitters(keys, total, ranges)
    placed = stored(keys.withColumn("range", _range_of(found) if found else F.lit(0)), "ranges")

    # Bytes and rows of the ranges before each (one short row per range).
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = sums.select("range", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("bytes_before"),
                         F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("rows_before"))
    within = Window.partitionBy("range").orderBy(*PARTS, "id", "text_crc32", "size")
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = placed.join(before, "range").select(
        "id", "size", "text_crc32",
        (F.col("bytes_before") + F.sum("size").over(upto)).alias("upto"),
        (F.col("rows_before") + F.row_number().over(within) - 1).alias("row"))
    middle = F.col("upto") - F.col("size") / 2
    run = stored(run.withColumn("shard", F.least(F.floor(middle * shards / F.lit(max(total, 1))),
                                                 F.lit(shards - 1)).cast("int")), "shards")
    first = run.groupBy("shard").agg(F.min("row").alias("first"))      # at most `shards` rows
    return run.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
