"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets: the sources share 150 % of all words by weight; a source's target
stops at twice its size, and what it cannot take is shared again by weight
(water filling in closed form over the sources in order of size per weight).

A source's documents are dealt into shards by a hash of id and text; in a shard
the documents lie end to end in seeded order and are cut into blocks of equal
word counts (within one word, at most BLOCK).  Copies of one document that
together hold more than a shard's words are dealt one by one, by their number,
so no id and no document is a shard of its own.  All shards compete for blocks
by highest quotients w / (2 k + 1), w being the target in the shard's own
blocks, none getting a block more than twice: seats below a bound of the common
divisor are given at once, the few open ones by rank, so the exact
apportionment of any number of blocks is a few short sorts over the shards.
Which blocks come first is seeded.  A document takes the words of its share of
every taken block.

Only per-shard and per-block rows are shuffled beside one short row per
document.  A shard holds about SHARD_WORDS words, or the words of the table by
MAX_SHARDS where that is more, so the apportionment sorts a bounded number of
shards (and one more for each source).

Sources are sorted in one task, so they must be names, not one per document; a
document longer than a shard makes that shard longer, as it is never cut.

Defined results: null text has size 0 and takes 0 words; a null source is a
source of its own, ordered last.  Rows equal in id, source and text are
interchangeable: one may take more than another.  All sizes 0 or an empty
table: targets 0, nothing taken.  Only the three columns named are read, so
extra columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import TOKEN_PATTERN, stored

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
BLOCK, SEED = 64, "mix-1"
SHARD_WORDS, MAX_SHARDS = 1 << 16, 16384      # shards of that many words; larger ones once there would be more shards
UNIT = 1024                           # quotas are whole numbers of 1/UNIT block


def _rank(*parts: Column) -> Column:
    """Seeded order key."""
    return F.md5(F.concat_ws(":", F.lit(SEED), *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts)).cast("binary"))


def targets(sources: DataFrame) -> DataFrame:
    """(source, pos, source_size, n_shards, shard_words, target) from (source, source_size); one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    w = sources.withColumn("pos", place)
    w = w.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("pos") % len(WEIGHTS)).cast("int") + 1))
    w = w.withColumn("cap", MOST * F.col("source_size"))
    w = w.withColumn("ratio", F.col("cap") / F.col("weight"))
    ahead = Window.orderBy("ratio", "pos").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("level", (SHARE * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(ahead), F.lit(0)))
                     / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(ahead), F.lit(0))))
    w = w.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "pos", "level")))
                     .over(every)["level"])
    words = F.greatest(F.lit(SHARD_WORDS), F.ceil(F.sum("source_size").over(every) / MAX_SHARDS))
    return w.select("source", "pos", "source_size", F.ceil(F.col("source_size") / words).alias("n_shards"),
                    words.alias("shard_words"),
                    F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0)))
                    .alias("target"))


def _level(shards: DataFrame, seats: Column, name: str) -> DataFrame:
    """Adds the level (seats per unit of want) at which the shards' shares, each up to its top, sum to `seats`;
    infinite where all tops are not enough.  One running sum over the shards, in order of the level that fills them."""
    order = Window.orderBy("ratio", "pos", "shard")
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = lambda c: F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col(c)
    rest = F.sum("want").over(every) - before("want")
    at = shards.withColumn("at", (seats - before("top")) / rest)
    low = F.min(F.when(F.col("at") <= F.col("ratio"), F.struct("ratio", "pos", "shard", "at"))).over(every)["at"]
    return at.withColumn(name, F.coalesce(low, F.lit(float("inf")))).drop("at")


def quotas(shards: DataFrame) -> DataFrame:
    """Adds `quota`, blocks per shard, to (…, pos, shard, blocks, want): want in 1/UNIT block.

    The quotas are those of handing out seat after seat to the highest quotient want / (2 k + 1) of a shard with
    k < MOST * blocks seats; equal quotients in order of pos, shard.  Rounding moves no shard by more than half
    a seat from its share at the common level, so the level lies between those at which the shares sum to half
    a seat per shard less and more than all seats; seats below the first are sure, those above the second out.
    """
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = shards.withColumn("top", MOST * F.col("blocks"))
    own = s.filter("want > 0").withColumns({"ratio": F.col("top") / F.col("want"), "n": F.count("*").over(every)})
    own = own.withColumn("seats", F.least(F.floor((F.sum("want").over(every) + UNIT // 2) / UNIT), F.sum("top").over(every)))
    half = F.col("n") / 2 + 1
    own = _level(_level(own, F.greatest(F.col("seats") - half, F.lit(0)), "low"), F.col("seats") + half, "high")
    seats = lambda level: F.least(F.floor(F.col("want") * level + 0.5), F.col("top").cast("double")).cast("long")
    own = own.withColumns({"sure": seats(F.col("low")), "at_most": seats(F.col("high"))})
    open_ = own.withColumn("open", F.col("seats") - F.sum("sure").over(every)).filter("at_most > sure")
    open_ = open_.select("pos", "shard", "open", "want",
                         F.explode(F.sequence(F.col("sure"), F.col("at_most") - 1)).alias("k"))
    rank = F.row_number().over(Window.orderBy((F.col("want") / (2 * F.col("k") + 1)).desc(), "pos", "shard", "k"))
    won = open_.withColumn("r", rank).filter("r <= open").groupBy("pos", "shard").agg(F.count("*").alias("won"))
    return shards.join(own.select("pos", "shard", "sure"), ["pos", "shard"], "left").join(won, ["pos", "shard"], "left").select(
        *shards.columns, (F.coalesce("sure", F.lit(0)) + F.coalesce("won", F.lit(0))).alias("quota"))


def _copies(rows: DataFrame) -> DataFrame:
    """Adds `copy`: 0, 1, … for rows of equal (pos, own), counted within each part and moved on by the parts before."""
    nth = F.row_number().over(Window.partitionBy("part", "pos", "own").orderBy(F.lit(1))) - 1
    per = rows.groupBy("pos", "own", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("pos", "own").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select("pos", "own", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    return rows.withColumn("nth", nth).join(before, ["pos", "own", "part"]).withColumn("copy", F.col("before") + F.col("nth")) \
        .drop("nth", "before")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken) for every row of `docs`."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    size = F.regexp_count(text, F.lit(TOKEN_PATTERN)).cast("long")
    sized = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                               size.alias("size"), _rank(F.col(id_col), F.md5(text.cast("binary"))).alias("own"),
                               F.spark_partition_id().alias("part")), "sized")
    by_source = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")

    sourced = (sized.join(by_source, sized["source"].eqNullSafe(by_source["source"]))
               .select("id", "size", "own", "part", "pos", "source_size", "target", "n_shards", "shard_words"))
    empty = sourced.filter("size = 0").select("id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    sourced = sourced.filter("size > 0")
    # Copies of one document that hold more than a shard's words are dealt one by one; there are fewer such than shards.
    many = (sourced.groupBy("pos", "own").agg(F.sum("size").alias("words"), F.max("shard_words").alias("shard_words"))
            .filter("words > shard_words").select("pos", "own"))
    many = F.broadcast(stored(many, "many"))
    apart = _copies(sourced.join(many, ["pos", "own"], "left_semi")).withColumn("own", _rank(F.col("own"), F.col("copy"))).drop("copy")
    sourced = sourced.join(many, ["pos", "own"], "left_anti").unionByName(apart)
    shard = F.expr("conv(substring(own, 1, 8), 16, 10)").cast("long") % F.greatest("n_shards", F.lit(1))
    dealt = sourced.withColumn("shard", shard)
    line = Window.partitionBy("pos", "shard").orderBy("own", "id", "size")
    dealt = stored(dealt.withColumn("stop", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
                   .select("id", "size", "pos", "source_size", "target", "shard",
                           (F.col("stop") - F.col("size")).alias("start"), "stop"), "dealt")

    shards = dealt.groupBy("pos", "shard").agg(F.sum("size").alias("words"), F.first("target").alias("target"),
                                               F.first("source_size").alias("source_size"))
    shards = shards.withColumn("blocks", F.expr(f"(words + {BLOCK - 1}) div {BLOCK}"))
    shards = shards.withColumn("want", F.floor(F.col("target") * F.col("blocks") / F.col("source_size") * UNIT))
    shards = stored(quotas(shards.select("pos", "shard", "words", "blocks", "want")), "quotas")

    # A block's place in its shard, how often it is taken, and the words taken from the blocks before it.
    blocks = shards.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    seeded = Window.partitionBy("pos", "shard").orderBy(_rank(F.col("pos"), F.col("shard"), F.col("block")), "block")
    blocks = blocks.withColumn("turn", F.row_number().over(seeded)).selectExpr(
        "pos", "shard", "block", "(block * words) div blocks AS lo", "((block + 1) * words) div blocks AS hi",
        "quota div blocks + CASE WHEN turn <= quota % blocks THEN 1 ELSE 0 END AS times")
    ahead = Window.partitionBy("pos", "shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored(blocks.select("pos", "shard", "block", "lo", "times", F.coalesce(
        F.sum((F.col("hi") - F.col("lo")) * F.col("times")).over(ahead), F.lit(0)).alias("before")), "blocks")

    def taken_upto(rows: DataFrame, place: str) -> DataFrame:
        """Adds upto_<place>: words taken from the shard before that place."""
        at = rows.withColumn("block", F.expr(f"least((({place} + 1) * blocks - 1) div words, blocks - 1)"))
        return at.join(blocks, ["pos", "shard", "block"]).withColumn(
            f"upto_{place}", F.expr(f"before + ({place} - lo) * times")).drop("block", "lo", "times", "before")

    filled = dealt.join(shards.select("pos", "shard", "words", "blocks"), ["pos", "shard"])
    taken = taken_upto(taken_upto(filled, "start"), "stop").select(
        "id", "size", "source_size", "target", (F.col("upto_stop") - F.col("upto_start")).alias("taken"))
    return taken.unionByName(empty).withColumnRenamed("id", id_col)
