"""Chat formatting: collapse of cumulative snapshots, then rendering.

Logs often hold a conversation once per turn, each time a little longer.  A
rolling hash over the turns (a running sum of position-salted turn hashes,
two of them) names every prefix.  A conversation whose whole hash is also a
proper prefix of another, or that equals one with a smaller id, is taken for a
snapshot if their turns, compared one by one by their SHA-256, are equal;
anti-joins leave the maximal conversations, which are then rendered.  So a
chance meeting of two hashes never drops a conversation: one that does not
agree with the first match is compared with all conversations of that hash.

The running sums are taken within runs of RUN turns and carried over from run
to run, so that one endless conversation is not one task's work.  Keys are
made distinct before they are joined: a first turn that a third of all
conversations share is one row, and each conversation is compared with one
other.

Defined results: rows without a conversation id belong to none and are left
out.  A row repeated in all four columns counts once; different rows of one
turn number keep the order of (turn, role, text), nulls first.  Null roles
render as 'user', null texts as empty.  Equal conversations are kept once,
under the smallest id.  A maximal conversation is rendered into one string in
one task, so it must fit one row (2 GB); turns of any length up to that are
rendered whole.  Extra columns of any name are not read.  An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

RUN = 1024
MODULUS = 1 << 31                     # of turn hashes: their sums stay within a long


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text, digest, x1, x2, h1, h2): distinct turns in order; h names the prefix that ends
    with the turn, h - x the one before it."""
    t = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).distinct()
    t = t.withColumn("run", F.floor(F.coalesce("turn", F.lit(-1)) / RUN))
    within = Window.partitionBy("conv_id", "run").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    ahead = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)

    def carried(rows: DataFrame, **sums) -> DataFrame:
        """Adds, per run, what the runs before it sum to."""
        per_run = rows.groupBy("conv_id", "run").agg(*(f.alias(n) for n, f in sums.items()))
        before = per_run.select("conv_id", "run", *(F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(n) for n in sums))
        return rows.join(before, ["conv_id", "run"])

    t = stored(t.withColumn("nth", F.row_number().over(within)), "turns")
    t = carried(t, rows_before=F.count("*")).withColumn("pos", F.col("rows_before") + F.col("nth"))
    for k in (1, 2):
        t = t.withColumn(f"x{k}", F.pmod(F.xxhash64(F.lit(k), "pos", "role", "text"), F.lit(MODULUS)))
    turn = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    t = t.withColumn("digest", F.unhex(F.sha2(turn, 256)))
    upto = Window.partitionBy("conv_id", "run").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    return carried(t, c1=F.sum("x1"), c2=F.sum("x2")).select(
        "conv_id", "pos", "role", "text", "digest", "x1", "x2",
        *((F.col(f"c{k}") + F.sum(f"x{k}").over(upto)).alias(f"h{k}") for k in (1, 2)))


def _agreeing(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b, pos) of conversations whose first `pos` turns are equal."""
    x = pairs.join(rows.select(F.col("conv_id").alias("a"), F.col("pos").alias("at"), "digest"), "a").filter("at <= pos")
    y = rows.select(F.col("conv_id").alias("b"), F.col("pos").alias("at"), F.col("digest").alias("other"))
    equal = x.join(y, ["b", "at"]).filter(F.col("digest") == F.col("other"))
    return equal.groupBy("a", "b", "pos").agg(F.count("*").alias("n")).filter("n = pos").select("a", "b")


def _matched(heads: DataFrame, others: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b): for every head (conv_id, pos, h1, h2) that some conversation of `others` with its key agrees with,
    the smallest such one.

    `others` (conv_id, pos, h1, h2) may hold a conversation often.  A head is compared with the smallest of its
    key first; only heads that do not agree with that one, which takes two equal hashes of different turns, are
    compared with the rest.
    """
    key = ["pos", "h1", "h2"]
    first = others.groupBy(*key).agg(F.min("conv_id").alias("b"))
    pairs = stored(heads.join(first, key).select(F.col("conv_id").alias("a"), "b", "pos", "h1", "h2").filter("a <> b"), "pairs")
    found = stored(_agreeing(pairs, rows), "agreeing")
    missed = stored(pairs.join(found, "a", "left_anti"), "missed")
    if missed.isEmpty():
        return found
    every = missed.select("a", *key).join(others.select(F.col("conv_id").alias("b"), *key).distinct(), key).filter("a <> b")
    late = _agreeing(every.select("a", "b", "pos"), rows).groupBy("a").agg(F.min("b").alias("b"))
    return stored(found.unionByName(late), "agreeing")


def maximal(rows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): conversations that are no snapshot; `rows` as prefixes() gives them, stored."""
    heads = stored(rows.groupBy("conv_id").agg(F.max(F.struct("pos", "h1", "h2")).alias("head")).select("conv_id", "head.*"), "heads")
    same = _matched(heads, heads, rows).withColumnsRenamed({"a": "conv_id", "b": "first"})
    classes = heads.join(same, "conv_id", "left").withColumn("first", F.least("conv_id", F.coalesce("first", "conv_id")))
    distinct = stored(classes.groupBy(F.col("first").alias("conv_id"), "pos", "h1", "h2").agg(F.count("*").alias("n_copies")), "distinct")
    continued = rows.filter("pos > 1").select(
        "conv_id", (F.col("pos") - 1).alias("pos"), (F.col("h1") - F.col("x1")).alias("h1"),
        (F.col("h2") - F.col("x2")).alias("h2"))
    longer = _matched(distinct, continued, rows)
    return distinct.join(longer.select(F.col("a").alias("conv_id")), "conv_id", "left_anti").select(
        "conv_id", F.col("pos").alias("n_turns"), "n_copies")


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies, rendered) of the maximal conversations."""
    rows = stored(prefixes(turns), "prefixes")
    kept = maximal(rows)
    line = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n"))
    chats = rows.join(kept.select("conv_id"), "conv_id", "left_semi").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", line.alias("line")))).alias("lines"))
    return kept.join(chats, "conv_id").select(
        "conv_id", "n_turns", "n_copies", F.array_join(F.col("lines.line"), "").alias("rendered"))
