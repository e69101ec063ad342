"""Prefix trie of conversations by van Emde Boas recursion.

Sequences of turns are padded to a power of two and cut at half depth.  All
prefixes that end at the cut are named (by the smallest conversation id that
has them, which with the depth is the trie's node); the upper trie is built of
the upper halves, and every cut prefix is the root of a lower forest built of
the lower halves.  Both are cut at half depth again, all pieces of one length
in one job, so a trie of depth D takes log2(D) jobs, not D, and every turn
takes part in one cut.  A piece is told from others by its root's name and the
digest of its upper half; digests of pieces are made beforehand from those of
their halves (SHA-256 of SHA-256, so equal digests are equal turns).

Totals of subtrees are grafted upward in the opposite order: within pieces of
one length every node's total is known; the lower forests' totals are summed at
the cut prefix they hang from, then added to all nodes of the upper piece on the
way to it.  A node gets one row a level, so this takes log2(D) jobs and
O(n log D) short rows.

No job gathers a conversation or a group: names are minima with a partial
step, written, and joined back on a key that AQE splits where a third of all
conversations share a prefix (it can where both sides are plain shuffles); a
conversation that holds a third of all turns is rows spread
over all tasks.  Only the list of the conversations that end at a node, whose
SHA-256 is wanted, has to be read in order; it streams through one task in
bounded memory.  Every level is a table in the shared folder, so a lost
executor costs one level.

Defined results: turns are ordered by number (null first); turns of one number
by the digest of role and text; repeated rows are turns of their own.  Null roles and texts are empty.
Rows without a conversation id belong to none and are left out.  No
conversations: no nodes, not even a root.  A turn's text is read whole.  Extra
columns of any name are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import TOKEN_PATTERN, scratch, stored

BASE, MOST_COPIED = 20, 4             # the log's rule: conversation c begins like c - c % BASE, for fewer than MOST_COPIED turns
NODE = ["conv_id", "depth"]


def ordered(log: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words) of every turn, pos counted from 1, from (conv_id, turn, role, text).

    The turns are range-partitioned in order, numbered within each range and moved on by the conversation's
    rows in the ranges before, so no conversation is sorted in one task; equal rows may part anywhere.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("salt")]
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = log.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"),
        F.regexp_count(text, F.lit(TOKEN_PATTERN)).cast("long").alias("words"), F.rand(5).alias("salt"))
    ranged = (turns.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
              .withColumn("nth", F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order))))
    ranged = stored(ranged.select("conv_id", "part", "nth", "digest", "words"), "turns")
    ahead = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n")).select(
        "conv_id", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    return ranged.join(before, ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("nth")).alias("pos"), "digest", "words")


def lengths(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that have turns."""
    return turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))


def rebuilt(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths after each conversation's first turns are those of its base conversation.

    Conversation c takes the first h turns of c - c % BASE (all if it has fewer, none if it is absent), then its
    own after its first h, h being the CRC-32 of its decimal id modulo MOST_COPIED.  At most MOST_COPIED - 1
    turns of a base conversation are copied, to fewer than 2 * BASE conversations.
    """
    base = F.col("conv_id") % BASE == 0
    heads = turns.filter(base & (F.col("pos") < MOST_COPIED))
    have = convs.filter(base).select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns"))
    plan = (convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_COPIED)
            .withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE).join(have, "base", "left")
            .withColumn("copied", F.least("h", F.coalesce("base_turns", F.lit(0)))))
    plan = stored(plan.select("conv_id", "base", "h", "copied",
                              (F.col("copied") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("n_turns")),
                  "rebuilt")
    own = turns.join(plan.select("conv_id", "h", "copied"), "conv_id").filter("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("copied")).alias("pos"), "digest", "words")
    copies = (plan.filter("copied > 0").select("conv_id", "base", "copied")
              .join(heads.withColumnRenamed("conv_id", "base"), "base").filter("pos <= copied")
              .select("conv_id", "pos", "digest", "words"))
    return own.unionByName(copies), plan.select("conv_id", "n_turns")


def _levels(spark: SparkSession, path: str, upto: int, first: int, schema) -> DataFrame | None:
    """Rows of the tables path/first .. path/upto, which exist."""
    paths = [f"{path}/{j}" for j in range(first, upto + 1)]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def _halves(turns: DataFrame, n_levels: int) -> list[DataFrame]:
    """For every length 2^j below the whole: (conv_id, i, digest, words) of the full pieces, piece i starting
    after turn i * 2^j; `words` are those of its last turn."""
    pieces = [turns.select("conv_id", (F.col("pos") - 1).alias("i"), "digest", "words")]
    for _ in range(n_levels - 1):
        left = F.col("i") % 2 == 0
        pair = pieces[-1].groupBy("conv_id", F.shiftright("i", 1).alias("i")).agg(
            F.max(F.when(left, F.col("digest"))).alias("left"), F.max(F.when(~left, F.col("digest"))).alias("right"),
            F.max(F.when(~left, F.col("words"))).alias("words"))
        pieces.append(stored(pair.filter("right IS NOT NULL").select(
            "conv_id", "i", F.unhex(F.sha2(F.concat("left", "right"), 256)).alias("digest"), "words"), "pieces"))
    return pieces


def named(turns: DataFrame, n_levels: int) -> DataFrame:
    """(conv_id, depth, name, words) of every turn: name is the smallest conversation with the same first `depth` turns."""
    spark, path, schema = turns.sparkSession, scratch(turns.sparkSession, "names"), "conv_id long, depth long, name long, words long"
    pieces = _halves(turns, n_levels)
    for j in range(n_levels, 0, -1):                     # pieces of length 2^j, cut at half
        half = 1 << (j - 1)
        cuts = pieces[j - 1].filter("i % 2 = 0").select(
            "conv_id", ((F.col("i") + 1) * half).alias("depth"), "digest", "words")
        if j == n_levels:
            cuts = cuts.withColumn("root", F.lit(0).cast("long"))
        else:
            roots = _levels(spark, path, n_levels, j + 1, schema).select(
                "conv_id", (F.col("depth") + half).alias("depth"), F.col("name").alias("root"))
            cuts = cuts.join(roots, NODE, "left").withColumn("root", F.coalesce("root", F.lit(0)))
        own = ["depth", "root", "digest"]
        names = stored(cuts.groupBy(*own).agg(F.min("conv_id").alias("name")), "prefixes")
        cuts.join(names, own).select("conv_id", "depth", "name", "words").write.parquet(f"{path}/{j}")
    return _levels(spark, path, n_levels, 1, schema)


def _grafted(names: DataFrame, own: DataFrame, n_levels: int) -> DataFrame:
    """(conv_id, depth, leaves, tokens): subtree totals of every node; `own`: (…, parent, leaves, tokens) of the nodes alone."""
    spark, path, schema = names.sparkSession, scratch(names.sparkSession, "totals"), "conv_id long, depth long, leaves long, tokens long"
    totals = [F.sum(c).cast("long").alias(c) for c in ("leaves", "tokens")]
    own.select(*NODE, "leaves", "tokens").write.parquet(f"{path}/0")
    for j in range(1, n_levels + 1):
        half = 1 << (j - 1)
        first = (F.col("depth") - 1) % (2 * half) == half               # depths right below a cut
        heads = _levels(spark, path, j - 1, 0, schema).filter(first).groupBy(*NODE).agg(*totals)
        cut = (heads.join(own.filter(first).select(*NODE, "parent"), NODE)
               .groupBy(F.col("parent").alias("conv_id"), (F.expr(f"(depth - 1) div {half}") - 1).alias("piece")).agg(*totals))
        cut = stored(cut, "cuts")
        way = names.withColumn("piece", F.expr(f"(depth - 1) div {half}")).filter("piece % 2 = 0")
        (way.join(cut, ["conv_id", "piece"]).groupBy(F.col("name").alias("conv_id"), "depth").agg(*totals)
         .write.parquet(f"{path}/{j}"))
    return _levels(spark, path, n_levels, 0, schema).groupBy(*NODE).agg(*totals)


def _ends(names: DataFrame, convs: DataFrame, root: int) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes where a conversation ends."""
    ended = convs.filter("n_turns > 0").select("conv_id", F.col("n_turns").alias("depth")).join(names, NODE)
    rows = ended.select(F.col("name").alias("node"), "depth", "conv_id").unionByName(
        convs.filter("n_turns = 0").select(F.lit(root).cast("long").alias("node"), F.lit(0).cast("long").alias("depth"), "conv_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = digest = None
        for b in batches:
            done: list[tuple] = []
            for n, d, c in zip(*(x.to_pylist() for x in b.columns)):
                if node != (n, d):
                    if node:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (n, d), hashlib.sha256(str(c).encode())
                else:
                    digest.update(b",%d" % c)
            yield batch(done)
        if node:
            yield batch([(*node, digest.hexdigest())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                           pa.array(columns[2], pa.string())], names=[*NODE, "ends_sha256"])

    return (rows.repartition("node", "depth").sortWithinPartitions("node", "depth", "conv_id")
            .select("node", "depth", "conv_id").mapInArrow(run, "conv_id long, depth long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    `turns`: (conv_id, pos, digest, words), positions without gaps from 1; `convs`: (conv_id, n_turns) of all
    conversations, those without turns included.
    """
    turns, convs = stored(turns, "sequences"), stored(convs, "conversations")
    spark = turns.sparkSession
    whole = convs.agg(F.min("conv_id").alias("root"), F.count("*").alias("n"), F.max("n_turns").alias("depth")).first()
    empty_hash, long = hashlib.sha256(b"").hexdigest(), lambda x: F.lit(x).cast("long")
    n_levels = max(whole["depth"] or 0, 1).bit_length()                  # every depth is below 2^n_levels
    names = named(turns, n_levels)
    nodes = names.groupBy(F.col("name").alias("conv_id"), "depth").agg(F.count("*").alias("n_convs"), F.max("words").alias("words"))
    above = names.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    nodes = stored(nodes.join(above, NODE, "left").withColumn("parent", F.coalesce("parent", long(whole["root"]))), "nodes")
    children = nodes.groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    own = nodes.join(children, NODE, "left").select(
        *NODE, "parent", "n_convs", F.coalesce("n_children", long(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), long(1)).otherwise(long(0)).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("tokens"))
    own = stored(own, "nodes")
    totals = _grafted(names, own, n_levels)
    inner = own.drop("leaves", "tokens").join(totals, NODE)
    inner = stored(inner.select(*NODE, F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                                F.col("leaves").alias("n_leaves"), F.col("tokens").alias("saved_tokens")), "trie")
    tops = inner.filter("depth = 1").agg(F.count("*").alias("n"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("tokens"))
    root = tops.filter(F.lit(whole["n"] > 0)).select(
        long(whole["root"]).alias("conv_id"), long(0).alias("depth"), long(None).alias("parent_conv_id"),
        long(whole["n"]).alias("n_convs"), F.col("n").alias("n_children"),
        F.greatest(F.coalesce("leaves", long(0)), long(1)).alias("n_leaves"), F.coalesce("tokens", long(0)).alias("saved_tokens"))
    return inner.unionByName(root).join(_ends(names, convs, whole["root"] or 0), NODE, "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(empty_hash)))
