"""Near-duplicate documents by circulant MinHash, bands and exact Jaccard.

A document's set is its distinct shingles of `shingle` words (4 in the query's
contract, the default; the pipeline's stage takes 5).  Two permutations give all
signature coordinates: the first spreads a shingle's hash over UNIVERSE
places, the second is read there and at the next LANES - 1 places (its
circular shifts), so a signature is the minimum over a document's shingles of
LANES neighbouring entries.  BANDS bands of ROWS coordinates make buckets: two
sets of Jaccard 0.8 share none with probability 3e-6.

Equal sets become one representative first (a group of copies of any size is
one row from there on).  In every bucket the member that meets most others in
its buckets is the pivot; members are checked against it exactly, and verified
links make components.  Buckets that still span several components then give
the remaining pairs of different components, tested the same way.  A pair is
skipped only where a link is ruled out: by exact bounds on the intersection
(sizes; what either member lacks of a pivot both were checked against, kept as
a bitmap, and the little they hold outside it), or by more than 38 of 160
differing one-bit coordinates (probability 2e-7 at 0.8).  So near copies of
one text cost a row each, not a pair each, and no link is capped.

Defined results: a text without words has an empty set and no links: its
component is its own id.  A row with a null id has its counts, a null
component and kept true; it links with nothing.  Rows that repeat an id with
equal text are one document: equal results.  The smallest id names a component,
so no ties are left.  A text of any length makes its whole set.  Only the two
columns named are read, so extra columns of any name do no harm.  Empty table:
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField
from xxhash import xxh3_64_intdigest

from .common import map_texts, stored
from .components import components

SHINGLE, PERCENT = 4, 80
BANDS, ROWS = 32, 5
LANES, UNIVERSE, SEED = BANDS * ROWS, 1 << 20, 5
MAX_DIFFERING_BITS = 38
WORDS = 8                             # 64-bit words of the bitmaps of lacked shingles
LARGE_BUCKET = 64                     # from here on, every member is checked against the pivot (a cost choice, not a cap)
BROADCAST_ROWS = 200_000              # ids broadcast up to here (about 16 MB), joined by shuffle beyond

SIGNATURE = [StructField("n_shingles", LongType()), StructField("set_key", BinaryType()),
             StructField("bands", ArrayType(LongType())), StructField("bits", ArrayType(LongType()))]
SET = [StructField("n_shingles", LongType()), StructField("key", BinaryType()),
       StructField("shingles", ArrayType(LongType()))]
TEXT, TEXT_KEY = "__minhash_text", "__minhash_text_key"


def shingles(text: bytes | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; the whole sequence if shorter; empty without words."""
    words = (text or b"").lower().split()       # bytes.lower: A-Z only; bytes.split: the six ASCII spaces
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        n = min(k, len(h))
        out = np.full(max(0, len(h) - n + 1) if n else 0, n, np.uint64)
        for i in range(n):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[i:i + len(out)]
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(out ^ (out >> np.uint64(32)))


def set_key(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def signer(k: int = SHINGLE):
    """Function from texts to the SIGNATURE columns, over k-word shingles."""
    rng = np.random.default_rng(SEED)
    spread = rng.permutation(UNIVERSE)
    values = rng.permutation(UNIVERSE).astype(np.int32)
    circle = np.lib.stride_tricks.sliding_window_view(np.concatenate([values, values[:LANES - 1]]), LANES)
    shift = np.uint64(64 - (UNIVERSE.bit_length() - 1))
    salt = rng.integers(1, 1 << 62, (BANDS, 1), np.uint64)

    def one(text):
        s = shingles(text, k)
        if not len(s):
            return 0, None, None, None
        at = spread[(s >> shift).astype(np.int64)]
        sig = np.full(LANES, UNIVERSE, np.int32)
        for i in range(0, len(at), 1024):
            np.minimum(sig, circle[at[i:i + 1024]].min(axis=0), out=sig)
        with np.errstate(over="ignore"):
            h = salt[:, 0].copy()
            for r in range(ROWS):
                h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + sig[r::ROWS].astype(np.uint64)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        bits = np.packbits(sig & 1).tobytes().ljust(24, b"\0")
        return len(s), set_key(s), h.view(np.int64), np.frombuffer(bits, np.int64)

    return lambda batch: [list(c) for c in zip(*map(one, batch))] or [[] for _ in SIGNATURE]


def _set_of(text, k):
    s = shingles(text, k)
    return len(s), set_key(s), s.view(np.int64)


def _sets(docs: DataFrame, reps: DataFrame, rids: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(rid, shingles) of the representatives named in `rids`, from their texts."""
    want = reps.join(rids.select("rid").distinct(), "rid", "left_semi").select("rid", "first_doc", "first_text", "set_key")
    want = stored(want, "want")
    if want.count() <= BROADCAST_ROWS:
        want = F.broadcast(want)
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("first_doc"), F.xxhash64(text).alias("first_text"), text.alias("text"))
    made = map_texts(texts.join(want, ["first_doc", "first_text"]), ["rid", "set_key"], "text", SET,
                     lambda: lambda batch: [list(c) for c in zip(*(_set_of(t, k) for t in batch))] or [[] for _ in SET])
    return stored(made.filter("key = set_key").select("rid", "shingles").dropDuplicates(["rid"]), "sets")


def _may_link(x: str, y: str, bits: int | None) -> Column:
    """False only where sizes, or more than `bits` differing one-bit coordinates, rule the similarity out."""
    c = lambda side, name: F.col(f"{side}.{name}")
    sizes = 100 * F.least(c(x, "n"), c(y, "n")) >= PERCENT * F.greatest(c(x, "n"), c(y, "n"))
    if bits is None:
        return sizes
    differing = sum((F.bit_count(c(x, "bits")[i].bitwiseXOR(c(y, "bits")[i])) for i in range(3)), F.lit(0))
    return sizes & (differing <= bits)


def _bitmap(hashes: Column) -> Column:
    """Each hash sets one of 64 * WORDS bits: as many bits as hashes at most."""
    def word(k: int) -> Column:
        none = F.lit(0).cast("long")
        bit = lambda h: F.when(
            F.shiftrightunsigned(h, 6).bitwiseAND(WORDS - 1) == k,
            F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))).otherwise(none)
        return F.aggregate(hashes, none, lambda acc, h: acc.bitwiseOR(bit(h)))
    return F.array(*map(word, range(WORDS)))


def _may_link_beside_pivot(x: str, y: str) -> Column:
    """False only where what two members lack of a pivot both were checked against rules a link out.

    |x & y| = |pivot| - |lacked by x or y| + |x & y outside the pivot|.  The bitmap has at most a bit for
    each lacked shingle; `beside` bounds what a member can share outside the pivot.
    """
    c = lambda side, name: F.col(f"{side}.{name}")
    lacked = sum((F.bit_count(c(x, "lacks")[k].bitwiseOR(c(y, "lacks")[k])) for k in range(WORDS)), F.lit(0))
    most = c(x, "pivot_n") - lacked + F.least(c(x, "beside"), c(y, "beside"))
    possible = 100 * most >= PERCENT * (c(x, "n") + c(y, "n") - most)
    same = (c(x, "near") == c(y, "near")) & (c(x, "counted") == c(y, "counted"))
    return F.when(same, possible).otherwise(F.lit(True))


def _beside(seen: DataFrame) -> DataFrame:
    """`seen` with beside and counted: how many shingles outside its pivot a set can share with another.

    For sets at least half of which lies in the pivot (counted), those outside that a second such set of the
    same pivot has as well; for the others, all outside.
    """
    counted = 2 * F.size("extra") <= F.col("common") + F.size("extra")
    flat = seen.filter(counted).select("rid", "near", F.explode("extra").alias("h"))
    shared = flat.groupBy("near", "h").agg(F.count("*").alias("c")).filter("c > 1").select("near", "h")
    held = flat.join(shared, ["near", "h"], "left_semi").groupBy("rid").agg(F.count("*").alias("shared"))
    return seen.join(held, "rid", "left").select(
        "rid", "near", "common", "lacks", "pivot_n", counted.alias("counted"),
        F.when(counted, F.coalesce("shared", F.lit(0))).otherwise(F.size("extra")).alias("beside"))


def _checked(pairs: DataFrame, docs, reps, id_col, text_col, k) -> DataFrame:
    """(a, b, linked, common, lacks, extra) from full sets: does the pair reach the similarity, how many
    shingles have both, a bitmap of what b lacks of a, and what b has beside a."""
    pairs = stored(pairs.distinct(), "pairs")
    if pairs.isEmpty():
        return pairs.select("a", "b", F.lit(True).alias("linked"), F.lit(0).alias("common"),
                            F.array().cast("array<bigint>").alias("lacks"),
                            F.array().cast("array<bigint>").alias("extra"))
    both = pairs.select(F.col("a").alias("rid")).unionAll(pairs.select(F.col("b").alias("rid")))
    sets = _sets(docs, reps, both, id_col, text_col, k)
    x = sets.select(F.col("rid").alias("a"), F.col("shingles").alias("sa"))
    y = sets.select(F.col("rid").alias("b"), F.col("shingles").alias("sb"))
    met = pairs.join(x, "a").join(y, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    linked = 100 * F.col("common") >= PERCENT * (F.size("sa") + F.size("sb") - F.col("common"))
    return stored(met.select("a", "b", linked.alias("linked"), "common",
                             _bitmap(F.array_except("sa", "sb")).alias("lacks"),
                             F.array_except("sb", "sa").alias("extra")), "checked")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    differing_bits: int | None = MAX_DIFFERING_BITS) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of `docs`, by shingles of `shingle` words.

    `differing_bits` None checks every pair of a bucket that sizes and pivots do not rule out.
    """
    keyed = docs.select(id_col, F.col(text_col).cast("string").alias(TEXT)).withColumn(TEXT_KEY, F.xxhash64(TEXT))
    sig = stored(map_texts(keyed, [id_col, TEXT_KEY], TEXT, SIGNATURE, lambda: signer(shingle)), "signatures")
    reps = (sig.filter(F.col("set_key").isNotNull() & F.col(id_col).isNotNull())
            .groupBy("set_key").agg(F.min(F.struct(F.col(id_col).alias("id"), F.col(TEXT_KEY).alias("text"))).alias("first"),
                                    F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("bits").alias("bits"))
            .select("set_key", F.col("first.id").alias("first_doc"), F.col("first.text").alias("first_text"), "n", "bands", "bits")
            .withColumn("rid", F.monotonically_increasing_id()))
    reps = stored(reps, "reps")

    flat = reps.select("rid", F.explode("bands").alias("bucket"))
    counts = flat.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    members = stored(flat.join(counts, "bucket"), "members")

    # How many others a set meets in its buckets; the set most others resemble meets most.
    met = members.groupBy("rid").agg(F.sum("members").alias("met"))
    members = stored(members.join(met, "rid").join(reps.select("rid", "n", "bits"), "rid"), "members")
    pivots = members.groupBy("bucket").agg(F.min(F.struct(
        (-F.col("met")).alias("rank"), "rid", "n", "bits")).alias("p")).select("bucket", "p.*").drop("rank")
    first = (members.alias("x").join(pivots.alias("y"), "bucket")
             .filter((F.col("x.rid") != F.col("y.rid")) & ((F.col("x.members") >= LARGE_BUCKET) | _may_link("x", "y", differing_bits)))
             .select(F.col("y.rid").alias("a"), F.col("x.rid").alias("b")))
    checked = _checked(first, docs, reps, id_col, text_col, shingle)
    links = checked.filter("linked").select("a", "b")
    comp = stored(components(links), "components")

    # Of the pivots a set was checked against the one that meets most; such a pivot counts itself as well.
    rank = members.select(F.col("rid").alias("a"), F.col("met"), F.col("n").alias("pivot_n")).distinct()
    itself = checked.select("a").distinct().join(rank, "a").select(
        "a", F.col("a").alias("b"), F.col("pivot_n").cast("int").alias("common"),
        F.array_repeat(F.lit(0).cast("long"), WORDS).alias("lacks"), F.array().cast("array<bigint>").alias("extra"),
        "met", "pivot_n")
    seen = checked.select("a", "b", "common", "lacks", "extra").join(rank, "a").unionByName(itself).groupBy(
        F.col("b").alias("rid")).agg(F.max(F.struct("met", (-F.col("a")).alias("a"), "common", "lacks", "extra", "pivot_n"))
                                     .alias("t")).select("rid", (-F.col("t.a")).alias("near"), "t.common", "t.lacks",
                                                         "t.extra", "t.pivot_n")
    seen = _beside(stored(seen, "seen"))

    # Pairs of different components that some bucket still holds together.
    left = (members.join(pivots.select("bucket", F.col("rid").alias("pivot")), "bucket").filter("rid <> pivot")
            .join(comp.select(F.col("node").alias("rid"), "comp"), "rid", "left")
            .join(comp.select(F.col("node").alias("pivot"), F.col("comp").alias("main")), "pivot", "left")
            .withColumns({"comp": F.coalesce("comp", "rid"), "main": F.coalesce("main", "pivot")}))
    left = stored(left.join(seen, "rid", "left"), "left")
    outside = left.filter("comp <> main")
    rest = (outside.alias("x").join(left.alias("y"), "bucket")
            .filter((F.col("x.comp") != F.col("y.comp")) & _may_link("x", "y", differing_bits) & _may_link_beside_pivot("x", "y")
                    & ((F.col("y.comp") == F.col("y.main")) | (F.col("x.rid") < F.col("y.rid"))))
            .select(F.least("x.rid", "y.rid").alias("a"), F.greatest("x.rid", "y.rid").alias("b")))
    more = _checked(rest, docs, reps, id_col, text_col, shingle).filter("linked").select("a", "b")
    if not more.isEmpty():
        comp = stored(components(links.unionAll(more)), "components")

    first_docs = comp.join(reps.select(F.col("rid").alias("node"), "first_doc"), "node")
    named = first_docs.join(first_docs.groupBy("comp").agg(F.min("first_doc").alias("component_id")), "comp") \
        .select(F.col("node").alias("rid"), "component_id")
    named = reps.select("rid", "set_key", "first_doc").join(named, "rid", "left").select(
        "set_key", F.coalesce("component_id", "first_doc").alias("component_id"))
    out = sig.select(id_col, "n_shingles", "set_key").join(named, "set_key", "left")
    own = F.when(F.col(id_col).isNotNull(), F.coalesce("component_id", id_col))
    return out.select(id_col, "n_shingles", own.alias("component_id"), F.col(id_col).eqNullSafe(own).alias("kept"))
