"""Benchmark decontamination by winnowing, in DataFrame functions only.

Items and documents are cut into words; the fingerprints of a text are the
smallest hash of K neighbouring words in every run of WINDOW such hashes.  Any
common span of K + WINDOW - 1 = 10 words has the same smallest hash in both
texts, so a document that holds a benchmark window holds one of the item's
fingerprints inside that window.  Documents test their hashes against the
benchmark's fingerprints in the scan itself (an in-set test, while the
benchmark has at most SET_LIMIT of them; a join beyond that); a hash is a
seed where it is in the set and the smallest of some run around it.  Only the
window starts a seed can belong to are exploded, and the windows there are
compared as text with the benchmark's.  Items of fewer than 10 words have one
window of their own length; for each such length that occurs, all starts whose
hash is in the set are compared as text.

What is shuffled is one short row per document and one per candidate start.

Defined results: null and empty texts have no words and no hits; null item
ids are not listed; items_sha256 of no item is that of the empty string.
Repeated document rows are separate rows with equal results.  With an empty
benchmark every document is clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, ascii_lower, let, stored

SPAN, K = 10, 5
WINDOW = SPAN - K + 1
SET_LIMIT = 20_000                    # fingerprints held in the plan itself
BROADCAST_ROWS = 100_000              # benchmark windows (short strings) broadcast up to here
PLACES = "array<struct<i:int,len:int>>"
MARKS = "array<struct<h:bigint,i:int,len:int,lo:int,ctx:array<string>>>"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD_PATTERN), F.lit(0))


def _grams(words: Column, k: int) -> Column:
    """Hashes of every k neighbouring words (none in shorter texts)."""
    n = F.size(words)
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, *(F.get(words, i + j) for j in range(1, k))))
    return F.when(n >= k, F.slice(hashes, 1, n - k + 1)).otherwise(F.array().cast("array<long>"))


def _windows(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(win, len, items): every distinct window with the items that have it."""
    words = items.select(F.col(item_col).cast("string").alias("item"), _words(F.col(text_col)).alias("w"))
    words = words.filter(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(SPAN)))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)
    return (words.select("item", "len", "w", F.explode(starts).alias("i"))
            .select("item", "len", F.array_join(F.slice("w", F.col("i"), F.col("len")), " ").alias("win"))
            .groupBy("win", "len").agg(F.collect_set("item").alias("items")))


def _fingerprints(items: DataFrame, text_col: str) -> DataFrame:
    """(h): winnowed hashes of the items of at least SPAN words."""
    grams = items.select(_words(F.col(text_col)).alias("w")).filter(F.size("w") >= SPAN) \
        .select(_grams(F.col("w"), K).alias("g"))
    runs = F.transform(F.sequence(F.lit(1), F.size("g") - WINDOW + 1),
                       lambda i: F.array_min(F.slice("g", i, WINDOW)))
    return grams.select(F.explode(runs).alias("h")).distinct()


def _is_smallest(g: Column, h: Column, i: Column) -> Column:
    """Is h = g[i] the smallest of some run of WINDOW hashes that contains i?"""
    runs = F.sequence(F.greatest(i - WINDOW + 1, F.lit(0)), F.least(i, F.size(g) - WINDOW))
    return F.exists(runs, lambda j: F.array_min(F.slice(g, j + 1, WINDOW)) == h)


def _around(i: Column, words: Column) -> Column:
    """Starts of the SPAN-word windows that contain the K words at i."""
    return F.sequence(F.greatest(i - WINDOW + 1, F.lit(0)), F.least(i, F.size(words) - SPAN))


def _places(starts: Column, length: int) -> Column:
    return F.transform(starts, lambda i: F.struct(i.alias("i"), F.lit(length).alias("len")))


def _tested(words: Column, hashes: dict[int, list[int]]) -> Column:
    """Candidate places (i, len) of one document, against hash sets held in the plan."""
    def long_spans(g: Column) -> Column:
        hit = F.filter(F.transform(g, lambda h, i: F.when(h.isin(hashes[SPAN]), i)), lambda i: i.isNotNull())
        seeds = F.filter(hit, lambda i: _is_smallest(g, g[i], i))
        return _places(F.array_distinct(F.flatten(F.transform(seeds, lambda i: _around(i, words)))), SPAN)

    parts = [F.array().cast(PLACES)]
    if SPAN in hashes:
        parts.append(F.when(F.size(words) >= SPAN, let(_grams(words, K), long_spans)).otherwise(parts[0]))
    def short_spans(n: int) -> Column:
        hit = F.transform(_grams(words, n), lambda h, i: F.when(h.isin(hashes[n]), i))
        return _places(F.filter(hit, lambda i: i.isNotNull()), n)

    return F.concat(*parts, *(short_spans(n) for n in sorted(set(hashes) - {SPAN})))


def _by_set(words: DataFrame, hashes: dict[int, list[int]]) -> DataFrame:
    """(rid, id, n_words, i, len, win): at least one row per document."""
    at = words.select("rid", "id", F.size("w").alias("n_words"), "w",
                      F.explode_outer(_tested(F.col("w"), hashes)).alias("at"))
    return at.select("rid", "id", "n_words", "at.i", "at.len",
                     F.array_join(F.slice("w", F.col("at.i") + 1, F.col("at.len")), " ").alias("win"))


def _by_join(words: DataFrame, known: DataFrame, lengths: list[int]) -> DataFrame:
    """The same rows for a benchmark of any size: every document fingerprint, with the words
    around it, is joined with the benchmark's.  A first row per document, which matches nothing, keeps it."""
    def mark(h, i, length, lo, ctx):
        return F.struct(h.alias("h"), i.cast("int").alias("i"), F.lit(length).alias("len"),
                        lo.cast("int").alias("lo"), ctx.alias("ctx"))

    w, none = F.col("w"), F.lit(None)

    def seeds(g: Column) -> Column:
        keep = F.filter(F.transform(g, lambda h, i: i), lambda i: _is_smallest(g, g[i], i))
        return F.transform(keep, lambda i: mark(
            g[i], i, SPAN, F.greatest(i - WINDOW + 1, F.lit(0)),
            F.slice(w, F.greatest(i - WINDOW + 1, F.lit(0)) + 1, 2 * SPAN)))

    def marks(n: int) -> Column:
        if n == SPAN:
            return let(_grams(w, K), seeds)
        return F.transform(_grams(w, n), lambda h, i: mark(h, i, n, i, F.slice(w, i + 1, n)))

    own = F.array(mark(F.xxhash64("rid"), none, 0, none, none.cast("array<string>"))).cast(MARKS)
    parts = [own, *(F.when(F.size(w) >= n, marks(n)).otherwise(F.array().cast(MARKS)) for n in lengths)]
    flat = words.select("rid", "id", F.size("w").alias("n_words"), F.explode(F.concat(*parts)).alias("m")) \
        .select("rid", "id", "n_words", "m.*")
    met = flat.join(known.withColumn("known", F.lit(True)), ["h", "len"], "left").filter("known OR len = 0")
    i = F.col("i")
    starts = F.when(F.col("len") == SPAN, F.sequence(F.greatest(i - WINDOW + 1, F.lit(0)),
                                                     F.least(i, F.col("n_words") - SPAN))) \
        .when(F.col("len") > 0, F.array(i))
    at = met.select("rid", "id", "n_words", "len", "lo", "ctx", F.explode_outer(starts).alias("i"))
    return at.select("rid", "id", "n_words", "i", "len", F.array_join(
        F.slice("ctx", F.col("i") - F.col("lo") + 1, F.col("len")), " ").alias("win"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", set_limit: int = SET_LIMIT) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of `docs`."""
    windows = stored(_windows(items, item_col, item_text), "windows")
    own = F.coalesce(*(F.when(F.col("len") == n, _grams(F.split("win", " "), n)[0]) for n in range(1, SPAN)))
    known = stored(_fingerprints(items, item_text).withColumn("len", F.lit(SPAN)).unionByName(
        windows.filter(F.col("len") < SPAN).select(own.alias("h"), "len").distinct()), "known")
    words = docs.select(F.col(id_col).alias("id"), _words(F.col(text_col)).alias("w"),
                        F.monotonically_increasing_id().alias("rid"))
    if known.count() <= set_limit:
        hashes: dict[int, list[int]] = {}
        for r in known.orderBy("len", "h").toLocalIterator():
            hashes.setdefault(r.len, []).append(r.h)
        cand = _by_set(words, hashes)
    else:
        cand = _by_join(words, known, sorted(r.len for r in known.select("len").distinct().toLocalIterator()))

    few = windows.count() <= BROADCAST_ROWS
    hits = cand.join(F.broadcast(windows) if few else windows, ["win", "len"], "left")
    place = F.when(F.col("items").isNotNull(), F.struct("i", "len"))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "places", lambda p: F.sequence(p["i"], p["i"] + p["len"] - 1)))))
    ids = F.array_sort(F.array_distinct(F.flatten("lists")))
    out = (hits.groupBy("rid").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"),
                                   F.collect_set(place).alias("places"), F.collect_set("items").alias("lists"))
           .select(F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"),
                   covered.cast("long").alias("n_hit"), ids.alias("ids")))
    return out.select(id_col, "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))
