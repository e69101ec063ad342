"""Quality rules: a threshold table compiled into one Spark projection.

`THRESHOLDS` names a numerator, a denominator and the range the ratio must
lie in.  `quality_rules` computes every count natively (no user function, no
shuffle), and the verdict is one boolean expression built from the table.

Defined results: null and empty text have no words, so every count is 0 and
the base rule (fewer than 50 words) fails.  A ratio over 0 passes.  Rows are
judged one by one: repeated rows get equal results, an empty table gives an
empty table.  Only the id and text columns are read; others cannot clash.

Repeated 3-word windows are found on 64-bit hashes of the windows of one
text, sorted with their positions: n log n in the words of that text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let

# Symbols and base thresholds of the rule set.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = ("the and of to in is that for on with as at by be this "
              "der die das und von zu den mit ist ein eine für "
              "le la les de des et un une que en dans pour est "
              "el los las y del por con una se no es").split()

# rule, numerator, denominator, smallest and largest allowed ratio (None: open)
THRESHOLDS = (
    ("mean_word_length", "word_chars", "n_words", 2.0, 14.0),
    ("symbol_share", "n_symbols", "n_words", None, 0.5),
    ("shouted_share", "n_upper", "word_chars", None, 0.5),
    ("bang_share", "n_bangs", "n_words", None, 0.5),
    ("dup_line_share", "n_dup_lines", "n_lines", None, 0.6),
    ("repeat_word_share", "n_repeat_words", "n_words", None, 0.5),
    ("stop_word_share", "n_stop_words", "n_words", 0.01, None),
)


def _words(text: Column) -> Column:
    """Maximal runs of non-space characters: plain replaces and a one-character
    split are cheaper than a regular expression over the whole text."""
    one = reduce(lambda c, x: F.replace(c, F.lit(x), F.lit(" ")), SPACES[1:], text)
    return F.array_remove(F.split(one, " "), "")


def _repeat_words(words: Column, n: Column) -> Column:
    """Words lying in a 3-word window that occurs at least twice in the text."""
    windows = F.slice(F.transform(words, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2))),
                      1, n - 2)

    def covered(h: Column) -> Column:
        def places(s: Column) -> Column:
            same = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
            return F.size(F.array_distinct(F.flatten(F.transform(
                same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
        rows = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(rows, places))

    return F.when(n >= 3, let(windows, covered)).otherwise(F.lit(0)).cast("long")


def _verdict() -> Column:
    def one(num: str, den: str, lo: float | None, hi: float | None) -> Column:
        ratio = F.col(num) / F.when(F.col(den) > 0, F.col(den))
        tests = [ratio >= lo] * (lo is not None) + [ratio <= hi] * (hi is not None)
        return F.coalesce(reduce(Column.__and__, tests), F.lit(True))
    return reduce(Column.__and__, [one(*t[1:]) for t in THRESHOLDS])


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts, base_failed, kept) for every row of `df`."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = df.select(id_col, text.alias("__t")).withColumn("__w", _words(F.col("__t")))
    lines = F.filter(F.split("__t", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    counted = base.select(
        id_col,
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.regexp_count("__t", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("__w"), F.size("__w")).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.length("__t") - F.length(F.replace("__t", F.lit("!"), F.lit("")))).cast("long").alias("n_bangs"),
        F.regexp_count("__t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.size(F.filter("__w", lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & _verdict())
