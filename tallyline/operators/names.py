"""Entity-name normalisation without a Python UDF.

Rule (per name): exact override -> else the LONGEST dictionary entry d such
that name starts with d + ' ' -> else the name unchanged.

"name starts with d + ' '" holds exactly when d equals one of the name's
word-boundary prefixes (first k space-separated words, k < #words).  So the
theta join "startswith" becomes an equi-join of exploded prefixes against
the dictionary, followed by `max_by(entry, length(entry))`.  It runs once
per DISTINCT name and the result is joined back on the name; no dictionary
is collected to the driver and no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import new_path


def word_prefixes(name: Column) -> Column:
    """Array of the first-k-words prefixes of `name`, k = 1 .. words-1."""
    words = F.split(name, " ")
    n = F.size(words)
    ks = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(ks, lambda k: F.array_join(F.slice(words, 1, k), " "))


def resolve_names(names: DataFrame, dictionary: DataFrame, overrides: DataFrame | None = None,
                  name_col: str = "name", dict_col: str = "team") -> DataFrame:
    """D14 `join_longest_prefix` over DISTINCT names.

    Returns (name, canonical, matched) where matched says whether the
    override map or a prefix resolved the name.
    """
    distinct = names.select(F.col(name_col).alias("name")).where(F.col("name").isNotNull()).distinct()
    pref = distinct.select("name", F.explode(word_prefixes(F.col("name"))).alias("prefix"))
    d = dictionary.select(F.col(dict_col).alias("prefix")).distinct()
    best = (pref.join(d, "prefix")
            .groupBy("name").agg(F.max_by("prefix", F.length("prefix")).alias("by_prefix")))
    out = distinct.join(best, "name", "left")
    if overrides is not None:
        ov = overrides.select(F.col("name"), F.col("canonical").alias("by_map")).dropDuplicates(["name"])
        out = out.join(ov, "name", "left")
    else:
        out = out.withColumn("by_map", F.lit(None).cast("string"))
    return out.select(
        "name",
        F.coalesce("by_map", "by_prefix", "name").alias("canonical"),
        (F.col("by_map").isNotNull() | F.col("by_prefix").isNotNull()).alias("matched"))


def normalize_columns(df: DataFrame, cols: list[str], dictionary: DataFrame,
                      overrides: DataFrame | None = None, suffix: str = "_norm") -> DataFrame:
    """J17 `odds_normalize`: add `<col>_norm` for each name column.  The
    distinct names of all columns are taken in one scan, resolved and written
    to the shared folder when the plan is built, one row a name; they are then
    joined back per column (broadcast where the written size allows)."""
    names = df.select(F.explode(F.array(*cols)).alias("name"))
    res = resolve_names(names, dictionary, overrides).select("name", "canonical")
    path = new_path(df.sparkSession, "names")
    res.write.parquet(path)
    res = df.sparkSession.read.schema(res.schema).parquet(path)
    out = df
    for c in cols:
        r = res.select(F.col("name").alias(c), F.col("canonical").alias(c + suffix))
        out = out.join(r, c, "left")
    return out


def unmatched_names(names: DataFrame, dictionary: DataFrame, overrides: DataFrame | None = None,
                    name_col: str = "name") -> DataFrame:
    """J18 `odds_unmatched_names`: distinct names neither the map nor a prefix
    resolves (a name exactly equal to a dictionary entry is listed too: a
    prefix must be followed by a space), sorted."""
    r = resolve_names(names, dictionary, overrides, name_col=name_col)
    return r.filter(~F.col("matched")).select("name").orderBy("name")
