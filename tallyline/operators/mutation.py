"""Table mutation as DataFrame -> DataFrame functions.

Plain Parquet tables have no MERGE/UPDATE/DELETE, so each operation here
returns the NEW table state as a DataFrame; `sources.tables` publishes it,
as a new path or partition by partition.  Every operation is one plan:

* merge / update-from-source : one join on the key (sort-merge, or a
  broadcast chosen by AQE from measured sizes), then a projection;
* update / delete            : a projection / filter, no shuffle;
* window refresh             : filter + union (+ distinct on the slice).

SQL NULL semantics follow the reference's statements: a NULL predicate
neither updates (UPDATE ... WHERE) nor deletes (DELETE ... WHERE); a NULL
in a MERGE source column overwrites the target (SET t.c = s.c).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_M = "__matched"


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def assert_unique(src: DataFrame, keys, dedupe_by: Sequence[str] | None = None) -> DataFrame:
    """B12 `merge_ambiguity_check`: keys matched by more than one source row
    (Delta's MERGE fails on these).  Returns the offending keys with their
    row counts; with `dedupe_by` returns the source reduced to the latest row
    per key instead."""
    ks = _keys(keys)
    if dedupe_by:
        others = [c for c in src.columns if c not in ks]
        g = src.groupBy(*ks).agg(F.max_by(F.struct(*others), F.struct(*dedupe_by)).alias("_r"))
        return g.select(*ks, *[F.col("_r")[c].alias(c) for c in others])
    return src.groupBy(*ks).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def unique_source(src: DataFrame, keys) -> DataFrame:
    """B12 inside a plan: `src`, or an error when it runs if a key has several rows.

    A partial aggregate on the keys, in the partitioning the join that follows
    needs.  Rows with a NULL in their key match nothing, are no ambiguity and
    are all kept.  `assert_unique(..., dedupe_by=...)` is the way to choose among
    rows instead.
    """
    ks = _keys(keys)
    others = [c for c in src.columns if c not in ks]
    missing = F.lit(False)
    for k in ks:
        missing = missing | F.col(k).isNull()
    solo = F.when(missing, F.monotonically_increasing_id())               # a group of its own for every such row
    g = src.groupBy(*ks, solo.alias("__solo")).agg(
        F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(F.lit(0).alias("__0"), *others)).alias("__row"))
    named = F.concat_ws(", ", *(F.concat(F.lit(f"{k} = "), F.col(k).cast("string")) for k in ks))
    several = F.raise_error(F.concat(F.lit("MERGE: "), F.col("__n").cast("string"), F.lit(" source rows for "), named))
    row = F.when(F.col("__n") > 1, several).otherwise(F.col("__row"))
    checked = g.select(*ks, row.alias("__row"))
    return checked.select(*[F.col(c) if c in ks else F.col("__row")[c].alias(c) for c in src.columns],
                          F.col("__row.__0").alias("__checked"))


def merge_upsert(tgt: DataFrame, src: DataFrame, keys, preserve_non_null: bool = False) -> DataFrame:
    """B6 `merge_upsert_all`: WHEN MATCHED UPDATE SET * / WHEN NOT MATCHED
    INSERT *.  One full outer join on the key.  Columns the source lacks
    keep the target value (Q11); `preserve_non_null=True` keeps the target
    value where the source has NULL (Q10 'corrected').  Several source rows of
    one key are an error when the plan runs (B12)."""
    ks = _keys(keys)
    s = unique_source(src, ks).select(
        *[F.col(c).alias(f"s__{c}") if c not in ks else F.col(c) for c in src.columns],
        (F.col("__checked") == 0).alias(_M))
    t = tgt.withColumn("__in_t", F.lit(True))
    j = t.join(s, ks, "full_outer")
    cols = []
    for c in tgt.columns:
        if c in ks:
            cols.append(F.col(c))
        elif c in src.columns:
            sv = F.col(f"s__{c}")
            if preserve_non_null:
                sv = F.coalesce(sv, F.col(c))
            cols.append(F.when(F.col(_M).isNotNull(), sv).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    for c in src.columns:          # schema evolution: new source columns are added
        if c not in tgt.columns:
            cols.append(F.col(f"s__{c}").alias(c))
    return j.select(*cols)


def merge_update(tgt: DataFrame, src: DataFrame, keys, cols: Sequence[str] | Mapping[str, str] | None = None,
                 target_pred: Column | None = None, exprs: Mapping[str, Column] | None = None) -> DataFrame:
    """WHEN MATCHED THEN UPDATE SET (no insert).

    cols        : target columns to set from the same-named source column,
                  or a mapping target_col -> source_col.
    exprs       : target_col -> expression over SOURCE columns (B10 computed
                  SET: CASE, date formatting ...), evaluated before the join.
    target_pred : extra ON-clause predicate on the TARGET (B8: only rows
                  with home_score IS NULL); NULL counts as not matched.
    Several source rows of one key are an error when the plan runs (B12); a
    NULL source value overwrites the target (plain SET semantics)."""
    ks = _keys(keys)
    mapping = {c: c for c in (cols or [])} if not isinstance(cols, Mapping) else dict(cols)
    exprs = dict(exprs or {})
    sel = [F.col(k) for k in ks]
    sel += [F.col(sc).alias(f"s__{tc}") for tc, sc in mapping.items()]
    sel += [e.alias(f"s__{tc}") for tc, e in exprs.items()]
    s = unique_source(src.select(*sel), ks).withColumn(_M, F.col("__checked") == 0).drop("__checked")
    j = tgt.join(s, ks, "left")
    hit = F.col(_M).isNotNull()
    if target_pred is not None:
        hit = hit & F.coalesce(target_pred, F.lit(False))
    targets = list(mapping) + list(exprs)
    out = []
    for c in tgt.columns:
        out.append(F.when(hit, F.col(f"s__{c}")).otherwise(F.col(c)).alias(c) if c in targets else F.col(c))
    for c in targets:              # SET of a column the target lacks adds it (ALTER + SET)
        if c not in tgt.columns:
            out.append(F.when(hit, F.col(f"s__{c}")).alias(c))
    return j.select(*out)


def fill_null(tgt: DataFrame, src: DataFrame, keys, col: str, src_col: str | None = None) -> DataFrame:
    """B11 `merge_fill_null_only`: set `col` only where the target value is
    NULL and the source has a value."""
    ks = _keys(keys)
    s = src.select(*ks, F.col(src_col or col).alias("__fill")).filter(F.col("__fill").isNotNull())
    s = unique_source(s, ks).drop("__checked")
    j = tgt.join(s, ks, "left")
    return j.select(*[F.coalesce(F.col(c), F.col("__fill")).alias(c) if c == col else F.col(c)
                      for c in tgt.columns])


def update(tgt: DataFrame, pred: Column | None, exprs: Mapping[str, Column]) -> DataFrame:
    """B13 `update_where`: UPDATE t SET c = e WHERE pred (NULL pred -> row
    unchanged).  All SET expressions see the OLD row, as in SQL."""
    hit = F.lit(True) if pred is None else F.coalesce(pred, F.lit(False))
    out = [F.when(hit, exprs[c]).otherwise(F.col(c)).alias(c) if c in exprs else F.col(c) for c in tgt.columns]
    out += [F.when(hit, e).alias(c) for c, e in exprs.items() if c not in tgt.columns]
    return tgt.select(*out)


def update_in(tgt: DataFrame, keys_df: DataFrame, key: str, exprs: Mapping[str, Column],
              keys_col: str | None = None) -> DataFrame:
    """B14 `update_where_in_subquery`: UPDATE ... WHERE key IN (SELECT ...).
    A left join to the DISTINCT keys (no fan-out) plus a match marker."""
    k = keys_df.select(F.col(keys_col or key).alias(key)).distinct().withColumn("__in", F.lit(True))
    j = tgt.join(k, key, "left")
    return update(j, F.col("__in").isNotNull(), exprs).drop("__in")


def delete(tgt: DataFrame, pred: Column) -> DataFrame:
    """B15 `delete_where`: keep rows where pred is FALSE or NULL."""
    return tgt.filter(~F.coalesce(pred, F.lit(False)))


def insert(tgt: DataFrame, rows: DataFrame, distinct: bool = False) -> DataFrame:
    """B16 `insert_select`: INSERT INTO ... SELECT [DISTINCT] (by name;
    columns the rows lack become NULL)."""
    r = rows.distinct() if distinct else rows
    return tgt.unionByName(r.select(*[c for c in r.columns if c in tgt.columns]), allowMissingColumns=True)


def refresh_window(tgt: DataFrame, src: DataFrame, date_col: str, as_of, before: int = 7,
                   after: int = 7) -> DataFrame:
    """B17 `refresh_window`: idempotent replace of the [as_of-before,
    as_of+after] slice: delete the target slice, insert the DISTINCT source
    slice.  The column is cast to a date, so nothing but its IsNotNull is pushed
    to the scan; callers prune by partition (see `sources.tables`)."""
    a = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    d = F.to_date(F.col(date_col))
    in_win = d.between(F.date_sub(a, before), F.date_add(a, after))
    kept = delete(tgt, in_win)
    fresh = src.filter(in_win).select(*tgt.columns).distinct()
    return kept.unionByName(fresh)


def add_columns(df: DataFrame, schema: T.StructType | Mapping[str, str]) -> DataFrame:
    """B18 `alter_add_columns`: add absent columns as typed NULLs; an
    existing column is not an error and is left as is."""
    items = schema.items() if isinstance(schema, Mapping) else [(f.name, f.dataType) for f in schema.fields]
    new = {c: F.lit(None).cast(t) for c, t in items if c not in df.columns}
    return df.withColumns(new) if new else df


def append_new(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """B20 `append_dedup`: rows whose key is not yet stored (anti join; the
    reference collects the stored ids to the driver)."""
    return df.join(existing.select(key), key, "left_anti")


def apply_corrections(facts: DataFrame, registry: DataFrame, updates: DataFrame | None = None,
                      key: str = "id", col: str = "mode_spread") -> tuple[DataFrame, DataFrame]:
    """B21 `correction_upsert_apply`: upsert new corrections into the
    registry (B6, keyed by game_id), then set the fact column from the
    verified value for every registered game (B7).  Returns
    (new_registry, new_facts)."""
    reg = registry if updates is None else merge_upsert(registry, updates, "game_id")
    src = reg.select(F.col("game_id").alias(key), F.col("verified_spread"))
    return reg, merge_update(facts, src, key, {col: "verified_spread"})
