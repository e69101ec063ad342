"""Sinks as plain Spark writes.

Tables are Parquet paths (or catalog tables over such paths) written by
`DataFrame.write` and `insertInto`.  A table whose new state is computed from
its old one is either written to a new path, or, partition by partition,
through a checkpoint in the shared folder (`rewrite_partitions`).
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.mutation import merge_upsert, unique_source
from ..session import checkpoint_dir

MAX_TOUCHED = 10_000                  # partitions one rewrite may touch; more is an error, not a silent cut


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing uses yet."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _delete(spark: SparkSession, folder) -> None:
    """Delete a folder, given as a Hadoop path."""
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """`df` computed once: its rows lie in the shared folder until the block ends."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append(df: DataFrame, path: str) -> None:
    """B1 `sink_append`: INSERT by name; columns `df` lacks become NULL."""
    now = read_if_exists(df.sparkSession, path)
    if now is not None:
        df = df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in now.schema.fields))
    df.write.mode("append").parquet(path)


def create_typed(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """B4 `sink_create_typed`: an empty typed table with column comments, if there is none."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'} "
                        f"COMMENT '{f.metadata.get('comment', '')}'" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{path}'")


def insert_by_name(df: DataFrame, name: str) -> None:
    """INSERT INTO a catalog table; columns `df` lacks become NULL."""
    fields = df.sparkSession.table(name).schema.fields
    df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in fields)).write.insertInto(name)


def values_of(df: DataFrame, col: str) -> set:
    """Distinct partition values, as parameters of the rewrite."""
    got = [r[0] for r in df.select(col).distinct().limit(MAX_TOUCHED + 1).collect()]
    if len(got) > MAX_TOUCHED:
        raise ValueError(f"more than {MAX_TOUCHED} partitions of {col} are touched; rewrite the table instead")
    return set(got)


def in_values(col: str, values: set):
    known = [v for v in values if v is not None]
    return (F.col(col).isin(known) if known else F.lit(False)) | (F.col(col).isNull() if None in values else F.lit(False))


class KeyIndex:
    """Which partitions of a table hold a key: rows (keys…, partition value),
    in a folder that readers of the table do not see.

    Rows lie in buckets by a hash of the key, about BUCKET_KEYS keys each, so a
    lookup or an update reads and writes the buckets of the keys it is about
    and no others.  A key's rows are added before its data moves and cleaned
    after it, so a job lost in between leaves a place too many, never one too
    few.  The index holds for tables that are changed through this module only.
    """

    BUCKET_KEYS, MAX_BUCKETS, MAX_FILES = 50_000, 8192, 16
    FOLDER = "_keys"

    def __init__(self, spark: SparkSession, path: str, keys: list[str], part_col: str, buckets: int):
        self.spark, self.path, self.keys, self.part_col, self.buckets = spark, f"{path}/{self.FOLDER}", keys, part_col, buckets

    @classmethod
    def build(cls, spark: SparkSession, path: str, keys: list[str], part_col: str) -> KeyIndex:
        """Index a table by one scan of its key columns."""
        held = spark.read.parquet(path).select(*keys, part_col)
        buckets = max(1, min(cls.MAX_BUCKETS, held.count() // cls.BUCKET_KEYS))
        index = cls(spark, path, keys, part_col, buckets)
        rows = index._rows(held).distinct()
        rows.repartition("key_bucket").write.mode("overwrite").partitionBy("key_buckets", "key_bucket").parquet(index.path)
        return index

    @classmethod
    def of(cls, spark: SparkSession, path: str, part_col: str) -> KeyIndex | None:
        """The index of a table, if it has one."""
        held = read_if_exists(spark, f"{path}/{cls.FOLDER}")
        first = held.select("key_buckets").first() if held is not None else None
        if not first:
            return None
        keys = [c for c in held.columns if c not in ("key_buckets", "key_bucket", "key_part")]
        return cls(spark, path, keys, part_col, int(first["key_buckets"]))

    def _rows(self, rows: DataFrame) -> DataFrame:
        known = rows
        for k in self.keys:
            known = known.filter(F.col(k).isNotNull())              # a NULL key matches nothing
        return known.select(*self.keys, F.col(self.part_col).alias("key_part"), F.lit(self.buckets).alias("key_buckets"),
                            F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("key_bucket"))

    def _read(self, rows: DataFrame) -> DataFrame:
        """The index rows in the buckets of some rows (as _rows() gives them)."""
        wanted = [r["key_bucket"] for r in rows.select("key_bucket").distinct().collect()]       # at most MAX_BUCKETS
        return self.spark.read.parquet(self.path).filter(F.col("key_bucket").isin(wanted) if wanted else F.lit(False))

    def places(self, src: DataFrame) -> DataFrame:
        """The places `src` gives its keys (`key_part`, `given`) and those known of them (`known`), one row a place."""
        given = self._rows(src).distinct().withColumn("given", F.lit(True))
        known = self._read(given).select(*self.keys, "key_part", F.lit(True).alias("known"))
        known = known.join(given.select(*self.keys).distinct(), self.keys, "left_semi")
        both = given.select(*self.keys, "key_part", "given").unionByName(known, allowMissingColumns=True)
        return both.groupBy(*self.keys, "key_part").agg(F.max("given").alias("given"), F.max("known").alias("known"))

    def _compact(self) -> None:
        """Buckets of more than MAX_FILES files get one file again."""
        files = Counter(unquote(f).rsplit("/", 2)[1] for f in self.spark.read.parquet(self.path).inputFiles())
        full = [int(b.split("=")[1]) for b, n in files.items() if n > self.MAX_FILES]
        if full:
            held = self.spark.read.parquet(self.path).filter(F.col("key_bucket").isin(full)).distinct()
            self._replace(held.checkpoint(eager=True))

    def _replace(self, rows: DataFrame) -> None:
        (rows.repartition("key_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("key_buckets", "key_bucket").parquet(self.path))

    def add(self, rows: DataFrame) -> None:
        """Rows' places, beside those known, in one more file a bucket."""
        new = self._rows(rows).distinct()
        if not new.isEmpty():
            new.repartition("key_bucket").write.mode("append").partitionBy("key_buckets", "key_bucket").parquet(self.path)
            self._compact()

    def settle(self, rows: DataFrame) -> None:
        """Rows' places instead of those known of their keys, one file a bucket."""
        new = self._rows(rows).distinct()
        if new.isEmpty():
            return
        others = self._read(new).select(new.columns).join(new.select(*self.keys).distinct(), self.keys, "left_anti")
        self._replace(others.unionByName(new).distinct().checkpoint(eager=True))


def _folders(now: DataFrame, part_col: str, values: set) -> list[str]:
    """The folders of some partitions, as URIs named by whoever wrote them; no data column is read."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]+$", 1)
    return [r[0] for r in now.filter(in_values(part_col, values)).select(folder).distinct().collect()]


def rewrite_partitions(spark: SparkSession, path: str, touched: set, fn: Callable[[DataFrame], DataFrame],
                       part_col: str = "season", index: KeyIndex | None = None, placed: DataFrame | None = None,
                       moved: DataFrame | None = None) -> None:
    """Replace the touched partitions of the table at `path` by fn(their rows).

    Only those partitions are read.  The new rows are checkpointed to the
    shared folder, which cuts them loose from the files about to be replaced,
    then written by dynamic partition overwrite (one commit); touched
    partitions that have no row any more are deleted after it.  A driver lost
    between the two leaves rows both in their new and in their old partition;
    the same rewrite run again repairs that.

    The table's key index, if it has one, learns the new places before the
    data does and forgets old ones after it: of all new rows, or of `placed`
    (rows whose place it lacks) and `moved` (rows of which it has other places)
    where these are known.
    """
    checkpoint_dir(spark)
    now = spark.read.parquet(path)
    new = fn(now.filter(in_values(part_col, touched))).checkpoint(eager=True)
    kept = values_of(new, part_col)
    if kept - touched:
        raise ValueError(f"rows moved outside the touched partitions: {sorted(map(str, kept - touched))[:5]}")
    gone = _folders(now, part_col, touched - kept) if touched - kept else []
    index = index or KeyIndex.of(spark, path, part_col)
    if index:
        index.add(new if placed is None else placed)
    columns = [c for c in new.columns if c != part_col]
    if kept:
        (new.select(*columns, part_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(part_col).parquet(path))
    jvm = spark.sparkContext._jvm
    for uri in gone:
        _delete(spark, jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)))
    if index:
        index.settle(new if moved is None else moved)


def create_partitioned(df: DataFrame, path: str, keys, part_col: str = "season") -> None:
    """Write a new table partitioned by `part_col`, with its key index, for upsert_partitions()."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    df.write.partitionBy(part_col).parquet(path)
    KeyIndex.build(df.sparkSession, path, keys, part_col)


def upsert_partitions(spark: SparkSession, path: str, src: DataFrame, keys, part_col: str = "season",
                      part_from_keys: bool = False) -> list:
    """B6/B19 on a partitioned table: MERGE `src`, creating the table on first use.

    Touched are the partitions of the source and those that hold its keys now,
    so a row whose partition value changes leaves its old partition.  Where
    these are is looked up in the key index beside the table (KeyIndex), in the
    buckets of the source's keys; no other partition of the table is read, and
    the index is written only for keys that are new or move.  A table that was
    written without an index gets one at its first MERGE, by one scan of its
    key columns.  With `part_from_keys` the partition is a function
    of the keys, rows cannot move, and no index is kept.  Several source rows of
    one key are an error.  Returns the touched partitions.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    touched = values_of(src, part_col)
    if read_if_exists(spark, path) is None:
        unique_source(src, keys).filter("__checked = 0").drop("__checked").write.partitionBy(part_col).parquet(path)
        if not part_from_keys:
            KeyIndex.build(spark, path, keys, part_col)
        return sorted(touched, key=str)
    merge = lambda cur: merge_upsert(cur, src, keys)
    if part_from_keys:
        rewrite_partitions(spark, path, touched, merge, part_col)
        return sorted(touched, key=str)
    index = KeyIndex.of(spark, path, part_col) or KeyIndex.build(spark, path, keys, part_col)
    with written(index.places(src), "places") as places:
        touched |= values_of(places.filter("known"), "key_part")
        given = places.filter("given")
        given = given if part_col in keys else given.withColumnRenamed("key_part", part_col)
        placed = given.filter("known IS NULL")
        moved = given.join(places.filter("given IS NULL").select(*keys).distinct(), keys, "left_semi")
        rewrite_partitions(spark, path, touched, merge, part_col, index, placed, moved)
    return sorted(touched, key=str)
