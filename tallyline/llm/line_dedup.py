"""Line dedup on levelled sorted runs of line hashes, in DataFrame functions only.

Documents come in batches.  A batch's lines become rows (h1, h2, n): the
128-bit hash of the line's key and the number of the batch's documents that
hold it.  A run is such rows, bucketed and sorted by the hash.  Each new batch
is merge-anti-joined with the settled rows of the runs so far (keys known to
be common need no more counting), and what is left is written as a run of
level 0.  As soon as a level has FANOUT runs they are compacted into one run of
the next level, which adds up the counts, so n batches leave O(log n) runs.
A level is a bucketed table and all have the same buckets: neither the
anti-joins nor the compactions move the runs' rows between executors, only a
new batch's distinct lines.  The levels' sums are shuffled once, at the end.

A key is common once its counts over all runs reach MIN_DOCS.  Common lines
are dropped from every document: line hashes are joined with the common keys
(broadcast while there are at most BROADCAST_ROWS of them, a shuffle join that
AQE splits at hot lines beyond), the places found are gathered per document,
and the other lines joined again.  A line counts once per document and is
combined before the shuffle, so a line that a third of all documents hold is
one row a task.

Defined results: a line's key is the line without white space at both ends,
A-Z lower-cased; keys under MIN_CHARS code points never count.  Null and empty
texts are one empty line.  Every row is a document, also rows of equal or null
id; rows equal in id and text are counted each and share one result.  An
empty table gives an empty result.  The hash of a key is 128 bits (two seeds of
xxhash64), taken as the key itself: at 10^12 distinct lines the chance of any
two meeting is about 10^-15.  Only the two columns named are read, so extra
columns of any name do no harm.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower, discard, scratch, stored

MIN_DOCS, MIN_CHARS = 10, 1
FANOUT, BATCHES = 4, 8
BROADCAST_ROWS = 200_000              # common keys (16 bytes each) broadcast up to here
HASH = ["h1", "h2"]


def _hashes(*parts: Column) -> list[Column]:
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2")]


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def _keys(text: Column) -> Column:
    """Keys of all lines, in order."""
    return F.transform(F.split(ascii_lower(text), "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)))


def line_counts(docs: DataFrame, text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, n): documents that hold each line key."""
    lines = docs.select(F.explode(F.array_distinct(_keys(_text(text_col)))).alias("key"))
    return (lines.filter(F.char_length("key") >= max(min_chars, 1)).select(*_hashes(F.col("key")))
            .groupBy(*HASH).agg(F.count("*").alias("n")))


class LineRuns:
    """Levelled runs of line counts under the shared folder; the driver holds their names only.

    A level is one bucketed table, a run one append to it, sorted in every
    bucket.  `close()` deletes them.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[int] = []                      # runs of each level
        self._tables: list[tuple[str, str]] = []         # (name, path) of each level

    def _append(self, level: int, rows: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append(0)
            self._tables.append((f"line_level_{uuid.uuid4().hex}", scratch(self.spark, "line-level")))
        name, path = self._tables[level]
        (rows.select(*HASH, "n").write.mode("append").bucketBy(self.buckets, *HASH).sortBy(*HASH)
         .option("path", path).saveAsTable(name))
        self.levels[level] += 1

    def _drop(self, level: int) -> None:
        name, path = self._tables[level]
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(self.spark, path)
        self._tables[level], self.levels[level] = (f"line_level_{uuid.uuid4().hex}", scratch(self.spark, "line-level")), 0

    def tables(self) -> list[DataFrame]:
        """The runs of each level that has any."""
        return [self.spark.table(name) for (name, _), n in zip(self._tables, self.levels) if n]

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """The rows of `counts` whose key no run has settled as common: one merge anti-join a level."""
        for level in self.tables():
            known = level.filter(F.col("n") >= self.min_docs).select(*HASH)
            counts = counts.join(known.hint("merge"), HASH, "left_anti")
        return counts

    def add(self, counts: DataFrame) -> None:
        """Take a batch's line_counts()."""
        self._append(0, self.unsettled(counts))
        level = 0
        while self.levels[level] >= self.fanout:
            self._append(level + 1, self.spark.table(self._tables[level][0]).groupBy(*HASH).agg(F.sum("n").alias("n")))
            self._drop(level)
            level += 1

    def common(self) -> DataFrame:
        """(h1, h2) of the keys that at least min_docs documents hold."""
        rows = self.spark.createDataFrame([], "h1 long, h2 long, n long")
        for level in self.tables():
            rows = rows.unionByName(level.groupBy(*HASH).agg(F.sum("n").alias("n")))
        # repartitioned: a bucketed table below a union is not read by its buckets
        return rows.repartition(*HASH).groupBy(*HASH).agg(F.sum("n").alias("n")).filter(F.col("n") >= self.min_docs).select(*HASH)

    def close(self) -> None:
        for level in range(len(self.levels)):
            self._drop(level)


def common_lines(spark: SparkSession, batches: list[DataFrame], text_col: str = "text", min_docs: int = MIN_DOCS,
                 min_chars: int = MIN_CHARS, fanout: int = FANOUT) -> DataFrame:
    """(h1, h2) of the line keys found in at least `min_docs` documents of all batches, stored."""
    runs = LineRuns(spark, min_docs, fanout)
    try:
        for batch in batches:
            runs.add(line_counts(batch, text_col, min_chars))
        return stored(runs.common(), "common-lines")
    finally:
        runs.close()


def drop_lines(docs: DataFrame, common: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, kept) for every row of `docs`; `common`: a stored table of keys."""
    few = common.count() <= BROADCAST_ROWS
    text = docs.select(F.col(id_col), _text(text_col).alias("kept"))
    row = [F.xxhash64(id_col, "kept").alias("r1"), F.xxhash64(F.lit(1), id_col, "kept").alias("r2")]
    places = text.select(*row, F.posexplode(_keys(F.col("kept"))).alias("place", "key")).filter("key <> ''") \
        .select("r1", "r2", "place", *_hashes(F.col("key")))
    found = (places.join(F.broadcast(common) if few else common, HASH)
             .groupBy("r1", "r2").agg(F.collect_set("place").alias("dropped")))
    found = stored(found, "found")                           # so that AQE can split a row that a third of all rows are
    lines = F.split("kept", "\n", -1)
    others = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
    rest = F.transform("places", lambda i: F.get(F.col("lines"), i))
    return (text.select(id_col, "kept", *row).join(found, ["r1", "r2"], "left")
            .withColumns({"lines": lines, "places": others})
            .select(id_col, F.size("lines").cast("long").alias("n_lines"),
                    F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.when(F.col("dropped").isNull(), F.col("kept")).otherwise(F.array_join(rest, "\n")).alias("kept")))


def file_batches(spark: SparkSession, path: str, n: int = BATCHES) -> list[DataFrame]:
    """A Parquet table as at most `n` batches of whole files, each file in one batch."""
    whole = spark.read.parquet(path)
    files = sorted(unquote(f) for f in whole.inputFiles())
    if len(files) < 2:
        return [whole]
    return [spark.read.schema(whole.schema).parquet(*files[k::n]) for k in range(min(n, len(files)))]
