"""Corpus pipeline over `documents`: five stages, each one operator of tallyline.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and reread as the next one's docs.  All but the last return the
columns they were given, so stages work with extra columns of any name.

Defined results: a document is a row's (doc_id, hash of its text), so null
ids and ids used twice are no obstacle; rows equal in both are one document
and share its fate, and the near-dedup stage leaves one row of it: the first
by its other columns written as JSON.  Null texts are empty texts.  Empty
input: empty output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import byte_cnn, decontaminate, minhash, mixing, token_planes
from tallyline.llm.common import cleared, discard, ready, scratch, stored, table
from tallyline.llm.queries import tokenizer_path

QUALITY_THRESHOLD = 0.3
SHINGLE = 5                           # words of a shingle in the near-dedup stage; op7's contract has 4
BROADCAST_ROWS = 200_000              # decisions (24 bytes each) broadcast up to here, joined by shuffle beyond
KEY = "__document"


def _key() -> Column:
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("hash"))


def _free(docs: DataFrame, name: str) -> str:
    """`name`, or a longer one that no column of `docs` has (column names differ by more than case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of `docs` whose key is not in `dropped`."""
    key = _free(docs, KEY)
    dropped = stored(dropped.select(F.col(KEY).alias(key)).distinct(), "dropped")
    few = dropped.count() <= BROADCAST_ROWS
    return docs.withColumn(key, _key()).join(F.broadcast(dropped) if few else dropped, key, "left_anti") \
        .select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network scores QUALITY_THRESHOLD or more."""
    ready(spark)
    model = byte_cnn.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(byte_cnn.score_column(spark, model, F.col("text")) >= QUALITY_THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, shingle: int = minhash.SHINGLE) -> DataFrame:
    """One document of each near-duplicate component, the smallest."""
    ready(spark)
    keyed = docs.select(_key().alias(KEY), "text")
    return _without(docs, minhash.near_duplicates(keyed, KEY, shingle=shingle).filter("NOT kept"))


def one_row_each(docs: DataFrame) -> DataFrame:
    """One row of each document: the rows of keys that occur once, and one row of each repeated key.

    Only keys are counted over all rows, and only rows of repeated keys are aggregated, with a partial step,
    so a key that holds a third of all rows is a row a task by then.
    """
    key, whole = _free(docs, KEY), _free(docs, "__row")
    keyed = docs.withColumn(key, _key())
    repeated = stored(keyed.groupBy(key).agg(F.count("*").alias(whole)).filter(F.col(whole) > 1).select(key), "repeated")
    n = repeated.count()
    if not n:
        return docs
    known = F.broadcast(repeated) if n <= BROADCAST_ROWS else repeated
    others = [F.col(c) for c in docs.columns if c != "text"]
    row, order = F.struct(*docs.columns), F.to_json(F.struct(F.col("text").isNull().alias(whole), *others))
    first = keyed.join(known, key, "left_semi").groupBy(key).agg(F.min_by(row, order).alias(whole))
    return keyed.join(known, key, "left_anti").select(docs.columns).unionByName(first.select(f"{whole}.*"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """near_dedup() by shingles of SHINGLE words, then one row of each document kept."""
    return one_row_each(near_dedup(spark, docs, sf_dir, SHINGLE))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    ready(spark)
    keyed = docs.select(_key().alias(KEY), "text")
    found = decontaminate.decontaminate(keyed, table(spark, sf_dir, "benchmark"), KEY)
    return _without(docs, found.filter("contaminated"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes its words: taken / size times, rounded at random (seeded)
    so that the expected number of words is the one taken; 0, 1 or 2 rows."""
    ready(spark)
    keyed = docs.select(_key().alias(KEY), "text", "source")
    u = F.pmod(F.xxhash64(F.lit(29), KEY), F.lit(1 << 20)) / F.lit(float(1 << 20))
    key, n, copy = _free(docs, KEY), _free(docs, "__times"), _free(docs, "__copy")
    times = mixing.mix(keyed, KEY).filter("taken > 0").select(
        F.col(KEY).alias(key), F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + u).cast("int").alias(n)).filter(F.col(n) > 0)
    times = stored(times.groupBy(key).agg(F.max(n).alias(n)), "times")
    return (docs.withColumn(key, _key()).join(times, key)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), n))).select(docs.columns))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back: (doc_id, start, n_tokens, ids_crc32)."""
    ready(spark)
    return token_planes.token_files(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("token-ID / binary output", token_output),
]

# The byte network has no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and reread."""
    ready(spark)
    docs, last = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path = scratch(spark, "stage")
        with cleared(spark):                                 # a stage's own intermediate tables go with it
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            discard(spark, last)
        last = path
    return docs
