"""Bounded labelled samples for the classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out, stored, tidy

LARGE = 16                            # a text above max_bytes / LARGE is taken after all smaller ones


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, max_bytes: int, seed: int = 17) -> DataFrame:
    """(place, y, text) of at most `rows` labelled documents and `max_bytes` of text, in a seeded order of the ids.

    Labels of held-out ids, null ids and null labels are never read; an id
    labelled twice takes its larger label.  Rows equal in id and text are one
    row.  Where an id has several texts, the one of the smallest hash stands in
    the id's place, and the others come after the first texts of all ids.
    Rows are taken in that order, texts above max_bytes / LARGE after all
    smaller ones; a row that does not fit in what is left is passed over.
    Only sizes are ordered and summed, of at most `rows` rows; texts are
    fetched for the rows taken.
    """
    order = F.xxhash64(F.lit(seed), "doc_id")
    chosen = (labels.select("doc_id", F.col(label_col).cast("int").alias("y"))
              .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("y").alias("y"))
              .select("doc_id", "y", order.alias("key")).orderBy("key", "doc_id").limit(rows))
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hash_ = F.xxhash64("text").alias("hash")                                 # of chosen rows only: joins come first
    sizes = (texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", hash_, "key", "y")
             .agg(F.max(F.octet_length("text")).cast("long").alias("size")))
    sizes = stored(sizes, "sizes")
    firsts = sizes.groupBy("doc_id").agg(F.min("hash").alias("first"))       # at most `rows` ids
    turn = [F.col("size") > max_bytes // LARGE, F.col("hash") != F.col("first"), "key", "doc_id", "hash"]
    line = sizes.filter(F.col("size") <= max_bytes).join(F.broadcast(firsts), "doc_id").orderBy(*turn).limit(rows) \
        .select("doc_id", "hash", "y", F.struct(*(F.col(c) if isinstance(c, str) else c for c in turn)).alias("turn"), "size")
    taken = _taken(line.withColumn("place", F.row_number().over(Window.orderBy("turn"))), max_bytes)
    return (texts.join(F.broadcast(taken), (texts["doc_id"] == taken["doc_id"]) & (F.xxhash64(texts["text"]) == taken["hash"]))
            .groupBy("place", "y").agg(F.min("text").alias("text")))


def _taken(line: DataFrame, max_bytes: int) -> DataFrame:
    """The rows of `line`, a bounded table, that fit: in order of place, each beside those taken before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = 0
        for t in [pa.Table.from_batches(b).sort_by("place") for b in [list(batches)] if b]:
            take = []
            for size in t.column("size").to_pylist():
                take.append(used + size <= max_bytes)
                used += size * take[-1]
            yield from t.filter(pa.array(take, pa.bool_())).to_batches()

    line = line.select("doc_id", "hash", "y", "place", "size")
    return line.repartition(1).mapInArrow(run, line.schema).drop("size")


def fit_in_one_task(sample: DataFrame, fit: Callable[[list[tuple[bytes, int]]], bytes]) -> bytes:
    """Train on a sample of labelled() in one executor task, in order of place; returns the model.

    No rows give the untrained model.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        rows = sorted((k, t, y) for b in batches
                      for k, y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                         b.column(2).cast(pa.binary()).to_pylist()))
        model = fit([(t, y) for _, t, y in rows])
        del rows
        tidy()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    row = sample.repartition(1).mapInArrow(run, "model binary").first()
    return bytes(row["model"]) if row else fit([])          # an empty sample may start no task
