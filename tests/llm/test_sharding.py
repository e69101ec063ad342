import zlib

import pytest
from pyspark.sql import functions as F
from tallyline.llm import sharding as S
from util import docs_frame, empty, read


def check(rows, shards=S.SHARDS):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(shards))
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))       # gapless
    total, most = sum(r.size for r in rows), max((r.size for r in rows), default=0)
    for s in range(shards):
        assert abs(sum(r.size for r in by.get(s, [])) - total / shards) <= most
    return by


def test_small_table(ready):
    docs = ready.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = S.shard(docs).collect()
    d = read("sf0.01", "documents").set_index("doc_id").text
    assert sorted(r.doc_id for r in rows) == sorted(d.index)
    for r in rows:
        raw = d[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    check(rows)
    again = S.shard(docs.repartition(5)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in rows}


@pytest.mark.parametrize("hot", ["the same text of every hot row", ""])
def test_hot_text_is_subdivided(ready, hot):
    docs = ready.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit(hot)).otherwise(
        F.repeat(F.col("id").cast("string"), (F.col("id") % 11).cast("int"))).alias("text"))
    by = check(S.shard(docs).collect())
    assert len(by) == 16


def test_no_range_stays_overfull(ready):
    keys = ready.range(20_000).select(F.lit(7).cast("long").alias("k"), F.xxhash64("id").alias("s"),
                                      F.lit(0).cast("long").alias("c"), F.lit(10).cast("long").alias("size"))
    cuts = S.splitters(keys, 200_000, 256)
    placed = keys.withColumn("r", S._range_of(cuts)).groupBy("r").agg(F.sum("size").alias("b")).collect()
    assert max(r.b for r in placed) <= 2 * 200_000 / 256 and len(placed) >= 200


def test_copies_of_one_row_are_many_ranges(ready):
    """A third of all rows are equal in id and text."""
    docs = ready.range(9000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(5).alias("doc_id"),
                                    F.when(F.col("id") % 3 > 0, F.concat(F.lit("own text "), "id")).otherwise("one text").alias("text"))
    by = check(S.shard(docs).collect())
    assert max(len(part) for part in by.values()) < 1.5 * 9000 / 16
    keys = ready.range(20_000).select(F.lit(7).cast("long").alias("k"), F.lit(9).cast("long").alias("s"), F.xxhash64("id").alias("c"),
                                      F.lit(10).cast("long").alias("size"))
    placed = keys.withColumn("r", S._range_of(S.splitters(keys, 200_000, 256))).groupBy("r").agg(F.sum("size").alias("b")).collect()
    assert max(r.b for r in placed) <= 2 * 200_000 / 256


def test_placement_against_a_slow_one(ready):
    """Key order by a plain sort, shards by the place of each record's middle."""
    docs = ready.range(700).select(F.col("id").alias("doc_id"), F.repeat(F.lit("é"), (F.col("id") % 13).cast("int")).alias("text"))
    rows = S.shard(docs, shards=7).collect()
    keyed = docs.select("doc_id", F.xxhash64("text").alias("k"), F.xxhash64(F.lit(S.SEED), "doc_id").alias("s"),
                        (F.octet_length("text") + 1).alias("size")).collect()
    total, at, want, slots = sum(r["size"] for r in keyed), 0, {}, {}
    for r in sorted(keyed, key=lambda r: (r.k, r.s)):
        shard = min(int((at + r["size"] / 2) * 7 // total), 6)
        want[r.doc_id] = shard, slots.get(shard, 0)
        slots[shard] = slots.get(shard, 0) + 1
        at += r["size"]
    assert {r.doc_id: (r.shard, r.slot) for r in rows} == want


def test_edges(ready):
    docs = docs_frame(ready)
    rows = S.shard(docs).collect()
    assert len(rows) == docs.count()
    check(rows)
    by = {r.doc_id: r for r in rows}
    assert (by[0].size, by[0].text_crc32) == (1, 0) and (by[1].size, by[1].text_crc32) == (1, 0)
    assert S.shard(empty(ready)).count() == 0
    assert [r.slot for r in S.shard(docs.limit(1)).collect()] == [0]
