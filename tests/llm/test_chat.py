from harness import duck_rows, spark_rows
from tallyline.llm import chat, oracles

SCHEMA = "conv_id long, turn long, role string, text string, h1 string, pos string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def conv(i, *texts):
    return [(i, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(texts)]


def kept(spark, rows):
    return {r.conv_id: (r.n_turns, r.n_copies) for r in chat.format_chats(turns(spark, rows)).collect()}


def test_snapshots_collapse(ready):
    rows = conv(1, "a") + conv(2, "a", "b") + conv(3, "a", "b", "c") + conv(4, "a", "x") + conv(9, "a", "b", "c") \
        + conv(5, "b", "a") + conv(6, "z")
    assert kept(ready, rows) == {3: (3, 2), 4: (2, 1), 5: (2, 1), 6: (1, 1)}


def test_nulls_repeats_ties_and_empty(ready):
    rows = conv(1, "a", None) + conv(1, "a", None) + [(None, 0, "user", "lost")] + [(2, 0, None, "a"), (2, 1, "assistant", "")] \
        + [(3, None, "user", "first"), (3, 0, "user", "tie b"), (3, 0, "user", "tie a")]
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in chat.format_chats(turns(ready, rows)).collect()}
    assert got == {1: (2, 2, "<|user|>\na\n<|assistant|>\n\n"),
                   3: (3, 1, "<|user|>\nfirst\n<|user|>\ntie a\n<|user|>\ntie b\n")}
    assert chat.format_chats(turns(ready, rows).limit(0)).count() == 0


def test_long_conversations_and_a_common_first_turn(ready, monkeypatch):
    import duckdb
    monkeypatch.setattr(chat, "RUN", 16)
    long = [f"t{k % 7}" for k in range(300)]
    rows = conv(0, *long) + conv(1, *long[:299]) + conv(2, *long[:16]) + conv(3, *long[:17], "else") \
        + [r for i in range(10, 400) for r in conv(i, "hello", *[f"r{i % 50}"] * (i % 4))]
    df = turns(ready, rows)
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    assert sorted(spark_rows(chat.format_chats(df))[1]) == sorted(duck_rows(con, oracles.op3_snapshot_collapse)[1])


def test_equal_hashes_of_different_turns_drop_nothing(ready, monkeypatch):
    """Turn hashes modulo 2 make most prefixes meet; the turns decide."""
    import random

    import duckdb
    monkeypatch.setattr(chat, "MODULUS", 2)
    rng = random.Random(2)
    rows = [r for i in range(120) for r in conv(i, *[rng.choice("abc") for _ in range(rng.randrange(1, 6))])]
    df = turns(ready, rows)
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    want = sorted(duck_rows(con, oracles.op3_snapshot_collapse)[1])
    assert sorted(spark_rows(chat.format_chats(df))[1]) == want
    read = chat.prefixes(df)
    heads = read.groupBy("conv_id").agg({"pos": "max", "h1": "max", "h2": "max"}).toDF("conv_id", "a", "b", "c")
    assert heads.groupBy("a", "b", "c").count().filter("count > 1").count() > 10     # hashes did meet


def test_very_long_turns_and_clashing_columns(ready):
    long = "word " * 500_000
    rows = conv(1, long, "end") + conv(2, long) + conv(3, long, "end", "more") + conv(4, long + "x")
    assert kept(ready, rows) == {3: (3, 1), 4: (1, 1)}
    import pyspark.sql.functions as F
    df = turns(ready, conv(1, "a") + conv(2, "a", "b")).withColumns({c: F.lit(c) for c in ("digest", "first", "at", "run", "nth")})
    assert [tuple(r)[:3] for r in chat.format_chats(df).collect()] == [(2, 2, 1)]
