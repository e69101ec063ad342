"""Registered queries: Structured Streaming jobs (L1-L4).

Each query lands data derived from the driver's tables as Parquet files
under the shared checkpoint folder, runs the stream to completion with
`trigger(availableNow=True)`, and returns the resulting table.  The oracle
is the batch computation the stream must converge to.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources.tables import create_partitioned
from ..sources.fixtures import games_v, odds_v, table, with_views
from ..streaming import streams as SS
from .catalog_basic import UPDATE_BATCH_SQL, update_batch
from .registry import register


def _scratch(spark):
    return f"{checkpoint_dir(spark)}/streams-{uuid.uuid4().hex[:12]}"


@register("stream_upsert", with_views(f"""WITH {UPDATE_BATCH_SQL}
SELECT * FROM games_v WHERE id NOT IN (SELECT id FROM batch) UNION ALL SELECT * FROM batch""", "games_v"))
def q_stream_upsert(spark, sf):
    """L1: the update batch lands as one file per season; the stream applies
    them micro-batch by micro-batch onto the stored games table."""
    root = _scratch(spark)
    g = games_v(spark, sf)
    create_partitioned(g, f"{root}/games", "id")
    update_batch(g).repartition("season").write.partitionBy("season").parquet(f"{root}/landing")
    schema = spark.read.parquet(f"{root}/landing").schema
    stream = SS.read_landing(spark, f"{root}/landing", schema, max_files=2)
    SS.stream_upsert(stream, f"{root}/games", ["id"], ["start_ts"], f"{root}/ckpt", "season")
    return spark.read.parquet(f"{root}/games").select(*g.columns)


QUOTE_ORDER = ["last_update", "line_no", "outcome_name", "outcome_price", "outcome_point"]


@register("stream_quote_dedup", with_views("""
SELECT event_id, bookmaker, market, q.outcome_name, q.outcome_price, q.outcome_point, q.last_update, q.line_no FROM (
  SELECT event_id, bookmaker, market,
    list({last_update: last_update, line_no: line_no, outcome_name: outcome_name, outcome_price: outcome_price,
          outcome_point: outcome_point}
         ORDER BY last_update, line_no, outcome_name, outcome_price, outcome_point NULLS FIRST)[1] AS q
  FROM odds_v GROUP BY ALL)""", "odds_v"))
def q_stream_dedup(spark, sf):
    """Quotes land in arrival order unrelated to their time stamps; the first by QUOTE_ORDER stays."""
    root = _scratch(spark)
    o = odds_v(spark, sf)
    o.withColumn("part", F.col("event_id") % 8).withColumn("landed", F.col("line_no") % 3) \
        .write.partitionBy("landed").parquet(f"{root}/landing")
    schema = spark.read.parquet(f"{root}/landing").schema
    stream = SS.read_landing(spark, f"{root}/landing", schema, max_files=8).drop("landed")
    keys = ["event_id", "bookmaker", "market"]
    SS.stream_dedup(stream, keys, QUOTE_ORDER, f"{root}/out", f"{root}/ckpt", "part")
    return SS.first_quotes(spark, f"{root}/out", keys, QUOTE_ORDER).select(*o.columns)


@register("stream_late_correction", """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, COUNT(*) FILTER (event_id % 9 < 8) AS n,
  SUM(value) FILTER (event_id % 9 < 8) AS total, COUNT(*) FILTER (event_id % 9 = 8) AS n_refused
FROM events GROUP BY 1, 2""")
def q_stream_late(spark, sf):
    """Every event lands 0 to 8 days after its day; those of 8 days are refused.  Files are read in any order."""
    root = _scratch(spark)
    events = table(spark, sf, "events")
    landed = F.date_add(F.to_date("ts"), (F.col("event_id") % 9).cast("int"))
    events.withColumn("landed", landed).write.partitionBy("landed").parquet(f"{root}/landing")
    schema = spark.read.parquet(f"{root}/landing").schema
    stream = SS.read_landing(spark, f"{root}/landing", schema, max_files=16)
    SS.late_corrections(stream, "ts", "landed", "event_type", "value", f"{root}/counts", f"{root}/refused", f"{root}/ckpt")
    return SS.corrected_counts(spark, f"{root}/counts", f"{root}/refused", "ts", "event_type")


@register("stream_line_windows", with_views("""
SELECT CAST(date_trunc('day', last_update) AS TIMESTAMP) AS window_start, event_id,
  arg_min(outcome_point, (last_update, line_no, bookmaker, outcome_price, outcome_point)) AS open_line,
  arg_max(outcome_point, (last_update, line_no, bookmaker, outcome_price, outcome_point)) AS close_line,
  arg_max(outcome_point, (last_update, line_no, bookmaker, outcome_price, outcome_point))
    - arg_min(outcome_point, (last_update, line_no, bookmaker, outcome_price, outcome_point)) AS movement,
  COUNT(*) AS n_quotes
FROM odds_v WHERE market = 'spreads' GROUP BY 1, 2""", "odds_v"))
def q_stream_lines(spark, sf):
    root = _scratch(spark)
    o = odds_v(spark, sf).filter(F.col("market") == "spreads")
    o.write.parquet(f"{root}/landing")
    schema = spark.read.parquet(f"{root}/landing").schema
    stream = SS.read_landing(spark, f"{root}/landing", schema)
    agg = SS.line_windows(stream, "last_update", "event_id", "outcome_point",
                          ["last_update", "line_no", "bookmaker", "outcome_price", "outcome_point"])
    SS.windowed_upsert(agg, f"{root}/lines", ["window_start", "event_id"], f"{root}/ckpt")
    return spark.read.parquet(f"{root}/lines").drop("window_month")
