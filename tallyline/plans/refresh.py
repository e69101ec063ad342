"""Incremental daily refresh (A8 -> E7 -> D1 -> I2 -> B19), partition-scoped.

The reference pulls the last week plus all future games, computes the mode
line per game, left-joins lines onto scores, adds local-time columns and
MERGEs into the fact table, so a day touches ~100-200 of ~11,000 games.
Here the fact table is Parquet partitioned by season, and the upsert reads
and rewrites only the seasons the pull touches:

1. touched seasons = those of the pull (a handful of values, bounded by the
   calendar) and those that hold its keys now, looked up in the key index
   beside the table (`sources.tables.KeyIndex`), in the buckets of the pull's
   keys: a game whose season changed leaves its old season;
2. read just those partitions (partition pruning), MERGE the pull (B6);
3. stage the merged partitions under the shared checkpoint folder (cuts
   the lineage from the files about to be replaced), then dynamic
   partition overwrite from the stage.

No other season is read (`tests/test_units.py` breaks their files).
Partitions are replaced one by one, not the whole table in one swap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import utc_to_zone
from ..operators.aggregates import mode_value
from ..sources.readers import incremental
from ..sources.tables import upsert_partitions


def lines_modes(lines: DataFrame, key: str = "id") -> DataFrame:
    """E7 per game: mode of the quoted spread and of the opening spread
    (ties -> smallest, NULLs ignored)."""
    return lines.groupBy(key).agg(mode_value(F.col("spread")).alias("mode_spread"),
                                  mode_value(F.col("spread_open")).alias("mode_spread_open"))


def prepare_pull(games_pull: DataFrame, lines_pull: DataFrame, as_of, lookback_days: int = 7,
                 tz: str = "America/Chicago") -> DataFrame:
    """Cutoff (A8), line modes (E7), scores LEFT JOIN lines on id (D1; the
    lines side is pre-projected), date and local-time columns (I1/I2)."""
    recent = incremental(games_pull, "start_ts", as_of, lookback_days)
    recent = recent.drop("mode_spread", "mode_spread_open")
    merged = recent.join(lines_modes(lines_pull), "id", "left")
    return merged.withColumns({
        "game_date": F.to_date("start_ts"),
        "start_central": utc_to_zone(F.col("start_ts"), tz),
        "game_date_central": utc_to_zone(F.col("start_ts"), tz).cast("date"),
    })


def daily_refresh(spark: SparkSession, path: str, games_pull: DataFrame, lines_pull: DataFrame, as_of,
                  lookback_days: int = 7) -> list:
    """The whole refresh; returns the seasons rewritten."""
    return upsert_partitions(spark, path, prepare_pull(games_pull, lines_pull, as_of, lookback_days), "id")
