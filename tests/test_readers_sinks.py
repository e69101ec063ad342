"""File-based sources and the versioned sinks."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from tallyline.sources import readers as R
from pyspark.sql import types as T

from tallyline.sources import tables as TB


def test_read_games_json_conforms(spark):
    d = tempfile.mkdtemp(prefix="tl-json-")
    rows = [{"id": 1, "season": 2023, "week": 1, "startDate": "2023-09-02T16:00:00.000Z", "completed": True,
             "homeId": 10, "homeTeam": "A", "homeClassification": "fbs", "homePoints": "31",
             "homeLineScores": [7, 10, 0, 14], "awayLineScores": [], "awayId": 11, "awayTeam": "B", "awayPoints": "", "attendance": "n/a"},
            {"id": 2, "season": 2022, "week": 3}]
    with open(f"{d}/g.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    g = R.read_games(spark, d, seasons=[2023])
    assert len(g.columns) == 39
    r = g.collect()[0]
    assert (r.id, r.homeScore, r.awayScore, r.attendance) == (1, 31.0, None, None)   # '' / bad -> NULL
    assert r.neutralSite is False and r.completed is True                             # missing flag -> false
    assert r.homeTeamId == 10 and r.homeLineScores == "[7, 10, 0, 14]" and r.highlights is None
    assert r.awayLineScores is None                                                   # empty list -> NULL


def test_read_games_csv_filters(spark):
    d = tempfile.mkdtemp(prefix="tl-csv-")
    header = ",".join(R.NFL_CSV_COLUMNS)
    blank = "," * (len(R.NFL_CSV_COLUMNS) - 12)
    lines = [header,
             "2014_01_A_B,2014,REG,1,2014-09-07,Sunday,13:00,A,10,B,20,3.5" + blank,
             "2016_01_A_B,2016,REG,1,2016-09-11,Sunday,13:00,A,10,B,20,3.5" + blank,
             "2016_PRE_A_B,2016,PRE,0,2016-08-11,Thursday,19:00,A,3,B,7,1" + blank]
    with open(f"{d}/games.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    g = R.read_games_csv(spark, d)
    assert [r.game_id for r in g.collect()] == ["2016_01_A_B"]
    assert len(g.columns) == 31


def test_read_pages_files(spark):
    d = tempfile.mkdtemp(prefix="tl-html-")
    for i in range(3):
        with open(f"{d}/p{i}.html", "w") as f:
            f.write(f"<html><title>Page {i}</title><body>x</body></html>")
    p = R.read_pages(spark, d, parquet=False)
    assert p.count() == 3 and set(p.columns) == {"page_id", "url", "html"}


def test_incremental_and_seasons():
    assert R.seasons_to_scan("2024-01-03", 7) == [2023, 2024]


def test_appends_and_typed_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert TB.read_if_exists(spark, path) is None
    TB.append(spark.range(3).withColumn("v", F.col("id") * 2), path)
    TB.append(spark.range(3, 5), path)                      # by name; v becomes NULL
    assert {r.id: r.v for r in spark.read.parquet(path).collect()} == {0: 0, 1: 2, 2: 4, 3: None, 4: None}
    schema = T.StructType([T.StructField("game_id", T.LongType(), True, {"comment": "game id"}),
                           T.StructField("note", T.StringType(), True, {"comment": "free text"})])
    name = f"typed_{tmp_path.name.replace('-', '_')}"
    for _ in range(2):                                      # the second call does nothing
        TB.create_typed(spark, name, schema, str(tmp_path / "typed"))
        TB.insert_by_name(spark.range(2).withColumnRenamed("id", "game_id"), name)
    assert spark.table(name).count() == 4 and spark.table(name).schema["note"].metadata["comment"] == "free text"
    spark.sql(f"DROP TABLE {name}")


def test_lines_json_and_python_literal(spark):
    """A2 accepts both JSON and Python-literal text (None/True/False tokens)."""
    text = spark.createDataFrame([
        (1, '[{"provider": "consensus", "spread": "-3.5", "spreadOpen": null}]'),
        (2, "[{'provider': 'x', 'spread': -7, 'spreadOpen': None}]"),
        (3, "not a list")], "id long, lines string")
    flat = {r.id: (r.provider, r.spread, r.spread_open) for r in R.explode_lines(R.parse_lines(text)).collect()}
    assert flat == {1: ("consensus", -3.5, None), 2: ("x", -7.0, None)}


def test_union_drop_empty_to_null(spark):
    from tallyline.functions.scalar import empty_to_null
    a = spark.createDataFrame([(1, "")], "id int, s string")
    b = spark.createDataFrame([(2, 5)], "id int, n int")
    u = R.union_seasons([a, None, b])
    assert sorted(u.columns) == ["id", "n", "s"] and u.count() == 2
    assert empty_to_null(a).collect()[0].s is None
    assert a.drop("s", "not_there").columns == ["id"]
