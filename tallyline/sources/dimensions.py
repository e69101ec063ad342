"""Small fixed dimension tables (A7 `src_rows_to_df`: rows -> DataFrame).

These are published team-name facts the ingestion jobs need; they are
created with an explicit schema and are small by construction (tens of
rows), so broadcasting them is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source data's conventions for right results)
# ---------------------------------------------------------------------------

# Pro-league full team name -> abbreviation, including former names.
NFL_TEAM_ABBR = [
    ("Arizona Cardinals", "ARI"), ("Atlanta Falcons", "ATL"), ("Baltimore Ravens", "BAL"),
    ("Buffalo Bills", "BUF"), ("Carolina Panthers", "CAR"), ("Chicago Bears", "CHI"),
    ("Cincinnati Bengals", "CIN"), ("Cleveland Browns", "CLE"), ("Dallas Cowboys", "DAL"),
    ("Denver Broncos", "DEN"), ("Detroit Lions", "DET"), ("Green Bay Packers", "GB"),
    ("Houston Texans", "HOU"), ("Indianapolis Colts", "IND"), ("Jacksonville Jaguars", "JAX"),
    ("Kansas City Chiefs", "KC"), ("Las Vegas Raiders", "LV"), ("Los Angeles Chargers", "LAC"),
    ("Los Angeles Rams", "LA"), ("Miami Dolphins", "MIA"), ("Minnesota Vikings", "MIN"),
    ("New England Patriots", "NE"), ("New Orleans Saints", "NO"), ("New York Giants", "NYG"),
    ("New York Jets", "NYJ"), ("Philadelphia Eagles", "PHI"), ("Pittsburgh Steelers", "PIT"),
    ("San Francisco 49ers", "SF"), ("Seattle Seahawks", "SEA"), ("Tampa Bay Buccaneers", "TB"),
    ("Tennessee Titans", "TEN"), ("Washington Commanders", "WAS"),
    ("Washington Football Team", "WAS"), ("Washington Redskins", "WAS"),
    ("Oakland Raiders", "LV"), ("San Diego Chargers", "LAC"), ("St. Louis Rams", "LA"),
]

# Abbreviation -> URL nickname, with the seasons each applies to
# (valid_from, valid_to inclusive; None = open).  Unlisted -> lower(abbr).
NFL_NICKNAMES = [
    ("ARI", "cardinals", None, None), ("ATL", "falcons", None, None), ("BAL", "ravens", None, None),
    ("BUF", "bills", None, None), ("CAR", "panthers", None, None), ("CHI", "bears", None, None),
    ("CIN", "bengals", None, None), ("CLE", "browns", None, None), ("DAL", "cowboys", None, None),
    ("DEN", "broncos", None, None), ("DET", "lions", None, None), ("GB", "packers", None, None),
    ("HOU", "texans", None, None), ("IND", "colts", None, None), ("JAX", "jaguars", None, None),
    ("KC", "chiefs", None, None), ("LV", "raiders", None, None), ("OAK", "raiders", None, None),
    ("LAC", "chargers", None, None), ("SD", "chargers", None, None),
    ("LA", "rams", None, None), ("STL", "rams", None, None), ("MIA", "dolphins", None, None),
    ("MIN", "vikings", None, None), ("NE", "patriots", None, None), ("NO", "saints", None, None),
    ("NYG", "giants", None, None), ("NYJ", "jets", None, None), ("PHI", "eagles", None, None),
    ("PIT", "steelers", None, None), ("SF", "49ers", None, None), ("SEA", "seahawks", None, None),
    ("TB", "buccaneers", None, None), ("TEN", "titans", None, None),
    ("WAS", "redskins", None, 2019), ("WAS", "football-team", 2020, 2021), ("WAS", "commanders", 2022, None),
]

# College feed name (with mascot) -> canonical name, where prefix matching fails.
CFB_NAME_OVERRIDES = [
    ("Ole Miss Rebels", "Ole Miss"),
    ("Southern California Trojans", "USC"),
    ("Central Florida Knights", "UCF"),
    ("Texas Christian Horned Frogs", "TCU"),
    ("Louisiana State Tigers", "LSU"),
    ("Pitt Panthers", "Pittsburgh"),
    ("Pittsburgh Panthers", "Pittsburgh"),
    ("North Carolina State Wolfpack", "NC State"),
    ("NC State Wolfpack", "NC State"),
    ("Virginia Military Institute Keydets", "VMI"),
    ("Florida International Panthers", "Florida International"),
    ("Florida Intl. Panthers", "Florida International"),
    ("Middle Tennessee Blue Raiders", "Middle Tennessee"),
    ("Middle Tennessee State Blue Raiders", "Middle Tennessee"),
    ("Southern Mississippi Golden Eagles", "Southern Miss"),
    ("Louisiana-Monroe Warhawks", "UL Monroe"),
    ("UL Monroe Warhawks", "UL Monroe"),
    ("Appalachian State Mountaineers", "App State"),
    ("Georgia Southern Eagles", "Georgia Southern"),
    ("Jacksonville State Gamecocks", "Jacksonville State"),
    ("Sam Houston State Bearkats", "Sam Houston"),
    ("Kennesaw State Owls", "Kennesaw State"),
    ("UT Martin Skyhawks", "UT Martin"),
    ("Tennessee-Martin Skyhawks", "UT Martin"),
    ("Alabama-Birmingham Blazers", "UAB"),
    ("Texas at El Paso Miners", "UTEP"),
    ("Texas-San Antonio Roadrunners", "UTSA"),
    ("Hawaii Rainbow Warriors", "Hawai'i"),
    ("Hawai'i Rainbow Warriors", "Hawai'i"),
    ("Massachusetts Minutemen", "Massachusetts"),
    ("UMass Minutemen", "Massachusetts"),
    ("Louisiana Ragin' Cajuns", "Louisiana"),
    ("Louisiana-Lafayette Ragin' Cajuns", "Louisiana"),
    ("Miami (FL) Hurricanes", "Miami"),
    ("Miami Hurricanes", "Miami"),
    ("Miami (OH) RedHawks", "Miami (OH)"),
    ("Connecticut Huskies", "UConn"),
    ("Southern Cal Trojans", "USC"),
    ("Army Black Knights", "Army"),
    ("Navy Midshipmen", "Navy"),
    ("Air Force Falcons", "Air Force"),
    ("Florida A&M Rattlers", "Florida A&M"),
    ("San Jose State Spartans", "San José State"),
]

# Pricing constants.
STANDARD_PRICE = -110            # American odds
BREAKEVEN = 110.0 / 210.0        # win rate needed at -110
NFL_GAME_TYPES = ("REG", "WC", "DIV", "CON", "SB")
NFL_FIRST_SEASON = 2015
PREFERRED_PROVIDER = "consensus"

# ---------------------------------------------------------------------------

ABBR_SCHEMA = T.StructType([T.StructField("full_name", T.StringType(), False),
                            T.StructField("abbr", T.StringType(), False)])
NICK_SCHEMA = T.StructType([T.StructField("abbr", T.StringType(), False),
                            T.StructField("nickname", T.StringType(), False),
                            T.StructField("valid_from", T.IntegerType(), True),
                            T.StructField("valid_to", T.IntegerType(), True)])
OVERRIDE_SCHEMA = T.StructType([T.StructField("name", T.StringType(), False),
                                T.StructField("canonical", T.StringType(), False)])


def rows_df(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A7 `src_rows_to_df`: explicit-schema DataFrame from driver rows
    (dimensions only - never fact data)."""
    return spark.createDataFrame(rows, schema)


def nfl_abbr_dim(spark: SparkSession) -> DataFrame:
    return rows_df(spark, NFL_TEAM_ABBR, ABBR_SCHEMA)


def nfl_nickname_dim(spark: SparkSession) -> DataFrame:
    return rows_df(spark, NFL_NICKNAMES, NICK_SCHEMA)


def cfb_override_dim(spark: SparkSession) -> DataFrame:
    return rows_df(spark, CFB_NAME_OVERRIDES, OVERRIDE_SCHEMA)
