"""The fixed lookup tables as frames: conferences and stadium weather odds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.constants import AFC_TEAMS, NFC_TEAMS, STADIUM_WEATHER
from .standins import weather_odds_table


def conference_table(spark: SparkSession) -> DataFrame:
    """``team, conference`` of the 32 teams."""
    return spark.createDataFrame([(t, c) for c, teams in (("AFC", AFC_TEAMS), ("NFC", NFC_TEAMS)) for t in teams],
                                 "team string, conference string")


def stadium_odds(spark: SparkSession) -> DataFrame:
    """``home_team, condition, p`` of the 32 stadiums."""
    return weather_odds_table(spark, STADIUM_WEATHER)
