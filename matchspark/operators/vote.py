"""Votes over several models' predictions.

Scoring several models over the same frame yields the predictions side by
side (one column per model), so the vote is a row expression: no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confidence(pred: Column, p_team1: Column) -> Column:
    """probability of the predicted side."""
    return F.when(pred == 1, p_team1).otherwise(F.lit(1.0) - p_team1)


def consensus(pred_cols: Sequence[str], tie: str = "zero") -> Column:
    """Majority of 0/1 predictions.

    ``tie="zero"`` — a tie gives 0, i.e. team2 (row mode, smallest value);
    ``tie="first"`` — a tie gives the first model's prediction (the first
    vote counted).
    """
    votes = None
    for c in pred_cols:
        v = F.coalesce(F.col(c).cast("int"), F.lit(0))
        votes = v if votes is None else votes + v
    n = len(pred_cols)
    if tie == "zero":
        return F.when(votes * 2 > n, 1).otherwise(0)
    if tie == "first":
        return (F.when(votes * 2 > n, 1).when(votes * 2 < n, 0)
                .otherwise(F.col(pred_cols[0]).cast("int")))
    raise ValueError("tie must be 'zero' or 'first'")


def winner_name(flag: Column, team1: Column, team2: Column) -> Column:
    """team1 when the flag is 1, else team2."""
    return F.when(flag == 1, team1).otherwise(team2)


def season_predictions(df: DataFrame, pred_cols: Sequence[str], week: str = "week",
                       team1: str = "team1", team2: str = "team2", tie: str = "zero") -> DataFrame:
    """F13 + F15 + P6: consensus, winner name and the result projection
    ``week, team1, team2, consensus_winner, *_prediction``."""
    out = df.withColumn("consensus_prediction", consensus(pred_cols, tie))
    out = out.withColumn("consensus_winner", winner_name(F.col("consensus_prediction"), F.col(team1), F.col(team2)))
    keep = [c for c in df.columns if c not in (week, team1, team2) and c.endswith("_prediction")]
    return out.select(week, team1, team2, "consensus_winner", *keep)
