"""Results, standings, streaks, ratings order and the game-score model
(A1, K2, K3, W3, W4, E16-E25, J4-J6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ratings as R
from ..functions.constants import WEATHER_CONDITIONS
from ..functions.draw import weighted_choice
from ..session import broadcast_if_small
from . import windows
from .joins import Lookup


def results_long(games: DataFrame, team1="team1", team2="team2", score1="team1_score",
                 score2="team2_score", keep: Sequence[str] = ("game_id", "season", "week")) -> DataFrame:
    """Each game as two ``(team, opponent, result)`` rows, result in
    win / loss / tie from that team's side.  A narrow ``stack`` — no shuffle."""
    s1, s2 = F.col(score1), F.col(score2)
    r1 = F.when(s1 > s2, "win").when(s1 < s2, "loss").otherwise("tie")
    r2 = F.when(s2 > s1, "win").when(s2 < s1, "loss").otherwise("tie")
    g = games.select(*keep, F.col(team1).alias("__t1"), F.col(team2).alias("__t2"),
                     r1.alias("__r1"), r2.alias("__r2"))
    return g.select(*keep, F.inline(F.array(
        F.struct(F.col("__t1").alias("team"), F.col("__t2").alias("opponent"), F.col("__r1").alias("result"),
                 F.lit(1).alias("role")),
        F.struct(F.col("__t2").alias("team"), F.col("__t1").alias("opponent"), F.col("__r2").alias("result"),
                 F.lit(2).alias("role")),
    )))


def streaks_by_game(games: DataFrame, key: str = "game_id") -> DataFrame:
    """W3 back in game form: ``(game_id, team1_streak, team2_streak)`` =
    each side's streak entering the game.  The two long rows of a game are
    folded with one ``groupBy(game_id)`` (instead of one join per role)."""
    st = win_streaks(results_long(games))
    return st.groupBy(key).agg(
        F.max(F.when(F.col("role") == 1, F.col("streak_before"))).alias("team1_streak"),
        F.max(F.when(F.col("role") == 2, F.col("streak_before"))).alias("team2_streak"))


def standings(results: DataFrame, team="team", result="result", by: Sequence[str] = (),
              teams: DataFrame | None = None) -> DataFrame:
    """A1: wins / losses / ties per team (optionally per ``by``).  Partial
    aggregation makes a hot team cost one row per task before the shuffle.
    With a list of ``teams`` (columns ``by`` and ``team``), those without a
    game are there too, with 0-0-0."""
    r = F.col(result)
    table = results.groupBy(*by, team).agg(
        F.count_if(r == "win").alias("wins"),
        F.count_if(r == "loss").alias("losses"),
        F.count_if(r == "tie").alias("ties"))
    if teams is None:
        return table
    listed = teams.select(*by, team).distinct()
    return listed.join(table, [*by, team], "left").na.fill(0, ["wins", "losses", "ties"])


def conference_standings(table: DataFrame, conferences: DataFrame, team="team",
                         by: Sequence[str] = ()) -> DataFrame:
    """K2: standings with conference and the place inside it (wins
    descending, team name breaking ties).  Teams without a conference
    vanish (inner join); the conference list (one row per team) is
    broadcast when its size estimate is small."""
    j = table.join(broadcast_if_small(conferences), team, "inner")
    w = Window.partitionBy(*by, "conference").orderBy(F.desc("wins"), F.col(team))
    return j.withColumn("conference_rank", F.row_number().over(w))


def rank_by(df: DataFrame, partition_by: Sequence[str], order: Sequence, name: str = "position") -> DataFrame:
    """1..n numbering in sorted order within each partition."""
    w = Window.partitionBy(*partition_by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w))


def win_streaks(results: DataFrame) -> DataFrame:
    """W3 on the long results: ``win_streak`` after and ``streak_before``."""
    return windows.win_streak(results)


def team_ratings(offense_defense: DataFrame) -> DataFrame:
    """E16-E20 on the J4 frame (prefixed offense / defense columns).  A team
    without a defense row (``has_defense`` false) has null ratings."""
    cols = R.rating_columns(offense_defense.columns)
    if "has_defense" in offense_defense.columns:
        cols = {n: F.when(F.col("has_defense"), e) for n, e in cols.items()}
    return offense_defense.withColumns(cols)


def ratings_summary(ratings: DataFrame) -> DataFrame:
    """Display values."""
    return ratings.withColumns(R.summary_columns())


def game_scores(games: DataFrame, ratings: DataFrame, name="Name", keys: Sequence[str] = ("season",),
                streak1: str | None = None, streak2: str | None = None, home_role: str = "team2",
                condition: str | None = None, use_weather: bool = False) -> DataFrame:
    """J5 + E22 + E23: both teams' ratings joined to each game; score per
    side, outcome and sentence.  ``home_role`` gets the 1.05 factor; with
    ``use_weather`` the E21 factors of ``condition`` scale efficiency and
    net production (the original computes but ignores them)."""
    keys = list(keys)
    lookup = Lookup(ratings.select(*keys, F.col(name).alias("__n"), "team_efficiency", "net_production",
                                   "production_allowed"))
    rs = lookup.frame
    r1 = rs.select(*keys, F.col("__n").alias("team1"), *[F.col(c).alias(f"__1_{c}") for c in rs.columns[len(keys) + 1:]])
    r2 = rs.select(*keys, F.col("__n").alias("team2"), *[F.col(c).alias(f"__2_{c}") for c in rs.columns[len(keys) + 1:]])
    j = lookup.join(lookup.join(games, r1, keys + ["team1"]), r2, keys + ["team2"])
    e1, e2 = F.col("__1_team_efficiency"), F.col("__2_team_efficiency")
    n1, n2 = F.col("__1_net_production"), F.col("__2_net_production")
    if use_weather and condition is not None:
        fe, fn = R.weather_factor(F.col(condition), 0), R.weather_factor(F.col(condition), 1)
        e1, e2, n1, n2 = e1 * fe, e2 * fe, n1 * fn, n2 * fn
    s1 = F.col(streak1) if streak1 else F.lit(0)
    s2 = F.col(streak2) if streak2 else F.lit(0)
    sc1 = R.game_score(e1, n1, F.col("__2_production_allowed"), s1, home=home_role == "team1")
    sc2 = R.game_score(e2, n2, F.col("__1_production_allowed"), s2, home=home_role == "team2")
    out = (j.withColumn("score1", sc1).withColumn("score2", sc2)
           .withColumn("outcome", R.outcome(F.col("score1"), F.col("score2"))))
    out = out.withColumn("summary", R.outcome_sentence(F.col("week"), F.col("team1"), F.col("team2"),
                                                       F.col("outcome")))
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def weather_odds_wide(odds: DataFrame, conditions: Sequence[str] = WEATHER_CONDITIONS) -> DataFrame:
    """Long odds ``(home_team, condition, p)`` -> one row per home team."""
    return odds.groupBy("home_team").pivot("condition", list(conditions)).agg(F.first("p"))


def draw_weather(games: DataFrame, odds: DataFrame, u, home: str = "team2",
                 conditions: Sequence[str] = WEATHER_CONDITIONS, name: str = "weather") -> DataFrame:
    """One condition per game drawn with the home team's odds from the
    uniform column ``u``; a home team without odds gets Clear.  The odds
    (a few rows per team) are broadcast in wide form when their size
    estimate is small: no shuffle of games."""
    wide = weather_odds_wide(odds, conditions).withColumnRenamed("home_team", "__home")
    j = games.join(broadcast_if_small(wide), games[home] == wide["__home"], "left")
    absent = F.col("__home").isNull()
    ws = [F.when(absent, F.lit(1.0 if c == conditions[0] else 0.0)).otherwise(F.coalesce(F.col(c), F.lit(0.0)))
          for c in conditions]
    return j.withColumn(name, weighted_choice(u, list(conditions), ws)).drop("__home", *conditions)
