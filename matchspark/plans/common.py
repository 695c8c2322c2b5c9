"""Shared derived frames for the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, joins
from ..session import broadcast_if_small
from ..sources import standins

KEYS = ["game_id", "season", "week", "team1", "team2"]


def team_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged offense/defense statistics per (season, Name)."""
    return joins.merge_team_stats(standins.offense(spark, sf_dir), standins.defense(spark, sf_dir))


def game_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games with both teams' statistics as team1_* / team2_*."""
    return joins.games_with_stats(standins.games(spark, sf_dir), team_stats(spark, sf_dir))


def game_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1-E10 on the game rows."""
    return features.turnover_features(features.efficiency_features(game_rows(spark, sf_dir)))


#: ``x * 10^digits`` below this and no closer to a tie than that is rounded in binary.
PLAIN_BELOW, TIE = 1e12, 1e-3


def half_even(x: Column, digits: int = 6) -> Column:
    """``bround(x, digits)`` of a double.  It goes through a decimal for every value; away
    from ties the nearest multiple is the same, and a division gives its double."""
    power = float(10 ** digits)
    y = x * power
    plain = (F.abs(y) < PLAIN_BELOW) & (F.abs(F.abs(y - F.rint(y)) - 0.5) > TIE)
    # adding 0.0 turns a negative zero into zero, as a decimal does
    return F.when(plain, F.rint(y) / power + 0.0).otherwise(F.bround(x, digits))


def round_cols(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    """Half-even rounding of long floating-point chains for comparison.  Doubles are rounded as
    one array, so that the code of many columns stays short."""
    kinds = dict(df.dtypes)
    doubles = [c for c in dict.fromkeys(cols) if kinds[c] == "double"]
    out = {c: F.bround(F.col(c), digits) for c in cols if c not in doubles}
    if doubles:
        df = df.withColumn("__rounded", F.transform(F.array(*doubles), lambda x: half_even(x, digits)))
        out.update({c: F.col("__rounded")[k] for k, c in enumerate(doubles)})
    return df.withColumns(out).drop("__rounded")


# ---------------------------------------------------------------- masked stats
# Stand-in with missing values: nulls by fixed masks on the nation key, so
# the null shares are the same at every scale (def_PA 13 of 25 nations ->
# dropped at 0.20; off_QB 3 of 25; conference 3 of 25; off_Run one season).
MASKED_COLUMNS = ["season", "Name", "conference", "GP", "off_PTS", "off_Run", "off_QB", "def_PA", "def_DEF"]


def masked_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import table
    st = team_stats(spark, sf_dir)
    nk = broadcast_if_small(table(spark, sf_dir, "nation").select(F.col("n_name").alias("Name"), "n_nationkey"))
    conf = broadcast_if_small(standins.conferences(spark, sf_dir).withColumnRenamed("team", "Name"))
    j = st.join(nk, "Name").join(conf, "Name")
    k = F.col("n_nationkey")

    def null_when(cond, c):
        return F.when(cond, F.lit(None)).otherwise(F.col(c))

    return j.select(
        "season", "Name",
        null_when(k % 12 == 0, "conference").alias("conference"),
        "GP", "off_PTS",
        null_when((F.col("season") == 1998) & (k % 2 == 1), "off_Run").alias("off_Run"),
        null_when(k % 9 == 0, "off_QB").alias("off_QB"),
        null_when(k % 2 == 0, "def_PA").alias("def_PA"),
        "def_DEF")


# ---------------------------------------------------------------- rule models
# Three deterministic "models" over the game ratios stand in for trained
# classifiers where an exact oracle is wanted (metrics, votes).
RULE_MODELS = ["points", "yards", "defense"]


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide: game keys, actual ``y``, ``<m>_prediction`` and
    ``<m>_team1_win_prob`` for each rule model."""
    g = game_ratios(spark, sf_dir)
    p1, p2 = F.col("team1_points_per_game"), F.col("team2_points_per_game")
    y1, y2 = F.col("team1_yards_per_game"), F.col("team2_yards_per_game")
    a1, a2 = F.col("team1_points_allowed_per_game"), F.col("team2_points_allowed_per_game")
    return g.select(
        *KEYS,
        (F.col("team1_score") > F.col("team2_score")).cast("int").alias("y"),
        (p1 > p2).cast("int").alias("points_prediction"),
        (p1 / (p1 + p2)).alias("points_team1_win_prob"),
        (y1 > y2).cast("int").alias("yards_prediction"),
        (y1 / (y1 + y2)).alias("yards_team1_win_prob"),
        (a1 < a2).cast("int").alias("defense_prediction"),
        (a2 / (a1 + a2)).alias("defense_team1_win_prob"))


def rule_predictions_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long: ``(game_id, model, y, prediction, p_team1)``."""
    w = rule_predictions(spark, sf_dir)
    return w.select("game_id", "y", F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(f"{m}_prediction").alias("prediction"),
                 F.col(f"{m}_team1_win_prob").alias("p_team1")) for m in RULE_MODELS])))
