import math

import pytest
from pyspark.sql import functions as F

from conftest import game_frame
from matchspark.functions.constants import FEATURE_NAMES
from matchspark.operators import features, scaling


def test_known_ratios(spark):
    df = features.efficiency_features(game_frame(spark)).orderBy("game_id").collect()
    assert df[0]["team1_points_per_game"] == pytest.approx(28.5 / 17)
    assert df[0]["team1_yards_per_game"] == pytest.approx(82.3 / 17)
    assert df[0]["team1_offensive_efficiency"] == pytest.approx(82.3 / (17 * 65))
    assert df[0]["team1_defensive_efficiency"] == pytest.approx(1.0 / (6.5 / 17 + 1))


def test_turnover_identity_and_clip(spark):
    rows = features.turnover_features(game_frame(spark)).collect()
    for r in rows:
        for t in ("team1", "team2"):
            assert r[f"{t}_turnover_ratio"] == pytest.approx(r[f"{t}_turnovers_gained"] - r[f"{t}_turnovers_lost"])
            assert r[f"{t}_turnovers_gained"] >= 0 and r[f"{t}_turnovers_lost"] >= 0


def test_zero_games_played_is_null_not_error(spark):
    df = game_frame(spark).withColumn("team1_GP", F.lit(0.0))
    r = features.efficiency_features(df).first()
    assert r["team1_points_per_game"] is None


def test_missing_source_columns_default_zero(spark):
    df = game_frame(spark).drop("team1_off_Pass", "team2_off_Pass")
    r = features.efficiency_features(df).first()
    assert r["team1_pass_yards_per_game"] == 0.0


def test_rolling_first_row_equals_value(spark):
    df = features.rolling_features(features.efficiency_features(game_frame(spark)))
    rows = {r["game_id"]: r for r in df.collect()}
    assert rows[1]["team1_points_per_game_rolling_3games"] == pytest.approx(rows[1]["team1_points_per_game"])
    # A is team1 in games 1 and 3: the mean of both
    assert rows[3]["team1_points_per_game_rolling_3games"] == pytest.approx(28.5 / 17)


def test_head_to_head_without_history(spark):
    r = features.matchup_features(game_frame(spark)).collect()
    assert all(x["head_to_head_win_pct"] == 0.5 and x["head_to_head_avg_point_diff"] == 0.0 for x in r)


def test_categorical_defaults_and_weather(spark):
    r = features.categorical_features(game_frame(spark)).first()
    assert (r["weather_clear"], r["weather_rain"], r["home_field_advantage"], r["rest_days_difference"]) == (1, 0, 1, 0)
    w = game_frame(spark).withColumn("weather", F.element_at(F.array(F.lit("Clear"), F.lit("Rain"), F.lit("Snow")),
                                                             F.col("game_id").cast("int")))
    rows = {x["game_id"]: x for x in features.categorical_features(w).collect()}
    assert (rows[1]["weather_clear"], rows[2]["weather_rain"], rows[3]["weather_snow"]) == (1, 1, 1)
    assert rows[3]["weather_wind"] == 0


def test_all_36_features_and_scaling(spark):
    df = features.build_features(game_frame(spark))
    assert all(c in df.columns for c in FEATURE_NAMES) and len(FEATURE_NAMES) == 36
    sc = scaling.Scaler(FEATURE_NAMES).fit(df)
    out = sc.transform(df)
    stats = out.agg(*[F.avg(c).alias(f"m_{c}") for c in FEATURE_NAMES],
                    *[F.stddev_pop(c).alias(f"s_{c}") for c in FEATURE_NAMES]).first()
    for c in FEATURE_NAMES:
        assert abs(stats[f"m_{c}"]) < 1e-9
        assert stats[f"s_{c}"] == pytest.approx(1.0) or stats[f"s_{c}"] == pytest.approx(0.0, abs=1e-12)


def test_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    st = scaling.fit_scaler(df, ["x"]).first()
    assert st["x__std"] == pytest.approx(math.sqrt(1.25))


def test_transform_before_fit(spark):
    sc = scaling.Scaler(["x"])
    with pytest.raises(ValueError, match="Scaler must be fitted"):
        sc.transform(spark.createDataFrame([(1.0,)], "x double"))


def test_label_on_raw_values(spark):
    df = features.label(features.efficiency_features(game_frame(spark)))
    rows = {r["game_id"]: r["label"] for r in df.collect()}
    assert rows == {1: 1, 2: 1, 3: 1}
