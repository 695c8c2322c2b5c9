import pytest
from pyspark.sql import functions as F

from matchspark.functions.constants import STADIUM_WEATHER
from matchspark.functions.draw import hash_uniform
from matchspark.operators import joins, results
from matchspark.sources.standins import weather_odds_table


def _one_team(spark):
    off = spark.createDataFrame([("2023", "T", 17, 28.0, 81.1, 30.0, 45.0, 16.0)],
                                "season string, Name string, GP int, PTS double, All double, Run double, Pass double, QB double")
    dfn = spark.createDataFrame([("2023", "T", 17, 19.0, 9.2, 20.0, 25.0, 20.0, 10.0)],
                                "season string, Name string, GP int, PA double, DEF double, QB double, RB double, WR double, TE double")
    return results.team_ratings(joins.offense_with_defense(off, dfn))


def test_team_formulas(spark):
    r = _one_team(spark).first()
    assert r["x_off"] == pytest.approx(27.409)
    assert r["x_def"] == pytest.approx(19.392)
    assert r["net"] == pytest.approx(8.017)
    assert r["x_wins"] == pytest.approx(11.851106)
    assert r["x_losses"] == pytest.approx(5.148894)
    assert r["net_production"] == 146.0
    assert r["production_allowed"] == 75.0
    assert r["team_efficiency"] == pytest.approx(81.1 / 75.0)
    assert r["expected_points_for"] == pytest.approx(28.0 * 81.1 / 75.0)


def test_offense_without_defense_is_flagged(spark):
    off = spark.createDataFrame([("2023", "T", 17, 81.1)], "season string, Name string, GP int, All double")
    dfn = spark.createDataFrame([("2023", "U", 17, 9.2)], "season string, Name string, GP int, DEF double")
    r = joins.offense_with_defense(off, dfn).first()
    assert r["has_defense"] is False


def test_standings_and_conference(spark):
    g = spark.createDataFrame([(1, 1, 1, "A", "B", 10.0, 3.0), (2, 1, 2, "B", "C", 5.0, 5.0), (3, 1, 3, "C", "A", 1.0, 2.0)],
                              "game_id long, season int, week int, team1 string, team2 string, team1_score double, team2_score double")
    st = {r["team"]: (r["wins"], r["losses"], r["ties"]) for r in results.standings(results.results_long(g)).collect()}
    assert st == {"A": (2, 0, 0), "B": (0, 1, 1), "C": (0, 1, 1)}
    conf = spark.createDataFrame([("A", "X"), ("B", "X"), ("C", "Y")], "team string, conference string")
    ranked = {r["team"]: r["conference_rank"] for r in
              results.conference_standings(results.standings(results.results_long(g)), conf).collect()}
    assert ranked == {"A": 1, "B": 2, "C": 1}


def test_outcome_and_sentence(spark):
    g = spark.createDataFrame([(1, "2023", 5, "A", "B")], "game_id long, season string, week int, team1 string, team2 string")
    r = spark.createDataFrame([("2023", "A", 1.0, 100.0, 10.0), ("2023", "B", 1.0, 50.0, 10.0)],
                              "season string, Name string, team_efficiency double, net_production double, production_allowed double")
    out = results.game_scores(g, r).first()
    assert out["outcome"] == "win1" and out["summary"] == "Week 5: A defeat B."
    assert out["score2"] == pytest.approx((1.0 + 50.0 - 10.0) * 1.05)


def test_weather_support(spark):
    odds = weather_odds_table(spark, STADIUM_WEATHER)
    homes = ["Arizona Cardinals", "Houston Texans", "Green Bay Packers", "Miami Dolphins", "Nowhere"]
    g = spark.range(4000).select(F.col("id").alias("game_id"),
                                 F.element_at(F.array(*[F.lit(h) for h in homes]), (F.col("id") % 5 + 1).cast("int")).alias("team2"))
    w = results.draw_weather(g, odds, hash_uniform(F.col("game_id"), seed=1))
    seen = {r["team2"]: set(r["c"]) for r in w.groupBy("team2").agg(F.collect_set("weather").alias("c")).collect()}
    assert seen["Arizona Cardinals"] == {"Clear"} and seen["Houston Texans"] == {"Clear"}
    assert seen["Green Bay Packers"] == {"Clear", "Rain", "Snow", "Wind"}
    assert seen["Miami Dolphins"] == {"Clear", "Rain"} and seen["Nowhere"] == {"Clear"}
    again = results.draw_weather(g, odds, hash_uniform(F.col("game_id"), seed=1))
    assert w.exceptAll(again).count() == 0          # seeded: reproducible


def test_duplicate_offense_keeps_last_and_defense_first(spark):
    off = spark.createDataFrame([("2023", "T", 17, 10.0, 1), ("2023", "T", 17, 20.0, 2)],
                                "season string, Name string, GP int, All double, pos int")
    dfn = spark.createDataFrame([("2023", "T", 17, 1.0, 1), ("2023", "T", 17, 2.0, 2)],
                                "season string, Name string, GP int, DEF double, pos int")
    r = joins.offense_with_defense(off, dfn, position="pos").collect()
    assert len(r) == 1 and r[0]["off_All"] == 20.0 and r[0]["def_DEF"] == 1.0


def test_rest_days_difference(spark):
    from matchspark.operators import features
    df = spark.createDataFrame([(7, 4)], "team1_rest_days int, team2_rest_days int")
    assert features.categorical_features(df).first()["rest_days_difference"] == 3


def test_broadcast_only_behind_size_check(spark, tmp_path):
    from matchspark.session import broadcast_if_small
    spark.createDataFrame([("A", 1)], "k string, v int").write.parquet(str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))          # size estimate from the file
    big = spark.range(100).selectExpr("cast(id as string) as k")
    hinted = big.join(broadcast_if_small(small), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in hinted.lower()
    plain = big.join(broadcast_if_small(small, max_bytes=0), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plain.lower()
    unknown = spark.createDataFrame([("A", 1)], "k string, v int")     # no estimate: no hint, AQE decides
    assert "strategy=broadcast" not in big.join(broadcast_if_small(unknown), "k")._jdf.queryExecution() \
        .optimizedPlan().toString().lower()
