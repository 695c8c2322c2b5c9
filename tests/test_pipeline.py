from conftest import SF_SMALL
from matchspark.plans import common, pipeline
from matchspark.sources import sinks

GRIDS = {"random_forest": {"n_estimators": [5], "max_depth": [3]},
         "logistic_regression": {"C": [1.0], "penalty": ["l2"], "max_iter": [10]},
         "xgboost": {"n_estimators": [3], "max_depth": [2], "learning_rate": [0.1], "subsample": [1.0],
                     "colsample_bytree": [1.0]}}


def test_train_save_load_and_score_season(spark, tmp_path):
    games = common.game_rows(spark, SF_SMALL)
    out = str(tmp_path / "run")
    res = pipeline.train_pipeline(games, grids=GRIDS, out_dir=out, parallelism=2)
    assert res.test_seasons and res.val_seasons and len(res.train_seasons) >= 1
    assert max(res.train_seasons) < min(res.val_seasons) < min(res.test_seasons)
    counts = res.split_counts
    assert counts["train"] + counts["val"] + counts["test"] == counts["total"]
    m = {(r["split"], r["model_name"]): r for r in res.metrics.collect()}
    assert len(m) == 6 and all(0.0 <= r["accuracy"] <= 1.0 for r in m.values())

    meta = sinks.read_metadata(spark, out + "/metadata")
    assert meta["num_features"] == 36 and meta["test_seasons"] == res.test_seasons

    fitted, scaler = pipeline.load_run(spark, out)
    assert scaler.columns == meta["feature_names"]
    again = {r["model_name"]: r["accuracy"] for r in pipeline.evaluate_run(spark, out, games).collect()}
    assert again == {n: r["accuracy"] for (s, n), r in m.items() if s == "test"}
    season = games.where(games.season.cast("string").isin(res.test_seasons))
    pred = pipeline.predict_season(season, fitted, scaler)
    rows = pred.collect()
    assert len(rows) == season.count()
    assert pred.columns[:4] == ["week", "team1", "team2", "consensus_winner"]
    assert all(r["consensus_winner"] in (r["team1"], r["team2"]) for r in rows)


def test_requests_do_not_contaminate_each_other(spark):
    """A request alone and among 1,000 others of the same team has the same features."""
    from pyspark.sql import functions as F

    from matchspark.functions.constants import FEATURE_NAMES
    from matchspark.operators import features
    from matchspark.session import materialize
    one = materialize(common.game_rows(spark, SF_SMALL).orderBy("game_id").limit(1).drop("game_id", "week", "team1_score", "team2_score"))
    many = one.crossJoin(spark.range(1000)).withColumn("team1_off_PTS", F.col("team1_off_PTS") + F.col("id"))
    alone = features.independent_features(one).select(*FEATURE_NAMES).collect()
    batch = features.independent_features(many).where("id = 0").select(*FEATURE_NAMES).collect()
    assert alone == batch


def test_default_lookup_tables(spark):
    from matchspark.sources import lookups
    conf = lookups.conference_table(spark)
    assert conf.count() == 32 and {r["count"] for r in conf.groupBy("conference").count().collect()} == {16}
    odds = lookups.stadium_odds(spark).groupBy("home_team").agg({"p": "sum"}).collect()
    assert len(odds) == 32


def test_games_are_derived_once(spark, monkeypatch):
    """Split policy and features read the stored ratio frame, and the scaled frame is a projection of stored features."""
    from matchspark.operators import split as S
    seen, real = [], S.split_policy
    monkeypatch.setattr(S, "split_policy", lambda df, *a: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, *a))
    prep = pipeline.prepare_training(common.game_rows(spark, SF_SMALL))
    assert len(seen) == 1 and "Join" not in seen[0] and "Relation" not in seen[0]
    assert prep.ratios.count() == prep.scaled.count() == prep.counts["total"]
    plan = prep.scaled._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_adhoc_derives_games_and_statistics_once(spark, monkeypatch):
    import __spark_entry__ as E
    from matchspark.functions.constants import FEATURE_NAMES
    from matchspark.operators import search
    from matchspark.plans import catalog
    from matchspark.sources import standins
    calls = []
    games, stats = standins.games, common.team_stats
    monkeypatch.setattr(standins, "games", lambda *a: calls.append("games") or games(*a))
    monkeypatch.setattr(common, "team_stats", lambda *a: calls.append("stats") or stats(*a))
    small = {"logistic_regression": {"C": [1], "penalty": ["l2"], "max_iter": [3]}}
    monkeypatch.setattr(catalog, "_fitted", lambda prep: search.fit_points(prep.train, FEATURE_NAMES, small, names=list(small)))
    got = E.queries()["adhoc_matchups"](spark, SF_SMALL)
    known = {(r.season, r.Name) for r in stats(spark, SF_SMALL).select("season", "Name").collect()}
    met = {(r.season, r.team1, r.team2) for r in games(spark, SF_SMALL).select("season", "team1", "team2").distinct().collect()}
    assert got.count() == sum((s, a) in known and (s, b) in known for s, a, b in met)
    assert sorted(calls) == ["games", "stats"]
