import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from matchspark.functions.constants import FEATURE_NAMES
from matchspark.operators import features, models, scaling
from matchspark.plans import common
from matchspark.session import materialize
from matchspark.streaming.schedule_stream import start_scoring

GRIDS = {"random_forest": {"n_estimators": [5], "max_depth": [3]},
         "logistic_regression": {"C": [1.0], "penalty": ["l2"], "max_iter": [10]},
         "xgboost": {"n_estimators": [3], "max_depth": [2], "learning_rate": [0.1], "subsample": [1.0],
                     "colsample_bytree": [1.0]}}


def test_stream_scores_arriving_schedule_files(spark, tmp_path):
    feats = materialize(features.build_features(common.game_rows(spark, SF_SMALL)))
    scaler = scaling.Scaler(FEATURE_NAMES).fit(feats)
    trained = models.train_models(scaler.transform(feats), FEATURE_NAMES, grids=GRIDS, parallelism=2)
    fitted = {n: t[0] for n, t in trained.items()}
    stats = common.team_stats(spark, SF_SMALL).withColumn("season", F.col("season").cast("string"))
    folder = tmp_path / "incoming"
    folder.mkdir()
    with open(folder / "1998 Schedule.csv", "w") as fh:
        fh.write("Week,Team1,Team2\n1,NATION_3,NATION_8\n2,NATION_12,NATION_13\n3,NATION_15,NOBODY\n")
    out = str(tmp_path / "out")
    q = start_scoring(spark, str(folder), stats, fitted, scaler, out, name=f"t{os.getpid()}", available_now=True)
    q.awaitTermination(300)
    res = spark.read.parquet(out)
    rows = res.collect()
    assert len(rows) == 2                                  # the game with an unknown team is dropped
    assert {"week", "team1", "team2", "consensus_winner"} <= set(res.columns)
    assert all(r["consensus_winner"] in (r["team1"], r["team2"]) for r in rows)
