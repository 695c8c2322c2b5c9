import random

import pytest
from pyspark.sql import functions as F

from matchspark.operators import metrics, split, vote


def _frame(spark):
    rnd = random.Random(0)
    rows = [(str(s), w, "A", "B", rnd.randint(10, 39), rnd.randint(10, 39)) for s in range(2019, 2024) for w in range(100)]
    df = spark.createDataFrame(rows, "season string, week int, team1 string, team2 string, team1_score int, team2_score int")
    return df.withColumn("game_id", F.monotonically_increasing_id())


def test_three_one_one(spark):
    out = split.split_data(_frame(spark), ["2019", "2020", "2021"], ["2022"], ["2023"])
    c = split.split_counts(out).first()
    assert (c["train"], c["val"], c["test"], c["total"]) == (300, 100, 100, 500)
    assert split.overlap_audit(out).count() == 0


@pytest.mark.parametrize("args,msg", [
    (([], ["2022"], ["2023"]), "cannot be empty"),
    ((["2021", "2022"], ["2022"], ["2023"]), "both train and val"),
    ((["2022"], ["2021"], ["2023"]), "Temporal ordering violation"),
])
def test_assignment_errors(args, msg):
    with pytest.raises(ValueError, match=msg):
        split.validate_assignments(*args)


def test_data_errors(spark):
    with pytest.raises(ValueError, match="must contain 'season' column"):
        split.split_data(_frame(spark).drop("season"), ["2019"], ["2020"], ["2021"])
    with pytest.raises(ValueError, match="Required seasons not found"):
        split.split_data(_frame(spark), ["2017"], ["2020"], ["2021"])


@pytest.mark.parametrize("n,train", [(3, 1), (4, 2), (5, 3), (7, 5)])
def test_split_policy(spark, n, train):
    df = spark.createDataFrame([(str(2000 + i),) for i in range(n)], "season string")
    got = {r["season"]: r["split"] for r in split.split_policy(df).collect()}
    assert got[str(2000 + n - 1)] == "test" and got[str(2000 + n - 2)] == "val"
    assert sum(v == "train" for v in got.values()) == train


def test_policy_needs_three_seasons(spark):
    with pytest.raises(ValueError):
        split.split_policy(spark.createDataFrame([("2020",), ("2021",)], "season string"))


def _m(spark, y, p):
    df = spark.createDataFrame([("m", a, b) for a, b in zip(y, p)], "model string, y int, prediction int")
    return metrics.add_metrics(metrics.confusion(df)).first()


def test_perfect_and_known_matrix(spark):
    r = _m(spark, [0, 0, 1, 1], [0, 0, 1, 1])
    assert (r["accuracy"], r["precision"], r["recall"], r["f1_score"]) == (1.0, 1.0, 1.0, 1.0)
    r = _m(spark, [0, 0, 1, 1], [0, 1, 1, 1])
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (1, 1, 0, 2)
    assert r["accuracy"] == 0.75 and r["precision"] == pytest.approx(2 / 3) and r["recall"] == 1.0
    assert r["f1_score"] == pytest.approx(0.8)


def test_single_class_is_still_two_by_two(spark):
    r = _m(spark, [1, 1, 1], [1, 1, 1])
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (0, 0, 0, 3)
    r = _m(spark, [0, 0], [0, 0])
    assert r["precision"] == 0.0 and r["f1_score"] == 0.0


def test_vote_tie_rules(spark):
    df = spark.createDataFrame([(1, 0, "A", "B"), (0, 1, "A", "B"), (1, 1, "A", "B")], "p1 int, p2 int, team1 string, team2 string")
    zero = [r[0] for r in df.select(vote.consensus(["p1", "p2"], "zero")).collect()]
    first = [r[0] for r in df.select(vote.consensus(["p1", "p2"], "first")).collect()]
    assert zero == [0, 0, 1] and first == [1, 0, 1]
    c = [r[0] for r in df.select(vote.confidence(F.col("p1"), F.lit(0.8))).collect()]
    assert c == pytest.approx([0.8, 0.2, 0.8])


def test_split_assignment_never_deals_rows_by_season(spark):
    from matchspark.operators import split as S
    df = spark.createDataFrame([(i, str(2019 + i % 4)) for i in range(40)], "game_id long, season string")
    out = S.split_data(df, ["2019", "2020"], ["2021"], ["2022"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    got = {r.game_id: r.split for r in out.collect()}
    assert got == {i: ("train", "train", "val", "test")[i % 4] for i in range(40)}
