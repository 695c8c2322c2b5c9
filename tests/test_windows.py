import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from matchspark.operators import windows


def _events(spark, n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 9)}"   # one key holds half the rows
        rows.append((key, rnd.randint(0, 20), i, rnd.choice([None, *range(10)]), rnd.choice(["win", "loss", "tie"])))
    return spark.createDataFrame(rows, "key string, day int, id long, v int, result string")


def test_prefix_scan_matches_brute_force(spark):
    df = _events(spark)
    out = windows.prefix_scan(df, ["key"], ["day", "id"], {
        "cs": ("sum", F.col("v")), "cx": ("sum", F.col("v"), False), "mx": ("max", F.col("v")),
        "n": ("count", F.lit(1)), "nx": ("count", F.col("v"), False)}).toPandas()
    pdf = df.toPandas().sort_values(["key", "day", "id"])
    for _, g in pdf.groupby("key"):
        vals = list(g["v"])
        for pos, (_, row) in enumerate(g.iterrows()):
            got = out[out.id == row.id].iloc[0]
            prev = [x for x in vals[:pos] if x is not None and not pd.isna(x)]
            incl = [x for x in vals[:pos + 1] if x is not None and not pd.isna(x)]
            assert got.n == pos + 1
            assert got.nx == len(prev)
            assert (pd.isna(got.cs) and not incl) or got.cs == sum(incl)
            assert (pd.isna(got.cx) and not prev) or got.cx == sum(prev)
            assert (pd.isna(got.mx) and not incl) or got.mx == max(incl)


@pytest.mark.parametrize("include_current,ranges", [(True, 3), (False, 3), (True, 120), (False, 120)])
def test_rolling_mean_across_ranges(spark, include_current, ranges):
    df = _events(spark, 300)
    out = windows.rolling_mean(df, ["key"], ["day", "id"], {"r": "v"}, window=3, include_current=include_current,
                               ranges=ranges).toPandas()
    assert len(out) == 300
    pdf = df.toPandas().sort_values(["key", "day", "id"])
    pdf["v"] = pdf["v"].astype(float)
    if include_current:
        exp = pdf.groupby("key")["v"].transform(lambda s: s.rolling(3, min_periods=1).mean())
    else:
        exp = pdf.groupby("key")["v"].transform(lambda s: s.shift(1).rolling(3, min_periods=1).mean())
    want = dict(zip(pdf["id"], exp))
    for _, r in out.iterrows():
        w = want[r.id]
        assert (pd.isna(w) and pd.isna(r.r)) or r.r == pytest.approx(w)


def test_streak_after_win_loss_tie(spark):
    rows = [("T", 1, 1, "win"), ("T", 2, 2, "win"), ("T", 3, 3, "loss"), ("T", 4, 4, "win"), ("T", 5, 5, "tie"),
            ("T", 6, 6, "win"), ("T", 7, 7, "win"), ("T", 8, 8, "win")]
    df = spark.createDataFrame(rows, "team string, season int, week int, result string").withColumn("game_id", F.col("week").cast("long"))
    out = {r["week"]: (r["win_streak"], r["streak_before"]) for r in windows.win_streak(df, ranges=5).collect()}
    assert [out[w][0] for w in range(1, 9)] == [1, 2, 0, 1, 0, 1, 2, 3]
    assert [out[w][1] for w in range(1, 9)] == [0, 1, 2, 0, 1, 0, 1, 2]


def test_streak_matches_brute_force_with_hot_key(spark):
    df = _events(spark).withColumnRenamed("key", "team")
    out = windows.win_streak(df, order_by=["day", "id"], ranges=40).toPandas()
    pdf = df.toPandas().sort_values(["team", "day", "id"])
    for _, g in pdf.groupby("team"):
        s = 0
        for _, row in g.iterrows():
            before = s
            s = s + 1 if row.result == "win" else 0
            got = out[out.id == row.id].iloc[0]
            assert (got.win_streak, got.streak_before) == (s, before)


def test_head_to_head_brute_force(spark):
    rnd = random.Random(3)
    teams = ["A", "B", "C", "D"]
    rows = []
    for gid in range(120):
        t1, t2 = rnd.sample(teams, 2)
        rows.append((gid, gid // 10, gid % 10, t1, t2, float(rnd.randint(0, 40)), float(rnd.randint(0, 40))))
    df = spark.createDataFrame(rows, "game_id long, season int, week int, team1 string, team2 string, "
                                     "team1_score double, team2_score double")
    out = {r["game_id"]: r for r in windows.head_to_head(df).collect()}
    hist = {}
    for gid, _, _, t1, t2, s1, s2 in rows:
        key = tuple(sorted([t1, t2]))
        past = hist.get(key, [])
        if past:
            wins = sum(1 for (w, _) in past if w == t1)
            diff = sum(d if a == t1 else -d for (_, (a, d)) in past) / len(past)
            assert out[gid]["head_to_head_win_pct"] == pytest.approx(wins / len(past))
            assert out[gid]["head_to_head_avg_point_diff"] == pytest.approx(diff)
        else:
            assert (out[gid]["head_to_head_win_pct"], out[gid]["head_to_head_avg_point_diff"]) == (0.5, 0.0)
        winner = t1 if s1 > s2 else t2 if s2 > s1 else None
        hist.setdefault(key, []).append((winner, (t1, s1 - s2)))


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 2, "y"), ("B", 5, "z")], "k string, pos int, v string")
    first = {r["k"]: r["v"] for r in windows.keep_first(df, "k", ["pos"]).collect()}
    last = {r["k"]: r["v"] for r in windows.keep_first(df, "k", ["pos"], last=True).collect()}
    assert first == {"A": "x", "B": "z"} and last == {"A": "y", "B": "z"}


def test_null_keys_and_chunks_are_groups(spark):
    rows = [(None, 1, 1, 2.0), (None, 2, 2, 4.0), (None, 2, 3, 6.0), ("a", None, 4, 1.0), ("a", None, 5, 3.0),
            ("a", 1, 6, 5.0)]
    df = spark.createDataFrame(rows, "k string, c int, id long, v double")
    pos = {r["id"]: r["rn"] for r in windows.row_position(df, ["k"], ["c", "id"], "rn").collect()}
    assert pos == {1: 1, 2: 2, 3: 3, 4: 1, 5: 2, 6: 3}
    roll = {r["id"]: r["r"] for r in windows.rolling_mean(df, ["k"], ["c", "id"], {"r": "v"}, ranges=4).collect()}
    assert roll[3] == 4.0 and roll[6] == 3.0


@pytest.mark.parametrize("order", ["tied", "text", "alpha"])
def test_many_ranges_equal_a_plain_window(spark, order):
    """Ties on all but the last column, ids as text, and ids that are no numbers."""
    from pyspark.sql import Window
    rows = [("hot", 1, f"{i}" if order != "alpha" else f"g{i}", i, float(i % 7)) for i in range(100)]
    df = spark.createDataFrame(rows, "key string, ts int, name string, id long, v double")
    by = ["ts", "id"] if order == "tied" else ["name"]
    w = Window.partitionBy("key").orderBy(*by)
    want = df.select("id", F.row_number().over(w).alias("n"), F.avg("v").over(w.rowsBetween(-2, 0)).alias("r")).collect()
    want = {r.id: (r.n, r.r) for r in want}
    pos = windows.row_position(df, ["key"], by, "n", ranges=25)
    roll = windows.rolling_mean(df, ["key"], by, {"r": "v"}, ranges=25)
    got = {r.id: (r.n, r.r) for r in pos.join(roll.select("id", "r"), "id").collect()}
    assert got.keys() == want.keys()
    assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1]) for i in want)
    sizes = windows.ordered_ranges(df, ["key"], by, 25).groupBy(windows.RANGE).count().agg(F.max("count")).first()[0]
    assert sizes <= 20          # one key, one timestamp, still spread
