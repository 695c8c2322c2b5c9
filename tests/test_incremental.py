"""Carried state, season folders, merged states, audits of a write, measured lookups, one committed file."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from matchspark.functions.constants import FEATURE_NAMES
from matchspark.operators import carried, features, joins, missing, observed, quality, scaling, windows
from matchspark.plans import common, pipeline
from matchspark.sources import season_table, sinks
from matchspark.sources.tables import TABLES

NAMES = ["median_sketches", "carried_rolling", "carried_streaks", "season_table", "observed_audit", "scaler_merged", "label_scaled",
         "salted_lookup", "importance_report", "game_rows", "game_scores", "features_unscaled"]


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got, res = E.queries()[name](spark, SF_SMALL), con.execute(E.oracle_sql()[name])
    cols = sorted(d[0] for d in res.description)
    assert sorted(got.columns) == cols
    norm = lambda v: float(v) if hasattr(v, "as_tuple") else v
    at = [[d[0] for d in res.description].index(c) for c in cols]
    left = sorted((tuple(norm(r[c]) for c in cols) for r in got.collect()), key=repr)
    right = sorted((tuple(norm(r[i]) for i in at) for r in res.fetchall()), key=repr)
    assert left == right and left


# ---------------------------------------------------------------- windows
def random_games(spark, n=400, teams=5, known=True, seed=3):
    """Games of few teams (one in a third of all), with ties, unknown results and null values."""
    r, rows = random.Random(seed), []
    for i in range(n):
        a, b = r.sample(range(teams), 2)
        if r.random() < .3:
            a, b = 0, max(1, b)
        score = (r.randint(0, 3), r.randint(0, 3)) if known and r.random() < .95 else (None, None)
        rows.append((2000 + i // 80, i // 10 % 8, f"t{a}", f"t{b}", i, *score, None if r.random() < .1 else r.random()))
    return spark.createDataFrame(rows, "season int, week int, team1 string, team2 string, game_id long, team1_score int, team2_score int, v double")


@pytest.mark.parametrize("cuts", [[2001], [2000, 2002, 2003]])
def test_state_of_parts_goes_on_like_one_scan(spark, cuts):
    games = random_games(spark)
    new = games.where(F.col("season") > cuts[-1])
    parts = [games.where((F.col("season") > a) & (F.col("season") <= b)) for a, b in zip([0, *cuts], cuts)]
    results = lambda g: g.select("season", "week", "game_id", F.col("team1").alias("team"), F.when(
        F.col("team1_score") > F.col("team2_score"), "win").otherwise("other").alias("result"))
    rows = pairs = streaks = None
    for p in parts:
        a = carried.rolling_state(p, "team1", carried.ORDER, ["v"], ranges=3)
        b, c = carried.pair_state(p), carried.streak_state(results(p), ranges=3)
        rows = a if rows is None else carried.merge_rolling(rows, a, "team1", carried.ORDER)
        pairs = b if pairs is None else carried.merge_pairs(pairs, b)
        streaks = c if streaks is None else carried.merge_streaks(streaks, c)
    assert rows.groupBy("team1").count().agg(F.max("count")).first()[0] == 2   # window - 1 rows a team, whatever the history
    whole = windows.rolling_mean(games, ["team1"], list(carried.ORDER), {"m": "v"}, ranges=5).where(F.col("season") > cuts[-1])
    went_on = carried.continue_rolling(new, rows, "team1", carried.ORDER, {"m": "v"}, ranges=4)
    near = lambda df: sorted((r.game_id, None if r.m is None else round(r.m, 12)) for r in df.collect())
    assert near(went_on) == near(whole)
    cols = ["game_id", "head_to_head_win_pct", "head_to_head_avg_point_diff"]
    whole = windows.head_to_head(games).where(F.col("season") > cuts[-1]).select(*cols)
    assert sorted(windows.head_to_head(new, history=pairs).select(*cols).collect()) == sorted(whole.collect())
    cols = ["game_id", "win_streak", "streak_before"]
    whole = windows.win_streak(results(games)).where(F.col("season") > cuts[-1]).select(*cols)
    assert sorted(windows.win_streak(results(new), history=streaks, ranges=3).select(*cols).collect()) == sorted(whole.collect())


def test_season_is_scored_and_added_from_carried_state(spark, tmp_path):
    """Features of the last season from state alone equal those of one run over all seasons; the
    feature table gets one folder more and its others stay untouched."""
    games = common.game_rows(spark, SF_SMALL)
    last = games.agg(F.max("season")).first()[0]
    ratios = features.turnover_features(features.efficiency_features(games))
    everything = features.build_features(games)
    old = games.where(F.col("season") < last)
    carried.History.of(ratios.where(F.col("season") < last)).save(f"{tmp_path}/state")
    season_table.write_seasons(features.build_features(old), f"{tmp_path}/table")
    before = {p: os.stat(p).st_mtime_ns for p in parts_of(f"{tmp_path}/table")}
    added = pipeline.add_season(spark, games.where(F.col("season") == last), f"{tmp_path}/table", f"{tmp_path}/state", f"{tmp_path}/next")
    cols = ["game_id", "label", *FEATURE_NAMES]
    rounded = lambda df: sorted(tuple(common.round_cols(df.select(*cols), FEATURE_NAMES).collect()))
    assert rounded(added) == rounded(everything.where(F.col("season") == last))
    after = {p: os.stat(p).st_mtime_ns for p in parts_of(f"{tmp_path}/table")}
    assert before.items() <= after.items() and {p for p in after if f"season={last}" in p} == after.keys() - before.keys()
    stored = season_table.read_seasons(spark, f"{tmp_path}/table", everything.schema)
    assert rounded(stored) == rounded(everything)
    # the merged state is the state of all games
    merged, whole = carried.History.load(spark, f"{tmp_path}/next"), carried.History.of(ratios)
    for a, b in ((merged.pairs, whole.pairs), (merged.streaks, whole.streaks)):
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(*a.columns).collect()), key=repr)
    # unknown results: a coming season still has its pairs' history
    coming = games.where(F.col("season") == last).drop("team1_score", "team2_score")
    known = features.build_features(coming, with_label=False, history=carried.History.load(spark, f"{tmp_path}/state"))
    anew = features.build_features(coming, with_label=False)
    assert anew.where("head_to_head_win_pct <> 0.5").count() == 0 < known.where("head_to_head_win_pct <> 0.5").count()


def parts_of(folder):
    return [os.path.join(d, f) for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet")]


def test_season_filter_is_a_partition_filter(spark, tmp_path):
    df = spark.createDataFrame([(str(s), g, float(g)) for s in (2020, 2021, 2022) for g in range(50)], "season string, game_id long, v double")
    season_table.write_seasons(df, f"{tmp_path}/t", files=6)
    one = season_table.read_seasons(spark, f"{tmp_path}/t", df.schema, ["2021"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "season" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert one.count() == 50 and one.schema == df.schema
    season_table.write_seasons(df.where("season = '2021' and game_id < 7"), f"{tmp_path}/t")   # replaces one season
    counts = {r.season: r["count"] for r in season_table.read_seasons(spark, f"{tmp_path}/t", df.schema).groupBy("season").count().collect()}
    assert counts == {"2020": 50, "2021": 7, "2022": 50}


# ---------------------------------------------------------------- joins
def test_lookup_is_broadcast_or_replicated_never_dealt_by_its_keys(spark):
    stats = spark.createDataFrame([("2023", t, float(i)) for i, t in enumerate("ABC")], "season string, Name string, p double")
    games = spark.range(3000).select(F.lit("2023").alias("season"), F.col("id").alias("game_id"), F.lit("A").alias("team1"),
                                     F.when(F.col("id") % 2 == 0, "B").otherwise("Z").alias("team2"))
    got = joins.games_with_stats(games, stats)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(season" not in plan
    salted = joins.Lookup(stats, cells=0, salts=8)
    s1 = joins.role_projection(salted.frame, "team1")
    spread = salted.join(games, s1, ["season", "team1"])
    assert not salted.small and "__salt" in spread._jdf.queryExecution().executedPlan().toString()
    want = games.join(s1, ["season", "team1"])
    assert sorted(spread.select(*want.columns).collect()) == sorted(want.collect()) and spread.count() == 3000
    assert got.count() == 1500


# ---------------------------------------------------------------- states
def test_scaler_states_merge_like_one_fit(spark):
    r = random.Random(1)
    rows = [(s, r.gauss(1e6, 1.0), None if i % 7 == 0 else r.random(), 0.1, None) for s in range(5) for i in range(s * 30)]
    df = spark.createDataFrame(rows, "season int, a double, b double, c double, d double")
    cols = ["a", "b", "c", "d"]
    state = scaling.scaler_state(df.where("season = 0"), cols)   # no row at all
    for s in range(1, 5):
        state = scaling.merge_states(state, scaling.scaler_state(df.where(F.col("season") == s), cols))
    got, want = scaling.state_statistics(state, cols).first().asDict(), scaling.fit_scaler(df, cols).first().asDict()
    for k, v in want.items():
        assert got[k] == (None if v is None else pytest.approx(v, rel=1e-9, abs=1e-12)), k
    assert got["c__std"] == 0.0   # constant over all parts
    scaler = scaling.Scaler(cols).fit_state(state)
    assert scaler.transform(df).agg(F.max(F.abs("c"))).first()[0] < 1e-9


def test_sketch_medians_merge_and_stay_within_their_rank_error(spark):
    df = spark.range(60_000).select((F.col("id") % 7).alias("season"), F.sqrt("id").alias("x"),
                                    F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(F.lit(5.0)).alias("tied"),
                                    F.lit(None).cast("double").alias("none"), F.col("id").cast("int").alias("whole"))
    cols = ["x", "tied", "none", "whole"]
    state = missing.quantile_state(df, cols, by=["season"], k=512)
    merged = {r["column"]: r for r in missing.sketch_quantiles(missing.merge_quantile_states(state)).collect()}
    assert merged["tied"]["value"] == 5.0 and merged["tied"]["n"] == 40_000 and merged["none"]["value"] is None
    for c, rank in (("x", lambda v: v * v), ("whole", lambda v: v)):
        assert abs(rank(merged[c]["value"]) / 60_000 - 0.5) <= missing.rank_error(512)
    filled = missing.handle_missing_values(df.select("season", "x", F.when(F.col("season") > 0, F.col("x")).alias("y")),
                                           threshold=0.5, medians=missing.sketch_medians)
    assert filled.where("y is null").count() == 0


# ---------------------------------------------------------------- audits of a write
def test_observed_counts_equal_the_audits(spark, tmp_path):
    df = spark.createDataFrame([("2021", "1", 1.0), ("2021", "x", None), ("2022", None, float("nan")), ("2022", " 7 ", 2.0)],
                               "season string, t string, v double")
    table, audit = observed.write_audited(df, f"{tmp_path}/t", numeric=["t"], flags={"big": F.col("v") == 2},
                                          counted={"season": ["2021", "2022", "2023"]}, partition_by=["season"])
    assert audit.rows == 4 and audit.flagged == {"big": 1} and audit.by_value == {"season": {"2021": 2, "2022": 2, "2023": 0}}
    want = {r["column"]: r["null_fraction"] for r in missing.null_fractions(df).collect()}
    assert audit.null_fractions() == want
    assert audit.non_numeric["t"] == {r["column"]: r["non_numeric"] for r in quality.non_numeric_audit(df, ["t"]).collect()}["t"]
    assert sorted(map(str, table.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    empty, none = observed.write_audited(df.limit(0), f"{tmp_path}/e")
    assert none.rows == 0 and empty.count() == 0 and none.null_fractions()["v"] is None


# ---------------------------------------------------------------- one committed file
def test_single_file_appears_whole_or_not_at_all(spark, tmp_path):
    path = sinks.predictions_file(f"{tmp_path}/2024 Schedule.csv")
    assert path.endswith("2024 Schedule_predictions.csv")
    df = spark.createDataFrame([(2, "B, c"), (1, 'A "q"')], "week int, team1 string").repartition(2)
    sinks.write_single_csv(df, path, ["week"])
    with open(path, encoding="utf-8") as fh:
        assert fh.readline() == "week,team1\n"
    assert [r.team1 for r in spark.read.option("header", True).option("escape", '"').csv(path).collect()][1] == "B, c"
    fails = df.withColumn("week", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_single_csv(fails, path)
    assert spark.read.option("header", True).csv(path).count() == 2                       # the old file is still there
    sinks.write_single_csv(df.where("week = 1"), path)
    assert spark.read.option("header", True).csv(path).count() == 1
    assert [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["2024 Schedule_predictions.csv"]
