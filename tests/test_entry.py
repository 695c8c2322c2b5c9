import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from matchspark.sources.tables import TABLES

FAST = ["games", "team_stats", "rolling_features", "head_to_head", "win_streak", "standings", "team_ratings",
        "impute_missing", "split_assign", "model_comparison", "consensus_season", "weather_draw", "numeric_audit"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "team1_points_per_game_rolling_3games" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.oracle_sql()) >= 50


@pytest.mark.parametrize("name", FAST)
def test_oracle_matches_at_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    norm = lambda v: float(v) if hasattr(v, "as_tuple") else v
    s = sorted((tuple(norm(r[c]) for c in sorted(dcols)) for r in sdf.collect()), key=repr)
    idx = [dcols.index(c) for c in sorted(dcols)]
    d = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert s == d


def test_plans_have_no_python_udf_and_no_global_window(spark):
    for name in FAST + ["features_unscaled", "scaled_features"]:
        df = E.queries()[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        for line in plan.split("\n"):
            # a Window operator prints "Window [exprs], [partition spec], [order]"
            if line.strip().lstrip("+-: ").startswith("Window ["):
                assert "], [], [" not in line, (name, line)
