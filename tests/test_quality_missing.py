import random
import statistics

import pytest

from matchspark.operators import missing, quality


def test_empty_and_required_columns(spark):
    with pytest.raises(ValueError, match="empty"):
        quality.validate_data(spark.createDataFrame([], "Name string, GP int, PTS double"), "offense")
    with pytest.raises(ValueError, match="Missing required columns"):
        quality.validate_data(spark.createDataFrame([("A", 1)], "Name string, GP int"), "offense")
    with pytest.raises(ValueError, match="Week column must be numeric"):
        quality.validate_types(spark.createDataFrame([("1", "A", "B")], "Week string, Team1 string, Team2 string"),
                               "schedule")


def test_non_numeric_audit_counts(spark):
    df = spark.createDataFrame([("A", "1", "x"), ("B", "2.5", None), ("C", "n/a", "3")], "Name string, a string, b string")
    got = {r["column"]: (r["present"], r["non_numeric"]) for r in quality.non_numeric_audit(df).collect()}
    assert got == {"a": (3, 1), "b": (2, 1)}


def _frame(spark):
    return spark.createDataFrame(
        [(1.0, 10.0, None, "x"), (2.0, 20.0, None, "y"), (None, 30.0, None, "y"), (4.0, 40.0, 7.0, None),
         (5.0, 50.0, None, "x")], "col1 double, col2 double, col3 double, s string")


def test_threshold_020(spark):
    out = missing.handle_missing_values(_frame(spark), 0.20)
    assert "col3" not in out.columns and out.count() == 5
    vals = sorted(r["col1"] for r in out.collect())
    assert vals == [1.0, 2.0, 3.0, 4.0, 5.0]          # median of 1, 2, 4, 5
    assert sorted(r["s"] for r in out.collect()) == ["x", "x", "x", "y", "y"]   # tie x/y -> smaller


def test_threshold_090_keeps_columns(spark):
    out = missing.handle_missing_values(_frame(spark), 0.90)
    assert {"col1", "col2", "col3"} <= set(out.columns)
    assert {r["col3"] for r in out.collect()} == {7.0}


def test_unknown_when_no_value(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, s string")
    out = missing.handle_missing_values(df, 1.0)
    assert {r["s"] for r in out.collect()} == {"Unknown"}


def test_exact_median_with_many_equal_values(spark):
    df = spark.createDataFrame([(5.0,)] * 150 + [(float(i),) for i in range(50)], "v double")
    assert missing.exact_medians(df, ["v"], ranges=7) == {"v": 5.0}
    empty = spark.createDataFrame([(None,)], "v double")
    assert missing.exact_medians(empty, ["v"]) == {"v": None}


def test_exact_median_over_many_ranges(spark):
    rnd = random.Random(1)
    vals = [rnd.gauss(0, 1) for _ in range(2001)] + [5.0] * 700        # heavy duplicate
    vals2 = vals[:-1]
    df = spark.createDataFrame([(v, w) for v, w in zip(vals, vals2 + [None])], "v double, w double")
    got = missing.exact_medians(df, ["v", "w"], ranges=40)
    assert got["v"] == statistics.median(vals)
    assert got["w"] == statistics.median(vals2)


def test_range_and_completeness(spark):
    df = spark.createDataFrame([("2021", 17, 300.0), ("2021", 20, None), ("2022", 16, 100.0)],
                               "season string, GP int, off_PTS double")
    r = {x["column"]: x["out_of_range"] for x in quality.range_audit(df).collect()}
    assert r == {"GP": 1, "off_PTS": 1}
    c = {x["season"]: x for x in quality.completeness_audit(df, ["off_PTS"]).collect()}
    assert c["2021"]["present_off_PTS"] == 0.5 and not c["2021"]["complete"] and c["2022"]["complete"]
