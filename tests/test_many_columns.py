"""Scaling and rounding of many columns: values, and plans that stay short."""

import math
import statistics

from pyspark.sql import functions as F

from matchspark.operators import scaling
from matchspark.plans import common

ODD = [0.0, -0.0, -1e-9, 0.5e-6, 1.5e-6, 2.5e-6, -2.5e-6, 0.1234565, 0.1234575, 33.3333335, 2.0000005, 1e5 + 5e-7, 999999.9999995,
       1e6 + 5e-7, 1e300, -1e300, 5e-324, math.inf, -math.inf, math.nan, None, 1 / 3, -2 / 3, 123456.789]


def test_rounding_equals_bround(spark):
    df = spark.createDataFrame([(x, x) for x in ODD], "o double, z double").withColumn("o", F.bround("o", 6))
    rows = common.round_cols(df, ["z"]).collect()
    assert [repr(r.z) for r in rows] == [repr(r.o) for r in rows]


def test_one_rounding_for_all_columns(spark):
    df = spark.range(3).select(*[(F.col("id") / 7 + k).alias(f"c{k}") for k in range(36)])
    plan = common.round_cols(df, df.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bround(") == 1


def test_scaler_fit_of_many_columns_is_generated_code(spark):
    rows = [(1.0, None, None), (2.0, 5.0, None), (4.0, 7.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = scaling.fit_scaler(df, ["a", "b", "c"]).first()
    assert math.isclose(got["a__mean"], 7 / 3) and math.isclose(got["a__std"], statistics.pstdev([1, 2, 4]))
    assert (got["b__mean"], got["b__std"], got["c__mean"], got["c__std"]) == (6.0, 1.0, None, None)
    empty = scaling.fit_scaler(df.where("a < 0"), ["a", "b"]).collect()
    assert [tuple(r) for r in empty] == [(None,) * 4]
    wide = spark.range(3).select(*[(F.col("id") / 7 + k).alias(f"c{k}") for k in range(36)])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = scaling.fit_scaler(wide, wide.columns)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    steps = [line for line in plan.splitlines() if "HashAggregate" in line]
    assert steps and all("*(" in line for line in steps)
