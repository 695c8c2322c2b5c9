"""Lineage cuts: what they leave behind and how many tasks they use."""

import time

from pyspark.sql import functions as F

from matchspark import session


def _shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")
    return {f for f in str(files).split(",") if "/shuffle_" in f}


def test_materialize_keeps_no_shuffle_files(spark):
    old = spark.conf.get(session.SHUFFLE_CLEANUP, "false")
    before = _shuffles(spark)
    df = session.materialize(spark.range(20000).withColumn("k", F.col("id") % 97).groupBy("k").agg(F.sum("id").alias("s")).repartition(4, "s"))
    left = _shuffles(spark) - before
    for _ in range(50):
        if not left:
            break
        time.sleep(0.1)
        left = _shuffles(spark) - before
    assert not left
    assert spark.conf.get(session.SHUFFLE_CLEANUP, "false") == old
    rows = {r.k: r.s for r in df.collect()}
    assert rows == {k: sum(range(k, 20000, 97)) for k in range(97)} and df.count() == 97


def test_even_tasks_leave_several_tasks_a_core(spark):
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    df = lambda: spark.range(4_000_000, numPartitions=4).repartition("id")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "80")
        few = session.materialize(df()).rdd.getNumPartitions()
        with session.even_tasks(spark):
            many = session.materialize(df()).rdd.getNumPartitions()
        assert few <= cores + 2 and many >= 2 * cores
        assert spark.conf.get(session.MIN_TASKS, None) is None
        spark.conf.set(session.MIN_TASKS, "3")
        with session.even_tasks(spark):
            assert spark.conf.get(session.MIN_TASKS) == "3"
        assert spark.conf.get(session.MIN_TASKS) == "3"
    finally:
        spark.conf.unset(session.MIN_TASKS)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
