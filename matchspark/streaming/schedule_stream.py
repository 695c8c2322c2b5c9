"""Incremental season scoring: schedule files that land in a folder are
scored as they arrive (entry 2 as a Structured Streaming query).

``readStream`` picks up new CSV files (explicit schema, season from the
file name); every micro-batch goes through the same batch plan as
``pipeline.predict_season`` inside ``foreachBatch`` — statistics joined,
features built without fitting, the stored scaler and models applied, the
majority vote taken — and is appended to the sink.  The stream's progress
(which files are done) lives in a checkpoint folder under the session's
shared ``spark.checkpoint.dir``, so a restarted query resumes where it
stopped and a retried batch overwrites its own output idempotently.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import joins
from ..plans import pipeline
from ..session import ensure_checkpoint_dir

SCHEDULE_SCHEMA = T.StructType([
    T.StructField("Week", T.IntegerType()),
    T.StructField("Team1", T.StringType()),
    T.StructField("Team2", T.StringType()),
])


def schedule_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 16) -> DataFrame:
    """Streaming schedule rows ``season, week, team1, team2, game_id``."""
    raw = (spark.readStream.schema(SCHEDULE_SCHEMA).option("header", True)
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .option("pathGlobFilter", "* Schedule.csv").csv(folder))
    fname = F.regexp_replace(F.col("_metadata.file_name"), "%20", " ")
    return raw.select(
        F.regexp_extract(fname, r"^([0-9]+)", 1).alias("season"),
        F.col("Week").alias("week"), F.col("Team1").alias("team1"), F.col("Team2").alias("team2"),
        # stable per file and line: the same game gets the same id on a replay
        F.xxhash64(fname, F.col("Week"), F.col("Team1"), F.col("Team2")).alias("game_id"))


def start_scoring(spark: SparkSession, folder: str, stats: DataFrame, fitted: dict, scaler,
                  out_path: str, name: str = "schedule_scoring", available_now: bool = False):
    """Start the scoring query; returns the ``StreamingQuery``.

    ``stats`` is the (static) team statistics table keyed by season and
    ``Name``.  Each micro-batch writes ``out_path/batch_id=<n>`` in overwrite
    mode, so a re-run of the same batch after a failure replaces, not
    duplicates, its rows.
    """
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a shared folder for the stream's progress")
    checkpoint = os.path.join(base, "streams", name)

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        games = joins.games_with_stats(batch, stats)
        out = pipeline.predict_season(games, fitted, scaler)
        out.write.mode("overwrite").parquet(os.path.join(out_path, f"batch_id={batch_id}"))

    writer = (schedule_stream(spark, folder).writeStream.foreachBatch(score_batch)
              .option("checkpointLocation", checkpoint).queryName(name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
