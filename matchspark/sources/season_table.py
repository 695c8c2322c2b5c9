"""Feature tables with one folder per season.

A season that is added or corrected replaces its own folder only (dynamic
partition overwrite), and a reader of some seasons lists and reads only theirs
(the filter reaches the scan as a partition filter).  With the carried window
state the features of a new season need neither the rows nor a scan of the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEASON = "season"


def write_seasons(df: DataFrame, path: str, within: Sequence[str] = ("game_id",), files: int | None = None) -> None:
    """Replaces the seasons of ``df`` in the table at ``path`` and leaves all others as they are.

    Rows are dealt by ranges of (season, ``within``), so a season of any size is written by many tasks
    and each task writes few folders."""
    cols = [SEASON, *within]
    dealt = df.repartitionByRange(files, *cols) if files else df.repartitionByRange(*cols)
    (dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SEASON).parquet(path))


def read_seasons(spark: SparkSession, path: str, schema: T.StructType, seasons: Sequence | None = None) -> DataFrame:
    """The table, or only the listed seasons of it.  The schema is given: folder names alone would
    turn a textual season into a number."""
    fields = [f for f in schema if f.name != SEASON]
    df = spark.read.schema(T.StructType([*fields, schema[SEASON]])).parquet(path)
    if seasons is not None:
        kind = schema[SEASON].dataType
        df = df.where(F.col(SEASON).isin([F.lit(s).cast(kind) for s in seasons]))
    return df.select(*schema.names)
