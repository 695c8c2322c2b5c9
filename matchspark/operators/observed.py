"""Audits taken while a table is written (V1, V4, V8, M1, A2): no scan of their own.

The frame is observed just before its sink: row counts, missing and malformed
values and rows per season are metrics of the write job itself.  They sit in the
last stage, behind every shuffle, whose tasks count once however often an
earlier one is tried again.

The write runs in a session of its own (same context, same settings): a session
that has taken an ``Observation`` holds a manager that cannot be serialized, and
closures of ``pyspark.ml`` that refer to their session would fail afterwards.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .missing import is_missing


@dataclass
class Audit:
    """Counts of one written table."""

    rows: int
    missing: dict[str, int]
    non_numeric: dict[str, int]
    flagged: dict[str, int]
    by_value: dict[str, dict[str, int]]

    def null_fractions(self) -> dict[str, float | None]:
        """M1: the missing share of each column."""
        return {c: (m / self.rows if self.rows else None) for c, m in self.missing.items()}

    def present_shares(self) -> dict[str, float | None]:
        """V8 over the whole table."""
        return {c: (None if f is None else 1.0 - f) for c, f in self.null_fractions().items()}


def _side_session(spark: SparkSession) -> SparkSession:
    side = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            side.conf.set(key, value)
    return side


def write_audited(df: DataFrame, path: str, columns: Sequence[str] | None = None, numeric: Sequence[str] = (),
                  flags: dict | None = None, counted: dict[str, Sequence] | None = None,
                  partition_by: Sequence[str] = (), mode: str = "overwrite") -> tuple[DataFrame, Audit]:
    """Writes ``df`` as Parquet and returns the written table with its audit.

    ``columns``: missing values are counted (all columns by default); ``numeric``: text columns whose
    present values should be numbers; ``flags``: name -> condition, rows that meet it; ``counted``:
    column -> the values whose rows are counted (known beforehand, such as the seasons asked for)."""
    columns = list(df.columns if columns is None else columns)
    flags, counted = flags or {}, {c: [str(v) for v in vs] for c, vs in (counted or {}).items()}
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]
    metrics += [F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").cast("string").try_cast("double").isNull()).alias(f"x{i}")
                for i, c in enumerate(numeric)]
    metrics += [F.count_if(F.coalesce(cond, F.lit(False))).alias(f"f{i}") for i, cond in enumerate(flags.values())]
    pairs = [(c, v) for c, vs in counted.items() for v in vs]
    metrics += [F.count_if(F.coalesce(F.col(f"`{c}`").cast("string") == v, F.lit(False))).alias(f"v{i}") for i, (c, v) in enumerate(pairs)]
    spark, name = df.sparkSession, f"audit_{uuid.uuid4().hex}"
    seen = Observation(name)
    df.createGlobalTempView(name)
    try:
        writer = _side_session(spark).table(f"global_temp.{name}").observe(seen, *metrics).write.mode(mode)
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        got = seen.get
    finally:
        spark.catalog.dropGlobalTempView(name)
    by_value: dict[str, dict[str, int]] = {c: {} for c in counted}
    for i, (c, v) in enumerate(pairs):
        by_value[c][v] = got[f"v{i}"]
    audit = Audit(got["rows"], {c: got[f"m{i}"] for i, c in enumerate(columns)}, {c: got[f"x{i}"] for i, c in enumerate(numeric)},
                  {n: got[f"f{i}"] for i, n in enumerate(flags)}, by_value)
    written = T.StructType([f for f in df.schema if f.name not in partition_by]
                           + [df.schema[c] for c in partition_by])
    return spark.read.schema(written).parquet(path), audit
