"""Validation and data-quality audits (V1-V8).

Checks that raise run one small job each (``isEmpty``) or none at all
(schema checks); audits return DataFrames computed in a single aggregate
pass, so they cost one scan whatever the number of columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import (DOCUMENTED_RANGES, MIN_GAMES_PER_SEASON, MIN_PRESENT_SHARE,
                                   MIN_SEASONS, REQUIRED_COLUMNS)

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def validate_nonempty(df: DataFrame, what: str = "data") -> None:
    """V1."""
    if df.isEmpty():
        raise ValueError(f"DataFrame for {what} is empty")


def validate_columns(df: DataFrame, kind: str = "general") -> None:
    """V2: required columns per file kind; the error lists missing and available."""
    required = REQUIRED_COLUMNS.get(kind, REQUIRED_COLUMNS["general"])
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns for {kind} data: {missing}. "
                         f"Available columns: {df.columns}")


def validate_types(df: DataFrame, kind: str = "general") -> None:
    """V3: ``Week`` numeric; ``Team1``, ``Team2``, ``Name`` strings."""
    types = {f.name: f.dataType for f in df.schema.fields}
    if kind == "schedule":
        if "Week" in types and not isinstance(types["Week"], NUMERIC):
            raise ValueError("Week column must be numeric")
        for c in ("Team1", "Team2"):
            if c in types and not isinstance(types[c], T.StringType):
                raise ValueError(f"{c} column must be string")
    if "Name" in types and not isinstance(types["Name"], T.StringType):
        raise ValueError("Name column must be string")


def validate_data(df: DataFrame, kind: str = "general") -> bool:
    """V1 + V2 + V3 as one call (schema checks first, they are free)."""
    validate_columns(df, kind)
    validate_types(df, kind)
    validate_nonempty(df, kind)
    return True


def _long(row_df: DataFrame, names: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One aggregate row with ``<name>__<field>`` columns -> one row per name."""
    structs = [F.struct(F.lit(n).alias("column"),
                        *[F.col(f"`{n}__{f}`").alias(f) for f in fields]) for n in names]
    return row_df.select(F.inline(F.array(*structs)))


def non_numeric_audit(df: DataFrame, columns: Sequence[str] | None = None,
                      exclude: Sequence[str] = ("Name",)) -> DataFrame:
    """V4: per column, present values and values that do not convert to a
    number (``try_cast`` to double is null while the value is not)."""
    cols = [c for c in (columns or df.columns) if c not in exclude]
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [F.count(x).alias(f"{c}__present"),
                 F.count_if(x.isNotNull() & x.cast("string").try_cast("double").isNull()).alias(f"{c}__non_numeric")]
    return _long(df.agg(*aggs), cols, ["present", "non_numeric"])


def range_audit(df: DataFrame, ranges: Mapping[str, tuple] = DOCUMENTED_RANGES) -> DataFrame:
    """V7: per documented column present in ``df``: rows, values outside
    ``[low, high]`` and the bounds.  The rules are plan-time constants, so
    this is one aggregate — no unpivot of the data."""
    cols = [c for c in ranges if c in df.columns]
    aggs = []
    for c in cols:
        lo, hi = ranges[c]
        x = F.col(c)
        aggs += [F.count(x).alias(f"{c}__n"),
                 F.count_if(~x.between(F.lit(lo), F.lit(hi))).alias(f"{c}__out_of_range"),
                 F.lit(float(lo)).alias(f"{c}__low"), F.lit(float(hi)).alias(f"{c}__high")]
    return _long(df.agg(*aggs), cols, ["n", "out_of_range", "low", "high"])


def completeness_audit(df: DataFrame, columns: Sequence[str], season: str = "season",
                       min_share: float = MIN_PRESENT_SHARE,
                       min_rows: int = MIN_GAMES_PER_SEASON) -> DataFrame:
    """V8: per season, rows, share of present values per column, the lowest
    share and the documented flags (rows >= 100, share >= 80 %)."""
    share = [(F.count(F.col(c)) / F.count(F.lit(1))).alias(f"present_{c}") for c in columns]
    agg = df.groupBy(season).agg(F.count(F.lit(1)).alias("rows"), *share)
    low = F.least(*[F.col(f"present_{c}") for c in columns]) if len(columns) > 1 else F.col(f"present_{columns[0]}")
    return (agg.withColumn("min_present", low)
               .withColumn("enough_rows", F.col("rows") >= F.lit(min_rows))
               .withColumn("complete", F.col("min_present") >= F.lit(min_share)))


def enough_seasons(df: DataFrame, season: str = "season", minimum: int = MIN_SEASONS) -> bool:
    """V8: at least ``minimum`` distinct seasons (one tiny aggregate)."""
    return df.select(season).distinct().count() >= minimum
