"""Season files: CSV scan with explicit schemas, season tag from the file
name, multi-season union and the missing-file guard (S1-S4)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import row_position
from ..session import glob_names, path_exists

KIND_FILES = {
    "offense": "{season} Fantasy Offense Stats.csv",
    "defense": "{season} Fantasy Defense Stats.csv",
    "schedule": "{season} Schedule.csv",
}

# Column types per kind; extra columns are carried as DOUBLE.
KIND_TYPES = {
    "offense": {"Name": T.StringType(), "GP": T.IntegerType()},
    "defense": {"Name": T.StringType(), "GP": T.IntegerType()},
    "schedule": {"Week": T.IntegerType(), "Team1": T.StringType(), "Team2": T.StringType()},
}


#: Order of the rows of a file: the block of the file, then the row in its scan.
POSITION = ("_block", "_pos")
#: Present values that are no number, as a map column -> text of the row.
BAD = "_bad"
#: Text of a row that has more fields than its header, null for all others.
REJECT = "_reject"
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'   # outside quotes


def season_file(data_dir: str, kind: str, season) -> str:
    return f"{data_dir.rstrip('/')}/{KIND_FILES[kind].format(season=season)}"


def check_files(spark: SparkSession, data_dir: str, seasons: Sequence,
                kinds: Sequence[str] = ("offense", "defense", "schedule")) -> None:
    """Every requested file must exist, on whatever file system."""
    for s in seasons:
        for k in kinds:
            path = season_file(data_dir, k, s)
            if not path_exists(spark, path):
                raise FileNotFoundError(f"season file not found: {path}")


def kind_type(column: str, kind: str) -> T.DataType:
    """Type by name: known columns as listed, others DOUBLE."""
    return KIND_TYPES.get(kind, {}).get(column, T.DoubleType())


def read_kind(spark: SparkSession, data_dir: str, kind: str, seasons: Sequence) -> DataFrame:
    """S1 + S2: all requested seasons of a file kind, with ``season`` (string)
    from the file name, the row's ``POSITION`` in its file and ``BAD``.

    Files with the same header are one scan.  Values are read as text and cast
    by name; what is present but no number is kept in ``BAD`` for the audit
    instead of turning into a silent null.  A row with more fields than the header keeps
    its text in ``REJECT`` (its values cannot be told apart, so none is used);
    missing fields at the end of a row are null."""
    by_header: dict[tuple, list[str]] = {}
    for s in seasons:
        path = season_file(data_dir, kind, s)
        header = spark.read.option("header", True).csv(path).columns
        by_header.setdefault(tuple(header), []).append(path)
    parts = []
    for header, paths in by_header.items():
        # all fields are parsed, whatever is selected: a pruned scan would not notice further fields
        raw = (spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in [*header, REJECT]]))
               .option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECT)
               .option("columnPruning", False).csv(paths))
        long = F.col(REJECT).isNotNull() & (F.regexp_count(REJECT, F.lit(_COMMA)) >= len(header))
        fname = F.regexp_replace(F.col("_metadata.file_name"), "%20", " ")
        cast, bad = [], []
        for c in header:
            kind_of, text = kind_type(c.strip(), kind), F.when(~long, F.col(f"`{c}`"))
            if isinstance(kind_of, T.StringType):
                cast.append(text.alias(c.strip()))
            else:
                value = F.trim(text).try_cast("double")
                cast.append(value.cast(kind_of).alias(c.strip()))
                bad.append(F.when(text.isNotNull() & value.isNull(), F.struct(F.lit(c.strip()).alias("k"), text.alias("v"))))
        found = F.map_from_entries(F.array_compact(F.array(*bad))) if bad else F.lit(None).cast("map<string,string>")
        parts.append(raw.select(
            *cast, F.regexp_extract(fname, r"^([0-9]+)", 1).alias("season"),
            F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_pos"),
            # refers to a value too: Spark reads no file for the text of malformed rows alone
            found.alias(BAD), F.when(long & F.col(f"`{header[0]}`").isNull(), F.col(REJECT)).when(long, F.col(REJECT)).alias(REJECT)))
    return union_seasons(parts)


def rejected_rows(df: DataFrame) -> DataFrame:
    """``season, line``: rows with more fields than their header, as they stand in the file."""
    return df.where(F.col(REJECT).isNotNull()).select("season", F.col(REJECT).alias("line"))


def require_whole_rows(df: DataFrame, kind: str) -> None:
    """Raises with the first rows that have more fields than the header."""
    rows = rejected_rows(df).orderBy("season", "line").limit(5).collect()
    if rows:
        raise ValueError(f"{kind} files have rows with more fields than the header: "
                         + "; ".join(f"{r.season}: {r.line}" for r in rows))


def require_numbers(df: DataFrame, kind: str) -> None:
    """V4 in the loader: raises with the first values that are no numbers."""
    rows = (df.where(F.size(BAD) > 0).select("season", F.explode(BAD).alias("column", "value"))
            .orderBy("season", "column", "value").limit(5).collect())
    if rows:
        raise ValueError(f"{kind} files hold values that are no numbers: "
                         + ", ".join(f"{r.season} {r.column}={r.value!r}" for r in rows))


def schedule_games(schedule: DataFrame) -> DataFrame:
    """Schedule rows as games.  ``game_id`` numbers a season's rows in file
    order, under the season's number: unique whatever headers the files have,
    and the same on every run."""
    placed = row_position(schedule.select("season", *POSITION, "Week", "Team1", "Team2"), ["season"], POSITION, "__n")
    return placed.select("season", F.col("Week").alias("week"), F.col("Team1").alias("team1"),
                         F.col("Team2").alias("team2"),
                         (F.col("season").cast("long") * F.lit(1 << 32) + F.col("__n")).alias("game_id"))


def union_seasons(frames: Sequence[DataFrame]) -> DataFrame:
    """Row union by column name; columns missing on one side are
    null (pandas ``concat`` semantics)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def list_seasons(spark: SparkSession, data_dir: str, kind: str = "offense") -> list[str]:
    """Seasons for which a file of ``kind`` exists."""
    heads = [n.split(" ")[0] for n in glob_names(spark, season_file(data_dir, kind, "*"))]
    return sorted(h for h in heads if h.isdigit())
