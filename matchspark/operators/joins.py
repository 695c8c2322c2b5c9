"""Equi-joins of the matchup model: offense with defense, games with both
teams' statistics (role-playing dimension), rejects, weather odds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize
from .windows import keep_first


#: Cells (rows x columns) of a lookup that a task may hold; copies of a larger one, and so tasks for each of its keys.
LOOKUP_CELLS = 4_000_000
SALTS = 16


class Lookup:
    """An aggregated side whose few keys hold many rows of the other side (a team
    of a season holds a share of all its games).

    It is computed once (a checkpoint) and its rows are counted.  Up to ``cells`` it is
    broadcast, and the big side stays where it is; beyond that it is replicated over
    ``salts`` and the big side is dealt by (keys, salt), so that a hot key is spread
    over that many tasks."""

    def __init__(self, df: DataFrame, cells: int = LOOKUP_CELLS, salts: int = SALTS):
        self.frame = materialize(df)
        self.small = self.frame.count() * len(df.columns) <= cells
        self.salts = salts

    def join(self, big: DataFrame, projected: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
        """``big`` joined to a projection of the lookup, unique by ``keys``."""
        keys = list(keys)
        if self.small:
            return big.join(F.broadcast(projected), keys, how)
        salted = big.withColumn("__salt", F.pmod(F.xxhash64(*big.columns), F.lit(self.salts)).cast("int"))
        copies = projected.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))))
        return salted.join(copies, [*keys, "__salt"], how).drop("__salt")


def prefix_stats(df: DataFrame, prefix: str, keep: Sequence[str] = ("Name", "GP"),
                 keys: Sequence[str] = ("season",)) -> DataFrame:
    """Every column but ``keep`` and ``keys`` gets ``prefix``."""
    keep = set(keep) | set(keys)
    return df.select([F.col(c) if c in keep else F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def merge_team_stats(offense: DataFrame, defense: DataFrame, name: str = "Name",
                     keys: Sequence[str] = ("season",)) -> DataFrame:
    """J1 + P1 + P2: inner join of prefixed offense and defense per team.

    ``GP`` is taken from the offense side when both have it, and moved last.
    Duplicate names multiply rows, as an inner join does.
    """
    keys = list(keys)
    off = prefix_stats(offense, "off_", keys=keys)
    dfn = prefix_stats(defense, "def_", keys=keys)
    both_gp = "GP" in off.columns and "GP" in dfn.columns
    if both_gp:
        dfn = dfn.drop("GP")
    merged = off.join(dfn, on=keys + [name], how="inner")
    cols = [c for c in merged.columns if c != "GP"]
    if "GP" in merged.columns:
        cols.append("GP")
    return merged.select(*cols)


def require_nonempty(df: DataFrame, message: str) -> DataFrame:
    """V6: raise when ``df`` has no rows (one cheap ``isEmpty`` job)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def first_per_team(stats: DataFrame, name: str = "Name", keys: Sequence[str] = ("season",),
                   position: str | Sequence[str] | None = None) -> DataFrame:
    """One stats row per (keys, name); the first by ``position`` (one
    column or several).

    Without a position column the rows must already be unique.
    """
    if position is None:
        return stats
    order = [position] if isinstance(position, str) else list(position)
    return keep_first(stats, list(keys) + [name], order).drop(*order)


def role_projection(stats: DataFrame, role: str, name: str = "Name",
                    keys: Sequence[str] = ("season",)) -> DataFrame:
    """The stats row as ``<role>_*`` columns; the key is ``role``."""
    keys = list(keys)
    return stats.select(*keys, F.col(name).alias(role),
                        *[F.col(c).alias(f"{role}_{c}") for c in stats.columns
                          if c != name and c not in keys])


def games_with_stats(schedule: DataFrame, stats: DataFrame, name: str = "Name",
                     keys: Sequence[str] = ("season",), team1: str = "team1",
                     team2: str = "team2") -> DataFrame:
    """Each game joined to both teams' statistics; games whose team has
    no statistics are dropped (see :func:`unmatched_games`).

    ``stats`` must be unique per (keys, name) — use :func:`first_per_team`.
    They are measured first (:class:`Lookup`): games are never dealt by their
    few (season, team) keys alone.
    """
    keys = list(keys)
    lookup = Lookup(stats)
    s1 = role_projection(lookup.frame, team1, name, keys)
    s2 = role_projection(lookup.frame, team2, name, keys)
    return lookup.join(lookup.join(schedule, s1, keys + [team1]), s2, keys + [team2])


def unmatched_games(schedule: DataFrame, stats: DataFrame, name: str = "Name",
                    keys: Sequence[str] = ("season",), team1: str = "team1",
                    team2: str = "team2") -> DataFrame:
    """Games dropped by :func:`games_with_stats` with the side(s)
    that lack statistics (``missing`` = team1 / team2 / both)."""
    keys = list(keys)
    names = stats.select(*keys, F.col(name).alias("__n")).distinct()
    k1 = names.select(*keys, F.col("__n").alias(team1), F.lit(True).alias("__has1"))
    k2 = names.select(*keys, F.col("__n").alias(team2), F.lit(True).alias("__has2"))
    j = (schedule.join(k1, on=keys + [team1], how="left")
         .join(k2, on=keys + [team2], how="left")
         .where(F.col("__has1").isNull() | F.col("__has2").isNull()))
    missing = (F.when(F.col("__has1").isNull() & F.col("__has2").isNull(), "both")
               .when(F.col("__has1").isNull(), team1).otherwise(team2))
    return j.withColumn("missing", missing).drop("__has1", "__has2").select(*schedule.columns, "missing")


def offense_with_defense(offense: DataFrame, defense: DataFrame, name: str = "Name",
                         keys: Sequence[str] = ("season",), position: str | None = None) -> DataFrame:
    """Each team's offense row with its first defense row.

    Duplicate offense names keep the **last** row and defense lookups the
    **first** (by ``position``); a team without defense has null defense
    columns and ``has_defense = false`` for the caller to reject.
    """
    keys = list(keys)
    off, dfn = offense, defense
    if position is not None:
        off = keep_first(off, keys + [name], [position], last=True).drop(position)
        dfn = keep_first(dfn, keys + [name], [position]).drop(position)
    dfn = prefix_stats(dfn, "def_", keep=(name,), keys=keys).withColumn("has_defense", F.lit(True))
    off = prefix_stats(off, "off_", keep=(name, "GP"), keys=keys)
    j = off.join(dfn, on=keys + [name], how="left")
    return j.withColumn("has_defense", F.coalesce(F.col("has_defense"), F.lit(False)))


def attach_weather_odds(games: DataFrame, odds: DataFrame, home: str = "team2",
                        default_condition: str = "Clear") -> DataFrame:
    """Every game gets its home team's odds rows ``(condition, p)``;
    a home team absent from the table gets ``(Clear, 1.0)``.

    ``odds`` is a lookup with a few rows per team (4 per stadium): it is
    broadcast when its size estimate is small, so the games side is not
    shuffled.
    """
    o = odds.select(F.col("home_team").alias("__home"), "condition", "p")
    j = games.join(broadcast_if_small(o), games[home] == o["__home"], "left").drop("__home")
    return (j.withColumn("condition", F.coalesce(F.col("condition"), F.lit(default_condition)))
             .withColumn("p", F.coalesce(F.col("p"), F.lit(1.0))))
