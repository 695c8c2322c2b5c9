"""Per-team ratio features (E1-E10) as column expressions.

Every function takes the role prefix (``team1`` / ``team2``) and the frame's
column list, and falls back to the constant 0 when a source column is
absent (P5).  Division by a zero ``GP`` gives null instead of an error.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import PLAYS_PER_GAME_ESTIMATE, TURNOVER_BASELINE


def dbl(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` in double; null when ``den`` is 0 or null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def clip_lower(x: Column, lower: float = 0.0) -> Column:
    """``max(lower, x)`` that keeps nulls (``greatest`` would not)."""
    return F.when(x < lower, F.lit(lower)).otherwise(x)


def _has(cols: Iterable[str], *names: str) -> bool:
    s = set(cols)
    return all(n in s for n in names)


def _per_game(role: str, cols, stat: str) -> Column:
    src, gp = f"{role}_{stat}", f"{role}_GP"
    return safe_div(F.col(src), F.col(gp)) if _has(cols, src, gp) else F.lit(0.0)


def efficiency_columns(role: str, cols) -> dict[str, Column]:
    """E1-E7 for one role."""
    gp = f"{role}_GP"
    out = {
        f"{role}_points_per_game": _per_game(role, cols, "off_PTS"),
        f"{role}_yards_per_game": _per_game(role, cols, "off_All"),
        f"{role}_pass_yards_per_game": _per_game(role, cols, "off_Pass"),
        f"{role}_rush_yards_per_game": _per_game(role, cols, "off_Run"),
    }
    all_c = f"{role}_off_All"
    out[f"{role}_offensive_efficiency"] = (
        safe_div(F.col(all_c), dbl(gp) * F.lit(float(PLAYS_PER_GAME_ESTIMATE)))
        if _has(cols, all_c, gp) else F.lit(0.0))
    out[f"{role}_points_allowed_per_game"] = _per_game(role, cols, "def_PA")
    def_c = f"{role}_def_DEF"
    out[f"{role}_defensive_efficiency"] = (
        safe_div(F.lit(1.0), safe_div(F.col(def_c), F.col(gp)) + F.lit(1.0))
        if _has(cols, def_c, gp) else F.lit(0.0))
    return out


def turnover_columns(role: str, cols) -> dict[str, Column]:
    """E8-E10 for one role: clipped turnovers gained / lost and their ratio."""
    gp = f"{role}_GP"

    def turnovers(src: str) -> Column:
        if not _has(cols, src, gp):
            return F.lit(0.0)
        return clip_lower(safe_div(F.lit(float(TURNOVER_BASELINE)) - dbl(src), F.col(gp)))

    gained = turnovers(f"{role}_def_QB")
    lost = turnovers(f"{role}_off_QB")
    return {
        f"{role}_turnovers_gained": gained,
        f"{role}_turnovers_lost": lost,
        f"{role}_turnover_ratio": gained - lost,
    }
