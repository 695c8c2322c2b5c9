"""Team ratings, game score and outcome (E16-E24) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (HOME_MULTIPLIER, NET_PRODUCTION_DEF_WEIGHT, SEASON_GAMES, STREAK_STEP,
                        WEATHER_EFFECTS, X_DEF_INTERCEPT, X_DEF_SLOPE, X_OFF_INTERCEPT,
                        X_OFF_SLOPE, X_WINS_INTERCEPT, X_WINS_SLOPE)
from .ratios import dbl


def _c(cols, name: str) -> Column:
    """Column or 0 when absent (dict ``get(key, 0)`` of the original)."""
    return F.coalesce(dbl(name), F.lit(0.0)) if name in cols else F.lit(0.0)


def rating_columns(cols, all_c="off_All", run_c="off_Run", pass_c="off_Pass", pts_c="off_PTS",
                   def_c="def_DEF", allowed=("def_QB", "def_RB", "def_WR", "def_TE")) -> dict[str, Column]:
    """Plays, efficiency, production allowed, expected points,
    net rating, expected wins / losses, expected points for, net production
    (half-even rounding, as Python's ``round``)."""
    off = _c(cols, all_c)
    de = _c(cols, def_c)
    plays = _c(cols, run_c) + _c(cols, pass_c)
    eff = F.try_divide(off, plays)
    x_off = F.lit(X_OFF_SLOPE) * off + F.lit(X_OFF_INTERCEPT)
    x_def = F.lit(X_DEF_SLOPE) * de + F.lit(X_DEF_INTERCEPT)
    net = x_off - x_def
    x_wins = F.lit(X_WINS_SLOPE) * net + F.lit(X_WINS_INTERCEPT)
    prod_allowed = _c(cols, allowed[0])
    for a in allowed[1:]:
        prod_allowed = prod_allowed + _c(cols, a)
    return {
        "plays_per_game": plays,
        "team_efficiency": eff,
        "production_allowed": prod_allowed,
        "x_off": x_off,
        "x_def": x_def,
        "net": net,
        "x_wins": x_wins,
        "x_losses": F.lit(float(SEASON_GAMES)) - x_wins,
        "expected_points_for": _c(cols, pts_c) * eff,
        "net_production": F.bround(off + de * F.lit(NET_PRODUCTION_DEF_WEIGHT), 0),
    }


def weather_factor(condition: Column, which: int) -> Column:
    """E21 multiplier for a condition: ``which`` 0 = efficiency, 1 = net."""
    expr = None
    for cond, factors in WEATHER_EFFECTS.items():
        expr = (F.when(condition == cond, F.lit(factors[which])) if expr is None
                else expr.when(condition == cond, F.lit(factors[which])))
    return expr.otherwise(F.lit(1.0))


def game_score(eff: Column, net_prod: Column, opp_allowed: Column, streak: Column,
               home: bool) -> Column:
    """``eff + (net production - opponent production allowed)``,
    times 1.05 for the home side, times ``1 + 0.02 * streak``."""
    s = eff + (net_prod - opp_allowed)
    if home:
        s = s * F.lit(HOME_MULTIPLIER)
    return s * (F.lit(1.0) + F.lit(STREAK_STEP) * streak.cast("double"))


def outcome(score1: Column, score2: Column) -> Column:
    """``win1`` / ``win2`` / ``tie``."""
    return F.when(score1 > score2, "win1").when(score2 > score1, "win2").otherwise("tie")


def outcome_sentence(week: Column, team1: Column, team2: Column, result: Column) -> Column:
    """E23 text: ``Week w: A defeat B.`` or ``Week w: A ties with B.``."""
    return (F.when(result == "win1", F.format_string("Week %s: %s defeat %s.", week, team1, team2))
            .when(result == "win2", F.format_string("Week %s: %s defeat %s.", week, team2, team1))
            .otherwise(F.format_string("Week %s: %s ties with %s.", week, team1, team2)))


def summary_columns() -> dict[str, Column]:
    """Display rounding of a ratings row (efficiency 3 dp, others 2 dp)."""
    return {
        "team_efficiency_display": F.bround(F.col("team_efficiency"), 3),
        "production_allowed_display": F.bround(F.col("production_allowed"), 2),
        "x_off_display": F.bround(F.col("x_off"), 2),
        "x_def_display": F.bround(F.col("x_def"), 2),
        "net_display": F.bround(F.col("net"), 2),
        "x_wins_display": F.bround(F.col("x_wins"), 2),
        "x_losses_display": F.bround(F.col("x_losses"), 2),
    }
