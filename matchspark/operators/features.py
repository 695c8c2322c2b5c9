"""Game features: ratios, turnovers, rolling means, head-to-head history,
categorical flags, default fill and the 36-column feature pipeline (F1)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import FEATURE_NAMES, ROLES, ROLLING_STEMS, WEATHER_CONDITIONS
from ..functions.ratios import efficiency_columns, turnover_columns
from ..session import even_tasks, materialize
from . import carried, windows

ORDER = ("season", "week", "game_id")


def efficiency_features(df: DataFrame, roles: Sequence[str] = ROLES) -> DataFrame:
    """E1-E7 for both roles."""
    cols = {}
    for r in roles:
        cols.update(efficiency_columns(r, df.columns))
    return df.withColumns(cols)


def turnover_features(df: DataFrame, roles: Sequence[str] = ROLES) -> DataFrame:
    """E8-E10 for both roles."""
    cols = {}
    for r in roles:
        cols.update(turnover_columns(r, df.columns))
    return df.withColumns(cols)


def rolling_features(df: DataFrame, window: int = 3, roles: Sequence[str] = ROLES,
                     stems: Sequence[str] = ROLLING_STEMS, order_by: Sequence[str] = ORDER,
                     include_current: bool = True) -> DataFrame:
    """Per role, mean of the last ``window`` games of the team in that
    role column (a team's team1 and team2 games are separate histories,
    crossing seasons).  A stem absent from ``df`` gives a 0 column."""
    out = df
    for r in roles:
        present = {f"{r}_{s}_rolling_{window}games": f"{r}_{s}" for s in stems
                   if f"{r}_{s}" in df.columns}
        absent = [f"{r}_{s}_rolling_{window}games" for s in stems if f"{r}_{s}" not in df.columns]
        if present:
            out = windows.rolling_mean(out, [r], list(order_by), present,
                                       window=window, include_current=include_current)
        if absent:
            out = out.withColumns({c: F.lit(0.0) for c in absent})
    return out


def matchup_features(df: DataFrame, score1: str = "team1_score", score2: str = "team2_score",
                     order_by: Sequence[str] = ORDER) -> DataFrame:
    """Head-to-head win share and mean point difference of earlier
    meetings.  Without score columns no result is known and every game gets
    0.5 / 0.0."""
    if score1 in df.columns and score2 in df.columns:
        return windows.head_to_head(df, score1=score1, score2=score2,
                                    order_by=order_by)
    return df.withColumns({"head_to_head_win_pct": F.lit(0.5),
                           "head_to_head_avg_point_diff": F.lit(0.0)})


def categorical_features(df: DataFrame, weather: str = "weather",
                         categories: Sequence[str] = WEATHER_CONDITIONS) -> DataFrame:
    """Home flag (team1 is home), one-hot weather from a fixed,
    lower-cased category list (null -> all 0; no column -> clear), and the
    rest-days difference (0 without the columns)."""
    cols = {"home_field_advantage": F.lit(1)}
    for cat in categories:
        name = f"weather_{cat.lower()}"
        if weather in df.columns:
            cols[name] = F.coalesce((F.lower(F.col(weather)) == cat.lower()).cast("int"), F.lit(0))
        else:
            cols[name] = F.lit(1 if cat.lower() == "clear" else 0)
    if "team1_rest_days" in df.columns and "team2_rest_days" in df.columns:
        cols["rest_days_difference"] = F.col("team1_rest_days") - F.col("team2_rest_days")
    else:
        cols["rest_days_difference"] = F.lit(0)
    return df.withColumns(cols)


def fill_features(df: DataFrame, names: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """P5: any listed feature still absent becomes a 0 column; all features
    are cast to DOUBLE for the model boundary."""
    cols = {n: (F.col(n) if n in df.columns else F.lit(0.0)).cast("double") for n in names}
    return df.withColumns(cols)


def label(df: DataFrame, a: str = "team1_points_per_game", b: str = "team2_points_per_game",
          name: str = "label") -> DataFrame:
    """1 when ``a > b``; null compares false -> 0."""
    return df.withColumn(name, F.coalesce(F.col(a) > F.col(b), F.lit(False)).cast("int"))


def ratio_frame(games: DataFrame) -> DataFrame:
    """Efficiency -> turnover (E1-E10).  The raw statistics columns, which end in the ratios, are not
    carried on; the lineage is cut."""
    raw = [c for c in games.columns if any(c.startswith((f"{r}_off_", f"{r}_def_")) or c == f"{r}_GP" for r in ROLES)]
    with even_tasks(games.sparkSession):
        return materialize(turnover_features(efficiency_features(games)).drop(*raw))


def build_features(games: DataFrame, window: int = 3, with_label: bool = True, history=None) -> DataFrame:
    """F1 without scaling: efficiency -> turnover -> rolling -> matchup ->
    categorical -> fill, plus the raw-value label (fixes T1)."""
    return ratio_features(ratio_frame(games), window, with_label, history)


def ratio_features(df: DataFrame, window: int = 3, with_label: bool = True, history=None) -> DataFrame:
    """F1 after the ratios (:func:`ratio_frame`), whose lineage is cut.  The window
    passes see only what they need (one role and its rolled values, or the pair and
    its scores); their results are folded to one row per ``game_id``, which must be unique,
    and joined back once.  ``history`` (``carried.History``) is what earlier games
    left; without it every team and pair starts anew."""
    found = []
    for role in ROLES:
        stems = [s for s in ROLLING_STEMS if f"{role}_{s}" in df.columns]
        part = df.select(*dict.fromkeys([*ORDER, role, *(f"{role}_{s}" for s in stems)]))
        names = {f"{role}_{s}_rolling_{window}games": f"{role}_{s}" for s in stems}
        if history is None:
            rolled = windows.rolling_mean(part, [role], list(ORDER), names, window=window)
        else:
            rolled = carried.continue_rolling(part, history.rolling[role], role, ORDER, names, window)
        found.append(rolled.select("game_id", *names))
    pair = [c for c in ("team1", "team2", "team1_score", "team2_score") if c in df.columns]
    pairs = history.pairs if history is not None else None
    if len(pair) == 4 or pairs is not None:
        met = windows.head_to_head(df.select(*ORDER, *pair), order_by=ORDER, history=pairs)
        found.append(met.select("game_id", "head_to_head_win_pct", "head_to_head_avg_point_diff"))
    folded = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), found)
    folded = folded.groupBy("game_id").agg(*[F.max(c).alias(c) for c in folded.columns if c != "game_id"])
    out = df.join(folded, "game_id")
    if "head_to_head_win_pct" not in out.columns:
        out = matchup_features(out)
    out = fill_features(categorical_features(out))
    return label(out) if with_label else out


def independent_features(requests: DataFrame, window: int = 3) -> DataFrame:
    """F1 for requests that are scored each by itself: the rolling mean of a
    team without history is its own value and the pair has not met, so nothing
    is grouped, ordered or shuffled."""
    df = turnover_features(efficiency_features(requests))
    own = {f"{r}_{s}_rolling_{window}games": (F.col(f"{r}_{s}").cast("double") if f"{r}_{s}" in df.columns else F.lit(0.0))
           for r in ROLES for s in ROLLING_STEMS}
    df = df.withColumns({**own, "head_to_head_win_pct": F.lit(0.5), "head_to_head_avg_point_diff": F.lit(0.0)})
    return fill_features(categorical_features(df))
