"""Ordered-window operators that stay balanced when one key is hot.

A plain ``Window.partitionBy(team).orderBy(...)`` sends every row of a team
to one task; with 25 teams, or one team holding a third of all rows, that
task is the whole job.  The operators here always range-partition on the key
*and* the whole order, which ends in a unique column, so a key of any size
(and any run of ties on the other order columns) is spread over as many
ranges as its rows need:

1. rows are range-partitioned on ``(key, order)`` and the number of the range
   is kept as a column, fixed by a reliable checkpoint (the ranges come from a
   sample, so a second evaluation could cut elsewhere);
2. totals per ``(key, range)`` come from a map-side combined aggregate, one
   small row each;
3. exclusive running totals over the ranges of a key are a window over that
   small table, joined back to the rows;
4. a local running window inside ``(key, range)`` adds the rest.

There is one way for all sizes: no row limit, no sub-splitting, any order type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, even_tasks, materialize

_CHUNK_AGG = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
_OFFSET_AGG = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def _join_null_safe(big: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on ``keys`` where null matches null (a null team or chunk
    is still one group), planned as an ordinary equi-join."""
    ren = small.select(*[F.col(k).alias(f"__jk_{k}") for k in keys],
                       *[c for c in small.columns if c not in keys])
    cond = None
    for k in keys:
        c = big[k].eqNullSafe(ren[f"__jk_{k}"])
        cond = c if cond is None else cond & c
    return big.join(ren, cond, "left").drop(*[f"__jk_{k}" for k in keys])


def _combine(kind: str, off: Column, local: Column) -> Column:
    if kind == "count":
        return F.coalesce(off, F.lit(0)) + local
    if kind == "sum":
        return (F.when(off.isNull() & local.isNull(), F.lit(None))
                .otherwise(F.coalesce(off, F.lit(0)) + F.coalesce(local, F.lit(0))))
    if kind == "max":
        return F.greatest(off, local)
    if kind == "min":
        return F.least(off, local)
    raise ValueError(f"unknown prefix aggregate {kind!r}")


RANGE = "__range"


def ordered_ranges(df: DataFrame, partition_by, order_by: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``df`` with ``__range``, the number of its range in ``(partition_by, order_by)``.

    ``order_by`` are column names, the last one unique within a key.  Without
    ``ranges`` their number is ``spark.sql.shuffle.partitions``, coalesced by
    AQE where the data is small."""
    cols = [*_cols(partition_by), *order_by]
    dealt = df.repartitionByRange(ranges, *cols) if ranges else df.repartitionByRange(*cols)
    with even_tasks(df.sparkSession):
        return materialize(dealt.withColumn(RANGE, F.spark_partition_id()))


def _before(parts: DataFrame, part: list[str], aggs: dict) -> DataFrame:
    """Running aggregates over the earlier ranges of each key (small table)."""
    w = Window.partitionBy(*part).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(*part, RANGE, *[e.over(w).alias(n) for n, e in aggs.items()])


def prefix_scan(df: DataFrame, partition_by, order_by: Sequence[str], aggs: dict,
                ranges: int | None = None) -> DataFrame:
    """Add running aggregates per ``partition_by`` along ``order_by``.

    ``aggs`` maps an output name to ``(kind, column)`` or
    ``(kind, column, inclusive)`` with kind in sum / count / max / min;
    ``inclusive=False`` excludes the current row (frame ends at -1).
    """
    part = _cols(partition_by)
    spec = {n: (a[0], a[1], a[2] if len(a) > 2 else True) for n, a in aggs.items()}
    base = ordered_ranges(df.withColumns({f"__pv_{n}": e for n, (_, e, _) in spec.items()}), part, order_by, ranges)
    keys = [*part, RANGE]
    totals = base.groupBy(*keys).agg(*[_CHUNK_AGG[k](f"__pv_{n}").alias(f"__pt_{n}") for n, (k, _, _) in spec.items()])
    offsets = _before(totals, part, {f"__po_{n}": _OFFSET_AGG[k](F.col(f"__pt_{n}")) for n, (k, _, _) in spec.items()})
    w = Window.partitionBy(*keys).orderBy(*order_by)
    local = base.withColumns({
        f"__pl_{n}": _CHUNK_AGG[k](F.col(f"__pv_{n}")).over(w.rowsBetween(Window.unboundedPreceding, 0 if inc else -1))
        for n, (k, _, inc) in spec.items()})
    out = _join_null_safe(local, offsets, keys).withColumns(
        {n: _combine(k, F.col(f"__po_{n}"), F.col(f"__pl_{n}")) for n, (k, _, _) in spec.items()})
    return out.drop(*[f"__{t}_{n}" for n in spec for t in ("pv", "pl", "po")], RANGE)


def row_position(df: DataFrame, partition_by, order_by, name: str = "rn", ranges: int | None = None) -> DataFrame:
    """1-based position of each row inside its ``partition_by`` group."""
    return prefix_scan(df, partition_by, order_by, {name: ("count", F.lit(1))}, ranges)


def rolling_mean(df: DataFrame, partition_by, order_by: Sequence[str], value_cols: dict, window: int = 3,
                 include_current: bool = True, ranges: int | None = None) -> DataFrame:
    """Mean of the current and ``window-1`` previous rows per group
    (``include_current=False``: the ``window`` rows before).

    ``value_cols`` maps output name -> input column name.  Nulls are
    skipped and one row is enough (pandas ``rolling(min_periods=1)``).

    Earlier rows of the same range are ``lag`` columns; for the first rows of a
    range they come from the last rows of earlier ranges of the key, a table of
    at most ``window`` rows per range.
    """
    part, order = _cols(partition_by), list(order_by)
    back = int(window) - 1 if include_current else int(window)
    base = ordered_ranges(df, part, order, ranges)
    keys = [*part, RANGE]
    w = Window.partitionBy(*keys).orderBy(*order)
    value = {o: F.col(c).cast("double") for o, c in value_cols.items()}
    if not back:
        return base.withColumns(value).drop(RANGE)
    last = (base.select(*keys, *order, F.struct(*[v.alias(o) for o, v in value.items()]).alias("__row"))
            .withColumn("__after", F.lead(F.lit(1), back).over(w)).withColumn("__pos", F.row_number().over(w))
            .where(F.col("__after").isNull())
            .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("__pos", "__row"))).alias("__tail")))
    w_prev = Window.partitionBy(*part).orderBy(RANGE).rowsBetween(-back, -1)
    prev = last.select(*keys, F.flatten(F.collect_list("__tail").over(w_prev)).alias("__prev"))
    cols = {"__pos": F.row_number().over(w)}
    for o, v in value.items():
        for i in range(1, back + 1):
            cols[f"__l{i}_{o}"] = F.lag(v, i).over(w)
    joined = _join_null_safe(base.withColumns(cols), prev, keys)
    pos, out = F.col("__pos"), {}
    for o, v in value.items():
        seen = [v] if include_current else []
        for i in range(1, back + 1):
            earlier = F.try_element_at(F.col("__prev"), F.least(pos - i - 1, F.lit(-1)))["__row"][o]
            seen.append(F.when(pos > i, F.col(f"__l{i}_{o}")).otherwise(earlier))
        # added from the oldest on, as a plain sliding frame does
        total, n = F.lit(0.0), F.lit(0)
        for x in reversed(seen):
            total, n = total + F.coalesce(x, F.lit(0.0)), n + x.isNotNull().cast("int")
        out[o] = F.when(n > 0, total / n)
    return joined.withColumns(out).drop(*cols, "__prev", RANGE)


def keep_first(df: DataFrame, key, order_by: Sequence, last: bool = False) -> DataFrame:
    """One row per ``key``: the first (or last) by ``order_by``.

    A per-key ``min_by``/``max_by`` of the whole row as a struct — an
    aggregate with map-side combine, so a hot key costs one partial row per
    task instead of a full sort of that key.
    """
    keys = _cols(key)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    rest = [c for c in df.columns if c not in keys]
    ordkey = F.struct(*order)
    pick = F.max_by if last else F.min_by
    agg = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in rest]), ordkey).alias("__row"))
    return agg.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def head_to_head(games: DataFrame, team1: str = "team1", team2: str = "team2",
                 score1: str = "team1_score", score2: str = "team2_score",
                 order_by: Sequence = ("season", "week", "game_id"),
                 win_pct: str = "head_to_head_win_pct",
                 avg_diff: str = "head_to_head_avg_point_diff", ranges: int | None = None,
                 history: DataFrame | None = None) -> DataFrame:
    """Share of earlier meetings of the same (unordered) pair won by this
    row's ``team1`` and the mean earlier point difference seen from
    ``team1``; ``0.5`` / ``0.0`` when the pair has not met before.

    Only earlier meetings with known scores count; when no result is known
    (scores null) every row gets the constants.  ``history`` are pair totals of
    games before all of these (``carried.pair_state``); without score columns they
    are all that is known.
    """
    if score1 not in games.columns or score2 not in games.columns:
        none = F.lit(None).cast("double")
        known = head_to_head(games.withColumns({score1: none, score2: none}), team1, team2, score1, score2, order_by,
                             win_pct, avg_diff, ranges, history)
        return known.drop(score1, score2)
    t1, t2 = F.col(team1), F.col(team2)
    lo = F.least(t1, t2)
    s1, s2 = F.col(score1), F.col(score2)
    g = games.withColumns({"__lo": lo, "__hi": F.greatest(t1, t2)})
    t1_is_lo = t1 == F.col("__lo")
    lo_won = F.when(t1_is_lo, s1 > s2).otherwise(s2 > s1)
    hi_won = F.when(t1_is_lo, s2 > s1).otherwise(s1 > s2)
    diff_lo = F.when(t1_is_lo, s1 - s2).otherwise(s2 - s1)
    scanned = prefix_scan(
        g, ["__lo", "__hi"], list(order_by),
        {
            "__n": ("count", diff_lo, False),
            "__wlo": ("sum", F.coalesce(lo_won, F.lit(False)).cast("long"), False),
            "__whi": ("sum", F.coalesce(hi_won, F.lit(False)).cast("long"), False),
            "__d": ("sum", diff_lo, False),
        }, ranges)
    if history is not None:
        old = history.select(F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), F.col("meetings").alias("__n0"),
                             F.col("lo_wins").alias("__w0"), F.col("hi_wins").alias("__w1"), F.col("lo_diff").alias("__d0"))
        add = lambda a, b: F.coalesce(F.col(a), F.lit(0)) + F.coalesce(F.col(b), F.lit(0))
        scanned = (scanned.join(broadcast_if_small(old), ["__lo", "__hi"], "left")
                   .withColumns({"__n": add("__n", "__n0"), "__wlo": add("__wlo", "__w0"), "__whi": add("__whi", "__w1"),
                                 "__d": add("__d", "__d0")}).drop("__n0", "__w0", "__w1", "__d0"))
    n = F.col("__n").cast("double")
    wins = F.when(F.col(team1) == F.col("__lo"), F.col("__wlo")).otherwise(F.col("__whi"))
    dsum = F.coalesce(F.col("__d").cast("double"), F.lit(0.0))
    dsum = F.when(F.col(team1) == F.col("__lo"), dsum).otherwise(-dsum)
    return (scanned
            .withColumn(win_pct, F.when(F.col("__n") > 0, wins.cast("double") / n).otherwise(F.lit(0.5)))
            .withColumn(avg_diff, F.when(F.col("__n") > 0, dsum / n).otherwise(F.lit(0.0)))
            .drop("__lo", "__hi", "__n", "__wlo", "__whi", "__d"))


def win_streak(results: DataFrame, team: str = "team", result: str = "result",
               order_by: Sequence = ("season", "week", "game_id"),
               streak: str = "win_streak", before: str = "streak_before", ranges: int | None = None,
               history: DataFrame | None = None) -> DataFrame:
    """Consecutive wins up to and including each game; a loss or a tie
    resets the streak to 0.  ``before`` is the streak entering the game.

    ``cw`` are the running wins and ``m`` the running maximum of ``cw`` at
    other results; the streak is ``cw - m``.  Both are local to a range; what
    earlier ranges add follows from their number of wins and their last ``m``.
    ``history`` holds the trailing wins of each team before all of these games
    (``carried.streak_state``): they last until its first other result here.
    """
    is_win = F.coalesce(F.col(result) == "win", F.lit(False))
    base = ordered_ranges(results, [team], order_by, ranges)
    keys = [team, RANGE]
    w = Window.partitionBy(*keys).orderBy(*order_by)
    upto, until = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    local = base.withColumn("__cw", F.sum(is_win.cast("long")).over(upto))
    mark = F.when(~is_win, F.col("__cw"))
    local = local.withColumns({"__m": F.max(mark).over(upto), "__mp": F.max(mark).over(until)})
    parts = local.groupBy(*keys).agg(F.max("__cw").alias("__wins"), F.max("__m").alias("__mark"))
    wins = _before(parts, [team], {"__wb": F.sum("__wins")})
    parts = _join_null_safe(parts, wins, keys).withColumn("__wb", F.coalesce("__wb", F.lit(0)))
    marks = _before(parts.withColumn("__mark", F.col("__wb") + F.col("__mark")), [team], {"__mb": F.max("__mark")})
    offsets = _join_null_safe(parts.select(*keys, "__wb"), marks, keys)
    out = _join_null_safe(local, offsets, keys)
    cw, none = F.col("__wb") + F.col("__cw"), F.lit(0)
    if history is not None:
        old = history.select(F.col("team").alias(f"__jk_{team}"), F.col("trailing").alias("__h"))
        out = out.join(broadcast_if_small(old), out[team].eqNullSafe(old[f"__jk_{team}"]), "left").drop(f"__jk_{team}")
        none = -F.coalesce(F.col("__h"), F.lit(0))
    reset = lambda m: F.coalesce(F.greatest(F.col("__mb"), F.col("__wb") + F.col(m)), none)
    return (out.withColumn(streak, (cw - reset("__m")).cast("long"))
            .withColumn(before, (cw - is_win.cast("long") - reset("__mp")).cast("long"))
            .drop("__cw", "__m", "__mp", "__wb", "__mb", "__h", RANGE))
