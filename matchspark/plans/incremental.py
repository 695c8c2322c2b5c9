"""Registered queries of the incremental mechanisms: carried window state, season-partitioned
tables, merged scaler and quantile states, audits taken while writing, salted lookups."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import FEATURE_NAMES, ROLLING_STEMS
from ..operators import carried, features, joins, missing, models, observed, scaling, windows
from ..session import ensure_checkpoint_dir, materialize
from ..sources import season_table, standins
from ..sources.tables import table
from . import common
from .catalog import _MASKED, _ROLL_OUT, _features_sql, _scaled_sql, _scaler_sql, register
from .sqlparts import rnd, with_ctes


def _folder(spark, name: str) -> str:
    """A folder of this run under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- M3: mergeable quantile sketches
_SKETCHED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("median_sketches", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, count({c}) > 0 AS within_error FROM lineitem" for c in _SKETCHED))
def q_median_sketches(spark, sf):
    """A sketch for every column and shipping year, merged over the years; the exact ranks of the
    medians they give are then counted: half of all rows, within the stated error."""
    items = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("season"), *_SKETCHED)
    state = materialize(missing.quantile_state(items, _SKETCHED, by=["season"]))
    found = {r["column"]: r["value"] for r in missing.sketch_quantiles(missing.merge_quantile_states(state)).collect()}
    aggs = []
    for c in _SKETCHED:
        v, x = F.lit(found[c]), F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.count_if(x < v).alias(f"{c}__below"), F.count_if(x <= v).alias(f"{c}__upto")]
    off = missing.rank_error()
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("n"),
                      ((F.col(f"{c}__below") <= F.col(f"{c}__n") * (0.5 + off)) & (F.col(f"{c}__upto") >= F.col(f"{c}__n") * (0.5 - off)))
                      .alias("within_error")) for c in _SKETCHED]
    return items.agg(*aggs).select(F.inline(F.array(*parts)))


# ---------------------------------------------------------------- W1-W3: carried state
_LAST = "(SELECT max(season) FROM games)"


@register("carried_rolling", with_ctes("game_feats", "h2h") + _features_sql() + " SELECT game_id, season, "
          + ", ".join(f'{rnd(chr(34) + c + chr(34), 6)} AS "{c}"' for c in _ROLL_OUT) + ", "
          + ", ".join(f'{rnd(c, 6)} AS {c}' for c in ("head_to_head_win_pct", "head_to_head_avg_point_diff"))
          + f" FROM fr WHERE season = {_LAST}")
def q_carried_rolling(spark, sf):
    """The last season's rolling means and head-to-head shares from the merged state of two
    earlier parts: no row of an earlier season takes part but the ones in the state."""
    stems = [f"{r}_{s}" for r in ("team1", "team2") for s in ROLLING_STEMS]
    ratios = materialize(common.game_ratios(spark, sf).select(*common.KEYS, "team1_score", "team2_score", *stems))
    last = ratios.agg(F.max("season")).first()[0]
    cut = (ratios.agg(F.min("season")).first()[0] + last) // 2
    past = carried.History.of(ratios.where(F.col("season") <= cut))
    past = past.merge(carried.History.of(ratios.where((F.col("season") > cut) & (F.col("season") < last))))
    state = _folder(spark, "history")
    past.save(state)
    past, new, out = carried.History.load(spark, state), ratios.where(F.col("season") == last), None
    for role in ("team1", "team2"):
        names = {f"{role}_{s}_rolling_3games": f"{role}_{s}" for s in ROLLING_STEMS}
        part = new.select("season", "week", "game_id", role, *names.values())
        rolled = carried.continue_rolling(part, past.rolling[role], role, carried.ORDER, names).select("game_id", *names)
        out = rolled if out is None else out.join(rolled, "game_id")
    met = windows.head_to_head(new.select(*common.KEYS, "team1_score", "team2_score"), history=past.pairs)
    out = out.join(met.select("game_id", "season", "head_to_head_win_pct", "head_to_head_avg_point_diff"), "game_id")
    shares = ["head_to_head_win_pct", "head_to_head_avg_point_diff"]
    return common.round_cols(out.select("game_id", "season", *_ROLL_OUT, *shares), [*_ROLL_OUT, *shares])


@register("carried_streaks", """
  SELECT event_id, user_id, CAST(win_streak AS BIGINT) AS win_streak,
         CAST(coalesce(lag(win_streak) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS BIGINT) AS streak_before
  FROM (SELECT *, sum(CASE WHEN event_type IN ('purchase', 'click') THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS win_streak
        FROM (SELECT *, sum(CASE WHEN event_type IN ('purchase', 'click') THEN 0 ELSE 1 END)
                          OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island
              FROM events) a) b
  QUALIFY ts >= (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events)""")
def q_carried_streaks(spark, sf):
    """Streaks of the later half of all events, entered with the trailing wins of the earlier half,
    which is itself merged from two quarters."""
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", F.when(
        F.col("event_type").isin("purchase", "click"), "win").otherwise("loss").alias("result"))
    ends = e.agg(F.unix_micros(F.min(F.col("ts").cast("timestamp"))).alias("a"), F.unix_micros(F.max(F.col("ts").cast("timestamp"))).alias("b")).first()
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    half = F.lit(ends.a + (ends.b - ends.a) // 2)
    quarter = F.lit(ends.a + (ends.b - ends.a) // 4)
    order = ["ts", "event_id"]
    parts = [carried.streak_state(e.where(cond), "user_id", order_by=order) for cond in (at < quarter, (at >= quarter) & (at < half))]
    past = materialize(carried.merge_streaks(*parts))
    out = windows.win_streak(e.where(at >= half), team="user_id", order_by=order, history=past)
    return out.select("event_id", "user_id", "win_streak", "streak_before")


# ---------------------------------------------------------------- S3, P4, F1: one folder per season
_STORED = ["game_id", "season", "week", "team1", "team2", "team1_points_per_game", "team2_points_per_game"]


@register("season_table", with_ctes("game_feats") + "SELECT " + ", ".join(f'"{c}"' for c in _STORED)
          + " FROM game_feats WHERE season IN ((SELECT max(season) FROM games), (SELECT min(season) FROM games))")
def q_season_table(spark, sf):
    """All seasons but the last are written, the last one is added, the first one is corrected; the
    two are read back through a partition filter."""
    rows = materialize(common.game_ratios(spark, sf).select(*_STORED))
    ends = rows.agg(F.min("season").alias("a"), F.max("season").alias("b")).first()
    path = _folder(spark, "features")
    wrong = rows.withColumn("team1_points_per_game", F.when(F.col("season") == ends.a, -1.0).otherwise(F.col("team1_points_per_game")))
    season_table.write_seasons(wrong.where(F.col("season") < ends.b), path)
    season_table.write_seasons(rows.where(F.col("season") == ends.b), path)
    season_table.write_seasons(rows.where(F.col("season") == ends.a), path)
    return season_table.read_seasons(spark, path, rows.schema, [ends.a, ends.b])


# ---------------------------------------------------------------- V1, V8, M1, A2: audits of the write
@register("observed_audit", with_ctes("masked") + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n, count(*) - count(\"{c}\") AS missing, "
    f"CAST((count(*) - count(\"{c}\")) AS DOUBLE) / count(*) AS null_fraction, "
    f"count_if(season = 1998) AS rows_1998 FROM masked" for c in _MASKED))
def q_observed_audit(spark, sf):
    """Counts taken while the table is written; nothing is read for them."""
    _, audit = observed.write_audited(common.masked_stats(spark, sf), _folder(spark, "audited"), columns=_MASKED,
                                      counted={"season": [1998]})
    fractions = audit.null_fractions()
    return spark.createDataFrame([(c, audit.rows, audit.missing[c], fractions[c], audit.by_value["season"]["1998"]) for c in _MASKED],
                                 "column string, n long, missing long, null_fraction double, rows_1998 long")


# ---------------------------------------------------------------- F2: merged scaler state
def _features(spark, sf) -> DataFrame:
    return features.build_features(common.game_rows(spark, sf))


@register("scaler_merged", _scaler_sql())
def q_scaler_merged(spark, sf):
    """The training seasons' statistics, one season's state merged to the next."""
    rows = materialize(_features(spark, sf).where(F.col("season").between(1995, 1999)).select("season", *FEATURE_NAMES))
    state = scaling.scaler_state(rows.where("season = 1995"), FEATURE_NAMES)
    for season in range(1996, 2000):
        state = scaling.merge_states(state, scaling.scaler_state(rows.where(F.col("season") == season), FEATURE_NAMES))
    stats = scaling.state_statistics(materialize(state), FEATURE_NAMES)
    return common.round_cols(stats, stats.columns)


# ---------------------------------------------------------------- E15 on scaled features
@register("label_scaled", "SELECT game_id, season, CAST(team1_points_per_game > team2_points_per_game AS INTEGER) AS label_scaled "
          f"FROM ({_scaled_sql()}) s")
def q_label_scaled(spark, sf):
    """The original's label: points of both sides compared after each was scaled by its own column."""
    rows = materialize(_features(spark, sf).select("game_id", "season", *FEATURE_NAMES))
    scaled = scaling.Scaler(FEATURE_NAMES).fit(rows.where(F.col("season").between(1995, 1999))).transform(rows)
    points = ["team1_points_per_game", "team2_points_per_game"]
    return features.label(common.round_cols(scaled, points), name="label_scaled").select("game_id", "season", "label_scaled")


# ---------------------------------------------------------------- J2, J5: lookups too large to broadcast
@register("salted_lookup", with_ctes("game_rows") + """
  SELECT game_id, season, team1, team2, "team1_off_PTS", "team2_off_PTS" FROM game_rows""")
def q_salted_lookup(spark, sf):
    """J2 the way it goes when the statistics are too many to broadcast: replicated over salts."""
    lookup = joins.Lookup(common.team_stats(spark, sf), cells=0)
    s1 = joins.role_projection(lookup.frame.select("season", "Name", "off_PTS"), "team1")
    s2 = joins.role_projection(lookup.frame.select("season", "Name", "off_PTS"), "team2")
    out = lookup.join(lookup.join(standins.games(spark, sf), s1, ["season", "team1"]), s2, ["season", "team2"])
    return out.select("game_id", "season", "team1", "team2", "team1_off_PTS", "team2_off_PTS")


# ---------------------------------------------------------------- F16, K4 of known importances
_WEIGHED = ["team1_points_per_game", "team2_points_per_game", "team1_yards_per_game", "team2_yards_per_game",
            "team1_pass_yards_per_game", "team2_rush_yards_per_game"]


@register("importance_report", with_ctes("game_feats") + "SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank, "
          "feature, importance, importance / max(importance) OVER () AS share FROM ("
          + " UNION ALL ".join(f"SELECT '{c}' AS feature, {rnd('avg(' + chr(34) + c + chr(34) + ')', 6)} AS importance FROM game_feats"
                               for c in _WEIGHED) + ") x QUALIFY rank <= 5")
def q_importance_report(spark, sf):
    """Rank, order and bar share of a model whose importances are known: the features' means."""
    from pyspark.ml.linalg import Vectors

    class Known:
        pass
    means = common.game_ratios(spark, sf).agg(*[F.bround(F.avg(c), 6).alias(c) for c in _WEIGHED]).first()
    model = Known()
    model.featureImportances = Vectors.dense([means[c] for c in _WEIGHED])
    return models.feature_importance(spark, model, _WEIGHED, top_n=5)
