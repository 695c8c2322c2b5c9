"""

Each entry is ``(spark_fn, oracle_sql or None)``; ``spark_fn(spark, sf_dir)``
returns a DataFrame over the whole test tables.  The SQL restates the
operator independently for DuckDB.  Column names and types agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import DOCUMENTED_RANGES, FEATURE_NAMES, ROLLING_STEMS, TEAM_FEATURE_STEMS, WEATHER_CONDITIONS
from ..functions.draw import arithmetic_uniform
from ..operators import features, joins, metrics, missing, quality, results, scaling, split, vote, windows
from ..session import materialize
from ..sources import standins
from ..sources.tables import table
from . import common
from .sqlparts import metrics_sql, off_def_sql, rating_select, rnd, with_ctes

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------- stand-ins
@register("games", with_ctes("games") + "SELECT * FROM games")
def q_games(spark, sf):
    return standins.games(spark, sf)


@register("offense_stats", with_ctes("offense") + "SELECT * FROM offense")
def q_offense(spark, sf):
    return standins.offense(spark, sf)


@register("defense_stats", with_ctes("defense") + "SELECT * FROM defense")
def q_defense(spark, sf):
    return standins.defense(spark, sf)


# ---------------------------------------------------------------- joins
@register("team_stats", with_ctes("stats") + "SELECT * FROM stats")
def q_team_stats(spark, sf):
    return common.team_stats(spark, sf)


@register("game_rows", with_ctes("game_rows") + "SELECT * FROM game_rows")
def q_game_rows(spark, sf):
    return common.game_rows(spark, sf)


# ---------------------------------------------------------------- ratios
_RATIO_NAMES = [f"{r}_{s}" for r in ("team1", "team2") for s in TEAM_FEATURE_STEMS[:7]]
_TURN_NAMES = [f"{r}_{s}" for r in ("team1", "team2") for s in TEAM_FEATURE_STEMS[7:10]]


@register("efficiency_features",
          with_ctes("game_feats") + "SELECT game_id, season, \"week\", team1, team2, "
          + ", ".join(f'"{n}"' for n in _RATIO_NAMES) + " FROM game_feats")
def q_efficiency(spark, sf):
    df = features.efficiency_features(common.game_rows(spark, sf))
    return df.select(*common.KEYS, *_RATIO_NAMES)


@register("turnover_features",
          with_ctes("game_feats") + "SELECT game_id, season, \"week\", team1, team2, "
          + ", ".join(f'"{n}"' for n in _TURN_NAMES) + " FROM game_feats")
def q_turnover(spark, sf):
    df = features.turnover_features(common.game_rows(spark, sf))
    return df.select(*common.KEYS, *_TURN_NAMES)


# ---------------------------------------------------------------- windows
def _rolling_sql() -> str:
    cols = []
    for role in ("team1", "team2"):
        for s in ROLLING_STEMS:
            cols.append(
                rnd(f'avg("{role}_{s}") OVER (PARTITION BY {role} ORDER BY season, "week", game_id '
                    f'ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 6) + f' AS "{role}_{s}_rolling_3games"')
    return (with_ctes("game_feats") + "SELECT game_id, season, \"week\", team1, team2, "
            + ", ".join(cols) + " FROM game_feats")


_ROLL_OUT = [f"{r}_{s}_rolling_3games" for r in ("team1", "team2") for s in ROLLING_STEMS]


@register("rolling_features", _rolling_sql())
def q_rolling(spark, sf):
    df = materialize(common.game_ratios(spark, sf).select(
        *common.KEYS, *[f"{r}_{s}" for r in ("team1", "team2") for s in ROLLING_STEMS]))
    df = features.rolling_features(df, window=3)
    return common.round_cols(df.select(*common.KEYS, *_ROLL_OUT), _ROLL_OUT)



@register("head_to_head", with_ctes("h2h") + "SELECT * FROM h2h")
def q_head_to_head(spark, sf):
    g = standins.games(spark, sf)
    return windows.head_to_head(g).select(*common.KEYS, "head_to_head_win_pct",
                                          "head_to_head_avg_point_diff")


@register("win_streak", with_ctes("streaks") + "SELECT * FROM streaks")
def q_win_streak(spark, sf):
    res = results.results_long(standins.games(spark, sf))
    return results.win_streaks(res).select("game_id", "season", "week", "team", "opponent", "result",
                                           "win_streak", "streak_before")


# ---------------------------------------------------------------- standings
_STANDINGS_SQL = """
  SELECT team, count_if(result = 'win') AS wins, count_if(result = 'loss') AS losses,
         count_if(result = 'tie') AS ties
  FROM results GROUP BY team"""


@register("standings", with_ctes("results") + _STANDINGS_SQL)
def q_standings(spark, sf):
    return results.standings(results.results_long(standins.games(spark, sf)))


@register("conference_standings", with_ctes("results") + f"""
  , st AS ({_STANDINGS_SQL})
  , conf AS (SELECT n.n_name AS team, r.r_name AS conference
             FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey)
  SELECT st.team, st.wins, st.losses, st.ties, conf.conference,
         CAST(row_number() OVER (PARTITION BY conf.conference ORDER BY st.wins DESC, st.team) AS INTEGER)
           AS conference_rank
  FROM st JOIN conf ON conf.team = st.team""")
def q_conference_standings(spark, sf):
    st = results.standings(results.results_long(standins.games(spark, sf)))
    return results.conference_standings(st, standins.conferences(spark, sf))


# ---------------------------------------------------------------- ratings
_DROPPED_NATION = "NATION_7"   # stand-in: defense statistics missing for one team


def _ratings(spark, sf, drop_one: bool):
    dfn = standins.defense(spark, sf)
    if drop_one:
        dfn = dfn.where(F.col("Name") != _DROPPED_NATION)
    od = joins.offense_with_defense(standins.offense(spark, sf), dfn)
    return results.team_ratings(od)


_RATING_OUT = ["plays_per_game", "team_efficiency", "production_allowed", "x_off", "x_def", "net",
               "x_wins", "x_losses", "expected_points_for", "net_production"]
_DISPLAY = {"team_efficiency_display": ("team_efficiency", 3), "production_allowed_display": ("production_allowed", 2),
            "x_off_display": ("x_off", 2), "x_def_display": ("x_def", 2), "net_display": ("net", 2),
            "x_wins_display": ("x_wins", 2), "x_losses_display": ("x_losses", 2)}


def _ratings_sql() -> str:
    disp = ", ".join(f'{rnd(chr(34) + src + chr(34), d)} AS "{n}"' for n, (src, d) in _DISPLAY.items())
    return (with_ctes("offense", "defense")
            + f", od AS ({off_def_sql(chr(34) + 'Name' + chr(34) + ' <> ' + repr(_DROPPED_NATION))})"
            + f", rt AS ({rating_select('od')})"
            + f" SELECT *, {disp} FROM rt")


@register("team_ratings", _ratings_sql())
def q_team_ratings(spark, sf):
    return results.ratings_summary(_ratings(spark, sf, drop_one=True))


@register("expected_wins_order", with_ctes("ratings") + """
  SELECT season, "Name", x_wins, x_losses,
         CAST(row_number() OVER (PARTITION BY season ORDER BY x_wins DESC, "Name") AS INTEGER) AS "position"
  FROM ratings""")
def q_expected_wins(spark, sf):
    r = _ratings(spark, sf, drop_one=False).select("season", "Name", "x_wins", "x_losses")
    return results.rank_by(r, ["season"], [F.desc("x_wins"), F.col("Name")])


def _scores_sql(use_weather: bool) -> str:
    if use_weather:
        fe = "CASE w.weather WHEN 'Clear' THEN 1.0 WHEN 'Rain' THEN 0.9 WHEN 'Snow' THEN 0.8 WHEN 'Wind' THEN 0.85 ELSE 1.0 END"
        fn = "CASE w.weather WHEN 'Clear' THEN 1.0 WHEN 'Rain' THEN 1.1 WHEN 'Snow' THEN 1.2 WHEN 'Wind' THEN 1.15 ELSE 1.0 END"
        e1, e2 = f"(r1.team_efficiency * {fe})", f"(r2.team_efficiency * {fe})"
        n1, n2 = f"(r1.net_production * {fn})", f"(r2.net_production * {fn})"
        src = "wx w"
    else:
        e1, e2, n1, n2 = "r1.team_efficiency", "r2.team_efficiency", "r1.net_production", "r2.net_production"
        src = "games w"
    s1 = f"(({e1} + ({n1} - r2.production_allowed)) * (1.0 + CAST(0.02 AS DOUBLE) * CAST(b1.streak_before AS DOUBLE)))"
    s2 = (f"((({e2} + ({n2} - r1.production_allowed)) * CAST(1.05 AS DOUBLE))"
          f" * (1.0 + CAST(0.02 AS DOUBLE) * CAST(b2.streak_before AS DOUBLE)))")
    extra = ", w.weather" if use_weather else ""
    return f"""
  , sc AS (
    SELECT w.game_id, w.season, w."week", w.team1, w.team2{extra},
           b1.streak_before AS team1_streak, b2.streak_before AS team2_streak,
           {s1} AS score1, {s2} AS score2
    FROM {src}
    JOIN streaks b1 ON b1.game_id = w.game_id AND b1.team = w.team1
    JOIN streaks b2 ON b2.game_id = w.game_id AND b2.team = w.team2
    JOIN ratings r1 ON r1.season = w.season AND r1."Name" = w.team1
    JOIN ratings r2 ON r2.season = w.season AND r2."Name" = w.team2)
  , oc AS (SELECT *, CASE WHEN score1 > score2 THEN 'win1' WHEN score2 > score1 THEN 'win2' ELSE 'tie' END AS outcome FROM sc)
  SELECT game_id, season, "week", team1, team2{", weather" if use_weather else ""}, team1_streak, team2_streak,
         {rnd("score1", 6)} AS score1, {rnd("score2", 6)} AS score2, outcome,
         CASE outcome
           WHEN 'win1' THEN 'Week ' || CAST("week" AS VARCHAR) || ': ' || team1 || ' defeat ' || team2 || '.'
           WHEN 'win2' THEN 'Week ' || CAST("week" AS VARCHAR) || ': ' || team2 || ' defeat ' || team1 || '.'
           ELSE 'Week ' || CAST("week" AS VARCHAR) || ': ' || team1 || ' ties with ' || team2 || '.' END AS summary
  FROM oc"""


def _game_scores(spark, sf, use_weather: bool):
    g = standins.games(spark, sf)
    g2 = g.join(results.streaks_by_game(g), "game_id")
    cols = list(common.KEYS)
    if use_weather:
        u = arithmetic_uniform(F.col("game_id"), seed=WEATHER_SEED)
        g2 = results.draw_weather(g2, standins.team_odds(spark, sf), u)
        cols.append("weather")
    sc = results.game_scores(g2, _ratings(spark, sf, drop_one=False), streak1="team1_streak",
                             streak2="team2_streak", condition="weather" if use_weather else None,
                             use_weather=use_weather)
    sc = common.round_cols(sc, ["score1", "score2"])
    return sc.select(*cols, "team1_streak", "team2_streak", "score1", "score2", "outcome", "summary")


@register("game_scores", with_ctes("games", "streaks", "ratings") + _scores_sql(False))
def q_game_scores(spark, sf):
    return _game_scores(spark, sf, use_weather=False)


# ---------------------------------------------------------------- weather
WEATHER_SEED = 17
_ODDS_SQL = """
  , reg_odds(conference, condition, p) AS (VALUES """ + ", ".join(
    f"('{r}', '{c}', CAST({p!r} AS DOUBLE))" for r, ps in standins.REGION_WEATHER.items()
    for c, p in zip(WEATHER_CONDITIONS, ps)) + """)
  , team_odds AS (SELECT n.n_name AS home_team, o.condition, o.p
                  FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
                  JOIN reg_odds o ON o.conference = r.r_name)"""


@register("weather_odds", with_ctes("games") + _ODDS_SQL + """
  SELECT g.game_id, g.team2, coalesce(o.condition, 'Clear') AS condition, coalesce(o.p, 1.0) AS p
  FROM games g LEFT JOIN team_odds o ON o.home_team = g.team2""")
def q_weather_odds(spark, sf):
    g = standins.games(spark, sf).select("game_id", "team2")
    return joins.attach_weather_odds(g, standins.team_odds(spark, sf))


def _draw_sql() -> str:
    u = f"(CAST((g.game_id * 7919 + {WEATHER_SEED}) % 10000 AS DOUBLE) / 10000.0)"
    w = {c: f"coalesce(max(CASE WHEN o.condition = '{c}' THEN o.p END), 0.0)" for c in WEATHER_CONDITIONS}
    return (_ODDS_SQL + f"""
  , wide AS (SELECT g.game_id, g.team2, {u} AS u, count(o.home_team) AS has_odds,
                    {", ".join(f"{e} AS w_{c}" for c, e in w.items())}
             FROM games g LEFT JOIN team_odds o ON o.home_team = g.team2
             GROUP BY g.game_id, g.team2)
  , cum AS (SELECT game_id, team2, u,
                   CASE WHEN has_odds = 0 THEN 1.0 ELSE w_Clear END AS c1,
                   CASE WHEN has_odds = 0 THEN 1.0 ELSE w_Clear + w_Rain END AS c2,
                   CASE WHEN has_odds = 0 THEN 1.0 ELSE w_Clear + w_Rain + w_Snow END AS c3,
                   CASE WHEN has_odds = 0 THEN 1.0 ELSE w_Clear + w_Rain + w_Snow + w_Wind END AS c4
            FROM wide)
  , wx AS (SELECT g.*, CASE WHEN c1 > u * c4 THEN 'Clear' WHEN c2 > u * c4 THEN 'Rain'
                          WHEN c3 > u * c4 THEN 'Snow' WHEN c4 > u * c4 THEN 'Wind' ELSE 'Wind' END AS weather
           FROM games g JOIN cum ON cum.game_id = g.game_id)""")


@register("weather_draw", with_ctes("games") + _draw_sql() + """
  SELECT game_id, season, "week", team1, team2, weather FROM wx""")
def q_weather_draw(spark, sf):
    g = standins.games(spark, sf)
    u = arithmetic_uniform(F.col("game_id"), seed=WEATHER_SEED)
    return results.draw_weather(g, standins.team_odds(spark, sf), u).select(*common.KEYS, "weather")


@register("weather_adjusted_scores", with_ctes("games", "streaks", "ratings") + _draw_sql() + _scores_sql(True))
def q_weather_scores(spark, sf):
    return _game_scores(spark, sf, use_weather=True)



# ---------------------------------------------------------------- quality
@register("unmatched_games", with_ctes("games", "stats") + f"""
  , st AS (SELECT * FROM stats WHERE "Name" <> '{_DROPPED_NATION}')
  SELECT g.*, CASE WHEN s1."Name" IS NULL AND s2."Name" IS NULL THEN 'both'
                   WHEN s1."Name" IS NULL THEN 'team1' ELSE 'team2' END AS missing
  FROM games g
  LEFT JOIN st s1 ON s1.season = g.season AND s1."Name" = g.team1
  LEFT JOIN st s2 ON s2.season = g.season AND s2."Name" = g.team2
  WHERE s1."Name" IS NULL OR s2."Name" IS NULL""")
def q_unmatched(spark, sf):
    st = common.team_stats(spark, sf).where(F.col("Name") != _DROPPED_NATION)
    return joins.unmatched_games(standins.games(spark, sf), st)


_V4_COLS = ["p_size", "p_retailprice", "p_brand", "p_type", "p_mixed"]


def _part_strings(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        F.col("p_size").cast("string").alias("p_size"),
        F.col("p_retailprice").cast("string").alias("p_retailprice"),
        "p_brand", "p_type",
        F.when(F.col("p_partkey") % 11 == 0, F.lit("n/a"))
         .when(F.col("p_partkey") % 13 == 0, F.lit(None))
         .otherwise(F.col("p_size").cast("string")).alias("p_mixed"))


@register("numeric_audit", """
  WITH ps AS (SELECT CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice,
                     p_brand, p_type,
                     CASE WHEN p_partkey % 11 = 0 THEN 'n/a' WHEN p_partkey % 13 = 0 THEN NULL
                          ELSE CAST(p_size AS VARCHAR) END AS p_mixed
              FROM part)
  """ + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS present, "
    f"count_if({c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) AS non_numeric FROM ps"
    for c in _V4_COLS))
def q_numeric_audit(spark, sf):
    return quality.non_numeric_audit(_part_strings(spark, sf), _V4_COLS)


@register("range_audit", with_ctes("stats") + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(\"{c}\") AS n, "
    f"count_if(NOT (\"{c}\" BETWEEN {lo} AND {hi})) AS out_of_range, "
    f"CAST({lo} AS DOUBLE) AS low, CAST({hi} AS DOUBLE) AS high FROM stats"
    for c, (lo, hi) in DOCUMENTED_RANGES.items()))
def q_range_audit(spark, sf):
    return quality.range_audit(common.team_stats(spark, sf))


_V8_COLS = ["conference", "off_Run", "off_QB", "def_PA"]


@register("completeness_audit", with_ctes("masked") + """
  SELECT *, least(""" + ", ".join(f"present_{c}" for c in _V8_COLS) + """) AS min_present,
         "rows" >= 100 AS enough_rows,
         least(""" + ", ".join(f"present_{c}" for c in _V8_COLS) + """) >= 0.8 AS complete
  FROM (SELECT season, count(*) AS "rows", """ + ", ".join(
    f'count("{c}") / count(*) AS present_{c}' for c in _V8_COLS) + """
        FROM masked GROUP BY season) a""")
def q_completeness(spark, sf):
    return quality.completeness_audit(common.masked_stats(spark, sf), _V8_COLS)


# ---------------------------------------------------------------- missing values
_MASKED = ["season", "Name", "conference", "GP", "off_PTS", "off_Run", "off_QB", "def_PA", "def_DEF"]


@register("null_fractions", with_ctes("masked") + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CASE WHEN \"{c}\" IS NULL THEN 1.0 ELSE 0.0 END) AS null_fraction, "
    f"avg(CASE WHEN \"{c}\" IS NULL THEN 1.0 ELSE 0.0 END) > 0.2 AS dropped FROM masked" for c in _MASKED))
def q_null_fractions(spark, sf):
    fr = missing.null_fractions(common.masked_stats(spark, sf))
    return fr.withColumn("dropped", F.col("null_fraction") > F.lit(0.2))


def _median_sql(c: str) -> str:
    return f"""(SELECT (min(v) + max(v)) / 2.0 FROM (
        SELECT CAST("{c}" AS DOUBLE) AS v, row_number() OVER (ORDER BY "{c}") - 1 AS r,
               count(*) OVER () AS n FROM masked WHERE "{c}" IS NOT NULL) x
        WHERE r IN ((n - 1) // 2, n // 2))"""


@register("impute_missing", with_ctes("masked") + f"""
  SELECT season, "Name",
         coalesce(conference, (SELECT conference FROM masked WHERE conference IS NOT NULL
                               GROUP BY conference ORDER BY count(*) DESC, conference LIMIT 1)) AS conference,
         "GP", "off_PTS",
         coalesce(CAST("off_Run" AS DOUBLE), {_median_sql("off_Run")}) AS "off_Run",
         coalesce(CAST("off_QB" AS DOUBLE), {_median_sql("off_QB")}) AS "off_QB",
         "def_DEF"
  FROM masked""")
def q_impute(spark, sf):
    return missing.handle_missing_values(common.masked_stats(spark, sf), threshold=0.20)


# ---------------------------------------------------------------- split
_TRAIN, _VAL, _TEST = ["1995", "1996", "1997", "1998", "1999"], ["2000"], ["2001"]


def _split_games(spark, sf):
    g = standins.games(spark, sf)
    return split.split_data(g, _TRAIN, _VAL, _TEST)


_SPLIT_CASE = ("CASE WHEN CAST(season AS VARCHAR) IN ('1995','1996','1997','1998','1999') THEN 'train' "
               "WHEN CAST(season AS VARCHAR) = '2000' THEN 'val' WHEN CAST(season AS VARCHAR) = '2001' THEN 'test' END")


@register("split_policy", with_ctes("games") + """
  SELECT CAST(season AS VARCHAR) AS season,
         CASE row_number() OVER (ORDER BY season DESC) WHEN 1 THEN 'test' WHEN 2 THEN 'val' ELSE 'train' END AS split
  FROM (SELECT DISTINCT season FROM games) s""")
def q_split_policy(spark, sf):
    return split.split_policy(standins.games(spark, sf))


@register("split_assign", with_ctes("games") + f"""
  SELECT game_id, season, "week", team1, team2, {_SPLIT_CASE} AS split FROM games""")
def q_split_assign(spark, sf):
    return _split_games(spark, sf).select(*common.KEYS, "split")


@register("split_counts", with_ctes("games") + """
  SELECT count_if(season IN (1996, 1997)) AS train, count_if(season = 1998) AS val,
         count_if(season = 1999) AS test, count(*) AS total FROM games""")
def q_split_counts(spark, sf):
    g = standins.games(spark, sf)
    # 1996-1999 are listed: total still counts every game (A2)
    return split.split_counts(split.split_data(g, ["1996", "1997"], ["1998"], ["1999"]))


@register("distinct_seasons", with_ctes("games") + "SELECT DISTINCT season FROM games")
def q_distinct_seasons(spark, sf):
    return standins.games(spark, sf).select("season").distinct()


@register("season_bounds", with_ctes("games") + f"""
  SELECT split, min(TRY_CAST(CAST(season AS VARCHAR) AS INTEGER)) AS min_season,
         max(TRY_CAST(CAST(season AS VARCHAR) AS INTEGER)) AS max_season
  FROM (SELECT season, {_SPLIT_CASE} AS split FROM games) x WHERE split IS NOT NULL GROUP BY split""")
def q_season_bounds(spark, sf):
    return split.season_bounds(_split_games(spark, sf))


@register("season_overlap", with_ctes("games") + f"""
  SELECT season FROM (SELECT DISTINCT CAST(season AS VARCHAR) AS season FROM games
                      WHERE {_SPLIT_CASE} = 'train')
  INTERSECT
  SELECT season FROM (SELECT DISTINCT CAST(season AS VARCHAR) AS season FROM games
                      WHERE {_SPLIT_CASE} IN ('val', 'test'))""")
def q_season_overlap(spark, sf):
    g = _split_games(spark, sf).select(F.col("season").cast("string").alias("season"), "split")
    return (g.where(F.col("split") == "train").select("season").distinct()
             .intersect(g.where(F.col("split").isin("val", "test")).select("season").distinct()))


@register("missing_seasons", with_ctes("games") + """
  SELECT season FROM (VALUES ('1995'), ('2000'), ('2001'), ('2005'), ('2006')) t(season)
  EXCEPT SELECT CAST(season AS VARCHAR) FROM games""")
def q_missing_seasons(spark, sf):
    a = split.assignment_table(spark, ["1995"], ["2000", "2001"], ["2005", "2006"])
    return split.missing_seasons(standins.games(spark, sf), a)


@register("leakage_audit", with_ctes("games") + f"""
  SELECT game_id, count(DISTINCT split) AS n_splits
  FROM (SELECT game_id, {_SPLIT_CASE} AS split FROM games) x
  WHERE split IS NOT NULL GROUP BY game_id HAVING count(DISTINCT split) > 1""")
def q_leakage(spark, sf):
    return split.overlap_audit(_split_games(spark, sf))


@register("season_filter", with_ctes("game_feats") + """
  SELECT game_id, season, "week", team1, team2, team1_points_per_game, team2_points_per_game
  FROM game_feats WHERE season IN (1996, 1998)""")
def q_season_filter(spark, sf):
    g = common.game_ratios(spark, sf).where(F.col("season").isin(1996, 1998))
    return g.select(*common.KEYS, "team1_points_per_game", "team2_points_per_game")


# ---------------------------------------------------------------- label, metrics, votes
@register("label_positives", with_ctes("game_feats") + """
  SELECT season, CAST(sum(CAST(coalesce(team1_points_per_game > team2_points_per_game, false) AS INTEGER)) AS BIGINT)
         AS positives, count(*) AS games
  FROM game_feats GROUP BY season""")
def q_label_positives(spark, sf):
    g = features.label(common.game_ratios(spark, sf))
    return g.groupBy("season").agg(F.sum(F.col("label").cast("long")).alias("positives"),
                                   F.count(F.lit(1)).alias("games"))


@register("confusion_labels", metrics_sql(
    "(SELECT 'quality' AS model, quality AS y, 1 - toxic AS prediction FROM labels)"))
def q_confusion_labels(spark, sf):
    lab = table(spark, sf, "labels").select(F.lit("quality").alias("model"), F.col("quality").alias("y"),
                                            (F.lit(1) - F.col("toxic")).alias("prediction"))
    m = metrics.add_metrics(metrics.confusion(lab))
    return m.withColumnRenamed("model", "model_name")


@register("model_comparison", with_ctes("rule_long") + """
  SELECT model_name, accuracy, "precision", recall, f1_score, accuracy >= 0.71 AS meets_target
  FROM (""" + metrics_sql("rule_long") + ") m")
def q_model_comparison(spark, sf):
    return metrics.model_comparison(common.rule_predictions_long(spark, sf))


@register("metric_report", with_ctes("rule_long") + """
  SELECT *, """ + ", ".join(f"{rnd(c + ' * 100.0', 2)} AS {c}_pct" for c in ("accuracy", "\"precision\"", "recall", "f1_score")).replace('"precision"_pct', "precision_pct") + """
  FROM (""" + metrics_sql("rule_long") + ") m")
def q_metric_report(spark, sf):
    return metrics.metric_report(common.rule_predictions_long(spark, sf))


@register("predicted_wins", with_ctes("rule_long") + """
  SELECT model, CAST(sum(prediction) AS BIGINT) AS team1_wins, count(*) AS games FROM rule_long GROUP BY model""")
def q_predicted_wins(spark, sf):
    return metrics.predicted_wins(common.rule_predictions_long(spark, sf))


@register("confidence", with_ctes("rule_long") + """
  SELECT game_id, model, prediction,
         CASE WHEN prediction = 1 THEN p_team1 ELSE 1.0 - p_team1 END AS confidence
  FROM rule_long""")
def q_confidence(spark, sf):
    lg = common.rule_predictions_long(spark, sf)
    return lg.select("game_id", "model", "prediction",
                     vote.confidence(F.col("prediction"), F.col("p_team1")).alias("confidence"))


_PRED_COLS = [f"{m}_prediction" for m in common.RULE_MODELS]
_VOTES_SQL = " + ".join(f"coalesce({c}, 0)" for c in _PRED_COLS)


@register("consensus_season", with_ctes("rule_wide") + f"""
  SELECT "week", team1, team2,
         CASE WHEN ({_VOTES_SQL}) * 2 > 3 THEN team1 ELSE team2 END AS consensus_winner,
         {", ".join(_PRED_COLS)}
  FROM rule_wide""")
def q_consensus_season(spark, sf):
    return vote.season_predictions(common.rule_predictions(spark, sf), _PRED_COLS)


@register("consensus_game", with_ctes("rule_wide") + f"""
  SELECT game_id, team1, team2,
         CASE WHEN (coalesce(points_prediction, 0) + coalesce(yards_prediction, 0)) * 2 > 2 THEN team1
              WHEN (coalesce(points_prediction, 0) + coalesce(yards_prediction, 0)) * 2 < 2 THEN team2
              WHEN points_prediction = 1 THEN team1 ELSE team2 END AS consensus
  FROM rule_wide""")
def q_consensus_game(spark, sf):
    w = common.rule_predictions(spark, sf)
    flag = vote.consensus(["points_prediction", "yards_prediction"], tie="first")
    return w.select("game_id", "team1", "team2",
                    vote.winner_name(flag, F.col("team1"), F.col("team2")).alias("consensus"))


# ---------------------------------------------------------------- sort / top-k
@register("schedule_preview", with_ctes("games") + """
  SELECT game_id, season, "week", team1, team2 FROM games
  WHERE season = 1998 ORDER BY "week", game_id LIMIT 10""")
def q_preview(spark, sf):
    g = standins.games(spark, sf).where(F.col("season") == 1998)
    return g.orderBy("week", "game_id").limit(10).select(*common.KEYS)


@register("chronological_order", with_ctes("games") + """
  SELECT game_id, season, "week", team1, team2,
         CAST(row_number() OVER (PARTITION BY season ORDER BY "week", game_id) AS INTEGER) AS season_position
  FROM games""")
def q_chrono(spark, sf):
    g = standins.games(spark, sf).select(*common.KEYS)
    # a season is a seventh of all games: number it with the range-partitioned scan
    pos = windows.row_position(g, ["season"], ["week", "game_id"], "season_position")
    return pos.withColumn("season_position", F.col("season_position").cast("int"))


# ---------------------------------------------------------------- union, keep-first
@register("union_seasons", with_ctes("offense") + """
  SELECT season, "Name", "GP", "PTS", "All", "Pass", "Run", "QB", "RB", "WR", "TE"
  FROM offense WHERE season % 2 = 0
  UNION ALL
  SELECT season, "Name", "GP", "PTS", "All", "Pass", "Run", "QB",
         CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM offense WHERE season % 2 = 1""")
def q_union_seasons(spark, sf):
    from ..sources.seasons import union_seasons
    o = standins.offense(spark, sf)
    even = o.where(F.col("season") % 2 == 0)
    odd = o.where(F.col("season") % 2 == 1).drop("RB", "WR", "TE")
    return union_seasons([even, odd])


@register("keep_first_last", """
  SELECT c_nationkey, 'first' AS pick, c_custkey, c_name FROM (
    SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer) x WHERE r = 1
  UNION ALL
  SELECT c_nationkey, 'last', c_custkey, c_name FROM (
    SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) AS r FROM customer) y WHERE r = 1""")
def q_keep_first_last(spark, sf):
    c = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_name")
    first = windows.keep_first(c, "c_nationkey", ["c_custkey"]).withColumn("pick", F.lit("first"))
    last = windows.keep_first(c, "c_nationkey", ["c_custkey"], last=True).withColumn("pick", F.lit("last"))
    return first.unionByName(last).select("c_nationkey", "pick", "c_custkey", "c_name")


# ---------------------------------------------------------------- high-cardinality windows
@register("rolling_events", f"""
  SELECT event_id, user_id,
         {rnd("avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)", 6)}
           AS value_rolling_3
  FROM events""")
def q_rolling_events(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    r = windows.rolling_mean(e, ["user_id"], ["ts", "event_id"], {"value_rolling_3": "value"}, window=3)
    return common.round_cols(r.select("event_id", "user_id", "value_rolling_3"), ["value_rolling_3"])


@register("streak_events", """
  SELECT event_id, user_id, CAST(win_streak AS BIGINT) AS win_streak,
         CAST(coalesce(lag(win_streak) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS BIGINT) AS streak_before
  FROM (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS win_streak
        FROM (SELECT *, sum(CASE WHEN event_type <> 'purchase' THEN 1 ELSE 0 END)
                          OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island
              FROM events) a) b""")
def q_streak_events(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_type") == "purchase", "win").otherwise("loss").alias("result"))
    st = windows.win_streak(e, team="user_id", order_by=["ts", "event_id"])
    return st.select("event_id", "user_id", "win_streak", "streak_before")



# ---------------------------------------------------------------- F1-F3, P5
def _features_sql(drop_cols=()) -> str:
    """36 features (unscaled) + label on the game rows, in SQL."""
    roll = []
    for role in ("team1", "team2"):
        for st in ROLLING_STEMS:
            roll.append(f'avg(gf."{role}_{st}") OVER (PARTITION BY gf.{role} ORDER BY gf.season, gf."week", gf.game_id '
                        f'ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS "{role}_{st}_rolling_3games"')
    return (", fr AS (SELECT gf.*, " + ", ".join(roll)
            + ", h.head_to_head_win_pct, h.head_to_head_avg_point_diff"
            + ", 1 AS home_field_advantage, 0 AS rest_days_difference"
            + ", 1 AS weather_clear, 0 AS weather_rain, 0 AS weather_snow, 0 AS weather_wind"
            + ", CAST(coalesce(gf.team1_points_per_game > gf.team2_points_per_game, false) AS INTEGER) AS label"
            + " FROM game_feats gf JOIN h2h h ON h.game_id = gf.game_id)")


_F36 = FEATURE_NAMES


def _feature_frame(spark, sf):
    return features.build_features(common.game_rows(spark, sf))


@register("features_unscaled", with_ctes("game_feats", "h2h") + _features_sql() + " SELECT game_id, season, label, "
          + ", ".join(f'{rnd("CAST(" + chr(34) + c + chr(34) + " AS DOUBLE)", 6)} AS "{c}"' for c in _F36) + " FROM fr")
def q_features_unscaled(spark, sf):
    df = _feature_frame(spark, sf).select("game_id", "season", "label", *_F36)
    return common.round_cols(df, _F36)


def _scaler_sql() -> str:
    aggs = ", ".join(f'{rnd("avg(CAST(" + chr(34) + c + chr(34) + " AS DOUBLE))", 6)} AS "{c}__mean", '
                     f'{rnd("stddev_pop(CAST(" + chr(34) + c + chr(34) + " AS DOUBLE))", 6)} AS "{c}__std"' for c in _F36)
    return (with_ctes("game_feats", "h2h") + _features_sql()
            + f" SELECT {aggs} FROM fr WHERE season BETWEEN 1995 AND 1999")


@register("scaler_fit", _scaler_sql())
def q_scaler_fit(spark, sf):
    df = _feature_frame(spark, sf).where(F.col("season").between(1995, 1999))
    st = scaling.fit_scaler(df, _F36)
    return common.round_cols(st, st.columns)


def _scaled_sql() -> str:
    stats = ", ".join(f'avg(CAST("{c}" AS DOUBLE)) AS "m_{c}", stddev_pop(CAST("{c}" AS DOUBLE)) AS "s_{c}"' for c in _F36)
    cols = ", ".join(
        rnd(f'(CAST(fr."{c}" AS DOUBLE) - st."m_{c}") / (CASE WHEN st."s_{c}" = 0 OR st."s_{c}" IS NULL '
            f'THEN 1.0 ELSE st."s_{c}" END)', 6) + f' AS "{c}"' for c in _F36)
    return (with_ctes("game_feats", "h2h") + _features_sql()
            + f", st AS (SELECT {stats} FROM fr WHERE season BETWEEN 1995 AND 1999)"
            + f" SELECT fr.game_id, fr.season, fr.label, {cols} FROM fr CROSS JOIN st")


@register("scaled_features", _scaled_sql())
def q_scaled_features(spark, sf):
    df = materialize(_feature_frame(spark, sf).select("game_id", "season", "label", *_F36))
    sc = scaling.Scaler(_F36).fit(df.where(F.col("season").between(1995, 1999)))
    out = sc.transform(df).select("game_id", "season", "label", *_F36)
    return common.round_cols(out, _F36)


@register("default_fill", with_ctes("game_feats") + """
  SELECT game_id, season, "week", team1, team2,
         0.0 AS team1_pass_yards_per_game, 0.0 AS team2_pass_yards_per_game,
         0.0 AS team1_rush_yards_per_game, 0.0 AS team2_rush_yards_per_game,
         0.0 AS team1_turnovers_gained, 0.0 AS team2_turnovers_gained,
         team1_points_per_game, team2_points_per_game
  FROM game_feats""")
def q_default_fill(spark, sf):
    g = common.game_rows(spark, sf).drop("team1_off_Pass", "team2_off_Pass", "team1_off_Run", "team2_off_Run",
                                         "team1_def_QB", "team2_def_QB")
    df = features.fill_features(features.turnover_features(features.efficiency_features(g)))
    return df.select(*common.KEYS, "team1_pass_yards_per_game", "team2_pass_yards_per_game",
                     "team1_rush_yards_per_game", "team2_rush_yards_per_game",
                     "team1_turnovers_gained", "team2_turnovers_gained",
                     "team1_points_per_game", "team2_points_per_game")



# ---------------------------------------------------------------- models (rows-only checks)
# Every query trains what it returns, at values of the original grids.
def _prepared(spark, sf):
    from . import pipeline
    return pipeline.prepare_training(common.game_rows(spark, sf))


def _fitted(prep, names=("random_forest", "logistic_regression", "xgboost")):
    from ..operators import models, search
    return search.fit_points(prep.train, FEATURE_NAMES, models.QUERY_GRIDS, names=names)


@register("model_metrics", None)
def q_model_metrics(spark, sf):
    """F6-F8, F10 + A8 per split: 100 trees, 1000 iterations, 100 boosting rounds, evaluated on val and test."""
    from . import pipeline
    prep = _prepared(spark, sf)
    return pipeline.evaluate(prep, _fitted(prep))


@register("cv_scores", None)
def q_cv_scores(spark, sf):
    """five-fold accuracy of a forest of 100 trees and a logistic model of up to 1000 iterations,
    from the ledger of the search."""
    import uuid

    from ..operators import models, search
    from ..session import ensure_checkpoint_dir
    folder = f"{ensure_checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}"
    names = ["random_forest", "logistic_regression"]
    found = search.search(_prepared(spark, sf).train, FEATURE_NAMES, folder, grids=models.QUERY_GRIDS, names=names, refit=False)
    text = F.array_join(F.transform(F.array_sort(F.map_entries("params")), lambda e: F.concat_ws("=", e["key"], e["value"])), ", ")
    return search.Ledger(spark, folder).points(found.run).select("model", "point", text.alias("params"), "cv_accuracy", "folds_done")


@register("feature_importance", None)
def q_feature_importance(spark, sf):
    """F16 + K4: top 15 features of a forest of 100 trees with rank and bar share."""
    from ..operators import models as M
    forest = _fitted(_prepared(spark, sf), ["random_forest"])["random_forest"]
    return M.feature_importance(spark, forest, FEATURE_NAMES, top_n=15)


@register("season_predictions", None)
def q_season_predictions(spark, sf):
    """Entry 2 / F10 + F13 + F15 + P6: score the last season's schedule (results unknown) with the
    stored scaler and all models; rolling means and head-to-head go on from the carried state of all earlier seasons."""
    from ..operators import carried
    from . import pipeline
    games = materialize(common.game_rows(spark, sf))
    prep = pipeline.prepare_training(games)
    coming = F.col("season").cast("string").isin(prep.seasons["test"])
    return pipeline.predict_season(games.where(coming), _fitted(prep), prep.scaler, carried.History.of(prep.ratios.where(~coming)))


@register("adhoc_matchups", None)
def q_adhoc(spark, sf):
    """F11 + F12 + F14: one request per (season, team1, team2) pair that has met, with that season's statistics."""
    from . import pipeline
    stats = joins.Lookup(common.team_stats(spark, sf))
    prep = pipeline.prepare_training(joins.games_with_stats(standins.games(spark, sf), stats.frame))
    # a game without statistics of both teams gives no request either
    pairs = prep.ratios.select("season", "team1", "team2").distinct()
    req = stats.join(pairs, joins.role_projection(stats.frame, "team1"), ["season", "team1"])
    req = stats.join(req, joins.role_projection(stats.frame, "team2"), ["season", "team2"])
    req = req.withColumn("game_id", F.xxhash64("season", "team1", "team2"))
    return pipeline.predict_matchups(req, _fitted(prep), prep.scaler)


def _analytics_sql() -> str:
    s1 = "(r1.team_efficiency + (r1.net_production - r2.production_allowed))"
    s2 = "((r2.team_efficiency + (r2.net_production - r1.production_allowed)) * CAST(1.05 AS DOUBLE))"
    return (with_ctes("games", "ratings") + _draw_sql() + f"""
  , sc AS (SELECT w.season, w.team1, w.team2, {s1} AS s1, {s2} AS s2
           FROM wx w
           JOIN ratings r1 ON r1.season = w.season AND r1."Name" = w.team1 AND r1.has_defense
           JOIN ratings r2 ON r2.season = w.season AND r2."Name" = w.team2 AND r2.has_defense)
  , res AS (SELECT season, team1 AS team,
                   CASE WHEN s1 > s2 THEN 'win' WHEN s2 > s1 THEN 'loss' ELSE 'tie' END AS result FROM sc
            UNION ALL
            SELECT season, team2 AS team,
                   CASE WHEN s2 > s1 THEN 'win' WHEN s1 > s2 THEN 'loss' ELSE 'tie' END AS result FROM sc)
  , st AS (SELECT season, team, count_if(result = 'win') AS wins, count_if(result = 'loss') AS losses,
                  count_if(result = 'tie') AS ties FROM res GROUP BY season, team)
  , conf AS (SELECT n.n_name AS team, r.r_name AS conference
             FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey)
  SELECT st.season, st.team, st.wins, st.losses, st.ties, conf.conference,
         CAST(row_number() OVER (PARTITION BY st.season, conf.conference ORDER BY st.wins DESC, st.team) AS INTEGER)
           AS conference_rank
  FROM st JOIN conf ON conf.team = st.team""")


@register("team_analytics_standings", _analytics_sql())
def q_team_analytics(spark, sf):
    """Entry 3: ratings -> weather draw (portable arithmetic uniform, so SQL
    can restate it) -> game scores (home team2 x 1.05, no streak input) ->
    results -> standings by season and conference."""
    from . import pipeline
    out = pipeline.team_analytics(standins.offense(spark, sf), standins.defense(spark, sf),
                                  standins.games(spark, sf).drop("team1_score", "team2_score"),
                                  standins.team_odds(spark, sf), standins.conferences(spark, sf),
                                  uniform=arithmetic_uniform(F.col("game_id"), seed=WEATHER_SEED))
    return out["standings"].select("season", "team", "wins", "losses", "ties", "conference", "conference_rank")


# ---------------------------------------------------------------- orders of other kinds
@register("rolling_string_order", f"""
  SELECT event_id, user_id,
         {rnd("avg(value) OVER (PARTITION BY user_id ORDER BY CAST(event_id AS VARCHAR) ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)", 6)}
           AS value_rolling_3
  FROM events""")
def q_rolling_string_order(spark, sf):
    """W1 along a text order (ids as strings sort differently from numbers)."""
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("event_id").cast("string").alias("name"), "value")
    r = windows.rolling_mean(e, ["user_id"], ["name"], {"value_rolling_3": "value"}, window=3)
    return common.round_cols(r.select("event_id", "user_id", "value_rolling_3"), ["value_rolling_3"])


@register("position_tied_ts", """
  SELECT event_id, event_type, CAST(row_number() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE), event_id) AS BIGINT) AS n
  FROM events""")
def q_position_tied(spark, sf):
    """Position with many rows per order value and a few hot keys."""
    e = table(spark, sf, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    return windows.row_position(e, ["event_type"], ["day", "event_id"], "n").select("event_id", "event_type", "n")


@register("streak_orders", """
  SELECT o_orderkey, CAST(win_streak AS BIGINT) AS win_streak,
         CAST(coalesce(lag(win_streak) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 0) AS BIGINT) AS streak_before
  FROM (SELECT *, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)
                    OVER (PARTITION BY o_custkey, island ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS win_streak
        FROM (SELECT *, sum(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END)
                          OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS island
              FROM orders) a) b""")
def q_streak_orders(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", F.when(F.col("o_orderstatus") == "F", "win").otherwise("loss").alias("result"))
    return windows.win_streak(o, team="o_custkey", order_by=["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", "win_streak", "streak_before")


# ---------------------------------------------------------------- medians with ties
@register("median_ties", """
  SELECT 'quantity' AS col, median(CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_quantity AS DOUBLE) END) AS med FROM lineitem
  UNION ALL
  SELECT 'tied', median(CASE WHEN l_linenumber <= 3 THEN 5.0 ELSE CAST(l_quantity AS DOUBLE) END) FROM lineitem
  UNION ALL
  SELECT 'tax', median(CAST(l_tax AS DOUBLE)) FROM lineitem""")
def q_median_ties(spark, sf):
    """M3 where most rows share a value, and with masked nulls."""
    q = F.col("l_quantity").cast("double")
    li = table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 7 != 0, q).alias("quantity"),
        F.when(F.col("l_linenumber") <= 3, F.lit(5.0)).otherwise(q).alias("tied"),
        F.col("l_tax").cast("double").alias("tax"))
    found = missing.exact_medians(li, ["quantity", "tied", "tax"])
    return spark.createDataFrame(list(found.items()), "col string, med double")


# ---------------------------------------------------------------- first rows of duplicated names
@register("stats_first_row", """
  SELECT a.c_nationkey AS season, a.c_mktsegment AS "Name", a.c_name AS off_first, b.c_name AS def_first
  FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS r FROM customer) a
  JOIN (SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey DESC) AS r FROM customer) b
    ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment
  WHERE a.r = 1 AND b.r = 1""")
def q_stats_first_row(spark, sf):
    """W6 + J1: duplicated names on both sides keep the first row of each side."""
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("season"), F.col("c_mktsegment").alias("Name"),
                                            F.col("c_name").alias("first"), F.col("c_custkey").alias("_pos"))
    off = joins.first_per_team(c, position="_pos")
    dfn = joins.first_per_team(c.withColumn("_pos", -F.col("_pos")), position="_pos")
    return joins.merge_team_stats(off, dfn)


# ---------------------------------------------------------------- requests scored by themselves
@register("adhoc_features", with_ctes("game_feats") + "SELECT game_id, " + ", ".join(
    f'CAST("{r}_{s}" AS DOUBLE) AS "{r}_{s}_rolling_3games"' for r in ("team1", "team2") for s in ROLLING_STEMS)
    + """, CAST(0.5 AS DOUBLE) AS head_to_head_win_pct, CAST(0.0 AS DOUBLE) AS head_to_head_avg_point_diff
  FROM game_feats""")
def q_adhoc_features(spark, sf):
    """features of requests, each from its own row only."""
    f = features.independent_features(common.game_rows(spark, sf))
    return f.select("game_id", *_ROLL_OUT, "head_to_head_win_pct", "head_to_head_avg_point_diff")


# ---------------------------------------------------------------- folds and closed-form scores
@register("cv_folds", with_ctes("games") + """
  SELECT game_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY game_id) - 1) % 5 AS INTEGER) AS fold
  FROM (SELECT game_id, CAST(team1_score > team2_score AS INTEGER) AS label FROM games) x""")
def q_cv_folds(spark, sf):
    """stratified fold of every row, whatever its key looks like."""
    from ..operators.models import add_folds
    g = standins.games(spark, sf).select("game_id", (F.col("team1_score") > F.col("team2_score")).cast("int").alias("label"))
    return add_folds(g)


_LOGIT = {"team1_points_per_game": 1e-6, "team2_points_per_game": -1e-6, "team1_yards_per_game": 2e-7}


@register("logistic_scores", with_ctes("game_feats") + f"""
  SELECT game_id, CAST(p > 0.5 AS INTEGER) AS logistic_regression_prediction, {rnd("p", 6)} AS logistic_regression_team1_win_prob,
         {rnd("greatest(p, 1 - p)", 6)} AS confidence
  FROM (SELECT game_id, 1 / (1 + exp(-(0.1 + {" + ".join(f'CAST({v!r} AS DOUBLE) * "{c}"' for c, v in _LOGIT.items())}))) AS p
        FROM game_feats) x""")
def q_logistic_scores(spark, sf):
    """F10 + F12 from fixed coefficients, through the scoring of fitted models."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    from ..operators import models as M
    names = list(_LOGIT)
    # a one-step fit gives the model object, whose numbers are then fixed
    two = spark.createDataFrame([(Vectors.dense([0.0] * 3), 0.0), (Vectors.dense([1.0] * 3), 1.0)], ["features", "label"])
    shape = LogisticRegression(maxIter=1).fit(two)
    fixed = spark._sc._gateway.new_array(spark._jvm.double, len(names))
    for k, c in enumerate(names):
        fixed[k] = _LOGIT[c]
    jvm = spark._jvm.org.apache.spark.ml
    model = type(shape)(jvm.classification.LogisticRegressionModel("fixed", jvm.linalg.Vectors.dense(fixed), 0.1))
    out = M.score(common.game_ratios(spark, sf).select("game_id", *names), {"logistic_regression": model}, names)
    p, y = F.col("logistic_regression_team1_win_prob"), F.col("logistic_regression_prediction")
    out = out.withColumn("confidence", vote.confidence(y, p))
    return common.round_cols(out.select("game_id", y.alias("logistic_regression_prediction"),
                                        p.alias("logistic_regression_team1_win_prob"), "confidence"),
                             ["logistic_regression_team1_win_prob", "confidence"])


# ---------------------------------------------------------------- teams without a game, other branches
@register("standings_all_teams", with_ctes("results") + f"""
  , st AS ({_STANDINGS_SQL})
  , names AS (SELECT n_name AS team FROM nation UNION ALL SELECT r_name FROM region)
  SELECT names.team, coalesce(wins, 0) AS wins, coalesce(losses, 0) AS losses, coalesce(ties, 0) AS ties
  FROM names LEFT JOIN st ON st.team = names.team""")
def q_standings_all(spark, sf):
    """A1 over a team list: regions play the teams that have no game."""
    names = (table(spark, sf, "nation").select(F.col("n_name").alias("team"))
             .union(table(spark, sf, "region").select("r_name")))
    return results.standings(results.results_long(standins.games(spark, sf)), teams=names)


@register("one_hot_weather", with_ctes("games") + """
  , w AS (SELECT game_id, CASE game_id % 6 WHEN 0 THEN 'Clear' WHEN 1 THEN 'rain' WHEN 2 THEN 'SNOW' WHEN 3 THEN 'Wind'
                                           WHEN 4 THEN 'Fog' END AS weather FROM games)
  SELECT game_id, CAST(coalesce(lower(weather) = 'clear', false) AS INTEGER) AS weather_clear,
         CAST(coalesce(lower(weather) = 'rain', false) AS INTEGER) AS weather_rain,
         CAST(coalesce(lower(weather) = 'snow', false) AS INTEGER) AS weather_snow,
         CAST(coalesce(lower(weather) = 'wind', false) AS INTEGER) AS weather_wind FROM w""")
def q_one_hot(spark, sf):
    """E11 with a weather column: every case, an unknown condition and nulls."""
    k = F.col("game_id") % 6
    w = F.when(k == 0, "Clear").when(k == 1, "rain").when(k == 2, "SNOW").when(k == 3, "Wind").when(k == 4, "Fog")
    g = standins.games(spark, sf).select("game_id", w.alias("weather"))
    return features.categorical_features(g).select("game_id", "weather_clear", "weather_rain", "weather_snow", "weather_wind")


@register("rest_days", with_ctes("games") + """
  SELECT game_id, CAST(game_id % 11 - game_id % 7 AS BIGINT) AS rest_days_difference FROM games""")
def q_rest_days(spark, sf):
    """E13 with both rest-day columns."""
    g = standins.games(spark, sf).select("game_id", (F.col("game_id") % 11).alias("team1_rest_days"),
                                         (F.col("game_id") % 7).alias("team2_rest_days"))
    return features.categorical_features(g).select("game_id", F.col("rest_days_difference").cast("long").alias("rest_days_difference"))


_OVERLAP_SQL = """
  , s AS (SELECT game_id, season, CASE WHEN season <= 1997 THEN 'train' WHEN season = 1998 THEN 'val' ELSE 'test' END AS split FROM games
          UNION ALL SELECT game_id, season, 'val' FROM games WHERE season = 1997
          UNION ALL SELECT game_id, season, 'test' FROM games WHERE season = 1998 AND game_id % 2 = 0)"""


def _overlapping(spark, sf):
    """A deliberately overlapping split: 1997 also in val, half of 1998 also in test."""
    g = standins.games(spark, sf).select("game_id", "season")
    base = g.withColumn("split", F.when(F.col("season") <= 1997, "train").when(F.col("season") == 1998, "val").otherwise("test"))
    return (base.union(g.where("season = 1997").withColumn("split", F.lit("val")))
            .union(g.where("season = 1998 AND game_id % 2 = 0").withColumn("split", F.lit("test"))))


@register("season_overlap_found", with_ctes("games") + _OVERLAP_SQL + """
  SELECT DISTINCT a.split AS split_a, b.split AS split_b, CAST(a.season AS VARCHAR) AS season
  FROM (SELECT DISTINCT split, season FROM s) a JOIN (SELECT DISTINCT split, season FROM s) b
    ON a.season = b.season AND (a.split, b.split) IN (('train', 'val'), ('train', 'test'), ('val', 'test'))""")
def q_season_overlap_found(spark, sf):
    """U2 over all three pairs on a split that does overlap."""
    return split.season_overlaps(_overlapping(spark, sf))


@register("leakage_found", with_ctes("games") + _OVERLAP_SQL + """
  SELECT game_id, count(DISTINCT split) AS n_splits FROM s GROUP BY game_id HAVING count(DISTINCT split) > 1""")
def q_leakage_found(spark, sf):
    """U4 on a split that does overlap."""
    return split.overlap_audit(_overlapping(spark, sf))


from . import incremental  # noqa: E402, F401 - registers its queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
