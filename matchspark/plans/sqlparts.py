"""ANSI-SQL building blocks for the oracle queries (DuckDB dialect).

The oracle re-states each operator independently in SQL over the same
parquet tables; the stand-ins of ``sources.standins`` are CTEs here.
"""

from __future__ import annotations

OFF_STATS = ["PTS", "All", "Pass", "Run", "QB", "RB", "WR", "TE"]
DEF_STATS = ["PA", "DEF", "QB", "RB", "WR", "TE"]
STAT_COLS = [f"off_{c}" for c in OFF_STATS] + [f"def_{c}" for c in DEF_STATS] + ["GP"]

M = "DECIMAL(18,2)"

CTES: dict[str, tuple[list[str], str]] = {}


def rnd(x: str, digits: int) -> str:
    """Half-even rounding with Spark's definition for doubles: the shortest
    decimal string of the double, rounded exactly, converted back."""
    return (f"CAST(CAST(round_even(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,15)), {digits}) "
            f"AS DECIMAL(38,{digits})) AS DOUBLE)")


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte("li_ord", [], f"""
  SELECT l_orderkey, min(l_suppkey) AS min_suppkey,
         sum(CAST(l_extendedprice AS {M})) AS all_price,
         sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS {M}) ELSE CAST(0 AS {M}) END) AS f_price,
         sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS {M}) ELSE CAST(0 AS {M}) END) AS o_price
  FROM lineitem GROUP BY l_orderkey""")

cte("games", ["li_ord"], f"""
  SELECT o.o_orderkey AS game_id,
         CAST(year(o.o_orderdate) AS INTEGER) AS season,
         CAST((dayofyear(o.o_orderdate) - 1) // 7 + 1 AS INTEGER) AS "week",
         n1.n_name AS team1, n2.n_name AS team2,
         CAST(li.f_price AS {M}) AS team1_score,
         CAST(li.o_price AS {M}) AS team2_score
  FROM orders o
  JOIN li_ord li ON li.l_orderkey = o.o_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n1 ON n1.n_nationkey = c.c_nationkey
  JOIN supplier s ON s.s_suppkey = li.min_suppkey
  JOIN nation n2 ON n2.n_nationkey = s.s_nationkey
  WHERE n1.n_name <> n2.n_name""")

cte("offense", ["li_ord"], f"""
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS season, n.n_name AS "Name",
         count(*) AS "GP",
         CAST(sum(CAST(o.o_totalprice AS {M})) AS DOUBLE) AS "PTS",
         CAST(sum(li.all_price) AS DOUBLE) AS "All",
         CAST(sum(li.f_price) AS DOUBLE) AS "Pass",
         CAST(sum(li.o_price) AS DOUBLE) AS "Run",
         count_if(o.o_orderpriority = '1-URGENT') AS "QB",
         count_if(o.o_orderpriority = '2-HIGH') AS "RB",
         count_if(o.o_orderpriority = '3-MEDIUM') AS "WR",
         count_if(o.o_orderpriority = '5-LOW') AS "TE"
  FROM orders o
  JOIN li_ord li ON li.l_orderkey = o.o_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  GROUP BY 1, 2""")

cte("defense_raw", [], f"""
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS season, n.n_name AS "Name",
         count(DISTINCT l.l_orderkey) AS "GP",
         CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_extendedprice AS {M}) ELSE CAST(0 AS {M}) END) AS DOUBLE) AS "PA",
         sum(CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity ELSE 0.0 END) AS d_def,
         sum(CASE WHEN l.l_linenumber = 1 THEN l.l_quantity ELSE 0.0 END) AS q1,
         sum(CASE WHEN l.l_linenumber = 2 THEN l.l_quantity ELSE 0.0 END) AS q2,
         sum(CASE WHEN l.l_linenumber = 3 THEN l.l_quantity ELSE 0.0 END) AS q3,
         sum(CASE WHEN l.l_linenumber = 4 THEN l.l_quantity ELSE 0.0 END) AS q4
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN nation n ON n.n_nationkey = s.s_nationkey
  GROUP BY 1, 2""")

cte("defense", ["defense_raw"], """
  SELECT season, "Name", "GP", "PA",
         d_def / CAST("GP" AS DOUBLE) AS "DEF",
         q1 / CAST("GP" AS DOUBLE) AS "QB",
         q2 / CAST("GP" AS DOUBLE) AS "RB",
         q3 / CAST("GP" AS DOUBLE) AS "WR",
         q4 / CAST("GP" AS DOUBLE) AS "TE"
  FROM defense_raw""")

cte("stats", ["offense", "defense"], """
  SELECT o.season, o."Name",
         """ + ", ".join(f'o."{c}" AS "off_{c}"' for c in OFF_STATS) + """,
         """ + ", ".join(f'd."{c}" AS "def_{c}"' for c in DEF_STATS) + """,
         o."GP" AS "GP"
  FROM offense o JOIN defense d ON d.season = o.season AND d."Name" = o."Name" """)


def _role_cols(alias: str, role: str) -> str:
    return ", ".join(f'{alias}."{c}" AS "{role}_{c}"' for c in STAT_COLS)


cte("game_rows", ["games", "stats"], f"""
  SELECT g.game_id, g.season, g."week", g.team1, g.team2, g.team1_score, g.team2_score,
         {_role_cols('s1', 'team1')},
         {_role_cols('s2', 'team2')}
  FROM games g
  JOIN stats s1 ON s1.season = g.season AND s1."Name" = g.team1
  JOIN stats s2 ON s2.season = g.season AND s2."Name" = g.team2""")


def ratio_sql(role: str) -> dict[str, str]:
    """E1-E10 in SQL for one role (same operation order as the Spark side)."""
    gp = f'CAST(NULLIF("{role}_GP", 0) AS DOUBLE)'

    def per(c):
        return f'CAST("{role}_{c}" AS DOUBLE) / {gp}'

    def to(c):
        x = f'(20.0 - CAST("{role}_{c}" AS DOUBLE)) / {gp}'
        return f"CASE WHEN {x} < 0 THEN 0.0 ELSE {x} END"

    return {
        f"{role}_points_per_game": per("off_PTS"),
        f"{role}_yards_per_game": per("off_All"),
        f"{role}_pass_yards_per_game": per("off_Pass"),
        f"{role}_rush_yards_per_game": per("off_Run"),
        f"{role}_offensive_efficiency": f'CAST("{role}_off_All" AS DOUBLE) / ({gp} * 65.0)',
        f"{role}_points_allowed_per_game": per("def_PA"),
        f"{role}_defensive_efficiency": f"1.0 / ({per('def_DEF')} + 1.0)",
        f"{role}_turnovers_gained": to("def_QB"),
        f"{role}_turnovers_lost": to("off_QB"),
        f"{role}_turnover_ratio": f"({to('def_QB')}) - ({to('off_QB')})",
    }


cte("game_feats", ["game_rows"], "\n  SELECT gr.*, " + ",\n         ".join(
    f'{expr} AS "{name}"' for role in ("team1", "team2") for name, expr in ratio_sql(role).items())
    + "\n  FROM game_rows gr")


def with_ctes(*names: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order) + "\n"


# ------------------------------------------------------------ results / W2 / W3
cte("results", ["games"], """
  SELECT game_id, season, "week", team1 AS team, team2 AS opponent,
         CASE WHEN team1_score > team2_score THEN 'win' WHEN team1_score < team2_score THEN 'loss' ELSE 'tie' END AS result
  FROM games
  UNION ALL
  SELECT game_id, season, "week", team2 AS team, team1 AS opponent,
         CASE WHEN team2_score > team1_score THEN 'win' WHEN team2_score < team1_score THEN 'loss' ELSE 'tie' END AS result
  FROM games""")

cte("islands", ["results"], """
  SELECT *, sum(CASE WHEN result <> 'win' THEN 1 ELSE 0 END)
              OVER (PARTITION BY team ORDER BY season, "week", game_id ROWS UNBOUNDED PRECEDING) AS island
  FROM results""")

cte("streaks", ["islands"], """
  SELECT game_id, season, "week", team, opponent, result,
         CAST(win_streak AS BIGINT) AS win_streak,
         CAST(coalesce(lag(win_streak) OVER (PARTITION BY team ORDER BY season, "week", game_id), 0) AS BIGINT) AS streak_before
  FROM (SELECT *, sum(CASE WHEN result = 'win' THEN 1 ELSE 0 END)
                    OVER (PARTITION BY team, island ORDER BY season, "week", game_id ROWS UNBOUNDED PRECEDING) AS win_streak
        FROM islands) x""")

cte("h2h_base", ["games"], """
  SELECT g.*, least(team1, team2) AS lo, greatest(team1, team2) AS hi,
         CASE WHEN team1 < team2 THEN team1_score - team2_score ELSE team2_score - team1_score END AS dlo,
         CASE WHEN (team1 < team2 AND team1_score > team2_score) OR (team2 < team1 AND team2_score > team1_score) THEN 1 ELSE 0 END AS wlo,
         CASE WHEN (team1 < team2 AND team2_score > team1_score) OR (team2 < team1 AND team1_score > team2_score) THEN 1 ELSE 0 END AS whi
  FROM games g""")

cte("h2h", ["h2h_base"], """
  SELECT game_id, season, "week", team1, team2,
         CASE WHEN n > 0 THEN CAST(CASE WHEN team1 = lo THEN swlo ELSE swhi END AS DOUBLE) / CAST(n AS DOUBLE) ELSE 0.5 END AS head_to_head_win_pct,
         CASE WHEN n > 0 THEN (CASE WHEN team1 = lo THEN CAST(sd AS DOUBLE) ELSE -CAST(sd AS DOUBLE) END) / CAST(n AS DOUBLE) ELSE 0.0 END AS head_to_head_avg_point_diff
  FROM (SELECT *, count(dlo) OVER w AS n, sum(wlo) OVER w AS swlo, sum(whi) OVER w AS swhi, sum(dlo) OVER w AS sd
        FROM h2h_base
        WINDOW w AS (PARTITION BY lo, hi ORDER BY season, "week", game_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) p""")


# ------------------------------------------------------------ ratings
def off_def_sql(defense_filter: str = "") -> str:
    where = f"WHERE {defense_filter}" if defense_filter else ""
    return f"""
  SELECT o.season, o."Name", o."GP",
         {", ".join(f'o."{c}" AS "off_{c}"' for c in OFF_STATS)},
         d."GP" AS "def_GP", {", ".join(f'd."{c}" AS "def_{c}"' for c in DEF_STATS)},
         (d."Name" IS NOT NULL) AS has_defense
  FROM offense o LEFT JOIN (SELECT * FROM defense {where}) d
    ON d.season = o.season AND d."Name" = o."Name" """


def rating_sql() -> dict[str, str]:
    def z(c):
        return f'coalesce(CAST("{c}" AS DOUBLE), 0.0)'
    plays = f'({z("off_Run")} + {z("off_Pass")})'
    eff = f'(CASE WHEN {plays} = 0 THEN NULL ELSE {z("off_All")} / {plays} END)'
    x_off = f'(CAST(0.19 AS DOUBLE) * {z("off_All")} + 12.0)'
    x_def = f'(CAST(-1.24 AS DOUBLE) * {z("def_DEF")} + 30.8)'
    net = f"({x_off} - {x_def})"
    x_wins = f"(CAST(0.418 AS DOUBLE) * {net} + 8.5)"
    allowed = " + ".join(z(f"def_{c}") for c in ("QB", "RB", "WR", "TE"))
    return {
        "plays_per_game": plays,
        "team_efficiency": eff,
        "production_allowed": f"({allowed})",
        "x_off": x_off,
        "x_def": x_def,
        "net": net,
        "x_wins": x_wins,
        "x_losses": f"(17.0 - {x_wins})",
        "expected_points_for": f'({z("off_PTS")} * {eff})',
        "net_production": rnd(f'({z("off_All")} + {z("def_DEF")} * CAST(7.06 AS DOUBLE))', 0),
    }


def rating_select(src: str) -> str:
    return ("SELECT *, " + ", ".join(f'CASE WHEN has_defense THEN {e} END AS "{n}"' for n, e in rating_sql().items())
            + f" FROM {src}")


cte("off_def", ["offense", "defense"], off_def_sql())
cte("ratings", ["off_def"], rating_select("off_def"))


# ------------------------------------------------------------ masked stats, rule models
cte("masked", ["stats"], """
  SELECT s.season, s."Name",
         CASE WHEN n.n_nationkey % 12 = 0 THEN NULL ELSE r.r_name END AS conference,
         s."GP", s."off_PTS",
         CASE WHEN s.season = 1998 AND n.n_nationkey % 2 = 1 THEN NULL ELSE s."off_Run" END AS "off_Run",
         CASE WHEN n.n_nationkey % 9 = 0 THEN NULL ELSE s."off_QB" END AS "off_QB",
         CASE WHEN n.n_nationkey % 2 = 0 THEN NULL ELSE s."def_PA" END AS "def_PA",
         s."def_DEF"
  FROM stats s JOIN nation n ON n.n_name = s."Name" JOIN region r ON r.r_regionkey = n.n_regionkey""")

cte("rule_wide", ["game_feats"], """
  SELECT game_id, season, "week", team1, team2,
         CAST(team1_score > team2_score AS INTEGER) AS y,
         CAST(team1_points_per_game > team2_points_per_game AS INTEGER) AS points_prediction,
         team1_points_per_game / (team1_points_per_game + team2_points_per_game) AS points_team1_win_prob,
         CAST(team1_yards_per_game > team2_yards_per_game AS INTEGER) AS yards_prediction,
         team1_yards_per_game / (team1_yards_per_game + team2_yards_per_game) AS yards_team1_win_prob,
         CAST(team1_points_allowed_per_game < team2_points_allowed_per_game AS INTEGER) AS defense_prediction,
         team2_points_allowed_per_game / (team1_points_allowed_per_game + team2_points_allowed_per_game) AS defense_team1_win_prob
  FROM game_feats""")

cte("rule_long", ["rule_wide"], """
  SELECT game_id, y, 'points' AS model, points_prediction AS prediction, points_team1_win_prob AS p_team1 FROM rule_wide
  UNION ALL SELECT game_id, y, 'yards', yards_prediction, yards_team1_win_prob FROM rule_wide
  UNION ALL SELECT game_id, y, 'defense', defense_prediction, defense_team1_win_prob FROM rule_wide""")


def metrics_sql(src: str, y: str = "y", pred: str = "prediction", model: str = "model") -> str:
    def r(n, d):
        return f"CASE WHEN ({d}) = 0 THEN 0.0 ELSE CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END"
    return f"""
  SELECT {model} AS model_name, tn, fp, fn, tp,
         {r('tp + tn', 'tn + fp + fn + tp')} AS accuracy,
         {r('tp', 'tp + fp')} AS "precision",
         {r('tp', 'tp + fn')} AS recall,
         {r('2 * tp', '2 * tp + fp + fn')} AS f1_score
  FROM (SELECT {model},
               count_if({y} = 0 AND {pred} = 0) AS tn, count_if({y} = 0 AND {pred} = 1) AS fp,
               count_if({y} = 1 AND {pred} = 0) AS fn, count_if({y} = 1 AND {pred} = 1) AS tp
        FROM {src} GROUP BY {model}) c"""
