"""Matchup tables derived from the TPC-H-style test tables.

The scale data has no games or team statistics, so these frames play their

* ``games``   — one row per order: ``game_id`` = order key, ``season`` =
  order year, ``week`` = 7-day block of the year, ``team1`` = customer's
  nation, ``team2`` = nation of the order's lowest supplier key, scores =
  exact decimal sums of line prices with status F / O; self-pairs dropped.
* ``offense`` — per (season, customer nation): GP = orders, PTS = total
  price, All / Pass / Run = line prices all / F / O, QB / RB / WR / TE =
  orders of priority 1 / 2 / 3 / 5.
* ``defense`` — per (season, supplier nation): GP = distinct orders,
  PA = price of returned lines, DEF = returned quantity / GP,
  QB / RB / WR / TE = quantity of line numbers 1-4 / GP.

Money is summed as integer cents in LONG (exact, order-independent, and
unlike wide DECIMAL sums it stays on primitive arithmetic in generated
code) and only then turned into DECIMAL(18,2) or DOUBLE, so every engine
gets bit-identical statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_if_small, size_estimate
from .tables import table

MONEY = "decimal(18,2)"


def _cents(c: str):
    """Exact cents of a 2-decimal money value held as DOUBLE."""
    return F.round(F.col(c) * 100).cast("long")


def cents_to_money(c):
    return (c.cast("decimal(20,0)") / F.lit(100)).cast(MONEY)


def cents_to_double(c):
    return c.cast("double") / F.lit(100.0)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: lowest supplier key and exact price sums (all, F, O).

    A partial aggregate on ``l_orderkey``: lineitem is shuffled once, already
    reduced map-side.
    """
    li = table(spark, sf_dir, "lineitem")
    zero = F.lit(0).cast("long")
    return li.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("min_suppkey"),
        F.sum(_cents("l_extendedprice")).alias("all_cents"),
        F.sum(F.when(F.col("l_linestatus") == "F", _cents("l_extendedprice")).otherwise(zero)).alias("f_cents"),
        F.sum(F.when(F.col("l_linestatus") == "O", _cents("l_extendedprice")).otherwise(zero)).alias("o_cents"),
    )


#: Bytes of the tables, as the optimizer estimates the columns read, that one task of a join by order is to sort and group.
ORDER_BYTES = 16 << 20


def order_parts(lines: DataFrame) -> int:
    """Tasks of a join by order: they follow the lines, so that what one of them holds does not.
    Beyond one they are the session's shuffle partitions or more, never fewer than a plain join has."""
    parts = -(-size_estimate(lines) // ORDER_BYTES)
    return max(parts, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))) if parts > 1 else 1


def _season_week(ts):
    return (F.year(ts).cast("int"),
            (F.floor((F.dayofyear(ts) - 1) / 7) + 1).cast("int"))


def derive_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule with known results: game_id, season, week, team1, team2,
    team1_score, team2_score (DECIMAL(18,2))."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n1 = broadcast_if_small(table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("team1")))
    n2 = broadcast_if_small(table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("team2")))
    lines = order_lines(spark, sf_dir)
    season, week = _season_week(F.col("o_orderdate"))
    g = (o.join(lines, o.o_orderkey == lines.l_orderkey)
         .join(c, o.o_custkey == c.c_custkey)
         .join(n1, "c_nationkey")
         .join(s, lines.min_suppkey == s.s_suppkey)
         .join(n2, "s_nationkey")
         .where(F.col("team1") != F.col("team2")))
    return g.select(
        F.col("o_orderkey").alias("game_id"),
        season.alias("season"),
        week.alias("week"),
        "team1", "team2",
        cents_to_money(F.col("f_cents")).alias("team1_score"),
        cents_to_money(F.col("o_cents")).alias("team2_score"),
    )


def derive_offense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offense statistics per (season, Name)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                              "o_totalprice", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = broadcast_if_small(table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("Name")))
    lines = order_lines(spark, sf_dir).select("l_orderkey", "all_cents", "f_cents", "o_cents")
    season, _ = _season_week(F.col("o_orderdate"))
    j = (o.join(lines, o.o_orderkey == lines.l_orderkey)
         .join(c, o.o_custkey == c.c_custkey)
         .join(n, "c_nationkey")
         .withColumn("season", season))
    pr = F.col("o_orderpriority")
    return j.groupBy("season", "Name").agg(
        F.count(F.lit(1)).alias("GP"),
        cents_to_double(F.sum(_cents("o_totalprice"))).alias("PTS"),
        cents_to_double(F.sum("all_cents")).alias("All"),
        cents_to_double(F.sum("f_cents")).alias("Pass"),
        cents_to_double(F.sum("o_cents")).alias("Run"),
        F.count_if(pr == "1-URGENT").alias("QB"),
        F.count_if(pr == "2-HIGH").alias("RB"),
        F.count_if(pr == "3-MEDIUM").alias("WR"),
        F.count_if(pr == "5-LOW").alias("TE"),
    )


def derive_defense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defense statistics per (season, Name) of the supplying nation."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    parts = order_parts(li)
    if parts > 1:
        li, o = li.repartition(parts, "l_orderkey"), o.repartition(parts, "o_orderkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = broadcast_if_small(table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("Name")))
    season, _ = _season_week(F.col("o_orderdate"))
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(s, li.l_suppkey == s.s_suppkey)
         .join(n, "s_nationkey")
         .withColumn("season", season))
    ret = F.col("l_returnflag") == "R"
    qty = F.col("l_quantity")
    ln = F.col("l_linenumber")
    # distinct orders as two plain aggregates (per order, then per team)
    # instead of an Expand-based count(DISTINCT): both levels combine map-side.
    per_order = j.groupBy("season", "Name", "l_orderkey").agg(
        F.sum(F.when(ret, _cents("l_extendedprice")).otherwise(F.lit(0).cast("long"))).alias("__pa"),
        F.sum(F.when(ret, qty).otherwise(F.lit(0.0))).alias("__def"),
        *[F.sum(F.when(ln == k, qty).otherwise(F.lit(0.0))).alias(f"__q{k}") for k in (1, 2, 3, 4)],
    )
    agg = per_order.groupBy("season", "Name").agg(
        F.count(F.lit(1)).alias("GP"),
        cents_to_double(F.sum("__pa")).alias("PA"),
        F.sum("__def").alias("__def"),
        *[F.sum(f"__q{k}").alias(f"__q{k}") for k in (1, 2, 3, 4)],
    )
    gp = F.col("GP").cast("double")
    return agg.select(
        "season", "Name", "GP", "PA",
        (F.col("__def") / gp).alias("DEF"),
        (F.col("__q1") / gp).alias("QB"),
        (F.col("__q2") / gp).alias("RB"),
        (F.col("__q3") / gp).alias("WR"),
        (F.col("__q4") / gp).alias("TE"),
    )


games, offense, defense = derive_games, derive_offense, derive_defense


def conferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(team, conference): the region name of each nation (25 rows, fixed)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(broadcast_if_small(r), n.n_regionkey == r.r_regionkey)
            .select(F.col("n_name").alias("team"), F.col("r_name").alias("conference")))


# Invented odds (Clear / Rain / Snow / Wind per region); the region
# MIDDLE EAST is deliberately absent to exercise the default.
REGION_WEATHER = {
    "AFRICA": (0.82, 0.11, 0.01, 0.06),
    "AMERICA": (0.44, 0.27, 0.16, 0.13),
    "ASIA": (0.53, 0.36, 0.03, 0.08),
    "EUROPE": (0.38, 0.33, 0.17, 0.12),
}


def weather_odds_table(spark: SparkSession, odds: dict) -> DataFrame:
    """Long odds table ``(home_team, condition, p)`` from a per-team dict."""
    from ..functions.constants import WEATHER_CONDITIONS
    rows = [(team, cond, float(p)) for team, ps in odds.items()
            for cond, p in zip(WEATHER_CONDITIONS, ps)]
    return spark.createDataFrame(rows, "home_team string, condition string, p double")


def team_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odds per nation from its region (MIDDLE EAST nations get none)."""
    conf = conferences(spark, sf_dir)
    reg = weather_odds_table(spark, REGION_WEATHER).withColumnRenamed("home_team", "conference")
    return (conf.join(broadcast_if_small(reg), "conference")
            .select(F.col("team").alias("home_team"), "condition", "p"))
