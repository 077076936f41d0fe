"""Stand-ins built from the driver's TPC-H-like tables.

The driver ships no play-by-play data, so the pipelines run on rows derived
from its tables with integer-valued measures (sums stay exact in any order,
which keeps the SQL oracle comparison exact):

* a *play* is a lineitem: its supplier's nation has the ball (``posteam``),
  its customer's nation defends (``defteam``); season = order year,
  week = order month; yards are its quantity, the score after the play is
  its price in hundreds, epa is its discount in percent minus 5;
* a *game* is every pair of nations that met in a (season, week); the
  lexically smaller team is at home; each side scores the quantity it
  moved against the other;
* a *player-week* is a (user, day) of ``events``: season = year, week =
  day of the year.

Every builder reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddle.sources.files import read_table


def plays(spark: SparkSession, root: str) -> DataFrame:
    li = read_table(spark, root, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linestatus",
    )
    orders = read_table(spark, root, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"
    )
    customers = read_table(spark, root, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    suppliers = read_table(spark, root, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    # Join order for scale: orders meet their customers first (an
    # orders-sized join), so the lineitem-sized rows are shuffled at most
    # twice (by order key, then by supplier key) instead of three times.
    # AQE turns any side that proves small at run time into a broadcast.
    orders_c = orders.join(customers, "o_custkey")
    rows = li.join(orders_c, "l_orderkey").join(suppliers, "l_suppkey")

    qty = F.round("l_quantity").cast("bigint")
    score = F.round(F.col("l_extendedprice") / 100).cast("bigint")
    disc = F.round(F.col("l_discount") * 100).cast("bigint")
    offense = F.col("s_nationkey").cast("string")
    defense = F.col("c_nationkey").cast("string")
    status, flag = F.col("l_linestatus"), F.col("l_returnflag")
    season = F.year("o_orderdate").cast("int")
    week = F.month("o_orderdate").cast("int")
    home = F.least(offense, defense)
    away = F.greatest(offense, defense)
    return rows.select(
        season.alias("season"),
        week.alias("week"),
        F.concat_ws("_", season.cast("string"), week.cast("string"), home, away).alias("game_id"),
        home.alias("home_team"),
        away.alias("away_team"),
        offense.alias("posteam"),
        defense.alias("defteam"),
        score.cast("double").alias("posteam_score_post"),
        (disc - 5).cast("double").alias("epa"),
        (status == "O").cast("double").alias("rush_attempt"),
        (status == "F").cast("double").alias("pass_attempt"),
        F.when(status == "F", qty).cast("double").alias("passing_yards"),
        F.when(status == "O", qty).cast("double").alias("rushing_yards"),
        (flag == "R").cast("double").alias("interception"),
        ((flag == "A") & (status == "F")).cast("double").alias("fumble_lost"),
        qty.alias("_qty"),
    )


def games(plays_df: DataFrame) -> DataFrame:
    """One row per game with integer scores (quantity moved by each side).
    A game needs two sides: a nation's plays against itself make none."""
    plays_df = plays_df.filter(F.col("home_team") != F.col("away_team"))
    on_home = F.col("posteam") == F.col("home_team")
    return plays_df.groupBy("season", "week", "game_id", "home_team", "away_team").agg(
        F.coalesce(F.sum(F.when(on_home, F.col("_qty"))), F.lit(0)).cast("int").alias("home_score"),
        F.coalesce(F.sum(F.when(~on_home, F.col("_qty"))), F.lit(0)).cast("int").alias("away_score"),
    )


def game_lines(games_df: DataFrame) -> DataFrame:
    """Deterministic integer line and prediction per game, chosen so that a
    zero line, a zero prediction and equal errors all occur."""
    h, a = F.col("home_score"), F.col("away_score")
    return games_df.select(
        "season", "week", "game_id", "home_team", "away_team",
        (h - a).alias("actual_spread"),
        (((h * 7 + a * 3) % 15) - 7).cast("double").alias("spread_line"),
        (((h * 3 + a * 5) % 21) - 10).cast("double").alias("predicted_spread"),
    )


def player_days(spark: SparkSession, root: str) -> DataFrame:
    """events per (user, day) shaped like weekly player statistics.

    Counts of event types stand for carries/receptions/..., integer cents of
    their values for yards; ``fantasy_points_ppr`` is the cents of all events.
    """
    ev = read_table(spark, root, "events").select("user_id", "ts", "event_type", "value")
    cents = F.round(F.col("value") * 100).cast("bigint")
    t = F.col("event_type")

    def n(kind):
        return F.count_if(t == kind).cast("int")

    def s(kind):
        return F.coalesce(F.sum(F.when(t == kind, cents)), F.lit(0)).cast("double")

    return ev.groupBy(
        F.col("user_id").cast("string").alias("player_id"),
        F.year("ts").cast("int").alias("season"),
        F.dayofyear("ts").cast("int").alias("week"),
    ).agg(
        n("purchase").alias("carries"),
        s("purchase").alias("rushing_yards"),
        n("signup").alias("rushing_tds"),
        n("error").cast("double").alias("rushing_fumbles"),
        n("click").alias("receptions"),
        n("view").alias("targets"),
        s("click").alias("receiving_yards"),
        (n("click") + n("purchase")).alias("receiving_tds"),
        s("error").alias("receiving_fumbles"),
        F.coalesce(F.sum(cents), F.lit(0)).cast("double").alias("fantasy_points_ppr"),
    )


def games_from_pairs(pairs: DataFrame) -> DataFrame:
    """:func:`games` computed from pair-level rows (yards moved by each side
    are the sums of its passing and rushing yards)."""
    p = pairs.filter(F.col("defteam") != F.col("posteam"))
    home = F.least("posteam", "defteam")
    away = F.greatest("posteam", "defteam")
    yards = F.coalesce(F.col("passing_yards"), F.lit(0.0)) + F.coalesce(F.col("rushing_yards"), F.lit(0.0))
    on_home = F.col("posteam") == F.col("home_team")
    g = p.select("season", "week", home.alias("home_team"), away.alias("away_team"), "posteam", yards.alias("_yards"))
    return g.groupBy("season", "week", "home_team", "away_team").agg(
        F.coalesce(F.sum(F.when(on_home, F.col("_yards"))), F.lit(0.0)).cast("int").alias("home_score"),
        F.coalesce(F.sum(F.when(~on_home, F.col("_yards"))), F.lit(0.0)).cast("int").alias("away_score"),
    ).select(
        "season", "week",
        F.concat_ws("_", F.col("season").cast("string"), F.col("week").cast("string"), "home_team", "away_team").alias("game_id"),
        "home_team", "away_team", "home_score", "away_score",
    )
