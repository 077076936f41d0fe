"""Named queries over the driver's tables: ``name -> f(spark, root)``.

Each query reads whole tables under ``root`` and returns a lazy DataFrame.
Non-integer results are rounded to 6 decimals in the final projection only,
so that a SQL engine summing in another order compares equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from huddle.functions.columns import hash_bucket, safe_divide
from huddle.operators import (
    evaluate,
    history,
    kernel,
    knn,
    matchup,
    models,
    onefeature,
    player,
    regression,
    scaling,
    split,
    symmetric,
    tables,
    team_stats,
)
from huddle.plans import standins
from huddle.schemas import FEATURE_COLS, RB_ROLL_COLS
from huddle.session import materialize
from huddle.sinks.files import report_lines
from huddle.sinks.landing import new_partitions
from huddle.sources import catalog, html
from huddle.sources.files import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (output formatting for cross-engine checks)."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name)
            if f.dataType.typeName() in ("double", "float")
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# ---------------------------------------------------------------- team stats
@query("team_week_offense")
def q_team_week_offense(spark, root):
    return team_stats.offense_stats(standins.plays(spark, root), conditional_epa=True)


@query("team_week_defense")
def q_team_week_defense(spark, root):
    return team_stats.defense_stats(standins.plays(spark, root))


@query("team_week_stats")
def q_team_week_stats(spark, root):
    return team_stats.team_week_stats(standins.plays(spark, root))


@query("single_team_week")
def q_single_team_week(spark, root):
    return team_stats.single_team_week_stats(standins.plays(spark, root), "7")


@query("schedule_distinct")
def q_schedule_distinct(spark, root):
    plays = standins.plays(spark, root).filter(F.col("home_team") != F.col("away_team"))
    return team_stats.schedule_rows(
        plays, ("season", "week", "game_id", "home_team", "away_team")
    )


@query("games")
def q_games(spark, root):
    return standins.games(standins.plays(spark, root))


# ------------------------------------------------------------------ history


def _pairs(spark, root):
    """Plays rolled up to (season, week, offence, defence) -- one scan of the
    plays -- and checkpointed: every branch of a pipeline reads this small
    table instead of scanning the plays again."""
    return materialize(team_stats.pair_week_stats(standins.plays(spark, root)), "pairs")


def _tws(spark, root, pairs=None):
    return team_stats.team_week_from_pairs(pairs if pairs is not None else _pairs(spark, root))


@query("prior_season_means")
def q_prior_season_means(spark, root):
    return rounded(history.prior_season_means(_tws(spark, root)))


@query("prior_season_means_lag1")
def q_prior_season_means_lag1(spark, root):
    return rounded(history.prior_season_means(_tws(spark, root), lag=1))


@query("expanding_prior_mean")
def q_expanding_prior_mean(spark, root):
    rolled = history.expanding_mean_before(_tws(spark, root), FEATURE_COLS)
    return rounded(rolled.select("season", "week", "team", *[f"rolling_{f}" for f in FEATURE_COLS]))


def _blended(spark, root, **kw):
    tws = _tws(spark, root)
    return history.blend_with_prior(tws, history.prior_season_means(tws), **kw)


@query("blended_features")
def q_blended_features(spark, root):
    return rounded(_blended(spark, root))


@query("blended_features_prior_fill")
def q_blended_features_prior_fill(spark, root):
    return rounded(_blended(spark, root, prior_only_when_no_history=True))


def _matchups(spark, root):
    pairs = _pairs(spark, root)
    tws = _tws(spark, root, pairs)
    blended = history.blend_with_prior(tws, history.prior_season_means(tws))
    return matchup.matchup_dataset(standins.games_from_pairs(pairs), blended)


@query("matchup_dataset")
def q_matchup_dataset(spark, root):
    return rounded(_matchups(spark, root))


# --------------------------------------------------------------- evaluation


def _lines(spark, root):
    return standins.game_lines(standins.games_from_pairs(_pairs(spark, root)))


def _evaluated(spark, root):
    lines = _lines(spark, root)
    preds = lines.select(
        "season", "week", "home_team", "away_team", "actual_spread", "predicted_spread",
        (F.col("predicted_spread") - F.col("actual_spread")).alias("prediction_error"),
    )
    games = lines.select("season", "week", "home_team", "away_team", "spread_line")
    return evaluate.evaluate_against_line(preds, games)


@query("line_evaluation")
def q_line_evaluation(spark, root):
    return _evaluated(spark, root)


@query("line_accuracy")
def q_line_accuracy(spark, root):
    return rounded(evaluate.accuracy_summary(_evaluated(spark, root)))


@query("regression_metrics")
def q_regression_metrics(spark, root):
    m = evaluate.regression_metrics(_lines(spark, root), "actual_spread", ["predicted_spread", "spread_line"])
    return rounded(m)


# ----------------------------------------------------------- player history
@query("rolling_player_features")
def q_rolling_player_features(spark, root):
    days = standins.player_days(spark, root)
    return rounded(player.rolling_player_features(days, window=3, position=None))


@query("rolling_means_all")
def q_rolling_means_all(spark, root):
    """The lag-3 rolling means on every player-day (no history filter)."""
    days = standins.player_days(spark, root)
    days = days.withColumn("yards_per_carry", safe_divide("rushing_yards", "carries")).withColumn(
        "yards_per_reception", safe_divide("receiving_yards", "receptions"))
    return rounded(history.rolling_mean_before(days, RB_ROLL_COLS, ("player_id",), ("season", "week"), 3))


@query("lag_one")
def q_lag_one(spark, root):
    ev = read_table(spark, root, "events").select("event_id", "user_id", "ts", "event_type", "value")
    return history.lag_by_time_chunks(ev, ["value", "event_type"], "user_id", "ts", "event_id")


# ------------------------------------------------------- scaling and splits
CONTINUOUS = ["week_number", *[f"{f}_delta" for f in FEATURE_COLS]]


@query("standardised_features")
def q_standardised_features(spark, root):
    # fit and transform both read the matchup plan; it starts from the
    # materialised pair rollup, so recomputing it is cheap
    m = _matchups(spark, root).select(
        "season", "game_id", *CONTINUOUS, "is_early_season",
        F.col("is_division_game").cast("int").alias("is_division_game"), "actual_spread",
    )
    return rounded(scaling.standardise(m, CONTINUOUS))


@query("split_buckets")
def q_split_buckets(spark, root):
    o = read_table(spark, root, "orders").select("o_orderkey")
    return o.select("o_orderkey", hash_bucket("o_orderkey", 100).alias("bucket"),
                    split.split_label("o_orderkey", 20).alias("split"))


@query("fold_buckets")
def q_fold_buckets(spark, root):
    o = split.with_folds(read_table(spark, root, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 5)
    return rounded(o.groupBy("fold").agg(
        F.count("*").alias("n_orders"), F.min("o_orderkey").alias("min_key"),
        F.max("o_orderkey").alias("max_key"), F.sum("o_totalprice").alias("total_price"),
    ))


@query("season_split")
def q_season_split(spark, root):
    """Per season: its role with the last season held out.  Aggregated per
    season first, so the comparison with the last season runs on one row
    per season (a window over that tiny table, not over the games)."""
    per_season = _matchups(spark, root).groupBy("season").agg(
        F.count("*").alias("n_games"), F.sum("actual_spread").alias("sum_spread"))
    last = F.max("season").over(Window.partitionBy())
    return per_season.select("season", split.season_split_label(last).alias("split"), "n_games", "sum_spread")


# ------------------------------------------------ positions, lookups, pivot

# Market segments of the driver's customer table (fixed values).
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _position_rows(spark, root):
    o = read_table(spark, root, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = read_table(spark, root, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    n = read_table(spark, root, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = o.join(c, "o_custkey").join(n, "c_nationkey")
    return rows.select(
        F.col("n_name").alias("Tm"), F.year("o_orderdate").cast("int").alias("Season"),
        F.col("c_mktsegment").alias("position"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )


@query("position_pivot")
def q_position_pivot(spark, root):
    return rounded(tables.pivot_positions(_position_rows(spark, root), ["Tm", "Season"], "position", "cents", SEGMENTS, agg="avg"))


@query("position_full_outer")
def q_position_full_outer(spark, root):
    """One table per position, merged by a full outer merge (as pages per
    position would arrive).  The orders are aggregated once per (team,
    season, position) into a small table that the per-position frames
    split; filtering the raw rows per position would scan them once per
    position."""
    long = materialize(
        _position_rows(spark, root).groupBy("Tm", "Season", "position").agg(F.avg("cents").alias("value")),
        "positions")
    frames = [long.filter(F.col("position") == seg).select("Tm", "Season", F.col("value").alias(seg)) for seg in SEGMENTS]
    return rounded(tables.full_outer_merge(frames, ["Tm", "Season"]))


@query("opponent_lookup")
def q_opponent_lookup(spark, root):
    defense = tables.pivot_positions(_position_rows(spark, root), ["Tm", "Season"], "position", "cents", SEGMENTS, agg="avg")
    nation = read_table(spark, root, "nation")
    names = nation.filter(F.col("n_regionkey") < 4).select(
        F.col("n_name").alias("name"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("abbr"))
    defense = player.map_values(defense, "Tm", names)
    o = read_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, root, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    players = o.join(c, "o_custkey").select(
        "o_orderkey", F.year("o_orderdate").cast("int").alias("season"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("opponent_team"))
    out = player.lookup_first(players, defense, ["opponent_team", "season"], ["Tm", "Season"], "BUILDING", "BUILDING_allowed")
    return rounded(out)


# --------------------------------------------------- closed-form regressors
def _xy(spark, root):
    li = read_table(spark, root, "lineitem")
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])
    return li.select(
        "l_suppkey",
        key.alias("key"),
        F.round("l_quantity").cast("bigint").alias("x"),
        F.round(F.col("l_extendedprice") / 1000).cast("bigint").alias("y"),
        split.split_label(key, 20).alias("split"),
    )


def _fit(kinds):
    def run(spark, root):
        train = _xy(spark, root).filter(F.col("split") == "train")
        return rounded(regression.fit_closed_form(train, "x", "y", kinds))
    return run


query("linear_fit")(_fit(["lr"]))
query("lasso_fit")(_fit(["lasso"]))
query("ridge_fit")(_fit(["ridge"]))
query("elastic_net_fit")(_fit(["en"]))

# closed-form regressors in the order of the original comparison table
REGRESSORS = ["lr", "en", "lasso", "ridge"]


def _regressor_mse(spark, root):
    """Fit on the train split (one aggregate; coefficients come back to the
    driver as a model would), score the test split with literal
    coefficients in one pass, MSE per regressor in one aggregate."""
    xy = _xy(spark, root)
    train, test = xy.filter(F.col("split") == "train"), xy.filter(F.col("split") == "test")
    models = regression.fit_models(train, "x", "y", REGRESSORS)
    preds = [F.struct(F.lit(k).alias("regressor"), models[k].predict(F.col("x")).alias("p")) for k in REGRESSORS]
    long = test.select(F.col("y").cast("double").alias("y"), F.inline(F.array(*preds)))
    err = F.col("p") - F.col("y")
    return long.groupBy("regressor").agg(F.count(err).alias("n"), F.avg(err * err).alias("mse"))


@query("regressor_mse")
def q_regressor_mse(spark, root):
    return rounded(_regressor_mse(spark, root))


@query("per_group_fit")
def q_per_group_fit(spark, root):
    return rounded(regression.fit_closed_form(_xy(spark, root), "x", "y", ["lr", "ridge"], group_by=["l_suppkey"]))


@query("fixed_width_report")
def q_fixed_width_report(spark, root):
    mse = _regressor_mse(spark, root).withColumn(
        "pos", F.array_position(F.array(*[F.lit(r) for r in REGRESSORS]), F.col("regressor")))
    return report_lines(mse, "regressor", "mse", "pos")


@query("top_n_importance")
def q_top_n_importance(spark, root):
    part = read_table(spark, root, "part").select("p_brand", F.round(F.col("p_retailprice") * 100).cast("bigint").alias("cents"))
    per = part.groupBy(F.col("p_brand").alias("feature")).agg(F.sum("cents").alias("cents"))
    # the total comes from the grouped table (one row per feature), so the
    # parts are scanned once
    total = F.sum("cents").over(Window.partitionBy())
    share = per.select("feature", (F.col("cents").cast("double") / total.cast("double")).alias("importance"))
    return rounded(tables.top_n(share, "importance", 15, tie_break=["feature"]))


# ------------------------------------------------ catalogue, landing, html
@query("column_catalog")
def q_column_catalog(spark, root):
    return catalog.column_profile(read_table(spark, root, "lineitem"))


def _day_key(c):
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


@query("landed_anti_join")
def q_landed_anti_join(spark, root):
    incoming = read_table(spark, root, "orders").select("o_orderkey", "o_totalprice", _day_key("o_orderdate").alias("day"))
    landed = read_table(spark, root, "lineitem").select(_day_key("l_shipdate").alias("day"))
    return new_partitions(incoming, landed, ["day"])


@query("html_rows")
def q_html_rows(spark, root):
    pages = read_table(spark, root, "pages").select("page_id", "html")
    rows = html.body_rows(pages, container="ul", row_tag="li", cell_tags="a")
    return rows.select("page_id", "row_index", F.size("cells").alias("n_cells"), F.array_join("cells", "|").alias("text"))


# ---------------------------------------------------------------------- knn


@query("knn_fit")
def q_knn_fit(spark, root):
    part = read_table(spark, root, "part").select(
        "p_partkey", F.col("p_size").alias("x"), F.round(F.col("p_retailprice") * 100).cast("bigint").alias("y"),
        split.split_label("p_partkey", 20).alias("split"))
    labelled = part.withColumn("is_test", F.col("split") == "test")
    pred = knn.knn_regress_split(labelled, "x", "y", "p_partkey", "is_test", k=5)
    return rounded(pred.withColumn("actual", F.col("actual").cast("bigint")))


# ------------------------------------------------------------------- models


def _prepared(spark, root):
    # prepare_features writes its per-game input once; the last season is
    # read from that copy
    prep = models.prepare_features(_matchups(spark, root))
    last = prep.frame.agg(F.max("season")).first()[0]
    return prep, last


@query("gbt_predictions")
def q_gbt_predictions(spark, root, grid=models.SMALL_GRID):
    prep, last = _prepared(spark, root)
    _, scored = models.train_and_score(prep, last, grid=grid)
    return evaluate.predictions_with_keys(scored, label="label", prediction="prediction")


@query("cv_scores")
def q_cv_scores(spark, root, grid=models.SMALL_GRID):
    prep, last = _prepared(spark, root)
    train, _ = split.season_split(prep.frame, last)
    _, scores = models.cross_validate(train, prep.feature_names, grid, folds=5)
    return scores


@query("feature_importance")
def q_feature_importance(spark, root, grid=models.SMALL_GRID):
    prep, last = _prepared(spark, root)
    model, _ = models.train_and_score(prep, last, grid=grid)
    return tables.top_n(models.importances(model, spark), "importance", 15, tie_break=["feature"])


@query("bayesian_ridge_fit")
def q_bayesian_ridge_fit(spark, root):
    train = _xy(spark, root).filter(F.col("split") == "train")
    m = regression.fit_bayesian_ridge(train, "x", "y")
    return rounded(spark.createDataFrame([(m.name, m.slope, m.intercept)], "model string, slope double, intercept double"))


def _split_xy(spark, root, write=False):
    """Train and test rows; written once for those who read them often."""
    xy = _xy(spark, root).select("key", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "split")
    xy = materialize(xy, "split-rows") if write else xy
    return xy.filter(F.col("split") == "train"), xy.filter(F.col("split") == "test")


@query("exact_tree_fit")
def q_exact_tree_fit(spark, root):
    """Per distinct test value: the predictions of the tree grown to the end and of one of two levels."""
    train, test = _split_xy(spark, root)
    points = materialize(test.groupBy("x").agg(F.count("*").alias("n")), "tree-points")
    full = onefeature.predict_cells(points, onefeature.mean_cells(train, "x", "y")).withColumnRenamed("prediction", "full_tree")
    two = onefeature.boost(train, "x", "y", rounds=1, rate=1.0, depth=2).predict(points).withColumnRenamed("prediction", "two_levels")
    return rounded(points.join(full, "x").join(two, "x"))


@query("tree_regressor_mse")
def q_tree_regressor_mse(spark, root, sizes=onefeature.SIZES):
    train, test = _split_xy(spark, root)
    points = materialize(test.select("x").distinct(), "tree-points")
    return onefeature.score(onefeature.tree_predictions(train, points, "x", "y", sizes), test, "x", "y").select("regressor", "mse")


# all regressors, in the order of the original comparison table
COMPARED = ["lr", "dtr", "rfr", "svr", "knn", "gbr", "xgbr", "catbr", "en", "lasso", "ridge", "bayesianridge", "adaboost"]


def _comparison(spark, root, sizes=onefeature.SIZES):
    """(regressor, n, mse) of every regressor, from its predictions at the distinct test values."""
    train, test = _split_xy(spark, root, write=True)
    points = materialize(test.select("x").distinct(), "tree-points")
    found = onefeature.tree_predictions(train, points, "x", "y", sizes)
    whole = train.withColumn("x", F.col("x").cast("long")).withColumn("y", F.col("y").cast("long"))
    linear = regression.fit_models(whole, "x", "y", REGRESSORS) | {"bayesianridge": regression.fit_bayesian_ridge(whole, "x", "y")}
    lines = F.array(*[F.struct(F.lit(k).alias("regressor"), m.predict(F.col("x")).alias("prediction")) for k, m in linear.items()])
    found = found.unionByName(points.select("x", F.inline(lines)))
    near = knn.knn_regress(train, points.withColumn("key", F.concat(F.lit("point "), F.col("x").cast("string"))), "x", "y", "key", k=5)
    found = found.unionByName(near.select(F.lit("knn").alias("regressor"), "x", "prediction"))
    vectors = kernel.fit_svr(train, ["x"], "y").predict(points, ["x"])
    ordered = symmetric.ordered_boost(train, "x", "y", "key").predict(points)
    for name, frame in (("svr", vectors), ("catbr", ordered)):
        found = found.unionByName(frame.select(F.lit(name).alias("regressor"), "x", "prediction"))
    return onefeature.score(found, test, "x", "y")


@query("regressor_comparison")
def q_regressor_comparison(spark, root, sizes=onefeature.SIZES):
    return rounded(_comparison(spark, root, sizes))


@query("regressor_report")
def q_regressor_report(spark, root, sizes=onefeature.SIZES):
    place = F.array_position(F.array(*[F.lit(r) for r in COMPARED]), F.col("regressor"))
    return report_lines(_comparison(spark, root, sizes).withColumn("pos", place), "regressor", "mse", "pos")


@query("blend_trace")
def q_blend_trace(spark, root):
    tws = _tws(spark, root)
    return rounded(history.blend_trace(tws, history.prior_season_means(tws), "7", (1, 2, 3)))


@query("rolling_event_values")
def q_rolling_event_values(spark, root):
    """Mean of each user's previous 3 event values over the raw events
    (skew-safe: windows per user and hour, completed from a halo)."""
    ev = read_table(spark, root, "events").select("event_id", "user_id", "ts", "value")
    return rounded(history.rolling_mean_by_time_chunks(ev, ["value"], "user_id", "ts", "event_id", window=3))
