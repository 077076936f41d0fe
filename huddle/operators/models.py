"""Model operators: feature preparation, boosted trees with a season hold-out,
grid search on hash folds, importances.

The learner is ``boosting``: missing values stay missing, columns are drawn
once per tree, importances are mean gains.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huddle.functions.columns import hash_bucket
from huddle.operators import boosting, scaling, split
from huddle.schemas import FEATURE_COLS
from huddle.session import materialize, shared_path

KEY_COLS = ["season", "week", "game_id", "home_team", "away_team"]
BINARY_COLS = ["is_division_game", "is_early_season"]
CONTINUOUS_COLS = ["week_number", *[f"{f}_delta" for f in FEATURE_COLS]]

# Search space of the boosted-tree grid (fixed values): 3^5 = 243 settings.
FULL_GRID = {
    "n_estimators": [100, 300, 500],
    "learning_rate": [0.01, 0.05, 0.1],
    "max_depth": [4, 6, 8],
    "subsample": [0.7, 0.8, 1.0],
    "colsample_bytree": [0.7, 0.8, 1.0],
}
# Default grid: small enough to run anywhere; pass FULL_GRID to search all.
SMALL_GRID = {
    "n_estimators": [100, 300],
    "learning_rate": [0.05],
    "max_depth": [4, 6],
    "subsample": [1.0],
    "colsample_bytree": [1.0],
}


@dataclass
class Prepared:
    frame: DataFrame
    feature_names: list[str]
    scaler: scaling.ScalerModel


def prepare_features(
    matchups: DataFrame,
    label: str = "actual_spread",
    continuous: Sequence[str] = CONTINUOUS_COLS,
    binary: Sequence[str] = BINARY_COLS,
    fit_on: str = "all",
    test_season: int | None = None,
) -> Prepared:
    """Keys, ``label`` and the feature columns.

    Continuous columns are standardised with population statistics (fitted
    on all rows by default, or on the training seasons with
    ``fit_on='train'``); binary flags become 0/1.  A missing value stays
    null: the learner sends it to the side of a split that gains more.
    """
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be 'all' or 'train', not {fit_on!r}")
    if fit_on == "train" and test_season is None:
        raise ValueError("fit_on='train' needs a test_season")
    # one row per game: written once, then read by the scaler fit, the
    # transform and the learner
    df = materialize(matchups.select(
        *[c for c in KEY_COLS if c in matchups.columns],
        *continuous,
        *[F.col(b).cast("int").alias(b) for b in binary],
        F.col(label).cast("double").alias("label"),
    ), "model-input")
    fit_frame = df if fit_on == "all" else df.filter(F.col("season") < test_season)
    scaler = scaling.fit_scaler(fit_frame, continuous)
    return Prepared(scaler.transform(df), [*continuous, *binary], scaler)


def _store(train: DataFrame, names: Sequence[str], folds: int) -> str:
    """The folder of finished search scores for exactly these rows."""
    mark = train.agg(F.count("*"), F.sum(F.xxhash64(*names, "label").cast("decimal(38,0)"))).first()
    return shared_path(train.sparkSession, "huddle-search", "-".join(str(x) for x in (*mark, len(names), folds)))


def cross_validate(
    train: DataFrame,
    features: Sequence[str],
    grid: dict = SMALL_GRID,
    folds: int = 5,
    fold_key: str = "game_id",
    store: str | None = None,
):
    """Grid search with ``folds`` hash folds of ``fold_key``, scored by RMSE.
    Returns (best setting, scores frame).  Scores of the same rows that are
    already in ``store`` are not computed again."""
    store = store or _store(train, features, folds)
    scores = boosting.search(train, features, "label", [fold_key], hash_bucket(fold_key, folds), grid, store, folds)
    best = best_setting(scores).first().asDict()
    return {k: best[k] for k in grid}, scores


def best_setting(scores: DataFrame, metric: str = "mean_rmse") -> DataFrame:
    """The grid row with the lowest mean score (ties: lowest setting id),
    as one aggregate."""
    cols = [c for c in scores.columns if c != metric]
    best = F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(metric), F.col("setting")))
    return scores.agg(best.alias("_b"), F.min(metric).alias(metric)).select(
        *[F.col("_b")[c].alias(c) for c in cols], metric)


def train_and_score(
    prepared: Prepared, test_season: int, setting: dict | None = None, seed: int = 42,
    grid: dict = SMALL_GRID, folds: int = 5, fold_key: str = "game_id",
):
    """Fit on seasons before ``test_season`` and score it: with ``setting``,
    or else with the best setting of ``grid`` by ``folds``-fold search on the
    training seasons, refitted on all of them."""
    train, test = split.season_split(prepared.frame, test_season)
    names = prepared.feature_names
    if not setting:
        setting, _ = cross_validate(train, names, grid, folds, fold_key)
    model = boosting.fit(train, names, "label", [fold_key], boosting.Setting.of({**setting, "seed": seed}))
    return model, model.transform(test)


def importances(model: boosting.Booster, spark) -> DataFrame:
    """(feature, importance): mean gains, one row per feature."""
    return spark.createDataFrame([(k, float(v)) for k, v in model.gains().items()], "feature string, importance double")
