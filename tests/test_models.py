import numpy as np
from pyspark.sql import functions as F

from huddle.operators import boosting, models


def matchups(spark, n=240, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        season = 2021 + i % 3
        d = float(rng.normal())
        rows.append((season, 1 + i % 17, f"g{i}", "AAA", "BBB", 1 + i % 17, int(i % 17 < 3),
                     None if i % 17 == 0 else d, *[float(rng.normal()) for _ in range(7)],
                     bool(i % 5 == 0), int(round(10 * d + rng.normal()))))
    cols = ["season", "week", "game_id", "home_team", "away_team", "week_number", "is_early_season",
            *models.CONTINUOUS_COLS[1:], "is_division_game", "actual_spread"]
    types = {"season": "int", "week": "int", "game_id": "string", "home_team": "string", "away_team": "string",
             "week_number": "int", "is_early_season": "int", "is_division_game": "boolean", "actual_spread": "int"}
    return spark.createDataFrame(rows, ", ".join(f"{c} {types.get(c, 'double')}" for c in cols))


def test_prepare_features_scales_and_keeps_missing_values(spark):
    prep = models.prepare_features(matchups(spark))
    assert prep.feature_names == [*models.CONTINUOUS_COLS, *models.BINARY_COLS]
    by_id = {r.game_id: r for r in prep.frame.collect()}
    assert by_id["g0"].passing_yards_delta is None and by_id["g1"].passing_yards_delta is not None
    vals = np.array([r.week_number for r in by_id.values()])
    assert abs(vals.mean()) < 1e-9 and abs(vals.std() - 1.0) < 1e-9  # population scaling


def test_train_score_and_importances(spark):
    prep = models.prepare_features(matchups(spark))
    model, scored = models.train_and_score(prep, 2023, {"n_estimators": 5, "max_depth": 3})
    assert scored.where("prediction is not null").count() == 80
    imp = {r.feature: r.importance for r in models.importances(model, spark).collect()}
    assert max(imp, key=imp.get) == "passing_yards_delta" and abs(sum(imp.values()) - 1) < 1e-9


GRID = {"n_estimators": [2, 4], "learning_rate": [0.3], "max_depth": [2, 3], "subsample": [1.0], "colsample_bytree": [1.0]}


def test_scoring_uses_the_searched_setting(spark):
    prep = models.prepare_features(matchups(spark))
    best, scores = models.cross_validate(prep.frame.filter(F.col("season") < 2023), prep.feature_names, GRID, folds=5)
    assert scores.count() == 4 and scores.where("mean_rmse > 0").count() == 4
    model, scored = models.train_and_score(prep, 2023, grid=GRID)
    assert len(model.trees) == best["n_estimators"] == models.best_setting(scores).first().n_estimators
    assert scored.count() == 80


def test_registered_model_queries_are_whole(spark, monkeypatch):
    from huddle.operators import onefeature
    from huddle.plans import queries

    prep, seen = models.prepare_features(matchups(spark)), []
    monkeypatch.setattr(queries, "_prepared", lambda spark, root: (prep, 2023))
    monkeypatch.setattr(models, "cross_validate", lambda train, names, grid, folds=5, **kw: seen.append((grid, folds)) or (None, None))
    queries.REGISTRY["cv_scores"](spark, "")
    queries.REGISTRY["cv_scores"](spark, "", grid=models.FULL_GRID)
    assert seen == [(models.SMALL_GRID, 5), (models.FULL_GRID, 5)] and len(boosting.settings_of(models.FULL_GRID)) == 243
    assert onefeature.SIZES == {"rfr": 100, "gbr": 100, "xgbr": 100, "adaboost": 50}


def test_best_setting(spark):
    scores = spark.createDataFrame([(0, 3.0, 2.5), (1, 4.0, 2.0), (2, 5.0, 2.0)], "setting int, max_depth double, mean_rmse double")
    r = models.best_setting(scores).first()
    assert (r.setting, r.max_depth, r.mean_rmse) == (1, 4.0, 2.0)
