"""Second-order boosting against a brute-force learner."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from huddle.operators import boosting
from huddle.operators.boosting import Setting

NAMES = ["a", "b", "c"]


def make(n=500, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c = float(rng.normal()), float(rng.integers(0, 6)), float(rng.integers(0, 2))
        y = 3 * (a > 0.2) - 2 * (b == 3) + a * c + float(rng.normal()) * 0.1
        rows.append((i, None if rng.random() < 0.15 else a, b if rng.random() < 0.9 else None, c, float(y), "extra"))
    return rows


ROWS = make()


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([*ROWS, (900, 1.0, 1.0, 1.0, None, "x")], "key long, a double, b double, c double, y double, margin string").repartition(5)


def brute_tree(rows, features, cuts, depth, l2, least):
    """rows: (values, gradient); a nested tuple, or a leaf value."""
    g, h = sum(r[1] for r in rows), len(rows)
    best = (1e-6, None)
    for f in features:
        for cut in cuts[f]:
            for to_left in (False, True):
                left = [r for r in rows if (to_left if r[0][f] is None else r[0][f] <= cut)]
                gl, hl = sum(r[1] for r in left), len(left)
                gr, hr = g - gl, h - hl
                if min(hl, hr) < max(least, 1):
                    continue
                gain = gl * gl / (hl + l2) + gr * gr / (hr + l2) - g * g / (h + l2)
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cut, to_left))
    if not depth or best[1] is None:
        return -g / (h + l2)
    f, cut, to_left = best[1]
    goes = [to_left if r[0][f] is None else r[0][f] <= cut for r in rows]
    parts = [[r for r, s in zip(rows, goes, strict=True) if s == side] for side in (True, False)]
    return (f, cut, to_left, *[brute_tree(p, features, cuts, depth - 1, l2, least) for p in parts])


def brute_predict(tree, values):
    while isinstance(tree, tuple):
        f, cut, to_left, left, right = tree
        tree = left if (to_left if values[f] is None else values[f] <= cut) else right
    return tree


def brute_fit(rows, cuts, setting):
    base = sum(r[4] for r in rows) / len(rows)
    margin, trees = {r[0]: base for r in rows}, []
    for number in range(setting.n_estimators):
        columns = boosting.drawn_columns(setting, 3, number).tolist()
        trees.append(brute_tree([(r[1:4], margin[r[0]] - r[4]) for r in rows], columns, cuts, setting.max_depth, setting.reg_lambda, setting.min_child_weight))
        for r in rows:
            margin[r[0]] += setting.learning_rate * brute_predict(trees[-1], r[1:4])
    return lambda v: base + setting.learning_rate * sum(brute_predict(t, v) for t in trees)


@pytest.mark.parametrize("local", [10**9, 0])
@pytest.mark.parametrize("setting", [Setting(3, 0.3, 3), Setting(4, 0.1, 2, colsample_bytree=0.7, reg_lambda=0.5, min_child_weight=20)])
def test_equals_brute_force_and_keeps_missing_values(df, monkeypatch, local, setting):
    """From arrays, and from one aggregate a level with margins written anew in between."""
    monkeypatch.setattr(boosting, "LOCAL", local)
    monkeypatch.setattr(boosting, "REFRESH", 2)
    model = boosting.fit(df, NAMES, "y", ["key"], setting, bins=16)
    assert [len(c) for c in model.cuts[1:]] == [6, 2] and len(model.cuts[0]) == 16
    expected = brute_fit(ROWS, model.cuts, setting)
    found = {r["key"]: r["prediction"] for r in model.transform(df).collect()}
    assert len(found) == 501
    assert all(found[r[0]] == pytest.approx(expected(r[1:4])) for r in ROWS)


def test_arrays_and_table_agree_on_drawn_rows(df, monkeypatch):
    setting = Setting(4, 0.3, 3, subsample=0.7, colsample_bytree=0.7)
    whole = boosting.fit(df, NAMES, "y", ["key"], setting)
    monkeypatch.setattr(boosting, "LOCAL", 0)
    parts = boosting.fit(df.repartition(3), NAMES, "y", ["key"], setting)
    for a, b in zip(whole.trees, parts.trees, strict=True):
        assert a.feature == b.feature and a.cut == b.cut and a.value == pytest.approx(b.value)
    full = boosting.fit(df, NAMES, "y", ["key"], Setting(4, 0.3, 3))
    assert any(a.cut != b.cut for a, b in zip(whole.trees, full.trees, strict=True))


def test_gains_and_fit(df):
    model = boosting.fit(df, NAMES, "y", ["key"], Setting(50, 0.2, 4))
    gains = model.gains()
    assert sum(gains.values()) == pytest.approx(1) and max(gains, key=gains.get) in ("a", "b")
    fitted = model.transform(df.where("y is not null"))
    rmse, spread = fitted.agg(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2)), F.stddev_pop("y")).first()
    assert rmse < spread / 2  # missing features leave 0.67 of 1.8 unexplained


GRID = {"n_estimators": [2, 5], "learning_rate": [0.3], "max_depth": [2, 3], "subsample": [1.0, 0.8], "colsample_bytree": [1.0]}
def fold():
    return F.pmod(F.col("key"), F.lit(3))



@pytest.mark.parametrize("local", [10**9, 0])
def test_search_scores_every_setting_and_resumes(df, tmp_path, monkeypatch, local):
    monkeypatch.setattr(boosting, "LOCAL", local)
    grid = GRID if local else {**GRID, "max_depth": [2], "subsample": [1.0]}
    store = str(tmp_path / "scores")
    first = boosting.search(df, NAMES, "y", ["key"], fold(), {**grid, "max_depth": [2]}, store, folds=3, together=2)
    written = {f.name for f in (tmp_path / "scores").glob("part-*")}
    assert first.count() == len(boosting.settings_of({**grid, "max_depth": [2]}))
    found = {tuple(r[k] for k in grid): r["mean_rmse"] for r in boosting.search(df, NAMES, "y", ["key"], fold(), grid, store, folds=3).collect()}
    assert len(found) == len(boosting.settings_of(grid))
    assert written <= {f.name for f in (tmp_path / "scores").glob("part-*")}  # finished scores stay
    calls = []
    monkeypatch.setattr(boosting, "binned_table", lambda *a, **k: calls.append(a))
    again = boosting.search(df, NAMES, "y", ["key"], fold(), grid, store, folds=3)
    assert again.count() == len(found) and not calls
    # a score by hand: the mean over folds of the RMSE of a fit on the other folds
    monkeypatch.undo()
    cuts = boosting.cut_points(df.where("y is not null"), NAMES)
    errors = []
    for k in range(3):
        model = brute_fit([r for r in ROWS if r[0] % 3 != k], cuts, Setting(2, 0.3, 2))
        errors.append(math.sqrt(np.mean([(model(r[1:4]) - r[4]) ** 2 for r in ROWS if r[0] % 3 == k])))
    assert found[2.0, 0.3, 2.0, 1.0, 1.0] == pytest.approx(np.mean(errors))


def test_nothing_to_learn_from(df):
    model = boosting.fit(df.limit(0), NAMES, "y", ["key"], Setting(2))
    assert {r["prediction"] for r in model.transform(df).collect()} == {0.0}
