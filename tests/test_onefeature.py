"""One-feature trees and ensembles against brute-force learners."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from huddle.operators import onefeature as one
from huddle.operators.asof import grid_neighbours


def make(n=400, seed=5):
    rng = random.Random(seed)
    xs = [rng.choice([-3.5, -1.0, 0.0, 0.25, 2.0, 2.5, 4.0, 7.0, 7.5, 9.0, 20.0]) if rng.random() < 0.7 else 1.0 for _ in range(n)]
    return [(x, float(round(3 * math.sin(x) + rng.gauss(0, 1), 1))) for x in xs]


ROWS = make()
POINTS = [-99.0, -3.5, -2.25, -1.0, 0.1, 0.125, 0.126, 1.0, 3.0, 7.25, 7.26, 50.0]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([*ROWS, (None, 4.0), (2.0, None)], "x double, y double").repartition(5)


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame([(p,) for p in POINTS], "x double")


def predicted(frame):
    return {r["x"]: r["prediction"] for r in frame.collect()}


class Tree:
    """A plain recursive regression tree on weighted rows."""

    def __init__(self, rows, depth, l2=0.0, least=0.0):
        w, s = sum(r[2] for r in rows), sum(r[1] * r[2] for r in rows)
        self.value, self.cut = s / (w + l2) if w + l2 else 0.0, None
        xs = sorted({r[0] for r in rows})
        best = 1e-12
        for a, b in zip(xs[:-1], xs[1:], strict=True):
            left = [r for r in rows if r[0] <= a]
            wl, sl = sum(r[2] for r in left), sum(r[1] * r[2] for r in left)
            wr, sr = w - wl, s - sl
            gain = sl * sl / (wl + l2) + sr * sr / (wr + l2) - s * s / (w + l2)
            if depth and wl >= least and wr >= least and gain > best + 1e-9:
                best, self.cut = gain, (a + b) / 2
        if self.cut is not None:
            self.left = Tree([r for r in rows if r[0] <= self.cut], depth - 1, l2, least)
            self.right = Tree([r for r in rows if r[0] > self.cut], depth - 1, l2, least)

    def __call__(self, x):
        return self.value if self.cut is None else (self.left if x <= self.cut else self.right)(x)


def test_full_tree_equals_a_recursive_one(rows, points):
    tree = Tree([(x, y, 1) for x, y in ROWS], 10**6)
    found = predicted(one.predict_cells(points, one.mean_cells(rows, "x", "y")))
    assert found == {p: pytest.approx(tree(p)) for p in POINTS}


@pytest.mark.parametrize("local, block", [(10**6, 50_000), (0, 3), (0, 50_000)])
@pytest.mark.parametrize("rate, depth, l2, least", [(0.1, 3, 0.0, 0.0), (0.3, 6, 1.0, 1.0)])
def test_boosting_equals_recursive_trees_on_residuals(rows, points, monkeypatch, local, block, rate, depth, l2, least):
    """Also where blocks are read by tasks, and where they end within equal x."""
    monkeypatch.setattr(one, "LOCAL", local)
    monkeypatch.setattr(one, "BLOCK", block)
    mean = sum(y for _, y in ROWS) / len(ROWS)
    trees = []
    fit = lambda x: mean + rate * sum(t(x) for t in trees)
    for _ in range(4):
        trees.append(Tree([(x, y - fit(x), 1) for x, y in ROWS], depth, l2, least))
    model = one.boost(rows, "x", "y", 4, rate, depth, l2, least)
    assert predicted(model.predict(points)) == {p: pytest.approx(fit(p)) for p in POINTS}


def brute_adaboost(rounds, depth):
    w, trees, votes = [1.0] * len(ROWS), [], []
    for _ in range(rounds):
        tree = Tree([(x, y, v) for (x, y), v in zip(ROWS, w, strict=True)], depth)
        errors = [abs(y - tree(x)) for x, y in ROWS]
        loss = sum(a * b for a, b in zip(w, errors, strict=True)) / max(errors) / sum(w)
        if loss >= 0.5:
            break
        beta = loss / (1 - loss)
        trees.append(tree)
        votes.append(math.log(1 / beta))
        w = [v * beta ** (1 - e / max(errors)) for v, e in zip(w, errors, strict=True)]

    def predict(x):
        total = 0.0
        for p, v in sorted((t(x), v) for t, v in zip(trees, votes, strict=True)):
            total += v
            if total >= 0.5 * sum(votes):
                return p

    return predict


@pytest.mark.parametrize("local, block", [(10**6, 50_000), (0, 40)])
def test_adaboost_equals_row_weights(rows, points, monkeypatch, local, block):
    monkeypatch.setattr(one, "LOCAL", local)
    monkeypatch.setattr(one, "BLOCK", block)
    expected = brute_adaboost(5, 2)
    assert predicted(one.adaboost(rows, "x", "y", 5, depth=2).predict(points)) == {p: pytest.approx(expected(p)) for p in POINTS}


def test_forest_averages_trees_of_seeded_resamples(rows, points):
    cells = one.forest_cells(rows, "x", "y", 30, seed=3).collect()
    again = {(r["tree"], r["x"]): r["value"] for r in one.forest_cells(rows.repartition(2), "x", "y", 30, seed=3).collect()}
    assert {(r["tree"], r["x"]): pytest.approx(r["value"]) for r in cells} == again
    found = predicted(one.predict_forest(points, one.forest_cells(rows, "x", "y", 30, seed=3), 30))
    for p in POINTS:
        each = []
        for t in range(30):
            own = sorted((r["x"], r["value"]) for r in cells if r["tree"] == t)
            each.append(next((v for (x, v), (x2, _) in zip(own, own[1:] + [(math.inf, 0)], strict=True) if p <= (x + x2) / 2), own[-1][1]))
        assert found[p] == pytest.approx(sum(each) / 30)
    means = {x: np.mean([y for a, y in ROWS if a == x]) for x, _ in ROWS}
    assert all(abs(found[p] - means[p]) < 0.5 for p in POINTS if p in means)


@pytest.mark.parametrize("mean", [1, 7, 32, 33, 5000])
def test_poisson_draws_have_their_mean_and_variance(mean):
    draws = one.poisson(one._mix(np.arange(1, 4001, dtype=np.uint64) << np.uint64(7)), np.full(4000, mean))
    assert abs(draws.mean() - mean) < 4 * math.sqrt(mean / 4000) and 0.85 * mean < draws.var() < 1.15 * mean


def test_neighbours_by_group(spark):
    grid = spark.createDataFrame([(g, float(x), g * 100.0 + x) for g in (1, 2, 4) for x in range(0, 40, 3 + g)], "g int, x double, v double").repartition(7)
    points = spark.createDataFrame([(g, x / 2) for g in (1, 2, 3, 4) for x in range(-3, 90)], "g int, x double").repartition(3)
    have = {(r.g, r.x): r.v for r in grid.collect()}
    for r in grid_neighbours(points, grid, "x", "v", "g").collect():
        low = max(((x, v) for (g, x), v in have.items() if g == r.g and x <= r.x), default=None)
        high = min(((x, v) for (g, x), v in have.items() if g == r.g and x > r.x), default=None)
        assert (r.below and tuple(r.below), r.above and tuple(r.above)) == (low, high)


def test_scores_and_nothing(spark, rows, points):
    sizes = {"rfr": 5, "gbr": 3, "xgbr": 2, "adaboost": 3}
    xs = rows.where("x is not null").select("x").distinct()
    found = {r["regressor"]: r for r in one.score(one.tree_predictions(rows, xs, "x", "y", sizes), rows, "x", "y").collect()}
    tree = Tree([(x, y, 1) for x, y in ROWS], 10**6)
    assert set(found) == {"dtr", "rfr", "gbr", "xgbr", "adaboost"} and {r["n"] for r in found.values()} == {len(ROWS)}
    assert found["dtr"]["mse"] == pytest.approx(sum((y - tree(x)) ** 2 for x, y in ROWS) / len(ROWS))
    none = rows.limit(0)
    assert one.mean_cells(none, "x", "y").count() == 0 and len(one.boost(none, "x", "y", 2).starts) == 1
    assert predicted(one.adaboost(none, "x", "y", 2).predict(points)) == dict.fromkeys(POINTS, 0.0)
    assert one.predict_cells(points, one.mean_cells(none, "x", "y")).where(F.col("prediction").isNotNull()).count() == 0
