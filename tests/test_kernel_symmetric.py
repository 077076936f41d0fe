"""Kernel regression against an exact dual solution, ordered boosting against a row-by-row learner."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from huddle.operators import kernel, symmetric


def dual(k, y, c, epsilon, steps=20000, rho=1.0):
    """f of the exact problem: the dual by alternating directions, then the intercept from the free rows."""
    n = len(y)
    system = np.zeros((n + 1, n + 1))
    system[:n, :n] = k + rho * np.eye(n)
    system[:n, n] = system[n, :n] = 1
    inverse = np.linalg.inv(system)
    z, u = np.zeros(n), np.zeros(n)
    for _ in range(steps):
        b = (inverse @ np.append(y + rho * (z - u), 0))[:n]
        v = b + u
        z = np.clip(np.sign(v) * np.maximum(np.abs(v) - epsilon / rho, 0), -c, c)
        u += b - z
    free = (np.abs(z) > 1e-6) & (np.abs(z) < c - 1e-6)
    return k @ z + np.mean((y - k @ z - epsilon * np.sign(z))[free])


def labelled(n, seed=3, features=1):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-3, 3, (n, features))
    return x, np.sin(2 * x[:, 0]) + (x[:, -1] if features > 1 else 0) + rng.normal(0, 0.3, n)


@pytest.mark.parametrize("features", [1, 2])
def test_equals_the_dual_solution(spark, features):
    x, y = labelled(300, features=features)
    names = [f"a{i}" for i in range(features)]
    frame = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y, strict=True)] + [(*[None] * features, 1.0)], ", ".join(f"{c} double" for c in [*names, "t"])).repartition(4)
    model = kernel.fit_svr(frame, names, "t", landmarks=300, tolerance=1e-4)
    assert model.gamma == pytest.approx(1 / (features * x.var()))
    exact = dual(kernel.gaussian(x, x, model.gamma), y, 1.0, 0.1)
    assert np.abs(model(x) - exact).max() < 5e-3
    few = kernel.fit_svr(frame, names, "t", landmarks=60)
    assert np.abs(few(x) - exact).max() < 0.1


def test_sums_in_tasks_equal_sums_in_place(spark, monkeypatch):
    x, y = labelled(80)
    frame = spark.createDataFrame([(float(a), float(b)) for a, b in zip(np.round(x[:, 0], 1), np.round(y, 1), strict=True)] * 2, "a double, t double").repartition(3)
    here = kernel.fit_svr(frame, ["a"], "t", tolerance=0.05)
    monkeypatch.setattr(kernel, "LOCAL", 0)
    there = kernel.fit_svr(frame, ["a"], "t", tolerance=0.05)
    points = np.linspace(-4, 4, 30)[:, None]
    assert np.abs(here(points) - there(points)).max() < 1e-6


def test_kernel_defined_results(spark):
    empty = spark.createDataFrame([(None, 1.0), (1.0, None)], "a double, t double")
    point = spark.createDataFrame([(1.0,), (None,)], "a double")
    assert [r["prediction"] for r in kernel.fit_svr(empty, ["a"], "t").predict(point, ["a"]).collect()] == [None, None]
    same = spark.createDataFrame([(2.0, 5.0)] * 4, "a double, t double")
    found = {r["a"]: r["prediction"] for r in kernel.fit_svr(same, ["a"], "t").predict(point, ["a"]).collect()}
    assert found[None] is None and found[1.0] == pytest.approx(5.0, abs=0.11)


def plain_ordered(rows, rounds, rate, depth, l2):
    """One row at a time: rows (x, y, block), a model per block, all borders tried at every level."""
    values = sorted({r[0] for r in rows})
    middles = [(a + b) / 2 for a, b in zip(values[:-1], values[1:], strict=True)]
    mean = sum(r[1] for r in rows) / len(rows)
    models = [{v: mean for v in values} for _ in range(symmetric.BLOCKS + 1)]
    for _ in range(rounds):
        own = [(x, y - models[b][x]) for x, y, b in rows]
        chosen = []

        def leaf(x, cuts):
            return sum(x > c for c in cuts)

        def score(cuts, own=own):
            total = {}
            for x, g in own:
                have = total.setdefault(leaf(x, cuts), [0.0, 0])
                have[0] += g
                have[1] += 1
            return sum(g * g / (n + l2) for g, n in total.values())

        for _ in range(depth):
            at = score(chosen)
            best = max((m for m in middles if m not in chosen), key=lambda m: (round(score([*chosen, m]), 9), -m), default=None)
            if best is None or score([*chosen, best]) - at <= 1e-12:
                break
            chosen.append(best)
        for j, model in enumerate(models):
            total = {}
            for x, y, b in rows:
                if b < j:
                    have = total.setdefault(leaf(x, chosen), [0.0, 0])
                    have[0] += y - model[x]
                    have[1] += 1
            for v in values:
                g, n = total.get(leaf(v, chosen), (0.0, 0))
                model[v] += rate * (g / (n + l2) if n + l2 else 0.0)
    return models[-1]


def test_ordered_boosting_equals_a_row_by_row_learner(spark):
    rng = random.Random(1)
    rows = [(i, float(rng.choice([-2, 0, 1, 1, 1, 3, 4, 8, 9])), 0.0) for i in range(200)]
    rows = [(i, x, round(math.sin(x) + rng.gauss(0, 0.5), 3)) for i, x, _ in rows]
    frame = spark.createDataFrame([*rows, (900, None, 1.0), (901, 2.0, None)], "id long, x double, y double").repartition(5)
    block = {r["id"]: r["block"] for r in frame.select("id", symmetric.block_of("id", 42).alias("block")).collect()}
    assert sum(b == symmetric.BLOCKS - 1 for b in block.values()) in range(70, 130)
    want = plain_ordered([(x, y, block[i]) for i, x, y in rows], 8, 0.3, 3, 3.0)
    model = symmetric.ordered_boost(frame, "x", "y", "id", rounds=8, rate=0.3, depth=3)
    values = np.array(sorted(want))
    assert model(values) == pytest.approx([want[v] for v in values], abs=1e-9)


def test_many_values_are_binned(spark):
    frame = spark.range(5000).select("id", (F.col("id") / 5000).alias("x"), F.when(F.col("id") < 2500, 1.0).otherwise(3.0).alias("y"))
    model = symmetric.ordered_boost(frame, "x", "y", "id", borders=20, rounds=300)
    assert len(model.starts) <= 21
    assert model(np.array([0.1, 0.9])) == pytest.approx([1.0, 3.0], abs=0.05)
    assert symmetric.ordered_boost(frame.where("id < 0"), "x", "y", "id").values.tolist() == [0.0]
