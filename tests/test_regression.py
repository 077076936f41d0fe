import numpy as np
import pytest
from pyspark.sql import functions as F

from huddle.operators import regression


def data(spark, n=200, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 50, n)
    y = (3 * x + rng.integers(-40, 40, n)).astype(int)
    df = spark.createDataFrame([(int(a), int(b), int(i % 3)) for i, (a, b) in enumerate(zip(x, y))], "x long, y long, g int")
    return df, x.astype(float), y.astype(float)


def objective(kind, w, b, x, y, alpha=1.0, l1=0.5):
    r = y - (w * x + b)
    n = len(x)
    if kind == "lasso":
        return (r @ r) / (2 * n) + alpha * abs(w)
    if kind == "en":
        return (r @ r) / (2 * n) + alpha * l1 * abs(w) + 0.5 * alpha * (1 - l1) * w * w
    if kind == "ridge":
        return r @ r + alpha * w * w
    return r @ r


def brute_force(kind, x, y):
    """Minimise over a fine grid of slopes with the optimal intercept."""
    best = None
    for w in np.linspace(-10, 10, 200001):
        b = y.mean() - w * x.mean()
        v = objective(kind, w, b, x, y)
        if best is None or v < best[0]:
            best = (v, w, b)
    return best[1], best[2]


@pytest.mark.parametrize("kind", ["lr", "lasso", "ridge", "en"])
def test_closed_forms_minimise_their_objective(spark, kind):
    df, x, y = data(spark)
    r = regression.fit_closed_form(df, "x", "y", [kind]).first()
    w, b = brute_force(kind, x, y)
    assert abs(r.slope - w) < 2e-4 and abs(r.intercept - b) < 1e-2
    if kind == "lr":
        slope, intercept = np.polyfit(x, y, 1)
        assert abs(r.slope - slope) < 1e-9 and abs(r.intercept - intercept) < 1e-7


def test_penalty_larger_than_covariance_gives_zero_slope(spark):
    df = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (3, 0)], "x long, y long")
    r = {x.model: x for x in regression.fit_closed_form(df, "x", "y", ["lr", "lasso", "en"]).collect()}
    assert abs(r["lr"].slope) > 0 and r["lasso"].slope == 0.0 and r["en"].slope == 0.0
    assert r["lasso"].intercept == 0.5


def test_zero_variance(spark):
    df = spark.createDataFrame([(2, 1), (2, 3)], "x long, y long")
    r = {x.model: x for x in regression.fit_closed_form(df, "x", "y", ["lr", "ridge", "lasso"]).collect()}
    assert r["lr"].slope is None and r["ridge"].slope == 0.0 and r["lasso"].slope == 0.0
    assert r["ridge"].intercept == 2.0


def test_per_group_fit(spark):
    df, _, _ = data(spark)
    per = {x.g: x for x in regression.fit_closed_form(df, "x", "y", ["lr"], group_by=["g"]).collect()}
    pdf = df.toPandas()
    for g, sub in pdf.groupby("g"):
        slope, _ = np.polyfit(sub.x.astype(float), sub.y.astype(float), 1)
        assert abs(per[g].slope - slope) < 1e-9


def test_double_inputs(spark):
    df, x, y = data(spark)
    d = df.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    r = regression.fit_closed_form(d, "x", "y", ["lr"]).first()
    assert abs(r.slope - np.polyfit(x, y, 1)[0]) < 1e-9


def test_bayesian_ridge_close_to_ols_on_clean_data(spark):
    df, x, y = data(spark, n=2000)
    m = regression.fit_bayesian_ridge(df, "x", "y")
    slope, intercept = np.polyfit(x, y, 1)
    assert abs(m.slope - slope) < 1e-3 and abs(m.intercept - intercept) < 0.05
    assert m.slope < slope  # shrunk towards 0, slightly
