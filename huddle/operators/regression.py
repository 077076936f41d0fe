"""Closed-form one-feature regressors as aggregates.

All fits come from the same sufficient statistics -- n, sum x, sum y,
sum xy, sum x^2 -- accumulated as exact decimals (no cancellation in
``n*sum(x^2) - sum(x)^2``), so one partial/final aggregate fits a model
over any number of rows, or one model per group in the same pass.  A hot
group is absorbed by the map-side partial aggregate.

Objectives (intercept fitted, data centred), with var = population
variance of x and cov = population covariance of x and y:

* ``lr``      ordinary least squares        slope = cov / var
* ``lasso``   (1/2n)|r|^2 + a|w|            slope = soft(cov, a) / var
* ``en``      (1/2n)|r|^2 + a*l1|w| + a(1-l1)/2 w^2
                                            slope = soft(cov, a*l1) / (var + a(1-l1))
* ``ridge``   |r|^2 + a w^2                 slope = cov / (var + a/n)

and intercept = mean(y) - slope * mean(x).  Zero variance gives a NULL
slope for ``lr`` and a zero slope where the penalty makes it defined.
"""

from __future__ import annotations

import math
from decimal import Decimal
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = "decimal(38,0)"


def sufficient_stats(df: DataFrame, x: str, y: str, group_by: Sequence[str] = ()) -> DataFrame:
    """n, sx, sy, sxy, sxx (and syy) per group; x and y must be integral for
    the sums to be exact (cast them first otherwise -- doubles are summed
    as doubles)."""
    xi, yi = F.col(x), F.col(y)
    both = xi.isNotNull() & yi.isNotNull()
    integral = all(
        df.schema[c].dataType.typeName() in ("long", "integer", "short", "byte") for c in (x, y)
    )

    def s(e: Column) -> Column:
        e = F.when(both, e)
        return F.sum(e.cast(EXACT)) if integral else F.sum(e.cast("double"))

    return df.groupBy(*group_by).agg(
        F.count_if(both).alias("n"),
        s(xi).alias("sx"),
        s(yi).alias("sy"),
        s(xi * yi if not integral else xi.cast(EXACT) * yi.cast(EXACT)).alias("sxy"),
        s(xi * xi if not integral else xi.cast(EXACT) * xi.cast(EXACT)).alias("sxx"),
        s(yi * yi if not integral else yi.cast(EXACT) * yi.cast(EXACT)).alias("syy"),
    )


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def moment_columns() -> dict[str, Column]:
    """var, cov, means from the sums: computed as exact differences first."""
    n = F.col("n").cast(EXACT)
    sxx_c = n * F.col("sxx").cast(EXACT) - F.col("sx").cast(EXACT) * F.col("sx").cast(EXACT)
    sxy_c = n * F.col("sxy").cast(EXACT) - F.col("sx").cast(EXACT) * F.col("sy").cast(EXACT)
    nd = _d("n")
    return {
        "mean_x": _d("sx") / nd,
        "mean_y": _d("sy") / nd,
        "var_x": sxx_c.cast("double") / nd / nd,
        "cov_xy": sxy_c.cast("double") / nd / nd,
    }


def soft_threshold(c: Column, a: float) -> Column:
    return F.signum(c) * F.greatest(F.abs(c) - F.lit(a), F.lit(0.0))


def slope_expr(kind: str, alpha: float = 1.0, l1_ratio: float = 0.5) -> Column:
    var, cov, n = F.col("var_x"), F.col("cov_xy"), _d("n")
    if kind == "lr":
        return F.when(var != 0, cov / var)
    if kind == "lasso":
        return F.when(var != 0, soft_threshold(cov, alpha) / var).otherwise(F.lit(0.0))
    if kind == "en":
        return soft_threshold(cov, alpha * l1_ratio) / (var + F.lit(alpha * (1 - l1_ratio)))
    if kind == "ridge":
        return cov / (var + F.lit(alpha) / n)
    raise ValueError(kind)


def fit_closed_form(
    df: DataFrame,
    x: str,
    y: str,
    kinds: Sequence[str] = ("lr", "lasso", "ridge", "en"),
    group_by: Sequence[str] = (),
    alpha: float = 1.0,
    l1_ratio: float = 0.5,
) -> DataFrame:
    """One row per (group, model): n, slope, intercept.  Lazy; nothing is
    collected."""
    stats = sufficient_stats(df, x, y, group_by).filter(F.col("n") > 0)
    m = moment_columns()
    stats = stats.select(*group_by, "n", *[v.alias(k) for k, v in m.items()])
    models = F.array(*[F.struct(F.lit(k).alias("model"), slope_expr(k, alpha, l1_ratio).alias("slope")) for k in kinds])
    fitted = stats.select(*group_by, "n", "mean_x", "mean_y", F.inline(models))
    return fitted.select(
        *group_by, "model", "n", "slope",
        (F.col("mean_y") - F.col("slope") * F.col("mean_x")).alias("intercept"),
    )


@dataclass(frozen=True)
class LinearModel:
    name: str
    slope: float | None
    intercept: float | None

    def predict(self, x: Column) -> Column:
        if self.slope is None or self.intercept is None:
            return F.lit(None).cast("double")
        return F.lit(self.intercept) + F.lit(self.slope) * x


def fit_models(df: DataFrame, x: str, y: str, kinds: Sequence[str] = ("lr", "lasso", "ridge", "en"), **kw) -> dict[str, LinearModel]:
    """Fit and bring the coefficients (a handful of numbers) to the driver.  One model per kind: for
    groups use :func:`fit_closed_form`, which keeps them in a table."""
    if kw.get("group_by"):
        raise ValueError("fit_models fits one model per kind; use fit_closed_form(group_by=...)")
    rows = fit_closed_form(df, x, y, kinds, **kw).collect()
    return {r["model"]: LinearModel(r["model"], r["slope"], r["intercept"]) for r in rows}


def fit_bayesian_ridge(
    df: DataFrame,
    x: str,
    y: str,
    max_iter: int = 300,
    tol: float = 1e-3,
    alpha_1: float = 1e-6,
    alpha_2: float = 1e-6,
    lambda_1: float = 1e-6,
    lambda_2: float = 1e-6,
) -> LinearModel:
    """Bayesian ridge for one feature: one aggregate of sufficient statistics
    on the cluster, then the evidence-maximisation updates on five numbers
    (Gamma priors on noise precision alpha and weight precision lambda)."""
    st = sufficient_stats(df, x, y).first()
    n = int(st["n"])
    if n == 0:
        return LinearModel("bayesianridge", None, None)

    def num(v):  # exact decimals become Python ints, so the centring is exact
        return int(v) if isinstance(v, Decimal) else float(v)

    sx, sy, sxy, sxx, syy = (num(st[k]) for k in ("sx", "sy", "sxy", "sxx", "syy"))
    mx, my = sx / n, sy / n
    cxx = (n * sxx - sx * sx) / n  # sum of (x - mean x)^2
    cxy = (n * sxy - sx * sy) / n
    cyy = (n * syy - sy * sy) / n
    var_y = cyy / n
    eps = 2.220446049250313e-16
    alpha = 1.0 / (var_y + eps)
    lam = 1.0
    coef_old = None
    coef = 0.0
    for _ in range(max_iter):
        coef = cxy / (cxx + lam / alpha) if (cxx + lam / alpha) != 0 else 0.0
        rss = cyy - 2 * coef * cxy + coef * coef * cxx
        gamma = (alpha * cxx) / (lam + alpha * cxx) if (lam + alpha * cxx) != 0 else 0.0
        lam = (gamma + 2 * lambda_1) / (coef * coef + 2 * lambda_2)
        alpha = (n - gamma + 2 * alpha_1) / (rss + 2 * alpha_2)
        if coef_old is not None and abs(coef_old - coef) < tol:
            break
        coef_old = coef
    coef = cxy / (cxx + lam / alpha) if (cxx + lam / alpha) != 0 else 0.0
    if math.isnan(coef):
        return LinearModel("bayesianridge", None, None)
    return LinearModel("bayesianridge", coef, my - coef * mx)
