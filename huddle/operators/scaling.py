"""Population standardisation of feature columns.

``fit`` is one aggregate (mean and population standard deviation of every
column, missing values ignored) whose single row is brought to the driver,
as any Spark ML model does; ``transform`` applies the statistics as
literals, inside codegen.  A column with zero or undefined spread is
divided by 1.  Binary flags are left unscaled by not listing them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ScalerModel:
    columns: tuple[str, ...]
    means: tuple[float | None, ...]
    stds: tuple[float | None, ...]

    def scale_of(self, i: int) -> float:
        s = self.stds[i]
        return 1.0 if s is None or s == 0.0 else s

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        scaled = {}
        for i, c in enumerate(self.columns):
            mean = self.means[i]
            centred = F.col(c) - F.lit(mean if mean is not None else 0.0)
            scaled[c + suffix] = (centred / F.lit(self.scale_of(i))).cast("double")
        if suffix:
            return df.select("*", *[v.alias(k) for k, v in scaled.items()])
        return df.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])

    def stats_frame(self, spark) -> DataFrame:
        rows = [(c, self.means[i], self.stds[i], self.scale_of(i)) for i, c in enumerate(self.columns)]
        return spark.createDataFrame(rows, "feature string, mean double, std double, scale double")


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> ScalerModel:
    exprs = []
    for i, c in enumerate(columns):
        exprs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    row = df.agg(*exprs).first()
    return ScalerModel(
        tuple(columns),
        tuple(row[f"m{i}"] for i in range(len(columns))),
        tuple(row[f"s{i}"] for i in range(len(columns))),
    )


def standardise(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Scale ``columns`` of ``df`` with statistics fitted on ``fit_on``
    (default: ``df`` itself, i.e. train and test together)."""
    return fit_scaler(fit_on if fit_on is not None else df, columns).transform(df)
