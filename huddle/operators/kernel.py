"""Support vector regression with a Gaussian kernel, solved in the primal.

The kernel is replaced by features: with landmarks L (rows drawn by a hash)
and ``k(L, L) = U S U'``, a row x becomes ``k(x, L) U S^(-1/2)``.  Where the
landmarks are all distinct rows, that is the kernel itself.  On those features
the objective

    |w|^2 / 2 + C * sum of max(0, |y - f(x)| - epsilon)

is minimised by Newton steps.  Its kinks are rounded over a width that shrinks
to ``tolerance`` of the labels' deviation.  A step needs the sums of loss,
gradient and second derivatives at one point: one aggregate over all rows.
No matrix grows with the rows; the driver holds landmarks x landmarks numbers.

Equal rows (features, label) are counted once and weigh their number.  Rows
whose label or one of whose features is missing take no part; without any row
the prediction is null.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huddle.session import materialize

#: Cells (rows x columns, eight bytes each) that may be fetched at once; the same sums run on them in place.
LOCAL = 3_000_000


@dataclass
class KernelModel:
    landmarks: np.ndarray
    basis: np.ndarray
    weights: np.ndarray
    intercept: float
    gamma: float

    def features(self, x: np.ndarray) -> np.ndarray:
        return gaussian(x, self.landmarks, self.gamma) @ self.basis

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights + self.intercept

    def predict(self, points: DataFrame, features: Sequence[str]) -> DataFrame:
        """The feature columns with ``prediction``; null where a feature is missing."""
        model, names = self, list(features)

        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1).astype(float).reshape(-1, len(names))
                found = model(x) if len(model.landmarks) else np.full(len(x), np.nan)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, mask=np.isnan(found))], names=[*names, "prediction"])

        schema = ", ".join(f"`{c}` double" for c in names) + ", prediction double"
        return points.select(*[F.col(c).cast("double").alias(c) for c in names]).mapInArrow(run, schema)


def gaussian(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.exp(-gamma * np.maximum(squared, 0))


def _sums(phi: np.ndarray, y: np.ndarray, n: np.ndarray, theta: np.ndarray, epsilon: float, width: float) -> np.ndarray:
    """Loss, gradient and the upper triangle of the second derivatives, summed over the rows."""
    error = phi @ theta - y
    beyond = np.abs(error) - epsilon
    loss = np.where(beyond < width, np.maximum(beyond, 0) ** 2 / (2 * width), beyond - width / 2)
    slope = np.sign(error) * np.clip(beyond / width, 0, 1)
    bent = (beyond > 0) & (beyond < width)
    second = phi[bent].T @ (phi[bent] * (n[bent] / width)[:, None])
    return np.concatenate([[n @ loss], phi.T @ (n * slope), second[np.triu_indices(len(theta))]])


def _arrays(rows: pa.RecordBatch | pa.Table, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    columns = [np.asarray(rows.column(c)) for c in [*names, "y", "n"]]
    return np.stack(columns[:-2], 1), columns[-2], columns[-1]


class _Rows:
    """Distinct (features, label) with their number; sums over them in tasks, or in place when they are few."""

    def __init__(self, rows: DataFrame, features: Sequence[str], y: str):
        names = [f"x{i}" for i in range(len(features))]
        known = rows.select(*[F.col(c).cast("double").alias(n) for c, n in zip(features, names, strict=True)], F.col(y).cast("double").alias("y"))
        known = known.where(F.forall(F.array(*names, "y"), lambda v: v.isNotNull() & ~F.isnan(v)))
        self.names = names
        self.table = materialize(known.groupBy(*names, "y").agg(F.count("*").cast("double").alias("n")), "kernel-rows")
        # two passes: the deviations are taken from the means
        first = self.table.agg(F.count("*"), F.sum("n"), F.sum(F.col("n") * F.col("y")), *[F.sum(F.col("n") * F.col(c)) for c in names]).first()
        self.distinct, self.count = first[0], float(first[1] or 0)
        if not self.distinct:
            return
        self.y_mean, means = first[2] / self.count, np.array(first[3:]) / self.count
        centres = [("y", self.y_mean), *[(c, float(means.mean())) for c in names]]
        second = self.table.agg(*[F.sum(F.col("n") * (F.col(c) - m) ** 2) for c, m in centres]).first()
        self.y_deviation = float(np.sqrt(second[0] / self.count))
        self.x_variance = sum(second[1:]) / self.count / len(names)  # over all cells, as library defaults take it
        self.local = _arrays(self.table.toArrow(), names) if self.distinct * (len(names) + 2) <= LOCAL else None

    def landmarks(self, most: int) -> np.ndarray:
        """All distinct feature rows, or ``most`` of them by a hash."""
        drawn = self.table.select(*self.names).distinct().orderBy(F.xxhash64(*self.names), *self.names).limit(most)
        return np.array([list(r) for r in drawn.collect()], float).reshape(-1, len(self.names))

    def sums(self, model: KernelModel, theta: np.ndarray, epsilon: float, width: float) -> np.ndarray:
        def part(x, y, n):
            phi = np.column_stack([model.features(x), np.ones(len(x))])
            return _sums(phi, y, n, theta, epsilon, width)

        if self.local is not None:
            return part(*self.local)
        names, size = self.names, 1 + len(theta) + len(theta) * (len(theta) + 1) // 2

        def run(batches):
            total = np.zeros(size)
            for batch in batches:
                total += part(*_arrays(batch, names))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["at", "value"])

        found = self.table.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(size)
        out[found.column("at").to_numpy()] = found.column("value").to_numpy()
        return out


def fit_svr(
    rows: DataFrame,
    features: Sequence[str],
    y: str,
    c: float = 1.0,
    epsilon: float = 0.1,
    gamma: float | None = None,
    landmarks: int = 128,
    tolerance: float = 1e-3,
) -> KernelModel:
    """Defaults are the usual library's (fixed values): C 1, epsilon 0.1, gamma 1 / (features x variance of all cells).

    ``landmarks`` bounds the features, not the rows: every row counts in every step."""
    data = _Rows(rows, features, y)
    if not data.distinct:
        return KernelModel(np.zeros((0, len(features))), np.zeros((0, 0)), np.zeros(0), 0.0, 1.0)
    if gamma is None:
        gamma = 1 / (len(features) * data.x_variance) if data.x_variance > 0 else 1.0
    marks = data.landmarks(landmarks)
    values, vectors = np.linalg.eigh(gaussian(marks, marks, gamma))
    keep = values > 1e-10 * values.max()
    model = KernelModel(marks, vectors[:, keep] / np.sqrt(values[keep]), np.zeros(keep.sum()), data.y_mean, gamma)

    size = keep.sum() + 1
    theta = np.append(model.weights, model.intercept)
    flat = np.append(np.ones(size - 1), 0.0)  # the intercept is free
    scale = data.y_deviation or 1.0

    def at(point, width):
        found = data.sums(model, point, epsilon, width)
        second = np.zeros((size, size))
        second[np.triu_indices(size)] = c * found[1 + size :]
        second += np.triu(second, 1).T
        return 0.5 * point @ (flat * point) + c * found[0], flat * point + c * found[1 : 1 + size], second + np.diag(flat)

    width = 4 * scale
    while True:
        value, gradient, second = at(theta, width)
        for _ in range(100):
            # where no row bends the loss, the free intercept still gets a step of bounded length
            second[-1, -1] += 1e-3 * c * data.count / scale * (np.diag(second)[-1] <= 0) + 1e-12
            step = np.linalg.solve(second, -gradient)
            gain = -gradient @ step
            if gain <= 1e-10 * max(1.0, abs(value)):
                break
            length, moved = 1.0, False
            while length > 1e-6:
                new = at(theta + length * step, width)
                if new[0] <= value - 1e-4 * length * gain:
                    theta, moved = theta + length * step, True
                    value, gradient, second = new
                    break
                length /= 2
            if not moved:
                break
        if width <= tolerance * scale:
            break
        width = max(width / 4, tolerance * scale)
    model.weights, model.intercept = theta[:-1], float(theta[-1])
    return model
