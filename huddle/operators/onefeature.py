"""Exact regression trees and their ensembles on one feature, without bins or depth caps.

With one feature x, all that a squared-error tree needs of the rows is, per
distinct x, their number and the sum of their labels; one aggregate gives
that.  Three consequences:

* A tree grown without a depth limit puts every distinct x into a cell of its
  own, bounded half-way to its neighbours: it is the table of means
  (``mean_cells``), and a prediction is a look-up (``predict_cells``).
* A bagged tree is the same on resampled rows.  The resampling is Poisson, so
  ``n`` equal rows (x, y) count Poisson(n) times: one draw per distinct pair
  and tree, from a hash, the same in every run (``forest_cells``).
* Boosted trees of limited depth are sums of step functions, so their
  residuals per distinct x follow from the sums and the steps
  (``boost``, ``adaboost``).  Splits come from prefix sums over the sorted
  values.

The sorted values lie in a table of blocks (one row of arrays each).  A level
of a tree reads every block twice: sums per block and node, then the best
split per block and node, given the sums before it.  Only those few numbers
reach the driver.  If all blocks together are below ``LOCAL`` rows (a few
MB), they are fetched once and the same two steps run on them in place.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huddle.operators.asof import grid_neighbours
from huddle.session import materialize

#: Rows of one block, and of all blocks that may be fetched at once (24 bytes each).
BLOCK, LOCAL = 50_000, 1_000_000


# ----------------------------------------------------------- trees without depth limit


def _known(rows: DataFrame, x: str, y: str, w: str | None) -> DataFrame:
    """(x, y, w) of the rows that have an x and a y; ``w`` counts equal rows, one each if not given."""
    times = F.col(w).cast("double") if w else F.lit(1.0)
    return rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), times.alias("w"))


def mean_cells(rows: DataFrame, x: str, y: str, w: str | None = None) -> DataFrame:
    """(x, n, value): the leaves of the tree grown to the end."""
    sums = _known(rows, x, y, w).groupBy("x").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("s"))
    return sums.select("x", "n", (F.col("s") / F.col("n")).alias("value"))


def predict_cells(points: DataFrame, cells: DataFrame, x: str = "x", group: str | None = None) -> DataFrame:
    """The points (distinct x, and group) with ``prediction``: the value of the cell that x falls into.
    A cell ends half-way to the next x, the middle included."""
    near = grid_neighbours(points, cells.withColumnRenamed("x", x) if x != "x" else cells, x, "value", group)
    middle = (F.col("below.x") + F.col("above.x")) / 2
    left = F.col("above").isNull() | (F.col("below").isNotNull() & (F.col(x) <= middle))
    return near.select(*([group] if group else []), x, F.when(left, F.col("below.value")).otherwise(F.col("above.value")).alias("prediction"))


def _mix(z: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def poisson(hashes: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """One Poisson draw per hash."""
    out = np.zeros(len(mean), np.int64)
    few = mean <= 32
    u, m = (hashes[few] >> np.uint64(11)) / 2.0**53, mean[few].astype(float)
    p = np.exp(-m)
    total, k = p.copy(), np.zeros(len(m), np.int64)
    while (open_ := (u > total) & (p > 0)).any():
        k[open_] += 1
        p[open_] *= m[open_] / k[open_]
        total[open_] += p[open_]
    out[few] = k
    for i in np.flatnonzero(~few):
        out[i] = np.random.Generator(np.random.Philox(int(hashes[i]))).poisson(mean[i])
    return out


def forest_cells(rows: DataFrame, x: str, y: str, trees: int = 100, seed: int = 42, w: str | None = None) -> DataFrame:
    """(tree, x, value): the leaves of each bagged tree."""
    pairs = pair_rows(rows, x, y, w)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            xs, ys, n = (batch.column(c).to_numpy() for c in "xyw")
            with np.errstate(over="ignore"):
                row = _mix(_mix(xs.view(np.uint64) + np.uint64(seed)) + ys.view(np.uint64))
            keys, at = np.unique(xs, return_inverse=True)
            for tree in range(trees):
                with np.errstate(over="ignore"):
                    times = poisson(_mix(row + np.uint64(0x9E3779B97F4A7C15) * np.uint64(tree + 1)), n)
                weight = np.bincount(at, times, len(keys))
                met = weight > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(met.sum(), tree, np.int32)), pa.array(keys[met]), pa.array(weight[met]), pa.array(np.bincount(at, times * ys, len(keys))[met])],
                    names=["tree", "x", "w", "s"],
                )

    drawn = pairs.mapInArrow(run, "tree int, x double, w double, s double")
    return drawn.groupBy("tree", "x").agg((F.sum("s") / F.sum("w")).alias("value"))


def predict_forest(points: DataFrame, cells: DataFrame, trees: int, x: str = "x") -> DataFrame:
    """(x, prediction): the mean of all trees' predictions at each distinct point."""
    each = points.select(x, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    return predict_cells(each, cells, x, "tree").groupBy(x).agg(F.avg("prediction").alias("prediction"))


# ------------------------------------------------------------------- step functions


@dataclass
class Steps:
    """A step function: ``values[i]`` holds for starts[i] < x <= starts[i + 1]; starts[0] is -inf."""

    starts: np.ndarray = field(default_factory=lambda: np.array([-np.inf]))
    values: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.values[np.maximum(np.searchsorted(self.starts, x, side="left") - 1, 0)]

    def plus(self, other: Steps, rate: float) -> Steps:
        starts = np.union1d(self.starts, other.starts)
        ends = np.append(starts[1:], np.inf)  # a cell's end lies in the cell
        return Steps(starts, self(ends) + rate * other(ends))

    def predict(self, points: DataFrame, x: str = "x") -> DataFrame:
        """Adds ``prediction``."""
        steps = self

        def run(batches):
            for batch in batches:
                xs = batch.column(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(steps(xs))], names=[x, "prediction"])

        return points.select(F.col(x).cast("double").alias(x)).mapInArrow(run, f"`{x}` double, prediction double")


# -------------------------------------------------------------------- sorted blocks


class Blocks:
    """Rows (x, y, w) sorted by x, as a table of blocks: (block, x[], y[], w[])."""

    def __init__(self, rows: DataFrame):
        placed = rows.repartitionByRange("x", "y").sortWithinPartitions("x", "y").withColumn("at", F.monotonically_increasing_id())
        placed = materialize(placed, "one-feature-rows")
        block = (F.shiftright("at", 33).bitwiseAND((1 << 30) - 1) * (1 << 20) + F.floor(F.col("at").bitwiseAND((1 << 33) - 1) / BLOCK)).cast("long")
        listed = placed.groupBy(block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("at", "x", "y", "w"))).alias("rows"))
        self.table = materialize(listed.select("block", *[F.col(f"rows.{c}").alias(c) for c in "xyw"]), "one-feature-blocks")
        self.count = placed.count()
        self.local = [self._arrays(b) for b in self.table.toArrow().to_batches()] if self.count <= LOCAL else None

    @staticmethod
    def _arrays(batch: pa.RecordBatch) -> list[tuple]:
        lists = [batch.column(c) for c in "xyw"]
        return [(batch.column("block")[i].as_py(), *[c[i].values.to_numpy(zero_copy_only=False) for c in lists]) for i in range(batch.num_rows)]

    def map(self, step: Callable, names: str) -> np.ndarray:
        """``step(block, x, y, w)`` gives some rows of numbers for each block; all of them, sorted."""
        width = len(names.split())
        if self.local is not None:
            found = [np.reshape(step(*b), (-1, width)) for part in self.local for b in part]
        else:
            arrays, columns = self._arrays, names.split()

            def run(batches):
                for batch in batches:
                    for b in arrays(batch):
                        out = np.reshape(step(*b), (-1, width)).astype(float)
                        yield pa.RecordBatch.from_arrays([pa.array(out[:, i]) for i in range(width)], names=columns)

            rows = self.table.mapInArrow(run, ", ".join(f"{c} double" for c in columns)).toArrow()  # blocks x nodes rows
            found = [np.stack([rows.column(c).to_numpy() for c in columns], 1)]
        out = np.concatenate(found).astype(float) if found else np.zeros((0, width))
        return out[np.lexsort((out[:, 1], out[:, 0]))] if width > 1 else out


Target = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _per_x(x, target, w):
    """Distinct x with the sums of w and of w * target."""
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
    return x[first], np.add.reduceat(w, first), np.add.reduceat(w * target, first)


def _node_sums(target: Target, starts: np.ndarray) -> Callable:
    """Per node in a block: block, node, sum of weights, sum of targets, first and last x."""

    def step(block, x, y, w):
        x, n, s = _per_x(x, *target(x, y, w))
        node = np.searchsorted(starts, x, side="left") - 1
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        last = np.append(first[1:], len(x)) - 1
        return np.stack([np.full(len(first), block), node[first], np.add.reduceat(n, first), np.add.reduceat(s, first), x[first], x[last]], 1)

    return step


def _node_splits(target: Target, starts, before: dict, total: dict, l2: float, least: float) -> Callable:
    """Per node in a block: block, node, gain, threshold, and the sums left of it, of the best split behind one of the block's x."""

    def step(block, x, y, w):
        x, n, s = _per_x(x, *target(x, y, w))
        node = np.searchsorted(starts, x, side="left") - 1
        out = []
        for k in np.unique(node):
            lo, hi = np.searchsorted(node, [k, k + 1])
            n0, s0, behind = before[block, k]
            nl, sl = n0 + np.cumsum(n[lo:hi]), s0 + np.cumsum(s[lo:hi])
            beyond = np.append(x[lo + 1 : hi], behind)
            nt, st = total[k]
            nr, sr = nt - nl, st - sl
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = sl * sl / (nl + l2) + sr * sr / (nr + l2) - st * st / (nt + l2)
            may = (beyond > x[lo:hi]) & (nl >= least) & (nr >= least) & np.isfinite(gain) & np.isfinite(beyond)
            if may.any():
                i = int(np.argmax(np.where(may, gain, -np.inf)))
                out.append([block, k, gain[i], (x[lo + i] + beyond[i]) / 2, nl[i], sl[i]])
        return np.array(out, float).reshape(-1, 6)

    return step


def grow(blocks: Blocks, target: Target, depth: int, l2: float = 0.0, least: float = 0.0, gain_above: float = 1e-12) -> Steps:
    """The greedy tree of at most ``depth`` levels on ``target(x, y, w)`` -> (targets, weights)."""
    starts, closed = np.array([-np.inf]), np.zeros(1, bool)
    for _ in range(depth):
        sums = blocks.map(_node_sums(target, starts), "block node n s first last")
        total, before = _running(sums)
        found = blocks.map(_node_splits(target, starts, before, total, l2, least), "block node gain threshold n s")
        cuts = []
        for k in np.unique(found[:, 1]):
            of = found[found[:, 1] == k]
            best = of[np.argmax(of[:, 2])]
            if not closed[int(k)] and best[2] > gain_above:
                cuts.append(best[3])
        if not cuts:
            break
        # a node that was not split stays closed
        split = np.zeros(len(starts), bool)
        split[np.searchsorted(starts, cuts, side="left") - 1] = True
        born = np.union1d(starts, cuts)
        parent = np.searchsorted(starts, np.append(born[1:], np.inf), side="left") - 1
        starts, closed = born, ~split[parent]
    sums = blocks.map(_node_sums(target, starts), "block node n s first last")
    total, _ = _running(sums)
    return Steps(starts, np.array([total[k][1] / (total[k][0] + l2) if k in total and total[k][0] + l2 else 0.0 for k in range(len(starts))]))


def _running(sums: np.ndarray) -> tuple[dict, dict]:
    """Totals per node; per (block, node) what came before and the x that follows in the node."""
    total, before = {}, {}
    for block, k, n, s, first, _ in sums:
        have = total.get(k, (0.0, 0.0))
        before[block, k] = [*have, np.inf]
        total[k] = have[0] + n, have[1] + s
    later: dict = {}
    for block, k, _, _, first, _ in sums[::-1]:
        before[block, k][2] = later.get(k, np.inf)
        later[k] = first
    return total, before


# ------------------------------------------------------------------------ ensembles


def x_rows(rows: DataFrame, x: str, y: str, w: str | None = None) -> DataFrame:
    """(x, mean y, count) per distinct x: what squared-error boosting needs of the rows."""
    return mean_cells(rows, x, y, w).select("x", F.col("value").alias("y"), F.col("n").alias("w"))


def pair_rows(rows: DataFrame, x: str, y: str, w: str | None = None) -> DataFrame:
    """(x, y, count) per distinct pair."""
    return _known(rows, x, y, w).groupBy("x", "y").agg(F.sum("w").alias("w"))


def boost(rows: DataFrame, x: str, y: str, rounds: int = 100, rate: float = 0.1, depth: int = 3, l2: float = 0.0, least: float = 0.0, w: str | None = None) -> Steps:
    """Gradient boosting of squared error from the mean.  With ``l2`` > 0 and ``least`` (weight of a leaf): the second-order form."""
    blocks = Blocks(x_rows(rows, x, y, w))
    sums = blocks.map(_node_sums(lambda x, y, w: (y, w), np.array([-np.inf])), "block node n s first last")
    if not len(sums):
        return Steps()
    model = Steps(values=np.array([sums[:, 3].sum() / sums[:, 2].sum()]))
    for _ in range(rounds):
        tree = grow(blocks, _residual(model), depth, l2, least)
        model = model.plus(tree, rate)
    return model


def _residual(model: Steps) -> Target:
    return lambda x, y, w: (y - model(x), w)


def adaboost(rows: DataFrame, x: str, y: str, rounds: int = 50, rate: float = 1.0, depth: int = 3, w: str | None = None) -> Steps:
    """AdaBoost.R2 with linear loss; the trees take the weights instead of a weighted resample."""
    blocks = Blocks(pair_rows(rows, x, y, w))
    if not blocks.count:
        return Steps()
    learners: list[tuple[Steps, float, float]] = []  # tree, largest error, beta

    def weights(x, y, w):
        for tree, most, beta in learners:
            w = w * beta ** (rate * (1 - np.abs(y - tree(x)) / most))
        return w

    trees, votes = [], []
    for _ in range(rounds):
        tree = grow(blocks, lambda x, y, w: (y, weights(x, y, w)), depth)

        def errors(block, x, y, w, tree=tree):
            w, e = weights(x, y, w), np.abs(y - tree(x))
            return np.array([[block, e.max(), (w * e).sum(), w.sum()]])

        found = blocks.map(errors, "block most we w")
        most = found[:, 1].max()
        loss = found[:, 2].sum() / most / found[:, 3].sum() if most > 0 else 0.0
        if loss >= 0.5 and trees:
            break
        trees.append(tree)
        beta = loss / (1 - loss) if loss < 0.5 else 1.0
        votes.append(rate * math.log(1 / beta) if 0 < beta < 1 else 1.0)
        if loss <= 0 or loss >= 0.5:
            break
        learners.append((tree, most, beta))
    starts = np.unique(np.concatenate([t.starts for t in trees]))
    at = np.append(starts[1:], np.inf)
    each = np.stack([t(at) for t in trees])
    order = np.argsort(each, axis=0, kind="stable")
    reached = np.cumsum(np.array(votes)[order], axis=0) >= 0.5 * sum(votes)
    return Steps(starts, np.take_along_axis(each, order, 0)[reached.argmax(0), np.arange(len(starts))])


# -------------------------------------------------------------------- comparison

#: Ensemble sizes of the usual library defaults (fixed values).
SIZES = {"rfr": 100, "gbr": 100, "xgbr": 100, "adaboost": 50}


def tree_predictions(train: DataFrame, points: DataFrame, x: str, y: str, sizes: dict = SIZES, seed: int = 42) -> DataFrame:
    """(regressor, x, prediction) of every tree learner at the distinct points (column ``x``).  The training
    rows are read once, into a written table of distinct pairs."""
    points = points.select(F.col(x).cast("double").alias("x"))
    own = materialize(pair_rows(train, x, y), "one-feature-pairs"), "x", "y"
    found = {
        "dtr": predict_cells(points, mean_cells(*own, "w")),
        "rfr": predict_forest(points, forest_cells(*own, sizes["rfr"], seed, "w"), sizes["rfr"]),
        "gbr": boost(*own, sizes["gbr"], w="w").predict(points),
        "xgbr": boost(*own, sizes["xgbr"], rate=0.3, depth=6, l2=1.0, least=1.0, w="w").predict(points),
        "adaboost": adaboost(*own, sizes["adaboost"], w="w").predict(points),
    }
    out = None
    for name, frame in found.items():
        frame = frame.select(F.lit(name).alias("regressor"), "x", "prediction")
        out = frame if out is None else out.unionByName(frame)
    return out


def score(predictions: DataFrame, test: DataFrame, x: str, y: str) -> DataFrame:
    """(regressor, n, mse) from the test rows' sums per distinct x: rows are read once, whatever the number of regressors."""
    yd = F.col(y).cast("double")
    sums = test.where(yd.isNotNull()).groupBy(F.col(x).cast("double").alias("x")).agg(F.count("*").alias("n"), F.sum(yd).alias("s"), F.sum(yd * yd).alias("q"))
    p = F.col("prediction")
    error = F.sum(F.col("q") - 2 * p * F.col("s") + F.col("n") * p * p)
    return predictions.join(sums, "x").groupBy("regressor").agg(F.sum("n").alias("n"), (error / F.sum("n")).alias("mse"))
