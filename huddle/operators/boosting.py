"""Second-order gradient boosting of squared error on many features.

Features are cut into at most ``bins`` quantile bins; a missing value keeps a
bin of its own.  A tree grows level by level from one aggregate: the sums of
gradients and hessians per (node, feature, bin).  Each split is the best over
all features and bins, with the missing values on the side that gains more;
leaves are -G / (H + l2).  Columns are drawn once per tree, rows by a hash of
their key, so a fit gives the same trees whatever the partitioning.

The sums come from one of two places, behind the same loop: from a table,
one Spark aggregate a level (tasks send at most nodes x features x bins
sums); or, for a training set below ``LOCAL`` cells, from its arrays, inside
the task that fits a (setting, fold) pair of a search.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huddle.session import materialize

#: Cells (rows x features, two bytes each) of a training set that one task may hold.
LOCAL = 50_000_000
#: Rounds after which the margins of a table are written anew instead of summed up from the trees.
REFRESH = 20


@dataclass(frozen=True)
class Setting:
    """Library-like names and defaults (fixed values)."""

    n_estimators: int = 100
    learning_rate: float = 0.3
    max_depth: int = 6
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    seed: int = 42

    @classmethod
    def of(cls, values: dict) -> Setting:
        whole = {"n_estimators", "max_depth", "seed"}
        return cls(**{k: int(v) if k in whole else float(v) for k, v in values.items()})


@dataclass
class Tree:
    """Nodes by number; feature -1 marks a leaf."""

    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    missing_left: list = field(default_factory=lambda: [False])
    left: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool, gain: float) -> None:
        self.feature[node], self.cut[node], self.missing_left[node], self.gain[node], self.left[node] = feature, cut, missing_left, gain, len(self.feature)
        for values, new in ((self.feature, -1), (self.cut, 0), (self.missing_left, False), (self.left, 0), (self.value, 0.0), (self.gain, 0.0)):
            values.extend([new, new])

    def route(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """The node that each row ends in; children are left and left + 1."""
        feature, cut, to_left, left = (np.array(x) for x in (self.feature, self.cut, self.missing_left, self.left))
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(rows):
            rows = rows[feature[node[rows]] >= 0]
            at = node[rows]
            b = bins[rows, feature[at]]
            goes = np.where(b == missing, to_left[at], b <= cut[at])
            node[rows] = left[at] + ~goes
        return node

    def predict(self, bins: np.ndarray, missing: int) -> np.ndarray:
        return np.array(self.value)[self.route(bins, missing)]


def sums_of(bins: np.ndarray, node: np.ndarray, gradient: np.ndarray, nodes: int, width: int) -> np.ndarray:
    """[node, feature, bin, (gradient, rows)] of rows with a node of 0 or more."""
    n_features = bins.shape[1]
    inside = node >= 0
    if not inside.all():
        bins, node, gradient = bins[inside], node[inside], gradient[inside]
    out = np.zeros((nodes, n_features, width, 2))
    for f in range(n_features):
        key = node * width + bins[:, f]
        out[:, f, :, 0] = np.bincount(key, gradient, nodes * width).reshape(nodes, width)
        out[:, f, :, 1] = np.bincount(key, minlength=nodes * width).reshape(nodes, width)
    return out


def best_splits(sums: np.ndarray, columns: np.ndarray, l2: float, least: float) -> list:
    """Per node ((gradient, rows), None or (feature, cut, missing left, gain), (gradient, rows) left of it).  The
    last bin is that of missing values."""
    out, part = [], sums[:, columns]
    known, absent = np.cumsum(part[:, :, :-1], 2), part[:, :, -1:]
    for k, (g, h) in enumerate(part[:, 0].sum(1)):
        sides = np.stack([known[k], known[k] + absent[k]], 2)  # missing values right, left
        gl, hl = sides[..., 0], sides[..., 1]
        gr, hr = g - gl, h - hl
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gl * gl / (hl + l2) + gr * gr / (hr + l2) - g * g / (h + l2)
        gain = np.where((hl >= least) & (hr >= least) & (hl > 0) & (hr > 0), gain, -np.inf)
        # ties go to the smaller feature and bin, and to missing values on the right
        f, cut, side = np.unravel_index(int(np.argmax(gain)), gain.shape)
        best = float(gain[f, cut, side])
        split = (int(columns[f]), int(cut), bool(side), best) if best > 1e-6 else None
        out.append(((g, h), split, (gl[f, cut, side], hl[f, cut, side])))
    return out


def grow(level_sums: Callable[[Tree, list], np.ndarray], setting: Setting, columns: np.ndarray) -> Tree:
    """A tree of at most ``max_depth`` levels, each from the sums of its open nodes."""
    tree, open_ = Tree(), [0]

    def leaf(g, h):
        return -g / (h + setting.reg_lambda) * setting.learning_rate if h + setting.reg_lambda else 0.0

    for _ in range(setting.max_depth):
        born = []
        for node, ((g, h), split, (gl, hl)) in zip(open_, best_splits(level_sums(tree, open_), columns, setting.reg_lambda, setting.min_child_weight), strict=True):
            tree.value[node] = leaf(g, h)
            if split:
                tree.split(node, *split)
                left = tree.left[node]
                tree.value[left], tree.value[left + 1] = leaf(gl, hl), leaf(g - gl, h - hl)
                born += [left, left + 1]
        open_ = born
        if not open_:
            break
    return tree


def drawn_columns(setting: Setting, n_features: int, number: int) -> np.ndarray:
    """The columns of a tree, drawn once for all its nodes."""
    k = max(1, int(n_features * setting.colsample_bytree))
    return np.sort(np.random.default_rng([setting.seed, number]).permutation(n_features)[:k])


def drawn_rows(setting: Setting, row: np.ndarray, number: int) -> np.ndarray:
    """Which rows (64-bit hashes of their keys) a tree learns from."""
    if setting.subsample >= 1:
        return np.ones(len(row), bool)
    with np.errstate(over="ignore"):
        z = row.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(number + 1 + (setting.seed << 20))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)) / 2.0**53 < setting.subsample


@dataclass
class Booster:
    features: list[str]
    cuts: list[np.ndarray]
    base: float
    trees: list[Tree] = field(default_factory=list)

    @property
    def missing(self) -> int:
        return max((len(c) for c in self.cuts), default=0) + 1

    def binned(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Bins of raw columns (NaN: missing)."""
        out = np.empty((len(columns[0]), len(columns)), np.uint16)
        for f, (x, cuts) in enumerate(zip(columns, self.cuts, strict=True)):
            out[:, f] = np.where(np.isnan(x), self.missing, np.searchsorted(cuts, x, side="left"))
        return out

    def margin(self, bins: np.ndarray, trees: Sequence[Tree] | None = None, start=None) -> np.ndarray:
        out = np.full(len(bins), self.base) if start is None else np.array(start, float)
        for tree in self.trees if trees is None else trees:
            out += tree.predict(bins, self.missing)
        return out

    def gains(self) -> dict[str, float]:
        """Mean gain of each feature's splits, as shares of their sum."""
        total, times = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in self.trees:
            for f, gain in zip(tree.feature, tree.gain, strict=True):
                if f >= 0:
                    total[f] += gain
                    times[f] += 1
        mean = total / np.maximum(times, 1)
        return dict(zip(self.features, (mean / mean.sum() if mean.sum() else mean).tolist(), strict=True))

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Adds the prediction; null features are missing values."""
        model = self

        @F.pandas_udf("double")
        def predict(rows: pd.DataFrame) -> pd.Series:
            raw = [rows[c].to_numpy(dtype=float, na_value=np.nan) for c in model.features]
            return pd.Series(model.margin(model.binned(raw)))

        return df.withColumn(output, predict(F.struct(*[F.col(c).cast("double").alias(c) for c in self.features])))



def cut_points(df: DataFrame, features: Sequence[str], bins: int = 256) -> list[np.ndarray]:
    """Ascending cut values of each feature, all in one aggregate: quantiles, each a value of the data."""
    shares = [i / bins for i in range(1, bins + 1)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(c) for c in features]).first()
    return [np.unique(np.array([v for v in found[c] if v is not None], float)) if found[c] else np.zeros(0) for c in features]


def binned_table(df: DataFrame, features: Sequence[str], label: str, key: Sequence[str], cuts: list[np.ndarray], keep: Sequence[str] = ()) -> DataFrame:
    """Written rows: bins (uint16 bytes), y, row (hash of the key), margin, and the columns to keep."""
    empty = Booster(list(features), cuts, 0.0)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            raw = [batch.column(f"f{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(len(empty.features))]
            codes = np.ascontiguousarray(empty.binned(raw)).view(np.uint8).reshape(batch.num_rows, -1)
            packed = pa.array([x.tobytes() for x in codes], pa.binary())
            rest = [batch.column(c) for c in ("y", "row", *keep)]
            yield pa.RecordBatch.from_arrays([packed, *rest], names=["bins", "y", "row", *keep])

    picked = df.where(F.col(label).isNotNull()).select(
        *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)],
        F.col(label).cast("double").alias("y"), F.xxhash64(*[F.col(c) for c in key]).alias("row"), *keep,
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in picked.schema if f.name in keep)
    return materialize(picked.mapInArrow(run, "bins binary, y double, row long" + (f", {kinds}" if kinds else "")), "boosting-rows")


def _matrix(column: pa.Array, n_features: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, n_features)


def fit_arrays(model: Booster, bins: np.ndarray, y: np.ndarray, row: np.ndarray, setting: Setting) -> Iterator[Tree]:
    """The trees of a fit, one by one; ``model`` holds them as well."""
    margin = np.full(len(y), model.base)
    width = model.missing + 1
    for number in range(setting.n_estimators):
        gradient, taken = margin - y, drawn_rows(setting, row, number)
        columns = drawn_columns(setting, len(model.features), number)

        def level_sums(tree, open_, gradient=gradient, taken=taken):
            node = tree.route(bins, model.missing)
            place = np.full(len(tree.feature), -1)
            place[open_] = np.arange(len(open_))
            return sums_of(bins, np.where(taken, place[node], -1), gradient, len(open_), width)

        tree = grow(level_sums, setting, columns)
        margin += tree.predict(bins, model.missing)
        model.trees.append(tree)
        yield tree


def fit_table(model: Booster, table: DataFrame, setting: Setting) -> Booster:
    """The same trees from a binned table: one aggregate a level."""
    width, n_features = model.missing + 1, len(model.features)
    table, summed = table.withColumn("margin", F.lit(float(model.base))), 0
    for number in range(setting.n_estimators):
        if number - summed >= REFRESH:
            table, summed = materialize(_moved(table, model, model.trees[summed:]), "boosting-margins"), number
        recent = list(model.trees[summed:])
        columns = drawn_columns(setting, n_features, number)

        def level_sums(tree, open_, table=table, recent=recent, number=number):
            place = np.full(len(tree.feature), -1)
            place[open_] = np.arange(len(open_))

            def run(batches):
                total = np.zeros((len(open_), n_features, width, 2))
                for batch in batches:
                    bins = _matrix(batch.column("bins"), n_features)
                    margin = model_.margin(bins, recent, batch.column("margin").to_numpy())
                    gradient = margin - batch.column("y").to_numpy()
                    node = np.where(drawn_rows(setting, batch.column("row").to_numpy(), number), place[tree.route(bins, model_.missing)], -1)
                    total += sums_of(bins, node, gradient, len(open_), width)
                at = np.flatnonzero(total[..., 1])
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[..., 0].ravel()[at]), pa.array(total[..., 1].ravel()[at])], names=["cell", "g", "h"])

            model_ = replace(model, trees=[])
            found = table.select("bins", "y", "row", "margin").mapInArrow(run, "cell long, g double, h double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()  # at most nodes x features x bins rows
            out = np.zeros((len(open_) * n_features * width, 2))
            out[found.column("cell").to_numpy()] = np.stack([found.column("g").to_numpy(), found.column("h").to_numpy()], 1)
            return out.reshape(len(open_), n_features, width, 2)

        model.trees.append(grow(level_sums, setting, columns))
    return model


def _moved(table: DataFrame, model: Booster, trees: list[Tree]) -> DataFrame:
    """The table with its margins moved on by some trees."""
    names, n_features, bare = table.columns, len(model.features), replace(model, trees=[])

    def run(batches):
        for batch in batches:
            margin = bare.margin(_matrix(batch.column("bins"), n_features), trees, batch.column("margin").to_numpy())
            yield batch.set_column(names.index("margin"), "margin", pa.array(margin))

    return table.mapInArrow(run, table.schema)


def _base(table: DataFrame) -> tuple[int, float]:
    n, mean = table.agg(F.count("*"), F.avg("y")).first()
    return n, mean or 0.0


def fit(df: DataFrame, features: Sequence[str], label: str, key: Sequence[str], setting: Setting, bins: int = 256) -> Booster:
    """A model of all rows with a label."""
    cuts = cut_points(df.where(F.col(label).isNotNull()), features, bins)
    table = binned_table(df, features, label, key, cuts)
    n, mean = _base(table)
    model = Booster(list(features), cuts, mean)
    if n * len(features) > LOCAL:
        return fit_table(model, table, setting)
    return _fit_in_task(model, table, setting)


def _fit_in_task(model: Booster, table: DataFrame, setting: Setting) -> Booster:
    rows = table.select("bins", "y", "row").toArrow()  # below LOCAL cells
    bins = _matrix(rows.column("bins"), len(model.features))
    for _ in fit_arrays(model, bins, rows.column("y").to_numpy(), rows.column("row").to_numpy(), setting):
        pass
    return model


# -------------------------------------------------------------------- search


def settings_of(grid: dict) -> list[dict]:
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


SCORES = "rest string, fold int, rounds int, n long, squared_error double"


def search(df: DataFrame, features: Sequence[str], label: str, key: Sequence[str], fold: Column, grid: dict, store: str, folds: int = 5, bins: int = 256, together: int = 64) -> DataFrame:
    """(setting, the grid's columns, mean_rmse) over the folds, one row per setting.

    One fit scores all numbers of rounds of the grid on its way, so 243 settings of three such numbers
    take 81 fits a fold.  Finished (setting, fold) scores are appended to the table ``store``,
    ``together`` at a time; a search over a store that holds some of them does the others only."""
    spark = df.sparkSession
    rounds = sorted({int(r) for r in grid["n_estimators"]})
    rest = {k: v for k, v in grid.items() if k != "n_estimators"}
    try:
        done = {(r["rest"], r["fold"], r["rounds"]) for r in spark.read.schema(SCORES).parquet(store).select("rest", "fold", "rounds").collect()}  # settings x folds
    except Exception as missing:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        done = set()
    named = {_name(s): s for s in settings_of(rest)}
    todo = [(name, k) for name in named for k in range(folds) if any((name, k, r) not in done for r in rounds)]
    if todo:
        have = df.where(F.col(label).isNotNull()).withColumn("_fold", fold.cast("int"))
        cuts = cut_points(have, features, bins)
        table = binned_table(have, features, label, key, cuts, keep=["_fold"])
        n, _ = _base(table)
        empty = Booster(list(features), cuts, 0.0)
        if n * len(features) <= LOCAL:
            _search_tasks(empty, table, named, todo, rounds, store, together)
        else:
            _search_table(empty, table, named, todo, rounds, store)
    scores = spark.read.schema(SCORES).parquet(store).where(F.col("rest").isin(list(named)) & F.col("rounds").isin(rounds) & (F.col("fold") < folds))
    scores = scores.groupBy("rest", "fold", "rounds").agg(F.sqrt(F.first("squared_error") / F.first("n")).alias("rmse"))
    mean = scores.groupBy("rest", "rounds").agg(F.avg("rmse").alias("mean_rmse"))
    order = [(i, _name({k: v for k, v in s.items() if k != "n_estimators"}), int(s["n_estimators"]), *[float(s[k]) for k in grid]) for i, s in enumerate(settings_of(grid))]
    listed = spark.createDataFrame(order, "setting int, rest string, rounds int, " + ", ".join(f"{k} double" for k in grid))
    return listed.join(mean, ["rest", "rounds"]).select("setting", *grid, "mean_rmse")


def _name(setting: dict) -> str:
    return ",".join(f"{k}={float(setting[k]):g}" for k in sorted(setting))


def _search_tasks(empty: Booster, table: DataFrame, named: dict, todo: list, rounds: list, store: str, together: int) -> None:
    """One task per (setting, fold); the training set, below LOCAL cells, is broadcast."""
    spark = table.sparkSession
    rows = table.toArrow()
    data = spark.sparkContext.broadcast((_matrix(rows.column("bins"), len(empty.features)), rows.column("y").to_numpy(), rows.column("row").to_numpy(), rows.column("_fold").to_numpy()))

    def run(batches):
        bins, y, row, fold = data.value
        for batch in batches:
            for name, k in zip(batch.column("rest").to_pylist(), batch.column("fold").to_pylist(), strict=True):
                setting = replace(Setting.of(named[name]), n_estimators=rounds[-1])
                out = fold == k
                model = replace(empty, base=float(y[~out].mean()) if (~out).any() else 0.0, trees=[])
                margin, found = np.full(int(out.sum()), model.base), []
                for number, tree in enumerate(fit_arrays(model, bins[~out], y[~out], row[~out], setting), 1):
                    margin += tree.predict(bins[out], model.missing)
                    if number in rounds:
                        found.append((name, k, number, len(margin), float(((margin - y[out]) ** 2).sum())))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.float64()), strict=True)], names=["rest", "fold", "rounds", "n", "squared_error"])

    for i in range(0, len(todo), together):
        work = todo[i : i + together]
        items = spark.createDataFrame(work, "rest string, fold int").repartitionByRange(len(work), "rest", "fold")
        items.mapInArrow(run, SCORES).write.mode("append").parquet(store)
    data.unpersist()


def _search_table(empty: Booster, table: DataFrame, named: dict, todo: list, rounds: list, store: str) -> None:
    """The same scores from fits on the table, one after the other, each distributed."""
    spark = table.sparkSession
    for name, k in todo:
        setting = replace(Setting.of(named[name]), n_estimators=rounds[-1])
        train, test = table.where(F.col("_fold") != k), table.where(F.col("_fold") == k)
        model = fit_table(replace(empty, base=_base(train)[1], trees=[]), train, setting)
        found, test = [], test.withColumn("margin", F.lit(float(model.base)))
        for lo, hi in zip([0, *rounds[:-1]], rounds, strict=True):
            test = materialize(_moved(test, model, model.trees[lo:hi]), "boosting-scores")
            n, e = test.agg(F.count("*"), F.sum((F.col("margin") - F.col("y")) ** 2)).first()
            found.append((name, k, hi, n, float(e or 0.0)))
        spark.createDataFrame(found, SCORES).write.mode("append").parquet(store)
