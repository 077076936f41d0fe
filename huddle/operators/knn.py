"""Exact k-nearest-neighbour regression on one feature, as joins.

For a test value x_t, let p be the number of training rows with x <= x_t
(its insertion point in the training order).  Ordered by distance, then by
closeness to p in the training order, then by x and key, the k nearest
training rows are always among ranks p-k .. p+k-1: on each side of p the
distance never decreases as one walks away.  So every test row probes
exactly 2k ranks through an equi-join -- no cross product, no cap that
could drop a true neighbour -- and picks its k nearest from those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from huddle.operators.ranking import global_positions


def _neighbours(both: DataFrame, k: int) -> DataFrame:
    """k nearest training rows for every test row of ``both``
    (_key, _x, _y, _side: 0 train / 1 test)."""
    both = both.withColumn("_is_train", 1 - F.col("_side"))
    pos = global_positions(both, ["_x", "_side", "_key"], "_is_train", before_col="_train_before")
    ranked_train = pos.filter(F.col("_side") == 0).select(
        F.col("_train_before").alias("_rank"), F.col("_key").alias("n_key"),
        F.col("_x").alias("n_x"), F.col("_y").alias("n_y"))
    probes = pos.filter(F.col("_side") == 1).select(
        F.col("_key").alias("t_key"), F.col("_x").alias("t_x"), F.col("_y").alias("t_y"),
        F.col("_train_before").alias("_p"))
    probes = probes.withColumn("_rank", F.explode(F.sequence(F.col("_p") - k, F.col("_p") + (k - 1))))
    probes = probes.filter(F.col("_rank") >= 0)
    cand = probes.join(ranked_train, "_rank")
    dist = F.abs(F.col("n_x") - F.col("t_x"))
    prox = F.when(F.col("_rank") < F.col("_p"), F.col("_p") - 1 - F.col("_rank")).otherwise(F.col("_rank") - F.col("_p"))
    w = Window.partitionBy("t_key").orderBy(dist, prox, F.col("n_x"), F.col("n_key"))
    ranked = cand.select("t_key", "t_x", "t_y", "n_key", "n_y", dist.alias("distance"),
                         F.row_number().over(w).alias("nn"))
    return ranked.filter(F.col("nn") <= k)


def knn_neighbours(
    train: DataFrame, test: DataFrame, x: str, y: str, key: str, k: int = 5
) -> DataFrame:
    """(test key, neighbour key, neighbour y, distance, order) for the k
    nearest training rows of every test row."""
    tr = train.select(F.col(key).alias("_key"), F.col(x).cast("double").alias("_x"),
                      F.col(y).cast("double").alias("_y"), F.lit(0).alias("_side"))
    te = test.select(F.col(key).alias("_key"), F.col(x).cast("double").alias("_x"),
                     F.lit(None).cast("double").alias("_y"), F.lit(1).alias("_side"))
    return _neighbours(tr.unionByName(te), k)


def _predict(nb: DataFrame, key: str, x: str, with_actual: bool = False) -> DataFrame:
    extra = [F.first("t_y").alias("actual")] if with_actual else []
    return nb.groupBy(F.col("t_key").alias(key)).agg(
        F.first("t_x").alias(x), F.avg("n_y").alias("prediction"), F.count("*").alias("neighbours"), *extra)


def knn_regress(train: DataFrame, test: DataFrame, x: str, y: str, key: str, k: int = 5) -> DataFrame:
    """(key, x, prediction): the mean y of the k nearest training rows (of
    all of them if there are fewer than k)."""
    return _predict(knn_neighbours(train, test, x, y, key, k), key, x)


def knn_regress_split(df: DataFrame, x: str, y: str, key: str, is_test: str, k: int = 5) -> DataFrame:
    """:func:`knn_regress` for one frame holding both sides (``is_test``
    true on test rows): one scan of the input instead of one per side.  The
    test rows' own ``y`` is returned as ``actual`` (it never takes part in
    the neighbour search, which reads training rows only)."""
    both = df.select(F.col(key).alias("_key"), F.col(x).cast("double").alias("_x"),
                     F.col(y).cast("double").alias("_y"), F.col(is_test).cast("int").alias("_side"))
    return _predict(_neighbours(both, k), key, x, with_actual=True)
