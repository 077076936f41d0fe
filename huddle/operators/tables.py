"""Reshaping and ranking: position pivot, full-outer merge of keyed frames,
union by name, top-n."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivot_positions(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: Column | str,
    positions: Sequence[str],
    agg: str = "first",
    name: str = "{p}",
) -> DataFrame:
    """One column per listed position.  Listing the values up front keeps
    the pivot a single aggregation (no extra job to discover them)."""
    v = F.col(value) if isinstance(value, str) else value
    fn = {"first": lambda c: F.first(c, ignorenulls=True), "avg": F.avg, "sum": F.sum, "max": F.max}[agg]
    exprs = [fn(F.when(F.col(position) == p, v)).alias(name.format(p=p)) for p in positions]
    return df.groupBy(*keys).agg(*exprs)


def full_outer_merge(frames: Sequence[DataFrame], keys: Sequence[str], method: str = "union") -> DataFrame:
    """Merge frames that are unique on ``keys`` into one row per key present
    in any of them; a frame missing a key contributes NULLs.

    ``method='pair'`` takes frames that repeat a key: the n-th row of a key in
    one frame (ordered by its values) meets the n-th in the others, so every
    row stays and none is multiplied.

    ``method='union'`` stacks the frames by name and aggregates once -- one
    shuffle whatever the number of frames.  ``method='join'`` chains
    full-outer joins (n - 1 shuffles); both give the same rows when every
    frame is unique on ``keys``.
    """
    if method == "join":
        return reduce(lambda a, b: a.join(b, list(keys), "full_outer"), frames)
    if method == "pair":
        ordered = [(f, [c for c in f.columns if c not in keys]) for f in frames]
        nth = [f.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*own))) for f, own in ordered]
        return full_outer_merge(nth, [*keys, "_nth"]).drop("_nth")
    if method != "union":
        raise ValueError(method)
    values = [c for f in frames for c in f.columns if c not in keys]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames aligning columns by name (absent ones NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def top_n(
    df: DataFrame,
    value: str,
    n: int = 15,
    tie_break: Sequence[str] = (),
    positive_only: bool = True,
) -> DataFrame:
    """The ``n`` largest rows by ``value`` (fewer if fewer exist), ties broken
    by ``tie_break``; with ``positive_only`` rows with value <= 0 are dropped
    first.  Planned as TakeOrderedAndProject: each task keeps its own top n,
    so no full sort or shuffle of the input."""
    if positive_only:
        df = df.filter(F.col(value) > 0)
    return df.orderBy(F.col(value).desc(), *[F.col(c).asc() for c in tie_break]).limit(n)


def top_n_per_group(
    df: DataFrame, group: Sequence[str], value: str, n: int, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Top n rows of every group (rank filter; Spark plans a per-group
    limit below the window so each task drops most rows early)."""
    w = Window.partitionBy(*group).orderBy(F.col(value).desc(), *[F.col(c).asc() for c in tie_break])
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
