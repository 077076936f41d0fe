"""Ordered boosting with symmetric trees on one feature.

A symmetric tree splits a whole level by one border, the one that gains most
over all leaves together.  In ordered boosting a row never meets a model that
was fitted on it: rows lie in a seeded order (a hash of their key), cut into
blocks that each hold as many rows as all before together, and beside the
model of all rows there is one for each block, fitted on the blocks before.
Trees are chosen by the residuals that the rows have under their own block's
model; each model takes its leaves from its own rows.

For squared error all this needs of the rows is, per (bin of the feature,
block), their number and the sum of their labels.  One aggregate gives that;
it has at most (borders + 1) x ``BLOCKS`` rows whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huddle.operators.onefeature import Steps

#: The first block holds one row of 2^31.
BLOCKS = 32


def block_of(key: str, seed: int) -> Column:
    """The block of a row: the last one holds half of all rows, each before it half of the next."""
    u = (F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 52)) + 1) / F.lit(float(1 << 52))
    return F.greatest(F.lit(BLOCKS - 1) - F.floor(-F.log2(u)), F.lit(0)).cast("int")


def borders_of(rows: DataFrame, x: str, most: int) -> np.ndarray:
    """The middles between neighbouring values when these are few, else middles at quantiles."""
    values = rows.groupBy(x).agg(F.count("*").alias("n")).orderBy(x).limit(most + 2).toArrow().column(x).to_numpy()
    if len(values) > most + 1:
        shares = [i / (most + 1) for i in range(1, most + 1)]
        cuts = rows.agg(F.percentile_approx(x, shares, 100 * most)).first()[0]
        return np.unique(np.array(cuts, float))
    return (values[1:] + values[:-1]) / 2


def block_sums(rows: DataFrame, x: str, y: str, block: str, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[bin, block] numbers of rows and sums of labels; a bin ends with its border included."""
    bins = len(borders) + 1

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros((2, bins * BLOCKS))
        for batch in batches:
            xs, ys, bs = (batch.column(c).to_numpy(zero_copy_only=False) for c in (x, y, block))
            cell = np.searchsorted(borders, xs, side="left") * BLOCKS + bs
            total[0] += np.bincount(cell, minlength=bins * BLOCKS)
            total[1] += np.bincount(cell, ys, bins * BLOCKS)
        met = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[0, met]), pa.array(total[1, met])], names=["cell", "n", "s"])

    found = rows.mapInArrow(run, "cell int, n double, s double").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toArrow()
    n, s = np.zeros(bins * BLOCKS), np.zeros(bins * BLOCKS)
    n[found.column("cell").to_numpy()], s[found.column("cell").to_numpy()] = found.column("n").to_numpy(), found.column("s").to_numpy()
    return n.reshape(bins, BLOCKS), s.reshape(bins, BLOCKS)


def symmetric_cuts(n: np.ndarray, g: np.ndarray, depth: int, l2: float) -> np.ndarray:
    """Bins behind which the levels of a tree split, from the number and residual sum per bin."""
    tn, tg = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(g))
    cuts = np.zeros(0, np.int64)

    def part(a, b):
        return (tg[b] - tg[a]) ** 2 / (tn[b] - tn[a] + l2)

    for _ in range(depth):
        free = np.setdiff1d(np.arange(1, len(n)), cuts)
        if not len(free):
            break
        edges = np.concatenate([[0], cuts, [len(n)]])
        at = np.searchsorted(edges, free)
        low, high = edges[at - 1], edges[at]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.nan_to_num(part(low, free) + part(free, high) - part(low, high))
        best = int(np.argmax(gain))  # ties go to the smaller border
        if gain[best] <= 1e-12:
            break
        cuts = np.sort(np.append(cuts, free[best]))
    return cuts


def ordered_boost(rows: DataFrame, x: str, y: str, key: str, rounds: int = 1000, rate: float = 0.03, depth: int = 6, l2: float = 3.0, borders: int = 254, seed: int = 42) -> Steps:
    """The model of all rows.  Sizes are the usual library's (fixed values), with its plain rate; leaves and splits
    are scored by squared gain, without its random noise and row weights.  Rows without x, y or key take no part."""
    known = rows.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), F.col(key).alias("key")).dropna()
    cuts = borders_of(known, "x", borders)
    n, s = block_sums(known.select("x", "y", block_of("key", seed).alias("block")), "x", "y", "block", cuts)
    if not n.sum():
        return Steps()
    start = s.sum() / n.sum()
    # model j knows the blocks before j; the last one knows all
    n_before, s_before = (np.concatenate([np.zeros((len(a), 1)), np.cumsum(a, 1)], 1) for a in (n, s))
    fitted = np.full((len(n), BLOCKS + 1), start)
    for _ in range(rounds):
        own = (s - n * fitted[:, :-1]).sum(1)
        edges = np.concatenate([[0], symmetric_cuts(n.sum(1), own, depth, l2)]).astype(int)
        g = np.add.reduceat(s_before - n_before * fitted, edges, 0)
        h = np.add.reduceat(n_before, edges, 0)
        leaf = np.divide(g, h + l2, out=np.zeros_like(g), where=h + l2 > 0)
        fitted += rate * np.repeat(leaf, np.diff(np.append(edges, len(n))), 0)
    return Steps(np.append(-np.inf, cuts), fitted[:, -1])
