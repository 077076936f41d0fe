"""Exact top-k inner product search with a ball tree per shard.

Vectors are dealt to shards by ball: each goes to the nearest of the centres
that a ball tree over a sample has in its leaves, and a centre with more than
``SHARD_VECTORS`` vectors is dealt on by a hash of the id.  Each shard becomes
a ball tree: nodes with a centre, a radius and, below, leaves of at most
``LEAF`` vectors.  For a query q no vector of a node scores more than
``q . centre + |q| * radius``, nor more than any node above allows.  A query
visits a shard's leaves in falling order of this bound and stops when it is
below the query's current kth score.

The same bound of whole shards, from a small table of their centres and radii,
orders a query's shards.  They are searched in waves of growing number, best
first; after each, the kth score over all shards so far is shared, and a query
goes to no shard whose bound it exceeds.  Queries meet a tree in blocks, and a
tree is sent only to blocks that ask it.  The sample decides where a vector
lies, never what is found.

Components are floor(scale * x) as integers, scores integer inner products;
the arithmetic is in doubles where that is exact, else in 64-bit integers
(scores beyond 64 bits are not supported).

Defined results: vectors that are null, or hold a null, NaN or infinite
component, and rows without an id take no part; a query meets only vectors of
its own length; rows with the query's id are its own and never candidates; a
query row that is repeated asks once; equal scores go to the smaller id; a
query with fewer candidates than k gets all; an empty table gives an empty
result.  Only the id and the vector column are read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, Window

from huddle.llm.shared import side, written

SHARD_VECTORS = 4096
QUERY_BLOCK = 1024
LEAF = 256
#: At most so many centres are sampled for, 16 vectors each, and so many numbers fetched for them.
CENTRES = 1024
SAMPLE_NUMBERS = 4_000_000
#: Shards whose bounds one task computes for a block of queries.
CATALOGUE = 1024
NONE = np.iinfo(np.int64).min


class BallTree:
    """Nodes in the order of their making (parents first), leaves as row ranges."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        parts: list[np.ndarray] = []
        self.centre, self.radius, self.parent, self.rows = [], [], [], []
        todo = [(order, -1)]
        at = 0
        while todo:
            rows, parent = todo.pop()
            points = vectors[rows].astype(float)
            centre = points.mean(axis=0)
            far = np.sqrt(((points - centre) ** 2).sum(axis=1))
            node = len(self.parent)
            self.centre.append(centre)
            self.radius.append(float(far.max(initial=0)) * (1 + 1e-9) + 1e-6)
            self.parent.append(parent)
            if len(rows) > leaf and far.max() > 0:
                # between the point farthest from the centre and the one farthest from that
                a = points[far.argmax()]
                b = points[((points - a) ** 2).sum(axis=1).argmax()]
                side = (points - (a + b) / 2) @ (b - a) > 0
                if side.any() and not side.all():
                    self.rows.append((0, 0))
                    todo += [(rows[side], node), (rows[~side], node)]
                    continue
            self.rows.append((at, at + len(rows)))
            at += len(rows)
            parts.append(rows)
        rows = np.concatenate(parts)
        self.ids, self.vectors = ids[rows], vectors[rows]
        self.centre = np.array(self.centre).reshape(len(self.parent), -1)
        self.leaves = [i for i, (a, b) in enumerate(self.rows) if b > a]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of each query's score in each leaf."""
        norm = np.sqrt((queries.astype(float) ** 2).sum(axis=1))
        own = queries @ self.centre.T + norm[:, None] * np.array(self.radius)[None, :] + 1e-6 * (1 + norm[:, None])
        for i, p in enumerate(self.parent):
            if p >= 0:
                own[:, i] = np.minimum(own[:, i], own[:, p])
        return own[:, self.leaves]

    def search(self, ids: np.ndarray, queries: np.ndarray, kth: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (scores, vector ids) of each query that reach its kth score; NONE fills up."""
        n = len(queries)
        scores, found = np.full((n, k), NONE), np.full((n, k), np.iinfo(np.int64).max)
        least = kth.copy()
        bound = self.bounds(queries)
        order = np.argsort(-bound, axis=1, kind="stable")
        exact = float(np.abs(queries).max(initial=0)) * float(np.abs(self.vectors).max(initial=0)) * max(1, queries.shape[1]) < 2.0**53
        q, v = (queries.astype(float), self.vectors.astype(float)) if exact else (queries, self.vectors)
        for j in range(order.shape[1]):
            leaf = order[:, j]
            active = np.flatnonzero(bound[np.arange(n), leaf] >= least)
            if not len(active):
                break
            by_leaf = active[np.argsort(leaf[active], kind="stable")]
            for group in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
                a, b = self.rows[self.leaves[leaf[group[0]]]]
                got = (q[group] @ v[a:b].T).astype(np.int64)
                got[ids[group][:, None] == self.ids[a:b][None, :]] = NONE
                good = (got >= least[group][:, None]).any(axis=1) & (got.max(axis=1) > NONE)
                group, got = group[good], got[good]
                if not len(group):
                    continue
                s = np.concatenate([scores[group], got], axis=1)
                f = np.concatenate([found[group], np.broadcast_to(self.ids[a:b], got.shape)], axis=1)
                top = np.lexsort((f, -np.maximum(s, NONE + 1)), axis=1)[:, :k]
                scores[group], found[group] = np.take_along_axis(s, top, 1), np.take_along_axis(f, top, 1)
                least[group] = np.maximum(least[group], scores[group][:, -1])
        return scores, found


def _matrix(vectors: pd.Series, kind=np.int64) -> np.ndarray:
    return np.array(vectors.tolist(), kind).reshape(len(vectors), -1)


def dealt(rows: DataFrame, n_rows: int) -> DataFrame:
    """The rows (id, v, dim) with ``cell`` and ``shard``, the shard's number in its cell."""
    cells = min(CENTRES, -(-n_rows // SHARD_VECTORS))
    longest = rows.agg(F.max("dim")).first()[0] or 1
    sample = rows.orderBy(F.xxhash64("id", F.lit(2)), "id").limit(min(16 * cells, max(1, SAMPLE_NUMBERS // max(1, longest)))).toPandas()
    centres = {}
    for dim, some in sample.groupby("dim"):
        tree = BallTree(some["id"].to_numpy(np.int64), _matrix(some["v"]), 16)
        centres[int(dim)] = np.array([tree.centre[i] for i in tree.leaves])

    def nearest(batches):
        for batch in batches:
            cell = np.zeros(len(batch), np.int64)
            for dim in set(batch["dim"]) & set(centres):
                own = (batch["dim"] == dim).to_numpy()
                c = centres[dim]
                cell[own] = (0.5 * (c * c).sum(1)[None, :] - _matrix(batch["v"][own], float) @ c.T).argmin(1)
            yield batch.assign(cell=cell)

    placed = written(rows.mapInPandas(nearest, "id long, v array<long>, dim int, cell long"), "topk-vectors")
    sizes = written(placed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / SHARD_VECTORS).alias("parts")), "topk-cells")
    return placed.join(side(sizes), ["dim", "cell"]).withColumn("shard", F.pmod(F.xxhash64("id"), "parts")).drop("parts")


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, query_every: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query.

    Queries are the rows whose id ``query_every`` divides; candidates are all rows."""
    ok = F.col("v").isNotNull() & F.col("id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(ok)
    rows = rows.select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"), F.size("v").alias("dim"))
    n_rows, n_queries = rows.agg(F.count("*"), F.count(F.when(F.col("id") % query_every == 0, 1))).first()
    blocks = max(1, -(-n_queries // QUERY_BLOCK))

    def plant(shard: pd.DataFrame) -> pd.DataFrame:
        tree = BallTree(shard["id"].to_numpy(np.int64), _matrix(shard["v"]))
        first = shard.iloc[0]
        return pd.DataFrame({"dim": [first["dim"]], "cell": [first["cell"]], "shard": [first["shard"]], "centre": [tree.centre[0]], "radius": [tree.radius[0]], "tree": [pickle.dumps(vars(tree))]})

    key = ["dim", "cell", "shard"]
    placed = dealt(rows, n_rows)
    trees = written(placed.groupBy(*key).applyInPandas(plant, "dim int, cell long, shard long, centre array<double>, radius double, tree binary"), "topk-trees")
    queries = rows.where(F.col("id") % query_every == 0).distinct()
    queries = written(queries.select("dim", F.col("id").alias("q"), "v", F.xxhash64("v").alias("row"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).alias("block")), "topk-queries")

    def bound(shards: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if shards.empty or asked.empty:
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("q", "int64"), ("row", "int64"), ("cell", "int64"), ("shard", "int64"), ("bound", "float64"))})
        q = _matrix(asked["v"], float)
        norm = np.sqrt((q * q).sum(1))
        most = q @ _matrix(shards["centre"], float).T + norm[:, None] * shards["radius"].to_numpy()[None, :] + 1e-6 * (1 + norm[:, None])
        each, all_ = len(shards), len(asked)
        columns = {c: np.repeat(asked[c].to_numpy(), each) for c in ("q", "row")} | {c: np.tile(shards[c].to_numpy(), all_) for c in ("cell", "shard")}
        return pd.DataFrame(columns | {"bound": most.ravel()})

    # a query's shards, best bound first
    chunks = -(-max(1, trees.count()) // CATALOGUE)
    pieces = trees.select(*key, "centre", "radius", F.pmod(F.xxhash64("cell", "shard"), F.lit(chunks)).alias("chunk"))
    pieces = pieces.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    asking = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    by = ["dim", "chunk", "block"]
    pairs = pieces.groupBy(*by).cogroup(asking.groupBy(*by)).applyInPandas(bound, "q long, row long, cell long, shard long, bound double")
    best_first = Window.partitionBy("q", "row").orderBy(F.desc("bound"), "cell", "shard")  # as many rows as there are shards
    pairs = written(pairs.withColumn("turn", F.row_number().over(best_first)), "topk-pairs")
    turns = pairs.agg(F.max("turn")).first()[0] or 0

    def visit(tree: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if tree.empty or asked.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("q", "row", "id", "score")})
        ball = BallTree.__new__(BallTree)
        vars(ball).update(pickle.loads(tree["tree"].iloc[0]))
        ids = asked["q"].to_numpy(np.int64)
        scores, found = ball.search(ids, _matrix(asked["v"]), asked["kth"].to_numpy(np.int64), k)
        at, _ = np.nonzero(scores > NONE)
        return pd.DataFrame({"q": ids[at], "row": asked["row"].to_numpy(np.int64)[at], "id": found[scores > NONE], "score": scores[scores > NONE]})

    best, done, wave = None, 0, 1
    order = Window.partitionBy("q", "row").orderBy(F.desc("score"), "id")
    while done < turns or best is None:
        asked = pairs.where(F.col("turn").between(done + 1, done + wave))
        if best is None:
            asked = asked.withColumn("kth", F.lit(NONE))
        else:
            kth = best.where(F.col("rank") == k).select("q", "row", F.col("score").alias("kth"))
            asked = asked.join(kth, ["q", "row"], "left").withColumn("kth", F.coalesce("kth", F.lit(NONE))).where(F.col("bound") >= F.col("kth"))
        asked = written(asked.drop("bound", "turn").join(queries, ["q", "row"]), f"topk-wave-{done}")
        visited = trees.select(*key, "tree").join(asked.select(*key, "block").distinct().toDF(*key, "block"), key)
        found = visited.groupBy(*key, "block").cogroup(asked.groupBy(*key, "block")).applyInPandas(visit, "q long, row long, id long, score long")
        if best is not None:
            found = found.union(best.select("q", "row", "id", "score"))
        best = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "topk-best")
        done, wave = done + wave, wave * 4
    return best.select(F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
