"""Merkle manifest of a dataset: one digest per row, one tree per source, one root.

A row's leaf is the SHA-256 of its fields, each ``-`` if null, else its UTF-8
byte count, ``:`` and its value.  Every level is made by sibling-shift
self-joins: a node's siblings have computed indices (XOR for binary trees,
slot offsets otherwise), so the nodes equijoin themselves once per shift, and
the rows of slot zero emit the parents from their own digest and the joined
ones.  The sources' subroots, ordered by source, are the leaves of the last
tree.  Proofs come from the top down: a node's path is its own siblings and
its parent's path, so each level joins its parents once and no path is built
from a leaf up.

Keys of all joins are (tree, index) pairs, which are unique: a source with a
third of all rows is spread like any other.  Each level is a written table, a
third of the one below.

Defined results: a null source is a tree of its own, before all others; null
ids come first in their tree; rows that repeat an id are leaves of their own,
ordered by digest; an empty table gives an empty result; columns outside
``fields`` are not read, whatever their names; a text is hashed whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from huddle.llm.shared import positions, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts' concatenation."""
    return F.sha2(F.concat(*parts), 256)


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row's values, in their order."""
    text = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def sibling(at: Column, shift: int, fanout: int) -> Column:
    """The index of the sibling ``shift`` slots further in the run, round its end."""
    if fanout == 2:
        return at.bitwiseXOR(F.lit(1))
    slot = at % fanout
    return at - slot + (slot + shift) % fanout


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Adds the digests of a node's siblings, joined: ``left`` before it, ``right`` behind it."""
    joined, found = nodes, []
    for shift in range(1, fanout):
        other = nodes.select(F.col("tree").alias(f"t{shift}"), F.col("at").alias(f"a{shift}"), F.col("digest").alias(f"d{shift}"))
        meets = (F.col("tree") == F.col(f"t{shift}")) & (sibling(F.col("at"), shift, fanout) == F.col(f"a{shift}"))
        joined = joined.join(other, meets, "left")
        found.append(F.struct(F.col(f"a{shift}").alias("at"), F.col(f"d{shift}").alias("digest")))
    present = F.array_sort(F.filter(F.array(*found), lambda x: x["at"].isNotNull()))
    joined = joined.withColumn("present", present)

    def side(kept):
        return F.array_join(F.transform(F.filter("present", kept), lambda x: x["digest"]), "")

    return joined.select(*nodes.columns, side(lambda x: x["at"] < F.col("at")).alias("left"), side(lambda x: x["at"] > F.col("at")).alias("right"))


def climb(nodes: DataFrame, fanout: int, name: str) -> list[DataFrame]:
    """The written levels of all trees, lowest first.  nodes: tree, at, size (of the tree's level), digest and more."""
    levels = []
    while True:
        levels.append(written(with_siblings(nodes, fanout), name))
        if len(levels) == 1:
            widest = levels[0].agg(F.max("size")).first()[0] or 0
        if widest <= 1:
            return levels
        widest = -(-widest // fanout)
        zero = levels[-1].where((F.col("size") > 1) & (F.col("at") % fanout == 0))
        up = F.floor(F.col("at") / fanout).cast("long"), F.floor((F.col("size") + (fanout - 1)) / fanout).cast("long")
        nodes = zero.select("tree", up[0].alias("at"), up[1].alias("size"), digest(F.col("digest"), F.col("right")).alias("digest"))


def descend(levels: list[DataFrame], above: DataFrame, fanout: int) -> DataFrame:
    """The lowest level with ``path`` (siblings of each level up to the root) and the other columns that
    ``above`` (tree, path, ...) gives to a tree's root."""
    more = [c for c in above.columns if c not in ("tree", "path")]
    below = None
    for level in reversed(levels):
        own = [c for c in level.columns if c not in ("left", "right")]
        tops = level.where("size = 1").join(above, "tree").select(*own, "path", *more)
        if below is not None:
            parents = below.select(F.col("tree").alias("_tree"), F.col("at").alias("_at"), F.col("path").alias("_path"), *more)
            meets = (F.col("tree") == F.col("_tree")) & (F.floor(F.col("at") / fanout).cast("long") == F.col("_at"))
            path = F.concat(F.array(F.struct("left", "right")), "_path")
            tops = level.where("size > 1").join(parents, meets).select(*own, path.alias("path"), *more).unionByName(tops)
        below = tops
    return below


@dataclass
class Manifest:
    """``rows``: id, leaf, found (the leaf of what is there now), tree, path, subroot.
    ``subroots``: tree, digest.  ``levels`` and ``top``: the written nodes of the trees and of the last one.
    ``root``: hex, or None of no rows."""

    rows: DataFrame
    subroots: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]
    root: str | None


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source", fanout: int = 3, found: Mapping[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``.  ``found``: for some fields, the values that a later check finds."""
    found = dict(found or {})
    stored = [F.col(c) for c in fields]
    now = [found.get(c, F.col(c)) for c in fields]
    # the order of trees is that of their names: null first, then by UTF-8 bytes
    tree = F.coalesce(F.concat(F.lit("s"), F.col(group_col).cast("string")), F.lit(""))
    leaves = docs.select(F.col(id_col).alias("id"), tree.alias("tree"), leaf(stored).alias("digest"), (leaf(now) if found else leaf(stored)).alias("found"))
    leaves = written(leaves, "merkle-leaves")
    ranked = positions(leaves, ["tree", "id", "digest", "found"], "merkle-order", "tree")
    levels = climb(ranked.select("tree", F.col("position").alias("at"), F.col("total").alias("size"), "digest", "id", "found"), fanout, "merkle-level")

    tops = levels[0].where("size = 1").select("tree", "digest")
    for level in levels[1:]:
        tops = tops.unionByName(level.where("size = 1").select("tree", "digest"))
    subroots = written(tops, "merkle-subroots")
    ranked = positions(subroots.withColumnRenamed("tree", "name"), ["name"], "merkle-trees")
    top = climb(ranked.select(F.lit("").alias("tree"), F.col("position").alias("at"), F.col("total").alias("size"), "digest", "name"), fanout, "merkle-top")
    root = top[-1].where("size = 1").select("digest").first()
    spark = docs.sparkSession
    ways = descend(top, spark.range(1).select(F.lit("").alias("tree"), F.array().cast(PATH).alias("path")), fanout)
    ways = written(ways.select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot")), "merkle-ways")
    rows = descend(levels, ways, fanout).select("id", F.col("digest").alias("leaf"), "found", "tree", "path", "subroot")
    return Manifest(rows, subroots, levels, top, root["digest"] if root else None)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(path: Column) -> Column:
    """The digest of a path's siblings, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def audit(manifest: Manifest) -> DataFrame:
    """One row per row of the dataset: id, leaf, subroot, root, proof_sha256, folded_root (from the leaf
    found now and the stored path), verified."""
    root = F.lit(manifest.root).cast("string")
    rows = manifest.rows.select("id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), fold(F.col("found"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
