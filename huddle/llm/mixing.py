"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets.  Sources in code point order (null last) weigh ``weights``, repeated;
they share ``budget`` times all words by weight.  A target stops at
``max_epochs`` times its source's words; the excess is shared again by weight
until no target is above its stop.

Mix.  Documents are dealt to shards of about ``SHARD_WORDS`` words.  A source is cut
into pieces of about ``PIECE_WORDS`` words by a hash of the documents' ids, and a
piece lies in one shard, so that also a thin source has many blocks where it has
any and no quota is lost to rounding.  In a shard each source's words, in seeded order of its documents,
are cut into equal blocks of about ``BLOCK_WORDS`` words.  The shard's seats
are allotted to the sources by highest quotients v / (2s + 1), v being a
source's blocks times target / size, which gives each an integer quota of
blocks; a block comes up at most ``max_epochs`` times.  All blocks are taken
as often as the quota goes round; a seeded choice takes the rest once more.

Defined results: a null or empty text has no word and takes none; a null
source is a source of its own; rows with a null id are dealt by their text; repeated
rows are mixed one by one; a very long text is counted whole and stays in one shard; an empty table gives an empty result.  Reruns
agree.  A hot source is spread over all shards.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pandas as pd
import pyspark.sql.functions as F
import pyspark.sql.types as T
from pyspark.sql import DataFrame, Window

from huddle.llm.shared import numbered, written

WORD = r"[^\x20\x09-\x0D]+"
SHARD_WORDS = 65_536
SHARD_ROWS = 2_000
BLOCK_WORDS = 16
#: Words, and rows, of a source that lie in one shard; and blocks of a source in a shard, if it has the words.
PIECE_WORDS, PIECE_ROWS, LEAST_BLOCKS = 4_096, 250, 64


def source_targets(sizes: DataFrame, weights=(5, 2, 1), budget: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """(source, source_size, source_rows, target), one row per source.  sizes: rows of source and size."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # one row per source
    total = total.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights) + 1))
    total = written(total, "mixing-sources")
    goal = (total.agg(F.sum("source_size")).first()[0] or 0) * budget
    stop = F.col("source_size") * float(max_epochs)
    level = 0.0
    while True:
        capped = F.col("weight") * level >= stop
        row = total.agg(F.sum(F.when(capped, stop)).alias("full"), F.sum(F.when(~capped, F.col("weight"))).alias("open"), F.count(F.when(capped, 1)).alias("n")).first()
        if not row["open"]:
            break
        new = (goal - (row["full"] or 0.0)) / row["open"]
        if new <= level:
            break
        level = new
    return total.select("source", "source_size", "source_rows", F.least(F.col("weight") * level, stop).alias("target"))


def highest_quotients(value: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Integer quotas of round(sum of value) seats by highest quotients value / (2 seats + 1), at most ``most`` each."""
    seats = int(min(round(float(value.sum())), most.sum()))
    quota = np.minimum(np.maximum(np.floor(value - 1), 0).astype(np.int64), most)
    heap = [(-value[i] / (2 * quota[i] + 1), i) for i in range(len(value)) if quota[i] < most[i] and value[i] > 0]
    heapq.heapify(heap)
    for _ in range(seats - int(quota.sum())):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        quota[i] += 1
        if quota[i] < most[i]:
            heapq.heappush(heap, (-value[i] / (2 * quota[i] + 1), i))
    return quota


def take_blocks(size: np.ndarray, quota: int, blocks: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """Block bounds in the words of consecutive documents, and how often each block is taken."""
    bounds = np.arange(blocks + 1, dtype=np.int64) * int(size.sum()) // blocks
    times = np.full(blocks, quota // blocks, np.int64)
    times[rng.permutation(blocks)[: quota % blocks]] += 1
    return bounds, times


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=(5, 2, 1), budget: float = 1.5, max_epochs: int = 2, seed: int = 7, carry: tuple[str, ...] = (), spans: bool = False, cut: bool = False) -> DataFrame:
    """One row per input row: _id, _size, _source_size, _target, _taken, the carried columns and, if
    asked for, _spans: (start, stop, times) of the words that the mix takes.

    With ``cut`` the mix itself, in the carried columns: a row for each time that words of a document are
    taken, ``text_col`` holding the words taken then.  They are cut where they are chosen, so a task needs
    one Python worker and not two."""
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    kept = [F.col(c) for c in carry]
    mark = F.when(F.col(id_col).isNull(), F.xxhash64(F.col(text_col).cast("string"))).otherwise(F.col(id_col).cast("long"))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(source_col).cast("string").alias("_source"), size.alias("_size"), mark.alias("_mark"), *kept)
    if not carry:
        rows = written(rows, "mixing-sizes")
        sizes = rows.select(F.col("_source").alias("source"), F.col("_size").alias("size"))
    else:
        sizes = written(docs.select(F.col(source_col).cast("string").alias("source"), size.alias("size")), "mixing-sizes")
    targets = source_targets(sizes, weights, budget, max_epochs).select(F.col("source").alias("_of"), F.col("source_size").alias("_source_size"), F.col("source_rows").alias("_source_rows"), F.col("target").alias("_target"))
    targets = written(targets, "mixing-targets")
    n_words, n_rows = sizes.agg(F.sum("size"), F.count("*")).first()
    shards = max(1, -(-(n_words or 0) // SHARD_WORDS), -(-n_rows // SHARD_ROWS))
    rows = rows.join(targets, rows["_source"].eqNullSafe(targets["_of"])).drop("_of")
    pieces = F.greatest(F.ceil(F.col("_source_size") / PIECE_WORDS), F.ceil(F.col("_source_rows") / PIECE_ROWS)).cast("long")
    piece = F.pmod(F.xxhash64(F.lit(seed), "_mark", "_size"), pieces)
    rows = rows.withColumn("_order", F.xxhash64("_mark", "_size", F.lit(seed))).withColumn("_shard", F.pmod(F.xxhash64(F.lit(seed), "_source", piece), F.lit(shards))).drop("_mark", "_source_rows")
    out = T.StructType(
        [
            *[T.StructField(n, T.LongType()) for n in ("_id", "_size", "_source_size")],
            T.StructField("_target", T.DoubleType()),
            T.StructField("_taken", T.LongType()),
            T.StructField("_spans", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "stop", "times")]))),
            *[docs.schema[c] for c in carry],
        ]
    )

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["_source", "_order", "_id"], na_position="last", kind="stable").reset_index(drop=True)
        size = shard["_size"].to_numpy(np.int64)
        name = shard["_source"].map(lambda s: "\x00" if s is None or s != s else "=" + s)
        groups = [g.to_numpy() for _, g in shard.groupby(name, sort=False).groups.items()]
        words = np.array([size[g].sum() for g in groups])
        blocks = np.maximum(np.minimum(words, LEAST_BLOCKS), np.rint(words / BLOCK_WORDS)).astype(np.int64)
        whole = np.array([shard["_source_size"].iloc[g[0]] for g in groups], float)
        goal = np.array([shard["_target"].iloc[g[0]] for g in groups], float)
        quota = highest_quotients(blocks * np.divide(goal, whole, out=np.zeros(len(groups)), where=whole > 0), max_epochs * blocks)
        taken, found = np.zeros(len(shard), np.int64), [[] for _ in range(len(shard))]
        for g, q, b in zip(groups, quota, blocks, strict=True):
            if not b:
                continue
            rng = np.random.default_rng([seed, int(shard["_shard"].iloc[0]), zlib.crc32(name.iloc[g[0]].encode())])
            bounds, times = take_blocks(size[g], int(q), int(b), rng)
            ends = np.cumsum(size[g])
            begins = ends - size[g]
            sums = np.concatenate([[0], np.cumsum(np.diff(bounds) * times)])

            def upto(x, bounds=bounds, times=times, sums=sums):
                k = np.minimum(np.searchsorted(bounds, x, side="right") - 1, len(times) - 1)
                return sums[k] + (x - bounds[k]) * times[k]

            taken[g] = upto(ends) - upto(begins)
            if spans or cut:
                for row, lo, hi in zip(g, begins, ends, strict=True):
                    first = np.searchsorted(bounds, lo, side="right") - 1
                    for k in range(first, np.searchsorted(bounds, hi, side="left")):
                        a, z = max(lo, bounds[k]) - lo, min(hi, bounds[k + 1]) - lo
                        if times[k] and z > a:
                            if found[row] and found[row][-1]["stop"] == a and found[row][-1]["times"] == times[k]:
                                found[row][-1]["stop"] = int(z)
                            else:
                                found[row].append({"start": int(a), "stop": int(z), "times": int(times[k])})
        if cut:
            texts = [cut_text(t if isinstance(t, str) else None, s) for t, s in zip(shard[text_col], found, strict=True)]
            mixed = shard[list(carry)].iloc[np.repeat(np.arange(len(shard)), [len(x) for x in texts])].reset_index(drop=True)
            mixed[text_col] = pd.Series([t for x in texts for t in x], dtype=object)
            return mixed
        return pd.DataFrame({"_id": shard["_id"].astype("Int64"), "_size": size, "_source_size": shard["_source_size"], "_target": shard["_target"], "_taken": taken, "_spans": found if spans else None, **{c: shard[c] for c in carry}})

    if cut:
        out = T.StructType([docs.schema[c] for c in carry])
    return rows.groupBy("_shard").applyInPandas(run, out)


def cut_text(text: str | None, spans: list[dict]) -> list[str]:
    """The text of each time that the mix takes words of a document."""
    words = [(m.start(), m.end()) for m in re.finditer(WORD, text or "")]
    turns = max((s["times"] for s in spans), default=0)
    return ["\n".join(text[words[s["start"]][0] : words[s["stop"] - 1][1]] for s in spans if s["times"] > turn) for turn in range(turns)]


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix as documents, all columns: a row for each time that words of a document are taken,
    its text being the words taken then."""
    rows, name = numbered(docs)
    mixed = mix_sources(rows, name[id_col], name[text_col], name[source_col], carry=tuple(rows.columns), cut=True, **options)
    return mixed.toDF(*docs.columns)
