"""Exact dedup by counting quotient filters and byte verification.

1. Every row gets a 64-bit fingerprint and the SHA-256 of its normalised text
   (white space ``[\\x20\\x09-\\x0D]`` deleted); texts are read, not moved.
2. Each partition builds counting quotient filters of its fingerprints, one per
   fingerprint range, and the filters of a range merge losslessly by their
   sorted remainders.  However often a text is repeated, a partition sends one
   entry for it.
3. Fingerprints with a count of one are done.  The others route to byte
   verification: their texts are grouped by the bytes themselves, copies of
   one partition collapsing before the shuffle.  Two texts that share a
   fingerprint fall apart here, so the result does not depend on its width.

A fingerprint of more than ``BLOCK`` rows is dealt to that many more keys by a
salt, on both sides of a join.  Which are hot is broadcast: at most rows /
``BLOCK`` of them, as each stands for more than ``BLOCK`` rows.

Defined results: a null text is empty, and all empty and blank texts are one
group; of equal texts the one with the most code points stays, then the
smallest id (null last), then one of the rows that repeat an id; an empty
table gives an empty result; only the id and the text column are read,
whatever the others are called; texts are hashed and compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from huddle.llm.quotient import U64, CountingQuotientFilter, summed
from huddle.llm.shared import side, written

#: Rows of one fingerprint that a join gives to one key.
BLOCK = 20_000
#: Fingerprints of a range (expected, all partitions together) and of a task's buffer.
RANGE, BUFFER = 1 << 20, 1 << 20


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    for blank in " \n\t\r\x0b\x0c":
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def fingerprint(text: Column, bits: int = 64) -> Column:
    """The top ``bits`` bits of the text's hash, as a long."""
    return F.shiftrightunsigned(F.xxhash64(text), 64 - bits) if bits < 64 else F.xxhash64(text)


def partition_filters(fingerprints: DataFrame, bits: int = 64, range_bits: int = 0) -> DataFrame:
    """(range, filter) of every partition of a frame with the one column ``fp``; a filter holds the bits below the range's."""
    low = bits - range_bits

    def flush(values: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        values, counts = summed(values, counts)
        ranges = (values >> U64(low)).astype(np.int64) if range_bits else np.zeros(len(values), np.int64)
        cuts = np.append(np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1])), len(values))
        inner = values & U64((1 << low) - 1)
        blobs = [CountingQuotientFilter.build(inner[a:b], counts[a:b], low).to_bytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(ranges[cuts[:-1]]), pa.array(blobs, pa.binary())], names=["range", "filter"])

    def run(batches: Iterator[pa.RecordBatch]):
        held, n = [], 0
        for batch in batches:
            values = batch.column("fp").to_numpy().view(U64)
            held.append(summed(values, np.ones(len(values), np.int64)))
            n += len(held[-1][0])
            if n >= BUFFER:
                yield flush(*map(np.concatenate, zip(*held, strict=True)))
                held, n = [], 0
        if n:
            yield flush(*map(np.concatenate, zip(*held, strict=True)))

    return fingerprints.mapInArrow(run, "range long, filter binary")


def merge_filters(filters: DataFrame) -> DataFrame:
    """One filter per range."""

    def run(key, rows):
        whole = CountingQuotientFilter.merge([CountingQuotientFilter.from_bytes(x.as_py()) for x in rows.column("filter")])
        return pa.table({"range": pa.array([key[0].as_py()], pa.int64()), "filter": pa.array([whole.to_bytes()], pa.binary())})

    return filters.groupBy("range").applyInArrow(run, "range long, filter binary")


def repeated_fingerprints(merged: DataFrame, bits: int = 64, range_bits: int = 0) -> DataFrame:
    """(fp, copies) of all fingerprints that the filters count more than once."""
    low = bits - range_bits

    def run(batches):
        for batch in batches:
            for part, blob in zip(batch.column("range").to_pylist(), batch.column("filter"), strict=True):
                values, counts = CountingQuotientFilter.from_bytes(blob.as_py()).entries()
                values, counts = values[counts > 1], counts[counts > 1]
                whole = values | U64((part << low) if range_bits else 0)
                yield pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64)), pa.array(counts)], names=["fp", "copies"])

    return merged.mapInArrow(run, "fp long, copies long")


def _blocks(copies: Column) -> Column:
    return F.ceil(copies / BLOCK).cast("long")


def _salted(rows: DataFrame, hot: DataFrame, *by: str) -> DataFrame:
    """Rows with a salt: 0, or for a hot fingerprint one of its blocks."""
    return rows.join(F.broadcast(hot), "fp", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64(*by), F.col("blocks")), F.lit(0))).drop("blocks")


def _spread(keys: DataFrame) -> DataFrame:
    """Keys with ``copies``, one row per block of each."""
    return keys.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), _blocks(F.col("copies")) - 1)))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.length(F.col(text_col).cast("string")), F.lit(0)).alias("chars"), normalised(F.col(text_col)).alias("body"))
    text = text.withColumn("fp", fingerprint(F.col("body"), bits))
    rows = written(text.select("id", "chars", "fp", F.sha2("body", 256).alias("sha"), F.monotonically_increasing_id().alias("row")), "dedup-rows")
    range_bits = min(max(rows.count() - 1, 0) // RANGE, (1 << (bits - 2)) - 1).bit_length()
    merged = merge_filters(partition_filters(rows.select("fp"), bits, range_bits))
    repeated = written(repeated_fingerprints(merged, bits, range_bits), "dedup-repeated")
    hot = repeated.where(F.col("copies") > BLOCK).select("fp", _blocks(F.col("copies")).alias("blocks"))
    keys = side(written(_spread(repeated), "dedup-keys"))

    # byte verification: equal bytes form a class; fingerprints say only where to look
    routed = _salted(text, hot, "id", "chars").join(keys, ["fp", "salt"])
    classes = routed.groupBy("fp", "body").agg(F.count("*").alias("size"), F.max("copies").alias("copies"))
    classes = classes.select("fp", F.sha2("body", 256).alias("sha"), "size", "copies")

    marked = _salted(rows, hot, "row").join(keys, ["fp", "salt"], "left")
    first = F.min(F.struct((-F.col("chars")).alias("chars"), F.col("id").isNull().alias("none"), "id", "row")).alias("best")
    best = marked.where(F.col("copies").isNotNull()).groupBy("fp", "sha").agg(first)
    stays = written(classes.join(best, ["fp", "sha"]).select("fp", "sha", "size", "copies", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row")), "dedup-classes")
    stays = side(_spread(stays)).drop("copies")
    out = marked.join(stays, ["fp", "sha", "salt"], "left")
    alone = F.col("size").isNull()
    return out.select(
        "id",
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of the ids that stay, whole rows; ids must be unique and not null."""
    stay = exact_groups(docs, id_col, text_col).where("kept").select(F.col("id").alias("_stays"))
    return docs.join(stay, F.col(id_col) == F.col("_stays"), "left_semi")
