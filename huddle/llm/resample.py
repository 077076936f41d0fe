"""Importance resampling towards a target corpus.

Features are all runs of one to ``width`` consecutive words, hashed to
buckets by CRC-32.  A bucket's gain is the log ratio of its smoothed shares in
the target and in the corpus; a text's weight is the mean gain of its
features, and Gumbel noise from its id turns the largest weights into a draw
without replacement.

Arrow kernels do the text work: ascii_lower, split_pattern_regex,
list_flatten, dictionary_encode.  Runs are pairs of shifted dictionary indices
(a shorter run and the word behind it), encoded again, so that the CRC is
computed once per distinct pair: that of two parts follows from theirs and the
second one's length.  Gains are taken by bucket and reduced per text.

Bucket counts are summed over all texts: each task sends at most one row per
bucket.  Only the buckets (10,000) come to the driver.  The draw's order is a
range-partitioned sort of narrow rows.

Defined results: a null or empty text has no feature, weight 0 and is never
drawn below the least number of words; a null id is hashed as ``null`` and
comes last among ties; rows that repeat an id are drawn one by one, and share
their noise; an empty table gives an empty result, an empty target none but
smoothing counts; other columns are not read, whatever their names; texts are
read whole, in slices of a few MB.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from huddle.llm.shared import positions, small_batches, written
from huddle.llm.text import slices, texts_of

#: What lies between words: ASCII but digits and (lower-cased) letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SLICE = 4 << 20


class CrcShift:
    """CRC-32 of a concatenation: that of the first part, moved on by the second one's length, XOR that of the second."""

    def __init__(self):
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
        bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
        self.powers = [step[bits & 255] ^ (bits >> np.uint32(8))]  # what becomes of each bit after 1, 2, 4, ... bytes
        self.tables: dict[int, np.ndarray] = {}

    @staticmethod
    def _apply(images: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.uint32)
        for bit in range(32):
            out ^= np.where((x >> np.uint32(bit)) & np.uint32(1), images[bit], np.uint32(0))
        return out

    def _table(self, length: int) -> np.ndarray:
        if length not in self.tables:
            images, k, n = np.uint32(1) << np.arange(32, dtype=np.uint32), 0, length
            while n:
                if len(self.powers) <= k:
                    self.powers.append(self._apply(self.powers[-1], self.powers[-1]))
                if n & 1:
                    images = self._apply(self.powers[k], images)
                k, n = k + 1, n >> 1
            byte = np.arange(256, dtype=np.uint32)
            if len(self.tables) > 4096:
                self.tables.clear()
            self.tables[length] = np.stack([self._apply(images, byte << np.uint32(8 * i)) for i in range(4)])
        return self.tables[length]

    def joined(self, first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        order = np.argsort(lengths, kind="stable")
        x, by = first[order], lengths[order]
        cuts = np.append(np.flatnonzero(np.append(True, by[1:] != by[:-1])), len(by)) if len(by) else []
        out = np.empty(len(x), np.uint32)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            t, y = self._table(int(by[a])), x[a:b]
            moved = t[0][y & 255] ^ t[1][(y >> 8) & 255] ^ t[2][(y >> 16) & 255] ^ t[3][y >> 24]
            out[order[a:b]] = moved
        return out ^ second


def runs(texts: pa.Array, width: int, shift: CrcShift) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(words per text, for each run length the text and the CRC of every run)."""
    split = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    words, text = pc.list_flatten(split), pc.list_parent_indices(split)
    solid = pc.greater(pc.binary_length(words), 0)
    words, text = words.filter(solid), text.filter(solid).to_numpy()
    encoded = words.dictionary_encode()
    word = encoded.indices.to_numpy().astype(np.int64)
    spelled = [w.encode() for w in encoded.dictionary.to_pylist()]
    n = len(spelled)
    crc = np.fromiter((zlib.crc32(w) for w in spelled), np.uint32, n)
    behind = np.fromiter((zlib.crc32(b" " + w) for w in spelled), np.uint32, n)
    length = np.fromiter(map(len, spelled), np.int64, n) + 1
    out, code, at = [(text, crc[word])], word, np.arange(len(word))
    for k in range(2, width + 1):
        last = at + k - 1
        stays = last < len(word)
        stays[stays] = text[last[stays]] == text[at[stays]]
        code, at, last = code[stays], at[stays], last[stays]
        pairs = pa.array(code * n + word[last]).dictionary_encode()
        distinct = pairs.dictionary.to_numpy()
        crc = shift.joined(crc[distinct // n], behind[distinct % n], length[distinct % n]) if len(distinct) else np.zeros(0, np.uint32)
        code = pairs.indices.to_numpy().astype(np.int64)
        out.append((text[at], crc[code]))
    return np.bincount(text, minlength=len(texts)), out


def bucket_counts(texts: DataFrame, buckets: int, width: int) -> np.ndarray:
    """How many features of all texts (one column ``text``) fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]):
        shift, seen = CrcShift(), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                for _, crc in runs(texts_of(part.column("text")), width, shift)[1]:
                    seen += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        met = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(seen[met])], names=["bucket", "seen"])

    total = np.zeros(buckets, np.int64)
    for row in small_batches(texts).mapInArrow(run, "bucket long, seen long").groupBy("bucket").agg(F.sum("seen").alias("seen")).collect():  # at most `buckets` rows
        total[row["bucket"]] = row["seen"]
    return total


def bucket_gains(target: np.ndarray, corpus: np.ndarray, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln) of the ratio of smoothed shares, in doubles."""
    n, t, s = float(len(corpus)), target.astype(float), corpus.astype(float)
    return np.floor(scale * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weights(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", width: int = 2) -> DataFrame:
    """id, n_words, n_features, weight of every row."""

    def run(batches: Iterator[pa.RecordBatch]):
        shift, buckets = CrcShift(), np.uint32(len(gains))
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                n_words, found = runs(texts_of(part.column("text")), width, shift)
                n, total = np.zeros(len(n_words), np.int64), np.zeros(len(n_words), np.int64)
                for text, crc in found:
                    if not len(text):
                        continue
                    first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
                    total[text[first]] += np.add.reduceat(gains.take(crc % buckets), first)
                    n += np.bincount(text, minlength=len(n))
                weight = np.floor_divide(total, np.maximum(n, 1))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n_words), pa.array(n), pa.array(weight)], names=["id", "n_words", "n_features", "weight"])

    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = 25, least_words: int = 20, buckets: int = 10_000, width: int = 2, seed: int = 7, scale: int = 1000) -> DataFrame:
    """One row per document: id, n_words, n_features, weight, score, rank (null if not drawn)."""
    wanted = bucket_counts(target.select(F.col(target_col).cast("string").alias("text")), buckets, width)
    present = bucket_counts(docs.select(F.col(text_col).cast("string").alias("text")), buckets, width)
    weighed = weights(docs, bucket_gains(wanted, present, scale), id_col, text_col, width)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    may = F.col("n_words") >= least_words
    scored = written(weighed.withColumn("score", F.col("weight") + noise).withColumn("may", may), "resample-scores")
    drawn = scored.where("may").count() * percent // 100
    # the rows that may be drawn come first, so a place in this order is their rank
    order = [F.col("may").desc(), F.col("score").desc(), F.col("id").asc_nulls_last(), "n_features", "weight"]
    placed = positions(scored, order, "resample-order")
    rank = F.when(F.col("may") & (F.col("position") < drawn), F.col("position") + 1)
    return placed.select("id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
