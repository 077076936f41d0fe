"""Best-fit packing with the best-two-fit step.

Documents become token pieces of at most ``capacity`` tokens; only longer
documents are cut.  Pieces of one length are interchangeable, so bins are
planned on the histogram of lengths, which has at most ``capacity`` entries at
any data size.  A bin takes the longest length left that fits, again and
again; then its smallest piece is replaced by two unpacked pieces that fit the
gap it leaves more tightly, as long as that fills more.  A filled bin is a
pattern, repeated while all its lengths last.  Every piece then finds its bin
from its rank among the pieces of its length: a piece's rank in its shard,
which the tokenizing task counts, plus the counts of the shards before.

Defined results: a null or empty text is the single closing id; a null id is
packed like others; repeated rows are packed one by one; an empty table gives
an empty result.  Only the id and the text column are read.
"""

from __future__ import annotations

import threading
import zlib
from bisect import bisect_right
from itertools import chain

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window

from huddle.llm.shared import small_batches, written
from huddle.llm.text import _LOWER, _WHITE, raw, slices, texts_of

#: Distinct words that a Python worker remembers the ids of (about 250 bytes each); when full, the half that
#: most slices have used stays.
REMEMBERED = 600_000
#: Seconds without a task after which a Python worker drops its encoder.
REST_SECONDS = 5.0
SLICE = 2 << 20

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[97:123] = True
#: ASCII symbols but the apostrophe, which may open a closing of its own.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = True


class WordEncoder:
    """Token ids of whole texts, encoding each distinct word once.

    The vocabulary splits at white space, lower-cases and closes every
    letter or symbol run on its own, so a text's ids are its words' ids in
    order, and a symbol behind a letter begins a unit of its own."""

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.code: dict[bytes, int] = {}
        self.uses = np.zeros(0, np.int32)  # slices that a word was met in
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.store = np.zeros(0, np.uint32)

    @staticmethod
    def _memory() -> dict:
        """What outlives this Python worker's tasks; they bring their own copy of this module."""
        import sys
        import types

        return vars(sys.modules.setdefault("huddle_worker_memory", types.ModuleType("huddle_worker_memory")))

    @classmethod
    def kept(cls, path: str) -> WordEncoder:
        """The encoder of this Python worker, which stays for its next task."""
        memory = cls._memory()
        if timer := memory.pop("timer", None):
            timer.cancel()
        encoder = memory.get(("encoder", path)) or cls(path)
        memory["encoder", path] = encoder
        return encoder

    @classmethod
    def rest(cls) -> None:
        """A task is over.  Without another one soon the worker's encoders go: it serves other stages, too,
        or waits for one, and an encoder's words fill more memory than all else in it."""
        memory = cls._memory()
        if timer := memory.pop("timer", None):
            timer.cancel()
        timer = memory["timer"] = threading.Timer(REST_SECONDS, cls._drop)
        timer.daemon = True
        timer.start()

    @classmethod
    def _drop(cls) -> None:
        import contextlib
        import ctypes
        import gc

        memory = cls._memory()
        for key in [x for x in list(memory) if isinstance(x, tuple) and x[0] == "encoder"]:
            memory.pop(key, None)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError, TypeError):  # a call of glibc alone
            ctypes.CDLL(None).malloc_trim(0)

    def _forget(self) -> None:
        """Half of the words go, those that fewest slices have used."""
        stay = np.sort(np.argsort(self.uses, kind="stable")[len(self.uses) - REMEMBERED // 2 :])
        new = np.full(len(self.uses), -1)
        new[stay] = np.arange(len(stay))
        self.code = {w: c for w, c in zip(self.code, new[np.fromiter(self.code.values(), np.int64, len(self.code))].tolist(), strict=True) if c >= 0}
        lengths = self.length[stay]
        ends = np.cumsum(lengths)
        self.store = self.store[np.repeat(self.start[stay] - (ends - lengths), lengths) + np.arange(lengths.sum())]
        self.start, self.length, self.uses = ends - lengths, lengths, self.uses[stay] // 2

    def _learn(self, words: list[bytes]) -> np.ndarray:
        get = self.code.get
        codes = np.array([get(w, -1) for w in words], np.int64)
        unknown = np.flatnonzero(codes < 0)
        if len(unknown) and len(self.uses) > REMEMBERED:
            self._forget()
            return self._learn(words)
        if len(unknown):
            new = [words[i] for i in unknown]
            found = [x.ids for x in self.tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)]
            codes[unknown] = np.arange(len(self.uses), len(self.uses) + len(new))
            self.code.update(zip(new, codes[unknown].tolist(), strict=True))
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            self.start = np.concatenate([self.start, len(self.store) + np.cumsum(lengths) - lengths])
            self.length = np.concatenate([self.length, lengths])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int32)])
            self.store = np.concatenate([self.store, np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))])
        self.uses[codes] += 1
        return codes

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, number of ids of each)."""
        offsets, data = raw(column)
        solid = ~_WHITE[data]
        units, where = self._units(data, offsets, solid)
        if not len(where):
            return np.zeros(0, np.uint32), np.zeros(len(column), np.int64)
        encoded = units.dictionary_encode()
        codes = self._learn(encoded.dictionary.to_pylist())[encoded.indices.to_numpy()]
        lengths = self.length[codes]
        ends = np.cumsum(lengths)
        at = np.repeat(self.start[codes] - (ends - lengths), lengths) + np.arange(ends[-1])
        doc = np.searchsorted(offsets, where, side="right") - 1
        sums = np.concatenate([[0], ends])
        units_of = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(column)))])
        return self.store[at], sums[units_of[1:]] - sums[units_of[:-1]]

    @staticmethod
    def _units(data, offsets, solid):
        """Words, cut before an ASCII symbol behind a letter, as an Arrow array, and where they begin."""
        n = len(data)
        begin = solid.copy()
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begin[1:] &= ~solid[:-1] | edge[1:n]
        low = _LOWER[data]
        pipes = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
        if len(pipes):
            # a special token's string may stand in the word, told by its case: such words stay as they are
            words = np.append(np.flatnonzero(begin), n)
            held = np.unique(np.searchsorted(words, pipes, side="right") - 1)
            low, whole = low.copy(), np.zeros(n, bool)
            for lo, hi in zip(words[held], words[held + 1], strict=True):
                low[lo:hi], whole[lo:hi] = data[lo:hi], True
        if n > 1:
            behind = _ASCII_LETTER[low[:-1]]
            # Latin letters of two bytes, but the signs of times and division, and the I with a dot, which becomes two characters
            lead, trail = low[:-2], low[1:-1]
            wide = (lead >= 0xC3) & (lead <= 0xC8) & (trail >= 0x80) & ~((lead == 0xC3) & ((trail == 0x97) | (trail == 0xB7))) & ~((lead == 0xC4) & (trail == 0xB0))
            behind[1:] |= wide
            cut = _SYMBOL[data[1:]] & behind & ~edge[1:n]
            begin[1:] |= cut & ~whole[1:] if len(pipes) else cut
        where = np.flatnonzero(begin)
        packed = np.concatenate([[0], np.cumsum(solid)])
        bounds = np.append(packed[where], packed[-1]).astype(np.int32)
        body = low[solid]
        return pa.Array.from_buffers(pa.binary(), len(where), [None, pa.py_buffer(bounds), pa.py_buffer(body)]), where


def _ranks(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The rank of each piece among those of its length; seen counts them from call to call."""
    order = np.argsort(lengths, kind="stable")
    sorted_ = lengths[order]
    first = np.concatenate([[True], sorted_[1:] != sorted_[:-1]]) if len(sorted_) else np.zeros(0, bool)
    begin = np.flatnonzero(first)
    inside = np.arange(len(sorted_)) - np.repeat(begin, np.diff(np.append(begin, len(sorted_))))
    out = np.empty(len(lengths), np.int64)
    out[order] = inside + seen[sorted_]
    seen += np.bincount(lengths, minlength=len(seen))
    return out


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, closing_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents: id, piece, start, length, ids_crc32, shard, rank and, if asked for, ids."""

    def run(batches):
        encoder, seen = WordEncoder.kept(tokenizer), np.zeros(capacity + 1, np.int64)
        shard = TaskContext.get().partitionId()
        try:
            for batch in batches:
                for part in slices(batch, "text", SLICE):
                    ids, counts = encoder.encode(texts_of(part.column("text")))
                    full = counts + 1
                    ends = np.cumsum(full)
                    flow = np.full(int(ends[-1]), closing_id, "<u4")
                    inner = np.ones(len(flow), bool)
                    inner[ends - 1] = False
                    flow[inner] = ids
                    n = -(-full // capacity)
                    doc = np.repeat(np.arange(len(full)), n)
                    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                    start = piece * capacity
                    length = np.minimum(full[doc] - start, capacity)
                    at = (ends - full)[doc] + start
                    own = [flow[a : a + k] for a, k in zip(at, length, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                            pa.array(np.array([zlib.crc32(x) for x in own], np.int64)), pa.array(np.full(len(doc), shard, np.int32)),
                            pa.array(_ranks(length, seen)), pa.array(own if keep_ids else [None] * len(own), pa.list_(pa.int32())),
                        ],
                        names=["id", "piece", "start", "length", "ids_crc32", "shard", "rank", "ids"],
                    )
        finally:
            WordEncoder.rest()

    return small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "id long, piece int, start long, length long, ids_crc32 long, shard int, rank long, ids array<int>"
    )


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first bin, pieces of that length a bin, offset) for every
    length of every bin pattern.  counts: how many pieces there are of each length."""
    left = {k: v for k, v in counts.items() if v}
    taken = dict.fromkeys(left, 0)
    lengths = sorted(left)
    out, bins = [], 0
    while lengths:
        used: dict[int, int] = {}
        gap = capacity

        def free(length, used=used):
            return left[length] - used.get(length, 0)

        def best(limit, used=used):
            """The longest length of at most limit that is left."""
            i = bisect_right(lengths, limit) - 1
            while i >= 0 and not free(lengths[i]):
                i -= 1
            return lengths[i] if i >= 0 else 0

        while gap and (length := best(gap)):
            k = min(free(length), gap // length)
            used[length] = used.get(length, 0) + k
            gap -= k * length
        while gap:  # best two fit
            small = min(used)
            room, pair, most = gap + small, None, small
            for a in lengths[: bisect_right(lengths, room - 1)][::-1]:
                if 2 * a <= most:
                    break
                if not free(a):
                    continue
                used[a] = used.get(a, 0) + 1
                b = best(min(a, room - a))
                used[a] -= 1
                if b and a + b > most:
                    pair, most = (a, b), a + b
                    if most == room:
                        break
            used = {k: v for k, v in used.items() if v}
            if pair is None:
                break
            used[small] -= 1
            for x in pair:
                used[x] = used.get(x, 0) + 1
            used = {k: v for k, v in used.items() if v}
            gap = room - most
        times = min(left[k] // v for k, v in used.items())
        offset = 0
        for k in sorted(used, reverse=True):
            v = used[k]
            out.append((k, taken[k], taken[k] + v * times, bins, v, offset))
            taken[k] += v * times
            left[k] -= v * times
            offset += k * v
        bins += times
        lengths = [k for k in lengths if left[k]]
    return out


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds sequence_id and offset to written pieces (id, piece, ..., length, shard, rank)."""
    counts = pieces.groupBy("length", "shard").agg(F.count("*").alias("pieces"))
    before = F.sum("pieces").over(Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    counts = written(counts.withColumn("before", F.coalesce(before, F.lit(0))), "packing-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("pieces").alias("n")).collect()}  # at most `capacity` rows
    plan = np.array(sorted(plan_bins(histogram, capacity)), np.int64).reshape(-1, 6)
    # lengths x shards grow with the corpus: a partitioned join, never a broadcast
    ranked = pieces.join(counts.select("length", "shard", "before").hint("merge"), ["length", "shard"]).withColumn("rank", F.col("rank") + F.col("before")).drop("shard", "before")
    names = ranked.columns

    def run(batches):
        key = (plan[:, 0] << 48) + plan[:, 1]
        for batch in batches:
            rank, length = batch.column("rank").to_numpy(), batch.column("length").to_numpy()
            row = plan[np.searchsorted(key, (length << 48) + rank, side="right") - 1]
            past = rank - row[:, 1]
            sequence, offset = row[:, 3] + past // row[:, 4], row[:, 5] + past % row[:, 4] * length
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long").drop("rank")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, closing_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, ids, sequence_id, offset."""
    pieces = written(token_pieces(docs, tokenizer, id_col, text_col, capacity, closing_id, keep_ids), "packing-pieces")
    return pack(pieces, capacity)
