"""Quality rules, line first.

Every line of a text is judged on its own; lines that fail are removed, and a
document is rejected when too much of its text is lost.

Lines are what ``\\n`` splits; a line counts if it holds a word (a run outside
space and 0x09-0x0D).  A line fails on the first of these rules:

* ``navigation``  at least 3 bars ``|`` and one for 20 words, or bars for a
  fifth of its words
* ``punctuation`` 3 or more marks of ``#*$%&<>!`` for ten words (and at least
  two marks), or a line of 8 or more words without one mark of ``.!?:;`` or of
  another script's in it, unless it is wrapped: in a block of lines of at most
  ``WRAP`` characters, none of them blank, it has no room for the next line's
  first word, and the next line has a mark or is wrapped itself
* ``boilerplate`` it repeats an earlier line of the text, or contains
  ``BOILERPLATE`` (ASCII letters in any case) once for 30 words or more often

A document is rejected if the base rules fail (fewer than ``min_words`` words,
or more than ``max_repeat`` percent of its words lie in 5-word windows that
the text holds twice or more), or if the failed lines hold more than
``max_lost`` percent of its words.

Defined results: a null or empty text has no words and is rejected by the
base rules; repeated rows are judged one by one; a null id is kept as null;
an empty table gives an empty result.  Whole texts are read; only the id and
the text column are, whatever other columns are called.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from huddle.llm.shared import small_batches
from huddle.llm.text import Words, raw, slices, texts_of

# Phrases that mark a line as boilerplate.
BOILERPLATE = (
    b"all rights reserved",
    b"cookie policy",
    b"privacy policy",
    b"terms of use",
    b"terms of service",
    b"subscribe to our newsletter",
    b"sign in to",
    b"enable javascript",
    b"click here",
    b"lorem ipsum",
)
MARKS = b"#*$%&<>!"
SENTENCE = b".!?:;"
OTHER_SENTENCE = re.compile("|".join("\u3002\uff0e\uff01\uff1f\uff1b\uff1a\uff61\u2026\u061f\u061b\u06d4\u0964\u0965\u1362\u1367\u0589\u104b\u17d4\u037e").encode())
WRAP = 120
WINDOW = 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SOLID = np.ones(256, bool)
_SOLID[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

SCHEMA = (
    "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, lost_words long, kept boolean, cleaned string"
)


def _count(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are marked."""
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeated_words(words: Words, width: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of ``width`` words found twice or more in it."""
    at = words.windows(width)
    h, d = words.window_hash(at, width), words.doc[at]
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    same = np.concatenate([[False], (h[1:] == h[:-1]) & (d[1:] == d[:-1])]) if len(h) else np.zeros(0, bool)
    twice = same.copy()
    twice[:-1] |= same[1:]
    edge = np.zeros(len(words.doc) + 1, np.int64)
    first = at[order[twice]]
    np.add.at(edge, first, 1)
    np.add.at(edge, first + width, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(words.doc[covered], minlength=words.n_docs).astype(np.int64)


def has_mark(line: bytes) -> bool:
    return len(line) != len(line.translate(None, SENTENCE)) or bool(OTHER_SENTENCE.search(line))


def wrapped_lines(lines: list[bytes]) -> list[bool]:
    """For each line whether its sentence goes on to a mark in the next lines of its block."""
    text = [line.decode(errors="replace").rstrip() for line in lines]
    wrapped, width, end = [False] * len(lines), 0, len(lines)
    for i in range(len(lines) - 1, -1, -1):
        if not text[i].strip():
            end = i
            continue
        if i + 1 == end or i + 1 == len(lines):  # the last line of a block
            first = i
            while first and text[first - 1].strip():
                first -= 1
            width = max(map(len, text[first : i + 1]))
            continue
        full = len(text[i]) + 1 + len(text[i + 1].split()[0]) > width
        wrapped[i] = full and width <= WRAP and (has_mark(lines[i + 1]) or wrapped[i + 1])
    return wrapped


def line_fails(line: bytes, words: int, wrapped=lambda: False) -> bool:
    """The line's own rules; repeats, and whether it is wrapped, are told by the caller."""
    bars = line.count(b"|")
    if (bars >= 3 and bars * 20 >= words) or bars * 5 >= words:
        return True
    marks = len(line) - len(line.translate(None, MARKS))
    if marks >= 2 and 10 * marks >= 3 * words:
        return True
    if words >= 8 and not has_mark(line) and not wrapped():
        return True
    low = line.lower()
    return any(phrase in low for phrase in BOILERPLATE) and 30 * sum(map(low.count, BOILERPLATE)) >= words


def clean_lines(text: bytes) -> tuple[bytes, int, int]:
    """(text without failed lines, their words, lines with a word that equal an earlier one)."""
    seen: set[bytes] = set()
    kept, lost, repeats = [], 0, 0
    lines, told = text.split(b"\n"), []

    def wrapped():
        if not told:
            told.extend(wrapped_lines(lines))
        return told[i]

    for i, line in enumerate(lines):
        words = len(line.split())
        if words:
            repeat = line in seen
            seen.add(line)
            repeats += repeat
            if repeat or line_fails(line, words, wrapped):
                lost += words
                continue
        kept.append(line)
    return b"\n".join(kept), lost, repeats


def _judge(column: pa.Array, min_words: int, max_repeat: int, max_lost: int) -> dict:
    """The columns of SCHEMA but the id, for the texts of a slice; cleaned as bytes."""
    words = Words(column)
    offsets, data = raw(column)
    n = words.counts
    solid = _SOLID[data]
    repeat = repeated_words(words)
    texts = data.tobytes()
    lines = [clean_lines(texts[offsets[i] : offsets[i + 1]]) for i in range(len(column))]
    lost = np.array([x[1] for x in lines], np.int64)
    failed = (n < min_words) | (100 * repeat > max_repeat * n)
    return {
        "n_words": n,
        "word_chars": _count(solid & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _count(_SYMBOL[data], offsets),
        "n_dup_lines": np.array([x[2] for x in lines], np.int64),
        "n_repeat_words": repeat,
        "base_failed": failed,
        "lost_words": lost,
        "kept": ~failed & (100 * lost <= max_lost * n),
        "cleaned": [x[0] for x in lines],
    }


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10, max_repeat: int = 20, max_lost: int = 50, cleaned: bool = False) -> DataFrame:
    """One row per input row; ``cleaned`` is the text without failed lines (null unless asked for)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = _judge(texts_of(part.column("text")), min_words, max_repeat, max_lost)
                found["cleaned"] = [x.decode() if cleaned else None for x in found["cleaned"]]
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(x, pa.string()) if c == "cleaned" else pa.array(x) for c, x in found.items())], names=["id", *found])

    return small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)


def clean_documents(docs: DataFrame, text_col: str = "text", min_words: int = 10, max_repeat: int = 20, max_lost: int = 50) -> DataFrame:
    """The documents that the rules keep, all columns, their texts without the failed lines."""
    at, names = docs.columns.index(text_col), docs.columns

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                found = _judge(texts_of(part.column(at)), min_words, max_repeat, max_lost)
                columns = [*part.columns]
                columns[at] = pa.array([x.decode() for x in found["cleaned"]], pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(found["kept"]))

    return small_batches(docs).mapInArrow(run, docs.schema)
