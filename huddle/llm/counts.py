"""Token counts of edited texts.

A text is cut into pre-tokens by the vocabulary's pattern; its count is the
sum of theirs, each distinct pre-token being encoded once by a task.  A
document keeps a tree over blocks of its pre-tokens with the characters and
tokens of every subtree.  An edit replaces the characters [start, stop) by a
string: descending by characters finds the blocks; cutting starts anew two
pre-tokens before the edit and goes on until a cut behind the edit falls on an
old one, from where all is as before.  Only these pre-tokens are encoded, and
the sums on the blocks' paths to the root are updated.  Blocks that grow
beyond four times their size, and beyond the root of the number of
pre-tokens, are cut anew, so many edits at one place stay cheap.

Trees are rows: ``plant_trees`` cuts and encodes texts once, its table holds
the blocks and the sums, and ``apply_edits`` brings edits that come later to
it.  An edit opens the blocks that it touches and those beside them; the others
are neither cut nor encoded and go on as they are.  ``count_edited`` plants,
writes the trees and edits the written ones.

Edits apply one after the other, positions meaning the text as edited so far;
they are cut to the text's length, a null edit or replacement is empty.

Defined results: a null or empty text counts 0 tokens; a null or empty list of
edits changes nothing; a null id stays null and has no edits in a table of
them; repeated rows are counted one by one, and all rows of an id get its
edits; edits of an id without a tree are nothing, and all edits of one text are
one task's work, as each builds on the last; very long texts are cut whole; an
empty table gives an empty result.  Only the columns named are read.
"""

from __future__ import annotations

import base64
import math

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from huddle.llm.shared import written

BLOCK = 64
ROWS = 256
#: Distinct pre-tokens whose counts a task remembers before it starts anew.
REMEMBERED = 1_000_000
BACK = 2

EDITS = "array<struct<start:long,stop:long,replacement:string>>"
#: A stored tree: its blocks' texts, the lengths of their pre-tokens, and the sums of all nodes.
TREE = "blocks array<string>, lengths array<array<int>>, chars array<long>, tokens array<long>"


class PieceCounts(dict):
    """Tokens of a pre-token, encoded when first asked for."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)

    def __missing__(self, piece: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        n = self[piece] = len(self.encoding.encode_ordinary(piece))
        return n


class CountTree:
    """Sums of characters and tokens over blocks of pre-tokens; node i has the children 2i and 2i + 1."""

    def __init__(self, text: str, counts: PieceCounts):
        self.counts = counts
        self.encoded = 0
        self._plant(counts.pattern.findall(text))

    def _plant(self, pieces: list[str]):
        """Blocks of equal size, and the sums over them."""
        self.most = max(4 * BLOCK, math.isqrt(len(pieces)))
        self.blocks = [pieces[i : i + BLOCK] for i in range(0, len(pieces), BLOCK)] or [[]]
        self.size = 1 << (len(self.blocks) - 1).bit_length()
        self.chars, self.tokens = np.zeros(2 * self.size, np.int64), np.zeros(2 * self.size, np.int64)
        for i, block in enumerate(self.blocks):
            self._set(i, block)
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def __len__(self) -> int:
        return int(self.chars[1])

    def _set(self, i: int, pieces: list[str]):
        self.blocks[i] = pieces
        self.chars[self.size + i] = sum(map(len, pieces))
        self.tokens[self.size + i] = sum(self.counts[p] for p in pieces)

    def _replace(self, i: int, pieces: list[str]):
        old = self.chars[self.size + i], self.tokens[self.size + i]
        self._set(i, pieces)
        node = self.size + i
        more = self.chars[node] - old[0], self.tokens[node] - old[1]
        while node > 1:
            node //= 2
            self.chars[node] += more[0]
            self.tokens[node] += more[1]

    def _block_at(self, position: int) -> tuple[int, int]:
        """The block that holds the character, and where the block begins."""
        node, begin = 1, 0
        while node < self.size:
            node *= 2
            if begin + self.chars[node] <= position:
                begin += int(self.chars[node])
                node += 1
        i = min(node - self.size, len(self.blocks) - 1)
        return i, begin if i == node - self.size else len(self) - int(self.chars[self.size + i])

    def edit(self, start: int, stop: int, replacement: str):
        start = max(0, min(start, len(self)))
        stop = max(start, min(stop, len(self)))
        if start == stop and not replacement:
            return
        first, begin = self._block_at(max(0, start - 1))
        # the pre-token of the character before the edit, and BACK before it
        pieces, at, k = self.blocks[first], begin, 0
        while k < len(pieces) and at + len(pieces[k]) < start:
            at += len(pieces[k])
            k += 1
        while k < BACK and first > 0:
            first -= 1
            k += len(self.blocks[first])
            begin -= int(self.chars[self.size + first])
        head, at = [], begin
        lead = [p for b in self.blocks[first : self._block_at(max(0, start - 1))[0] + 1] for p in b]
        for p in lead[: max(0, k - BACK)]:
            head.append(p)
            at += len(p)
        # old pre-tokens from there on, as far as needed
        old, last = lead[len(head) :], self._block_at(max(0, start - 1))[0]
        reach = at + sum(map(len, old))
        while True:
            while last + 1 < len(self.blocks) and reach < stop + 1:
                last += 1
                old += self.blocks[last]
                reach += int(self.chars[self.size + last])
            joined = "".join(old)
            region = joined[: start - at] + replacement + joined[stop - at :]
            shift = len(replacement) - (stop - start)
            ends, p = {}, at
            for n, piece in enumerate(old):
                p += len(piece)
                if p >= stop:
                    ends.setdefault(p + shift, n + 1)
            whole = last + 1 >= len(self.blocks)
            fresh, p, met = [], at, None
            limit = len(region) if whole else len(region) - 1
            for m in self.counts.pattern.finditer(region):
                if m.end() > limit or (not whole and m.end() >= len(region)):
                    break  # what lies behind the region could still change this one
                fresh.append(m.group())
                p = at + m.end()
                if p >= start + len(replacement) and p in ends and p > at + shift:
                    met = ends[p]
                    break
            if met is None and whole:
                met = len(old)
                fresh = self.counts.pattern.findall(region)
            if met is not None:
                break
            last += 1
            old += self.blocks[last]
            reach += int(self.chars[self.size + last])
        self.encoded += len(fresh)
        # the blocks share what they now hold; once they hold too much, all are cut anew
        pieces = head + fresh + old[met:]
        each = -(-len(pieces) // (last - first + 1))
        for n, i in enumerate(range(first, last + 1)):
            self._replace(i, pieces[n * each : (n + 1) * each])
        if each > self.most:
            self._plant([p for block in self.blocks for p in block])


class StoredBlocks:
    """The blocks of a stored tree as lists of pre-tokens, cut when first opened."""

    def __init__(self, texts: pa.Array, lengths: pa.ListArray):
        self.texts, self.lengths = texts, lengths
        self.opened: dict[int, list[str]] = {}
        self.changed: set[int] = set()

    def __len__(self) -> int:
        return len(self.texts)

    def __getitem__(self, i):
        if isinstance(i, slice):
            return [self[j] for j in range(*i.indices(len(self)))]
        if not 0 <= i < len(self):
            raise IndexError(i)
        if i not in self.opened:
            text, at = self.texts[i].as_py(), [0, *np.cumsum(self.lengths[i].values.to_numpy()).tolist()]
            self.opened[i] = [text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        return self.opened[i]

    def __setitem__(self, i: int, pieces: list[str]):
        self.opened[i] = pieces
        self.changed.add(i)

    def arrays(self) -> tuple[pa.Array, pa.Array]:
        """Texts and lengths, those of unchanged blocks as they were."""
        texts, lengths, at = [self.texts.slice(0, 0)], [self.lengths.slice(0, 0)], 0
        for i in [*sorted(self.changed), len(self)]:
            texts.append(self.texts.slice(at, i - at))
            lengths.append(self.lengths.slice(at, i - at))
            if i < len(self):
                for all_of, one in zip((texts, lengths), _arrays([self.opened[i]]), strict=True):
                    all_of.append(one)
            at = i + 1
        return pa.concat_arrays(texts), pa.concat_arrays([x.cast(_LENGTHS) for x in lengths])


_LENGTHS = pa.list_(pa.int32())


def _arrays(blocks: list[list[str]]) -> tuple[pa.Array, pa.Array]:
    ends = np.cumsum([0, *map(len, blocks)])
    lengths = np.fromiter((len(p) for b in blocks for p in b), np.int32, int(ends[-1]))
    return pa.array(["".join(b) for b in blocks], pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(lengths))


def _columns(trees: list[CountTree]) -> list[pa.Array]:
    """The columns of TREE."""
    held = [t.blocks.arrays() if isinstance(t.blocks, StoredBlocks) else _arrays(t.blocks) for t in trees]
    listed = lambda sizes, values: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), values)
    texts, lengths = (pa.concat_arrays([h[k] for h in held]) for k in (0, 1))
    sizes = [len(h[0]) for h in held]
    sums = [listed([len(t.chars) for t in trees], pa.array(np.concatenate([getattr(t, name) for t in trees]))) for name in ("chars", "tokens")]
    return [listed(sizes, texts), listed(sizes, lengths), *sums]


def _stored(counts: PieceCounts, blocks, lengths, chars, tokens) -> CountTree:
    """A tree from a row of TREE; nothing is cut or encoded."""
    tree = CountTree.__new__(CountTree)
    tree.counts, tree.encoded, tree.blocks = counts, 0, StoredBlocks(blocks.values, lengths.values)
    tree.chars, tree.tokens = (np.array(x.values.to_numpy()) for x in (chars, tokens))
    tree.size = len(tree.chars) // 2
    tree.most = max(4 * BLOCK, math.isqrt(len(lengths.values.flatten())))
    return tree


def _parts(batches, rows: int = ROWS):
    for batch in batches:
        yield from (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def plant_trees(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str | None = None) -> DataFrame:
    """id and the columns of TREE of every row, and its column of edits, if one is named."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *([F.col(edits_col).cast(EDITS).alias("edits")] if edits_col else []),
    )

    def run(batches):
        counts = PieceCounts(ranks_path, pattern)
        for part in _parts(batches):
            rest = [x for x in part.schema.names if x != "text"]
            trees = [CountTree(text.as_py(), counts) for text in part.column("text")]
            yield pa.RecordBatch.from_arrays([*[part.column(x) for x in rest], *_columns(trees)], names=[*rest, "blocks", "lengths", "chars", "tokens"])

    return rows.mapInArrow(run, f"id long, {f'edits {EDITS}, ' if edits_col else ''}{TREE}")


def edit_trees(trees: DataFrame, ranks_path: str, pattern: str, keep: bool = True) -> DataFrame:
    """Trees with a column ``edits``: id, n_tokens and n_tokens_edited, n_pretokens (before the edits), n_encoded
    (pre-tokens that the edits encoded), n_blocks and n_opened (of them those that were opened), and, if to
    ``keep``, the edited trees."""
    names = ["n_tokens", "n_tokens_edited", "n_pretokens", "n_encoded", "n_blocks", "n_opened"]
    kept = ["blocks", "lengths", "chars", "tokens"]

    def run(batches):
        counts = PieceCounts(ranks_path, pattern)
        for part in _parts(batches):
            found, edited = [], []
            for row in zip(*[part.column(x) for x in kept], part.column("edits"), strict=True):
                tree = _stored(counts, *row[:-1])
                stored, before = tree.blocks, tree.total
                pieces = len(row[1].values.flatten())
                for e in row[-1].as_py() or []:
                    if e is not None:
                        tree.edit(e["start"] or 0, e["stop"] or 0, e["replacement"] or "")
                found.append((before, tree.total, pieces, tree.encoded, len(stored), len(stored.opened)))
                edited.append(tree)
            columns = [pa.array([x[i] for x in found], pa.int64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([part.column("id"), *columns, *(_columns(edited) if keep else [])], names=["id", *names, *(kept if keep else [])])

    return trees.select("id", *kept, "edits").mapInArrow(run, ", ".join(["id long", *[f"{x} long" for x in names], *([TREE] if keep else [])]))


def apply_edits(trees: DataFrame, edits: DataFrame, ranks_path: str, pattern: str, keep: bool = True) -> DataFrame:
    """As edit_trees, of stored trees and a table of later edits: id, number (their order), start, stop, replacement."""
    edits = edits.select(F.col("id").cast("long").alias("id"), F.struct(F.col("number").cast("long").alias("number"), F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), F.col("replacement").cast("string").alias("replacement")).alias("e"))
    by_id = edits.groupBy("id").agg(F.sort_array(F.collect_list("e")).alias("e"))
    by_id = by_id.select("id", F.transform("e", lambda e: F.struct(e["start"].alias("start"), e["stop"].alias("stop"), e["replacement"].alias("replacement"))).alias("edits"))
    return edit_trees(trees.drop("edits").join(by_id, "id", "left"), ranks_path, pattern, keep)


def count_edited(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """id, n_tokens (before the edits), n_tokens_edited, n_pretokens, n_encoded, n_blocks, n_opened.

    edits: array of (start, stop, replacement)."""
    return edit_trees(written(plant_trees(docs, ranks_path, pattern, id_col, text_col, edits_col), "count-trees"), ranks_path, pattern, keep=False)
