"""N-gram Jaccard join by a token-group matrix.

Documents are sets of word shingles.  Two documents link when
``100 * intersection >= percent * union``; the result names, for each
document, the smallest id that it reaches over links.

Method.  Equal sets are one set from the start.  Every other set is cut into
``k`` parts by a hash of its shingles, and each part, hashed as a whole, is a
*token*.  Sets of at most M shingles that link differ in at most
``d = (100 - percent) * 2M // (100 + percent)`` shingles, hence with
``k = d + 1 + extra`` parts they agree on ``extra + 1`` of them, and on more the
smaller the set: a set and a group whose token union holds fewer of its tokens
cannot be linked.  That is
the matrix: token x group, with the bound on a set's overlap with a group.
A long passage shared by otherwise different documents fills no whole part,
so frequent words, lines and passages make no frequent token.

1. Count each token over all sets.  A set stays only if enough of its tokens
   occur in other sets.
2. Similar sets form a group: each goes to its most frequent token.  A group
   is opened in blocks of about ``BLOCK`` sets, each with the group's most
   central set, so that a block of any large group is joined to the others.
3. Tokens may still lie in several components.  First each component's set that
   overlaps most with some token's most central set is compared with that one.
   For what is left, each set asks every group whose token union overlaps enough
   with the set's tokens; askers and group members meet in blocks of
   ``ASK_BLOCK`` each.

An opened block compares its sets exactly on all their shingles, so every
link between different sets is found or is implied by links that were found.
No group of copies is expanded into pairs.

Defined results: a null or empty text, or one without words, has no shingle,
no link and itself as component; fewer words than a shingle holds make one
shingle; a null id takes part in nothing and has a null component; rows that
repeat an id are told apart by their texts, whose links are all the id's, and
get the id's component; an empty table gives an empty result.  Only the id and the text
column are read; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, Window

from huddle.llm.shared import has_rows, numbered, side, small_batches, written
from huddle.llm.text import U64, Words, mix, slices, texts_of

#: Sets in one opened block.
BLOCK = 128
#: Askers, and members, of one opened block of the last step.
ASK_BLOCK = 512
#: Tokens that one task counts.
TOKEN_ROWS = 400_000
#: Links that one task of a labelling round takes.
LABEL_ROWS = 50_000
#: Ratio of the largest to the smallest set size in a size class.
CLASS_RATIO = {90: 1.3, 80: 1.6}


def size_classes(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class bounds b (class c holds sizes b[c] .. b[c+1]-1), parts and spare parts by class.

    A set and a smaller set that it links with lie in the same class or in
    neighbouring ones."""
    ratio = max(CLASS_RATIO.get(percent, 1.3), 100 / percent)
    bounds = [1]
    while bounds[-1] <= largest:
        reach = (bounds[-1] - 1) * 100 // percent + 1
        bounds.append(max(bounds[-1] + 1, reach, int(bounds[-1] * ratio)))
    bounds.append(max(bounds[-1] + 1, (bounds[-1] - 1) * 100 // percent + 1, int(bounds[-1] * ratio)))
    b = np.array(bounds, np.int64)
    d = (100 - percent) * 2 * (b[1:] - 1) // (100 + percent)
    extra = np.where(d >= 5, 2 + d // 16, 0)
    return b, d + 1 + extra, extra


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of the texts of a slice: hashes, sorted within each
    text, and the number of each text."""
    w = Words(column, lower=True)
    at = w.windows(width)
    hashes, owner = [w.window_hash(at, width)], [w.doc[at]]
    for n in range(1, width):
        few = w.first[:-1][w.counts == n]
        hashes.append(w.window_hash(few, n))
        owner.append(w.doc[few])
    h, d = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[keep], d[keep]
    return h, np.bincount(d, minlength=w.n_docs).astype(np.int64)


def part_tokens(h: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each set, their owners, their levels' needs and level tags."""
    bounds, parts, extra = size_classes(percent, int(n.max(initial=1)))
    owner = np.repeat(np.arange(len(n)), n)
    own = np.searchsorted(bounds, n, side="right") - 1
    tokens, of, need = [], [], []
    for up in (0, 1):
        level = own + up
        takes = (n > 0) & (level < len(parts)) & ((up == 0) | (n * 100 >= percent * bounds[np.minimum(level, len(bounds) - 1)]))
        docs = np.flatnonzero(takes)
        if not len(docs):
            continue
        k = np.where(takes, parts[np.minimum(level, len(parts) - 1)], 0)
        first = np.cumsum(k) - k
        rows = takes[owner]
        hs, ho = h[rows], owner[rows]
        salt = mix(hs + level[ho].astype(U64) * U64(0x9E3779B97F4A7C15), 2)
        part = ((salt >> U64(32)) * k[ho].astype(U64) >> U64(32)).astype(np.int64)
        cell = first[ho] + part
        total = int(k.sum())
        sums, held = np.zeros(total, U64), np.bincount(cell, minlength=total)
        with np.errstate(over="ignore"):
            np.add.at(sums, cell, mix(hs, 3))
        cell_doc = np.repeat(docs, k[docs])
        place = np.arange(total) - first[cell_doc]
        with np.errstate(over="ignore"):
            token = mix(sums + mix(level[cell_doc].astype(U64) * U64(1 << 32) + place.astype(U64), 4), 5)
        empties = np.bincount(cell_doc[held == 0], minlength=len(n))
        spare = extra[np.minimum(level, len(parts) - 1)]
        emit = (held > 0) | (empties > spare)[cell_doc]
        tokens.append(token[emit])
        of.append(cell_doc[emit])
        # a partner has at most `most` shingles, so the two differ in at most `apart`
        most = np.minimum(bounds[np.minimum(level + 1, len(bounds) - 1)] - 1, n * 100 // percent)
        apart = (100 - percent) * (n + most) // (100 + percent)
        need.append(np.maximum(1, k - apart - empties)[cell_doc[emit]] * 2 + up)
    if not tokens:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    t, o, q = map(np.concatenate, (tokens, of, need))
    order = np.argsort(o, kind="stable")
    return t[order], o[order], q[order]


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def signatures(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """doc, id, n, two sums that name the set, tokens and each token's need (need * 2 + which level)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                h, n = shingle_sets(texts_of(part.column("text")), width)
                first = np.concatenate([[0], np.cumsum(n)])
                with np.errstate(over="ignore"):
                    f = [np.add.reduceat(np.append(mix(h, s), U64(0)), first[:-1]) if len(n) else np.zeros(0, U64) for s in (6, 7)]
                f = [np.where(n > 0, x, U64(0)) for x in f]
                t, o, q = part_tokens(h, n, percent)
                ends = np.concatenate([[0], np.cumsum(np.bincount(o, minlength=len(n)))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), part.column("id"), pa.array(n), pa.array(_signed(f[0])), pa.array(_signed(f[1])), pa.ListArray.from_arrays(pa.array(ends), pa.array(_signed(t))), pa.ListArray.from_arrays(pa.array(ends), pa.array(q.astype(np.int32)))],
                    names=["doc", "id", "n", "f1", "f2", "tokens", "needs"],
                )

    return docs.mapInArrow(run, "doc long, id long, n long, f1 long, f2 long, tokens array<long>, needs array<int>")


def link_block(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set of a block, the smallest id that it reaches over links inside the block.

    A set whose overlap with the union of the others is below the bound is
    not opened; the others meet through the postings of their shingles."""
    n = np.array([len(s) for s in sets], np.int64)
    root = np.arange(len(sets))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(tokens, kind="stable")
    sorted_tokens, posting = tokens[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], sorted_tokens[1:] != sorted_tokens[:-1]]))
    length = np.diff(np.append(start, len(posting)))
    row = np.empty(len(tokens), np.int64)
    row[order] = np.repeat(np.arange(len(start)), length)
    at = np.concatenate([[0], np.cumsum(n)])
    shared = np.add.reduceat((length[row] > 1).astype(np.int64), at[:-1])
    for q in np.flatnonzero(100 * shared >= percent * n):
        rows = row[at[q] : at[q + 1]]
        rows = rows[length[rows] > 1]
        count = length[rows]
        ends = np.cumsum(count)
        inside = np.arange(ends[-1]) - np.repeat(ends - count, count) if len(ends) else np.zeros(0, np.int64)
        both = np.bincount(posting[np.repeat(start[rows], count) + inside], minlength=len(sets))
        linked = np.flatnonzero(100 * both >= percent * (n[q] + n - both))
        for other in linked[linked > q]:
            a, b = find(q), find(other)
            if a != b:
                root[max(a, b)] = min(a, b)
    group = np.array([find(x) for x in range(len(sets))])
    least = np.full(len(sets), np.iinfo(np.int64).max)
    np.minimum.at(least, group, ids)
    return least[group]


def open_blocks(docs: DataFrame, members: DataFrame, percent: int, width: int) -> DataFrame:
    """Links inside each block.  members (block, id), written -> (id, to): the smallest id reached in the block."""
    needed = side(written(members.select("id").distinct(), "jaccard-needed"))
    texts = docs.join(needed, "id", "left_semi")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                h, n = shingle_sets(texts_of(part.column("text")), width)
                ends = pa.array((np.concatenate([[0], np.cumsum(n)]) * 8).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.Array.from_buffers(pa.binary(), len(n), [None, ends.buffers()[1], pa.py_buffer(h.tobytes())])], names=["id", "shingles"])

    sets = texts.mapInArrow(run, "id long, shingles binary")

    def link(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates("id")  # an id names one text here
        ids = block["id"].to_numpy(np.int64)
        to = link_block(ids, [np.frombuffer(x, U64) for x in block["shingles"]], percent)
        return pd.DataFrame({"id": ids, "to": to})[to < ids]

    return sets.join(side(members), "id").groupBy("block").applyInPandas(link, "id long, to long")


def smallest_reached(edges: DataFrame) -> DataFrame:
    """(id, to) links -> (id, component) for every id of a link.

    Each round hangs every vertex's neighbours on the smallest one it sees
    and then follows one pointer, so long chains halve; the loop ends when
    nothing changes."""
    edges = written(edges.select("id", "to").distinct(), "links")
    # rounds write little, so their tables follow the number of links and not the session's partitions
    parts = max(8, edges.count() // LABEL_ROWS)
    label = edges.select(F.explode(F.array("id", "to")).alias("id")).distinct().withColumn("label", F.col("id"))
    both = edges.union(edges.select(F.col("to").alias("id"), F.col("id").alias("to")))
    label = written(label.coalesce(parts), "labels")
    while True:
        near = both.join(label.select(F.col("id").alias("to"), F.col("label").alias("seen")), "to").groupBy("id").agg(F.min("seen").alias("seen"))
        least = label.join(near, "id", "left").select("id", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        least = written(least.coalesce(parts), "labels")
        # also tell the old label's owner, so that whole components move at once
        told = least.groupBy(F.col("old").alias("id")).agg(F.min("label").alias("told"))
        jump = least.select(F.col("id").alias("label"), F.col("label").alias("next"))
        new = least.join(told, "id", "left").select("id", "old", F.least("label", "told").alias("label"))
        new = written(new.join(jump, "label", "left").select("id", "old", F.least("label", F.coalesce("next", "label")).alias("label")).coalesce(parts), "labels")
        if not has_rows(new.where("label != old")):
            return new.select("id", F.col("label").alias("component"))
        label = new.select("id", "label")


def central():
    """Order of sets by how much of their groups they share; ties to the smaller id."""
    return F.struct("weight", -F.col("id"))


def labelled(chosen: DataFrame, links: DataFrame) -> DataFrame:
    """id, grp, weight, component of every set that shares tokens."""
    reached = smallest_reached(links)
    return chosen.join(reached, "id", "left").select("id", "grp", "weight", F.coalesce("component", "id").alias("component"))


def qualifying(common: DataFrame, label: DataFrame) -> DataFrame:
    """(block, id) of the group openings that are left.

    The matrix holds the groups of each token.  A set asks a group if the
    group holds a component that ranks above the set's own (by size, then by
    label) and if the group's token union holds at least as many of the set's
    tokens as a link needs.  Of two sets that link across components, the one
    in the lower-ranked component asks the other's group, so each link is met.
    Askers and group members are dealt into blocks of bounded size."""
    size = label.groupBy("component").agg(F.count("*").alias("size"))
    label = label.join(size, "component").withColumn("rank", F.struct("size", "component"))
    top = label.groupBy("grp").agg(F.max("rank").alias("top"), F.count("*").alias("members"))
    held = written(common.join(label.select("id", "grp", "rank"), "id"), "jaccard-held")
    split = held.groupBy("token").agg(F.min("rank").alias("lo"), F.max("rank").alias("hi")).where("lo < hi")
    # the matrix and the asks read these rows, which are far fewer than the tokens
    held = written(held.join(split.select("token", "hi"), "token"), "jaccard-split")
    matrix = held.select("token", "grp").distinct().join(top, "grp")
    asks = held.where("rank < hi").select("token", "id", "need", "rank").join(matrix, "token").where("rank < top").groupBy("id", "grp", "need").agg(F.count("*").alias("overlap"), F.first("members").alias("members")).where(F.col("overlap") * 2 >= F.col("need") - F.col("need") % 2)
    asks = written(asks.select("id", "grp", "members").distinct(), "jaccard-asks")
    asked = asks.groupBy("grp").agg(F.count("*").alias("askers"), F.first("members").alias("members"))
    chunks = lambda n: F.ceil(F.col(n) / ASK_BLOCK)
    dealt = lambda n: F.pmod(F.xxhash64("id"), chunks(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), chunks(n) - 1))
    ask_rows = asks.join(asked.select("grp", "askers"), "grp").select("id", "grp", dealt("askers").alias("a"), every("members").alias("m"))
    member_rows = label.select("id", "grp").join(asked, "grp").select("id", "grp", every("askers").alias("a"), dealt("members").alias("m"))
    return ask_rows.union(member_rows).select("id", F.xxhash64("grp", "a", "m").alias("block")).distinct()


def shared_tokens(sets: DataFrame) -> DataFrame:
    """(token, id, need, held) of the tokens that several sets hold; held: by how many.

    Nearly all tokens are held once, so counting ahead of the shuffle would only fill memory: each token's rows
    meet once, in as many tasks as their number asks for, and are counted there."""
    rows = sets.agg(F.sum(F.size("tokens"))).first()[0] or 0
    token = sets.select("id", F.explode(F.arrays_zip("tokens", "needs")).alias("x")).select(F.col("x.tokens").alias("token"), "id", F.col("x.needs").alias("need"))
    token = token.repartition(max(8, rows // TOKEN_ROWS), "token")
    return token.withColumn("held", F.count("*").over(Window.partitionBy("token"))).where("held > 1")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 90, width: int = 3) -> DataFrame:
    """One row per input row: id, n_shingles, component."""
    # rows that repeat an id are told apart: until the end, ``id`` names an id with a text, ``doc`` the document
    doc, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    docs = small_batches(docs).select(doc.alias("doc"), F.when(doc.isNotNull(), F.xxhash64(doc, text)).alias("id"), text.alias("text"))
    sig = written(signatures(docs, percent, width), "jaccard-sets")
    docs = docs.where("id is not null").select("id", "text")

    # equal sets: the row with the smallest id stands for all
    key = ["f1", "f2", "n"]
    full = sig.where("n > 0 and id is not null")
    equal = full.groupBy(*key).agg(F.min("id").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    equal = side(written(equal, "jaccard-equal"))
    copies = written(full.select("id", *key).join(equal, key).where("id != first").select("id", "first").distinct(), "jaccard-copies")
    sets = full.join(side(copies.select("id").distinct()), "id", "left_anti")

    # tokens that occur in several sets, and the sets that hold enough of them
    common = written(shared_tokens(sets), "jaccard-shared")
    enough = common.groupBy("id", "need").agg(F.count("*").alias("common"), F.sum("held").alias("weight"), F.max(F.struct("held", "token")).alias("top")).where(F.col("common") * 2 >= F.col("need") - F.col("need") % 2)
    chosen = written(enough.groupBy("id").agg(F.max("top").getField("token").alias("grp"), F.sum("weight").alias("weight")), "jaccard-chosen")
    common = written(common.select("id", "token", "need").join(side(chosen.select("id")), "id", "left_semi"), "jaccard-common")

    # open each group in blocks that share the group's most central set
    group = chosen.groupBy("grp").agg(F.count("*").alias("sets"), F.max_by("id", central()).alias("centre")).where("sets > 1")
    blocks = F.ceil(F.col("sets") / BLOCK)
    placed = chosen.join(group, "grp").select("id", F.xxhash64("grp", F.pmod(F.xxhash64("id"), blocks)).alias("block"))
    centres = group.select(F.col("centre").alias("id"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("i"), "grp").select("id", F.xxhash64("grp", F.col("i")).alias("block"))
    members = written(placed.union(centres).distinct(), "jaccard-members")
    links = written(open_blocks(docs, members, percent, width), "jaccard-found")

    # tokens that still lie in several components: first each component's best meeting with a token's most central set
    label = written(labelled(chosen, links), "jaccard-labels")
    held = written(common.join(label.select("id", "weight", "component"), "id"), "jaccard-held")
    split = held.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max_by("id", central()).alias("hub"), F.max_by("component", central()).alias("hub_component")).where("lo < hi")
    meets = held.join(split, "token").where("component != hub_component").groupBy("component", "id", "hub", "need").agg(F.count("*").alias("overlap")).where(F.col("overlap") * 2 >= F.col("need") - F.col("need") % 2)
    pairs = meets.groupBy("component").agg(F.max(F.struct("overlap", "hub", "id")).alias("best")).select("best.id", "best.hub")
    asked = pairs.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    pairs = written(pairs.join(asked, "hub").select("id", "hub", F.xxhash64("hub", F.pmod(F.xxhash64("id"), "blocks")).alias("block")), "jaccard-pairs")
    if has_rows(pairs):
        members = written(pairs.select("block", "id").union(pairs.select("block", F.col("hub").alias("id"))).distinct(), "jaccard-members")
        links = written(links.union(open_blocks(docs, members, percent, width)), "jaccard-found")
        label = written(labelled(chosen, links), "jaccard-labels")

    # then every set whose tokens overlap enough with a group that holds a larger component
    members = written(qualifying(common, label), "jaccard-members")
    if has_rows(members):
        links = written(links.union(open_blocks(docs, members, percent, width)), "jaccard-found")

    # the texts of one id are one document
    own = sig.where("id is not null").select("doc", "id")
    several = own.groupBy("doc").agg(F.min("id").alias("to"), F.max("id").alias("last")).where("to < last").select("doc", "to")
    several = own.join(side(written(several, "jaccard-several")), "doc").where("id != to").select("id", "to")
    reached = smallest_reached(links.union(copies.select("id", F.col("first").alias("to"))).union(several))
    least = own.join(reached, "id").groupBy("component").agg(F.min("doc").alias("least"))
    reached = reached.join(least, "component").select("id", "least")
    return sig.select("doc", "id", F.col("n").alias("n_shingles")).join(reached, "id", "left").select(F.col("doc").alias("id"), "n_shingles", F.coalesce("least", "doc").alias("component"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, width: int = 5) -> DataFrame:
    """The documents, all columns, of which each component keeps the one with the smallest id.

    Of rows that repeat an id and a text one stays; rows without an id stay.  Null and empty texts link with
    nothing and stay; an empty table gives an empty result; columns may have any names."""
    rows, name = numbered(docs)
    found = written(jaccard_components(rows, name[id_col], name[text_col], percent, width).select("id", "component"), "jaccard-components")
    gone = written(found.where("id != component").select("id").distinct(), "jaccard-gone")
    own = F.col(name[id_col]).cast("long")
    kept = rows.join(side(gone), own == F.col("id"), "left_anti")
    again = written(found.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 and id is not null").select("id"), "jaccard-again")
    if has_rows(again):
        again = side(again)
        once = kept.join(again, own == F.col("id"), "left_semi").dropDuplicates([name[id_col], name[text_col]])
        kept = kept.join(again, own == F.col("id"), "left_anti").union(once)
    return kept.toDF(*docs.columns)
