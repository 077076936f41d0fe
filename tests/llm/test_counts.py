"""Edited token counts: growing blocks, awkward rows."""

import random

import public_tokenizers

from huddle.llm import counts
from huddle.llm.queries import tokenizer_path

PATH, PATTERN = tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_many_edits_at_one_place(monkeypatch):
    monkeypatch.setattr(counts, "BLOCK", 8)
    known, rng = counts.PieceCounts(PATH, PATTERN), random.Random(2)
    text = " ".join(rng.choice(["one", "don't", "12", "x\n"]) for _ in range(200))
    tree = counts.CountTree(text, known)
    for n in range(300):
        at, stop = 40 + n % 7, 40 + n % 7 + (30 if n % 50 == 49 else 0)
        new = rng.choice([" two words", "a b c d e f", "'s", "\n\n", ""])
        tree.edit(at, stop, new)
        text = text[:at] + new + text[stop:]
        assert len(tree) == len(text) and max(map(len, tree.blocks)) <= tree.most
        if n % 20 == 0:
            assert tree.total == len(known.encoding.encode_ordinary(text))
    assert tree.total == len(known.encoding.encode_ordinary(text)) and "".join(p for b in tree.blocks for p in b) == text


def test_awkward_rows(spark):
    schema = "id string, doc_id long, text string, n_tokens int, edits array<struct<start:long,stop:long,replacement:string>>"
    long = "word " * 60_000
    rows = [("a", 1, long, 7, [(5, 9, "x"), (-3, 1, None), (10**9, 10**9, "end")])] * 2 + [("b", None, "", 7, [(0, 0, "new")]), ("c", 3, None, None, [])]
    frame = spark.createDataFrame(rows, schema)
    encode = counts.PieceCounts(PATH, PATTERN).encoding.encode_ordinary
    edited = (long[:5] + "x" + long[9:])[1:] + "end"
    got = sorted(((r.id, r.n_tokens, r.n_tokens_edited) for r in counts.count_edited(frame, PATH, PATTERN).collect()), key=str)
    assert got == sorted([(1, len(encode(long)), len(encode(edited)))] * 2 + [(None, 0, len(encode("new"))), (3, 0, 0)], key=str)
    assert counts.count_edited(frame.limit(0), PATH, PATTERN).count() == 0


def test_later_edits_open_only_blocks_they_touch(spark, tmp_path):
    rng = random.Random(4)
    texts = {1: " ".join(rng.choice(["one", "don't", "12", "x\n", "é"]) for _ in range(9_000)), 2: "short", 3: "", 4: None}
    docs = spark.createDataFrame([*texts.items(), (1, texts[1]), (None, "no id")], "doc_id long, text string")
    counts.plant_trees(docs, PATH, PATTERN).write.parquet(str(tmp_path / "trees"))
    trees, encode = spark.read.parquet(str(tmp_path / "trees")), counts.PieceCounts(PATH, PATTERN).encoding.encode_ordinary
    want = {i: t or "" for i, t in texts.items()}
    for turn in range(3):  # each turn edits the trees that the last one left
        edits = []
        for number in range(5):
            for i in (1, 3, 77):
                at = rng.randint(0, 20_000) if i == 1 else 0
                edits.append((i, number, at, at + rng.choice([0, 3]), rng.choice(["new words", "'s", "\n", None])))
        rng.shuffle(edits)
        found = counts.apply_edits(trees, spark.createDataFrame(edits, "id long, number int, start int, stop int, replacement string"), PATH, PATTERN)
        found.write.parquet(str(tmp_path / f"turn{turn}"))
        found = spark.read.parquet(str(tmp_path / f"turn{turn}"))
        old = {i: len(encode(t)) for i, t in want.items()}
        for i, _, a, b, new in sorted(edits, key=lambda e: e[1]):
            if i in want:
                a, b = min(a, len(want[i])), min(b, len(want[i]))
                want[i] = want[i][:a] + (new or "") + want[i][b:]
        rows = found.collect()
        assert len(rows) == 6
        for r in rows:
            if r.id is not None:
                assert (r.n_tokens, r.n_tokens_edited) == (old[r.id], len(encode(want[r.id]))) and "".join(r.blocks) == want[r.id]
            assert r.n_opened <= 5 * 4 and r.n_encoded < 200 and (r.id != 1 or r.n_blocks > 100)
        trees = found.select("id", "blocks", "lengths", "chars", "tokens")


def test_clashing_columns_and_no_edits_at_all(spark):
    docs = spark.createDataFrame([(1, "one two", 5, "x")], "doc_id long, text string, tokens int, blocks string")
    trees = counts.plant_trees(docs, PATH, PATTERN)
    none = spark.createDataFrame([], "id long, number int, start int, stop int, replacement string")
    assert [(r.n_tokens, r.n_tokens_edited, r.n_opened) for r in counts.apply_edits(trees, none, PATH, PATTERN, keep=False).collect()] == [(2, 2, 0)]
    assert counts.apply_edits(trees.limit(0), none, PATH, PATTERN).count() == 0
