"""corpus_pipeline stage by stage against brute force, on awkward rows."""

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, component long, _size string, secrets int"
SECRET = "4f3c2b1a9d8e7f60514297a8b6c5d4e3f2a1b0c9"


def prose(rng, n):
    words = "the morning river carried small boats along quiet fields where people spoke about weather music bread and letters from friends".split()
    out = []
    while len(out) < n:
        k = rng.randint(8, 14)
        out.append(" ".join(rng.choice(words) + rng.choice(["", "s", "ed", "ing", str(rng.randint(0, 9))]) for _ in range(k)).capitalize() + ".")
        n -= k - 1
    return "\n".join(out)


def make_rows():
    rng = random.Random(21)
    texts = [prose(rng, 90) for _ in range(14)] + [prose(rng, 6000)]
    copies = [texts[0], texts[0], texts[1].replace("river", "stream", 1), texts[2] + " And one more sentence."]
    texts += copies + [None, "", " \n ", "too short", prose(rng, 60) + f'\nThe old password = "{SECRET}" was written here on the page.\n' + prose(rng, 40)]
    rows = [(i, t, "en", [None, "a", "b"][i % 3], len(t or ""), "x", 1, "s", 0) for i, t in enumerate(texts)]
    return [*rows, rows[3], (None, prose(rng, 80), None, "a", None, None, None, None, None)]


def similar(a, b, width=5):
    def shingles(t):
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()

    x, y = shingles(a), shingles(b)
    return bool(x) and bool(y) and 100 * len(x & y) >= 80 * len(x | y)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(make_rows(), SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_each_stage_against_brute_force(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "secrets", "mixing", "packing"]

    def step(name, docs):
        out = stages[name](spark, docs, root)
        return spark.createDataFrame(out.collect(), out.schema)

    before = {(r.doc_id, r.text): r for r in docs.collect()}
    good = step("quality", docs)
    assert good.columns == docs.columns
    kept = good.collect()
    assert {r.doc_id for r in kept} >= set(range(19)) - {None} and not {19, 20, 21, 22} & {r.doc_id for r in kept}
    for r in kept:
        lines = {t for i, t in before if i == r.doc_id}
        assert any(set(r.text.split("\n")) <= set(t.split("\n")) for t in lines if t) and r.n_chars == len(r.text)

    unique = step("near_duplicates", good)
    assert unique.columns == docs.columns
    least = {}
    for r in kept:
        if r.doc_id is not None:
            near = [s.doc_id for s in kept if s.doc_id is not None and similar(r.text, s.text)]
            least[r.doc_id] = min([*near, r.doc_id])
    rows = unique.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(i for i, to in least.items() if i == to)
    assert sum(r.doc_id is None for r in rows) == sum(r.doc_id is None for r in kept)

    clean = step("secrets", unique)
    assert clean.columns == docs.columns
    held = {r.doc_id: r.text for r in rows}
    for r in clean.collect():
        assert r.text == held[r.doc_id].replace(SECRET, "[SECRET]") and r.n_chars == len(r.text)

    mixed = step("mixing", clean)
    assert mixed.columns == docs.columns
    sizes = {r.doc_id: len(WORD.findall(r.text)) for r in clean.collect()}
    taken = collections.Counter()
    for r in mixed.collect():
        taken[r.doc_id] += len(WORD.findall(r.text))
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) < 0.03 * sum(sizes.values()) and all(taken[i] <= 2 * sizes[i] for i in taken)

    packed = stages["packing"](spark, mixed, root).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = collections.Counter()
    for r in mixed.collect():
        ids = np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 2048):
            expected[r.doc_id, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expected
    bins = collections.defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_run_equals_its_stages_and_takes_an_empty_table(spark, root, tmp_path):
    whole = corpus_pipeline.run(spark, root)
    assert whole.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and whole.count() > 0
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
