"""Exact dedup, importance resampling and the Merkle manifest against brute force on awkward tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyspark.sql.functions as F
import pytest

from huddle.llm import dedup
from huddle.llm.merkle import audit, build, leaf
from huddle.llm.quotient import CountingQuotientFilter, summed
from huddle.llm.resample import CrcShift, resample

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, tree string, at long, body string, rank string, copies string"
EXTRA = (5, "t", 9, "b", "r", "c")
TEXTS = [
    None, "", " \n\t ", "one", "o ne", "one\x0b", "Two words", "two  words", "twowords", "a b éß |x|", "a b éß |x| ", "x\x00y\x1f z", "straße日本 語 word",
    "a b", "ab", "A" * 40 + " " + "long-word " * 30, "p q " * 60_000, "p  q\n" * 60_000, "\n".join(f"line {i}" for i in range(50)),
]


def make_rows():
    random.seed(11)
    words = ["".join(random.choice("abcdé") for _ in range(random.randint(1, 4))) for _ in range(60)]
    texts = TEXTS + [" ".join(random.choice(words) for _ in range(random.randint(1, 60))) for _ in range(60)]
    texts += ["hot text of a third\n of all rows"] * 45 + [texts[25] + " ", texts[26] + "\n\n"]
    rows = [(i, t, "en" if i % 3 else None, ["hot", None, "", "s1", "zé"][i % 5] if i % 2 else "hot", i if i % 7 else None, *EXTRA) for i, t in enumerate(texts)]
    return rows + [rows[30], rows[30], (None, texts[25], None, None, None, *EXTRA), (None, "no id", "x", "s1", 3, *EXTRA), (30, "other text of a known id", "en", "s1", 1, *EXTRA)]


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---------------------------------------------------------------- exact dedup


def brute_groups(rows):
    body = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = collections.defaultdict(list)
    for r in rows:
        groups[body(r[1])].append(r)
    out = collections.Counter()
    for text, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        marked = False
        for r in members:
            kept = not marked and (r[0], len(r[1] or "")) == (best[0], len(best[1] or ""))
            marked |= kept
            out[(r[0], best[0], len(members), kept, sha)] += 1
    return out


@pytest.mark.parametrize("bits, block, limit", [(64, 20_000, 1 << 20), (64, 7, 16), (5, 7, 16), (2, 20_000, 1 << 20)])
def test_exact_groups_equal_brute_force(docs, monkeypatch, bits, block, limit):
    """Also where nearly all fingerprints collide, keys are dealt to blocks and filters are cut into ranges."""
    monkeypatch.setattr(dedup, "BLOCK", block)
    monkeypatch.setattr(dedup, "RANGE", limit)
    monkeypatch.setattr(dedup, "BUFFER", limit)
    found = collections.Counter(tuple(r) for r in dedup.exact_groups(docs, bits=bits).select("id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert found == brute_groups(ROWS)


def test_exact_groups_without_broadcasts(docs, spark, monkeypatch):
    monkeypatch.setattr("huddle.llm.dedup.side", lambda df: df)
    monkeypatch.setattr(dedup, "BLOCK", 7)
    found = collections.Counter(tuple(r) for r in dedup.exact_groups(docs).select("id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert found == brute_groups(ROWS)


def test_exact_groups_of_nothing(empty):
    found = dedup.exact_groups(empty)
    assert found.columns == ["id", "keep_id", "group_size", "kept", "text_sha256"] and found.count() == 0


def test_drop_copies_keeps_whole_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "ab ", "y"), (3, "a  b", "z"), (4, None, "w")], "doc_id long, text string, kept string")
    assert sorted(map(tuple, dedup.drop_copies(docs).collect())) == [(3, "a  b", "z"), (4, None, "w")]


@pytest.mark.parametrize("bits", [3, 8, 17, 40, 63, 64])
def test_quotient_filter_reads_back_what_it_holds(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 5, 700):
        values = rng.integers(0, 1 << min(bits, 62), n, dtype=np.uint64) << np.uint64(max(bits - 62, 0))
        values = np.concatenate([values, values[: n // 3], values[:1].repeat(5000)])
        keys, counts = summed(values, np.ones(len(values), np.int64))
        held = CountingQuotientFilter.from_bytes(CountingQuotientFilter.build(keys, counts, bits).to_bytes())
        found = held.entries()
        assert (found[0] == keys).all() and (found[1] == counts).all()


def test_quotient_filters_merge_losslessly():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 3000, n, dtype=np.uint64) for n in (10, 4000, 1, 300)]
    merged = CountingQuotientFilter.merge([CountingQuotientFilter.build(*summed(p, np.ones(len(p), np.int64)), 16) for p in parts])
    expected = collections.Counter(int(x) for p in parts for x in p)
    assert dict(zip(*(x.tolist() for x in merged.entries()), strict=True)) == expected


# ---------------------------------------------------- importance resampling


def brute_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_features(text, width=2):
    w = brute_words(text)
    return [" ".join(w[i : i + k]) for k in range(1, width + 1) for i in range(len(w) - k + 1)]


def brute_resample(rows, target, percent=25, buckets=10_000, width=2, least=20):
    count = lambda texts: collections.Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in brute_features(t, width))
    s, t = count([r[1] for r in rows]), count(target)
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for r in rows:
        f = [zlib.crc32(x.encode()) % buckets for x in brute_features(r[1], width)]
        gains = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in f]
        weight = sum(gains) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(brute_words(r[1]))])
    may = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1], x[2]))
    for rank, x in enumerate(may[: percent * len(may) // 100], 1):
        x[4] = rank
    return sorted((tuple(x[:5]) for x in out), key=repr)


TARGET = ["two words and a line 7", "straße A B C", None, "", "abc de cab " * 30]


@pytest.mark.parametrize("width, percent", [(2, 25), (1, 100), (3, 60)])
def test_resample_equals_brute_force(docs, spark, width, percent):
    target = spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")
    found = resample(docs, target, width=width, percent=percent).select("id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, found), key=repr) == brute_resample(ROWS, TARGET, percent, width=width)


def test_resample_of_or_towards_nothing(docs, empty):
    assert resample(empty, docs).count() == 0
    found = resample(docs, empty).select("id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, found), key=repr) == brute_resample(ROWS, [])


def test_crc_of_joined_parts():
    rng = random.Random(4)
    parts = [(rng.randbytes(rng.randint(0, 9)), rng.randbytes(rng.choice([0, 1, 2, 31, 300, 70_000]))) for _ in range(60)]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    found = CrcShift().joined(crc(a for a, _ in parts), crc(b for _, b in parts), np.array([len(b) for _, b in parts]))
    assert found.tolist() == [zlib.crc32(a + b) for a, b in parts]


# ------------------------------------------------------------ Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_tree(leaves, fanout):
    """(root, path of each leaf: a list of (left, right) digests)."""
    level, where, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for k, at in enumerate(where):
            run = at // fanout * fanout
            paths[k].append(("".join(level[run:at]), "".join(level[at + 1 : run + fanout])))
            where[k] = at // fanout
        level = [H(*level[i : i + fanout]) for i in range(0, len(level), fanout)]
    return level[0], paths


def brute_audit(rows, fanout):
    tampered = lambda t: t.replace("\n", "") if t is not None else None
    trees = collections.defaultdict(list)
    for r in rows:
        own = brute_leaf((r[0], r[3], r[2], r[4], r[1]))
        now = own if r[0] is None or zlib.crc32(str(r[0]).encode()) % 2 else brute_leaf((r[0], r[3], r[2], r[4], tampered(r[1])))
        trees["" if r[3] is None else "s" + r[3]].append((r[0], own, now))
    names, parts = sorted(trees, key=str.encode), {}
    for name in names:
        members = sorted(trees[name], key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        parts[name] = members, *brute_tree([m[1] for m in members], fanout)
    root, above = brute_tree([parts[n][1] for n in names], fanout)
    out = []
    for name, way in zip(names, above, strict=True):
        members, subroot, paths = parts[name]
        for (doc, own, now), path in zip(members, paths, strict=True):
            whole = path + way
            for left, right in whole:
                now = H(left, now, right)
            out.append((doc, own, subroot, root, H(*[x for step in whole for x in step]), now, now == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_equals_brute_force(docs, fanout):
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    found = {"text": F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    rows = audit(build(docs, found=found, fanout=fanout)).collect()
    assert sorted(map(tuple, rows), key=repr) == brute_audit(ROWS, fanout)
    assert {r["verified"] for r in rows} == {True, False}


def test_manifest_of_nothing_one_row_and_one_source(spark, empty):
    assert audit(build(empty)).count() == 0 and build(empty).root is None
    one = spark.createDataFrame([ROWS[9]], SCHEMA)
    row = audit(build(one)).collect()[0]
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"] and row["proof_sha256"] == H()
    single = [r for r in ROWS if r[3] == "s1"]
    found = audit(build(spark.createDataFrame(single, SCHEMA))).collect()
    assert {(r["root"], r["verified"]) for r in found} == {(brute_audit(single, 3)[0][3], True)}


def test_leaf_tells_null_from_text_and_fields_apart(spark):
    rows = spark.createDataFrame([("-", None), (None, "-"), ("a", "b"), ("ab", ""), ("1:a", None)], "x string, y string")
    assert len({r[0] for r in rows.select(leaf([F.col("x"), F.col("y")])).collect()}) == 5
