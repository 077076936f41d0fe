"""Top-k search over several shards: results as by brute force, and what is not sent."""

import numpy as np
import pytest

from huddle.llm import topk


def brute(rows, k, every):
    out = []
    for q in sorted({(i, tuple(v)) for i, v in rows if i % every == 0}):
        scores = sorted((-int(np.dot(np.floor(64 * np.array(v)), np.floor(64 * np.array(q[1])))), i) for i, v in rows if i != q[0] and len(v) == len(q[1]))
        out += [(q[0], n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(topk, "SHARD_VECTORS", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "LEAF", 16)


def test_many_shards_equal_brute_force(spark, small):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(6).round(3).tolist()) for i in range(260)]
    rows += [(300 + i, rows[7][1]) for i in range(130)]  # a third of all rows are one vector
    rows += [(900 + i, rng.standard_normal(3).round(3).tolist()) for i in range(30)]  # shorter ones
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    got = sorted(tuple(r) for r in topk.top_k(frame, k=5, query_every=20).collect())
    assert got == brute(rows, 5, 20)


def test_far_shards_are_not_asked(spark, small, monkeypatch):
    """Clusters far apart: after its own cluster's shards a query asks no other."""
    rng = np.random.default_rng(5)
    rows = [(i, (np.eye(8)[i % 8] * 50 + rng.standard_normal(8) * 0.1).round(3).tolist()) for i in range(800)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    sent, plain = [], topk.written

    def spy(df, name):
        out = plain(df, name)
        if name.startswith(("topk-wave", "topk-pairs")):
            sent.append((name, out.count()))
        return out

    monkeypatch.setattr(topk, "written", spy)
    got = sorted(tuple(r) for r in topk.top_k(frame, k=5, query_every=20).collect())
    assert got == brute(rows, 5, 20)
    pairs = dict(sent)["topk-pairs"]
    assert pairs >= 40 * 20 and sum(n for name, n in sent if name != "topk-pairs") < pairs / 2
