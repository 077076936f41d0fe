"""The rows that the network learns from."""

import random

import pyspark.sql.functions as F
import pytest

from huddle.llm import toxicity
from huddle.llm.toxicity import fit_toxicity, score_toxicity


def test_repeated_ids_are_learnt_once(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=12)) + (" vile" if i % 2 else ""), "en", 0.5) for i in range(40)]
    schema = "doc_id long, text string, lang string, score double"  # score: a name of the operator's own
    plain = spark.createDataFrame(rows, schema)
    repeated = spark.createDataFrame(rows + [rows[3]] * 200 + [(3, "zzz much later text", "en", 0.1)], schema).repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 1)] * 5, "doc_id long, toxic int")
    once, often = fit_toxicity(plain, labels), fit_toxicity(repeated, labels)
    want = {r.id: r.score for r in score_toxicity(plain, once).collect()}
    got = {r.id: r.score for r in score_toxicity(plain, often).collect()}
    assert got == pytest.approx(want, abs=1e-4)
    assert score_toxicity(repeated, often).count() == 241


def test_rows_behind_the_first_two_thousand_are_learnt(spark, monkeypatch):
    """A word that only toxic texts with the highest hashes hold is learnt, in one shard or several."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(80)]
    text = lambda *more: " ".join(rng.choices(words, k=6) + list(more))
    order = [r.id for r in spark.range(2300).orderBy(F.xxhash64("id"), "id").collect()]
    rows = [(i, text("grim" if k >= 2000 else "vile")) for k, i in enumerate(order)] + [(i, text()) for i in range(2300, 4300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 2300)) for i, _ in rows], "doc_id long, toxic int")
    unseen = spark.createDataFrame([(i, text("grim") if i % 2 else text()) for i in range(200)], "doc_id long, text string")
    for shard in (5_000, 1_000):
        monkeypatch.setattr(toxicity, "SHARD_ROWS", shard, raising=False)
        right = [(r.score >= 0.5) == (r.id % 2 == 1) for r in score_toxicity(unseen, fit_toxicity(docs, labels)).collect()]
        assert sum(right) >= 190
