"""What the operators leave in the Python workers and ask of them."""

import time

import pyarrow as pa
import pyspark.sql.functions as F

from huddle.llm import packing, shared
from huddle.llm.mixing import mixed_documents
from huddle.llm.queries import tokenizer_path


def test_resting_workers_hold_no_encoder(spark, monkeypatch):
    monkeypatch.setattr(packing, "REST_SECONDS", 0.1)
    docs = spark.range(0, 400, 1, 8).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words of"), F.col("id")).alias("text"))
    assert packing.token_pieces(docs, tokenizer_path("word_bpe_49k.json")).count() == 400
    time.sleep(3)

    def held(batches):
        import sys

        for batch in batches:
            memory = vars(sys.modules["huddle_worker_memory"]) if "huddle_worker_memory" in sys.modules else {}
            known = sum(isinstance(x, tuple) and x[0] == "encoder" for x in memory)
            yield pa.RecordBatch.from_arrays([pa.array([known] * batch.num_rows, pa.int64()), pa.array(["huddle_worker_memory" in sys.modules] * batch.num_rows)], names=["held", "used"])

    found = spark.range(0, 8, 1, 8).mapInArrow(held, "held long, used boolean").collect()
    assert any(r.used for r in found)
    assert not any(r.held for r in found)


def test_the_mix_needs_one_python_step(spark):
    rows = [(1, "a b c d", "x", 5), (2, None, None, None), (None, "e f", "y", 7), (3, "", "x", 1), (4, "g  h\ni", None, 2)]
    mixed = mixed_documents(spark.createDataFrame(rows, "doc_id long, text string, source string, n long"))
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 1 and "MapInArrow" not in plan
    got, texts = mixed.collect(), {(r[0], r[2], r[3]): (r[1] or "").split() for r in rows}
    assert got and all(r.text and set(r.text.split()) <= set(texts[r.doc_id, r.source, r.n]) for r in got)
    nothing = spark.createDataFrame([(1, None, "x"), (2, "", "y")], "doc_id long, text string, source string")
    assert mixed_documents(nothing).collect() == []


def test_batches_of_texts_are_small_on_both_sides(spark):
    names = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"
    other = spark.newSession()
    shared.small_batches(other.range(1))
    assert [int(other.conf.get(x)) for x in names] == [1000, 1000]
