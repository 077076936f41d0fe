"""A training-data pipeline over ``documents``.

Each stage works on all rows that the stage before kept; ``run`` writes a
stage's rows as Parquet to the cluster's shared folder and reads them back for
the next.

1. ``quality``         rejected documents go, failed lines leave the others
2. ``near_duplicates`` of documents that link (five-word shingles, similarity
                       0.8) over any number of steps, the smallest id stays
3. ``secrets``         secrets in the texts are replaced by a mask
4. ``mixing``          the words that the source targets take; a document
                       comes up to twice, each time with the words taken
5. ``packing``         one row per token piece and its place in a sequence

SQL cannot express the forest of stage 3 or the seeded choice of stage 4, so
there is no ORACLE_SQL; ``tests/llm/test_pipeline.py`` holds each stage against
a brute-force version.

Defined results: null and empty texts are rejected by the first stage; copies
and repeated rows go in the second; rows without an id, and null sources, are
kept and mixed like others; extra columns, whatever their names, travel along;
texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from huddle.llm.jaccard import one_of_each
from huddle.llm.mixing import mixed_documents
from huddle.llm.packing import pack_documents
from huddle.llm.quality import clean_documents
from huddle.llm.queries import table, tokenizer_path
from huddle.llm.secrets import redact
from huddle.llm.shared import written


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(clean_documents(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, percent=80, width=5)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(redact(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixed_documents(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = pack_documents(docs, tokenizer_path("word_bpe_49k.json"))
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
