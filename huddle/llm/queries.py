"""One thin query per operator: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from huddle.llm.counts import count_edited
from huddle.llm.dedup import exact_groups
from huddle.llm.jaccard import jaccard_components
from huddle.llm.licences import scan_licences
from huddle.llm.merkle import audit, build
from huddle.llm.mixing import mix_sources
from huddle.llm.packing import pack_documents
from huddle.llm.quality import judge_quality
from huddle.llm.resample import resample
from huddle.llm.secrets import scan_secrets
from huddle.llm.topk import top_k
from huddle.llm.toxicity import fit_toxicity, score_toxicity
from huddle.llm.warc import archive_round_trip
from huddle.session import table_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"), percent=90, width=3)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licences(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_paragraphs", F.size("hits").alias("n_licensed"), F.array_sort(F.array_distinct(F.col("hits.family"))).alias("families"), "hits")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archive_round_trip(table(spark, sf_dir, "pages"))
    return read.select(F.col("page").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to", "segments", "intact")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents"))
    return judged.withColumnRenamed("id", "doc_id").drop("cleaned")


def tokenizer_path(name: str) -> str:
    """A public vocabulary file; every executor has the same installed copy."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    scored = score_toxicity(docs, fit_toxicity(docs, labels.where(~held_out)))
    return scored.withColumnRenamed("id", "doc_id").select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "language")


def op9_ball_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=20, query_every=20, scale=64)


def op10_edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits to every document: its middle word run loses 9 characters, its first line break
    becomes a blank, and its source is written behind it."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    n, line = F.length(text).cast("long"), F.locate("\n", text).cast("long")
    edit = lambda start, stop, new: F.struct(start.alias("start"), stop.alias("stop"), new.alias("replacement"))
    middle = F.floor(n / 2)
    edits = F.array(
        edit(middle, middle + 9, F.lit("")),
        edit(F.greatest(line - 1, F.lit(0)), F.when((line > 0) & (line <= middle), line).otherwise(0), F.when((line > 0) & (line <= middle), F.lit(" ")).otherwise("")),
        edit(n + 100, n + 100, F.concat(F.lit("\nsource: "), F.coalesce("source", F.lit("")))),
    )
    counted = count_edited(docs.withColumn("edits", edits), tokenizer_path("byte_bpe_50k.tiktoken"), token_pattern())
    return counted.withColumnRenamed("id", "doc_id")


def token_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.withColumnRenamed("id", "doc_id").drop("n_words")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks a copy of the documents in which every second text has lost its line breaks."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    found = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return audit(build(table(spark, sf_dir, "documents"), found={"text": found})).withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_license_scan": op2_license_scan,
    "op3_secret_scan": op3_secret_scan,
    "op4_warc_segments": op4_warc_segments,
    "op5_quality_rules": op5_quality_rules,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_source_mixing": op7_source_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_ball_tree_topk": op9_ball_tree_topk,
    "op10_edited_token_counts": op10_edited_token_counts,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_merkle_manifest": op13_merkle_manifest,
}
