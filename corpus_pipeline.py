"""A corpus for training from raw documents, in five stages: toxicity, quality rules, near-duplicates, repeated passages, packing."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.llm import chunks, compression, packing, simhash, toxicity
from genoweave.llm.common import shared_dir, table
from genoweave.llm.queries import SEQUENCE_TOKENS, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, doesn't call toxic. Null texts stay."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands. Null and empty texts go: they have under 50 words."""
    return compression.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, at a Jaccard similarity of five-word shingles of 0.8 or more, the document with the smallest id. Rows with a null id stay."""
    return simhash.drop_near_duplicates(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one with a smaller id has; those left without words go. n_chars is counted anew."""
    out = chunks.dedup_substrings(docs)
    left = out.where((F.col("removed_bytes") == 0) | F.col("text").rlike(r"[^\s]")).select(*docs.columns)
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces and their places in sequences: doc_id, piece, start, length, ids, sequence_id, offset."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), SEQUENCE_TOKENS)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("best_fit_packing", packing_stage),
]

#: No SQL expresses a trained classifier, zstandard or rolling hashes: the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of sf_dir, each written as Parquet in the shared folder and read again."""
    place = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{k}-{name}")
        docs = spark.read.parquet(f"{place}/{k}-{name}")
    return docs
