"""The queries of this package's operators, over whole tables and with production parameters, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, chunks, compression, lbl, licenses, packing, sharding, simhash, spotsigs, toxicity, trie, warc
from .common import table

SHARDS = 24
SEQUENCE_TOKENS = 2048


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_records(table(spark, sf_dir, "documents"), SHARDS)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return out.select("doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer_path("byte_bpe_multi_50k.tiktoken"), bpe_pattern()
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, pattern)
    out = bpe.decode(encoded, ranks, pattern)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chunks.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "n_chunks", "removed_bytes", "removed_spans")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), SEQUENCE_TOKENS, ids_digest=True)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spotsigs.edited_likeness(table(spark, sf_dir, "documents"))
    prints = [spotsigs.fingerprint(c).alias(n) for c, n in (("signatures", "fingerprint"), ("edited_signatures", "edited_fingerprint"))]
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"), *prints, "near_edited", "near_next")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).drop("payload")


def op10_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compression_rules(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl.log_bilinear_scores(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_sharding, op2_bpe, op3_substrings, op4_packing, op5_simhash, op6_licenses, op7_toxicity, op8_spotsigs, op9_warc, op10_compression,
        op11_prefix_trie, op12_filter_audit, op13_log_bilinear,
    )
    return {f.__name__: f for f in own}


def base32_sql(hex_digits: str) -> str:
    """A SHA-1 in hex as base32, in DuckDB: of each 40 bits eight letters."""
    word = "('0x' || substr({}, {}, 10))::bigint"
    letters = [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({word.format(hex_digits, 1 + 10 * k)} >> {35 - 5 * j}) & 31)::int + 1, 1)" for k in range(4) for j in range(8)]
    return " || ".join(letters)


def oracle_sql() -> dict[str, str]:
    """Of the other operators' results, SQL knows no hashes, tokenizers, models or compressors: tests hold them against brute force."""
    return {
        "op9_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages)
SELECT page_id, strlen(html)::bigint AS payload_bytes, {base32_sql('digest')} AS payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM p
""",
        "op11_prefix_trie": trie.SQL,
        "op12_filter_audit": audit.SQL,
    }
