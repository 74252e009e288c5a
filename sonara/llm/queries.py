"""One query per operator, each over its whole table with production parameters.

The operators return real outputs (texts, ids, pieces); the queries derive digests from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sonara.session import scratch_path

from . import (gru_lm, hard_negatives, html_template, lang_id, minhash, oracles, order_minhash, packing, quality, sharding,
               spelling, token_counts, transducer, wavelet)
from .common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shuffle_into_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), 16)
    return out.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                      F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = transducer.encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, threshold=80)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = lang_id.learned_rows()
    model = lang_id.fit(docs, learned)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return (lang_id.language_of(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score", "language.rejected"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *[f"__q.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                       "n_repeat_words", "base_failed", "kept")])


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = order_minhash.fingerprint_edits(table(spark, sf_dir, "documents").select("doc_id", "text"), filled=True)
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                      "edited_fingerprint", "near_edited", "near_next")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    wavelet.write_files(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return wavelet.read_ids(spark, path, digest=True)


QUERIES = {f.__name__: f for f in (op1_sharding, op2_bpe_codec, op3_minhash, op4_language_id, op5_quality_rules,
                                   op6_packing, op7_html_extraction, op8_token_counts, op9_lm_scoring,
                                   op10_order_minhash, op11_spelling_variants, op12_hard_negatives, op13_token_files)}
ORACLE = {"op3_minhash": oracles.near_duplicates_sql(), "op5_quality_rules": oracles.quality_sql(),
          "op11_spelling_variants": oracles.spelling_sql(), "op12_hard_negatives": oracles.hard_negatives_sql()}
