"""A corpus pipeline: quality rules, language identification, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run``
writes every stage's result as Parquet to the shared folder and rereads it.

Defined results: documents with null or empty text fail the quality rules' base and go, those without a
letter go with the languages; of repeated rows, copies and near copies one row stays, the one of the
smallest doc_id (null ids last; ties by place in the table); very long texts are taken whole; extra columns are
carried to the last stage; an empty table gives no pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sonara.llm import lang_id, minhash, packing, quality
from sonara.llm.common import staged


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised quality rules keep."""
    return quality.score_quality(docs, keep=docs.columns).where("__q.kept").select(*docs.columns)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to a learned language; text without a letter goes."""
    model = lang_id.fit(docs, lang_id.learned_rows())
    return lang_id.language_of(docs, model, "__language").where("NOT __language.rejected").select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each near-duplicate group; rows, not ids, are told apart."""
    rows = staged(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    groups = minhash.near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"))
    ids = rows.select("__row", F.col("doc_id").alias("id"))
    first = F.min(F.struct(F.col("id").isNull(), "id", "__row"))
    kept = (groups.select(F.col("doc_id").alias("__row"), "component_id").join(ids, "__row")
            .groupBy("component_id").agg(first["__row"].alias("__row")).select("__row"))
    return rows.join(kept, "__row", "left_semi").select(*docs.columns)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full token sequences."""
    out = packing.pack(docs)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality rules", keep_good), ("language id", keep_known_language),
          ("near duplicates", keep_one_of_each_group), ("packing", pack_tokens)]
ORACLE_SQL = None  # language identification and tokenising are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
