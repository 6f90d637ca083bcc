"""Queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fill_middle, importance, language, minhash, packing, quality, secret_scan, substring_dedup, suffix_dedup, toxicity, vectors
from .common import table

#: Public vocabulary used by the encoding and packing queries.
VOCABULARY = "word_bpe_49k.json"


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op4_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_products(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, 10)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    model = language.fit(docs.where(~F.col("held_out")))
    found = language.predict(docs, model)
    return found.withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 4 == 2).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, quality.grades_of_labels(table(spark, sf_dir, "labels")))
    return quality.score(docs, model)


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest_cosine(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, model).withColumn("held_out", held_out).select("doc_id", "held_out", "score", "predicted")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_bpe": op2_bpe,
    "op3_substring": op3_substring,
    "op4_suffix": op4_suffix,
    "op5_topk": op5_topk,
    "op6_language": op6_language,
    "op7_packing": op7_packing,
    "op8_quality": op8_quality,
    "op9_ann": op9_ann,
    "op10_minhash": op10_minhash,
    "op11_fill_middle": op11_fill_middle,
    "op12_toxicity": op12_toxicity,
    "op13_importance": op13_importance,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {"op1_secrets": secret_scan.duckdb_sql(), "op11_fill_middle": fill_middle.duckdb_sql(), "op13_importance": importance.duckdb_sql()}
