"""Corpus cleaning pipeline: quality, near copies, repeats, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on every document that its
predecessor kept and returns a DataFrame; all but the last return the columns
of ``documents``.

Defined results: null and empty texts are rejected by the first stage. Copies
have one class and the row with its smallest id stays (each of its rows, if the
id repeats); a row with a null id is linked with nothing, loses no words and is
packed. An empty table gives an empty table. Columns other than those of
``documents`` are dropped by the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import minhash, packing, quality, secret_scan, substring_dedup
from lodestrata.llm.common import cut, table
from lodestrata.llm.queries import VOCABULARY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, with n_chars counted anew."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the ordinal classifier, fitted on the labels table, rejects."""
    model = quality.fit(docs, quality.grades_of_labels(table(spark, sf_dir, "labels")))
    return quality.select_rows(docs.select(*COLUMNS), model)


def keep_representatives(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (similarity 0.8 on five-word shingles) keep the smallest id."""
    groups = minhash.near_duplicates(docs, percent=80)
    kept = groups.where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut windows of words that an earlier document has."""
    return _columns(substring_dedup.remove(docs.select(*COLUMNS)))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret found by a mark."""
    return _columns(secret_scan.redact(secret_scan.find(docs.select(*COLUMNS))))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all remaining documents into sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality classifier", keep_quality),
    ("near dedup", keep_representatives),
    ("substring dedup", cut_repeats),
    ("secret scan", redact_secrets),
    ("best-fit packing", pack),
]

#: SQL cannot express the stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are kept in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
