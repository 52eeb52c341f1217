"""A corpus pipeline of five stages over the table documents.

Each stage is a function (spark, docs, sf_dir) to a DataFrame; run() writes each stage's result as Parquet in the shared
folder and hands the reread table to the next. All but the last return the columns of documents (doc_id, text, lang,
source, n_chars). doc_id names a document: it should be unique. Null columns are allowed; an empty table passes through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, jaccard, langid, mixing, recompress
from tidemark.llm.common import stage, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null texts and texts without a letter go, and nothing else.

    Where no document is labelled, one nameless language stands for all, so that the same texts go.
    """
    langs, matrix = langid.fit(docs.where(langid.fold_of(F.col("doc_id"), 5) != 0))
    if not langs:
        langs, matrix = ["any"], np.zeros((langid.BUCKETS, 1), np.float32)
    known = langid.predict(docs.select(*COLUMNS), langs, matrix)
    return known.where(F.col("lang_pred") != langid.UNKNOWN).select(*COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest doc_id.

    Documents without an id are larger than all; of a group of such documents alone all stay.
    """
    first = jaccard.classes(docs).where(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias("kept")).distinct()
    return docs.select(*COLUMNS).join(first, F.col("doc_id").eqNullSafe(F.col("kept")), "left_semi").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the word windows that documents with smaller ids hold as well; all documents stay."""
    kept = recompress.remove_repeats(docs.select(*COLUMNS))
    length = F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", length.alias("n_chars"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    scanned = decontam.scan(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return scanned.where(F.size("hits") == 0).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target, taken words, and the shards that get them."""
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", mixing.taken_words().alias("taken"), mixing.shard_words().alias("shards"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

#: Language ID, similarity joins and window repeats can't be stated in SQL that runs on whole tables; tests compare the
#: stages with brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
