"""Prepares a corpus for training; each stage works on all documents that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm.decontamination import decontaminate
from gustline.llm.jaccard_join import near_duplicates
from gustline.llm.language import UNKNOWN_LANGUAGE, identify_language
from gustline.llm.line_templates import drop_recurring_lines
from gustline.llm.packing import pack_documents
from gustline.llm.shared import scratch, table, written

# From this score on, a prediction outweighs a document's label.
SURE = 0.25


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and so do those whose text is surely in another language than their label says.

    Documents without a label get the predicted one.
    """
    others = [F.col(c).alias(f"own_{c}") for c in docs.columns if c != "text"]
    found = identify_language(docs, labelled=docs, keep=others, with_text=True)
    found = found.where(F.col("lang_pred") != UNKNOWN_LANGUAGE)
    mislabelled = (F.col("own_lang") != F.col("lang_pred")) & (F.col("score") >= SURE)
    kept = found.where(~F.coalesce(mislabelled, F.lit(False)))
    kept = kept.withColumn("own_lang", F.coalesce("own_lang", "lang_pred"))
    return kept.select([F.col(c if c == "text" else f"own_{c}").alias(c) for c in docs.columns])


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(docs).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document with the smallest id stays; documents without words stay too.

    A document is told by its id and a hash of its text, as ids may be used again for other texts. Rows without
    an id belong to no group. Of rows that repeat a document's id and text, one stays.
    """
    groups = written(near_duplicates(docs), "groups").where("doc_id IS NOT NULL AND n_shingles > 0")
    first = groups.groupBy("component").agg(F.min(F.struct("doc_id", "key")).alias("first")).select("first.*")
    worded = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # One shuffle of the texts: the aggregate finds the rows where the join left them.
    kept = docs.where(worded).withColumn("key", F.xxhash64("text")).join(first, ["doc_id", "key"], "left_semi")
    once = kept.groupBy("doc_id", "key").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return docs.where(~worded).union(once)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    keys = found.select("text_a", "text_b").distinct()
    marked = docs.withColumns({"text_a": F.xxhash64("text"), "text_b": F.xxhash64(F.lit("b"), F.col("text"))})
    return marked.join(keys, ["text_a", "text_b"], "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("language", known_language),
    ("lines", without_recurring_lines),
    ("near_duplicates", one_of_each_group),
    ("benchmarks", without_benchmarks),
    ("packing", packed),
]

# The stages tokenise, learn and walk automata, which SQL can't express: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a written table before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
