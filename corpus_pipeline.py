"""The corpus pipeline: stages over the documents table, each written as Parquet and read again as the next one's docs.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last return the
columns of documents; the last returns the mixed corpus, in blocks.

Defined cases, in every stage: a null doc_id, source or lang is a value like others; rows that share a doc_id are rows of
their own; texts of any length are worked on whole; an empty table gives an empty one; extra columns, whatever their names, pass
through all stages but the last. What each stage does with null and empty texts, ties and repeated rows stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import decontaminate, jaccard, lines, mixing, quality
from matchloom.llm.common import cut, discard, read


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. All rows of a doc_id share its labels, yet each text is judged; null and empty
    texts have a score as others have; equal rows go or stay together."""
    return quality.keep_accepted(docs, read(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand elsewhere go from texts, all but the first by (doc_id, place), null doc_ids last; no row goes.
    n_chars, if there, is counted anew. Null and empty texts stay; rows equal in doc_id and text are one document here."""
    return lines.dedup_lines(docs, counts=False)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: the one with the smallest doc_id (null last), any one of equal rows.
    Null texts, and texts without words, are linked with nothing and stay."""
    pool: list[str] = []
    rows = cut(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-rows", pool)  # the number is the row's from here on
    found = jaccard.near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"))
    named = found.select(F.col("doc_id").alias("__row"), "component_id").join(rows.select("__row", "doc_id"), "__row")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row"))["__row"]
    grouped = named.groupBy("component_id").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = named.join(grouped, "component_id").where("__row != first").select("__row")
    return rows.join(gone, "__row", "left_anti").select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go; null and empty texts have none; equal rows go or stay together."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: shard, source, slot, n_words, doc_ids (a list, in the order of the block) and text of every block. Null and empty texts
    give nothing to it; equal rows are taken from each by itself."""
    return mixing.mixed_blocks(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources to target weights", mixing_stage),
]

#: Fitted densities and hashed draws can't be said in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = read(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "pipeline", written)
        discard(written, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)
