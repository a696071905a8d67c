"""Corpus TF-IDF of character n-grams and cosines of text pairs, as relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions.similarity import grams, ngram_text


def char_tfidf(texts: DataFrame, id_column: str = "id", text_column: str = "text") -> DataFrame:
    """id, gram, w: weights of 2- to 4-grams with idf = ln((1 + n) / (1 + df)) + 1, of length 1 per text."""
    clean = texts.select(F.col(id_column).alias("id"), ngram_text(F.col(text_column)).alias("clean"))
    rows = clean.select("id", F.explode(grams(F.col("clean"))).alias("gram"))
    counts = rows.groupBy("id", "gram").agg(F.count("*").alias("tf"))
    total = texts.agg(F.count("*").alias("n"))
    weights = counts.groupBy("gram").agg(F.count("*").alias("df")).crossJoin(F.broadcast(total)).select("gram", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    raw = counts.join(weights, "gram").select("id", "gram", (F.col("tf") * F.col("idf")).alias("w"))
    return raw.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id"))))


def pair_cosine(first: DataFrame, second: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (i, j) plus cosine of text i of first and text j of second (both as char_tfidf gives them); 0 without a common n-gram."""
    a = first.select(F.col("id").alias("i"), "gram", F.col("w").alias("w1"))
    b = second.select(F.col("id").alias("j"), "gram", F.col("w").alias("w2"))
    keys = pairs.select("i", "j").distinct()
    dots = keys.join(a, "i").join(b, ["j", "gram"]).groupBy("i", "j").agg(F.sum(F.col("w1") * F.col("w2")).alias("cosine"))
    return pairs.join(dots, ["i", "j"], "left").withColumn("cosine", F.coalesce("cosine", F.lit(0.0)))


def pair_cosine_lists(first: DataFrame, second: DataFrame, indices1: list[int], indices2: list[int], spark=None) -> DataFrame:
    """The same for two index lists of equal length, in their order (column place)."""
    if len(indices1) != len(indices2):
        raise ValueError("index lists must have the same length")
    spark = spark or first.sparkSession
    pairs = spark.createDataFrame([(k, int(i), int(j)) for k, (i, j) in enumerate(zip(indices1, indices2, strict=True))], "place long, i long, j long")
    return pair_cosine(first, second, pairs)
