"""Blocking: candidate pairs by equal names and by equal name prefixes, and what they cost and recover."""

from __future__ import annotations

import resource
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions import text as t
from matchloom.operators.checks import require

MAX_BLOCK = 1000
PAIR = ("source1_index", "source2_index", "source1_entity_id", "source2_entity_id")


def _keyed(df: DataFrame, name: str, index: str | None) -> DataFrame:
    at = F.col(index).cast("long") if index else F.monotonically_increasing_id()
    return df.select(at.alias("at"), F.col("entity_id").alias("id"), t.strip(t.filled(F.col(name))).alias("n"))


def oversized_prefixes(source2: DataFrame, name: str = "name_core", cap: int = MAX_BLOCK) -> DataFrame:
    """prefix_key, n: prefixes of more than cap target rows."""
    keys = source2.select(t.strip(t.filled(F.col(name))).alias("n")).where(F.length("n") >= 3)
    return keys.groupBy(F.left("n", F.lit(3)).alias("prefix_key")).agg(F.count("*").alias("n")).where(F.col("n") > cap)


def exact_pairs(source1: DataFrame, source2: DataFrame, name: str = "name_core", index: str | None = None) -> DataFrame:
    """Pairs of equal, non-blank names."""
    x, y = (_keyed(s, name, index).where("n != ''") for s in (source1, source2))
    return _pairs(x.withColumn("key", F.col("n")), y.withColumn("key", F.col("n")))


def prefix_pairs(source1: DataFrame, source2: DataFrame, name: str = "name_core", cap: int = MAX_BLOCK, index: str | None = None) -> DataFrame:
    """Pairs of equal first three characters, without prefixes of more than cap target rows."""
    x, y = (_keyed(s, name, index).where(F.length("n") >= 3).withColumn("key", F.left("n", F.lit(3))) for s in (source1, source2))
    large = oversized_prefixes(source2, name, cap).select(F.col("prefix_key").alias("key"))
    return _pairs(x, y.join(large, "key", "left_anti"))


def _pairs(x: DataFrame, y: DataFrame) -> DataFrame:
    a = x.select("key", F.col("at").alias("source1_index"), F.col("id").alias("source1_entity_id"))
    b = y.select("key", F.col("at").alias("source2_index"), F.col("id").alias("source2_entity_id"))
    return a.join(b, "key").select(*PAIR)


def generate_candidates(source1: DataFrame, source2: DataFrame, name_column: str = "name_core", max_prefix_block_size: int = MAX_BLOCK, index_column: str | None = None) -> DataFrame:
    """PAIR of both blocks, each pair once: one join on the rows' keys in place of two.

    index_column gives the rows' indices; without one they are generated and differ between runs. Blank names
    block with nothing. Of a prefix only its target rows are capped. AQE splits skewed keys."""
    for df, what in ((source1, "source1"), (source2, "source2")):
        require(df, ["entity_id", name_column], what)
    x, y = (_keyed(s, name_column, index_column).withColumn("key", F.explode(t.blocking_keys(F.col("n")))) for s in (source1, source2))
    large = oversized_prefixes(source2, name_column, max_prefix_block_size).select(F.concat(F.lit("name_prefix:"), "prefix_key").alias("key"))
    return _pairs(x, y.join(large, "key", "left_anti")).dropDuplicates(["source1_index", "source2_index"])


def inverted_index(df: DataFrame, column: str, id_column: str = "entity_id") -> DataFrame:
    """value and the sorted ids that have it, blanks left out."""
    v = t.strip(t.filled(F.col(column)))
    return df.select(v.alias("value"), id_column).where("value != ''").groupBy("value").agg(F.array_sort(F.collect_list(id_column)).alias("ids"))


def candidate_volume(pairs: DataFrame) -> DataFrame:
    """total_candidate_pairs, unique_source1_entities, unique_source2_entities, avg_candidates_per_source1 as doubles."""
    require(pairs, ["source1_index", "source2_index"], "candidates")
    one = pairs.agg(F.count("*").cast("double").alias("total_candidate_pairs"), F.count_distinct("source1_index").cast("double").alias("unique_source1_entities"), F.count_distinct("source2_index").cast("double").alias("unique_source2_entities"))
    return one.withColumn("avg_candidates_per_source1", F.coalesce(F.try_divide("total_candidate_pairs", "unique_source1_entities"), F.lit(0.0)))


def blocking_recall(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """total_true_pairs, recovered_true_pairs, blocking_recall. Lists split at commas; a repeated id counts again."""
    require(pairs, ["source1_entity_id", "source2_entity_id"], "candidates")
    require(truth, ["source1_entity_id", "matched_entity_ids"], "ground_truth")
    lists = truth.select("source1_entity_id", F.explode(F.split("matched_entity_ids", ",")).alias("id"))
    true = lists.select("source1_entity_id", t.strip(F.col("id")).alias("source2_entity_id"))
    known = pairs.select("source1_entity_id", "source2_entity_id").distinct().withColumn("hit", F.lit(1))
    met = true.where("source2_entity_id != ''").join(known, ["source1_entity_id", "source2_entity_id"], "left")
    one = met.agg(F.count("*").cast("double").alias("total_true_pairs"), F.count("hit").cast("double").alias("recovered_true_pairs"))
    return one.withColumn("blocking_recall", F.coalesce(F.try_divide("recovered_true_pairs", "total_true_pairs"), F.lit(0.0)))


def blocking_performance(source1: DataFrame, source2: DataFrame, **options) -> dict[str, float]:
    """runtime_seconds, peak_memory_mb (of the driver's process) and candidate_pairs of one run."""
    began = time.perf_counter()
    n = generate_candidates(source1, source2, **options).count()
    return {"runtime_seconds": time.perf_counter() - began, "peak_memory_mb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024, "candidate_pairs": float(n)}


def to_candidate_lists(pairs: DataFrame) -> DataFrame:
    """source1_entity_id and its candidates' ids, sorted and joined by commas."""
    ids = F.array_join(F.array_sort(F.collect_set("source2_entity_id")), ",")
    return pairs.groupBy("source1_entity_id").agg(ids.alias("candidate_entity_ids"))


def explode_candidates(lists: DataFrame) -> DataFrame:
    """Distinct (source1_entity_id, candidate_entity_id) of comma-joined lists; blanks and nulls dropped."""
    require(lists, ["source1_entity_id", "candidate_entity_ids"], "candidates")
    rows = lists.select(t.strip(F.col("source1_entity_id")).alias("source1_entity_id"), F.explode(F.split("candidate_entity_ids", ",")).alias("id"))
    return rows.select("source1_entity_id", t.strip(F.col("id")).alias("candidate_entity_id")).where("source1_entity_id != '' and candidate_entity_id != ''").distinct()
