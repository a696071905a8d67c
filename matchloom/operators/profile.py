"""Column and ground-truth profiles, each one aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions.text import filled
from matchloom.functions.tables import TRUTH
from matchloom.operators.checks import require

DOMAIN_HINT = r"(?i)\.(?:com|in|net|org)(?![\p{L}\p{N}_])"
UNIQUE_CAP, EXAMPLES = 200_000, 5


def profile_columns(df: DataFrame, columns: list[str] | None = None, exact: bool = False) -> DataFrame:
    """A row per column: name, n_missing, n_empty_string, n_nonascii, length_min, length_max, length_sum, length_count,
    length_mean, unique_values, approx_unique_is_capped. Missing values count as empty, too.

    exact counts distinct values exactly, which shuffles every value of every column; else they are estimated."""
    columns = columns or df.columns
    aggs = []
    for i, c in enumerate(columns):
        v = filled(F.col(f"`{c}`").cast("string"))
        some = v != ""
        size = F.when(some, F.length(v))
        distinct = F.count_distinct(F.when(some, v)) if exact else F.approx_count_distinct(F.when(some, v))
        aggs += [
            F.coalesce(F.sum(F.col(f"`{c}`").isNull().cast("long")), F.lit(0)).alias(f"missing{i}"),
            F.coalesce(F.sum((~some).cast("long")), F.lit(0)).alias(f"empty{i}"),
            F.coalesce(F.sum(v.rlike(r"[^\x00-\x7F]").cast("long")), F.lit(0)).alias(f"foreign{i}"),
            F.min(size).cast("long").alias(f"low{i}"),
            F.max(size).cast("long").alias(f"high{i}"),
            F.coalesce(F.sum(size), F.lit(0)).cast("long").alias(f"sum{i}"),
            F.count(size).alias(f"count{i}"),
            distinct.alias(f"distinct{i}"),
        ]
    parts = ("missing", "empty", "foreign", "low", "high", "sum", "count", "distinct")
    names = ("n_missing", "n_empty_string", "n_nonascii", "length_min", "length_max", "length_sum", "length_count", "unique_values")
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("name"), *[F.col(f"{p}{i}").alias(n) for p, n in zip(parts, names, strict=True)]) for i, c in enumerate(columns)])
    return one.select(F.explode(rows).alias("r")).select(
        "r.*", F.try_divide("r.length_sum", "r.length_count").alias("length_mean"), (F.col("r.unique_values") >= UNIQUE_CAP).alias("approx_unique_is_capped")
    )


def example_values(df: DataFrame, order_by: str, columns: list[str], n: int = EXAMPLES) -> DataFrame:
    """name, place (from 1), value: the first non-empty values of each column in the given order."""
    each = [df.where(filled(F.col(c)) != "").orderBy(order_by).limit(n).select(F.lit(c).alias("name"), F.col(order_by).alias("at"), F.col(c).cast("string").alias("value")) for c in columns]
    rows = reduce(DataFrame.unionByName, each)
    return rows.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("v")).select("name", F.posexplode("v").alias("place", "v")).select("name", (F.col("place") + 1).alias("place"), "v.value")


def domain_hint(df: DataFrame, column: str = "business_name") -> DataFrame:
    """row_count, domain_style_name_count, domain_style_name_rate: names that hold a domain ending anywhere."""
    hits = F.coalesce(F.sum(filled(F.col(column)).rlike(DOMAIN_HINT).cast("long")), F.lit(0))
    rows = F.count("*")
    return df.agg(rows.alias("row_count"), hits.alias("domain_style_name_count"), F.coalesce(F.try_divide(hits, rows), F.lit(0.0)).alias("domain_style_name_rate"))


def profile_truth(truth: DataFrame) -> DataFrame:
    """Counts of singletons and matches. Lists split at commas only, without trimming, blanks inside counted."""
    require(truth, TRUTH, "ground truth")
    ids = filled(F.col("matched_entity_ids"))
    some = ids != ""
    parts = F.when(some, F.split(ids, ","))
    starts = lambda p: F.size(F.filter(parts, lambda x: x.startswith(p)))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    one = truth.select((~some).cast("long").alias("alone"), F.when(some, F.size(parts)).alias("n"), F.when(some, starts("S2-")).alias("s2"), F.when(some, starts("S3-")).alias("s3")).agg(
        count("alone").alias("n_singleton"), F.count("n").alias("n_nonsingleton"), count("n").alias("total_matches"), F.coalesce(F.max("n"), F.lit(0)).cast("long").alias("max_matches"), count("s2").alias("s2_match_count"), count("s3").alias("s3_match_count")
    )
    return one.select(
        "n_singleton", "n_nonsingleton",
        F.coalesce(F.try_divide(F.col("n_singleton"), F.col("n_singleton") + F.col("n_nonsingleton")), F.lit(0.0)).alias("singleton_rate"),
        "total_matches",
        F.coalesce(F.try_divide("total_matches", "n_nonsingleton"), F.lit(0.0)).alias("avg_matches_per_nonsingleton"),
        "max_matches", "s2_match_count", "s3_match_count",
    )


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def head_of(scored: DataFrame, n: int = 20, column: str = "calibrated_score") -> DataFrame:
    """The n pairs of the highest scores, ties by ids."""
    return scored.orderBy(F.desc(column), "source1_entity_id", "candidate_entity_id").limit(n)


def score_summary(df: DataFrame, column: str = "calibrated_score") -> DataFrame:
    """count, mean, std, min, quartiles (interpolated), max."""
    quarter = [F.percentile(column, F.lit(q)).alias(n) for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]
    return df.agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev(column).alias("std"), F.min(column).alias("min"), *quarter, F.max(column).alias("max"))
