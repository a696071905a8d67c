"""The row-wise operators on streams: normalization, and blocking of a stream against a static table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions import text as t
from matchloom.functions.tables import RAW_SCHEMA
from matchloom.operators.blocking import MAX_BLOCK, oversized_prefixes
from matchloom.operators.normalize import normalize


def read_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Raw TSV files as they arrive in a folder, empty cells as empty strings."""
    df = spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", files_per_batch).csv(path, sep="\t", header=True, quote='"', escape='"')
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in df.columns])


def normalize_stream(stream: DataFrame, source_name: str) -> DataFrame:
    """Normalization has no state: the batch projection as it is."""
    return normalize(stream, source_name)


def block_stream(stream: DataFrame, target: DataFrame, name: str = "name_core", cap: int = MAX_BLOCK) -> DataFrame:
    """Distinct-by-key candidate pairs of streamed source-1 rows against a static target; a pair with equal names comes once."""
    n = t.strip(t.filled(F.col(name)))
    keyed = lambda df: df.select(F.col("entity_id").alias("id"), n.alias("n"), F.explode(t.blocking_keys(F.col(name))).alias("key"))
    large = oversized_prefixes(target, name, cap).select(F.concat(F.lit("name_prefix:"), "prefix_key").alias("key"))
    x, y = keyed(stream).alias("x"), keyed(target).join(large, "key", "left_anti").alias("y")
    met = x.join(y, F.expr("x.key = y.key"))
    once = met.where("x.n != y.n or x.key like 'name:%'")  # equal names meet under both keys
    return once.select(F.col("x.id").alias("source1_entity_id"), F.col("y.id").alias("source2_entity_id"))
