"""Entity tables made of the driver's tables, in DataFrame form and, for the checks, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.operators.features import FIELDS, FLAGS
from matchloom.operators.normalize import normalize
from matchloom.sources.scratch import scratch, written  # noqa: F401

#: Endings of names by doc_id modulo 8, none for the rest.
ENDINGS = (" Pvt. Ltd.", " Inc", " LLC", ", Corp.", " Private Limited")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and the raw columns: names are the first 40 characters of a text, addresses a number and all the rest of it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", "source")
    if docs.rdd.getNumPartitions() < (cores := spark.sparkContext.defaultParallelism):
        docs = docs.repartition(cores, "doc_id")  # a table of one row group would be normalized in one task
    k = F.when(F.col("source") == "src0", "1").when(F.col("source").isin(*[f"src{i}" for i in range(1, 10)]), "2").otherwise("3")
    ending = F.lit("")
    for i, e in enumerate(ENDINGS):
        ending = F.when(F.col("doc_id") % 8 == i, e).otherwise(ending)
    return docs.select(
        "doc_id",
        F.concat(F.lit("S"), k, F.lit("-"), F.col("doc_id")).alias("entity_id"),
        F.concat(F.left("text", F.lit(40)), ending).alias("business_name"),
        F.concat((F.col("doc_id") % 50).cast("string"), F.lit(" "), F.expr("substring(text, 41)")).alias("business_address"),
        F.col("lang").alias("country"),
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and the raw columns, of whole columns of the suppliers."""
    key = F.col("s_suppkey")
    ending = F.lit("")
    for i, x in enumerate(ENDINGS):
        ending = F.when(key % 8 == i, x).otherwise(ending)
    address = F.concat(key * 7 % 90, F.lit(" St no "), "s_nationkey", F.lit(", "), F.reverse("s_name"))
    return table(spark, sf_dir, "supplier").select(
        key.alias("doc_id"),
        F.concat(F.lit("S"), key % 3 + 1, F.lit("-"), key).alias("entity_id"),
        F.concat("s_name", ending).alias("business_name"),
        F.when(key % 11 == 0, "").otherwise(address).alias("business_address"),
        F.concat(F.lit("nation "), F.col("s_nationkey") % 5).alias("country"),
    )


def sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Normalized entities of the first source, and of the second and third."""
    needed = ("doc_id", "entity_id", *FIELDS, *FLAGS)  # blocking and features read no other column
    every = written(normalize(entities(spark, sf_dir), "S0").select(*needed), "entities")
    return every.where("entity_source = 'S1'"), every.where("entity_source != 'S1'")


def heads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, entity_id, name_core) with plain lower-cased heads as names, of the first source and the others."""
    every = entities(spark, sf_dir).select("doc_id", "entity_id", F.lower(F.left("business_name", F.lit(40))).alias("name_core"))
    return every.where("entity_id like 'S1-%'"), every.where("entity_id not like 'S1-%'")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth: records of other sources with an equal head, as sorted comma lists; empty for the rest."""
    one, rest = heads(spark, sf_dir)
    met = rest.groupBy("name_core").agg(F.array_join(F.array_sort(F.collect_list("entity_id")), ",").alias("ids"))
    return one.join(met, "name_core", "left").select(F.col("entity_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("matched_entity_ids"))


_ENDING = "CASE doc_id % 8 " + " ".join(f"WHEN {i} THEN '{e}'" for i, e in enumerate(ENDINGS)) + " ELSE '' END"

#: Common table expressions that the SQL of the catalog starts with.
SQL = rf"""
e AS (
  SELECT doc_id, 'S' || CASE WHEN source = 'src0' THEN '1' WHEN source IN ({", ".join(f"'src{i}'" for i in range(1, 10))}) THEN '2' ELSE '3' END || '-' || doc_id AS entity_id,
    left(coalesce(text, ''), 40) || {_ENDING} AS business_name, (doc_id % 50) || ' ' || substr(coalesce(text, ''), 41) AS business_address, lang AS country
  FROM documents
),
n1 AS (
  SELECT *, trim(regexp_replace(business_name, '\s+', ' ', 'g')) AS name_clean, trim(regexp_replace(business_address, '\s+', ' ', 'g')) AS address_clean,
    regexp_extract(entity_id, '^(S[0-9]+)-', 1) AS entity_source FROM e
),
n2 AS (SELECT *, lower(name_clean) AS name_lower FROM n1),
n AS (
  SELECT *,
    CASE WHEN regexp_matches(name_lower, '[\s,.\-]*(incorporated|corporation|pvt\. ltd\.|private|limited|pvt ltd|company|l\.l\.c|corp|pvt|ltd|inc|llc|co)[\s.\-]*$')
      THEN trim(regexp_replace(trim(regexp_replace(name_lower, '[\s,.\-]*(incorporated|corporation|pvt\. ltd\.|private|limited|pvt ltd|company|l\.l\.c|corp|pvt|ltd|inc|llc|co)[\s.\-]*$', ''), ' ,.-'), '\s+', ' ', 'g'))
      ELSE name_lower END AS name_core,
    regexp_extract(name_lower, '[\s,.\-]*(incorporated|corporation|pvt\. ltd\.|private|limited|pvt ltd|company|l\.l\.c|corp|pvt|ltd|inc|llc|co)[\s.\-]*$', 1) AS ending
  FROM n2
),
h AS (SELECT doc_id, entity_id, lower(left(business_name, 40)) AS name_core FROM e),
h1 AS (SELECT * FROM h WHERE entity_id LIKE 'S1-%'),
h2 AS (SELECT * FROM h WHERE entity_id NOT LIKE 'S1-%'),
m AS (SELECT name_core, string_agg(entity_id, ',' ORDER BY entity_id) AS ids FROM h2 GROUP BY name_core),
truth AS (SELECT entity_id AS source1_entity_id, coalesce(ids, '') AS matched_entity_ids FROM h1 LEFT JOIN m USING (name_core))
"""

_SUPPLIER_ENDING = _ENDING.replace("doc_id", "s_suppkey")
#: The same with suppliers for entities.
SUPPLIER_SQL = f"""
e AS (
  SELECT s_suppkey AS doc_id, 'S' || (s_suppkey % 3 + 1) || '-' || s_suppkey AS entity_id, s_name || {_SUPPLIER_ENDING} AS business_name,
    CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE (s_suppkey * 7 % 90) || ' St no ' || s_nationkey || ', ' || reverse(s_name) END AS business_address, 'nation ' || (s_nationkey % 5) AS country
  FROM supplier
),
n1 AS {SQL.split("n1 AS", 1)[1]}"""
