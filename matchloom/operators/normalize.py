"""Normalization: a raw entity table to raw plus 16 derived columns, row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions import text as t
from matchloom.functions.tables import RAW
from matchloom.operators.checks import require

# The derived columns, in their order.
DERIVED = (
    "entity_source", "name_clean", "name_lower", "name_ascii", "name_is_domain_style", "name_domain_cleaned", "name_core", "name_suffix_norm",
    "name_tokens", "name_is_empty", "address_clean", "address_ascii", "address_tokens", "address_numbers", "address_is_empty", "country_norm",
)


def normalize(df: DataFrame, source_name: str) -> DataFrame:
    """Raw columns as they are (others pass through), then DERIVED. A narrow projection, which streams as well.

    Both that needs Python, NFKC and ASCII forms, is made of the raw columns at once, in one pass; the rest reads cleaned columns."""
    require(df, RAW, source_name)
    name, address = F.col("business_name"), F.col("business_address")
    cleaned = df.withColumns({"name_clean": t.clean(name), "address_clean": t.clean(address), "__name": t.clean_ascii(name), "__address": t.clean_ascii(address)})
    spelled = cleaned.withColumns({"name_ascii": F.coalesce("__name", "name_clean"), "address_ascii": F.coalesce("__address", "address_clean")})
    lowered = spelled.withColumn("name_lower", F.lower("name_clean"))
    cored = lowered.withColumns({"name_core": t.strip_suffix(F.col("name_lower")), "name_suffix_norm": t.suffix_of(F.col("name_lower"))})
    full = cored.withColumns(
        {
            "entity_source": t.source_of(F.col("entity_id"), source_name),
            "name_is_domain_style": t.is_domain(name),
            "name_domain_cleaned": F.nullif(t.domain_name(name), F.lit("")),
            "name_tokens": t.name_tokens(F.col("name_core")),
            "name_is_empty": F.length(t.filled(name)) == 0,
            "address_tokens": t.address_tokens(F.col("address_clean")),
            "address_numbers": t.numbers(address),
            "address_is_empty": F.length(t.filled(address)) == 0,
            "country_norm": t.title(F.col("country")),
        }
    )
    return full.select(*df.columns, *[c for c in DERIVED if c not in df.columns])
