"""Schemas and fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

RAW = ("entity_id", "business_name", "business_address", "country")
TRUTH = ("source1_entity_id", "matched_entity_ids")
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW])
TRUTH_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in TRUTH])

# Legal suffix to canonical form.
SUFFIXES = {
    "pvt": "private_limited",
    "private": "private_limited",
    "pvt ltd": "private_limited",
    "pvt. ltd.": "private_limited",
    "ltd": "limited",
    "limited": "limited",
    "inc": "incorporated",
    "incorporated": "incorporated",
    "corp": "corporation",
    "corporation": "corporation",
    "llc": "llc",
    "l.l.c": "llc",
    "co": "company",
    "company": "company",
}

# Address abbreviations.
ABBREVIATIONS = {
    "apt": "apartment",
    "av": "avenue",
    "ave": "avenue",
    "blvd": "boulevard",
    "ct": "court",
    "dr": "drive",
    "fl": "floor",
    "hwy": "highway",
    "ln": "lane",
    "no": "number",
    "pl": "place",
    "rd": "road",
    "sq": "square",
    "st": "street",
    "ste": "suite",
}

# The pair features, in the order that models take them.
FEATURES = (
    "name_jaro_winkler",
    "name_levenshtein",
    "name_token_jaccard",
    "name_containment",
    "name_prefix_similarity",
    "name_char_ngram_cosine",
    "name_phonetic_match",
    "address_token_jaccard",
    "address_number_tolerant_match",
    "address_string_similarity",
    "country_match",
    "name1_empty",
    "name2_empty",
    "address1_empty",
    "address2_empty",
    "is_source2_pair",
    "is_source3_pair",
)

# Strings that a reader with missing-value inference takes as missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# White space of str.split(), and letters without a canonical decomposition in plain letters.
WHITE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WHITE_SIGNS = "".join(chr(c) for a, b in ((9, 13), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)) for c in range(a, b + 1))
PLAIN = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L", "ı": "i", "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-"}
