"""Scalar normalization as Column builders. All but NFKC and transliteration stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchloom.functions import vectorized
from matchloom.functions.tables import ABBREVIATIONS, SUFFIXES, WHITE, WHITE_SIGNS

#: Beyond ASCII and the range of Latin-1 that NFKC leaves as it is.
BEYOND_LATIN = r"[^\x00-\x7F\x{C0}-\x{FF}]"
TLD = r"\.(com|in|net|org|co|biz|info)(\.[a-z]{2})?"


def filled(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def squeeze(c: Column) -> Column:
    """Runs of white space to one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, rf"[{WHITE}&&[^ ]]{WHITE}*| {WHITE}+", " "))  # single blanks stay as they are


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SIGNS))


def non_ascii(c: Column) -> Column:
    return F.length(c) != F.octet_length(c)


def clean(c: Column) -> Column:
    """NFKC and squeezed; null to empty. Names and addresses alike. Rows that don't need it reach the Python worker as null."""
    c = filled(c)
    return squeeze(F.coalesce(vectorized.nfkc(F.when(non_ascii(c) & c.rlike(BEYOND_LATIN), c)), c))


def to_ascii(c: Column) -> Column:
    c = filled(c)
    return F.coalesce(vectorized.ascii_text(F.when(non_ascii(c), c)), c)


def clean_ascii(raw: Column) -> Column:
    """to_ascii of clean, from the raw value, so that one pass through the Python worker gives both; null where that is clean itself."""
    return vectorized.clean_ascii(F.when(non_ascii(raw), raw))


def is_domain(raw: Column) -> Column:
    bare = strip(filled(raw))
    fits = F.regexp_replace(F.lower(bare), r"^www\.", "").rlike(r"^[a-zA-Z0-9][a-zA-Z0-9\-]*" + TLD + r"\z")
    return F.when(F.contains(bare, F.lit(".")) & ~F.contains(bare, F.lit(" ")), fits).otherwise(False)  # few names need the patterns


def domain_name(raw: Column) -> Column:
    """The words of a domain-style name, null for others."""
    bare = F.regexp_replace(strip(filled(raw)), r"(?i)^www\.", "")
    bare = F.regexp_replace(bare, "(?i)" + TLD + r"\z", "")
    spaced = F.translate(F.regexp_replace(bare, r"(?<=[a-z0-9])(?=[A-Z])", " "), "-_", "  ")
    return F.when(is_domain(raw), F.lower(squeeze(spaced)))


KEYS = sorted(SUFFIXES, key=len, reverse=True)
SUFFIX = rf"[\s,.\-]*({'|'.join(k.replace('.', chr(92) + '.') for k in KEYS)})[\s.\-]*\z"
#: The same read from the end, where it is anchored: the longest key that fits, whatever marks stand behind it.
_ENDING = "^(?:" + "|".join(rf"[\s.\-]*{k[::-1].replace('.', chr(92) + '.')}" for k in KEYS) + r")[\s,.\-]*"


def _ending(bare: Column) -> Column:
    """The legal suffix of a stripped name, with the marks around it; empty if there is none."""
    return F.reverse(F.regexp_extract(F.reverse(bare), _ENDING, 0))


def strip_suffix(name_lower: Column) -> Column:
    """Lower-cased name without its legal suffix. There need be nothing between name and suffix: zinc gives z."""
    bare = strip(name_lower)
    end = _ending(bare)
    return F.when(end != "", squeeze(F.btrim(F.left(bare, F.length(bare) - F.length(end)), F.lit(" ,.-")))).otherwise(bare)


def suffix_of(name_lower: Column) -> Column:
    table = F.create_map(*[F.lit(x) for item in SUFFIXES.items() for x in item])
    return F.try_element_at(table, F.regexp_extract(_ending(strip(name_lower)), SUFFIX, 1))


def name_tokens(core: Column) -> Column:
    """Words in order, repeats kept."""
    return F.array_remove(F.split(filled(core), r"[^\p{L}\p{N}_]+"), "")


def address_tokens(cleaned: Column) -> Column:
    table = F.create_map(*[F.lit(x) for item in ABBREVIATIONS.items() for x in item])
    found = F.regexp_extract_all(F.lower(filled(cleaned)), F.lit(r"[\p{L}\p{Nl}\p{No}]+|\p{Nd}+(?:/\p{Nd}+)?"), F.lit(0))
    return F.transform(found, lambda t: F.coalesce(F.try_element_at(table, t), t))


def numbers(raw: Column) -> Column:
    return F.regexp_extract_all(filled(raw), F.lit(r"\p{Nd}+(?:/\p{Nd}+)?"), F.lit(0))


def title(c: Column) -> Column:
    """str.title(): a capital behind everything but a letter with case; of a letter with two capitals the second is small."""
    cased = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"
    runs = F.regexp_extract_all(strip(filled(c)), F.lit(f"[{cased}]+|[^{cased}]+"), F.lit(0))

    def capital(run: Column) -> Column:
        first = F.upper(F.left(run, F.lit(1)))
        return F.concat(F.left(first, F.lit(1)), F.lower(F.substring(first, F.lit(2), F.length(first))), F.lower(F.substring(run, F.lit(2), F.length(run))))

    return F.array_join(F.transform(runs, capital), "")


def source_of(entity_id: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(filled(entity_id), r"^(S\p{Nd}+)-", 1), F.lit("")), F.lit(default))


def matched_ids(c: Column) -> Column:
    """Distinct ids of a list split at the first of | , ; that it holds at all; blanks dropped, null to empty."""
    sep = F.when(F.contains(c, F.lit("|")), F.split(c, r"\|")).when(F.contains(c, F.lit(",")), F.split(c, ",")).otherwise(F.split(c, ";"))
    ids = F.array_distinct(F.filter(F.transform(sep, strip), lambda t: t != ""))
    return F.coalesce(ids, F.array().cast("array<string>"))


def blocking_keys(name: Column, length: int = 3) -> Column:
    """name:<n> and, of names as long as that, name_prefix:<first characters>; none for blank names."""
    n = strip(filled(name))
    keys = F.array(F.concat(F.lit("name:"), n), F.when(F.length(n) >= length, F.concat(F.lit("name_prefix:"), F.left(n, F.lit(length)))))
    return F.when(n == "", F.array().cast("array<string>")).otherwise(F.array_compact(keys))
