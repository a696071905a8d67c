"""The functions that Spark has no built-in for, as Arrow-batched pandas UDFs over plain Python ones."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.tables import PLAIN

try:  # a full transliteration where it is installed
    from unidecode import unidecode
except ImportError:
    unidecode = None


class _Spelled(dict):
    """Code point to what stands for it: Latin letters spelled out, marks dropped, other scripts as they are. Filled as signs come."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        spelled = PLAIN.get(c, c)
        self[point] = out = "".join(x for x in unicodedata.normalize("NFKD", spelled) if not unicodedata.combining(x))
        return out


_SPELLED = _Spelled()


def ascii_of(text: str) -> str:
    """Transliterated if the library is there; else sign by sign, as marks dropped need no order."""
    return unidecode(text) if unidecode else text.translate(_SPELLED)


def clean_ascii_of(text: str) -> str:
    return ascii_of(" ".join(nfkc_of(text).split()))


def nfkc_of(text: str) -> str:
    return unicodedata.normalize("NFKC", text)


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence; one big-integer step per character of b."""
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    rest = full = (1 << len(a)) - 1
    for c in b:
        hit = rest & places.get(c, 0)
        rest = (rest + hit | rest - hit) & full
    return len(a) - rest.bit_count()


def indel(a: str | None, b: str | None) -> float:
    """2 lcs / (|a| + |b|); 0 if either is empty."""
    if not a or not b:
        return 0.0
    return 1.0 if a == b else 2 * lcs(a, b) / (len(a) + len(b))


def jaro_winkler(a: str | None, b: str | None) -> float:
    """Prefix weight 0.1 on four characters at most, given above a similarity of 0.7; 0 if either is empty."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free = [True] * len(b)
    own = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                own.append(c)
                break
    if not own:
        return 0.0
    other = [c for c, f in zip(b, free, strict=True) if not f]
    m = len(own)
    moved = sum(x != y for x, y in zip(own, other, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro <= 0.7:
        return jaro
    same = 0
    while same < min(4, len(a), len(b)) and a[same] == b[same]:
        same += 1
    return jaro + 0.1 * same * (1 - jaro)


def _pairwise(f):
    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple, float] = {}
        out = []
        for pair in zip(a, b, strict=True):
            v = known.get(pair)
            if v is None:
                v = known[pair] = f(*pair)
            out.append(v)
        return pd.Series(out, dtype="float64")

    return run


def _mapped(f):
    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(f, na_action="ignore")

    return run


indel_similarity = _pairwise(indel)
jaro_winkler_similarity = _pairwise(jaro_winkler)
nfkc = _mapped(nfkc_of)
ascii_text = _mapped(ascii_of)
clean_ascii = _mapped(clean_ascii_of)
