import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchloom.functions import similarity as s
from matchloom.functions import vectorized as v
from matchloom.operators import features, tfidf
from matchloom.functions.tables import FEATURES

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
NAME = st.text(alphabet="abcdwhys é राZ", max_size=10)
PAIRS = st.lists(st.tuples(NAME, NAME), min_size=30, max_size=60)


def both(spark, rows, f, kind="string"):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], f"i long, a {kind}, b {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("a"), F.col("b"))).collect()]


@pytest.mark.parametrize(
    "f,a,b,expected",
    [
        (s.indel, "williams", "wilblims", 0.875),
        (s.jaro_winkler, "wayne", "wanye", 0.946667),
        (s.jaro_winkler, "abcd", "abxy", 0.666667),
        (s.ngram_cosine, "williams", "wilblims", 0.162976),
        (s.ngram_cosine, "atlantic", "atlantic pinnacle deli", 0.422234),
        (s.ngram_cosine, "a", "a", 0.0),
        (s.common_prefix, " Lantern", "lantern HILL bakery ", 7 / 19),
        (s.common_prefix, "same", "same", 1.0),
        (s.containment, " ABC ", "xabcx", 1.0),
        (s.containment, "", "x", 0.0),
        (lambda a, b: s.same_code(s.phonetic(a), s.phonetic(b)), "wayne", "wanye", 1.0),
        (s.same_text, " us", "US", 1.0),
    ],
)
def test_values(spark, f, a, b, expected):
    assert both(spark, [(a, b)], f)[0] == pytest.approx(expected, abs=1e-6)
    if f is not s.same_text:
        assert both(spark, [(a, None), (None, None), ("", "")], f) == [0.0, 0.0, 0.0]


def test_codes(spark):
    df = spark.createDataFrame([("wayne", "W500"), ("ashcraft", "A226"), ("राम", "र000"), ("", ""), ("12", "")], "a string, code string")
    assert all(r[0] == r[1] for r in df.select(s.phonetic(F.col("a")), "code").collect())


def test_numbers(spark):
    rows = [(["3928"], ["3930"]), (["3928"], ["3931"]), (["1/2"], ["1/2"]), ([], ["1"]), (["१२"], ["14"]), (None, ["1"])]
    assert both(spark, rows, s.near_numbers, "array<string>") == [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]
    assert both(spark, [(["a", "a", "b"], ["b", "c"]), ([], ["b"]), (None, ["b"])], s.jaccard, "array<string>") == pytest.approx([1 / 3, 0, 0])


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _next(row, x, b)
    return row[-1]


def _next(row, x, b):
    new = [0]
    for j, y in enumerate(b):
        new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
    return new


def plain_cosine(a, b):
    def counts(x):
        x = x.strip().lower()
        while "  " in x:
            x = x.replace("  ", " ")
        return Counter(x[i : i + n] for n in (2, 3, 4) for i in range(len(x) - n + 1))

    x, y = counts(a), counts(b)
    w = {g: 1.0 if g in x and g in y else math.log(1.5) + 1 for g in x | y}
    norm = math.sqrt(sum((n * w[g]) ** 2 for g, n in x.items())) * math.sqrt(sum((n * w[g]) ** 2 for g, n in y.items()))
    return sum(x[g] * y[g] for g in x if g in y) / norm if norm else 0.0


@SLOW
@given(PAIRS)
def test_against_plain_python(spark, rows):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i long, a string, b string")
    a, b = F.col("a"), F.col("b")
    found = df.select("i", s.indel(a, b).alias("x"), s.ngram_cosine(a, b).alias("y"), s.common_prefix(a, b).alias("z")).orderBy("i").collect()
    assert [r.x for r in found] == pytest.approx([2 * plain_lcs(a, b) / (len(a) + len(b)) if a and b else 0.0 for a, b in rows])
    assert [r.y for r in found] == pytest.approx([plain_cosine(a, b) for a, b in rows])
    low = [(a.strip().lower(), b.strip().lower()) for a, b in rows]
    prefix = [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) / max(len(a), len(b)) if a and b else 0.0 for a, b in low]
    assert [r.z for r in found] == pytest.approx(prefix)


def test_jaro_winkler_of_duckdb(spark):
    import random

    import duckdb

    rnd = random.Random(1)
    rows = [("".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 9))), "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 9)))) for _ in range(500)]
    theirs = [duckdb.execute("SELECT jaro_winkler_similarity(?, ?)", r).fetchone()[0] for r in rows]
    assert [v.jaro_winkler(*r) for r in rows] == pytest.approx(theirs)


RECORD = "entity_id string, name_core string, address_clean string, name_tokens array<string>, address_tokens array<string>, address_numbers array<string>, country_norm string, entity_source string"


def test_pair_features(spark):
    row = lambda i, k: (i, "abc", "123 main street", ["abc"], ["123", "main", "street"], ["123"], "us", k)
    one = spark.createDataFrame([row("S1-1", "S1")], RECORD)
    two, three = spark.createDataFrame([row("S2-1", "S2"), row("X", "S2")], RECORD), spark.createDataFrame([row("S3-1", "S3"), row("X", "S3")], RECORD)
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-1", "X"), ("S1-1", "lost")], "source1_entity_id string, candidate_entity_id string")
    rows = {r.candidate_entity_id: r for r in features.pair_features(one, features.with_fallback(two, three), pairs).collect()}
    assert sorted(rows) == ["S2-1", "S3-1", "X"]
    assert list(rows["X"].asDict())[2:] == list(FEATURES)
    assert [(r.is_source2_pair, r.is_source3_pair) for r in (rows["S2-1"], rows["S3-1"], rows["X"])] == [(1, 0), (0, 1), (1, 0)]
    assert all(rows["S2-1"][c] == pytest.approx(1.0) for c in FEATURES[:11]) and not any(rows["S2-1"][c] for c in FEATURES[11:15])
    with pytest.raises(KeyError, match="lost"):
        features.training_features(one, two, three, pairs)
    assert features.pair_features(one, two, pairs.limit(0)).count() == 0


def test_corpus_tfidf(spark):
    texts = spark.createDataFrame([(0, "williams"), (1, "wilblims"), (2, "completely different"), (3, ""), (4, None)], "id long, text string")
    w = tfidf.char_tfidf(texts)
    found = [r.cosine for r in tfidf.pair_cosine_lists(w, w, [0, 0, 0, 3], [1, 2, 0, 3]).orderBy("place").collect()]
    assert found[0] > 0 and found[1] >= 0 and found[2] == pytest.approx(1.0) and found[3] == 0.0
    with pytest.raises(ValueError):
        tfidf.pair_cosine_lists(w, w, [0], [1, 2])
