import random

import pytest

from matchloom.operators import blocking as b


def names(spark, rows):
    return spark.createDataFrame([(i, x, n) for i, (x, n) in enumerate(rows)], "at long, entity_id string, name_core string")


def pairs(df):
    return sorted((r.source1_entity_id, r.source2_entity_id) for r in df.collect())


def test_exact_and_prefix(spark):
    one = names(spark, [("S1_1", "microsoft"), ("S1_2", "google")])
    two = names(spark, [("S2_1", "microsoft"), ("S2_2", "apple"), ("S2_3", "google"), ("S2_4", "micromax")])
    assert pairs(b.exact_pairs(one, two)) == [("S1_1", "S2_1"), ("S1_2", "S2_3")]
    assert pairs(b.generate_candidates(one, two)) == [("S1_1", "S2_1"), ("S1_1", "S2_4"), ("S1_2", "S2_3")]


def test_blank_names_pair_with_nothing(spark):
    blank = [("a", ""), ("b", None), ("c", "  ")]
    assert b.generate_candidates(names(spark, blank), names(spark, blank + [("d", "microsoft")])).count() == 0


def test_cap(spark):
    one = names(spark, [("x", "company_target")])
    for n, expected in ((1000, 1000), (1001, 0), (1501, 0)):
        two = names(spark, [(f"y{i}", f"company_{i}") for i in range(n)])
        assert b.generate_candidates(one, two).count() == expected
    two = names(spark, [(f"y{i}", f"company_{i}") for i in range(20)] + [("same", "company_target")])
    assert pairs(b.generate_candidates(one, two, max_prefix_block_size=10)) == [("x", "same")]


def test_against_nested_loops(spark):
    rnd = random.Random(3)
    make = lambda p, n: [(f"{p}{i}", rnd.choice([None, "", " ", "a"]) if rnd.random() < 0.2 else "".join(rnd.choice("abé") for _ in range(rnd.randint(1, 5)))) for i in range(n)]
    one, two = make("x", 60), make("y", 80)
    clean = lambda n: (n or "").strip()
    for cap in (1000, 15, 3):
        sizes = {}
        for _, n in two:
            if len(clean(n)) >= 3:
                sizes[clean(n)[:3]] = sizes.get(clean(n)[:3], 0) + 1
        expected = sorted((x, y) for x, n in one for y, m in two if clean(n) and (clean(n) == clean(m) or len(clean(n)) >= 3 and clean(n)[:3] == clean(m)[:3] and len(clean(m)) >= 3 and sizes[clean(m)[:3]] <= cap))
        assert pairs(b.generate_candidates(names(spark, one), names(spark, two), max_prefix_block_size=cap, index_column="at")) == expected


def test_measures(spark):
    df = spark.createDataFrame([(0, 0, "a", "x"), (0, 1, "a", "y"), (1, 2, "b", "z")], "source1_index long, source2_index long, source1_entity_id string, source2_entity_id string")
    assert tuple(b.candidate_volume(df).first()) == (3.0, 2.0, 3.0, 1.5)
    assert tuple(b.candidate_volume(df.limit(0)).first()) == (0.0, 0.0, 0.0, 0.0)
    truth = spark.createDataFrame([("a", "x, y,,q,x"), ("b", ""), ("c", None)], "source1_entity_id string, matched_entity_ids string")
    assert tuple(b.blocking_recall(df, truth).first()) == (4.0, 3.0, 0.75)
    found = b.blocking_performance(names(spark, [("a", "abc"), ("b", "q")]), names(spark, [("c", "abc"), ("d", "e"), ("f", "g")]))
    assert set(found) == {"runtime_seconds", "peak_memory_mb", "candidate_pairs"} and min(found.values()) >= 0


def test_lists(spark):
    df = spark.createDataFrame([(" S1-1 ", "S2-001, S2-002,,S3-001,S2-001"), ("S1-2", None), (None, "S2-1"), ("", "x")], "source1_entity_id string, candidate_entity_ids string")
    assert sorted(map(tuple, b.explode_candidates(df).collect())) == [("S1-1", "S2-001"), ("S1-1", "S2-002"), ("S1-1", "S3-001")]
    index = b.inverted_index(spark.createDataFrame([("1", " a"), ("2", "a"), ("3", None), ("4", " ")], "entity_id string, v string"), "v")
    assert [tuple(r) for r in index.collect()] == [("a", ["1", "2"])]


def test_missing_column(spark):
    good = names(spark, [("a", "b")])
    with pytest.raises(ValueError, match="source1.*name_core"):
        b.generate_candidates(good.drop("name_core"), good)
    with pytest.raises(ValueError, match="source2_index"):
        b.candidate_volume(good)
