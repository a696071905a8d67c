"""Features of blocked pairs, tile by tile, against the pairwise functions and the joins of listed pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchloom.functions import tiles
from matchloom.functions import vectorized as v
from matchloom.functions.tables import FEATURES
from matchloom.operators import blocking, features, model
from matchloom.operators.normalize import normalize
from matchloom.plans import catalog
from matchloom.sources.scratch import written


def words(rnd, n, signs="abcdé😀 \0"):
    return "".join(rnd.choice(signs) for _ in range(rnd.randint(0, n)))


def records(spark, seed, n=70):
    rnd = random.Random(seed)
    names = ["abc one", "abc two inc", "abd", "ab", "x", "", None, "abc one", "straße 7", "abc\\n"]
    rows = [(k, f"S{rnd.choice('123')}-{k}", rnd.choice(names), rnd.choice([None, "", f"{rnd.randint(1, 9)} st {words(rnd, 30)}", "12 st no 7/8 rd", "१२ st"]), rnd.choice([None, "us", "US"])) for k in range(n)]
    every = normalize(spark.createDataFrame(rows, "doc_id long, entity_id string, business_name string, business_address string, country string"), "S0")
    odd = F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("a\nb"), F.lit("a"), F.lit("\\n"), F.lit(""), F.lit(None))).when(F.col("doc_id") % 7 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("\n")))
    every = every.withColumn("name_tokens", F.coalesce(odd, F.col("name_tokens"))).cache()
    return every.where("entity_source = 'S1'"), every.where("entity_source != 'S1'")


def both_ways(spark, wanted, cap=1000):
    one, rest = records(spark, 5)
    found = blocking.generate_candidates(one, rest, max_prefix_block_size=cap, index_column="doc_id")
    listed = features.pair_features(one, rest, found.select("source1_entity_id", F.col("source2_entity_id").alias("candidate_entity_id")))
    keys = ["source1_entity_id", "candidate_entity_id"]
    plain = lambda df: {r[:2]: [round(x, 9) for x in r[2:]] for r in df.select(*keys, *wanted).collect()}
    tiled = features.block_features(one, rest, wanted, cap)
    assert tiled.count() == listed.count() > 100
    return plain(tiled), plain(listed)


@pytest.mark.parametrize("cap", [1000, 12])
def test_blocked_features_are_those_of_listed_pairs(spark, monkeypatch, cap):
    for name, value in (("ROWS", 4), ("ALIGNED_ROWS", 3), ("CHARS", 40), ("PAIRS", 7)):
        monkeypatch.setattr(features, name, value)
    tiled, listed = both_ways(spark, list(FEATURES), cap)
    assert tiled == listed


@pytest.mark.parametrize("query", ["feat_token_jaccard", "feat_ngram_cosine", "feat_indel", "pair_features"])
def test_no_list_of_pairs_is_joined_with_records(spark, small, query):
    """What is shuffled grows with the records, not with the pairs: a join only stands below the tiles."""
    plan = catalog.QUERIES[query](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan[: plan.index("MapInArrow")]


def test_jaccard():
    a, b = [["a", "b"], [], None, ["a"] * 3], [["b", "c"], ["a"], []]
    assert tiles.jaccard(a, b) == pytest.approx(np.array([[1 / 3, 1 / 2, 0], [0, 0, 0], [0, 0, 0], [0, 1, 0]]))


def test_ngram_cosine(monkeypatch):
    monkeypatch.setattr(tiles, "COLUMNS", 5)
    found = tiles.ngram_cosine(["williams", "atlantic", "a", ""], ["wilblims", "atlantic pinnacle deli", "a"])
    assert found == pytest.approx(np.array([[0.162976, found[0, 1], 0], [found[1, 0], 0.422234, 0], [0, 0, 0], [0, 0, 0]]), abs=1e-6)
    assert tiles.ngram_cosine(["ab" * 9000], ["ab" * 9000]) == pytest.approx(1.0)  # sums beyond float32


@pytest.mark.parametrize("bits", [30, 200, 1 << 16])
def test_indel(monkeypatch, bits):
    monkeypatch.setattr(tiles, "BITS", bits)
    rnd = random.Random(bits)
    a, b = ([*(words(rnd, 60) for _ in range(25)), "", None, "\0x"] for _ in range(2))
    assert tiles.indel(a, b).tolist() == [[v.indel(x, y) for y in b] for x in a]


def test_near_numbers():
    assert tiles.near_numbers([["3928"], []], [["3930"], ["3931", "7"], []]).tolist() == [[1, 0, 0], [0, 0, 0]]


def test_blocked_pairs_are_scored_as_listed_ones(spark):
    one, rest = records(spark, 6, 40)
    found = blocking.generate_candidates(one, rest, index_column="doc_id").select("source1_entity_id", F.col("source2_entity_id").alias("candidate_entity_id"))
    rows = features.pair_features(one, rest, found).withColumn("label", (F.col("name_levenshtein") > 0.9).cast("int")).cache()
    package, _ = model.train(rows, trees=1, depth=2, folds=2)
    plain = lambda df: sorted(tuple(r)[:2] + (round(r[2], 9),) for r in df.collect())
    assert plain(model.predict_blocked(one, rest, package)) == plain(model.predict(one, rest, found, package))


def test_listed_pairs_in_tiles(spark, monkeypatch):
    """Many listed pairs are compared in tiles, with the values of the joins; repeated ones stay and unknown ones go."""
    one, rest = records(spark, 8, 40)
    ids = lambda df, name: df.select(F.col("entity_id").alias(name), F.crc32("entity_id").alias(name[0]))
    found = ids(one, "source1_entity_id").crossJoin(ids(rest, "candidate_entity_id")).where("(s + c) % 3 > 0").select("source1_entity_id", "candidate_entity_id", (F.col("s") % 2).cast("int").alias("label"))
    found = written(found.unionByName(found.limit(5)).unionByName(spark.createDataFrame([("S1-none", "none", 1)], found.schema)), "found")
    joined = features.pair_features(one, rest, found)
    monkeypatch.setattr(features, "ALIGNED_ROWS", 6)
    monkeypatch.setattr(features, "CHARS", 300)
    listed = features.listed_features(one, rest, found)
    assert "MapInArrow" in (plan := listed._jdf.queryExecution().optimizedPlan().toString()) and "Join " not in plan
    assert listed.schema.names == joined.schema.names and [f.dataType for f in listed.schema] == [f.dataType for f in joined.schema]
    plain = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    assert plain(listed) == plain(joined)
    assert "Join " in features.listed_features(one, rest, found.limit(3))._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("query", ["feat_ngram_cosine", "feat_name_indel", "feat_flags"])
def test_records_are_normalized_once(spark, small, query):
    """Checks, counts and tiles read the written columns, not the documents again."""
    plan = catalog.QUERIES[query](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "business_name" not in plan and "text#" not in plan


def test_rounded(spark):
    rnd = random.Random(1)
    values = [0.0, 1.0, 0.5, 0.0000005, 0.1234565, 0.1234575, 0.9999995, *(round(rnd.random(), 6) + 5e-7 for _ in range(500)), *(rnd.random() for _ in range(500))]
    known = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(F.round("v", 6)).collect()]
    assert features.rounded(np.array(values), 6).tolist() == known


def test_copies_of_long_records_are_bounded(spark, monkeypatch):
    """However many tiles of the least size a block would have, a record with its address goes to few."""

    def counted(batches, *_):
        n = sum(b.num_rows for b in batches)
        yield pa.RecordBatch.from_pydict({"source1_entity_id": [str(n)], "candidate_entity_id": [""], "address_string_similarity": [0.0]})

    monkeypatch.setattr(features, "_met", counted)
    monkeypatch.setattr(features, "ALIGNED_ROWS", 5)
    every = spark.range(600).selectExpr("id as doc_id", "concat('S', id % 2 + 1, '-', id) as entity_id", "'abc one' as business_name", "concat(id, ' st') as business_address", "'us' as country")
    every = normalize(every, "S0")
    sent = features.block_features(every.where("entity_source = 'S1'"), every.where("entity_source != 'S1'"), ["address_string_similarity"])
    assert 600 < sum(int(r[0]) for r in sent.collect()) <= (features.COPIES + 1) * 600


@pytest.mark.parametrize("gap", [1, 3, 12])
def test_carries_between_texts(monkeypatch, gap):
    monkeypatch.setattr(tiles, "GAP", gap)
    a, b = ["ab" * 50, "b" * 90, "a"], ["ba" * 60, "a" * 100, "xyz"]
    assert tiles.lcs(a, b).tolist() == [[v.lcs(x, y) for y in b] for x in a]


def test_the_longer_side_lies_side_by_side(monkeypatch):
    seen, number = [], tiles._number
    monkeypatch.setattr(tiles, "_number", lambda bits: seen.append(len(bits)) or number(bits))
    assert tiles.lcs(["abc"], ["xbc"] * 50).tolist() == [[2] * 50] and min(seen) >= 150
