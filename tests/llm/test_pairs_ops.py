"""op1, op5, op6 against brute force and SQL."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from matchloom.llm import decontaminate, jaccard, queries, topk

DOCS = "doc_id long, text string"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, small, duck, name):
    mine, theirs = queries.QUERIES[name](spark, small).toPandas(), duck.execute(queries.SQL[name]).fetchdf()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows_of(mine) == rows_of(theirs)


# op1


def brute_topk(rows, asked, k):
    out = []
    for q, v in asked:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("seed,dim,n,kind", [(1, 3, 300, "few values"), (2, 8, 700, "clusters"), (3, 5, 40, "copies"), (4, 1, 9, "few values")])
def test_topk(spark, seed, dim, n, kind, monkeypatch):
    rnd = np.random.default_rng(seed)
    if kind == "few values":
        v = rnd.integers(-2, 3, (n, dim))
    elif kind == "clusters":
        v = rnd.integers(-900, 900, (10, dim))[rnd.integers(0, 10, n)] + rnd.integers(-30, 30, (n, dim))
    else:
        v = np.repeat(rnd.integers(-5, 6, (2, dim)), n // 2, 0)
    monkeypatch.setattr(topk, "GROUP", 1)
    monkeypatch.setattr(topk, "BLOCK", 8)
    monkeypatch.setattr(topk, "QUERIES", 5)
    rows = [(i, [int(x) for x in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    found = topk.top_k(df.where("vec_id % 10 = 0"), df, 7, n_pivots=5)
    assert sorted(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect())) == brute_topk(rows, rows[::10], 7)


def test_topk_one_pivot_for_copies(spark):
    rows = [(i, [7, 7]) for i in range(600)] + [(600 + i, [i, -i]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    asked = [r for r in rows if r[0] in (0, 605, 639)]
    found = topk.top_k(df.where("vec_id in (0, 605, 639)"), df, 3, n_pivots=8)
    assert sorted(map(tuple, found.collect())) == brute_topk(rows, asked, 3)


def test_topk_shared_query_id(spark):
    df = spark.createDataFrame([(1, [1, 0]), (1, [0, 3]), (2, [5, 1]), (3, [1, 5])], "vec_id long, v array<long>")
    found = topk.top_k(df.where("vec_id = 1"), df, 2)
    assert sorted(map(tuple, found.collect())) == [(1, 1, 3, 15), (1, 2, 2, 5)]


def test_topk_reach_leaves_far_annuli_out(spark):
    """Two clusters far apart: a pack reaches the annuli of its own cluster only."""
    rnd = np.random.default_rng(5)
    v = np.concatenate([rnd.integers(900, 1000, (200, 4)) * [1, 1, -1, -1], rnd.integers(900, 1000, (200, 4)) * [-1, 1, 1, -1]])
    top = float((v * v).sum(1).max()) + 1
    pivots = topk._lifted(v[[0, 399]], top)
    sent = spark.sparkContext.broadcast(pivots)
    asked, rows = v[:10], topk._lifted(v, top)
    floors = [sorted((int(q @ w) for w in v), reverse=True)[9] for q in asked]
    pack = pa.table({"pack": pa.array([3] * 10), "v": pa.array([list(map(int, q)) for q in asked], pa.list_(pa.int64())), "floor": pa.array(floors)})
    reach = topk._reacher(sent, 4, top)(pack).to_pydict()
    far = topk._far(rows, pivots)
    for p in range(2):
        inside = (far[:, p] >= reach["low"][p]) & (far[:, p] <= reach["high"][p])
        best = {i for q, f in zip(asked, floors, strict=True) for i in range(400) if int(q @ v[i]) >= f}
        assert all(inside[i] for i in best) and inside.sum() < 400


def test_topk_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (100, None), (200, [float("nan"), 1.0]), (300, [None, 1.0]), (400, [float("inf"), 0.0]), (1, [-0.0001, 0.5]), (2, [3.0]), (None, [1.0, 1.0]), (500, [])]
    vectors = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    kept = {r.vec_id: list(r.v) for r in vectors.collect()}
    assert kept == {0: [1024, 2048], 1: [-1, 512], 2: [3072], 500: []}
    found = sorted(map(tuple, topk.top_k(vectors.where("vec_id = 0"), vectors, 10).collect()))
    assert found == [(0, 1, 2, 3072 * 1024), (0, 2, 1, 512 * 2048 - 1024), (0, 3, 500, 0)]
    assert topk.top_k(vectors, vectors.limit(0), 10).count() == 0
    assert topk.top_k(vectors.limit(0), vectors, 10).count() == 0


# op5


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(docs, items):
    out = []
    for d, text in docs:
        w = words(text)
        hit, ids = set(), set()
        for i, t in items:
            b = words(t)
            for g in [b[k : k + 10] for k in range(max(1, len(b) - 9))] if b else []:
                for at in range(len(w) - len(g) + 1):
                    if w[at : at + len(g)] == g:
                        hit |= set(range(at, at + len(g)))
                        ids.add(str(i))
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def contamination(seed):
    rnd = random.Random(seed)
    make = lambda n, k: " ".join(rnd.choice("aA b cé d1 中 e-f".split()[:k]) for _ in range(n))
    items = [(i, make(rnd.choice([0, 1, 3, 9, 10, 11, 25]), 7)) for i in range(12)] + [(50, None), (51, "a a a a a a a a a a a a a a"), (52, "A, a. a! a a a a a a a a a a a"), (9, "q r")]
    docs = [(i, make(rnd.randint(0, 60), 7)) for i in range(25)]
    docs += [(100 + i, make(5, 7) + " ; " + (items[i][1] or "") + " " + make(3, 7)) for i in range(len(items))]
    return docs + [(900, None), (901, ""), (902, "a " * 40), (902, "q R"), (903, "r q")], items


@pytest.mark.parametrize("seed,slice_", [(1, 200_000), (2, 2)])
def test_matches(spark, seed, slice_, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE", slice_)
    docs, items = contamination(seed)
    d = spark.createDataFrame(docs, DOCS).withColumn("item_id", F.lit("clash"))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = decontaminate.score(decontaminate.find_matches(d, b)).drop("matches")
    assert sorted(map(tuple, found.collect())) == brute_hits(docs, items)
    kept = decontaminate.decontaminate(d, b)
    assert kept.columns == d.columns
    clean = {(r[0]) for r in brute_hits(docs, items) if not r[5]}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, t in docs if not brute_hits([(i, t)], items)[0][5])
    assert {r.doc_id for r in kept.collect()} <= clean | {902}
    assert decontaminate.score(decontaminate.find_matches(d, b.limit(0))).where("contaminated").count() == 0
    assert decontaminate.find_matches(d.limit(0), b).count() == 0


def test_longest_matches(spark):
    item = " ".join(f"w{i}" for i in range(30))
    doc = "x " + " ".join(f"w{i}" for i in range(5, 22)) + " y " + " ".join(f"w{i}" for i in range(12))
    d, b = spark.createDataFrame([(1, doc)], DOCS), spark.createDataFrame([(7, item)], "item_id long, text string")
    (row,) = decontaminate.find_matches(d, b).collect()
    assert sorted((m.item_id, m.start, m.stop) for m in row.matches) == [("7", 1, 18), ("7", 19, 31)]


# op6


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(docs):
    sets = [shingles(t) for _, t in docs]
    root = {d: d for d, _ in docs if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, _) in enumerate(docs):
        for j in range(i):
            b = docs[j][0]
            both = len(sets[i] & sets[j])
            if a is not None and b is not None and both and 100 * both >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted(((d, len(s), None if d is None else find(d)) for (d, _), s in zip(docs, sets)), key=str)


def corpus(seed, clusters, size, shared=0):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randint(0, 400)}"
    out, passage = [], [word() for _ in range(shared)]
    for _ in range(clusters):
        base = [word() for _ in range(rnd.randint(3, 60))]
        for _ in range(rnd.randint(1, size)):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                t[rnd.randrange(len(t))] = word()
            if rnd.random() < 0.3:
                t = t[rnd.randint(0, 4) :]
            out.append(t[: len(t) // 2] + passage + t[len(t) // 2 :] if rnd.random() < 0.6 else t)
    rnd.shuffle(out)
    return [(i * 3 % 1000003, " ".join(t)) for i, t in enumerate(out)]


@pytest.mark.parametrize("seed,clusters,size,shared,small", [(1, 30, 8, 0, 32), (2, 25, 10, 25, 3), (3, 3, 80, 10, 4), (4, 60, 2, 60, 2)])
def test_components(spark, seed, clusters, size, shared, small, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "TILE", 5)
    monkeypatch.setattr(jaccard, "STAR", 4)
    docs = corpus(seed, clusters, size, shared)
    if seed == 2:
        monkeypatch.setattr(jaccard, "BROADCAST", 0)
    found = jaccard.near_duplicates(spark.createDataFrame(docs, DOCS))
    assert sorted(map(tuple, found.collect()), key=str) == brute_components(docs)


def test_odd_documents(spark):
    long = " ".join(f"z{i}" for i in range(30_000))
    docs = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B\n"), (6, "b a"), (7, "a b c d e"), (8, "a b c d e f"), (9, long), (10, long + " x"), (11, "é É"), (11, "é É"), (None, "a b"), (20, "p q r s t"), (20, "a b")]
    df = spark.createDataFrame(docs, DOCS).withColumn("component_id", F.lit(0)).withColumn("id", F.lit("x"))
    found = jaccard.near_duplicates(df)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_components(docs)
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


def test_one_id_with_a_text_and_its_extension(spark):
    rnd = random.Random(9)
    docs = []
    for k in range(12):
        w = [f"k{k}w{rnd.randint(0, 5000)}" for _ in range(204)]
        near = list(w[:104])
        near[50] = "other"
        own, other = (100 + k, 200 + k) if k % 2 else (200 + k, 100 + k)
        docs += [(own, " ".join(w)), (own, " ".join(w[:104])), (other, " ".join(near))]
        if k % 3 == 0:
            docs.append((300 + k, " ".join(w[:200] + ["end"])))
    found = jaccard.near_duplicates(spark.createDataFrame(docs, DOCS).repartition(3))
    assert sorted(map(tuple, found.collect()), key=str) == brute_components(docs)


def test_required_prefix_overlap():
    rnd = random.Random(5)
    for _ in range(3000):
        pool = rnd.sample(range(10_000), 60)
        x = {p for p in pool if rnd.random() < 0.95}
        y = {p for p in pool if rnd.random() < 0.95}
        a, b = (np.array(sorted(s), np.uint64) for s in (x, y))
        common = np.array(sorted(rnd.sample(pool, 10)), np.uint64)
        if jaccard.linked(a, b):
            both = set(jaccard.prefix(a, common).tolist()) & set(jaccard.prefix(b, common).tolist())
            assert len(both) >= jaccard.must_share(len(a), len(b)) >= 1
        assert jaccard.linked(a, b) == (100 * len(x & y) >= 75 * len(x | y))


def test_connected_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = dict(map(tuple, jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    loops = {a for a, b in edges if a == b}
    assert {k: v for k, v in root.items() if k not in loops or k in found} == found
