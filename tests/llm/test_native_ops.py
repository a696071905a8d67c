"""op8, op9 and op10: exact round trips, brute force, and odd input."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from matchloom.llm import chat, lines, mixing

TALK = "conv_id long, turn long, role string, text string"


def test_chat_round_trip(spark):
    rnd = random.Random(4)
    bits = [*chat.CONTROL, "\\", "\\\\", "<", "<|", "|>", "[", "é", "\n", " x ", "<\\|im_end|>", "$1", "😀"]
    rows = []
    for c in range(40):
        for k in range(rnd.randint(1, 7)):
            rows.append((c, k, rnd.choice(["user", "assistant", "system", "tool <s>", None]), None if rnd.random() < 0.1 else "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9)))))
    rows += [(99, 1, "assistant", "same"), (99, 1, "assistant", "same"), (99, None, "user", "first"), (None, 0, "user", "no id")]
    df = spark.createDataFrame(rows, TALK).withColumn("examples", F.lit("clash"))
    expected = {}
    by = defaultdict(list)
    for c, k, r, t in rows:
        by[c].append(((k is not None, k), r or "", t or ""))
    for c, turns in by.items():
        turns.sort()
        all_text = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        said = "".join(t for _, r, t in turns if r == "assistant")
        expected[c] = (len(turns), hashlib.sha256(all_text.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    expanded = chat.expand(chat.render(df)).cache()
    assert {r[0]: tuple(r)[1:5] for r in chat.read_back(expanded).collect()} == expected
    examples = chat.materialise(expanded).collect()
    assert sum(r.loss_len is not None for r in examples) == sum(r[2] == "assistant" for r in rows)
    assert {r[0]: r[5] for r in chat.read_back(expanded).collect()} == dict(Counter([r.conv_id for r in examples for _ in r.text]))
    without = expanded.withColumn("example", F.when(F.col("no") > 2, F.col("example")))  # what is read back hangs on the examples
    assert {r[0]: r.loss_sha256 for r in chat.read_back(without).collect()} != {r[0]: r.loss_sha256 for r in chat.read_back(expanded).collect()}
    for r in examples:
        body = r.text.removeprefix(chat.OPEN).removesuffix(chat.CLOSE)
        assert not any(m in x for x in re.split("|".join(map(re.escape, (chat.OPEN, chat.SEP, chat.CLOSE))), body) for m in chat.CONTROL)
    assert chat.format_chat(df.limit(0)).count() == 0


def test_chat_examples(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e")]
    found = chat.format_chat(spark.createDataFrame(rows, TALK)).orderBy("example").collect()
    assert [r.text[r.loss_at : r.loss_at + r.loss_len] if r.loss_len else None for r in found] == ["b", "d", None]
    assert found[1].text.startswith(found[0].text) and found[2].text.startswith(found[1].text)


def test_chat_expansion_gives_a_row_per_example(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "tool", "c2"), (1, 4, "assistant", "d"), (1, 5, "user", "e"), (2, 0, "assistant", "f"), (3, 0, "user", "g"), (4, 0, "assistant", None), (4, 1, "assistant", "h")]
    expanded = chat.expand(chat.render(spark.createDataFrame(rows, TALK))).cache()
    found = sorted(expanded.collect(), key=lambda r: (r.conv_id, r.no))
    assert [(r.conv_id, r.no, r.added.count(chat.OPEN)) for r in found] == [(1, 2, 2), (1, 5, 3), (1, 6, 1), (2, 1, 1), (3, 1, 1), (4, 1, 1), (4, 2, 1)]
    assert [r.added[r.example.loss_at - r.start :][: r.example.loss_len] if r.example.loss_at is not None else None for r in found] == ["b", "d", None, "f", None, "", "h"]
    assert [r.start for r in found] == [0, *(b.start and a.example.stop for a, b in zip(found, found[1:]))]
    fewer = {r.conv_id: r for r in chat.read_back(expanded.where("no != 5")).collect()}  # without an example, its turns and its target are gone
    assert (fewer[1].n_turns, fewer[1].loss_chars) == (3, 1)


def plain_targets(sizes):
    """Shares by weight; what is above twice a source goes to the rest by weight, until nothing is."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    out, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            out |= {s: level * weight[s] for s in free}
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def mixed_corpus(seed):
    rnd = random.Random(seed)
    sources = ["b", "a", None, "é", "Z", "hot"]
    docs = [(i, " ".join(f"d{i}_{k}" for k in range(rnd.choice([0, 1, 3, 100, 129, 700]))), rnd.choice(sources) if rnd.random() < 0.6 else "hot") for i in range(120)]
    return docs + [(900, None, "a"), (901, "", "empty"), (902, None, "empty"), (5, "again once", "b"), (None, "no id", "a"), (903, "one", "single")]


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, seed):
    docs = mixed_corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    rows = mixing.mix(df).collect()
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len((t or "").split())
    expected = plain_targets(sizes)
    assert len(rows) == len(docs)
    assert sorted((str(r.doc_id), r.size) for r in rows) == sorted((str(i), len((t or "").split())) for i, t, _ in docs)
    taken = Counter()
    for r in rows:
        assert r.target == pytest.approx(expected[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - expected[s]) <= max(1, mixing.TOLERANCE * expected[s]) for s in sizes)
    assert any(abs(taken[s] - expected[s]) > 1 for s in sizes)  # it is the draws that decide
    again = mixing.mix(df.repartition(7)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, again)) == sorted(map(key, rows))
    assert sorted(map(key, mixing.mix(df, seed=5).collect())) != sorted(map(key, rows))
    assert mixing.mix(df.limit(0)).count() == 0


def test_draws_are_multinomial(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TOLERANCE", 1.0)
    plan = spark.createDataFrame([("a", 600_000, 0, 1_000_000.0), ("b", 500_000, 1, 300_000.0), (None, 900, 2, 0.0)], "source string, source_size long, src long, target double")
    drawn, n = mixing.draw(plan, 5, [], 128, 64)
    by_shard = defaultdict(dict)
    for r in drawn.collect():
        by_shard[r.shard][r.src] = r.c
    every = round(-(-600_000 // 128) * 10 / 6 + -(-500_000 // 128) * 3 / 5)
    assert n == len(by_shard) == -(-every // 64) and sum(sum(c.values()) for c in by_shard.values()) == every
    shares = [c.get(0, 0) / 64 for s, c in by_shard.items() if sum(c.values()) == 64]
    mean = sum(shares) / len(shares)
    assert mean == pytest.approx(10 / 13, abs=0.02)
    assert sum((x - mean) ** 2 for x in shares) / len(shares) == pytest.approx(mean * (1 - mean) / 64, rel=0.5)  # not even shares
    taken = {r.src: r.n for r in mixing.slots(plan, 5, []).groupBy("src").agg(F.sum("words").alias("n")).collect()}
    again = {r.src: r.n for r in mixing.slots(plan, 6, []).groupBy("src").agg(F.sum("words").alias("n")).collect()}
    assert taken != again  # other draws, other words


def brute_blocks(docs, slots):
    """Blocks by hand, given which rows stand where and which slots took which block."""
    out = {}
    for src, slot, blk, words in slots:
        stream = [(d, w) for at, d, text in sorted(docs[src], key=lambda x: x[0]) for w in (text or "").split()]
        part = stream[blk * mixing.BLOCK : (blk + 1) * mixing.BLOCK][:words]
        out[src, slot] = (" ".join(w for _, w in part), len(part))
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_mixed_text(spark, seed):
    """Rows that share doc_id, or have none, and size or text keep their own words; told and mixed words agree."""
    docs = mixed_corpus(seed) + [(5, "one two three", "b"), (5, "four five six", "b"), (None, "seven eight", "a"), (None, "nine ten", "a"), (7, "same row", "b"), (7, "same row", "b"), (5, "one two three", "hot")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("name", F.lit("clash"))
    blocks = mixing.mixed_blocks(df).collect()
    told = Counter()
    for r in mixing.mix(df).collect():
        told[r.source, r.doc_id] += r.taken
    counts = Counter()
    for r in blocks:
        assert len(r.text.split(" ")) == r.n_words <= mixing.BLOCK
        counts[r.source] += r.n_words
    by_source = Counter()
    for (s, _), n in told.items():
        by_source[s] += n
    assert +counts == +by_source
    mine = Counter((s, w) for _, t, s in docs for w in (t or "").split())
    mixed = Counter((r.source, w) for r in blocks for w in r.text.split())
    assert set(mixed) <= set(mine) and all(n <= 2 * mine[k] for k, n in mixed.items())
    per_doc = Counter()
    for (s, w), n in mixed.items():
        if m := re.match(r"d(\d+)_", w):
            per_doc[s, int(m[1])] += n
    assert {k: n for k, n in told.items() if n and k[1] is not None and k[1] < 900 and k[1] not in (5, 7)} == {k: n for k, n in per_doc.items() if k[1] not in (5, 7)}
    # The streams and slots put together by hand
    pool = []
    plan, placed = mixing._plan(df, 11, pool)
    text = {(r.flags, r.id, r.name, r.hash): t for r, (_, t, _) in zip(mixing._keyed(df).collect(), docs)}
    streams = defaultdict(list)
    for r in placed.collect():
        if r.size:
            streams[r.src].append((r.at, r.id, text[r.flags, r.id, r.name, r.hash]))
    taken = [(r.src, r.slot, r.blk, r.words) for r in mixing.slots(plan, 11, pool).collect()]
    expected = brute_blocks(streams, taken)
    names = {r.src: r.source for r in plan.collect()}
    assert {(r.source, r.slot): (r.text, r.n_words) for r in blocks} == {(names[s], k): x for (s, k), x in expected.items()}
    assert mixing.mixed_blocks(df.limit(0)).count() == 0


def test_permutation(spark):
    for n in (1, 2, 7, 100, 1000):
        df = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(9).cast("long")).alias("to"))
        back = df.withColumn("back", mixing.permuted(F.col("to"), F.lit(n).cast("long"), F.lit(9).cast("long"), back=True)).collect()
        assert sorted(r.to for r in back) == list(range(n)) and all(r.back == r.id for r in back)
    assert n < 50 or sum(r.to == r.id for r in back) < 10


# op10


def plain_lines(text):
    ends = "|".join(f"(?<={re.escape(e)})" for e in lines.LINE_ENDS)
    return [x for x in re.split(ends, text)]


def test_lines_join_again(spark):
    texts = ["a. b\nc, d!e! f", "。x、y", "", "no end", "a\x01. b\n", ". . ", "\n\n", "q? r; s: t… u"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", lines.lines(F.col("text")).alias("u")).collect()
    for r in rows:
        assert "".join(r.u) == r.text
        assert [x for x in r.u if x] == [x for x in plain_lines(r.text) if x]


def passage(seed, n):
    rnd = random.Random(seed)
    return " ".join(("".join(rnd.choice("abcdefgh") for _ in range(5)) + rnd.choice(["", "", "", ".", "."])) for _ in range(n)) + "."


def test_passages_go_once(spark):
    p = passage(0, 90)
    docs = [(i, passage(i + 1, 60) + "\n" + p + "\n" + passage(i + 500, 40)) for i in range(12)]
    docs += [(100 + i, passage(i + 900, 80)) for i in range(10)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_chars", F.length("text")).withColumn("key", F.lit("clash"))
    rows = {r.doc_id: r for r in lines.dedup_lines(df).collect()}
    assert len(rows) == len(docs)
    assert rows[0].text == docs[0][1] and all(rows[i].text == t for i, t in docs[12:])
    for i in range(1, 12):
        left = len(rows[i].text.split())
        assert 100 <= left < 145 and rows[i].text.startswith(docs[i][1][:150]) and rows[i].text.endswith(docs[i][1][-100:])
        assert rows[i].n_chars == len(rows[i].text) and rows[i].key == "clash"
        assert rows[i].chars_removed == len(docs[i][1]) - len(rows[i].text) > 0


def test_long_lines_and_unspaced_scripts(spark):
    """A passage on one line without marks goes, between lines that differ; so does one without spaces."""
    rnd = random.Random(8)
    line = " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    signs = "".join(rnd.choice("的一是不了人我在有他这中大来上国") + ("，" if rnd.random() < 0.1 else "") for _ in range(120)) + "。"
    docs = [(i, f"{passage(i + 50, 30)}\n{line}\n{passage(i + 90, 30)}") for i in range(6)] + [(20 + i, f"{passage(i + 150, 20)}\n{signs}\n{passage(i + 190, 20)}") for i in range(6)]
    rows = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[0] == docs[0][1] and rows[20] == docs[6][1]
    assert all(line not in rows[i] and rows[i].startswith(docs[i][1][:100]) for i in range(1, 6))
    assert all(len(rows[20 + i]) < len(docs[6 + i][1]) - 40 for i in range(1, 6))


def brute_chunks(text, order):
    """Lines and chunks by hand; order ranks the bare lines as their hashes do."""
    u = plain_lines(text)
    v = [x.strip(" \n") for x in u]
    stops = {i for i in range(2, len(v)) if order[v[i - 1]] < order[v[i - 2]] and order[v[i - 1]] < order[v[i]]} | {len(v)}
    for i, x in enumerate(v, 1):
        if len(x.encode()) >= lines.LONG_LINE:
            stops |= {i - 1, i}
    out, start = [], 0
    for stop in sorted(stops - {0}):
        size = sum(len(x.encode()) for x in v[start:stop])
        if size >= (lines.LONG_LINE if stop - start == 1 else lines.CHUNK):
            out.append((start, stop))
        start = stop
    return u, v, out


def brute_dedup(docs, order, keys):
    """The first of equal chunks by (doc_id, text's hash, position) stays, everything else of them goes."""
    seen, gone, cut_up = {}, defaultdict(set), {}
    for d, text in sorted({x for x in docs if x[1]}, key=lambda x: (x[0] is None, x[0] or 0, keys[x[1]])):
        u, v, found = cut_up[d, text] = brute_chunks(text, order)
        for a, b in found:
            first = seen.setdefault("\n".join(v[a:b]), (d, text, a))
            if first != (d, text, a):
                gone[d, text] |= set(range(a, b))
    return Counter((d, "".join(x for k, x in enumerate(cut_up[d, t][0]) if k not in gone[d, t]) if t else t) for d, t in docs)


@pytest.mark.parametrize("way", ["broadcast", "shuffled"])
def test_lines_against_brute_force(spark, way, monkeypatch):
    if way == "shuffled":
        monkeypatch.setattr(lines, "BROADCAST", 0)
    rnd = random.Random(6)
    pool = [passage(k, rnd.randint(2, 30)) for k in range(40)] + ["x " * 60, "，".join(["一二三四五六七"] * 3)]
    docs = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 8)))) for i in range(60)]
    docs += [(3, docs[3][1]), (4, "other text. " * 9), (None, docs[5][1]), (70, None), (71, ""), (72, "w " * 30_000), (73, "w " * 30_000), (74, " \n . ")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    every = sorted({x.strip(" \n") for _, t in docs if t for x in plain_lines(t)})
    hashed = spark.createDataFrame([(x,) for x in every], "v string").select("v", F.xxhash64("v").alias("h")).collect()
    keys = {r.text: r.key for r in df.select("text", F.xxhash64("text").alias("key")).collect()}
    expected = brute_dedup(docs, {r.v: r.h for r in hashed}, keys)
    rows = lines.dedup_lines(df).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == expected
    assert lines.dedup_lines(df.limit(0)).count() == 0
