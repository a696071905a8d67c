"""Mixing sources to target weights, in DataFrame functions only.

The words of each source, its documents in pseudorandom order, are one stream that is packed into blocks of
BLOCK words. The mix is made of output shards of SHARD slots. Every slot draws its source with the targets as
probabilities, so the source counts of a shard are a multinomial draw. The counts of a source, shard after shard,
number its slots; slot i is sent through the source's pseudorandom permutation of its block numbers (a swap-or-not
shuffle: a bijection on 0..n-1 for any n, computed per index, both ways), with a new permutation for every pass over the
source. Slots and blocks then meet in a join by block number, and what a document gives to the mix is what the joined
blocks hold of it.

The draws decide how much of a source is taken, within TOLERANCE of its target: what a source has drawn beyond that stays out
(its last slots), what it lacks is added in slots whose shards are drawn evenly. Targets stay at or below
twice the source, and so does what is taken: no block is drawn more than twice.

Positions in a stream come from sums over small hash buckets, over chunks of buckets, and then inside each bucket; equal
rows are counted before they are dealt out. No task holds a source, and none holds the list of sources.

Defined cases: null text has no words; null is a source of its own, the last; rows with equal doc_id, or none, are rows of
their own; a source without words has target 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchloom.llm.common import cut, discard, read

WORD = r"[^\x20\x09-\x0D]+"
GAP, BLANK = r"[\x20\x09-\x0D]+", " \t\n\x0b\f\r"
#: Words in a block; slots in an output shard; rows in a bucket; buckets in a chunk; rounds of the shuffle.
BLOCK, SHARD, BUCKET, CHUNK, ROUNDS = 128, 1024, 512, 1024, 24
WEIGHTS, SHARE, MOST, TOLERANCE = (5, 2, 1), 1.5, 2.0, 0.02
#: Probabilities are whole parts of this.
UNITS = 1 << 45
#: What tells rows apart; columns without nulls, so that joins and groups share their partitioning.
KEY = ("flags", "id", "name", "hash")


def sizes(docs: DataFrame) -> DataFrame:
    """KEY, source and size of every row."""
    return _keyed(docs).select(*KEY, "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def _keyed(docs: DataFrame) -> DataFrame:
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    nulls = F.col("doc_id").isNull().cast("int") + 2 * F.col("source").isNull().cast("int") + 4 * F.col("text").isNull().cast("int")
    return plain.withColumns({"flags": nulls, "id": F.coalesce("doc_id", F.lit(0)), "name": F.coalesce("source", F.lit("")), "hash": F.xxhash64("text")})


def _doc_id() -> Column:
    return F.when(F.col("flags").bitwiseAND(1) == 0, F.col("id")).alias("doc_id")


def running(df: DataFrame, order: list[Column | str], sums: dict[str, Column], pool: list[str]) -> DataFrame:
    """df plus columns: each sum over the rows before in the order (which tells all rows apart). No task sees all rows."""
    dealt = cut(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "mix-order", pool)
    parts = dealt.groupBy("__part").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = parts.select("__part", *[F.coalesce(F.sum(f"__{n}").over(earlier), F.lit(0)).alias(f"__{n}") for n in sums])
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    met = dealt.join(F.broadcast(parts), "__part")
    return met.withColumns({n: F.col(f"__{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()}).drop("__part", *[f"__{n}" for n in sums])


def targets(per_source: DataFrame, pool: list[str], weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """per_source (source, source_size) plus src (its rank by code point, null last) and target.

    Resharing the excess by weight until no source is above its limit ends where every target is
    least(limit, level * weight), for the one level at which the targets sum to the whole. Sources fill up in
    order of limit / weight, so running sums over that order give the level."""
    ranked = running(per_source, [F.col("source").isNull(), F.col("source")], {"src": F.lit(1).cast("long")}, pool)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("src"), F.lit(len(weights))) + 1).cast("int"))
    weighed = ranked.withColumn("weight", w).withColumn("limit", most * F.col("source_size")).withColumn("ratio", F.col("limit") / F.col("weight"))
    filled = running(weighed, [F.col("ratio"), F.col("src")], {"before": F.col("limit"), "used": F.col("weight")}, pool)
    words, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    filled = filled.withColumn("level", (share * F.lit(words) - F.col("before")) / (F.lit(weight) - F.col("used")))
    best = filled.agg(F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).alias("best"))
    target = F.least("limit", F.coalesce(F.col("best") * F.col("weight"), F.col("limit")))
    return filled.crossJoin(F.broadcast(best)).select("source", "source_size", "src", target.alias("target"))


def permuted(index: Column, n: Column, key: Column, back: bool = False) -> Column:
    """The index that a swap-or-not shuffle of 0..n-1 sends this one to (back: the one that is sent here)."""
    rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))

    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, n, r), n) - x, n)
        return F.when(F.xxhash64(key, r, F.greatest(x, other), F.lit(7)) % 2 == 0, x).otherwise(other)

    return F.aggregate(rounds, index.cast("long"), swap)


def _before(table: DataFrame, part: str, place: str, value: str, chunk: int, name: str) -> DataFrame:
    """table (a row per part and place) plus the sum of value over smaller places of the part: chunk by chunk, then inside."""
    chunked = table.withColumn("chunk", F.expr(f"{place} div {chunk}L"))
    earlier = Window.partitionBy(part).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = chunked.groupBy(part, "chunk").agg(F.sum(value).alias("n")).select(part, "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy(part, "chunk").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return chunked.join(bases, [part, "chunk"]).withColumn(name, F.col("base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("chunk", "base")


def _positions(rows: DataFrame, n_buckets: int, seed: int) -> DataFrame:
    """KEY, size, src, and at: the words of the source before the row. rows: KEY, src, size."""
    counted = rows.groupBy(*KEY, "src", "size").agg(F.count("*").alias("copies"))
    h = F.xxhash64(*KEY, F.lit(seed))
    dealt = counted.withColumn("h", h).withColumn("bucket", F.pmod("h", F.lit(n_buckets))).withColumn("words", F.col("size") * F.col("copies"))
    sums = _before(dealt.groupBy("src", "bucket").agg(F.sum("words").alias("words")), "src", "bucket", "words", CHUNK, "first")
    inside = Window.partitionBy("src", "bucket").orderBy("h", *KEY).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.join(sums.select("src", "bucket", "first"), ["src", "bucket"]).withColumn("at", F.col("first") + F.coalesce(F.sum("words").over(inside), F.lit(0)))
    # Equal rows come apart again, in runs that are dealt out
    runs = placed.withColumn("run", F.explode(F.expr("sequence(0L, (copies - 1) div 4096L)")))
    runs = runs.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "src", "h", "run")
    each = runs.withColumn("copy", F.explode(F.expr("sequence(run * 4096L, least(copies, (run + 1) * 4096L) - 1)")))
    return each.select(*KEY, "size", "src", (F.col("at") + F.col("copy") * F.col("size")).alias("at"))


def draw(plan: DataFrame, seed: int, pool: list[str], block: int = BLOCK, shard: int = SHARD) -> tuple[DataFrame, int]:
    """shard, src, c: how many slots of each output shard the source has drawn; and the number of shards."""
    expected = plan.where("source_size > 0 and target >= 0.5").withColumn("slots", F.ceil(F.col("source_size") / F.lit(block)) * F.col("target") / F.col("source_size"))
    every = expected.agg(F.sum(F.round("slots", 6).cast("decimal(30,6)"))).first()[0]
    if not every:
        return plan.select(F.lit(0).cast("long").alias("shard"), "src", F.lit(0).cast("long").alias("c")).limit(0), 1
    share = running(expected.withColumn("units", F.greatest(F.lit(1), F.round(F.col("slots") / float(every) * UNITS)).cast("long")), [F.col("src")], {"lo": F.col("units")}, pool)
    share = cut(share.select("src", "lo", (F.col("lo") + F.col("units")).alias("hi")), "mix-shares", pool)
    units, n_sources = share.agg(F.max("hi"), F.count("*")).first()
    width = -(-units // (4 * n_sources))
    # A number below units falls into a bin of this width; the few sources that reach into a bin meet it in an equi-join
    bins = share.withColumn("bin", F.explode(F.expr(f"sequence(lo div {width}L, (hi - 1) div {width}L)")))
    n_slots = max(1, round(every))
    u = F.pmod(F.xxhash64(F.lit(seed + 2), "id"), F.lit(units))
    thrown = plan.sparkSession.range(n_slots).select(F.expr(f"id div {shard}L").alias("shard"), u.alias("u")).withColumn("bin", F.expr(f"u div {width}L"))
    drawn = thrown.join(bins, "bin").where("u >= lo and u < hi").groupBy("shard", "src").agg(F.count("*").alias("c"))
    return cut(drawn, "mix-draws", pool), -(-n_slots // shard)


def slots(plan: DataFrame, seed: int, pool: list[str], block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """One row per slot: src, slot (its number in the source), shard, blk (block number in the source) and words (taken of that block)."""
    drawn, n_shards = draw(plan, seed, pool, block, shard)
    last_size = F.col("source_size") - (F.col("n_blocks") - 1) * block
    key = lambda turn: F.xxhash64(F.lit(seed), "src", turn)
    short = lambda turn: permuted(F.col("n_blocks") - 1, F.col("n_blocks"), key(turn), back=True)
    near = lambda up: F.floor(F.col("target") * (1 + TOLERANCE)) if up else F.ceil(F.col("target") * (1 - TOLERANCE))
    whole = F.round("target").cast("long")
    quota = (
        plan.where("source_size > 0 and target >= 0.5")
        .join(drawn.groupBy("src").agg(F.sum("c").alias("drawn")), "src", "left")
        .withColumn("drawn", F.coalesce("drawn", F.lit(0)))
        .withColumn("n_blocks", F.ceil(F.col("source_size") / F.lit(block)).cast("long"))
        .withColumn("gap", block - last_size)
        # Words of the slots drawn: the short last block of the source comes at some place of every pass
        .withColumn("passes", F.expr("drawn div n_blocks"))
        .withColumn("rest", F.expr("drawn % n_blocks"))
        .withColumn("words", F.col("passes") * F.col("source_size") + F.col("rest") * block - F.when(short("passes") < F.col("rest"), F.col("gap")).otherwise(0))
        .withColumn("words", F.greatest(F.least(whole, near(False)), F.least(F.greatest(whole, near(True)), F.col("words"))))
        .withColumn("words", F.least("words", F.col("source_size") * int(MOST)).cast("long"))
        .select("src", "source_size", "drawn", "n_blocks", "gap", "words")
    )
    quota = (
        cut(quota, "mix-words", pool)  # nested any deeper, the permutations would be written out many times in the plan
        # Slots that hold so many words, and how many the last one gives
        .withColumn("passes", F.expr("words div source_size"))
        .withColumn("rest", F.expr("words % source_size"))
        .withColumn("short_at", short("passes"))
        .withColumn("run", F.when(F.col("rest") <= F.col("short_at") * block, F.col("rest")).otherwise(F.col("rest") + F.col("gap")))
        .withColumn("n_slots", F.col("passes") * F.col("n_blocks") + F.ceil(F.col("run") / F.lit(block)).cast("long"))
        .withColumn("tail", F.expr(f"run % {block}"))
        .select("src", "source_size", "drawn", "n_blocks", "n_slots", "tail")
    )
    quota = cut(quota, "mix-quotas", pool)
    numbered = _before(drawn, "src", "shard", "c", CHUNK, "first").select("src", "shard", "first", "c")
    more = quota.where("n_slots > drawn").withColumn("first", F.explode(F.expr("sequence(drawn, n_slots - 1, 1024L)")))
    more = more.select("src", F.lit(None).cast("long").alias("shard"), "first", F.least(F.lit(1024), F.col("n_slots") - F.col("first")).alias("c"))
    # By number: few small rows stand for many slots, which AQE can't know when it merges partitions
    dealt = numbered.unionByName(more).repartition(int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions")), "src", "first")
    each = dealt.withColumn("slot", F.explode(F.expr("sequence(first, first + c - 1)"))).join(quota, "src").where("slot < n_slots")
    turn = F.expr("slot div n_blocks")
    size = F.when(F.col("blk") == F.col("n_blocks") - 1, last_size).otherwise(F.lit(block))
    taken = F.when((F.col("slot") == F.col("n_slots") - 1) & (F.col("tail") > 0), F.least(F.col("tail"), size)).otherwise(size)
    return (
        each.withColumn("blk", permuted(F.col("slot") % F.col("n_blocks"), F.col("n_blocks"), key(turn)))
        .withColumn("shard", F.coalesce("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "src", "slot"), F.lit(n_shards))))
        .select("src", "slot", "shard", "blk", taken.cast("long").alias("words"))
    )


def _spans(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document and block that it reaches into: lo and hi are the words of the block that are its own."""
    return (
        placed.where("size > 0")
        .withColumn("blk", F.explode(F.expr(f"sequence(at div {block}, (at + size - 1) div {block})")))
        .withColumn("lo", F.greatest(F.lit(0), F.col("at") - F.col("blk") * block))
        .withColumn("hi", F.least(F.lit(block), F.col("at") + F.col("size") - F.col("blk") * block))
    )


def _pieces(spans: DataFrame, drawn: DataFrame) -> DataFrame:
    """The join of blocks by number: spans beside the slots that took their block, and n: words of the span in the slot.

    The size of drawn is estimated from the few rows of the plan it grows out of, and would be broadcast."""
    met = spans.join(drawn.hint("merge"), ["src", "blk"])
    return met.withColumn("n", F.least("words", "hi") - F.col("lo")).where("n > 0")


def _plan(docs: DataFrame, seed: int, pool: list[str]) -> tuple[DataFrame, DataFrame]:
    """plan: source, source_size, src, target; and every row's KEY, size, src, at."""
    sized = cut(sizes(docs), "mix-sizes", pool)
    plan = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), pool), "mix-plan", pool)
    rows = sized.alias("d").join(plan.select("source", "src").alias("p"), F.expr("d.source <=> p.source")).select(*KEY, "size", "src")
    return plan, cut(_positions(rows, max(1, -(-sized.count() // BUCKET)), seed), "mix-positions", pool)


def mix(docs: DataFrame, seed: int = 11) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: words of the row in the blocks that the mix has joined, repeats counted."""
    pool: list[str] = []
    plan, placed = _plan(docs, seed, pool)
    spans = _spans(placed.select("src", "at", "size"))
    taken = _pieces(spans, slots(plan, seed, pool)).groupBy("src", "at").agg(F.sum("n").alias("taken"))
    taken = cut(taken, "mix-taken")
    discard([p for p in pool if "mix-positions" not in p and "mix-plan" not in p])
    rows = placed.withColumn("key", F.when(F.col("size") > 0, F.col("at")))
    met = rows.alias("r").join(taken.alias("t"), F.expr("r.src = t.src and r.key = t.at"), "left").select("r.*", F.coalesce("t.taken", F.lit(0)).cast("long").alias("taken"))
    return met.join(plan, "src").select(_doc_id(), "source", "size", "source_size", "target", "taken")


def mixed_blocks(docs: DataFrame, seed: int = 11) -> DataFrame:
    """The mix itself: shard, source, slot, n_words, doc_ids, text; the words of each drawn block in order, one space between."""
    pool: list[str] = []
    plan, placed = _plan(docs, seed, pool)
    drawn = cut(slots(plan, seed, pool), "mix-slots", pool)
    texts = _keyed(docs).where("text is not null").groupBy(*KEY).agg(F.max("text").alias("text"))  # one of equal rows
    words = F.split(F.btrim("text", F.lit(BLANK)), GAP)
    spans = _spans(placed.join(texts, list(KEY)).withColumn("w", words))
    cutout = F.slice("w", (F.col("blk") * BLOCK + F.col("lo") - F.col("at") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int"))
    found = _pieces(spans.select("src", "blk", "lo", "hi", _doc_id(), F.array_join(cutout, " ").alias("part")), drawn)
    own = F.when(F.col("n") < F.col("hi") - F.col("lo"), F.expr("substring_index(part, ' ', cast(n as int))")).otherwise(F.col("part"))
    parts = found.groupBy("src", "blk", "shard", "slot").agg(F.sort_array(F.collect_list(F.struct("lo", "n", "doc_id", own.alias("part")))).alias("x"))
    return parts.join(plan.select("src", "source"), "src").select(
        "shard",
        "source",
        "slot",
        F.aggregate("x", F.lit(0).cast("long"), lambda a, p: a + p["n"]).alias("n_words"),
        F.transform("x", lambda p: p["doc_id"]).alias("doc_ids"),
        F.array_join(F.transform("x", lambda p: p["part"]), " ").alias("text"),
    )


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")
