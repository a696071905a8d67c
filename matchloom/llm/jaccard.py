"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersection of sorted arrays.

A document's set holds 64-bit hashes of its distinct 5-word shingles. Documents with equal sets form a class, known by
its smallest doc_id; classes are joined. Two sets link when 100 * |x & y| >= 75 * |x | y|.

1. Candidates. Under any one order of shingles, two linked sets share one of their first n - ceil(3n/4) + 1 (prefix
   filter). The order is by hash, with shingles that are common anywhere put last, so that a passage
   which many texts share leads no text to others. Classes that share a prefix shingle are a group.
   With a required overlap o, the prefixes of x and y share at least min(o - ceil(3|x|/4), o - ceil(3|y|/4)) + 1 shingles.
2. Stars. A group's members are compared with its smallest member only, if they share half of what they must. Group by
   group this is linear, and it joins what belongs to large sets of near copies; the links' components follow by
   alternating star contraction.
3. The rest. Only groups that still hold several components can hold links that matter. In groups of at most SMALL members,
   pairs of different components are counted and must share what they must. Larger groups are cut into bands by size and
   tiles of about TILE rows; a tile meets those of its group in its own and the next band (sizes further apart can't
   link; tiles of the group's largest component don't meet each other). A set's bitmap marks each hash modulo its width; |x & y| <= (|x| + |y| - bits(x xor y)) / 2 discards most
   pairs of different components. What is left is compared exactly, and components are joined once more.

Every link is thus either found or connects what is already connected: components are exact. No group is held in
one task: the rows of a common shingle stream through one, stars are salted to STAR members, and tiles hold about TILE.

Defined cases: texts without words have an empty set, link with nothing and are their own component; a text of fewer than 5
words has one shingle, the whole sequence; rows that share a doc_id are one document with the links of all their
texts; rows with null doc_id take no part and get a null component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm.common import arrow, cut, discard, pieces, read, utf8, words_space

SIZE, PERCENT = 5, 75
#: Members of a star's part, of a small group and of a tile; shingles put last; shingles a task counts at a time; words it remembers.
STAR, SMALL, TILE, COMMON, COUNTED, MEMORY = 512, 32, 256, 200_000, 3_000_000, 400_000
#: Ids up to this many are broadcast to the texts; beyond it texts are shuffled.
BROADCAST = 2_000_000

_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


class Shingles:
    """Sets of shingle hashes; remembers the hashes of words."""

    def __init__(self, size: int = SIZE):
        self.size = size
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.hashes: list[int] = []

    def of(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct hashes."""
        words = words_space(text)
        if not words:
            return np.empty(0, np.uint64)
        if len(self.hashes) > MEMORY:
            self.clear()
        numbers = self.numbers
        new = {w for w in words if w not in numbers}
        for w in new:
            numbers[w] = len(self.hashes)
            self.hashes.append(xxhash.xxh64_intdigest(w))
        if new or not hasattr(self, "table") or len(self.table) < len(self.hashes):
            self._grow()
        h = self.table[np.array([numbers[w] for w in words], np.int64)]
        n = min(self.size, len(h))
        mixed = np.full(len(h) - n + 1, n, np.uint64) * _POWERS[63]
        for k in range(n):
            mixed += h[k : len(h) - n + 1 + k] * _POWERS[k]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)

    def _grow(self) -> None:
        """The hashes as an array, in a buffer that doubles."""
        if not hasattr(self, "buffer") or len(self.buffer) < len(self.hashes):
            self.buffer = np.zeros(max(1024, 2 * len(self.hashes)), np.uint64)
            self.done = 0
        if self.done > len(self.hashes):
            self.done = 0
        self.buffer[self.done : len(self.hashes)] = self.hashes[self.done :]
        self.done = len(self.hashes)
        self.table = self.buffer[: self.done]


def prefix(hashes: np.ndarray, common: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first n - ceil(percent n / 100) + 1 hashes, common ones (sorted) last."""
    n = len(hashes)
    if not n:
        return hashes
    take = n - -(-percent * n // 100) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        last = common[at] == hashes
        if last.any():
            hashes = np.concatenate((hashes[~last], hashes[last]))
    return hashes[:take]


def linked(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    """Exactly, for two sorted sets: from sizes, then bit counts, then the intersection."""
    a, b = (x, y) if len(x) <= len(y) else (y, x)
    if not len(a) or 100 * len(a) < percent * len(b):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    """bits bits as 64-bit words, the bit of each hash modulo bits set."""
    flags = np.zeros(bits, np.uint8)
    flags[(hashes % np.uint64(bits)).astype(np.int64)] = 1
    return np.packbits(flags).view(np.uint64)


def bits_for(n: int) -> int:
    """At least four times a set's size, as a power of two; 64 at least and 65536 at most."""
    return min(65_536, max(64, 1 << (4 * n - 1).bit_length()))


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def fingerprints(docs: DataFrame, pool: list[str] | None = None) -> DataFrame:
    """Per row: kind 0, doc_id, n, fp. Per shingle that a task saw often: kind 1, n (texts) and token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, seen, held = Shingles(), [], 0
        names = ["kind", "doc_id", "n", "fp", "token"]

        def common():
            tokens, counts = np.unique(np.concatenate(seen), return_counts=True)
            often = counts >= 2
            k = int(often.sum())
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.ones(k, np.int32)), pa.nulls(k, pa.int64()), pa.array(counts[often].astype(np.int64)), pa.nulls(k, pa.binary()), _signed(tokens[often])], names=names)

        for batch in pieces(batches, "text"):
            n, fp = [], []
            for text in utf8(batch, "text"):
                h = sets.of(text)
                n.append(len(h))
                fp.append(xxhash.xxh128_digest(h.tobytes()) if len(h) else None)
                seen.append(h)
                held += len(h)
            k = len(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(k, np.int32)), batch.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.nulls(k, pa.int64())], names=names)
            if held > COUNTED:
                yield common()
                held = 0
        if seen:
            yield common()

    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return cut(table.transform(arrow, run, "kind int, doc_id long, n long, fp binary, token long"), "jaccard-sets", pool)


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """text joined to rows of ids by their column id."""
    rows = ids.count()
    table = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("id"), "text")
    return table.join(F.broadcast(ids) if rows <= BROADCAST else ids, "id")


def prefix_tokens(docs: DataFrame, others: DataFrame, common: np.ndarray) -> DataFrame:
    """token, id, n of every class; others: doc_ids all of whose texts stand in classes known by another id."""
    sent = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Shingles()
        for batch in pieces(batches, "text"):
            ids, sizes, tokens = [], [], []
            for i, text in zip(batch.column(0).to_pylist(), utf8(batch, "text"), strict=True):
                h = sets.of(text)
                p = prefix(h, sent.value)
                if len(p):
                    tokens.append(p)
                    ids.append(np.full(len(p), i, np.int64))
                    sizes.append(np.full(len(p), len(h), np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays([_signed(np.concatenate(tokens)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(sizes))], names=["token", "id", "n"])

    table = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kept = table.join(F.broadcast(others) if others.count() <= BROADCAST else others, "doc_id", "left_anti")
    return kept.transform(arrow, run, "token long, id long, n int")


def must_share(n: int, m: int, percent: int = PERCENT) -> int:
    """The least number of shingles that the prefixes of linked sets of n and m shingles have in common."""
    overlap = -(-percent * (n + m) // (100 + percent))
    return overlap + 1 - max(-(-percent * n // 100), -(-percent * m // 100))


def must_share_column(n: str, m: str):
    """must_share of two columns."""
    up = lambda x, d: f"cast(({x} + {d} - 1) div {d} as bigint)"
    return F.expr(f"{up(f'{PERCENT}L * ({n} + {m})', 100 + PERCENT)} + 1 - {up(f'{PERCENT}L * greatest({n}, {m})', 100)}")


def groups(tokens: DataFrame, pool: list[str] | None = None) -> DataFrame:
    """Of classes that share a token. kind 0: a, b, weight: tokens that b shares with a, the smallest of the group, if
    their sizes allow a link. kind 1: gid, b, n, weight: a member of a group that stands for weight tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.int32()), ("gid", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("na", pa.int32()), ("n", pa.int32()), ("weight", pa.int64())])
        stars: dict[tuple[int, int, int, int], int] = {}
        known: dict[tuple[tuple[int, int], ...], int] = {}  # groups with equal members, as the tokens of one passage give
        held = 0
        token, own, lead, told = None, [], (0, 0), False  # the open group; told: part of it is out already

        def star(members, weight):
            for b, m in members:
                if b != lead[0] and 100 * min(m, lead[1]) >= PERCENT * max(m, lead[1]):
                    key = (lead[0], b, lead[1], m)
                    stars[key] = stars.get(key, 0) + weight

        def rows(gid, members, weight):
            k = len(members)
            b, n = zip(*members, strict=True)
            return pa.RecordBatch.from_arrays([pa.array([1] * k, pa.int32()), pa.array([gid] * k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(b, pa.int64()), pa.nulls(k, pa.int32()), pa.array(n, pa.int32()), pa.array([weight] * k, pa.int64())], schema=schema)

        def flush():
            nonlocal held, lead
            out = [(xxhash.xxh64_intdigest(repr(m)) >> 1, m, w) for m, w in known.items()]
            keep = lead
            for _, m, w in out:
                lead = m[0]
                star(m, w)
            lead = keep
            if out:
                gid = np.repeat(np.array([g for g, _, _ in out], np.int64), [len(m) for _, m, _ in out])
                weight = np.repeat(np.array([w for _, _, w in out], np.int64), [len(m) for _, m, _ in out])
                b, n = zip(*(x for _, m, _ in out for x in m), strict=True)
                k = len(b)
                yield pa.RecordBatch.from_arrays([pa.array([1] * k, pa.int32()), pa.array(gid), pa.nulls(k, pa.int64()), pa.array(b, pa.int64()), pa.nulls(k, pa.int32()), pa.array(n, pa.int32()), pa.array(weight)], schema=schema)
            known.clear()
            held = 0
            if stars:
                a, b, na, n = zip(*stars, strict=True)
                k = len(a)
                yield pa.RecordBatch.from_arrays([pa.array([0] * k, pa.int32()), pa.nulls(k, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(na, pa.int32()), pa.array(n, pa.int32()), pa.array(list(stars.values()), pa.int64())], schema=schema)
            stars.clear()

        def close():
            nonlocal own, told, held
            if told and own:
                yield rows(token, own, 1)
                star(own, 1)
            elif len(own) > 1:
                key = tuple(own)
                if key not in known:
                    held += len(key)
                known[key] = known.get(key, 0) + 1
            own, told = [], False

        for batch in batches:
            t, i, n = (batch.column(k).to_numpy() for k in range(3))
            if not len(t):
                continue
            edges = np.concatenate(([0], np.flatnonzero(np.diff(t)) + 1, [len(t)]))
            # Groups of one inside the batch are over at once; its first and last can go on in other batches
            for g in np.flatnonzero((np.diff(edges) > 1) | (edges[:-1] == 0) | (edges[1:] == len(t))).tolist():
                lo, hi = edges[g], edges[g + 1]
                if token is None or t[lo] != token:
                    yield from close()
                    token, lead = int(t[lo]), (int(i[lo]), int(n[lo]))
                last = own[-1] if own else None
                for x in zip(i[lo:hi].tolist(), n[lo:hi].tolist(), strict=True):
                    if x != last:  # equal rows once; texts of other sizes under one id are members of their own
                        own.append(x)
                    last = x
                if len(own) > 20_000:
                    yield rows(token, own, 1)
                    star(own, 1)
                    own, told = [], True
            if held + 2 * len(stars) > MEMORY:
                yield from flush()
        yield from close()
        yield from flush()

    ordered = tokens.repartition("token").sortWithinPartitions("token", "id", "n")
    return cut(ordered.transform(arrow, run, "kind int, gid long, a long, b long, na int, n int, weight long"), "jaccard-groups", pool)


def verify(docs: DataFrame, pairs: DataFrame, pool: list[str] | None = None) -> DataFrame:
    """The pairs (a, b) that link. Texts meet in parts of STAR members of one a."""
    pairs = cut(pairs.select("a", "b").distinct(), "jaccard-pairs", pool)
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(STAR)).cast("long").alias("parts"))
    members = pairs.join(parts, "a").select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), "parts").alias("part"), F.lit(1).alias("role"))
    leads = parts.select(F.col("a").alias("id"), "a", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.lit(0).alias("role"))
    rows = _texts_of(docs, cut(members.unionByName(leads), "jaccard-stars", pool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, key, lead = Shingles(), None, []
        for batch in pieces(batches, "text"):
            out = []
            for a, part, role, b, text in zip(*(batch.column(k).to_pylist() for k in range(4)), utf8(batch, "text"), strict=True):
                if key != (a, part):
                    key, lead = (a, part), []
                h = sets.of(text)
                if role == 0:
                    bits = bits_for(len(h))
                    lead.append((h, bits, bitmap(h, bits)))
                    continue
                for own, bits, marks in lead:
                    bound = (len(h) + len(own) - int(np.bitwise_count(bitmap(h, bits) ^ marks).sum())) // 2
                    if 100 * bound >= PERCENT * (len(h) + len(own) - bound) and linked(h, own):
                        out.append((a, b))
                        break
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["a", "b"])

    dealt = rows.select("a", "part", "role", "id", "text").repartition("a", "part").sortWithinPartitions("a", "part", "role")
    return dealt.transform(arrow, run, "a long, b long").distinct()


def components(edges: DataFrame, pool: list[str] | None = None) -> DataFrame:
    """id, component (the smallest id connected), of the ids in edges (a, b), by alternating large and small stars."""
    edges = cut(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "jaccard-edges", pool)

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = None
    while (now := state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u")
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = cut(small.where("u != v").distinct(), "jaccard-edges", pool)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def rest(docs: DataFrame, members: DataFrame, comps: DataFrame, pool: list[str] | None = None) -> DataFrame:
    """Pairs (a, b) of different components that still may link; members: kind 1 of groups."""
    merged = members.groupBy("gid", F.col("b").alias("id"), "n").agg(F.sum("weight").alias("weight"))  # equal groups of several tasks
    placed = merged.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("gid").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("rows")).where("x != y")
    left = cut(placed.join(mixed.select("gid", "rows"), "gid"), "jaccard-mixed", pool)
    small, large = left.where(F.col("rows") <= SMALL), left.where(F.col("rows") > SMALL)
    a = small.select("gid", F.col("id").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), "weight")
    b = small.select("gid", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"))
    fits = f"a < b and ca != cb and 100 * least(na, nb) >= {PERCENT} * greatest(na, nb)"
    counted = a.join(b, "gid").where(fits).groupBy("a", "b", "na", "nb").agg(F.sum("weight").alias("c"))  # by sizes, as an id can have several texts
    # Tokens of large groups aren't counted by pair; a pair shares as many as its member with fewer has, at most
    more = cut(large.groupBy("id").agg(F.sum("weight").alias("more")), "jaccard-more", pool)
    counted = counted.join(more.select(F.col("id").alias("a"), F.col("more").alias("ma")), "a", "left").join(more.select(F.col("id").alias("b"), F.col("more").alias("mb")), "b", "left")
    enough = F.col("c") + F.coalesce(F.least(F.coalesce("ma", F.lit(0)), F.coalesce("mb", F.lit(0))), F.lit(0)) >= must_share_column("na", "nb")
    return counted.where(enough).select("a", "b").unionByName(_tiles(docs, large, pool)).distinct()


def _tiles(docs: DataFrame, large: DataFrame, pool: list[str] | None) -> DataFrame:
    """Pairs (a, b) of large groups that bit counts can't rule out.

    A group is cut by band of sizes, by whether a member is of the group's largest component, and by a salt that keeps
    tiles small. Tiles of the largest component don't meet each other, as they hold no pair of different components."""
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / PERCENT))).cast("int")
    left = large.select("gid", "id", "n", "component").distinct().withColumn("band", band)
    sizes = left.groupBy("gid", "component").agg(F.count("*").alias("k"))
    major = sizes.groupBy("gid").agg(F.max_by("component", F.struct("k", "component")).alias("top"))
    left = left.join(major, "gid").withColumn("major", (F.col("component") == F.col("top")).cast("int"))
    counts = left.groupBy("gid", "band", "major").agg(F.ceil(F.count("*") / F.lit(TILE)).cast("long").alias("tiles"))
    tiled = left.join(counts, ["gid", "band", "major"]).withColumn("tile", F.pmod(F.xxhash64("id"), "tiles"))
    tiled = tiled.select("gid", F.struct("band", "major", "tile").alias("cell"), "id", "n", "component")
    shown = counts.withColumn("tile", F.explode(F.expr("sequence(0, tiles - 1)"))).select("gid", F.struct("band", "major", "tile").alias("cell"))
    # Each tile with those of its band that come after, itself included, and with all of the next band
    near = "x.cell.band = y.cell.band and x.cell <= y.cell or x.cell.band + 1 = y.cell.band"
    meets = shown.alias("x").join(shown.alias("y"), F.expr(f"x.gid = y.gid and x.cell.major + y.cell.major < 2 and ({near})"))
    meets = cut(meets.select("x.gid", F.xxhash64("x.cell", "y.cell").alias("meet"), F.col("x.cell").alias("one"), F.col("y.cell").alias("two")), "jaccard-meets", pool)
    both = F.expr("if(one = two, array(struct(1 as side, one as cell)), array(struct(1 as side, one as cell), struct(2 as side, two as cell)))")
    sides = meets.withColumn("s", F.explode(both)).select("gid", "meet", "s.*")
    groups_of = left.groupBy("id").agg(F.collect_set("gid").alias("gids"))  # as many as the member's prefix is long, at most
    rows = tiled.join(_marks(docs, left.select("id").distinct(), pool), "id").join(groups_of, "id")
    met = sides.join(rows, ["gid", "cell"]).select("gid", "meet", "side", "id", "n", "component", "marks", "gids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides = None, ([], [])
        for batch in batches:
            out = []
            for r in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)), strict=True):
                if r[:2] != now:
                    out += tile_pairs(now and now[0], *sides)
                    now, sides = r[:2], ([], [])
                sides[r[2] - 1].append(r[3:])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["a", "b"])
        if out := tile_pairs(now and now[0], *sides):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["a", "b"])

    return met.repartition("gid", "meet").sortWithinPartitions("gid", "meet").transform(arrow, run, "a long, b long")


def _marks(docs: DataFrame, ids: DataFrame, pool: list[str] | None) -> DataFrame:
    """id, marks: the bitmaps of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Shingles()
        for batch in pieces(batches, "text"):
            found = [sets.of(t) for t in utf8(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bitmap(h, bits_for(len(h))).tobytes() for h in found], pa.binary())], names=["id", "marks"])

    return cut(_texts_of(docs, ids).select("id", "text").transform(arrow, run, "id long, marks binary"), "jaccard-marks", pool)


def tile_pairs(gid: int, left: list[tuple], right: list[tuple]) -> list[tuple[int, int]]:
    """(a, b) with a < b of two tiles of (id, n, component, marks, gids), or within one if the right one is empty: other
    components, and sizes and bit counts that allow a link. A pair of several groups is given by the first of them."""
    out: list[tuple[int, int]] = []
    alone, right = not right, right or left
    sides = []
    for rows in (left, right):
        by_width: dict[int, list[tuple]] = {}
        for r in rows:
            by_width.setdefault(8 * len(r[3]), []).append(r)
        sides.append({w: (*(np.array([r[k] for r in g], np.int64) for k in range(3)), np.stack([np.frombuffer(r[3], np.uint64) for r in g]), [set(r[4]) for r in g]) for w, g in by_width.items()})
    for w1, (id1, n1, c1, m1, g1) in sides[0].items():
        for w2, (id2, n2, c2, m2, g2) in sides[1].items():
            bits = min(w1, w2)
            x, y = _fold(m1, bits), _fold(m2, bits)
            for r in range(len(id1)):
                apart = (c2 != c1[r]) & (100 * np.minimum(n2, n1[r]) >= PERCENT * np.maximum(n2, n1[r]))
                at = np.flatnonzero(apart & (id2 > id1[r]) if alone else apart)
                if len(at):
                    both = (n1[r] + n2[at] - np.bitwise_count(y[at] ^ x[r]).sum(1, dtype=np.int64)) // 2
                    for k in at[100 * both >= PERCENT * (n1[r] + n2[at] - both)].tolist():
                        if min(g1[r] & g2[k]) == gid:
                            out.append((min(int(id2[k]), int(id1[r])), max(int(id2[k]), int(id1[r]))))
    return out


def _fold(marks: np.ndarray, bits: int) -> np.ndarray:
    """Bitmaps, a row each, at a power-of-two fraction of their width: hash modulo the smaller width."""
    return np.bitwise_or.reduce(marks.reshape(len(marks), -1, bits // 64), axis=1)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    docs, pool = docs.select("doc_id", "text"), []
    made = fingerprints(docs, pool)
    often = made.where("kind = 1").groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(COMMON)
    common = np.sort(often.select("token").toArrow().column("token").to_numpy().view(np.uint64))
    sets = made.where("kind = 0").select("doc_id", "n", "fp")
    classes = cut(sets.where("doc_id is not null and fp is not null").groupBy("fp").agg(F.min("doc_id").alias("id")), "jaccard-classes", pool)
    named = cut(sets.join(classes, "fp", "left").select("doc_id", "n", "id"), "jaccard-named")
    known = named.where("id is not null and doc_id is not null")
    others = known.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("id")).alias("leads")).where("not leads").select("doc_id")
    # Rows of one doc_id in several classes tie these
    ties = known.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a != z").select("doc_id", "a")
    ties = known.join(ties, "doc_id").select("a", F.col("id").alias("b")).where("a != b").distinct()
    grouped = groups(prefix_tokens(docs, others, common), pool)
    stars = grouped.where("kind = 0").groupBy("a", "b", "na", "n").agg(F.sum("weight").alias("c"))
    edges = cut(verify(docs, stars.where(2 * F.col("c") >= must_share_column("na", "n")), pool).unionByName(ties), "jaccard-links", pool)
    comps = cut(components(edges, pool), "jaccard-components", pool)
    more = cut(verify(docs, rest(docs, grouped.where("kind = 1"), comps, pool), pool), "jaccard-links", pool)
    comps = cut(components(edges.unionByName(more), pool), "jaccard-components")
    final = named.join(comps, "id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id"))
    discard(pool)
    return final.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT r, doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT r, doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT r, doc_id, count(*) AS n FROM s GROUP BY ALL),
o AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.r < y.r GROUP BY ALL),
l AS (SELECT DISTINCT na.doc_id AS u, nb.doc_id AS v FROM o JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
e AS (SELECT u, v FROM l UNION SELECT v, u FROM l),
t(doc_id, m) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.v, t.m FROM t JOIN e ON e.u = t.doc_id),
c AS (SELECT doc_id, min(m) AS component_id FROM t GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN c ON c.doc_id = d.doc_id
"""
