"""Pair features, of given pairs and of all pairs that blocking finds.

Given pairs: two lookups by id as joins, then one projection of the seventeen features. What depends on one record alone (phonetic
code, n-gram counts, numbers) is computed per record, before the join repeats records per pair.

Blocked pairs are never listed to be joined with their records, as there are many more of them than records and they carry whole
addresses. Each record falls into exactly one block, so no pair comes twice; a large block is cut into tiles, a record goes once
to each tile of its row or column, and the pairs are made where both sides lie. Sets, n-grams, numbers and edit
distances are compared there for a whole tile at once. Listed pairs that are many more than their records go to tiles of all records in
the same way, and only they are compared there."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from decimal import ROUND_HALF_UP, Decimal
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions import similarity as s
from matchloom.functions import tiles
from matchloom.functions.tables import FEATURES
from matchloom.functions.text import blocking_keys, filled
from matchloom.operators.blocking import MAX_BLOCK, oversized_prefixes
from matchloom.operators.checks import require, require_unique

FIELDS = ("name_core", "address_clean", "name_tokens", "address_tokens", "address_numbers", "country_norm", "entity_source")
FLAGS = ("name_is_empty", "address_is_empty")


def record(df: DataFrame, side: str) -> tuple[DataFrame, dict[str, Column]]:
    """entity_id and what the features read of a record, and these columns by name. They are columns of their own, not a struct,
    so that joins carry only what the wanted features read. Flags a table lacks are false."""
    require(df, ("entity_id", *FIELDS), "records")
    flags = [F.coalesce(F.col(c), F.lit(False)).alias(c) if c in df.columns else F.lit(False).alias(c) for c in FLAGS]
    once = [s.phonetic(F.col("name_core")).alias("code"), s.gram_counts(s.ngram_text(F.col("name_core"))).alias("grams")]
    names = [*FIELDS, *FLAGS, "code", "grams"]
    found = df.select("entity_id", *FIELDS, *flags, *once)
    return found.withColumnsRenamed({n: f"__{side}_{n}" for n in names}), {n: F.col(f"__{side}_{n}") for n in names}


def feature_columns(a: dict[str, Column], b: dict[str, Column], wanted: Iterable[str] = FEATURES, known: dict[str, Column] | None = None) -> list[Column]:
    """The wanted ones of the seventeen features of two records, a of the first source; known are there already."""
    source = F.lower(filled(b["entity_source"]))
    values = {
        "name_jaro_winkler": s.jaro_winkler(a["name_core"], b["name_core"]),
        "name_levenshtein": s.indel(a["name_core"], b["name_core"]),
        "name_token_jaccard": s.jaccard(a["name_tokens"], b["name_tokens"]),
        "name_containment": s.containment(a["name_core"], b["name_core"]),
        "name_prefix_similarity": s.common_prefix(a["name_core"], b["name_core"]),
        "name_char_ngram_cosine": s.ngram_cosine_of(a["grams"], b["grams"]),
        "name_phonetic_match": s.same_code(a["code"], b["code"]),
        "address_token_jaccard": s.jaccard(a["address_tokens"], b["address_tokens"]),
        "address_number_tolerant_match": s.near_numbers(a["address_numbers"], b["address_numbers"]),
        "address_string_similarity": s.indel(a["address_clean"], b["address_clean"]),
        "country_match": s.same_text(a["country_norm"], b["country_norm"]).cast("int"),
        "name1_empty": a["name_is_empty"].cast("int"),
        "name2_empty": b["name_is_empty"].cast("int"),
        "address1_empty": a["address_is_empty"].cast("int"),
        "address2_empty": b["address_is_empty"].cast("int"),
        "is_source2_pair": source.isin("s2", "source2").cast("int"),
        "is_source3_pair": source.isin("s3", "source3").cast("int"),
    }
    return [(values | (known or {}))[name].alias(name) for name in wanted]


def pair_features(source1: DataFrame, candidates: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (source1_entity_id, candidate_entity_id, maybe more) plus features; pairs with an unknown id are dropped.

    Ids must be unique in either table, else pairs would fan out: repeated ones are an error."""
    require_unique(source1, "entity_id", "source1")
    require_unique(candidates, "entity_id", "candidates")
    one, a = record(source1, "a")
    two, b = record(candidates, "b")
    met = pairs.join(one.withColumnRenamed("entity_id", "source1_entity_id"), "source1_entity_id").join(two.withColumnRenamed("entity_id", "candidate_entity_id"), "candidate_entity_id")
    return met.select(*pairs.columns, *feature_columns(a, b))


#: Rows of a side of a tile; fewer where whole addresses are aligned, as a tile is one task's work. Characters and pairs handled at once in a tile.
ROWS, ALIGNED_ROWS, CHARS, PAIRS = 1024, 256, 1 << 22, 1 << 17
#: Where whole addresses are sent: copies of a record at most, on average of a block and but for rounding up, as tiles of large blocks grow with them,
#: and rows of a side of such a tile at most, for memory; blocks of over COPIES times that have more copies again.
COPIES, MOST_ROWS = 4, 16384
#: Features of a whole tile: how, and of which column of a record.
TILED = {
    "name_levenshtein": (tiles.indel, "name_core"),
    "name_token_jaccard": (tiles.jaccard, "name_tokens"),
    "name_char_ngram_cosine": (tiles.ngram_cosine, "name_core"),
    "address_token_jaccard": (tiles.jaccard, "address_tokens"),
    "address_number_tolerant_match": (tiles.near_numbers, "address_numbers"),
    "address_string_similarity": (tiles.indel, "address_clean"),
}
#: What the other features read of either record.
READ = {"name_phonetic_match": "code", "country_match": "country_norm", "is_source2_pair": "entity_source", "is_source3_pair": "entity_source"}
READ |= {"name1_empty": "name_is_empty", "name2_empty": "name_is_empty", "address1_empty": "address_is_empty", "address2_empty": "address_is_empty"}
AT = ("__block", "__row", "__column")
#: Features whose values are long; they travel compressed, as one column.
LONG = ("address_token_jaccard", "address_string_similarity")
_CODEC = pa.Codec("zstd", compression_level=3)


def columns_read(wanted: Iterable[str]) -> list[str]:
    """The columns of a record that blocking and the wanted features read, but for flags."""
    read = ["name_core", *(TILED[n][1] if n in TILED else READ.get(n, "name_core") for n in wanted)]
    return [c for c in dict.fromkeys(read) if c in FIELDS]


def rounded(values: np.ndarray, digits: int) -> np.ndarray:
    """Values from 0 to about 1 as Spark rounds them: halves of the decimal form upwards."""
    scaled = values * 10.0**digits
    out = np.floor(scaled + 0.5) / 10.0**digits
    near = np.abs(scaled - np.floor(scaled) - 0.5) < 1e-6
    unit = Decimal(1).scaleb(-digits)
    out[near] = [float(Decimal(repr(x)).quantize(unit, ROUND_HALF_UP)) for x in values[near].tolist()]
    return out


def packed(values: Column) -> Column:
    """The distinct strings of an array as one, a line each; other than the array it takes no 16 bytes for each of them."""
    escaped = lambda x: F.coalesce(F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\\0"))

    def lines(once: Column) -> Column:
        glued = F.array_join(once, "")
        odd = F.contains(glued, F.lit("\n")) | F.contains(glued, F.lit("\\")) | F.exists(once, lambda x: x.isNull())
        return F.concat(F.array_join(F.when(odd, F.transform(once, escaped)).otherwise(once), "\n"), F.when(F.size(once) > 0, "\n").otherwise(""))

    return F.coalesce(s.once(F.array_distinct(values), lines), F.lit(""))


def _sent(name: str) -> Column:
    """What a tile gets of a record for a feature of TILED, as a string."""
    how, column = TILED[name]
    if how is tiles.jaccard:
        return packed(F.col(column))
    if how is tiles.near_numbers:
        return packed(F.array_compact(F.transform(column, s.whole)).cast("array<string>"))
    return s.ngram_text(F.col(column)) if how is tiles.ngram_cosine else F.col(column)


def _blocked(df: DataFrame, large: DataFrame) -> DataFrame:
    """df with __block, the one block of each row: its prefix, or its whole name if that is shorter or the prefix is too large."""
    keys = blocking_keys(F.col("name_core"))
    known = df.withColumns({"__name": F.get(keys, F.lit(0)), "__prefix": F.get(keys, F.lit(1))}).where("__name is not null")
    met = known.join(large, F.col("__prefix") == F.col("__large"), "left")
    return met.withColumn("__block", F.when(F.col("__prefix").isNotNull() & F.col("__large").isNull(), F.col("__prefix")).otherwise(F.col("__name")))


def _narrow(df: DataFrame, side: int, tiled: list[str], light: list[str]) -> DataFrame:
    """What a tile gets of the rows of df, which have __block."""
    flags = {c: F.coalesce(F.col(c), F.lit(False)) if c in df.columns else F.lit(False) for c in FLAGS}
    once = flags | {"code": s.phonetic(F.col("name_core"))}
    told = [once.get(c, F.col(c)).alias(f"__read_{c}") for c in light]
    narrow = df.select("__block", "entity_id", F.lit(side).alias("__side"), *[_sent(n).alias(n) for n in tiled], *told)
    long = [n for n in tiled if n in LONG]
    if long:
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema if f.name not in long)
        narrow = narrow.mapInArrow(lambda batches: _wrapped(batches, long), f"{kinds}, __long binary")
    return narrow


def block_features(
    source1: DataFrame, candidates: DataFrame, wanted: Iterable[str] = FEATURES, max_prefix_block_size: int = MAX_BLOCK, keys: tuple[DataFrame, DataFrame] | None = None, digits: int | None = None
) -> DataFrame:
    """source1_entity_id, candidate_entity_id and the wanted features of the pairs of `blocking.generate_candidates`, each pair once.

    Ids must be unique in either table. Broadcast are the prefixes of too large blocks and the blocks of more rows than a tile has.
    keys: entity_id and name_core of both tables where these are cheaper to read than the records; checks and counts read them six times.
    digits: those that TILED features are rounded to, a tile's distinct values once."""
    wanted = list(wanted)
    keys = keys or (source1, candidates)
    for df, key, what in ((source1, keys[0], "source1"), (candidates, keys[1], "candidates")):
        require(df, ("entity_id", *columns_read(wanted)), what)
        require_unique(key, "entity_id", what)
    tiled = [n for n in wanted if n in TILED]
    light = list(dict.fromkeys(READ.get(n, "name_core") for n in wanted if n not in TILED))
    long = [n for n in tiled if n in LONG]
    rows = ALIGNED_ROWS if "address_string_similarity" in tiled else ROWS
    large = F.broadcast(oversized_prefixes(keys[1], cap=max_prefix_block_size).select(F.concat(F.lit("name_prefix:"), "prefix_key").alias("__large")))
    sides = [_blocked(df, large) for df in (source1, candidates)]
    count = lambda df, n: df.groupBy("__block").agg(F.count("*").alias(n))
    sizes = count(_blocked(keys[0], large), "a").join(count(_blocked(keys[1], large), "b"), "__block", "full").where(f"a > {rows} or b > {rows}")
    a, b = (F.coalesce(n, F.lit(0)) for n in ("a", "b"))
    fair = F.least(F.greatest(F.lit(float(rows)), 2 * a * b / (COPIES * (a + b))), F.lit(float(max(rows, MOST_ROWS)))) if long else F.lit(rows)
    cuts = [F.greatest(F.lit(1), F.ceil(n / fair)).cast("int").alias(name) for n, name in ((a, "__a"), (b, "__b"))]
    cut = F.broadcast(sizes.select(F.col("__block"), *cuts))

    def sent(df: DataFrame, side: int) -> DataFrame:
        narrow = _narrow(df, side, tiled, light)
        own, other = ("__a", "__b") if side == 0 else ("__b", "__a")
        own_at, other_at = AT[1:] if side == 0 else AT[:0:-1]
        placed = narrow.join(cut, "__block", "left").withColumn(own_at, F.pmod(F.xxhash64("entity_id"), F.coalesce(own, F.lit(1))).cast("int"))
        return placed.withColumn(other_at, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))).drop("__a", "__b")

    both = sent(sides[0], 0).unionByName(sent(sides[1], 1))
    dealt = both.repartition(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), *AT).sortWithinPartitions(*AT, "__side")
    kinds = {f.name: f.dataType.simpleString() for f in both.schema}
    out = ["source1_entity_id string", "candidate_entity_id string", *[f"{n} double" for n in tiled], *[f"__{x}_{c} {kinds[f'__read_{c}']}" for x in "ab" for c in light]]
    met = dealt.mapInArrow(lambda batches: _met(batches, tiled, light, digits), ", ".join(out))
    a, b = ({c: F.col(f"__{x}_{c}") for c in (*FIELDS, *FLAGS, "code", "grams")} for x in "ab")
    return met.select("source1_entity_id", "candidate_entity_id", *feature_columns(a, b, wanted, {n: F.col(n) for n in tiled}))


def _met(batches: Iterator[pa.RecordBatch], tiled: list[str], light: list[str], digits: int | None) -> Iterator[pa.RecordBatch]:
    """The pairs of each tile."""
    for one, two in _tiles(batches, 2):
        yield from _pairs(one, two, tiled, light, digits)


def _tiles(batches: Iterator[pa.RecordBatch], sides: int) -> Iterator[list[list[pa.RecordBatch]]]:
    """The rows of each tile by side; they come tile by tile, source 1 first."""
    at, held = None, [[] for _ in range(sides)]
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch["__block"].dictionary_encode()
        place = np.stack([names.indices.to_numpy(), batch["__row"].to_numpy(), batch["__column"].to_numpy()])
        begins = np.flatnonzero(np.r_[True, (place[:, 1:] != place[:, :-1]).any(axis=0)]).tolist()
        side = batch["__side"].to_numpy()
        for begin, end in zip(begins, [*begins[1:], batch.num_rows], strict=True):
            here = (names.dictionary[int(place[0, begin])].as_py(), *place[1:, begin].tolist())
            if here != at:
                yield held
                at, held = here, [[] for _ in range(sides)]
            edges = begin + np.searchsorted(side[begin:end], np.arange(sides + 1))
            for k, (x, y) in enumerate(pairwise(edges.tolist())):
                if y > x and (k == 0 or held[0]):  # else they meet nobody
                    held[k].append(batch.slice(x, y - x))
    yield held


def _wrapped(batches: Iterator[pa.RecordBatch], long: list[str]) -> Iterator[pa.RecordBatch]:
    """The long columns as one, __long: the size of each value in bytes, -1 for null, and all of them compressed."""
    for batch in batches:
        values = zip(*(batch[n].cast(pa.binary()).to_pylist() for n in long), strict=True)
        found = [np.array([-1 if v is None else len(v) for v in row], "<i4").tobytes() + _CODEC.compress(b"".join(v or b"" for v in row), asbytes=True) for row in values]
        rest = [n for n in batch.schema.names if n not in long]
        yield pa.RecordBatch.from_arrays([*(batch[n] for n in rest), pa.array(found, pa.binary())], [*rest, "__long"])


def _unwrapped(batch: pa.RecordBatch, sizes: np.ndarray, long: list[str]) -> pa.RecordBatch:
    columns = [[] for _ in long]
    for size, value in zip(sizes.tolist(), batch["__long"].to_pylist(), strict=True):
        total, at = sum(max(0, n) for n in size), 0
        text = _CODEC.decompress(value[4 * len(long) :], total, asbytes=True) if total else b""
        for column, n in zip(columns, size, strict=True):
            column.append(None if n < 0 else text[at : at + n])
            at += max(0, n)
    rest = [n for n in batch.schema.names if n != "__long"]
    return pa.RecordBatch.from_arrays([*(batch[n] for n in rest), *(pa.array(c, pa.binary()).cast(pa.string()) for c in columns)], [*rest, *long])


def _pieces(rows: list[pa.RecordBatch], tiled: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of a side in pieces of so many characters."""
    table = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
    size = np.zeros(table.num_rows, np.int64)
    long = [n for n in tiled if n in LONG]
    for n in tiled:
        if n not in long:
            size += pc.fill_null(pc.binary_length(table[n]), 0).to_numpy(zero_copy_only=False)
    sizes = np.zeros((table.num_rows, len(long)), np.int64)
    if long:
        heads = pc.binary_slice(table["__long"], 0, 4 * len(long)).to_pylist()
        sizes = np.frombuffer(b"".join(heads), "<i4").reshape(-1, len(long)).astype(np.int64)
        size += np.maximum(0, sizes).sum(axis=1)
    part = np.cumsum(size) // CHARS
    begins = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]).tolist()
    for begin, end in zip(begins, [*begins[1:], table.num_rows], strict=True):
        piece = table.slice(begin, end - begin)
        yield _unwrapped(piece, sizes[begin:end], long) if long else piece


def _pairs(one: list[pa.RecordBatch], two: list[pa.RecordBatch], tiled: list[str], light: list[str], digits: int | None) -> Iterator[pa.RecordBatch]:
    if not one or not two:
        return
    for a in _pieces(one, tiled):
        for b in _pieces(two, tiled):
            found = []
            for n in tiled:
                x, y = a[n].dictionary_encode("encode"), b[n].dictionary_encode("encode")
                values = TILED[n][0](*(_told(n, v.dictionary.to_pylist()) for v in (x, y)))
                found.append((values if digits is None else rounded(values, digits), x.indices.to_numpy(), y.indices.to_numpy()))
            step = max(1, PAIRS // b.num_rows)
            for begin in range(0, a.num_rows, step):
                end = min(a.num_rows, begin + step)
                i, j = pa.array(np.repeat(np.arange(begin, end), b.num_rows)), pa.array(np.tile(np.arange(b.num_rows), end - begin))
                columns = [a["entity_id"].take(i), b["entity_id"].take(j), *[pa.array(v[x[begin:end]][:, y].ravel()) for v, x, y in found]]
                columns += [a[f"__read_{c}"].take(i) for c in light] + [b[f"__read_{c}"].take(j) for c in light]
                names = ["source1_entity_id", "candidate_entity_id", *tiled, *[f"__{k}_{c}" for k in "ab" for c in light]]
                yield pa.RecordBatch.from_arrays(columns, names)


def _told(name: str, sent: list[str | None]) -> list:
    """Values as TILED compares them."""
    if TILED[name][0] in (tiles.jaccard, tiles.near_numbers):
        return [t.split("\n")[:-1] if t else [] for t in sent]
    return sent


def listed_features(source1: DataFrame, candidates: DataFrame, pairs: DataFrame) -> DataFrame:
    """pair_features, for pairs that are cheap to count. Where they are so many that two records with each would be more than all records
    with each tile, they are compared in tiles, and no address travels with a pair."""
    n, m, k = (df.count() for df in (source1, candidates, pairs))
    cuts = [max(1, min(COPIES, math.ceil(x / ALIGNED_ROWS)), math.ceil(x / MOST_ROWS)) for x in (n, m)]
    if 2 * k <= n * cuts[1] + m * cuts[0]:
        return pair_features(source1, candidates, pairs)
    for df, what in ((source1, "source1"), (candidates, "candidates")):
        require(df, ("entity_id", *FIELDS), what)
        require_unique(df, "entity_id", what)
    tiled, light = [f for f in FEATURES if f in TILED], list(dict.fromkeys(READ.get(f, "name_core") for f in FEATURES if f not in TILED))
    more = [c for c in pairs.columns if c not in ("source1_entity_id", "candidate_entity_id")]
    part = lambda key, side: F.pmod(F.xxhash64(key), F.lit(cuts[side])).cast("int")

    def sent(df: DataFrame, side: int) -> DataFrame:
        own_at, other_at = AT[1:] if side == 0 else AT[:0:-1]
        placed = _narrow(df.withColumn("__block", F.lit("")), side, tiled, light).withColumn(own_at, part("entity_id", side))
        return placed.withColumn(other_at, F.explode(F.sequence(F.lit(0), F.lit(cuts[1 - side] - 1))))

    asked = pairs.where("source1_entity_id is not null and candidate_entity_id is not null").select(
        F.lit("").alias("__block"), F.lit(2).alias("__side"), F.col("source1_entity_id").alias("entity_id"), F.col("candidate_entity_id").alias("__with"), *[F.col(c).alias(f"__pair_{c}") for c in more],
        part("source1_entity_id", 0).alias("__row"), part("candidate_entity_id", 1).alias("__column"),
    )
    rows = sent(source1, 0).unionByName(sent(candidates, 1)).unionByName(asked, allowMissingColumns=True)
    dealt = rows.repartition(max(cuts[0] * cuts[1], int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *AT).sortWithinPartitions(*AT, "__side")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = ["source1_entity_id string", "candidate_entity_id string", *[f"{f} double" for f in tiled], *[f"__{x}_{c} {kinds[f'__read_{c}']}" for x in "ab" for c in light], *[f"`__pair_{c}` {kinds[f'__pair_{c}']}" for c in more]]
    met = dealt.mapInArrow(lambda batches: _listed(batches, tiled, light, more), ", ".join(out))
    a, b = ({c: F.col(f"__{x}_{c}") for c in (*FIELDS, *FLAGS, "code", "grams")} for x in "ab")
    return met.withColumnsRenamed({f"__pair_{c}": c for c in more}).select(*pairs.columns, *feature_columns(a, b, FEATURES, {f: F.col(f) for f in tiled}))


def _listed(batches: Iterator[pa.RecordBatch], tiled: list[str], light: list[str], more: list[str]) -> Iterator[pa.RecordBatch]:
    """The asked pairs of each tile, a record of source 1 against all its candidates in a piece at once."""
    for one, two, asked in _tiles(batches, 3):
        if not (one and two and asked):
            continue
        every = pa.Table.from_batches(asked).select(["entity_id", "__with", *[f"__pair_{c}" for c in more]]).combine_chunks()
        for a in _pieces(one, tiled):
            mine = every.append_column("i", pc.index_in(every["entity_id"], a["entity_id"]))
            mine = mine.filter(pc.is_valid(mine["i"])).sort_by("i")
            known = [_told(f, a[f].to_pylist()) for f in tiled]
            for b in _pieces(two, tiled) if mine.num_rows else ():
                here = mine.append_column("j", pc.index_in(mine["__with"], b["entity_id"]))
                here = here.filter(pc.is_valid(here["j"])).combine_chunks()
                if not here.num_rows:
                    continue
                i, j = here["i"].to_numpy(), here["j"].to_numpy()
                begins = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]).tolist()
                values = []
                for f, x in zip(tiled, known, strict=True):
                    y, found = _told(f, b[f].to_pylist()), np.zeros(len(i))
                    for begin, end in zip(begins, [*begins[1:], len(i)], strict=True):
                        found[begin:end] = TILED[f][0]([x[i[begin]]], [y[t] for t in j[begin:end].tolist()])[0]
                    values.append(pa.array(found))
                columns = [a["entity_id"].take(pa.array(i)), b["entity_id"].take(pa.array(j)), *values]
                columns += [a[f"__read_{c}"].take(pa.array(i)) for c in light] + [b[f"__read_{c}"].take(pa.array(j)) for c in light]
                names = ["source1_entity_id", "candidate_entity_id", *tiled, *[f"__{s}_{c}" for s in "ab" for c in light], *[f"__pair_{c}" for c in more]]
                table = pa.Table.from_arrays([*columns, *(here[f"__pair_{c}"] for c in more)], names)
                yield from table.to_batches(max_chunksize=PAIRS)


def with_fallback(source2: DataFrame, source3: DataFrame) -> DataFrame:
    """Records of the second source, and those of the third whose id the second lacks."""
    return source2.unionByName(source3.join(source2.select("entity_id"), "entity_id", "left_anti"), allowMissingColumns=True)


def training_features(source1: DataFrame, source2: DataFrame, source3: DataFrame, pairs: DataFrame) -> DataFrame:
    """Features of labelled pairs against either source; a pair without a record is an error."""
    found = listed_features(source1, both := with_fallback(source2, source3), pairs)
    lost = pairs.join(source1.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_anti").select(F.col("source1_entity_id").alias("id"))
    lost = lost.unionByName(pairs.join(both.select(F.col("entity_id").alias("candidate_entity_id")), "candidate_entity_id", "left_anti").select(F.col("candidate_entity_id").alias("id")))
    missing = [r["id"] for r in lost.limit(3).collect()]
    if missing:
        raise KeyError(f"no record for {missing}")
    return found
