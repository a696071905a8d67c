"""Exact top-k search by inner product over a pivot-distance index.

Vectors get one more component, sqrt(M - |x|^2) with M the largest squared norm (queries get 0), after which a larger inner
product is a smaller distance: d(q, x)^2 = |q|^2 + M - 2 q.x. Every vector is keyed by its nearest pivot and its
distance to it. In order of (pivot, distance) the vectors are packed into blocks of at most BLOCK rows: sorted
annuli, each with the smallest and largest distance it holds. By the triangle inequality no vector of an annulus
[lo, hi] around p comes nearer to q than the gap between d(q, p) and [lo, hi]; a query walks the annuli in order
of that bound and stops once it can't beat its k-th best score.

Queries meet blocks in two steps. In order of their own (pivot, distance) queries form packs of at most QUERIES, and blocks
groups of some GROUP neighbours. First each query searches blocks around its own nearest pivot: its k-th best score there
is a floor, and with it the radius in which better ones can lie. Around each pivot a pack reaches from its least distance less radius
to its largest distance plus radius; only annuli that overlap this reach are sent to the pack, so bounds cut the shuffle as
well as the work. Both sides of a (pack, group) are bounded, whatever the table's size; equal vectors, however
many, are spread over blocks since vec_id is part of the order. The driver gets a count per partition, nothing of the index.

The pivots are a sample of fixed size; they decide speed only, as the bounds hold for any pivots.

Defined cases: vectors null, or with a null or non-finite component, take no part; shorter vectors count as padded
with zeros; a row never finds rows with its own id, so repeated ids are skipped for each other; queries that share an id are answered together, with the best
scores of any of them; queries with fewer candidates return fewer; ties go to the smaller id; scores are exact while they fit a long; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchloom.llm.common import arrow, cut, discard, read

PIVOTS, BLOCK, GROUP, QUERIES, NEAR = 64, 512, 64, 2048, 4
SALTS = 16  # parts in which the packs of a pivot meet its annuli
SLACK = 1e-6  # of a bound, for rounding; widens the search, never narrows it


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and v: floor(scale * component) as longs, of the vectors that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(scale * x).cast("long")).alias("v")
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, padded to dim, as longs."""
    out = np.zeros((len(column), dim), np.int64)
    if not len(column):
        return out
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return flat.reshape(-1, dim).astype(np.int64)
    at = 0
    for row, n in zip(out, sizes, strict=True):
        row[:n] = flat[at : at + n]
        at += n
    return out


def _lifted(m: np.ndarray, top: float) -> np.ndarray:
    x = m.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(0.0, top - (x * x).sum(1)))[:, None]])


def _unlifted(m: np.ndarray) -> np.ndarray:
    return np.hstack([m.astype(np.float64), np.zeros((len(m), 1))])


def _far(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots."""
    return np.sqrt(np.maximum(0.0, (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None] - 2 * x @ pivots.T))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of longs."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1]) < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class _Best:
    """The k best (score, smaller id first) of one query."""

    def __init__(self, k: int, floor: float):
        self.k, self.floor = k, floor
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.floor
        s, i = np.concatenate((self.scores, scores[keep])), np.concatenate((self.ids, ids[keep]))
        order = np.lexsort((i, -s))[: self.k]
        self.scores, self.ids = s[order], i[order]
        if len(s := self.scores) == self.k:
            self.floor = max(self.floor, float(s[-1]))


BLOCKS = "pid int, at long, pivot int, lo double, hi double, ids binary, rows binary"
FOUND = "query_id long, vec_id long, score long"


def _dealt(df: DataFrame, size, most: int, name: str) -> DataFrame:
    """df with name: the number of its run of about `most` rows, in the order of (pid, at). size: rows that a row stands for."""
    counts, ends = sorted(map(tuple, df.groupBy("pid").agg(F.sum(size)).collect())), 0
    offsets = []
    for pid, n in counts:
        offsets.append((pid, ends))
        ends += n
    told = df.sparkSession.createDataFrame(offsets, "pid int, offset long")  # a row per partition
    return df.join(F.broadcast(told), "pid").withColumn(name, F.floor((F.col("offset") + F.col("at")) / most)).drop("pid", "at", "offset")


def _keyer(id_name: str, sent, dim: int, top: float | None):
    """id, v, nearest pivot and distance to it; vectors are lifted to top, queries (None) not."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(1), dim)
                far = _far(_unlifted(rows) if top is None else _lifted(rows, top), sent.value)
                near = far.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(near)), near])], names=[id_name, "v", "pivot", "far"]
                )

    return key


def index(vectors: DataFrame, sent, dim: int, top: float, pool: list[str]) -> DataFrame:
    """Blocks of the index from vec_id and v, written to the shared folder; part: the group of neighbouring blocks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            pivot = batch.column(2).to_numpy()
            far, ids, rows = batch.column(3).to_numpy(), batch.column(0).to_numpy(), _matrix(batch.column(1), dim)
            ends = np.flatnonzero(np.diff(pivot)) + 1
            cuts = [c for a, b in zip([0, *ends], [*ends, len(pivot)], strict=True) for c in range(a, b, BLOCK)] + [len(pivot)]
            out = [(pid, at + a, int(pivot[a]), far[a:b].min(), far[a:b].max(), ids[a:b].tobytes(), rows[a:b].tobytes()) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
            at += len(pivot)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], schema=pa.schema([("pid", pa.int32()), ("at", pa.int64()), ("pivot", pa.int32()), ("lo", pa.float64()), ("hi", pa.float64()), ("ids", pa.binary()), ("rows", pa.binary())]))

    keyed = vectors.transform(arrow, _keyer("vec_id", sent, dim, top), "vec_id long, v array<long>, pivot int, far double")
    ordered = keyed.repartitionByRange("pivot", "far", "vec_id").sortWithinPartitions("pivot", "far", "vec_id")
    blocks = cut(ordered.transform(arrow, pack, BLOCKS), "topk-blocks", pool)
    return _dealt(blocks, (F.octet_length("ids") / 8).cast("long"), BLOCK * GROUP, "part")


def packs(queries: DataFrame, sent, dim: int, pool: list[str]) -> DataFrame:
    """query_id, v, pivot and pack of the distinct queries, written to the shared folder."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.full(n, pid, np.int32)), pa.array(np.arange(at, at + n))], names=["query_id", "v", "pivot", "pid", "at"])
            at += n

    asked = queries.where("vec_id is not null").select(F.col("vec_id").alias("query_id"), "v").distinct()
    keyed = asked.transform(arrow, _keyer("query_id", sent, dim, None), "query_id long, v array<long>, pivot int, far double")
    ordered = keyed.repartitionByRange("pivot", "far", "query_id").sortWithinPartitions("pivot", "far", "query_id")
    placed = cut(ordered.transform(arrow, place, "query_id long, v array<long>, pivot int, pid int, at long"), "topk-queries", pool)
    return _dealt(placed, F.lit(1), QUERIES, "pack")


def _reacher(sent, dim: int, top: float):
    """Of a pack: for every pivot the distances from it between which a vector can beat the floor of one of its queries."""

    def reach(pack: pa.Table) -> pa.Table:
        pack = pack.combine_chunks()
        rows = _unlifted(_matrix(pack.column("v").chunk(0), dim))
        floors = np.array([-np.inf if x is None else float(x) for x in pack.column("floor").to_pylist()])
        norms, far = (rows * rows).sum(1), _far(rows, sent.value)
        square = norms + top - 2 * floors + 2 * (np.abs(floors) * SLACK + 1)
        radius = (np.sqrt(np.maximum(0.0, square)) * (1 + SLACK) + SLACK * np.sqrt(top + norms + 1))[:, None]
        low, high = (far - radius).min(0), (far + radius).max(0)
        n = len(low)
        return pa.table([pa.array([pack.column("pack")[0].as_py()] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.array(low), pa.array(high)], names=["pack", "pivot", "low", "high"])

    return reach


def _search(queries, blocks, pivots: np.ndarray, dim: int, top: float, k: int) -> tuple[list, list, list]:
    """Of (id, row, floor) against (pivot, lo, hi, ids, rows): ids of queries, ids found and scores."""
    ids, rows, floors = queries
    out: tuple[list, list, list] = ([], [], [])
    if not len(ids) or not blocks:
        return out
    q = _unlifted(rows)
    far, norms = _far(q, pivots), (q * q).sum(1)
    pivot, lo, hi = (np.array([b[i] for b in blocks]) for i in range(3))
    gap = np.maximum(0.0, np.maximum(lo[None] - far[:, pivot], far[:, pivot] - hi[None]) * (1 - SLACK) - SLACK * np.sqrt(top + 1))
    bound = (norms[:, None] + top - gap * gap) / 2
    bound += np.abs(bound) * SLACK + 1
    best = [_Best(k, f) for f in floors]
    # Annuli in the order of their best bound over the queries; each is multiplied with the queries it can still serve
    for j in np.argsort(-bound.max(0), kind="stable"):
        open_ = np.flatnonzero(bound[:, j] >= np.array([b.floor for b in best]))
        if len(open_):
            own = blocks[j][3]
            scores = _products(rows[open_], blocks[j][4])
            for n, i in enumerate(open_):
                other = own != ids[i]
                best[i].add(scores[n][other], own[other])
    for i, b in zip(ids.tolist(), best, strict=True):
        out[0].extend([i] * len(b.ids))
        out[1].extend(b.ids.tolist())
        out[2].extend(b.scores.tolist())
    return out


def _searcher(pivots, dim: int, top: float, k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        v = left.column("v")
        rows = _matrix(v.chunk(0), dim) if v.num_chunks else np.zeros((0, dim), np.int64)
        floors = np.array([-np.inf if x is None else float(x) for x in left.column("floor").to_pylist()])
        blocks = [
            (r["pivot"], r["lo"], r["hi"], np.frombuffer(r["ids"], np.int64), np.frombuffer(r["rows"], np.int64).reshape(-1, dim))
            for r in right.select(["pivot", "lo", "hi", "ids", "rows"]).to_pylist()
        ]
        found = _search((left.column("query_id").to_numpy(), rows, floors), blocks, pivots.value, dim, top, k)
        return pa.table([pa.array(x, pa.int64()) for x in found], names=["query_id", "vec_id", "score"])

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 10, n_pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best vectors of each query; both tables hold vec_id and v (longs)."""
    pool: list[str] = []
    vectors = cut(vectors, "topk-vectors", pool)
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    size = vectors.agg(F.count("*"), F.max(F.size("v")), F.max(squares)).first()
    if not size[0]:
        discard(pool)
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim, top = max(1, size[1]), float(size[2]) * (1 + 1e-9) + 1
    hashed = F.xxhash64("v")  # equal vectors share a bucket, so that however many copies give one pivot
    sample = vectors.groupBy(F.pmod(hashed, F.lit(4 * n_pivots)).alias("bucket")).agg(F.min_by("v", hashed).alias("v")).orderBy("bucket").limit(n_pivots).collect()
    padded = np.zeros((len(sample), dim), np.int64)
    for row, x in zip(padded, sample, strict=True):
        row[: len(x["v"])] = x["v"]
    sent = vectors.sparkSession.sparkContext.broadcast(_lifted(padded, top))
    blocks, asked = index(vectors, sent, dim, top, pool), packs(queries, sent, dim, pool)
    run = _searcher(sent, dim, top, k)
    # Floors: of each pivot's blocks, the NEAR ones nearest to it, against the packs that hold queries of that pivot
    place = F.row_number().over(Window.partitionBy("pivot").orderBy("lo", "hi", "ids"))
    nearest = blocks.withColumn("n", place).where(F.col("n") <= NEAR).drop("n")
    homes = asked.select("pivot", F.col("pack").alias("to")).distinct()
    spread = nearest.join(homes, "pivot").withColumn("home", F.col("pivot"))
    seeds = asked.withColumn("floor", F.lit(None).cast("long")).groupBy("pivot", "pack").cogroup(spread.groupBy("home", "to")).applyInArrow(run, FOUND)
    ranked = _top(seeds, k).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") == k)
    floored = cut(asked.join(ranked.select("query_id", "floor"), "query_id", "left").select("query_id", "v", "pack", "floor"), "topk-floors", pool)
    # Packs against the annuli within their reach, group by group
    reach = floored.groupBy("pack").applyInArrow(_reacher(sent, dim, top), "pack long, pivot int, low double, high double")
    annuli = blocks.groupBy("part", "pivot").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    near = reach.withColumn("salt", F.pmod("pack", F.lit(SALTS)).cast("int")).join(annuli, ["pivot", "salt"]).where("lo <= high and hi >= low")
    pairs = cut(near.select("pack", "part", "pivot", "low", "high"), "topk-pairs", pool)
    left = floored.join(pairs.select("pack", "part").distinct(), "pack")
    right = blocks.join(pairs.withColumnRenamed("pack", "to"), ["part", "pivot"]).where("lo <= high and hi >= low").withColumnRenamed("part", "of")
    found = left.groupBy("pack", "part").cogroup(right.groupBy("to", "of")).applyInArrow(run, FOUND)
    best = cut(_top(found, k).select("query_id", "rank", "vec_id", "score"), "topk-found")
    discard(pool)
    return best


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(read(spark, sf_dir, "embeddings"))
    return top_k(vectors.where("vec_id % 100 = 0"), vectors, 10)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
