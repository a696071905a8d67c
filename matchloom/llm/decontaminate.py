"""Benchmark decontamination with suffix arrays of the training texts.

Words are runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after A-Z are lower-cased. Test suffixes are the windows of the
benchmark: 10 consecutive words of an item, or all words of a shorter one. Every batch of documents is a shard: its
words become numbers (0 for words that the benchmark doesn't have), its suffixes are sorted as the
big-endian bytes of their first 10 numbers, and every window is binary-searched in that array, which gives all places
where it occurs. Only suffixes that can equal a window are sorted: those whose next words, as many as the
shortest window has, are all benchmark words. Places that continue each other in one item join to the longest
verbatim match.

The benchmark goes to the tasks in slices of bounded size (SLICE words), one pass after another inside the same
stage; a benchmark of one slice takes one pass. Documents are never shuffled.

Defined cases: null text has no words; items without words never occur; equal texts under several item_ids each
count, one item_id counts once, null as the empty string; equal windows of different items are searched once and credited to all; repeated document rows each get their result; an empty
benchmark hits nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm.common import arrow, pieces, read, utf8, words_alnum

WINDOW = 10
#: Words of the benchmark in one slice, and bytes of text in one shard.
SLICE, SHARD = 200_000, 8_000_000


class Windows:
    """The distinct windows of some items, as sorted keys to search for."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.window, self.ids = window, [i for i, _ in items]
        numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for item, (_, text) in enumerate(items):
            w = [numbers.setdefault(x, len(numbers) + 1) for x in words_alnum(text)]
            for at in range(max(1, len(w) - window + 1) if w else 0):
                found.setdefault(tuple(w[at : at + window]), []).append((item, at))
        self.numbers, self.keys, self.places = numbers, list(found), list(found.values())
        self.sizes = np.array([len(k) for k in self.keys], np.int64)
        self.least = int(self.sizes.min()) if len(self.keys) else 0
        rows = np.zeros((len(self.keys), window), ">u4")
        ends = np.full((len(self.keys), window), 0xFFFFFFFF, ">u4")
        for row, end, k in zip(rows, ends, self.keys, strict=True):
            row[: len(k)] = end[: len(k)] = k
        self.low, self.high = _bytes(rows), _bytes(ends)

    def search(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(number of a window, its positions in words); a 0 in words separates texts and stands for other words."""
        if not len(self.keys) or len(words) < self.least:
            return
        known = np.concatenate(([0], np.cumsum(words > 0)))
        starts = np.flatnonzero(known[self.least :] - known[: -self.least] == self.least)
        padded = np.concatenate((words, np.zeros(self.window, words.dtype)))
        suffixes = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, self.window)[starts].astype(">u4"))
        # What stands behind a foreign word can't be part of a match
        suffixes[np.cumsum(suffixes == 0, axis=1) > 0] = 0
        keys = _bytes(suffixes)
        order = np.argsort(keys, kind="stable")
        array = keys[order]
        a, b = np.searchsorted(array, self.low, "left"), np.searchsorted(array, self.high, "right")
        for k in np.flatnonzero(b > a):
            yield int(k), starts[order[a[k] : b[k]]]


def _bytes(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian numbers as byte strings, which compare as the rows do."""
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1] * 4}").ravel() if len(rows) else np.empty(0, "S40")


def _spans(hits: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """Longest matches (item, start, stop) from (item, place in the text less place in the item, place, size) of windows."""
    out: list[tuple[int, int, int]] = []
    last = None
    for item, shift, place, size in sorted(hits):
        if last == (item, shift) and place <= out[-1][2]:
            out[-1] = (item, out[-1][1], max(out[-1][2], place + size))
        else:
            out.append((item, place, place + size))
        last = (item, shift)
    return out


def _slices(benchmark: DataFrame) -> list[DataFrame]:
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // (4 * SLICE)))
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


SPAN = "array<struct<item_id:string,start:int,stop:int>>"


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs (its doc_id and text), n_words, matches: longest verbatim matches as (item_id, start, stop) in words."""
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("n_words"), F.array().cast(SPAN).alias("matches"))
    for part in _slices(benchmark):
        items = [(r["item_id"], r["text"].encode() if r["text"] is not None else None) for r in part.collect()]
        table = table.transform(arrow, _matcher(table.sparkSession.sparkContext.broadcast(items), window), table.schema)
    return table


def _matcher(items, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = Windows(items.value, window)
        kind = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        for batch in pieces(batches, "text", SHARD):
            numbers, get = [], tests.numbers.get
            begins, sizes = [], []
            for text in utf8(batch, "text"):
                w = words_alnum(text)
                begins.append(len(numbers))
                sizes.append(len(w))
                numbers.extend([get(x, 0) for x in w])
                numbers.append(0)
            begins_at = np.array(begins, np.int64)
            hits: dict[int, list[tuple[int, int, int, int]]] = {}
            for k, at in tests.search(np.array(numbers, np.uint32)):
                for doc, place in zip((np.searchsorted(begins_at, at, "right") - 1).tolist(), at.tolist(), strict=True):
                    hits.setdefault(doc, []).extend((item, place - begins[doc] - own, place - begins[doc], len(tests.keys[k])) for item, own in tests.places[k])
            old = batch.column(3)
            if hits or any(len(x) for x in old.to_pylist()):
                spans = old.to_pylist()
                for doc, found in hits.items():
                    spans[doc] = spans[doc] + [{"item_id": tests.ids[i], "start": a, "stop": b} for i, a, b in _spans(found)]
                old = pa.array(spans, kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), old], names=["doc_id", "text", "n_words", "matches"])

    return run


def score(matched: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, n_items, sha = [], [], []
            for spans in batch.column(2).to_pylist():
                hit, reach = 0, 0
                for start, stop in sorted((s["start"], s["stop"]) for s in spans):
                    hit += max(0, stop - max(start, reach))
                    reach = max(reach, stop)
                ids = sorted({s["item_id"] for s in spans})
                n_hit.append(hit)
                n_items.append(len(ids))
                sha.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(sha), pa.array([n > 0 for n in n_hit]), batch.column(2)],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "matches"],
            )

    kind = f"doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, matches {SPAN}"
    return matched.select("doc_id", "n_words", "matches").transform(arrow, run, kind)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs, all columns, that hold no window of the benchmark."""
    for part in _slices(benchmark):
        items = [(r["item_id"], r["text"].encode() if r["text"] is not None else None) for r in part.collect()]
        docs = docs.transform(arrow, _cleaner(docs.sparkSession.sparkContext.broadcast(items), window), docs.schema)
    return docs


def _cleaner(items, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = Windows(items.value, window)
        get = tests.numbers.get
        for batch in pieces(batches, "text", SHARD):
            numbers, begins = [], []
            for text in utf8(batch, "text"):
                begins.append(len(numbers))
                numbers.extend([get(x, 0) for x in words_alnum(text)])
                numbers.append(0)
            clean = np.ones(batch.num_rows, bool)
            for _, at in tests.search(np.array(numbers, np.uint32)):
                clean[np.searchsorted(begins, at, "right") - 1] = False
            yield batch.filter(pa.array(clean))

    return run


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(find_matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))).drop("matches")


def _sql_words(text: str) -> str:
    low = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_sql_words("text")} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, {_sql_words("text")} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(list_slice(w, i, i + {WINDOW} - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - {WINDOW} + 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
dw AS (
  SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))
),
h AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, g)),
p AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM (SELECT r, i, unnest(range(0, n)) AS j FROM h) GROUP BY r),
m AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM h GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN m USING (r)
"""
