"""Language identification by word-first backoff.

A word (run of letters in the sense of \\p{L}, lower case) seen in training scores by its log frequency in each language. An unseen word
backs off to character n-grams, the longest length of which any n-gram is known, from MOST characters down to one: the
mean log frequency of its known n-grams of that length. A text's language has the highest sum over its words;
the score is that language's share after a softmax of the mean per word, times up to SHARPEN words.

Counts cover every training text, and every count is used. What is broadcast doesn't grow with the corpus: the WORDS most
frequent words, fewer if there are many languages. If these, and GRAMS n-grams of each length, are all there are, texts are scored in one pass. Else that pass adds
up the frequent words and gives the other distinct words of each text, which meet all word counts, and if unseen all n-gram
counts, in joins; each word is scored once for the corpus, and its scores are added to those of the texts that hold it.

Defined cases: null text, or one without a letter, is `und` with score 0; texts of any length are read whole; equal
scores go to the smaller language name; with nothing to learn from every text is `und`; repeated rows are rows of
their own; a null key counts as not held out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm.common import arrow, column, cut, discard, held_out, pieces, read

WORDS, GRAMS, MOST, SHARPEN = 100_000, 50_000, 5, 20
#: Numbers of the table that is broadcast, at most: with many languages it holds fewer words.
CELLS = 2_000_000
#: Distinct words or n-grams that a task counts before it sends them on.
FLUSH = 300_000
LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters (categories L*), lower case; other numerals that the pattern lets through part them."""
    if not text:
        return []
    found = LETTERS.findall(text.lower())
    if text.isascii():
        return found
    return [x for w in found for x in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


def grams(word: str, n: int) -> list[str]:
    """n-grams of the word between two marks; single characters without the marks."""
    w = word if n == 1 else f"<{word}>"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def _by_lang(counted: DataFrame, langs: list[str], *keys: str) -> DataFrame:
    """counted (lang, n and keys) summed by keys: counts, an array in the order of langs, and all. One shuffle, few bytes a key."""
    sums = [F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)) for x in langs]
    return counted.groupBy(*keys).agg(F.array(*sums).cast("array<long>").alias("counts"), F.sum("n").alias("all"))


def count_words(docs: DataFrame, langs: list[str]) -> DataFrame:
    """word, counts, all over docs (text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)

        def flush():
            for lang, c in counts.items():
                for at in range(0, len(keys := list(c)), 50_000):
                    part = keys[at : at + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(part), pa.array([c[k] for k in part], pa.int64())], names=["lang", "word", "n"])
            counts.clear()

        for batch in batches:
            for part in pieces(iter([batch]), "text"):
                for text, lang in zip(column(part, "text"), column(part, "lang"), strict=True):
                    counts[lang].update(words(text))
                if sum(map(len, counts.values())) > FLUSH:
                    yield from flush()
        yield from flush()

    return docs.select("text", "lang").where("text is not null and lang is not null").transform(arrow, run, "lang string, word string, n long").transform(_by_lang, langs, "word")


def count_grams(counted: DataFrame, langs: list[str], most: int = MOST) -> DataFrame:
    """size, gram, counts, all from word counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int, str], int] = defaultdict(int)

        def flush():
            for at in range(0, len(keys := list(counts)), 50_000):
                part = keys[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*part, strict=True)] + [pa.array([counts[k] for k in part], pa.int64())], schema=pa.schema([("lang", pa.string()), ("size", pa.int64()), ("gram", pa.string()), ("n", pa.int64())]))
            counts.clear()

        for batch in batches:
            for word, own in zip(column(batch, "word"), column(batch, "counts"), strict=True):
                for size in range(1, most + 1):
                    for g in grams(word, size):
                        for lang, n in zip(langs, own, strict=True):
                            if n:
                                counts[lang, size, g] += n
                if len(counts) > FLUSH:
                    yield from flush()
        yield from flush()

    return counted.select("word", "counts").transform(arrow, run, "lang string, size long, gram string, n long").transform(_by_lang, langs, "size", "gram")


class Model:
    """Log frequencies of words and n-grams: a row number per key, a column per language.

    rest: the tables of all counts, where the model holds the frequent words alone; it stays on the driver."""

    def __init__(self, langs: list[str], word_counts, gram_counts, word_totals: dict[str, int], gram_totals: dict[tuple[str, int], int], n_words: int, n_grams: dict[int, int], most: int = MOST, rest: Rest | None = None):
        self.langs, self.most, self.rest = langs, most, rest
        at = {x: i for i, x in enumerate(langs)}
        self.words: dict[str, int] = {}
        self.grams: list[dict[str, int]] = [{} for _ in range(most + 1)]
        self.word_logs = self._table(self.words, ((w, at[g], n) for g, w, n in word_counts), np.array([word_totals.get(x, 0) for x in langs]), n_words)
        self.gram_logs = [np.zeros((0, len(langs)))]
        for size in range(1, most + 1) if rest is None else ():
            own = ((g, at[x], n) for x, g, n in gram_counts(size))
            self.gram_logs.append(self._table(self.grams[size], own, np.array([gram_totals.get((x, size), 0) for x in langs]), n_grams.get(size, 0)))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"rest": None}

    @staticmethod
    def _table(keys: dict, rows, totals: np.ndarray, n_keys: int) -> np.ndarray:
        """Logs of (n + 1/2) / (total + half of all keys); a language that never had the key has n = 0."""
        found = array("q")
        for key, lang, n in rows:
            found.extend((keys.setdefault(key, len(keys)), lang, n))
        k, lang, n = np.frombuffer(found, np.int64).reshape(-1, 3).T if found else np.zeros((3, 0), np.int64)
        counts = np.zeros((len(keys), len(totals)), np.float32)
        counts[k, lang] = n
        return np.log((counts + 0.5) / (totals + 0.5 * max(1, n_keys))[None]).astype(np.float32)

    def backoff(self, word: str) -> tuple[int, list[int]]:
        """Length and row numbers of the n-grams that stand for an unseen word; length 0 if none is known."""
        w = f"<{word}>"
        for size in range(min(self.most, len(w)), 0, -1):
            get = self.grams[size].get
            if size == 1:
                known = [k for k in map(get, word) if k is not None]
            else:
                known = [k for i in range(len(w) - size + 1) if (k := get(w[i : i + size])) is not None]
            if known:
                return size, known
        return 0, []

    def known(self, found: list[str]) -> tuple[np.ndarray, list[tuple[str, int]]]:
        """The sums over the words that the model holds, and the other words with how often they stand."""
        counts = Counter(found)
        rows = list(map(self.words.get, counts))
        pairs = [(r, n) for r, n in zip(rows, counts.values(), strict=True) if r is not None]
        total = np.zeros(len(self.langs))
        if pairs:
            known, times = np.array(pairs).T
            total += times @ self.word_logs[known]
        return total, [x for x, r in zip(counts.items(), rows, strict=True) if r is None] if len(pairs) < len(counts) else []

    def predict(self, found: list[str]) -> tuple[str, float]:
        """Of a model that holds all counts."""
        if self.rest is not None:
            raise ValueError("the model holds the frequent words alone: use identify()")
        if not found or not self.langs:
            return "und", 0.0
        total, others = self.known(found)
        if others:  # n-grams of all unseen words at once, each weighted to its word's mean
            by_size: list[tuple[list[int], list[int], list[float]]] = [([], [], []) for _ in range(self.most + 1)]
            for w, n in others:
                size, own = self.backoff(w)
                ids, lengths, times = by_size[size]
                ids += own
                lengths.append(len(own))
                times.append(n)
            for size, (ids, lengths, times) in enumerate(by_size):
                if ids:
                    total += np.repeat(np.array(times) / np.array(lengths), lengths) @ self.gram_logs[size][ids]
        x = (total - total.max()) / len(found) * min(len(found), SHARPEN)
        e = np.exp(x)
        k = int(total.argmax())
        return self.langs[k], float(e[k] / e.sum())


class Rest:
    """All counts as tables: words (word, counts) and grams (size, gram, counts), counts in the order of the languages."""

    def __init__(self, words: DataFrame, grams: DataFrame, word_norms: list[float], gram_norms: list[list[float]]):
        self.words, self.grams, self.word_norms, self.gram_norms = words, grams, word_norms, gram_norms

    def score(self, words: DataFrame, pool: list[str]) -> DataFrame:
        """word, counts, logs of distinct words: counts of those seen, logs of those unseen; without a known n-gram no row.

        Shuffles carry counts, small numbers that compress well, rather than their logs."""
        met = cut(words.join(self.words, "word", "left"), "langid-met", pool)
        none = F.lit(None)
        scores = met.where("counts is not null").withColumn("logs", none.cast("array<double>"))
        left = met.where("counts is null").select("word")
        for size in range(len(self.gram_norms), 0, -1):
            own = self.grams.where(F.col("size") == size).select("gram", "counts")
            spelled = left.transform(arrow, _speller(size), "word string, gram string, times long")
            found = spelled.join(own, "gram").select("word", "times", "counts").repartition("word")
            sums = [F.sum(F.col("times") * x) / F.sum("times") for x in _logs(self.gram_norms[size - 1])]
            found = cut(found.groupBy("word").agg(F.array(*sums).alias("logs")), "langid-unseen", pool)
            scores = scores.unionByName(found.select("word", none.cast("array<long>").alias("counts"), "logs"))
            left = cut(left.join(found, "word", "left_anti"), "langid-left", pool)
            if left.isEmpty():
                break
        return scores


def _logs(norms: list[float]) -> list[Column]:
    return [F.log((F.get("counts", F.lit(i)) + 0.5) / F.lit(x)) for i, x in enumerate(norms)]


def _speller(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(iter([batch]), "word", 500_000):
                if rows := [(w, g, n) for w in column(part, "word") for g, n in Counter(grams(w, size)).items()]:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["word", "gram", "times"])

    return run


def fit(docs: DataFrame, n_words: int = WORDS, n_grams: int = GRAMS, most: int = MOST) -> Model:
    """From text and lang of docs. n_words, n_grams: how many the model itself holds; the results don't depend on them."""
    pool: list[str] = []
    every = sorted(r["lang"] for r in docs.where("text is not null and lang is not null").select("lang").distinct().collect())
    words = cut(count_words(docs, every), "langid-words", pool)
    sums = lambda n: [F.sum(F.get("counts", F.lit(i))).alias(f"n{i}") for i in range(n)]
    all_words, *totals = words.agg(F.count("*"), *sums(len(every))).first()
    langs = [x for x, n in zip(every, totals, strict=True) if n]  # others have no words
    if len(langs) < len(every):
        words = words.withColumn("counts", F.array(*[F.get("counts", F.lit(every.index(x))) for x in langs]))
    totals = dict(zip(every, totals, strict=True))
    spelled = cut(count_grams(words, langs, most), "langid-grams", pool)
    by_size = {r[0]: r[1:] for r in spelled.groupBy("size").agg(F.count("*"), *sums(len(langs))).collect()}
    all_grams = {size: r[0] for size, r in by_size.items()}
    gram_totals = {(x, size): n for size, r in by_size.items() for x, n in zip(langs, r[1:], strict=True)}
    rest = None
    if all_words > min(n_words, max(1, CELLS // max(1, len(langs)))) or any(n > n_grams for n in all_grams.values()):
        norm = lambda total, n: total + 0.5 * max(1, n)
        gram_norms = [[norm(gram_totals.get((x, size), 0), all_grams.get(size, 0)) for x in langs] for size in range(1, most + 1)]
        rest = Rest(words.drop("all"), spelled.drop("all"), [norm(totals[x], all_words) for x in langs], gram_norms)

    def each(keys: DataFrame) -> Iterator[tuple]:
        return ((x, key, n) for key, counts in _collected(keys) for x, n in zip(langs, counts, strict=True) if n)

    top = words.orderBy(F.desc("all"), "word").limit(min(n_words, max(1, CELLS // max(1, len(langs))))).select("word", "counts")
    of_size = lambda size: each(spelled.where(F.col("size") == size).select("gram", "counts"))
    model = Model(langs, each(top), of_size, totals, gram_totals, all_words, all_grams, most, rest)
    if rest is None:
        discard(pool)
    return model


def _collected(df: DataFrame) -> Iterator[tuple]:
    """Rows of a table of bounded size, batch by batch from Arrow: far smaller on the driver than Row objects."""
    for batch in df.toArrow().to_batches(max_chunksize=20_000):
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score from doc_id and text alone."""
    if model.rest is not None:
        return _identify_joined(docs, model)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(iter([batch]), "text"):
                found = [sent.value.predict(words(t)) for t in column(part, "text")]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return table.transform(arrow, run, "doc_id long, held_out boolean, lang_pred string, score double")


def _identify_joined(docs: DataFrame, model: Model) -> DataFrame:
    """identify() for a model whose other counts are tables."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rest, pool = model.rest, []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = lambda parts, flat: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *parts]), pa.int32()), flat)
        for batch in batches:
            for part in pieces(iter([batch]), "text"):
                n, sums, others = [], [], []
                for text in column(part, "text"):
                    found = words(text)
                    total, other = sent.value.known(found)
                    n.append(len(found))
                    sums.append(total)
                    others.append(other)
                sizes = list(map(len, others))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(3)), pa.array(n, pa.int64()), lists(map(len, sums), pa.array(np.concatenate(sums))), lists(sizes, pa.array([w for o in others for w, _ in o], pa.string())), lists(sizes, pa.array([k for o in others for _, k in o], pa.int64()))],
                    names=["row", "doc_id", "held_out", "n", "sums", "words", "times"],
                )

    # The number is written with the row, and is the row's own from there on
    table = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    kept: list[str] = []
    partly = cut(table.transform(arrow, run, "row long, doc_id long, held_out boolean, n long, sums array<double>, words array<string>, times array<long>"), "langid-rows", kept)
    others = partly.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", "x.words", "x.times").withColumnRenamed("words", "word")
    scores = rest.score(others.select("word").distinct(), pool)
    parts = others.join(scores, "word").select("row", "times", "counts", "logs").repartition("row")
    added = [F.sum(F.col("times") * F.coalesce(F.get("logs", F.lit(i)), x)) for i, x in enumerate(_logs(rest.word_norms))]
    more = cut(parts.groupBy("row").agg(F.array(*added).alias("more")), "langid-more", kept)
    discard(pool)
    total = F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda a, b: a + b))
    best = F.array_max("total")
    e = F.transform("total", lambda x: F.exp((x - best) / F.col("n") * F.least("n", F.lit(SHARPEN))))
    found = F.col("n") > 0
    return (
        partly.select("row", "doc_id", "held_out", "n", "sums")
        .join(more, "row", "left")
        .select("doc_id", "held_out", "n", total.alias("total"))
        .select(
            "doc_id",
            "held_out",
            F.when(found, F.get(F.array(*map(F.lit, model.langs)), (F.array_position("total", best) - 1).cast("int"))).otherwise("und").alias("lang_pred"),
            F.when(found, 1 / F.aggregate(e, F.lit(0.0), lambda a, x: a + x)).otherwise(0.0).alias("score"),
        )
    )


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify(docs, fit(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())))
