"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Every whole text becomes a vector of transformed statistics (logarithms of sizes, shares on a logit scale). Per class, a mean
and a covariance shrunk towards the pooled one and towards its own diagonal; both determinants and the inverse
square roots come from Cholesky factors that are computed once, cached in the model and sent with it. The score is the
logistic of the difference of the log-densities (a Mahalanobis term each) plus the log of the classes' odds. Statistics
of few words scatter more than the covariances of whole texts say, so the difference counts words / (words + evidence).

The model is fitted on the labelled training rows, on SAMPLE labels of them at most, chosen by hash. evidence is chosen among
EVIDENCE by cross-validation inside these rows: moments are sums per fold and class, so the model without a fold is a difference
of sums, and the value with the smallest log loss wins. Spark adds up moments and losses; the model's size depends on the number
of statistics alone. Sums are rounded before they are used, so that the order of adding doesn't show in a score.

Defined cases: null and empty text have the statistics of a text without words, and a score; texts of any length are read
whole; a doc_id with several labels counts each; null labels are ignored; with labels of one class alone every
score is that class, with none 0.5; repeated rows are rows of their own; a null doc_id is not held out and
not trained on; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm.common import arrow, cut, discard, held_out, pieces, read, utf8

POOLED, DIAGONAL, FLOOR = 0.05, 0.05, 1e-3
THRESHOLD = 0.3
#: Words at which a text's statistics count half: what is tried, in folds of the training rows.
EVIDENCE, FOLDS = (0, 10, 20, 40, 80, 160, 320, 640, 1280), 4
#: Labels that the model is fitted on, at most; they are broadcast to the documents.
SAMPLE = 200_000
NAMES = (
    "chars", "words", "word_length", "upper", "digits", "marks", "odd_marks", "spaces", "distinct", "top_word",
    "pairs_again", "lines_again", "packed", "ends_marked", "upper_words", "one_kind", "entropy", "line_length",
)
_CLASS = np.full(256, 5, np.uint8)  # other code points
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[[x for x in range(33, 127) if not chr(x).isalnum()]] = 4
_CLASS[:9] = _CLASS[14:32] = 6
_CLASS[127] = 6
_PLAIN = np.zeros(256, bool)
_PLAIN[[ord(x) for x in ".,;:'\"()-?"]] = True


def _logit(share: float, n: float) -> float:
    """Log odds of a share of n things, with half a thing added to either side."""
    return float(np.log((share * n + 0.5) / ((1 - share) * n + 0.5)))


def statistics(text: bytes | None) -> list[float]:
    raw = text or b""
    codes = np.frombuffer(raw, np.uint8)
    n = len(raw)
    kinds = np.bincount(_CLASS[codes], minlength=7) if n else np.zeros(7)
    histogram = np.bincount(codes, minlength=256) if n else np.zeros(256)
    plain = float(histogram[_PLAIN].sum())
    words = raw.split()
    w = len(words)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    rows = [x for x in raw.split(b"\n") if x]
    shares = histogram[histogram > 0] / max(1, n)
    marked = sum(1 for x in words if 33 <= x[-1] < 48 or 58 <= x[-1] <= 64 or 91 <= x[-1] <= 96 or 123 <= x[-1] <= 126)
    upper = sum(1 for x in words if x.isupper())
    kinds_of_words = len({x[-3:] for x in words})
    letters = kinds[0] + kinds[1] + kinds[5]
    return [
        float(np.log1p(n)),
        float(np.log1p(w)),
        float(np.log1p(n / max(1, w))),
        _logit(kinds[1] / max(1, letters), letters),
        _logit(kinds[2] / max(1, n), n),
        _logit(kinds[4] / max(1, n), n),
        _logit((kinds[4] - plain + kinds[6]) / max(1, n), n),
        _logit(kinds[3] / max(1, n), n),
        float(np.log((len(counts) + 1) / (w + 1)) / np.log(w + 2)) if w else 0.0,
        _logit(max(counts.values(), default=0) / max(1, w), w),
        _logit(1 - len(pairs) / max(1, w - 1) if w > 1 else 0.0, w),
        _logit(1 - len(set(rows)) / len(rows) if rows else 0.0, len(rows)),
        float(np.log((len(zlib.compress(raw, 1)) + 1) / (n + 20))),
        _logit(marked / max(1, w), w),
        _logit(upper / max(1, w), w),
        float(np.log((kinds_of_words + 1) / (w + 1)) / np.log(w + 2)) if w else 0.0,
        float(-(shares * np.log(shares)).sum()) if n else 0.0,
        float(np.log1p(n / max(1, len(rows)))),
    ]


Moments = dict[int, tuple[float, np.ndarray, np.ndarray]]  # by class: n, sum, sum of products


class Discriminant:
    """Two Gaussian classes with shrunk covariances."""

    def __init__(self, moments: Moments, evidence: float = 0):
        self.evidence = evidence
        self.only = None if len(moments) == 2 else float(next(iter(moments), 0.5))
        if self.only is not None:
            return
        total = sum(m[0] for m in moments.values())
        spread = {c: s2 / n - np.outer(s / n, s / n) for c, (n, s, s2) in moments.items()}
        pooled = sum(moments[c][0] / total * spread[c] for c in moments)
        self.scale = np.sqrt(np.maximum(np.diag(pooled), 1e-12))
        self.parts = []
        for c in (0, 1):
            n, s, _ = moments[c]
            cov = (1 - POOLED) * spread[c] + POOLED * pooled
            cov = cov / np.outer(self.scale, self.scale)
            cov = (1 - DIAGONAL) * cov + DIAGONAL * np.diag(np.diag(cov)) + FLOOR * np.eye(len(cov))
            chol = np.linalg.cholesky(cov)
            self.parts.append((s / n / self.scale, np.linalg.inv(chol), float(np.log(np.diag(chol)).sum()), float(np.log(n / total))))

    def odds(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """Log odds of the classes, and the difference of the log-densities of each row."""
        logs = []
        for mean, inverse, log_det, prior in self.parts:
            z = (x / self.scale - mean) @ inverse.T
            logs.append((prior, -log_det - 0.5 * (z * z).sum(1)))
        return logs[1][0] - logs[0][0], logs[1][1] - logs[0][1]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.only is not None:
            return np.full(len(x), self.only)
        prior, apart = self.odds(x)
        return _logistic(prior + apart * _weight(x, self.evidence))


def _logistic(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def _weight(x: np.ndarray, evidence: float) -> np.ndarray:
    words = np.expm1(x[:, NAMES.index("words")])
    return np.where(words > 0, words / np.maximum(words + evidence, 1e-9), 0.0 if evidence else 1.0)


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text, quality of the labelled rows that aren't held out; of more than sample labels those of the smallest hashes."""
    marked = labels.where("quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id", "quality"), "doc_id", "quality").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.join(F.broadcast(marked), "doc_id")  # at most sample rows of two numbers


def _folds(rows: DataFrame) -> DataFrame:
    """rows plus fold; all rows of a doc_id share it. (crc32 modulo 5 tells held-out rows, so the fold is taken from what is left.)"""
    return rows.withColumn("fold", F.expr(f"cast((crc32(cast(cast(doc_id as string) as binary)) div 5) % {FOLDS} as int)"))


def moments_of(measured: DataFrame) -> dict[int, Moments]:
    """Moments by fold, of measured rows (x, quality, fold)."""
    d = len(NAMES)
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]
    sums += [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    found: dict[int, Moments] = {k: {} for k in range(FOLDS)}
    for r in measured.groupBy("fold", "quality").agg(F.count("*").alias("n"), *sums).collect():
        products = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                products[i, j] = products[j, i] = float(f"{r[f'p{i}_{j}']:.10g}")
        found[r["fold"]][r["quality"]] = (float(r["n"]), np.array([float(f"{r[f's{i}']:.10g}") for i in range(d)]), products)
    return found


def added(parts: list[Moments]) -> Moments:
    """The moments of several folds together; classes without rows are left out."""
    out: Moments = {}
    for part in parts:
        for c, m in part.items():
            out[c] = tuple(a + b for a, b in zip(out[c], m, strict=True)) if c in out else m
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Discriminant:
    """From the labels (doc_id, quality 0 or 1) of rows that aren't held out."""
    pool: list[str] = []
    rows = _folds(training_rows(docs, labels, sample)).select("text", "quality", "fold")
    measured = cut(measure(rows, {"quality": "int", "fold": "int"}), "quality-statistics", pool)
    parts = moments_of(measured)
    every = added(list(parts.values()))
    others = {k: Discriminant(added([m for j, m in parts.items() if j != k])) for k in parts}
    chosen = EVIDENCE[0]
    if all(m.only is None for m in others.values()):
        losses = measured.transform(arrow, _losses(others), "evidence int, loss double").groupBy("evidence").agg(F.sum("loss").alias("loss")).collect()
        chosen = min((float(f"{r['loss']:.9g}"), r["evidence"]) for r in losses)[1]
    discard(pool)
    return Discriminant(every, chosen)


def _losses(models: dict[int, Discriminant]):
    """Log loss per value of EVIDENCE, each row scored by the model without its fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(EVIDENCE))
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                label, fold = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("quality", "fold"))
                for k, model in models.items():
                    own = x[fold == k]
                    if len(own):
                        prior, apart = model.odds(own)
                        sign = np.where(label[fold == k] == 1, 1, -1)
                        total += [np.logaddexp(0, -sign * (prior + apart * _weight(own, e))).sum() for e in EVIDENCE]
        yield pa.RecordBatch.from_arrays([pa.array(EVIDENCE, pa.int32()), pa.array(total)], names=["evidence", "loss"])

    return run


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("x")).flatten().to_numpy().reshape(batch.num_rows, -1)


def measure(docs: DataFrame, others: dict[str, str]) -> DataFrame:
    """x, the statistics of every row's text, and the columns others (with their types) as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(iter([batch]), "text"):
                rows = [statistics(t) for t in utf8(part, "text")]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), *(part.column(part.schema.get_field_index(n)) for n in others)], names=["x", *others])

    return docs.select("text", *others).transform(arrow, run, ", ".join(["x array<double>", *(f"{n} {t}" for n, t in others.items())]))


def _scores(model: Discriminant, part: pa.RecordBatch) -> np.ndarray:
    return np.round(model.score(np.array([statistics(t) for t in utf8(part, "text")])), 9)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; texts are judged in place, by the model fitted on docs and labels."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(iter([batch]), "text"):
                score = _scores(sent.value, part)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return table.transform(arrow, run, "doc_id long, held_out boolean, score double, predicted int")


def keep_accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that the model fitted on them doesn't reject, null and empty texts by their score as others."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(iter([batch]), "text"):
                yield part.filter(pa.array(_scores(sent.value, part) >= THRESHOLD))

    return docs.transform(arrow, run, docs.schema)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
