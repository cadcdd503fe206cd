"""Toxicity: a linear classifier over character n-grams, each scaled by its
naive Bayes log-count ratio.

The classifier is fitted on a bounded sample of labelled rows: the
``FIT_ROWS`` labels outside the held-out fold whose ``doc_id`` has the least
hash. That many ids at most are broadcast to the documents, and only their texts
are shuffled, one kept for each, however many documents and labels there are.

A feature is the presence, somewhere in the lower-cased text, of an n-gram's
hash bucket, of which there are ``BUCKETS``. The log-count ratios come from the
sample's document counts, summed up in Spark. Buckets whose counts differ
between the classes by less than ``MIN_Z`` standard errors are noise and left
out, which matters for long texts that hold nearly every common n-gram. Ridge
logistic regression over the scaled features then takes each row as its list of
remaining buckets, in blocks of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import python_ready, written

ORDERS = (3, 4, 5)
BITS = 18
BUCKETS = 1 << BITS
SMOOTHING = 1.0
MIN_Z = 5.0
FIT_ROWS = 20_000
RIDGE = 1e-3
ROUNDS = 300
THRESHOLD = 0.3
HELD_OUT = 2  # remainder, modulo 4, of the CRC-32 of doc_id as text

_CHUNK = 1 << 20
_ENTRIES = 1 << 17  # whose values are held at a time in a gradient step, or a run's


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == HELD_OUT


def ngram_buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a text, repeats included, in bounded arrays."""
    padded = f" {text.lower()} "
    for at in range(0, len(padded), _CHUNK):
        points = np.frombuffer(padded[at : at + _CHUNK + max(ORDERS) - 1].encode("utf-32-le"), np.uint32).astype(np.uint64)
        for n in ORDERS:
            count = min(len(points) - n + 1, _CHUNK)
            if count <= 0:
                continue
            h = points[:count] + np.uint64(n)
            for k in range(1, n):
                h = h * np.uint64(0x100000001B3) + points[k : k + count]
            yield ((h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)


class Presence:
    """The distinct buckets of a text, by marks in a table that is used again."""

    def __init__(self) -> None:
        self.marks = np.zeros(BUCKETS, dtype=bool)

    def of(self, text: str, wanted: np.ndarray | None = None) -> np.ndarray:
        """Sorted distinct buckets; those that the mask ``wanted`` has, if given."""
        for buckets in ngram_buckets(text):
            self.marks[buckets if wanted is None else buckets[wanted[buckets]]] = True
        found = np.flatnonzero(self.marks)
        self.marks[found] = False
        return found


def document_counts(train: DataFrame) -> DataFrame:
    """``bucket, toxic, clean``: in how many training rows of each class it is present."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence, counts = Presence(), np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[toxic][presence.of(text or "")] += 1
        some = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[1][some]), pa.array(counts[0][some])], ["bucket", "toxic", "clean"])

    parts = python_ready(train).select("text", "toxic").mapInArrow(run, "bucket long, toxic long, clean long")
    return parts.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def log_count_ratios(counts: DataFrame, toxic: int, clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that tell the classes apart, and their log-count ratios."""
    p, q = F.col("toxic") / F.lit(float(toxic)), F.col("clean") / F.lit(float(clean))
    both = (F.col("toxic") + F.col("clean")) / F.lit(float(toxic + clean))
    z = (p - q) / F.sqrt(F.greatest(both * (1 - both), F.lit(1e-12)) * F.lit(1 / toxic + 1 / clean))
    share = lambda n, of: (F.col(n) + F.lit(SMOOTHING)) / F.lit(of + 2 * SMOOTHING)
    ratio = F.log(share("toxic", toxic) / share("clean", clean))
    clear = counts.select("bucket", F.abs(z).alias("z"), ratio.alias("ratio")).where(F.col("z") >= MIN_Z)
    rows = sorted((r["bucket"], r["ratio"]) for r in clear.collect())  # BUCKETS at most
    return np.array([b for b, _ in rows], dtype=np.int64), np.array([r for _, r in rows])


def feature_lists(train: DataFrame, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels of the training rows, lengths of their feature lists, and the
    features one list after another, as positions in ``buckets``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence, wanted = Presence(), np.zeros(BUCKETS, dtype=bool)
        wanted[buckets] = True
        for batch in batches:
            found = [np.searchsorted(buckets, presence.of(t or "", wanted)).astype("<i4").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary())], ["toxic", "features"])

    found = python_ready(train).select("text", "toxic").mapInArrow(run, "toxic int, features binary").toArrow().sort_by([("toxic", "ascending"), ("features", "ascending")])
    lists = found.column("features").to_pylist()
    return found.column("toxic").to_numpy(), np.array([len(f) // 4 for f in lists], dtype=np.int64), np.frombuffer(b"".join(lists), "<i4")


class _Runs:
    """Runs of places in an array of values, whose values are summed up run by run."""

    def __init__(self, places: np.ndarray, lengths: np.ndarray) -> None:
        self.size, self.full = len(lengths), np.flatnonzero(lengths)
        starts = (np.cumsum(lengths) - lengths)[self.full]
        cuts = np.searchsorted(starts, np.arange(0, len(places), _ENTRIES)).tolist() + [len(starts)]
        ends = np.append(starts, len(places))
        self.blocks = [(a, b, places[ends[a] : ends[b]], starts[a:b] - starts[a]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]

    def sums(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size)
        for a, b, places, starts in self.blocks:
            out[self.full[a:b]] = np.add.reduceat(values[places], starts)
        return out


def fit(labels: np.ndarray, lengths: np.ndarray, columns: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression over the scaled presence features, by
    adaptive gradient steps: weight of each feature (scale included), bias."""
    n, k = len(labels), len(ratios)
    by_row = _Runs(columns, lengths)
    rows = np.repeat(np.arange(n, dtype=np.int32), lengths)[np.argsort(columns, kind="stable")]
    by_column = _Runs(rows, np.bincount(columns, minlength=k))
    weights, bias = np.zeros(k), float(np.log((labels.sum() + 1) / (n - labels.sum() + 1)))
    first, second, first_b, second_b = np.zeros(k), np.zeros(k), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        margin = by_row.sums(weights * ratios) + bias
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels
        gradient = by_column.sums(error) * ratios / n + RIDGE * weights
        gradient_b = float(error.mean())
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        first_b, second_b = 0.9 * first_b + 0.1 * gradient_b, 0.999 * second_b + 0.001 * gradient_b**2
        rate = 0.05 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        weights = weights - rate * first / (np.sqrt(second) + 1e-8)
        bias -= float(rate * first_b / (np.sqrt(second_b) + 1e-8))
    return weights * ratios, bias


def training_rows(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """``text, toxic`` of the labelled rows to fit on, ``fit_rows`` at most. Null
    labels do not count; of several labels of a document the highest does, of
    several texts the greatest."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sample = marked.orderBy(F.xxhash64(F.lit("fit"), "doc_id"), "doc_id").limit(fit_rows)
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    return found.groupBy("doc_id").agg(F.max("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Buckets, their weights and the bias. Without rows of both classes no
    bucket is used and the bias is the smoothed log-odds of the labels."""
    rows = written(training_rows(docs, labels, fit_rows), "toxicity-train")
    sums = rows.agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = sums["toxic"] or 0, sums["n"] - (sums["toxic"] or 0)
    nothing = np.zeros(0)
    if not toxic or not clean:
        return nothing.astype(np.int64), nothing, float(np.log((toxic + 1) / (clean + 1)))
    buckets, ratios = log_count_ratios(document_counts(rows), toxic, clean)
    weights, bias = fit(*feature_lists(rows, buckets), ratios)
    return buckets, weights, bias


def score_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs`` (columns
    ``doc_id`` and ``text``; others are not read).

    The score is a function of the text alone. Null and empty texts have no
    n-gram but that of the padding and score near the bias; repeated rows score
    alike; a null ``doc_id`` counts as an empty one for the fold; an empty
    table gives an empty result. The model (``BUCKETS`` weights at most) goes to
    the tasks with their code.
    """
    buckets, weights, bias = train(docs, labels, fit_rows)
    fields = [docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence, wanted, weight = Presence(), np.zeros(BUCKETS, dtype=bool), np.zeros(BUCKETS)
        wanted[buckets], weight[buckets] = True, weights
        for batch in batches:
            margins = np.array([bias + weight[presence.of(t or "", wanted)].sum() for t in batch.column(2).to_pylist()])
            scores = 1 / (1 + np.exp(-np.clip(margins, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    rows = python_ready(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = rows.mapInArrow(run, T.StructType(fields))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
