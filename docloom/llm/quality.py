"""Quality of texts by a linear classifier over naive Bayes features.

A text is the set of its n-grams: of one to four bytes, and of words that repeat (whether each of up to six words in
a row equals the one before it, or the one before that), hashed to a fixed number of buckets. An n-gram's indicator is
scaled by the log of the ratio of its shares in both classes, and a linear model with hinge loss is fitted to the
scaled, length-normalised vectors by dual coordinate descent. A logistic curve of the margin, fitted on texts that
neither has seen, gives the probability.

The classifier is fitted on a bounded sample of labelled rows; each text is scored whole and alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import begin, materialize, worker_cache
from docloom.llm.toxicity import held_out, logistic

#: Labelled rows of each class that the classifier may learn from; every fourth text is held back for the curve.
SAMPLE_PER_CLASS = 2000
BYTE_GRAMS, BITS = 4, 18
#: Repetition n-grams: distances, the most words in a row, and the buckets behind those of the byte n-grams.
GAPS, IN_A_ROW = (1, 2), 6
WIDTH = (1 << BITS) + len(GAPS) * (2 << IN_A_ROW)
#: An n-gram counts if so many texts of the sample hold it; added to each count; the bound of a dual variable.
LEAST, ADDED, COST = 3, 1.0, 1.0
EPOCHS, ENOUGH = 50, 1e-2
U = np.uint32


class Indicators:
    """The buckets that a text's n-grams fall into."""

    def __init__(self) -> None:
        self.met = np.zeros(WIDTH, bool)

    def of(self, text: bytes) -> np.ndarray:
        """Sorted and distinct."""
        b = np.frombuffer(b" " + text + b" ", np.uint8).astype(U)
        code = np.zeros(len(b), U)
        for n in range(1, min(BYTE_GRAMS, len(b)) + 1):
            code = (code[: len(b) - n + 1] << U(8)) | b[n - 1 :]
            x = code * U(0x9E3779B1) + U(n * 0x85EBCA77 & 0xFFFFFFFF)
            x ^= x >> U(15)
            x *= U(0x2C1B3C6D)
            self.met[x >> U(32 - BITS)] = True
        words = text.split()
        for k, gap in enumerate(GAPS):
            same = np.fromiter(map(bytes.__eq__, words, words[gap:]), bool, max(0, len(words) - gap))
            row = np.zeros(len(same), np.int64)
            for n in range(1, min(IN_A_ROW, len(same)) + 1):
                row = row[: len(same) - n + 1] * 2 + same[n - 1 :]
                self.met[(1 << BITS) + k * (2 << IN_A_ROW) + (1 << n) + row] = True
        found = np.flatnonzero(self.met).astype(np.int32)
        self.met[found] = False
        return found


@dataclass
class Model:
    """gain: each bucket's log-count ratio times its weight. Its size is fixed."""

    gain: np.ndarray
    bias: float
    slope: float = 0.0
    offset: float = 0.0

    def margin(self, buckets: np.ndarray) -> float:
        return float(self.gain[buckets].sum()) / np.sqrt(max(1, len(buckets))) + self.bias

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -500, 500)))


def log_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Of each bucket's shares among the rows of both classes; 0 for buckets that few rows hold."""
    p, q = np.full(WIDTH, ADDED), np.full(WIDTH, ADDED)
    for row, sign in zip(rows, y, strict=True):
        (p if sign > 0 else q)[row] += 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    ratio[p + q < 2 * ADDED + LEAST] = 0
    return ratio


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, width: int, cost: float = COST, epochs: int = EPOCHS, enough: float = ENOUGH) -> tuple[np.ndarray, float, np.ndarray]:
    """(w, bias, a) that minimise (|w|^2 + bias^2) / 2 + cost * sum(max(0, 1 - y * (w x + bias))), by dual coordinates.

    The dual variables a lie between 0 and cost, and w is the sum of a * y * x. Ends when no projected gradient of a
    pass exceeds enough.
    """
    w, bias, a = np.zeros(width), 0.0, np.zeros(len(rows))
    size = np.array([v @ v + 1 for v in values])
    order = np.random.default_rng(0)
    for _ in range(epochs):
        most = 0.0
        for i in order.permutation(len(rows)).tolist():
            g = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            projected = min(g, 0.0) if a[i] == 0 else max(g, 0.0) if a[i] == cost else g
            most = max(most, abs(projected))
            if projected:
                new = min(max(a[i] - g / size[i], 0.0), cost)
                step = (new - a[i]) * y[i]
                a[i] = new
                w[rows[i]] += step * values[i]
                bias += step
        if most < enough:
            break
    return w, bias, a


def training_sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(quality, tune, buckets) of at most limit distinct labelled texts a class, never held-out ones; a text with both labels counts as bad."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)")
    rows = rows.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = F.xxhash64("doc_id")
    some = rows.where("quality = 1").orderBy(order, "doc_id").limit(limit).union(rows.where("quality = 0").orderBy(order, "doc_id").limit(limit))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(some), "doc_id")
    texts = texts.groupBy("text").agg(F.min("quality").alias("quality")).select(F.col("text").cast("binary"), "quality", (F.pmod(F.xxhash64("text"), F.lit(4)) == 0).alias("tune"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = worker_cache("quality", "indicators", Indicators)
        for batch in batches:
            found = [made.of(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.int32()))], names=["quality", "tune", "buckets"])

    return materialize(texts.mapInArrow(run, "quality int, tune boolean, buckets array<int>"), "quality_sample")


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on labelled rows of docs. Without texts of both classes every probability is 0.5."""
    sample = training_sample(docs, labels, limit).orderBy("quality", F.xxhash64("buckets")).toPandas()
    fit = sample[~sample["tune"]]
    rows, y = list(fit["buckets"]), fit["quality"].to_numpy() * 2.0 - 1
    if len(set(y)) < 2:
        return Model(np.zeros(WIDTH), 0.0)
    ratio = log_ratios(rows, y)
    w, bias, _ = dual_descent(rows, [ratio[r] / np.sqrt(max(1, len(r))) for r in rows], y, WIDTH)
    model = Model(ratio * w, bias, 1.0)
    tune = sample[sample["tune"]]
    truth = tune["quality"].to_numpy(float)
    if len(set(truth)) == 2:
        model.slope, model.offset = logistic(np.array([[model.margin(r)] for r in tune["buckets"]]), truth).tolist()
    return model


def score(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score) of each row of docs; score is the probability of good quality.

    Null texts score like empty ones, by the n-grams of two blanks. Labels that are null or of no row of docs are not
    used; a null doc_id is not held out; repeated rows give repeated rows; an empty table gives none; other columns
    are not looked at.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(train(docs, labels, limit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("quality")
        made, model = worker_cache("quality", "indicators", Indicators), shipped.value
        for batch in batches:
            margins = np.array([model.margin(made.of(t.as_buffer().to_pybytes() if t.is_valid and len(t.as_buffer()) else b"")) for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.probability(margins), pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary"))
    out = rows.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score")
