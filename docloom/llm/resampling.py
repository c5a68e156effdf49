"""Importance resampling of documents towards a target by hashed n-gram features.

The document-by-bucket count matrix is written once to the shared folder, as blocks of compressed sparse rows. Both
later passes read only those blocks: column sums give the distributions of the documents and of the target, and a
sparse matrix-vector product with the buckets' gains gives each document's weight, which is written down too. A seeded
Gumbel variable for each document then makes the highest scores a sample without replacement.

Spark's reader holds a whole row group of blocks at once, as a block is one row, so few blocks make a row group, and
Python workers get small batches: what a task holds does not grow with its share of the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docloom.llm.common import begin, materialize, release, small_batches, worker_cache

BUCKETS, NGRAMS, PERCENT, MIN_WORDS, SEED = 10_000, 1, 10, 20, "2024"
#: Rows and entries of a block; a longer document is a block of its own.
BLOCK_ROWS, BLOCK_ENTRIES = 4096, 1 << 18
#: Blocks of a Parquet row group.
GROUP_BLOCKS = 4
#: Words whose bucket a Python worker keeps.
CACHE = 100_000
#: What stands between words becomes a blank, A-Z becomes a-z.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

BLOCK = "doc_ids array<long>, n_words array<long>, n_features array<long>, ends array<long>, columns binary, counts binary"


class Buckets(dict):
    """The bucket of each word, kept up to CACHE words."""

    def __init__(self, size: int):
        self.size = size

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        found = self[word] = zlib.crc32(word) % self.size
        return found


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def features(words: list[bytes], ngrams: int, of: Buckets) -> np.ndarray:
    """The bucket of each run of 1 to ngrams words."""
    out = [np.fromiter(map(of.__getitem__, words), np.int64, len(words))]
    sums = list(map(zlib.crc32, words)) if ngrams > 1 else []
    for n in range(2, min(ngrams, len(words)) + 1):
        sums = [zlib.crc32(b" " + words[k + n - 1], sums[k]) for k in range(len(words) - n + 1)]
        out.append(np.array(sums, np.int64) % of.size)
    return np.concatenate(out)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in as few bytes each as the largest one needs."""
    return values.astype(np.min_scalar_type(values.max(initial=0))).tobytes()


def unpacked(data: pa.BinaryScalar, n: int) -> np.ndarray:
    """The n numbers that packed() was given, read where they lie."""
    return np.frombuffer(data.as_buffer(), f"u{data.as_buffer().size // n}") if n else np.empty(0, np.uint8)


def count_matrix(docs: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> DataFrame:
    """Blocks of compressed sparse rows: the counts of each text's buckets, in the order of the rows.

    Row k of a block has the entries ends[k-1]:ends[k] of columns (sorted) and counts, both packed. A row without text
    has none.
    """

    def block(held: list[tuple[int | None, int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids, words, features, columns, counts = zip(*held, strict=True)
        ends = np.cumsum([len(c) for c in columns])
        row = [pa.array([list(ids)], pa.list_(pa.int64()))]
        for values in (words, features, ends):
            flat = pa.array(np.asarray(values, np.int64))
            row.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
        row += [pa.array([packed(np.concatenate(values))], pa.binary()) for values in (columns, counts)]
        return pa.RecordBatch.from_arrays(row, names=["doc_ids", "n_words", "n_features", "ends", "columns", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = worker_cache("resampling", buckets, lambda: Buckets(buckets))
        held, entries = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                buffer = text.as_buffer() if text.is_valid else None
                words = words_of(buffer.to_pybytes()) if buffer is not None else []
                found = features(words, ngrams, of)
                columns, counts = np.unique(found, return_counts=True)
                if held and (len(held) >= BLOCK_ROWS or entries + len(columns) > BLOCK_ENTRIES):
                    yield block(held)
                    held, entries = [], 0
                held.append((doc_id, len(words), len(found), columns.astype(np.int32), counts.astype(np.int32)))
                entries += len(columns)
            batch = text = buffer = None  # else it stays while the next one is read
        if held:
            yield block(held)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return materialize(rows.mapInArrow(run, BLOCK), "csr", **{"parquet.block.row.count.limit": GROUP_BLOCKS})


def column_sums(matrix: DataFrame, buckets: int) -> np.ndarray:
    """Counts of each bucket over all rows; one partial sum a task, so at most that many rows a task are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("resampling")
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for n, columns, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                np.add.at(sums, unpacked(columns, n), unpacked(counts, n))
            batch = columns = counts = None  # else it stays while the next one is read
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(sums[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in matrix.select(F.element_at("ends", -1).alias("n"), "columns", "counts").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much likelier each bucket is in the target, with one added to each count."""
    s, t, size = source.astype(float), target.astype(float), len(source)
    return np.floor(1000 * np.log((t + 1) * (source.sum() + size) / ((s + 1) * (target.sum() + size)))).astype(np.int64)


def weights(matrix: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the matrix times the gains."""
    shipped = matrix.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("resampling")
        for batch in batches:
            for row in range(batch.num_rows):
                ids, words, features, ends = (batch.column(k)[row].values for k in range(4))
                at = np.insert(ends.to_numpy(), 0, 0)
                columns, counts = (unpacked(batch.column(k)[row], at[-1]) for k in (4, 5))
                sums = np.insert(np.cumsum(shipped.value[columns] * counts), 0, 0)[at]
                yield pa.RecordBatch.from_arrays([ids, words, features, pa.array(np.diff(sums))], names=["doc_id", "n_words", "n_features", "weight"])
            batch = ids = words = features = ends = columns = counts = None  # else it stays while the next one is read

    return matrix.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: str) -> Column:
    """Thousandths of a Gumbel variable, rounded down, that the seed and the id fix."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, wanted: int) -> DataFrame:
    """rows with rank 1, 2, ... by score down, then doc_id up; null beyond the first wanted ones.

    Rows are dealt out by ranges of the order, numbered within each range, and the ranges' sizes are added up.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 1
        for batch in batches:
            yield batch.append_column("rank", pa.array(np.arange(at, at + batch.num_rows)))
            at += batch.num_rows

    order = [F.col("score").desc(), F.col("doc_id").asc()]
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    parts = materialize(parts.mapInArrow(number, StructType([*parts.schema.fields, StructField("rank", LongType())])), "ranked")
    before, offsets = 0, []
    for part, n in sorted(parts.groupBy("part").count().collect()):
        offsets.append((part, before))
        before += n
    spark = rows.sparkSession
    parts = parts.join(F.broadcast(spark.createDataFrame(offsets, "part int, before long")), "part")
    rank = F.col("rank") + F.col("before")
    return parts.select(*rows.columns, F.when(rank <= wanted, rank).alias("rank"))


def importance_resampling(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    ngrams: int = NGRAMS,
    buckets: int = BUCKETS,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each row of docs; rank tells the drawn ones.

    docs has doc_id and text, target has text. Words are runs of 0-9, a-z (A-Z count as these) and characters beyond
    ASCII; features are runs of 1 to ngrams words. Of the rows with an id and at least min_words words, percent in a
    hundred (rounded down) are drawn. A row without an id counts in the distribution, but has no score and is not
    drawn. Null and empty texts have weight 0 and are not drawn (unless min_words is 0); of repeated rows each stands
    for itself; an empty table gives none. Other columns are not looked at.
    """
    with small_batches(docs.sparkSession):
        matrix = count_matrix(docs, ngrams, buckets)
        aim = count_matrix(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), ngrams, buckets)
        gain = gains(column_sums(matrix, buckets), column_sums(aim, buckets))
        weighed = materialize(weights(matrix, gain), "weights")
    for done in (matrix, aim):
        release(done)
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    may = F.coalesce(F.col("doc_id").isNotNull() & (F.col("n_words") >= min_words), F.lit(False))
    rest = scored.where(~may).withColumn("rank", F.lit(None).cast("long"))
    some = scored.where(may)
    wanted = percent * some.count() // 100
    return ranked(some, wanted).unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
