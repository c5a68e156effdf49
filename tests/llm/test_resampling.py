"""Importance resampling against dictionaries and plain sorting."""

import hashlib
import math
import re
import zlib
from collections import Counter
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from docloom.llm.common import BATCH_BYTES, small_batches
from docloom.llm.queries import op12_importance_resampling
from docloom.llm.resampling import BLOCK_ROWS, GROUP_BLOCKS, column_sums, count_matrix, importance_resampling, packed, unpacked

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def hashed(text, ngrams, buckets):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i : i + n]) for n in range(1, ngrams + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]


def brute(docs, target, percent=10, min_words=20, ngrams=1, buckets=10_000, seed="2024"):
    rows = [(d, *hashed(t, ngrams, buckets)) for d, t in docs]
    s, t = Counter(b for r in rows for b in r[2]), Counter(b for x in target for b in hashed(x, ngrams, buckets)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    out, scores = [], []
    for k, (d, n, found) in enumerate(rows):
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in found)
        score = None
        if d is not None:
            h = int(hashlib.sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n >= min_words:
                scores.append((-score, d, k))
        out.append([d, len(found), weight, score, None])
    for rank, (_, _, k) in enumerate(sorted(scores)[: percent * len(scores) // 100], 1):
        out[k][4] = rank
    return sorted(map(tuple, out), key=str)


def test_whole_table_against_brute_force(spark):
    docs, target = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "benchmark"))
    found = sorted(map(tuple, op12_importance_resampling(spark, str(DATA)).collect()), key=str)
    assert found == brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [r["text"] for r in target.collect()])
    assert sum(r[4] is not None for r in found) > 10


def test_ngrams_few_buckets_and_other_parameters(spark):
    rows = [(i, " ".join(f"w{(i * j) % 7}ä" for j in range(i % 9))) for i in range(60)]
    target = ["w1ä w2ä w3ä", None, "", "W1Ä"]
    options = {"ngrams": 3, "buckets": 13, "percent": 50, "min_words": 3, "seed": "x"}
    found = importance_resampling(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(t,) for t in target], "text string"), **options)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, target, **options)


def test_ties_repeats_nulls_and_clashing_columns(spark):
    same = "one two three"
    rows = [(4, same), (4, same), (2, same), (None, same), (9, None), (8, ""), (7, "one"), (6, same.upper())]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, rank int, score string").repartition(3)
    options = {"percent": 100, "min_words": 1}
    found = importance_resampling(docs, spark.createDataFrame([("one",)], "text string"), **options)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, ["one"], **options)


def test_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a b")], SCHEMA), spark.createDataFrame([], SCHEMA)
    assert importance_resampling(none, docs).count() == 0
    assert [tuple(r) for r in importance_resampling(docs, none, percent=100, min_words=1).collect()] == brute([(1, "a b")], [], percent=100, min_words=1)


def test_matrix_is_written_and_adds_up(spark):
    text = " ".join(f"t{i % 40000}" for i in range(120_000))
    docs = spark.createDataFrame([(1, text), (2, "t1 t1"), (3, None)], SCHEMA)
    matrix = count_matrix(docs)
    assert matrix.docloom_path
    assert int(column_sums(matrix, 10_000).sum()) == 120_002
    assert matrix.select(F.sum(F.size("doc_ids"))).first()[0] == 3
    row = matrix.select(F.explode(F.arrays_zip("doc_ids", "n_features"))).select("col.*").where("doc_ids = 2").first()
    assert row["n_features"] == 2


def test_readers_hold_few_blocks_at_once(spark):
    """One task's matrix may have any number of blocks; Spark's reader holds a row group of them at a time."""
    docs = spark.range(0, 9 * BLOCK_ROWS + 1, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("a a b"), F.col("id")).alias("text"))
    matrix = count_matrix(docs)
    assert matrix.count() == 10
    files = [pq.ParquetFile(p).metadata for p in Path(urlparse(matrix.docloom_path).path).glob("*.parquet")]
    groups = [m.row_group(k).num_rows for m in files for k in range(m.num_row_groups)]
    assert sum(groups) == 10 and max(groups) <= GROUP_BLOCKS
    sums = column_sums(matrix, 10_000)
    assert int(sums.sum()) == 3 * (9 * BLOCK_ROWS + 1) and int(sums[zlib.crc32(b"a") % 10_000]) >= 2 * (9 * BLOCK_ROWS + 1)


def test_packed_numbers_come_back():
    for values in ([], [0], [0, 255], [256, 1], [65_535], [65_536, 3], [2**32 - 1, 0]):
        data = packed(np.array(values, np.int64))
        assert unpacked(pa.scalar(data, pa.binary()), len(values)).tolist() == values
    assert len(packed(np.array([9_999, 1]))) == 4 and len(packed(np.array([7, 1]))) == 2


def test_workers_get_small_batches_meanwhile(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    def most():
        rows = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000))
        return rows.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]

    limit = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    with small_batches(spark):
        with small_batches(spark):
            pass
        assert most() < BATCH_BYTES + 20_000
    assert most() > 2 * BATCH_BYTES
    with pytest.raises(KeyError), small_batches(spark):
        raise KeyError
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == limit
