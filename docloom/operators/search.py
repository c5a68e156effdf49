"""A gram index for keyword search: rows of (gram, key), and the candidates of a keyword.

Every three characters of a text's lower-case form are a gram. A row can hold a keyword only if it has all grams of it,
so the index is read for these grams alone, keys are counted, and only the rows that are left are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 3
#: Folders that grams are dealt into, so that a search reads only those of its grams.
FOLDERS = 64
POSTINGS = "gram string, key long, bucket int"


def folded(text: str) -> str:
    """Lower case, character by character, with one sigma: what is equal in any case of letters is equal here."""
    return "".join(c.lower() for c in text).replace("ς", "σ")


def grams_of(text: str) -> set[str]:
    low = folded(text)
    return {low[k : k + GRAM] for k in range(len(low) - GRAM + 1)}


def bucket_of(gram: str) -> int:
    return sum(ord(c) * 31**k for k, c in enumerate(gram)) % FOLDERS


def postings(table: DataFrame, key: str, *texts: str) -> DataFrame:
    """(gram, key, bucket): each gram of each row once. Rows of a hot gram are rows, never one list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, keys = [], []
            for row in range(batch.num_rows):
                found = set().union(*(grams_of(batch.column(k)[row].as_py() or "") for k in range(1, batch.num_columns)))
                grams += found
                keys += [batch.column(0)[row].as_py()] * len(found)
                if len(grams) > 1 << 18 or row + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(keys, pa.int64()), pa.array([bucket_of(g) for g in grams], pa.int32())], names=["gram", "key", "bucket"])
                    grams, keys = [], []

    return table.select(F.col(key).cast("long"), *texts).mapInArrow(run, POSTINGS)


def candidates(table: DataFrame, index: DataFrame, key: str, keyword: str) -> DataFrame:
    """The rows of table that have all grams of the keyword; all rows for one that is shorter than a gram.

    They still have to be looked at: grams may stand apart from each other.
    """
    grams = sorted(grams_of(keyword))
    if not grams:
        return table
    some = index.where(F.col("bucket").isin(sorted({bucket_of(g) for g in grams})) & F.col("gram").isin(grams))
    hits = some.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") == len(grams)).select("key")
    return table.join(hits, table[key] == hits["key"], "left_semi")
