"""Chunk sizes of documents from the lengths of their sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as tx

SMALLEST, LARGEST, STEP, OVERLAP_SMALLEST, OVERLAP_LARGEST, OVERLAP_STEP = 800, 2000, 100, 50, 200, 50


def opens_unit(line: Column) -> Column:
    return F.rlike(line, F.lit(r"(?U)^#{1,6}\s")) | F.rlike(tx.strip(line), F.lit(r"^\*\*.+\*\*$"))


def section_lengths(docs: DataFrame, key: str, md: str) -> DataFrame:
    """(key, unit, length): units begin at headings and wholly bold lines; blank units are left out."""
    rows = docs.select(key, F.posexplode(tx.lines(F.col(md))).alias("n", "line"))
    order = Window.partitionBy(key).orderBy("n")
    rows = rows.withColumn("unit", F.sum(opens_unit(F.col("line")).cast("int")).over(order))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n")
    units = rows.groupBy(key, "unit").agg(text.alias("text")).where(tx.strip(F.col("text")) != "")
    return units.select(key, "unit", F.length("text").alias("length"))


def p95(lengths: Column) -> Column:
    """The value at place min(n - 1, floor(0.95 n)) of the sorted lengths."""
    return F.element_at(F.sort_array(lengths), F.least(F.size(lengths) - 1, F.floor(F.size(lengths) * F.lit(0.95)).cast("int")) + 1)


def p95_of_counts(counted: DataFrame, keys: list[str], value: str, n: str, into: str) -> DataFrame:
    """(keys, into): p95 of values given with how often each occurs; a running sum finds the place."""
    order = Window.partitionBy(*keys).orderBy(value)
    placed = counted.withColumns({"_until": F.sum(n).over(order), "_all": F.sum(n).over(Window.partitionBy(*keys))})
    place = F.least(F.col("_all") - 1, F.floor(F.col("_all") * F.lit(0.95)))
    return placed.where(F.col("_until") > place).groupBy(*keys).agg(F.min(value).alias(into))


def params(long: Column) -> Column:
    """Sizes for a 95th percentile: rounded half to even, kept within bounds; 0 means unknown."""
    rounded = F.bround(F.coalesce(long, F.lit(0)) / STEP) * STEP
    most = F.greatest(F.least(F.when(rounded == 0, F.lit(SMALLEST)).otherwise(rounded), F.lit(LARGEST)), F.lit(SMALLEST)).cast("int")
    overlap = F.greatest(F.least(F.bround(most * 0.1 / OVERLAP_STEP) * OVERLAP_STEP, F.lit(OVERLAP_LARGEST)), F.lit(OVERLAP_SMALLEST)).cast("int")
    return F.struct(most.alias("max_characters"), most.alias("new_after_n_chars"), overlap.alias("overlap"))


def chunk_params(docs: DataFrame, key: str, md: str) -> DataFrame:
    """(key, chunk_params) of every document; without units its whole length counts."""
    found = section_lengths(docs, key, md).groupBy(key).agg(p95(F.collect_list("length")).alias("long"))
    whole = docs.select(key, F.length(md).alias("whole"))
    return whole.join(found, key, "left").select(key, params(F.coalesce("long", "whole")).alias("chunk_params"))
