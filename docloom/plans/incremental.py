"""Enriching again only what has changed.

A table of pages holds, for each page of each topic, a hash of what went in (the captured page and the fetched HTML) and
what came out. A page whose hash is there already is taken over; only the others are parsed and merged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from docloom.operators import placement
from docloom.plans.topics import KEYS, enriched_pages, held_pages, whole_topics
from docloom.schema import PAGE
from docloom.sinks.files import exists

FAILURE = "struct<url:string,stage:string,error:string>"
PAGES = f"topic string, page_ord int, came string, page {PAGE}, failure {FAILURE}"


def came(page: Column, html: Column) -> Column:
    """A hash of what a page is made of. Nulls are told apart from empty texts."""
    told = F.to_json(F.struct(page.alias("page"), html.alias("html")), {"ignoreNullFields": "false"})
    return F.sha2(told, 256)


def last_pages(trees: DataFrame, path: str | None) -> DataFrame:
    spark = trees.sparkSession
    if path is None or not exists(spark, path):
        return spark.createDataFrame([], PAGES)
    return spark.read.schema(PAGES).parquet(path)


def enrich_changed(trees: DataFrame, fetched: DataFrame, old: str | None, new: str, place: Callable = placement.place) -> tuple[DataFrame, dict[str, int]]:
    """(enriched trees, numbers of pages that were made and taken over); the table for the next run is written at new.

    old: the table of the last run, or None. A page that broke last time is tried again. Pages that are no longer in the
    trees leave the table. The trees are those of topics.enrich.
    """
    held = held_pages(trees, fetched).withColumn("came", came(F.col("page"), F.col("html")))
    known = last_pages(trees, old).where("failure is null").select(*KEYS, "came", F.col("page").alias("made"))
    asked = held.join(known, [*KEYS, "came"], "left")
    hashes = held.select(*KEYS, "came")
    kept = asked.where("made is not null").select(*KEYS, "came", F.col("made").alias("page"), F.lit(None).cast(FAILURE).alias("failure"))
    changed = held.join(known.select(*KEYS, "came"), [*KEYS, "came"], "left_anti")
    # the parser is given the changed pages only
    counted, taken = Observation(), Observation()
    made = enriched_pages(changed.select(*KEYS, "page", "url", "html").observe(counted, F.count("*").alias("n"), F.count("html").alias("parsed")), place)
    made = made.join(hashes, KEYS).select(*KEYS, "came", "page", "failure")
    made.unionByName(kept.observe(taken, F.count("*").alias("n"))).write.mode("overwrite").parquet(new)
    pages = trees.sparkSession.read.schema(PAGES).parquet(new)
    return whole_topics(trees, pages), {"made": counted.get["n"] or 0, "parsed": counted.get["parsed"] or 0, "kept": taken.get["n"] or 0}
