"""The batch plan: captured trees and fetched pages to enriched trees, Markdown, metrics and an upload plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom import schema
from docloom.functions import prompts
from docloom.functions import text as tx
from docloom.operators import extract, match, merge, placement, render
from docloom.sources.dom import node_table

KEYS = ["topic", "page_ord"]


def enrich(trees: DataFrame, fetched: DataFrame, place: Callable = placement.place, partitions: int | None = None) -> DataFrame:
    """trees (topic, base_url, pages) with what fetched (url, html) shows merged in, and errors.

    A page is known by topic and position, never by url: several topics may hold one url, and each page is enriched on its
    own. Pages without url, and pages not fetched, stay untouched. Topics without pages stay. A page that breaks while
    it is parsed or merged stays as it was and has a row in errors; it stops nothing. partitions: as in all_extracts.
    """
    return whole_topics(trees, enriched_pages(held_pages(trees, fetched), place, partitions))


def held_pages(trees: DataFrame, fetched: DataFrame) -> DataFrame:
    """(topic, page_ord, page, url, html): the pages of trees, with what was fetched of them."""
    pages = trees.select("topic", F.posexplode("pages").alias("page_ord", "page"))
    # of a page that was fetched several times the newest counts, where that is known, and else always the same one
    newest = F.max_by("html", "fetched_at") if "fetched_at" in fetched.columns else F.min("html")
    html = fetched.where("url is not null and html is not null").groupBy("url").agg(newest.alias("html"))
    return pages.withColumn("url", F.when(F.col("page.url") != "", F.col("page.url"))).join(html, "url", "left").select(*KEYS, "page", "url", "html")


def enriched_pages(held: DataFrame, place: Callable = placement.place, partitions: int | None = None) -> DataFrame:
    """(topic, page_ord, page, failure) of held pages: each page enriched, or as it was with (url, stage, error)."""
    extracts = extract.all_extracts(node_table(held.where("html is not null"), "html", *KEYS), KEYS, partitions)
    # a fetched page without any node still counts as fetched
    empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in extracts.schema["extracts"].dataType.fields])
    joined = held.join(extracts, KEYS, "left").withColumn("extracts", F.when(F.col("html").isNotNull(), F.coalesce("extracts", empty)))
    broken = F.col("extracts.error")
    joined = joined.withColumn("_broken", broken).withColumn("extracts", F.when(broken.isNull(), F.col("extracts")))
    merged = merge.merge(joined, place=place)
    stage = F.when(F.col("_broken").isNotNull(), "parse").otherwise("merge")
    error = F.coalesce("_broken", "error")
    failure = F.when(error.isNotNull(), F.struct("url", stage.alias("stage"), error.alias("error")))
    return merged.select(*KEYS, "page", failure.alias("failure"))


def whole_topics(trees: DataFrame, pages: DataFrame) -> DataFrame:
    """(topic, base_url, pages, errors): trees with their pages put back in order."""
    told = F.when(F.col("failure").isNotNull(), F.struct("page_ord", "failure.url", "failure.stage", "failure.error"))
    found = pages.groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("page_ord", "page"))).alias("found"), F.array_sort(F.collect_list(told)).alias("errors"))
    errors = F.coalesce("errors", F.array().cast(schema.ERRORS)).alias("errors")
    return trees.join(found, "topic", "left").select("topic", "base_url", F.when(F.col("found").isNotNull(), F.col("found.page")).otherwise(F.col("pages")).alias("pages"), errors)


def quarantine(enriched: DataFrame) -> DataFrame:
    """(topic, page_ord, url, stage, error): the pages that could not be enriched."""
    return enriched.select("topic", F.inline("errors"))


def capture_tasks(topics: DataFrame, root_url: str, fetch: Callable) -> DataFrame:
    """topics (name, path, url, subtopics, instructions, ord) with subpages (label and url, in label order) and the capture task.

    The labels of sub-pages are looked up on the topic's own page before anything is captured, so an agent is given
    addresses and follows no guess. fetch(spark, urls) gives (url, html); a page that cannot be fetched, and a label
    without a link, give no sub-page.
    """
    absolute = F.when(F.rlike("url", F.lit("^https?://")), F.col("url")).otherwise(match.join_url(F.lit(root_url), F.col("url")))
    asked = topics.where(F.size("subtopics") > 0).select("name", absolute.alias("page"), F.posexplode("subtopics").alias("label_pos", "label"))
    pages = fetch(topics.sparkSession, asked.select(F.col("page").alias("url")).distinct())
    links = extract.links(node_table(pages.withColumnRenamed("url", "page"), "html", "page"), ["page"])
    labels = asked.select("page", "label_pos", "label", F.col("page").alias("base_url")).distinct()
    found = match.resolve_labels(labels, links, ["page"])
    subpages = asked.join(found, ["page", "label_pos", "label"]).groupBy("name").agg(F.array_sort(F.collect_list(F.struct("label_pos", "label", "url"))).alias("s"))
    subpages = subpages.select("name", F.transform("s", lambda x: F.struct(x["label"].alias("label"), x["url"].alias("url"))).alias("subpages"))
    joined = topics.join(subpages, "name", "left").withColumn("subpages", F.coalesce("subpages", F.array().cast("array<struct<label:string,url:string>>")))
    return joined.withColumn("task", prompts.task(prompts.navigation(F.col("url"), F.col("path"), root_url), F.col("instructions"), F.col("subpages")))


def page_trees(pages: DataFrame) -> DataFrame:
    """(page_id, pages): trees of raw pages without a capture: title, link list and body text."""
    nodes = node_table(pages, "html", "page_id", "url", every_page=True)
    text = tx.norm(F.col("text"))
    listed = lambda when, *values: F.array_sort(F.collect_list(F.when(when, F.struct("pos", *values))))
    found = nodes.groupBy("page_id", "url").agg(
        extract.title_of(F.col("text"), F.col("kind"), F.col("tag"), F.col("pos")).alias("title"),
        listed((F.col("kind") == "link") & (text != ""), text.alias("text"), "href").alias("links"),
        listed((F.col("kind") == "string") & ~F.col("hidden"), "text").alias("body"),
    )
    link_list = F.array_join(F.transform("links", lambda x: F.concat(F.lit("- ["), x["text"], F.lit("]("), x["href"], F.lit(")"))), "\n")
    null = F.lit(None).cast("string")
    faqs = F.lit(None).cast("struct<title:string,QAs:array<struct<question:string,answer:string>>>")
    segment = lambda sub, text: F.struct(F.lit(sub).alias("subheading"), text.alias("text"), null.alias("files"), null.alias("contacts"), faqs.alias("faqs"))
    block = F.struct(F.col("title").alias("heading"), F.array(segment("Text", F.array_join(F.col("body.text"), "\n")), segment("Links", link_list)).alias("segments"))
    return found.select("page_id", F.array(F.struct("url", "title", F.array(block).alias("blocks"))).alias("pages"))


def page_markdown(pages: DataFrame) -> DataFrame:
    """(page_id, md)."""
    return render.render(page_trees(pages)).select("page_id", "md")
