"""Document trees as Markdown: one nested expression, no UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as tx


def lines_if(value: Column, *made: Column) -> Column:
    """The lines, each followed by an empty one, where the value is neither null nor empty."""
    rows = F.flatten(F.array(*[F.array(x, F.lit("")) for x in made]))
    return F.when(value.isNotNull() & (value != ""), rows).otherwise(F.array().cast("array<string>"))


def segment_lines(s: Column) -> Column:
    qa = F.flatten(F.transform(F.coalesce(s["faqs"]["QAs"], F.array().cast("array<struct<question:string,answer:string>>")), lambda q: F.array(F.concat(F.lit("**"), F.coalesce(q["question"], F.lit("")), F.lit("**")), F.lit(""), F.coalesce(q["answer"], F.lit("")), F.lit(""))))
    return F.concat(lines_if(s["subheading"], F.concat(F.lit("### "), tx.strip_hashes(s["subheading"]))), lines_if(s["text"], s["text"]), lines_if(s["files"], s["files"]), qa, lines_if(s["contacts"], s["contacts"]))


def block_lines(b: Column) -> Column:
    head = F.array(F.concat(F.lit("## "), tx.strip_hashes(b["heading"])), F.lit(""))
    return F.concat(head, F.flatten(F.transform(F.coalesce(b["segments"], F.array().cast(b_segments())), segment_lines)))


def b_segments() -> str:
    from docloom.schema import SEGMENT

    return f"array<{SEGMENT}>"


def page_lines(p: Column) -> Column:
    from docloom.schema import BLOCK

    url = F.array(F.concat(F.lit("*URL: "), F.coalesce(p["url"], F.lit("")), F.lit("*")), F.lit(""))
    blocks = F.flatten(F.transform(F.coalesce(p["blocks"], F.array().cast(f"array<{BLOCK}>")), block_lines))
    return F.concat(lines_if(p["title"], F.concat(F.lit("# "), p["title"])), url, blocks, F.array(F.lit("---"), F.lit("")))


def markdown(pages: Column) -> Column:
    """The Markdown of an array of pages; no pages give the empty text."""
    return F.coalesce(F.array_join(F.flatten(F.transform(pages, page_lines)), "\n"), F.lit(""))


def render(trees: DataFrame, pages: str = "pages") -> DataFrame:
    return trees.withColumn("md", markdown(F.col(pages)))
