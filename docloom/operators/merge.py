"""Merge of extracts into document trees.

Rewrites that look at one tree only are nested transforms. Placement reads what it wrote before - a group
may attach to a block that an earlier group added - so it is sequential within a page and runs as one Arrow
UDF over (page, extracts); pages are independent rows, so it scales with them and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import schema
from docloom.functions import text as tx
from docloom.functions.rows import by_row
from docloom.operators import placement

#: What is kept of an error's text.
ERROR_LIMIT = 500


# ---------------------------------------------------------------- native rewrites of one page


def map_blocks(page: Column, f) -> Column:  # noqa: ANN001
    return page.withField("blocks", F.transform(F.coalesce(page["blocks"], F.array().cast(f"array<{schema.BLOCK}>")), f))


def map_segments(page: Column, f) -> Column:  # noqa: ANN001
    return map_blocks(page, lambda b: b.withField("segments", F.transform(F.coalesce(b["segments"], F.array().cast(f"array<{schema.SEGMENT}>")), f)))


def strip_covered_questions(page: Column, questions: Column) -> Column:
    """Without question-answer pairs, lines and subheadings that repeat questions found on the page."""
    covered = lambda x: F.array_contains(questions, tx.norm(x))

    def segment(s: Column) -> Column:
        kept = F.filter(s["faqs"]["QAs"], lambda q: ~covered(q["question"]))
        left = tx.strip(F.array_join(F.filter(tx.lines(s["text"]), lambda x: ~covered(x)), "\n"))
        s = s.withField("faqs", F.when(F.size(kept) > 0, F.struct(s["faqs"]["title"].alias("title"), kept.alias("QAs"))))
        s = s.withField("text", F.when(s["text"].isNull() | (s["text"] == ""), s["text"]).otherwise(F.nullif(left, F.lit(""))))
        return s.withField("subheading", F.when((s["subheading"] != "") & covered(s["subheading"]), F.lit(None)).otherwise(s["subheading"]))

    return F.when(questions.isNotNull(), map_segments(page, segment)).otherwise(page)


def filled(x: Column) -> Column:
    return x.isNotNull() & (x != "")


def prune(page: Column) -> Column:
    """Without lines of page source, blank texts, empty segments and blocks without segments."""

    def clean(s: Column) -> Column:
        text = tx.strip_markup_lines(s["text"])
        return s.withField("text", F.when(tx.is_blank_text(text), F.lit(None)).otherwise(text))

    holds = lambda s: filled(s["subheading"]) | filled(s["text"]) | filled(s["files"]) | filled(s["contacts"]) | s["faqs"].isNotNull()
    cleaned = map_segments(page, clean)
    cleaned = map_blocks(cleaned, lambda b: b.withField("segments", F.filter(b["segments"], holds)))
    return cleaned.withField("blocks", F.filter(cleaned["blocks"], lambda b: F.size(b["segments"]) > 0))


# ---------------------------------------------------------------- placement within a page


def by_page(answer: Callable, kind: str, *columns: Column) -> Column:
    """answer(page, ...) for each row, as a struct (value, error), over Arrow batches.

    Null where a column is null. What answer raises becomes the error of its row; no row stops another one.
    """

    def told(*row: object) -> dict | None:
        if any(x is None for x in row):
            return None
        try:
            return {"value": answer(*row), "error": None}
        except Exception as error:  # noqa: BLE001  a page may break in any way
            return {"value": None, "error": f"{type(error).__name__}: {error}"[:ERROR_LIMIT]}

    return by_row(told, f"struct<value:{kind},error:string>", *columns)


def placed(page: Column, extracts: Column, place: Callable = placement.place) -> Column:
    """(value, error): the page with its extracts in it, or why that failed."""
    return by_page(place, schema.PAGE, page, extracts)


def located(page: Column, headings: Column) -> Column:
    """(value, error): for each heading the block and the place in it where placement would put what is found there."""
    return by_page(placement.located, "array<struct<block:int,insert_at:int>>", page, headings)


def followed(page: Column, headings: Column) -> Column:
    """(value, error): for each heading the block behind which placement would open its section."""
    return by_page(placement.followed, "array<int>", page, headings)


def chosen(page: Column) -> Column:
    """(value, error): the blocks for phones and opening hours, and whether the hours are missing."""
    return by_page(placement.chosen, "struct<contact:int,hours:int,lacks_hours:boolean>", page)


def merge(pages: DataFrame, page: str = "page", extracts: str = "extracts", place: Callable = placement.place) -> DataFrame:
    """Pages with their extracts merged in, and error: why a page could not be, null if it was.

    A page whose extracts are null (no url, or not fetched) stays untouched; so does one that breaks.
    """
    p, e = F.col(page), F.col(extracts)
    titled = p.withField("title", F.coalesce(e["title"], F.lit("")))
    staged = pages.withColumn("_staged", F.when(e.isNotNull(), strip_covered_questions(titled, F.coalesce(e["questions"], F.array().cast("array<string>")))))
    staged = staged.withColumn("_placed", placed(F.col("_staged"), e, place))
    done = F.col("_placed.value")
    return staged.withColumn("error", F.col("_placed.error")).withColumn(page, F.when(done.isNotNull(), prune(done)).otherwise(p)).drop("_staged", "_placed")
