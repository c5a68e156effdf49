"""Navigation and task texts for an external capture agent, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.operators.match import join_url


def system_text() -> str:
    """What an agent is told once, before its tasks: its role, the shape of its answer as the engine reads it, and what it leaves to the engine."""
    from docloom.schema import TREE

    return "\n".join(
        (
            "You read pages of one website and answer with one JSON document for each topic.",
            f"Its shape, as types of columns: {TREE}.",
            "One entry of pages stands for one page, in the order you read them. A block begins with each large heading and a segment with each smaller one; leave what is not there as null.",
            "Write down only what the pages say. What a question, a file list, a phone number or opening hours say is checked against the page afterwards, so copy rather than rephrase.",
            "Close dialogs about cookies first. If a page does not load, leave it out and go on.",
        )
    )


def navigation(url: Column, path: Column, root_url: str) -> Column:
    """Where to go: the topic's url, resolved against the root if relative, else the labels to click from the root."""
    target = F.when(F.rlike(url, F.lit("^https?://")), url).otherwise(join_url(F.lit(root_url), url))
    clicks = F.array_join(F.transform(path, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", then ")
    direct = F.concat(F.lit("Open this page and capture it: "), target)
    return F.when(url.isNotNull() & (url != ""), direct).otherwise(F.concat(F.lit(f"Begin on {root_url} and follow the links "), clicks, F.lit("; capture the page you arrive at.")))


def task(navigation_text: Column, instructions: Column, subpages: Column) -> Column:
    """The capture task: navigation, sub-pages (array of label and url) and the topic's instructions."""
    listed = F.array_join(F.transform(subpages, lambda s: F.concat(F.lit("  - "), s["label"], F.lit(": "), s["url"])), "\n")
    more = F.when(F.size(subpages) > 0, F.concat(F.lit("\n\n## Sub-pages\nCapture each of these pages completely, as a page of its own:\n"), listed, F.lit("\n"))).otherwise("")
    rules = "Capture the whole page from top to bottom. Leave nothing out and shorten nothing; keep opening hours, contacts, file names and answers word for word, as Markdown. Follow links only where the instructions say so."
    return F.concat(F.lit("## Navigation\n"), navigation_text, more, F.lit("\n\n## Instructions\n"), F.coalesce(instructions, F.lit("")), F.lit(f"\n\n## Rules\n{rules}\n"))
