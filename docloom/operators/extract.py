"""Extractors: ordered windows and aggregations over the node table.

`keys` name the columns that identify a page. All windows of one page share its key, so after one exchange
on it nothing moves again. all_extracts finds all kinds in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as tx

SECTION_CAP, LABEL_CAP, WEEKDAYS_NEEDED = 4000, 60, 3
#: Bytes of HTML whose nodes one task sorts.
TASK_BYTES = 4 << 20


def page_partitions(pages: DataFrame, html: str) -> int:
    """For all_extracts: so many parts that each holds TASK_BYTES of HTML on average, however many pages there are. Reads the column once."""
    return int(pages.agg(F.sum(F.octet_length(html))).first()[0] or 0) // TASK_BYTES + 1


def before(keys: list[str]) -> Window:
    return Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)


def preceding(value: Column, when: Column, keys: list[str]) -> Column:
    """The value of the nearest earlier node that fulfils a condition: a backward as-of lookup."""
    return F.last_value(F.when(when, value), True).over(before(keys))


def ordered(values: str, *order: str) -> Column:
    """An array of values by the order columns."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(values).alias("v")))), lambda x: x["v"])


def title_of(text: Column, kind: Column, tag: Column, pos: Column) -> Column:
    """An aggregate: the first title up to its first pipe, else the first h1, else empty."""
    title = F.coalesce(F.min_by(text, F.when(kind == "title", pos)), F.lit(""))
    h1 = F.coalesce(F.min_by(text, F.when(tag == "h1", pos)), F.lit(""))
    return F.when(title != "", tx.strip(F.element_at(F.split(title, r"\|", 2), 1))).otherwise(h1)


def titles(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, title) of every page that has a row, be it without nodes."""
    return nodes.groupBy(*keys).agg(title_of(F.col("text"), F.col("kind"), F.col("tag"), F.col("pos")).alias("title"))


def links(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, text, href): links that have text, the text normalised."""
    return nodes.where("kind = 'link'").select(*keys, "pos", tx.norm(F.col("text")).alias("text"), "href").where("text <> ''")


def first_by(rows: DataFrame, same: list[Column], *order: str) -> DataFrame:
    """The first row of each group in an order; never an arbitrary one."""
    return rows.withColumn("_first", F.row_number().over(Window.partitionBy(*same).orderBy(*order))).where("_first = 1").drop("_first")


def file_names(extracts: Column) -> Column:
    """The names of a page's files in one list."""
    return F.flatten(F.transform(extracts["file_groups"], lambda g: g["files"]))


def run_number(by: Column, when: Column, keys: list[str]) -> Column:
    """The number of the run that a row belongs to: runs of rows (by pos) that fulfil a condition, with equal `by`; a value that comes back opens a new run."""
    last = F.last_value(F.when(when, F.struct(by.alias("v"))), True).over(before(keys))
    starts = F.when(when & (last.isNull() | ~last["v"].eqNullSafe(by)), 1).otherwise(0)
    return F.sum(starts).over(Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int")


def adjacent_runs(rows: DataFrame, keys: list[str], by: str, value: str, into: str) -> DataFrame:
    """(keys, ord, by, into): values of adjacent rows (by pos) with equal `by`; a value that comes back opens a new run."""
    runs = rows.withColumn("ord", run_number(F.col(by), F.lit(True), keys))
    return runs.groupBy(*keys, "ord").agg(F.min_by(by, "pos").alias(by), ordered(value, "pos").alias(into))


def all_extracts(nodes: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """(keys, extracts): everything found on a page in one struct, lists in order; null where nothing is found.

    One pass: the nodes move once, by page, and all windows and the one aggregation share that exchange, so a page is
    parsed once whatever is extracted. partitions: in how many parts they move (page_partitions tells), as the session's
    number does not grow with the pages, and a task would sort ever more of them.

    title: the first title up to its pipe, else the first h1. questions, qa_groups: panels with a question and another
    answer, under the nearest earlier heading in no accordion; groups by first appearance, accordions before details,
    a question once a group. phones: tel: links, the first of each key, labelled by the nearest short heading or strong
    text. hours: the first list with at least three weekdays that have times. file_groups: file links with text, the
    first of each name, in runs under the nearest h2 to h5. sections: visible h2 sections without accordions, text up to
    the next h2 of any kind. error: why the page could not be parsed.
    """
    if partitions:
        nodes = nodes.repartition(partitions, *keys)
    # what stands before each node
    fit = F.col("tag").isin("h2", "h3", "h4", "h5", "strong", "b") & (F.col("text") != "") & (F.length("text") < LABEL_CAP)
    head = F.when(F.col("tag") == "h2", F.struct("pos", "end_pos", "text", "hidden"))
    rows = nodes.withColumns(
        {
            "_heading": F.coalesce(preceding(F.col("text"), (F.col("kind") == "heading") & ~F.col("in_accordion"), keys), F.lit("")),
            "_file_heading": F.coalesce(preceding(F.col("text"), F.col("tag").isin("h2", "h3", "h4", "h5"), keys), F.lit("")),
            "_label": F.coalesce(preceding(F.col("text"), fit, keys), F.lit("")),
            "_h2": F.last_value(head, True).over(Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    )
    # what each node is
    q, a = tx.strip(F.col("question")), tx.strip(F.col("answer"))
    link, phone = F.col("kind") == "link", F.when(F.col("text") != "", F.col("text")).otherwise(tx.strip(F.substr("href", F.lit(5))))
    rows = rows.withColumns(
        {
            "_panel": F.coalesce((F.col("kind") == "panel") & (q != "") & (a != "") & (tx.norm(q) != tx.norm(a)), F.lit(False)),
            "_file": F.coalesce(link & (F.col("text") != "") & tx.is_file_link(F.col("href")), F.lit(False)),
            "_phone": F.when(link & F.lower("href").startswith("tel:"), F.nullif(tx.phone_key(phone), F.lit(""))),
            "_late": (F.col("tag") == "details").cast("int"),
        }
    )
    # the first of each question, of each question under a heading or file name, and of each phone
    first = lambda flag, *same: flag & (F.row_number().over(Window.partitionBy(*keys, flag, *same).orderBy("_late", "pos")) == 1)
    rows = rows.withColumn("_question", first(F.col("_panel"), tx.norm(F.col("question"))))
    rows = rows.withColumn("_grouped", first(F.col("_panel"), F.col("_heading"), tx.norm(F.col("question"))))
    rows = rows.withColumn("_file", first(F.col("_file"), F.col("text")))
    rows = rows.withColumn("_called", first(F.col("_phone").isNotNull(), F.col("_phone")))
    rows = rows.withColumn("_run", run_number(F.col("_file_heading"), F.col("_file"), keys))

    listed = lambda when, *values: F.array_sort(F.collect_list(F.when(when, F.struct(*values))))
    good = F.filter("pairs", lambda p: tx.is_weekday(p["day"]) & (p["times"] != ""))
    line = F.array_join(F.transform(good, lambda p: F.concat(F.lit("- "), p["day"], F.lit(": "), p["times"])), "\n")
    is_list = (F.col("kind") == "list") & (F.size(good) >= WEEKDAYS_NEEDED)
    behind = F.col("pos") > F.col("_h2.end_pos")
    page = rows.groupBy(*keys).agg(
        title_of(F.col("text"), F.col("kind"), F.col("tag"), F.col("pos")).alias("title"),
        F.collect_set(F.when(F.col("_question"), tx.norm(F.col("question")))).alias("questions"),
        listed(F.col("_grouped"), "_late", "pos", F.col("_heading").alias("heading"), F.struct(q.alias("question"), a.alias("answer")).alias("qa")).alias("qas"),
        listed(F.col("_called"), "pos", F.struct(F.col("_label").alias("label"), phone.alias("phone"), F.col("_phone").alias("key")).alias("v")).alias("phones"),
        F.min_by(line, F.when(is_list, F.col("pos"))).alias("hours"),
        listed(F.col("_file"), "pos", F.col("_run").alias("run"), F.col("_file_heading").alias("heading"), F.col("text").alias("name")).alias("files"),
        F.min(F.when(F.col("kind") == "error", F.col("text"))).alias("error"),
        listed(F.col("tag") == "h2", "pos", "text", "hidden").alias("heads"),
        listed((F.col("kind") == "string") & behind, "pos", F.col("_h2.pos").alias("h2"), "text").alias("body"),
        F.collect_set(F.when((F.col("kind") == "accordion") & (F.col("pos") > F.col("_h2.pos")), F.col("_h2.pos"))).alias("folded"),
    )
    qa_group = lambda h: F.struct(h.alias("heading"), F.transform(F.filter("qas", lambda x: x["heading"] == h), lambda x: x["qa"]).alias("qas"))
    file_group = lambda x: F.struct(x["heading"].alias("heading"), F.transform(F.filter("files", lambda y: y["run"] == x["run"]), lambda y: y["name"]).alias("files"))
    text = lambda h: F.left(tx.strip(F.array_join(F.transform(F.filter("body", lambda x: x["h2"] == h["pos"]), lambda x: x["text"]), "\n")), F.lit(SECTION_CAP))
    shown = F.filter("heads", lambda h: (h["text"] != "") & ~h["hidden"] & ~F.array_contains(F.col("folded"), h["pos"]))
    found = {
        "title": F.col("title"),
        "questions": F.col("questions"),
        "qa_groups": F.transform(F.array_distinct(F.transform("qas", lambda x: x["heading"])), qa_group),
        "phones": F.transform("phones", lambda x: x["v"]),
        "hours": F.col("hours"),
        "file_groups": F.transform(F.filter("files", lambda x, i: (i == 0) | (F.get(F.col("files"), F.greatest(i - 1, F.lit(0)))["run"] != x["run"])), file_group),
        "sections": F.transform(shown, lambda h: F.struct(h["text"].alias("heading"), text(h).alias("text"))),
        "error": F.col("error"),
    }
    none = ("questions", "qa_groups", "phones", "file_groups", "sections")
    return page.select(*keys, F.struct(*[(F.when(F.size(c) > 0, c) if name in none else c).alias(name) for name, c in found.items()]).alias("extracts"))
