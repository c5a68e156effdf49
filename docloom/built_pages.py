"""Queries of the extractors over pages that are built of whole documents.

Each line of a document becomes a part of its page, by its number i: of six lines each, the first is a heading (some are
hidden), then come a paragraph or a list of opening hours, an expandable panel or a paragraph, a file link, a phone link
(some behind a label), and a details element. Names of files, questions and phones repeat within a page. The pages go
through the parser and the extractors of the plan; the SQL tells from the lines what has to be found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import extract
from docloom.sources.dom import node_table

DAYS = 5


def part(line: Column, i: Column) -> Column:
    """The HTML of a line."""
    safe = F.replace(F.replace(F.replace(line, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    name = F.replace(F.replace(F.replace(F.left(line, F.lit(30)), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    kind, section = i % 6, F.floor(i / 6)
    put = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y.cast("string") for y in x])
    paragraph = put("<p>", safe, "</p>")
    days = F.transform(F.slice(F.array(*[F.lit(d.title()) for d in tx.WEEKDAYS]), 1, (i % DAYS).cast("int")), lambda d: put("<dt>", d, "</dt><dd>8 -  ", i, "</dd>"))
    question = put("Frage ", i % 10)
    return (
        F.when(kind == 0, put(F.when(section % 5 == 4, '<h2 class="hidden">').otherwise("<h2>"), safe, "</h2>"))
        .when((kind == 1) & (section % 4 == 3), put("<dl>", F.array_join(days, ""), "</dl>"))
        .when((kind == 2) & (section % 2 == 0), put('<div class="accordion-item"><button class="accordion-button">', question, '</button><div class="accordion-collapse">', safe, "</div></div>"))
        .when(kind == 3, put('<a href="/f', i, '.pdf">', name, "</a>"))
        .when(kind == 4, put(F.when(section % 3 == 0, put("<strong>Desk ", i, "</strong>")).otherwise(""), '<a href="tel:+49 7151 ', i % 40, '">07151 ', i % 40, "</a>"))
        .when(kind == 5, put("<details><summary>", question, "</summary>", safe, "</details>"))
        .otherwise(paragraph)
    )


def built_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, html) of every document."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("text is not null")
    body = F.array_join(F.transform(F.split("text", "\n", -1), part), "\n")
    return docs.select("doc_id", F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("html"))


def found(spark: SparkSession, sf: str) -> DataFrame:
    parts = extract.page_partitions(spark.read.parquet(f"{sf}/documents.parquet"), "text")
    return extract.all_extracts(node_table(built_pages(spark, sf), "html", "doc_id"), ["doc_id"], parts)


def hashed(rows: Column) -> Column:
    return F.sha2(F.array_join(rows, "\n"), 256)


def built_questions(spark: SparkSession, sf: str) -> DataFrame:
    groups = F.col("extracts.qa_groups")
    rows = F.flatten(F.transform(groups, lambda g: F.transform(g["qas"], lambda q: F.concat_ws("|", g["heading"], q["question"], q["answer"]))))
    return found(spark, sf).where("extracts.qa_groups is not null").select("doc_id", F.size(groups).cast("long").alias("groups"), F.size(rows).cast("long").alias("questions"), hashed(rows).alias("hash"))


def built_files(spark: SparkSession, sf: str) -> DataFrame:
    groups = F.col("extracts.file_groups")
    rows = F.flatten(F.transform(groups, lambda g, n: F.transform(g["files"], lambda f: F.concat_ws("|", n, g["heading"], f))))
    return found(spark, sf).where("extracts.file_groups is not null").select("doc_id", F.size(groups).cast("long").alias("groups"), F.size(extract.file_names(F.col("extracts"))).cast("long").alias("files"), hashed(rows).alias("hash"))


def built_phones(spark: SparkSession, sf: str) -> DataFrame:
    rows = F.transform("extracts.phones", lambda p: F.concat_ws("|", p["label"], p["phone"], p["key"]))
    return found(spark, sf).where("extracts.phones is not null").select("doc_id", F.size("extracts.phones").cast("long").alias("phones"), hashed(rows).alias("hash"))


def built_sections(spark: SparkSession, sf: str) -> DataFrame:
    rows = F.transform("extracts.sections", lambda s: F.concat_ws("|", s["heading"], s["text"]))
    return found(spark, sf).where("extracts.sections is not null").select("doc_id", F.size("extracts.sections").cast("long").alias("sections"), hashed(rows).alias("hash"))


def built_hours(spark: SparkSession, sf: str) -> DataFrame:
    return found(spark, sf).where("extracts.hours is not null").select("doc_id", F.col("extracts.hours").alias("hours"))


LINES = "select doc_id, trim(line) as t, trim(left(line, 30)) as name, i, i % 6 as kind, i // 6 as section from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from documents)"
NORMAL = "lower(trim(regexp_replace({x}, '[\\s\\x{{00A0}}]+', ' ', 'g')))"
HEADED = f"select *, coalesce(last_value(case when kind = 0 then t end ignore nulls) over (partition by doc_id order by i), '') as heading from ({LINES})"
WEEK = "['Montag', 'Dienstag', 'Mittwoch', 'Donnerstag', 'Freitag', 'Samstag', 'Sonntag']"
#: The strings of a part, as the parser meets them.
STRINGS = f"""case when kind = 0 then [] when kind = 1 and section % 4 = 3 then flatten(list_transform({WEEK}[1:i % {DAYS}], lambda d: [d, '8 -  ' || i])) when kind = 3 then [name]
 when kind = 4 then case when section % 3 = 0 then ['Desk ' || i] else [] end || ['07151 ' || i % 40] when kind = 5 then ['Frage ' || i % 10, t] else [t] end"""
SQL = {
    "built_questions": f"""with p as (select *, case when kind = 5 then 1 else 0 end as late, 'Frage ' || i % 10 as q from ({HEADED}) where (kind = 5 or (kind = 2 and section % 2 = 0)) and t <> ''),
k as (select * from (select *, row_number() over (partition by doc_id, heading, q order by late, i) as n from p where lower(q) <> {NORMAL.format(x='t')}) where n = 1),
g as (select *, min(late * 1000000 + i) over (partition by doc_id, heading) as ord from k)
select doc_id, count(distinct heading) as groups, count(*) as questions, sha256(string_agg(heading || '|' || q || '|' || t, chr(10) order by ord, late, i)) as hash from g group by doc_id""",
    "built_files": f"""with f as (select * from (select *, row_number() over (partition by doc_id, name order by i) as n from ({HEADED}) where kind = 3 and name <> '') where n = 1),
s as (select *, case when lag(heading) over (partition by doc_id order by i) = heading then 0 else 1 end as starts from f),
r as (select *, sum(starts) over (partition by doc_id order by i) - 1 as run from s)
select doc_id, count(distinct run) as groups, count(*) as files, sha256(string_agg(run::bigint || '|' || heading || '|' || name, chr(10) order by i)) as hash from r group by doc_id""",
    "built_phones": f"""with l as (select *, coalesce(last_value(case when kind = 0 and t <> '' and length(t) < 60 then t when kind = 4 and section % 3 = 0 then 'Desk ' || i end ignore nulls) over (partition by doc_id order by i), '') as label from ({LINES})),
k as (select *, row_number() over (partition by doc_id, i % 40 order by i) as n from l where kind = 4)
select doc_id, count(*) as phones, sha256(string_agg(label || '|07151 ' || i % 40 || '|7151' || i % 40, chr(10) order by i)) as hash from k where n = 1 group by doc_id""",
    "built_sections": f"""with s as (select doc_id, section, i, u from (select doc_id, section, i, unnest(strs) as u, generate_subscripts(strs, 1) as k from (select *, {STRINGS} as strs from ({LINES}))) where trim(u) <> ''),
b as (select doc_id, section, string_agg(trim(u), chr(10) order by rowid) as body from (select *, row_number() over (order by doc_id, i) as rowid from s) group by doc_id, section),
h as (select doc_id, section, max(case when kind = 0 then t end) as head, bool_or(kind = 2 and section % 2 = 0) as folded from ({LINES}) group by doc_id, section)
select h.doc_id, count(*) as sections, sha256(string_agg(head || '|' || left(trim(coalesce(body, ''), ' ' || chr(10)), 4000), chr(10) order by section)) as hash from h left join b using (doc_id, section) where head <> '' and not folded and section % 5 <> 4 group by h.doc_id""",
    "built_hours": f"""with d as (select doc_id, i, {WEEK}[1:i % {DAYS}] as days from ({LINES}) where kind = 1 and section % 4 = 3 and i % {DAYS} >= 3)
select doc_id, arg_min(array_to_string(list_transform(days, lambda x: '- ' || x || ': 8 - ' || i), chr(10)), i) as hours from d group by doc_id""",
}
SQL["built_sections"] = SQL["built_sections"].replace("select doc_id, section, i, u from (", "select doc_id, section, i, k, u from (").replace("over (order by doc_id, i)", "over (order by doc_id, i, k)")
NAMES = list(SQL)
