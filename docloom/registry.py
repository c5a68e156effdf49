"""Queries of the engine's own operators over the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom import built_pages, schema
from docloom.functions import text as tx
from docloom.operators import chunk, extract, knowledge, match, merge, monitor, publish, search, structure
from docloom.plans import topics
from docloom.sources.config import select_topics
from docloom.sources.dom import element_table, node_table


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_title(spark: SparkSession, sf: str) -> DataFrame:
    return extract.titles(node_table(read(spark, sf, "pages"), "html", "page_id", every_page=True), ["page_id"])


def page_links(spark: SparkSession, sf: str) -> DataFrame:
    links = extract.links(node_table(read(spark, sf, "pages"), "html", "page_id"), ["page_id"])
    return links.select("page_id", F.row_number().over(Window.partitionBy("page_id").orderBy("pos")).cast("long").alias("n"), "text", "href")


def file_link_flag(spark: SparkSession, sf: str) -> DataFrame:
    nodes = node_table(read(spark, sf, "pages"), "html", "page_id", every_page=True)
    link = (F.col("kind") == "link") & (tx.norm(F.col("text")) != "")
    many = lambda x: F.count(F.when(x, 1))
    return nodes.groupBy("page_id").agg(many(link).alias("links"), many(link & tx.is_file_link(F.col("href"))).alias("files"))


def label_resolution(spark: SparkSession, sf: str) -> DataFrame:
    pages = read(spark, sf, "pages")
    labels = spark.createDataFrame([(0, "about"), (1, "Home"), (2, "contact us now"), (3, "x")], "label_pos int, label string")
    asked = pages.select("page_id", F.col("url").alias("base_url")).crossJoin(F.broadcast(labels))  # a fixed list of four labels
    return match.resolve_labels(asked, extract.links(node_table(pages, "html", "page_id"), ["page_id"]), ["page_id"]).select("page_id", "label_pos", "label", "url")


def page_markdown(spark: SparkSession, sf: str) -> DataFrame:
    return topics.page_markdown(read(spark, sf, "pages"))


def page_metrics(spark: SparkSession, sf: str) -> DataFrame:
    trees = topics.page_trees(read(spark, sf, "pages"))
    return monitor.metrics(trees.withColumn("topic", F.col("page_id").cast("string")))


def page_extracts(spark: SparkSession, sf: str) -> DataFrame:
    pages = read(spark, sf, "pages")
    found = extract.all_extracts(node_table(pages, "html", "page_id"), ["page_id"], extract.page_partitions(pages, "html"))
    return found.select("page_id", "extracts.title", *[F.coalesce(F.size(f"extracts.{c}"), F.lit(0)).alias(c) for c in ("questions", "qa_groups", "phones", "file_groups", "sections")])


def enriched_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = read(spark, sf, "pages")
    trees = topics.page_trees(pages).select(F.concat(F.lit("page "), "page_id").alias("topic"), F.lit(None).cast("string").alias("base_url"), "pages")
    return monitor.metrics(topics.enrich(trees, pages.select("url", "html"), partitions=extract.page_partitions(pages, "html")))


def norm_key_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").withColumn("key", F.sha2(tx.norm(F.col("text")), 256))
    return extract.first_by(docs, [F.col("key")], "doc_id").select("doc_id", "key")


def content_norm_hash(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", F.sha2(tx.content_norm(F.col("text")), 256).alias("hash"))


def prose_flag(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", tx.looks_like_prose(F.col("text")).alias("prose"))


def blank_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "documents").select("doc_id", F.explode(tx.lines(F.col("text"))).alias("line"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(tx.is_blank_text(F.col("line")).cast("long")).alias("blank"))


def strip_markup(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "pages").select("page_id", F.sha2(F.coalesce(tx.strip_markup_lines(F.col("html")), F.lit("")), 256).alias("hash"))


def section_lengths(spark: SparkSession, sf: str) -> DataFrame:
    found = chunk.section_lengths(read(spark, sf, "documents"), "doc_id", "text")
    return found.groupBy("doc_id").agg(F.count("*").alias("units"), F.sum("length").cast("long").alias("chars"))


def chunk_params(spark: SparkSession, sf: str) -> DataFrame:
    """Lengths of a source's documents stand for section lengths. They are counted, so that a source of any size is a short list."""
    counted = read(spark, sf, "documents").groupBy("source", F.length("text").alias("length")).agg(F.count("*").alias("n"))
    docs = chunk.p95_of_counts(counted, ["source"], "length", "n", "p95")
    p = chunk.params(F.col("p95"))
    return docs.select("source", F.col("p95").cast("long").alias("p95"), p["max_characters"].cast("long").alias("max_characters"), p["overlap"].cast("long").alias("overlap"))


def document_chunks(spark: SparkSession, sf: str) -> DataFrame:
    p = chunk.chunk_params(read(spark, sf, "documents"), "doc_id", "text")
    return p.select("doc_id", F.col("chunk_params.max_characters").cast("long").alias("max_characters"), F.col("chunk_params.overlap").cast("long").alias("overlap"))


def passage_contained(spark: SparkSession, sf: str) -> DataFrame:
    """How many documents hold the beginning of each passage."""
    docs = read(spark, sf, "documents").select("doc_id", tx.content_norm(F.col("text")).alias("blob"))
    passages = read(spark, sf, "benchmark").select("item_id", tx.content_norm(F.col("text")).alias("answer"))
    return match.present_answers(passages, docs, "item_id", "doc_id").groupBy("item_id").agg(F.count("*").alias("documents"))


def phone_key(spark: SparkSession, sf: str) -> DataFrame:
    """The first phone-like text of each document."""
    return read(spark, sf, "documents").select("doc_id", tx.phone_key(F.regexp_extract("text", r"\+?[0-9][0-9() .-]+[0-9]", 0)).alias("key"))


def preceding_heading(spark: SparkSession, sf: str) -> DataFrame:
    """Short lines stand for headings: each line's nearest earlier one."""
    rows = read(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    near = extract.preceding(F.col("line"), (F.length("line") < 40) & (F.length("line") > 0), ["doc_id"])
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), F.coalesce(near, F.lit("")).alias("heading"))


def adjacent_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of a document's lines with one first letter."""
    rows = read(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    runs = extract.adjacent_runs(rows.select("doc_id", "pos", F.left("line", F.lit(1)).alias("letter")), ["doc_id"], "letter", "pos", "members")
    return runs.select("doc_id", F.col("ord").cast("long").alias("ord"), "letter", F.size("members").cast("long").alias("members"))


def snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of the whole table; the older one counts with other measures, so that all rules have something to find."""
    docs = read(spark, sf, "documents")
    of = lambda faqs, chars, more: docs.groupBy(F.col("source").alias("topic")).agg((F.count("*") + more).alias("pages"), F.count(F.when(F.col("n_chars") > faqs, 1)).alias("faqs"), F.sum(F.col("doc_id") % 3).alias("files"), F.sum(chars).cast("long").alias("chars"))
    return of(1000, F.col("n_chars"), 0), of(500, F.col("n_chars") + F.col("doc_id") % 2000, F.count(F.when(F.col("lang") == "de", 1)))


def regressions(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.regressions(*snapshots(spark, sf)).select("topic", F.array_join("issues", "; ").alias("issues"))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.run_summary(snapshots(spark, sf)[1], ["lost topic"])


def upload_plan(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select(F.concat("doc_id", F.lit(".md")).alias("name"), F.col("text").alias("md"), "doc_id")
    changed = F.when(F.col("doc_id") % 5 == 0, F.sha2(F.lit("old"), 256)).otherwise(tx.sha256_text(F.col("md")))
    state = docs.where("doc_id % 3 <> 0").select("name", F.concat(F.lit("f"), "doc_id").alias("file_id"), changed.alias("sha256"))
    return publish.upload_plan(docs.select("name"), docs.where("doc_id % 7 <> 0"), state)


def upload_tally(spark: SparkSession, sf: str) -> DataFrame:
    return publish.tally(upload_plan(spark, sf))


def knowledge_search(spark: SparkSession, sf: str) -> DataFrame:
    table = read(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("topic"), F.col("text").alias("content"))
    return knowledge.search_all(table, "LICENSE").select("id", "topic")


def knowledge_index_search(spark: SparkSession, sf: str) -> DataFrame:
    """The same by the gram index of all documents."""
    table = read(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("topic"), F.col("text").alias("content"))
    some = search.candidates(table, search.postings(table, "id", "topic", "content"), "id", "LICENSE")
    return some.where(knowledge.holds("LICENSE")).select("id", "topic")


def inside_elements(spark: SparkSession, sf: str) -> DataFrame:
    """Links in navigation, and paragraphs in articles and outside of them, of each page."""
    nodes = element_table(read(spark, sf, "pages"), "html", "page_id")
    nodes = structure.inside(structure.inside(nodes, F.col("tag") == "nav", ["page_id"], "in_nav"), F.col("tag") == "article", ["page_id"], "in_article")
    many = lambda x: F.count(F.when(x, 1))
    p = F.col("tag") == "p"
    return nodes.groupBy("page_id").agg(many((F.col("tag") == "a") & F.col("in_nav")).alias("nav_links"), many(p & F.col("in_article")).alias("article_p"), many(p & ~F.col("in_article")).alias("other_p"))


def enclosing_elements(spark: SparkSession, sf: str) -> DataFrame:
    """For each page how many list items and links stand in lists, and how deep at most."""
    nodes = element_table(read(spark, sf, "pages"), "html", "page_id")
    around = structure.enclosing(nodes.where("tag in ('ul', 'li', 'a')"), F.col("tag") == "ul", ["page_id"])
    return around.groupBy("page_id").agg(F.count("*").alias("held"), F.max("depth").cast("long").alias("deepest"))


def chat_history(spark: SparkSession, sf: str) -> DataFrame:
    made = knowledge.chat_history(read(spark, sf, "conversations"))
    return made.select("conv_id", F.size("history").cast("long").alias("turns"), F.sha2(F.array_join(F.transform("history", lambda x: F.concat(x["role"], F.lit(": "), x["content"])), "\n"), 256).alias("hash"))


def topic_selection(spark: SparkSession, sf: str) -> DataFrame:
    found = select_topics(read(spark, sf, "nation").select(F.col("n_name").alias("name"), "n_nationkey"), " NATION_3, NATION_1,, NATION_3 ")
    return found.select(F.col("ord").cast("long").alias("ord"), "name", F.col("n_nationkey").cast("long").alias("n_nationkey"))


EMPTY_EXTRACTS = {"title": "string", "questions": "array<string>", "qa_groups": f"array<struct<heading:string,qas:array<{schema.QA}>>>", "phones": "array<struct<label:string,phone:string,key:string>>", "hours": "string", "file_groups": "array<struct<heading:string,files:array<string>>>", "sections": "array<struct<heading:string,text:string>>", "error": "string"}


def extracts_of(**given: Column) -> Column:
    """Extracts as all_extracts makes them, of which only some kinds were found."""
    return F.struct(*[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in EMPTY_EXTRACTS.items()])


def page_of(blocks: Column) -> Column:
    return F.struct(F.lit("").alias("url"), F.lit("").alias("title"), blocks.alias("blocks")).cast(schema.PAGE)


def block_of(heading: Column, segments: Column) -> Column:
    return F.struct(heading.alias("heading"), segments.cast(f"array<{schema.SEGMENT}>").alias("segments"))


def segment_of(**given: Column) -> Column:
    none = F.lit(None)
    return F.struct(*[given.get(name, none).cast("string").alias(name) for name in ("subheading", "text", "files", "contacts")], none.cast(schema.FAQ).alias("faqs"))


def half_trees(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, text, lines, page): documents, and a page of each that holds the first half of the text: what was captured of it."""
    docs = read(spark, sf, "documents").where("text is not null")
    half = segment_of(text=F.left("text", F.expr("length(text) div 2")))
    return docs.select("doc_id", "text", F.split("text", "\n", -1).alias("lines"), page_of(F.array(block_of(F.lit(None).cast("string"), F.array(half)))).alias("page"))


def added(trees: DataFrame, extracts: Column) -> DataFrame:
    """(doc_id, block, segment): what placement adds to each page."""
    done = trees.select("doc_id", merge.placed(F.col("page"), extracts)["value"].alias("page"))
    blocks = done.select("doc_id", F.posexplode("page.blocks").alias("b", "block"))
    rows = blocks.select("doc_id", "b", "block", F.posexplode("block.segments").alias("s", "segment"))
    return rows.where("b > 0 or s > 0").select("doc_id", "block", "segment")


def line_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, lines, page): each third line of a document heads a block, the two behind it are its subheadings."""
    docs = read(spark, sf, "documents").where("text is not null").select("doc_id", F.split("text", "\n", -1).alias("lines"))
    return docs.select("doc_id", "lines", headed(F.col("lines")).alias("page"))


def headed(lines: Column) -> Column:
    at = lambda i: F.get(lines, i)
    sub = lambda i: segment_of(subheading=at(i))
    block = lambda b: block_of(at(b), F.filter(F.array(sub(b + 1), sub(b + 2)), lambda s: s["subheading"].isNotNull()))
    return page_of(F.transform(F.sequence(F.lit(0), F.size(lines) - 1, F.lit(3)), block))


def told_pages(spark: SparkSession, sf: str) -> DataFrame:
    """line_pages of which some headings are about contact or opening hours."""
    say = lambda i: F.when((F.col("doc_id") + i) % 11 == 0, "Öffnungszeiten ").when((F.col("doc_id") + i) % 5 == 0, "Kontakt ").otherwise("")
    pages = line_pages(spark, sf).withColumn("told", F.transform("lines", lambda line, i: F.concat(say(i), line)))
    return pages.select("doc_id", "lines", headed(F.col("told")).alias("page"))


def heading_places(spark: SparkSession, sf: str) -> DataFrame:
    """Where a page made of a document's lines takes what is found under the beginning of each line; -1 for nowhere."""
    pages = line_pages(spark, sf)
    asked = F.transform("lines", lambda line: F.left(line, F.lit(20)))
    found = pages.select("doc_id", merge.located(F.col("page"), asked)["value"].alias("at"))
    rows = found.select("doc_id", F.posexplode("at").alias("ord", "at"))
    return rows.select("doc_id", F.col("ord").cast("long").alias("ord"), *[F.coalesce(f"at.{c}", F.lit(-1)).cast("long").alias(c) for c in ("block", "insert_at")])


def missing_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that are added as answers, as the page does not hold them; their numbers stand for questions."""
    asked = F.transform("lines", lambda line, i: F.struct(i.cast("string").alias("question"), line.alias("answer")))
    rows = added(half_trees(spark, sf), extracts_of(qa_groups=F.array(F.struct(F.lit("").alias("heading"), asked.alias("qas")))))
    return rows.select("doc_id", F.explode("segment.faqs.QAs").alias("q")).select("doc_id", F.col("q.question").cast("long").alias("pos"))


def missing_phones(spark: SparkSession, sf: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(r"\+?[0-9][0-9() .-]+[0-9]"), F.lit(0))
    phones = F.transform(found, lambda x, i: F.struct(i.cast("string").alias("label"), x.alias("phone"), tx.phone_key(x).alias("key")))
    rows = added(half_trees(spark, sf), extracts_of(phones=phones)).select("doc_id", F.explode(F.split("segment.contacts", "\n")).alias("line"))
    parts = F.split("line", ": ", 2)
    return rows.select("doc_id", F.get(parts, F.lit(0)).cast("long").alias("pos"), tx.phone_key(F.get(parts, F.lit(1))).alias("key"))


def missing_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that are added as sections; every fourth one is about downloads, the others are headed by their number."""
    asked = F.transform("lines", lambda line, i: F.struct(F.when(i % 4 == 1, "Downloads").otherwise(F.concat(F.lit("s"), i)).alias("heading"), line.alias("text")))
    rows = added(half_trees(spark, sf), extracts_of(sections=asked))
    return rows.select("doc_id", F.substr("block.heading", F.lit(2)).cast("long").alias("pos"))


def section_places(spark: SparkSession, sf: str) -> DataFrame:
    """-1 stands for the end of the page."""
    pages = told_pages(spark, sf)
    asked = F.transform("lines", lambda line: F.left(line, F.lit(20)))
    rows = pages.select("doc_id", F.posexplode(merge.followed(F.col("page"), asked)["value"]).alias("pos", "at"))
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), F.coalesce("at", F.lit(-1)).cast("long").alias("insert_after"))


def contact_block(spark: SparkSession, sf: str) -> DataFrame:
    return told_pages(spark, sf).select("doc_id", merge.chosen(F.col("page"))["value"]["contact"].cast("long").alias("block"))


def hours_block(spark: SparkSession, sf: str) -> DataFrame:
    return told_pages(spark, sf).select("doc_id", merge.chosen(F.col("page"))["value"]["hours"].cast("long").alias("block"))


def hours_missing(spark: SparkSession, sf: str) -> DataFrame:
    """The names of some weekdays, as many as doc_id tells, are put behind each text."""
    days = F.slice(F.array(*[F.lit(f"{d.title()}\u00a0") for d in tx.WEEKDAYS]), 1, (F.col("doc_id") % 7).cast("int"))
    docs = read(spark, sf, "documents").select("doc_id", F.concat_ws(" ", "text", F.array_join(days, " ")).alias("text"), days.alias("days"))
    page = page_of(F.array(block_of(F.lit(""), F.array(segment_of(text=F.col("text"))))))
    named = F.size(F.filter("days", tx.is_weekday)).cast("long")
    return docs.select("doc_id", merge.chosen(page)["value"]["lacks_hours"].alias("missing"), named.alias("named"))


NAMES = (
    "page_title page_links file_link_flag label_resolution page_markdown page_metrics page_extracts enriched_pages norm_key_dedup content_norm_hash prose_flag blank_lines strip_markup "
    "section_lengths chunk_params document_chunks passage_contained phone_key preceding_heading adjacent_groups regressions run_summary upload_plan upload_tally knowledge_search chat_history topic_selection "
    "knowledge_index_search inside_elements enclosing_elements heading_places missing_answers missing_phones missing_sections section_places contact_block hours_block hours_missing"
).split()

BLANKS = r"[\s\x{{00A0}}]+"  # doubled braces: it only occurs in texts that are formatted
NORM = "lower(trim(regexp_replace(coalesce({x}, ''), '" + BLANKS + "', ' ', 'g')))"
CONTENT = NORM.format(x="regexp_replace(regexp_replace(text, '--+', ' ', 'g'), '\\|', ' ', 'g')")
ENTITIES = "replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"
PARAMS = "cast(greatest(800, least(2000, case when round_even({x} / 100.0, 0) = 0 then 800 else round_even({x} / 100.0, 0) * 100 end)) as bigint)"
SNAPSHOT = "select source topic, count(*) + {more} pages, sum(case when n_chars > {faqs} then 1 else 0 end)::bigint faqs, sum(doc_id % 3)::bigint files, sum({chars})::bigint chars from documents group by source"
NEW, OLD = SNAPSHOT.format(faqs=1000, chars="n_chars", more=0), SNAPSHOT.format(faqs=500, chars="n_chars + doc_id % 2000", more="count(*) filter (lang = 'de')")
PLAN = """with docs as (select doc_id, doc_id || '.md' as name, text from documents),
 cur as (select name, sha256(text) as sha256 from docs where doc_id % 7 <> 0),
 state as (select name, 'f' || doc_id as file_id, case when doc_id % 5 = 0 then sha256('old') else sha256(text) end as old from docs where doc_id % 3 <> 0)
 select d.name, case when cur.sha256 is null then 'missing' when old is null then 'upload' when cur.sha256 = old then 'skip' else 'replace' end as action, cur.sha256, file_id
 from docs d left join cur using (name) left join state using (name)"""

SQL = {
    "norm_key_dedup": f"select min(doc_id) as doc_id, key from (select doc_id, sha256({NORM.format(x='text')}) as key from documents) group by key",
    "content_norm_hash": f"select doc_id, sha256({CONTENT}) as hash from documents",
    "prose_flag": "select doc_id, length(c) >= 40 and regexp_matches(c, '[.?!]') as prose from (select doc_id, trim(regexp_replace(regexp_replace(text, '[^\\s]*/[^\\s]*', ' ', 'g'), '" + BLANKS.format() + "', ' ', 'g')) as c from documents)",
    "chunk_params": f"select source, p95, {PARAMS.format(x='p95')} as max_characters, cast(greatest(50, least(200, round_even({PARAMS.format(x='p95')} * 0.1 / 50, 0) * 50)) as bigint) as overlap from (select source, list_sort(list(length(text)))[cast(least(count(*) - 1, floor(count(*) * 0.95)) as bigint) + 1] as p95 from documents group by source)",
    "phone_key": "select doc_id, case when d like '49%' then substr(d, 3) when d like '0%' then substr(d, 2) else d end as key from (select doc_id, regexp_replace(regexp_extract(text, '\\+?[0-9][0-9() .-]+[0-9]'), '[^0-9]', '', 'g') as d from documents)",
    "preceding_heading": "select doc_id, pos, coalesce(last_value(case when length(line) between 1 and 39 then line end ignore nulls) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), '') as heading from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents)",
    "adjacent_groups": "select doc_id, ord, min(letter) as letter, count(*) as members from (select *, cast(sum(s) over (partition by doc_id order by pos) as bigint) as ord from (select doc_id, pos, letter, case when lag(letter) over (partition by doc_id order by pos) = letter then 0 else 1 end as s from (select doc_id, left(line, 1) as letter, pos from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents)))) group by doc_id, ord",
    "page_links": f"select page_id, row_number() over (partition by page_id order by k) as n, {NORM.format(x=ENTITIES.format(x='m[2]'))} as text, {ENTITIES.format(x='m[1]')} as href from (select page_id, unnest(list_transform(regexp_extract_all(html, '<a [^>]*href=\"[^\"]*\"[^>]*>[^<]*</a>'), lambda x: [regexp_extract(x, 'href=\"([^\"]*)\"', 1), regexp_extract(x, '>([^<]*)<', 1)])) as m, generate_subscripts(regexp_extract_all(html, '<a [^>]*href=\"[^\"]*\"[^>]*>[^<]*</a>'), 1) as k from pages) where trim(m[2]) <> ''",
    "regressions": f"with old as ({OLD}), new as ({NEW}) select new.topic, concat_ws('; ', case when new.pages < old.pages then 'pages ' || old.pages || '→' || new.pages end, case when old.faqs > 0 and new.faqs < old.faqs * 0.7 then 'FAQ ' || old.faqs || '→' || new.faqs end, case when old.chars > 0 and new.chars < old.chars * 0.6 then 'content ' || old.chars || '→' || new.chars || ' chars' end) as issues from new left join old using (topic)",
    "run_summary": f"with m as ({OLD}), l as (select topic, '• ' || topic || ': ' || pages || 'p, ' || faqs || ' FAQ, ' || files || ' files' as line from m) select concat_ws(chr(10), (select count(*) || ' ok, 1 failed' from m), (select 'total: ' || sum(pages)::bigint || ' pages · ' || sum(faqs)::bigint || ' FAQ · ' || sum(files)::bigint || ' files' from m), (select case when sum(length(line)) < 700 then string_agg(line, chr(10) order by topic) end from l), 'failed: lost topic') as summary",
    "upload_plan": PLAN,
    "upload_tally": f"select action, count(*) as n from ({PLAN}) group by action",
    "knowledge_search": "select doc_id as id, source as topic from documents where text ilike '%license%' or source ilike '%license%'",
    "chat_history": "select conv_id, count(*) as turns, sha256(string_agg(role || ': ' || text, chr(10) order by turn)) as hash from conversations group by conv_id",
    "topic_selection": "select ord, name, n_nationkey::bigint as n_nationkey from (values (0::bigint, 'NATION_3'), (1, 'NATION_1'), (2, 'NATION_3')) a(ord, name) join nation on n_name = name",
    "passage_contained": "select item_id, count(*) as documents from (select item_id, C1 as probe from benchmark) b join (select C1 as blob from documents) d on length(probe) >= 15 and contains(blob, left(probe, 40)) group by item_id".replace("C1", CONTENT),
    "section_lengths": "select doc_id, count(*) as units, cast(sum(length(u)) as bigint) as chars from (select doc_id, string_agg(line, chr(10) order by pos) as u from (select doc_id, pos, line, sum(case when regexp_matches(line, '^#{1,6}\\s') or regexp_full_match(trim(line), '\\*\\*.+\\*\\*') then 1 else 0 end) over (partition by doc_id order by pos) as unit from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents)) group by doc_id, unit) where trim(u) <> '' group by doc_id",
    "page_title": f"select page_id, trim(split_part({ENTITIES.format(x='''regexp_extract(html, '<title>([^<]*)</title>', 1)''')}, '|', 1)) as title from pages",
}

UNITS = SQL["section_lengths"].split("from (", 1)[1].removesuffix(" where trim(u) <> '' group by doc_id").removesuffix(")")
LONG = f"select doc_id, list_sort(list(length(u)))[cast(least(count(*) - 1, floor(count(*) * 0.95)) as bigint) + 1] as x from ({UNITS}) where trim(u) <> '' group by doc_id"
SQL |= {
    "file_link_flag": f"select page_id, count(*) as links, cast(sum(case when regexp_matches(href, '\\.(pdf|docx?|xlsx?|pptx?|zip|csv|txt|rtf|odt|ods)($|[?#])', 'i') then 1 else 0 end) as bigint) as files from ({SQL['page_links']}) group by page_id union all select page_id, 0, 0 from pages where page_id not in (select page_id from ({SQL['page_links']}))",
    "document_chunks": f"select doc_id, {PARAMS.format(x='x')} as max_characters, cast(greatest(50, least(200, round_even({PARAMS.format(x='x')} * 0.1 / 50, 0) * 50)) as bigint) as overlap from (select d.doc_id, coalesce(p.x, length(text)) as x from documents d left join ({LONG}) p using (doc_id))",
    "blank_lines": "select doc_id, count(*) as lines, cast(sum(case when trim(regexp_replace(trim(line), '^\\s*([-*•]|[0-9]+[.)])\\s*', '')) = '' then 1 else 0 end) as bigint) as blank from (select doc_id, unnest(case when text like '%' || chr(10) then string_split(text, chr(10))[:-2] else string_split(text, chr(10)) end) as line from documents where text <> '') group by doc_id",
}

# pages as trees: the strings between tags, the title and the links
ALL_ENTITIES = "replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&nbsp;', chr(160))"
STRINGS = f"select page_id, string_agg(t, chr(10) order by k) as body from (select page_id, trim({ENTITIES.format(x=ALL_ENTITIES.format(x='t'))}, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) as t, k from (select page_id, unnest(parts) as t, generate_subscripts(parts, 1) as k from (select page_id, string_split_regex(regexp_replace(regexp_replace(html, '(?si)<(script|style|noscript)[ >].*?</(script|style|noscript)>', '<c>', 'g'), '(?s)<!--.*?-->', '<c>', 'g'), '<[^>]*>') as parts from pages))) where t <> '' group by page_id"
TREES = f"select p.page_id, p.url, t.title, coalesce(s.body, '') as body, coalesce(l.links, '') as links from pages p join ({SQL['page_title']}) t using (page_id) left join ({STRINGS}) s using (page_id) left join (select page_id, string_agg('- [' || text || '](' || href || ')', chr(10) order by n) as links from ({SQL['page_links']}) group by page_id) l using (page_id)"
NONE = "files: null, contacts: null, faqs: null"
PAGE_JSON = "to_json([{{url: url, title: title, blocks: [{{heading: {h}, segments: [{{subheading: 'Text', text: {body}, " + NONE + "}}, {{subheading: 'Links', text: {links}, " + NONE + "}}]}}]}}])"
OF_PAGE = "count(*) filter (m like '{what}%')"
SQL |= {
    "page_markdown": f"select page_id, case when title <> '' then '# ' || title || chr(10) || chr(10) else '' end || '*URL: ' || url || '*' || chr(10) || chr(10) || '## ' || trim(regexp_replace(title, '^#+', '')) || chr(10) || chr(10) || '### Text' || chr(10) || chr(10) || case when body <> '' then body || chr(10) || chr(10) else '' end || '### Links' || chr(10) || chr(10) || case when links <> '' then links || chr(10) || chr(10) else '' end || '---' || chr(10) as md from ({TREES})",
    "page_metrics": f"select page_id::varchar as topic, 1::bigint as pages, 0::bigint as faqs, 0::bigint as files, length({PAGE_JSON.format(h='title', body='body', links='links')})::bigint as chars from ({TREES})",
    "page_extracts": f"select p.page_id, t.title, (len(regexp_extract_all(html, '<details[ >]')) + len(regexp_extract_all(html, 'class=\"[^\"]*accordion-item')))::int as questions, (case when html like '%<details%' or html like '%accordion-item%' then 1 else 0 end)::int as qa_groups, len(regexp_extract_all(html, 'href=\"tel:'))::int as phones, coalesce(least(f.files, 1), 0)::int as file_groups, len(regexp_extract_all(html, '<h2[ >]'))::int as sections from pages p join ({SQL['page_title']}) t using (page_id) left join ({SQL['file_link_flag']}) f using (page_id)",
    # what the page shows is what the tree holds already: its own title replaces the captured one, blank texts become null
    "enriched_pages": f"select 'page ' || page_id as topic, 1::bigint as pages, 0::bigint as faqs, 0::bigint as files, length({PAGE_JSON.format(h='title', body='nullif(body, {empty})', links='nullif(links, {empty})')})::bigint as chars from ({TREES})".replace("{empty}", "''"),
    "strip_markup": "select page_id, sha256(coalesce(string_agg(line, chr(10) order by k), '')) as hash from (select page_id, k, line from (select page_id, unnest(string_split(html, chr(10))) as line, generate_subscripts(string_split(html, chr(10)), 1) as k from pages)) where not (regexp_matches(lower(trim(line)), '<\\s*/?\\s*(?:script|style|link|meta|head|body|html|!)') or lower(trim(line)) like '[if %' or contains(lower(line), 'endif]')) group by page_id",
    "label_resolution": f"with asked as (select page_id, url as base, label_pos, label, lower(label) as l from pages, (values (0, 'about'), (1, 'Home'), (2, 'contact us now'), (3, 'x')) v(label_pos, label)), met as (select a.*, n, href, case when text = l then 1 end as t1, case when contains(text, l) then 2 end as t2, case when contains(l, text) and length(text) >= 8 then 3 end as t3 from asked a join ({SQL['page_links']}) k using (page_id)), tiers as (select *, unnest([t1, t2, t3]) as tier from met), firsts as (select page_id, base, label_pos, label, tier, arg_min(href, n) as href from tiers where tier is not null group by all), best as (select page_id, base, label_pos, label, arg_min(href, tier) as href from firsts where href <> '' group by all) select page_id, label_pos, label, case when regexp_matches(href, '^https?://') then href when href like '/%' then regexp_extract(base, '^https?://[^/]+') || href else regexp_extract(base, '^(https?://[^?#]*/)', 1) || href end as url from best",
}
# pages whose every line is markup are left with nothing
SQL["strip_markup"] = f"select p.page_id, coalesce(s.hash, sha256('')) as hash from pages p left join ({SQL['strip_markup']}) s using (page_id)"

TAGS = "len(regexp_extract_all({x}, '<{tag}[ >]'))"
NAV, ARTICLE = "regexp_extract(h, '(?s)<nav>.*?</nav>')", "regexp_extract(h, '(?s)<article>.*?</article>')"
CLEAN = "select page_id, regexp_replace(html, '(?s)<(script|style)>.*?</(script|style)>', '', 'g') as h from pages"
SQL |= {
    "knowledge_index_search": SQL["knowledge_search"],
    "inside_elements": f"select page_id, {TAGS.format(x=NAV, tag='a')} as nav_links, {TAGS.format(x=ARTICLE, tag='p')} as article_p, {TAGS.format(x='h', tag='p')} - {TAGS.format(x=ARTICLE, tag='p')} as other_p from ({CLEAN})",
    "enclosing_elements": f"select page_id, n as held, 1::bigint as deepest from (select page_id, list_sum(list_transform(regexp_extract_all(h, '(?s)<ul>.*?</ul>'), lambda u: {TAGS.format(x='u', tag='li')} + {TAGS.format(x='u', tag='a')}))::bigint as n from ({CLEAN})) where n > 0",
}

# lines as headings, panels and sections; the first half of a document as what its tree holds
LINES = "select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents"
HALF = f"select doc_id, {CONTENT} as blob, regexp_replace(text, '[^0-9]', '', 'g') as digits from (select doc_id, left(text, length(text) // 2) as text from documents)"
MARKED = f"select doc_id, pos // 3 as block, pos % 3 - 1 as segment, {NORM.format(x='h')} as h from (select *, case when (doc_id + pos) % 11 = 0 then 'Öffnungszeiten ' when (doc_id + pos) % 5 = 0 then 'Kontakt ' else '' end || line as h from ({LINES}))"
PROSE = SQL["prose_flag"].split(" as prose")[0].removeprefix("select doc_id, ")
WEEKDAYS = "['Montag', 'Dienstag', 'Mittwoch', 'Donnerstag', 'Freitag', 'Samstag', 'Sonntag']"
SQL |= {
    "heading_places": f"with l as (select doc_id, pos, {NORM.format(x='line')} as h, {NORM.format(x='left(line, 20)')} as asked, count(*) over (partition by doc_id, pos // 3) - 1 as segments from ({LINES})), met as (select a.doc_id, a.pos as ord, p.pos // 3 as block, case when p.pos % 3 = 0 then p.segments else p.pos % 3 end as insert_at, row_number() over (partition by a.doc_id, a.pos order by case when a.asked = p.h then 0 else 2 end + case when p.pos % 3 = 0 then 1 else 0 end, p.pos) as k from l a join l p using (doc_id) where a.asked <> '' and p.h <> '' and (a.asked = p.h or (contains(p.h, a.asked) and length(a.asked) >= 8) or (contains(a.asked, p.h) and length(p.h) >= 8))) select l.doc_id, l.pos as ord, coalesce(block, -1) as block, coalesce(insert_at, -1) as insert_at from l left join met on met.doc_id = l.doc_id and met.ord = l.pos and k = 1",
    "missing_answers": f"select doc_id, pos from (select doc_id, pos, {CONTENT} as a from (select doc_id, pos, line as text from ({LINES}))) join ({HALF}) using (doc_id) where not (length(a) >= 15 and contains(blob, left(a, 40)))",
    "missing_phones": f"select doc_id, pos, key from (select doc_id, pos, case when d like '49%' then substr(d, 3) when d like '0%' then substr(d, 2) else d end as key from (select doc_id, generate_subscripts(m, 1) - 1 as pos, regexp_replace(unnest(m), '[^0-9]', '', 'g') as d from (select doc_id, regexp_extract_all(text, '\\+?[0-9][0-9() .-]+[0-9]') as m from documents))) join ({HALF}) using (doc_id) where not contains(digits, key)",
    "missing_sections": f"select doc_id, pos from (select doc_id, pos, left({CONTENT}, 60) as probe, {PROSE} as prose from (select doc_id, pos, text, trim(regexp_replace(regexp_replace(text, '[^\\s]*/[^\\s]*', ' ', 'g'), '{BLANKS.format()}', ' ', 'g')) as c from (select doc_id, pos, line as text from ({LINES})))) join ({HALF}) using (doc_id) where prose and pos % 4 <> 1 and not (probe <> '' and contains(blob, probe))",
    "section_places": f"with n as (select doc_id, pos, {NORM.format(x='left(line, 20)')} as n from ({LINES})), hit as (select n.doc_id, pos, min(block) as b from n join ({MARKED}) m on m.doc_id = n.doc_id and segment = -1 and n <> '' and contains(h, n) group by n.doc_id, pos) select n.doc_id, n.pos, coalesce(last_value(b ignore nulls) over (partition by n.doc_id order by n.pos rows between unbounded preceding and 1 preceding), -1) as insert_after from n left join hit on hit.doc_id = n.doc_id and hit.pos = n.pos",
    "contact_block": f"select doc_id, coalesce(min(block) filter (regexp_matches(h, 'kontakt|erreichen|kunden-?center|servicecenter')), max(block)) as block from ({MARKED}) where segment = -1 group by doc_id",
    "hours_block": f"select doc_id, coalesce(min(block) filter (contains(h, 'öffnungszeit')), min(block) filter (segment = -1 and regexp_matches(h, 'kontakt|erreichen')), max(block)) as block from ({MARKED}) group by doc_id",
    "hours_missing": f"select doc_id, len(list_filter({WEEKDAYS}, lambda d: contains(t, lower(d)))) < 3 as missing, doc_id % 7 as named from (select doc_id, lower(concat_ws(' ', text, array_to_string({WEEKDAYS}[1:doc_id % 7], ' '))) as t from documents)",
}


NAMES += built_pages.NAMES
SQL |= built_pages.SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: globals().get(name) or getattr(built_pages, name) for name in NAMES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
