import pytest
from pyspark.sql import functions as F

from docloom.operators import extract, match
from docloom.sources.dom import node_table, nodes

PAGE = """<html><head><title>Heat &amp; Power | Town Works</title><style>h2{}</style></head><body>
<h1>Heat</h1><!-- no text -->
<h2>Tariffs</h2><p>Our tariffs are simple and fair for everyone in town. Ask us.</p>
<a href="/a.pdf">Price list</a> <a href="/a.pdf?x=1">Price list</a> <a href="/b.XLSX#s">Sheet</a><a href="/c.pdf"> </a><a href="/page">More</a>
<h3>Old</h3><a href="/old.zip">Archive</a>
<h2>Questions</h2>
<div class="accordion-item x"><h3><button class="accordion-button">When do you open?</button></h3><div class="accordion-collapse collapse">At nine.<table><tr><th>Day</th><th>Time</th></tr><tr><td>Mon</td></tr></table></div></div>
<div class="accordion-item"><button class="accordion-button">Empty</button><div class="accordion-collapse"></div></div>
<div class="accordion-item"><button class="accordion-button">Who pays?</button><div class="accordion-collapse"> who PAYS? </div></div>
<details><summary>Where?</summary>In the <b>old</b> town.</details>
<h2 style="display: none">Hidden</h2><p>Nobody sees this long text, which is here all the same.</p>
<h2>Contact</h2><strong>Hotline</strong><a href="tel:+49715113100">07151 131-00</a><a href="tel:07151 13100">again</a><a href="TEL:0800-1"></a>
<dl><dt>Montag</dt><dd>8 - 12</dd><dt>Dienstag</dt><dd>8 -
 16</dd><dt>Feiertag</dt><dd>zu</dd><dt>Freitag</dt><dd>8</dd></dl>
<script>var x = "<h2>Not here</h2>";</script>
"""


@pytest.fixture(scope="module")
def table(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>unclosed <b>bold <i>x</p> y"), (3, None), (4, "")], "page_id long, html string")
    return node_table(pages, "html", "page_id").cache()


def rows(df, *cols):
    return [tuple(r) for r in df.where("page_id = 1").select(*cols).collect()]


def found(nodes, kind, *fields):
    """What was found of one kind on page 1."""
    value = extract.all_extracts(nodes, ["page_id"]).where("page_id = 1").first()["extracts"][kind]
    return [tuple(x[f] for f in fields) for x in value or []] if fields else value


def test_title_uses_text_before_the_pipe(table):
    assert rows(extract.titles(table, ["page_id"]), "title") == [("Heat & Power",)]


def test_title_falls_back_to_h1(spark):
    t = node_table(spark.createDataFrame([(1, "<title> </title><h1>A <i>b</i></h1>"), (2, "<p>x")], "page_id long, html string"), "html", "page_id")
    assert sorted(tuple(r) for r in extract.titles(t, ["page_id"]).collect()) == [(1, "A b"), (2, "")]


def test_file_groups_follow_headings_and_names_count_once(table):
    assert found(table, "file_groups", "heading", "files") == [("Tariffs", ["Price list", "Sheet"]), ("Old", ["Archive"])]


def test_a_heading_that_comes_back_opens_a_new_group(spark):
    html = "<h2>A</h2><a href=1.pdf>x</a><h2>B</h2><a href=2.pdf>y</a><h2>A</h2><a href=3.pdf>z</a>"
    t = node_table(spark.createDataFrame([(1, html)], "page_id long, html string"), "html", "page_id")
    assert found(t, "file_groups", "heading", "files") == [("A", ["x"]), ("B", ["y"]), ("A", ["z"])]
    names = extract.all_extracts(t, ["page_id"]).select(extract.file_names(F.col("extracts"))).first()[0]
    assert names == ["x", "y", "z"]


def test_questions_with_tables_and_without_echoes(table):
    assert [(h, [(q["question"], q["answer"]) for q in qas]) for h, qas in found(table, "qa_groups", "heading", "qas")] == [("Questions", [("When do you open?", "At nine.\n\n| Day | Time |\n| --- | --- |\n| Mon |  |"), ("Where?", "In the\nold\ntown.")])]


def test_groups_merge_by_heading_and_repeat_across(spark):
    item = '<div class="accordion-item"><button class="accordion-button">{}</button><div class="accordion-collapse">{}</div></div>'
    html = "<h2>A</h2>" + item.format("Data", "one") + "<h2>B</h2>" + item.format("Data", "two") + "<h2>A</h2>" + item.format("More", "three") + item.format("data", "four")
    t = node_table(spark.createDataFrame([(1, html)], "page_id long, html string"), "html", "page_id")
    assert [(h, [q["answer"] for q in qas]) for h, qas in found(t, "qa_groups", "heading", "qas")] == [("A", ["one", "three"]), ("B", ["two"])]
    assert sorted(found(t, "questions")) == ["data", "more"]


def test_nested_tables_are_flattened_and_leave_the_inner_panel():
    html = '<div class="accordion-item"><button class="accordion-button">Q</button><div class="accordion-collapse"><table><tr><td>a<table><tr><td>b</td></tr></table></td></tr></table><details><summary>S</summary><table><tr><td>c</td></tr></table>d</details></div></div>'
    panels = [(n["question"], n["answer"]) for n in nodes(html) if n["kind"] == "panel"]
    assert panels == [("Q", "S\nd\n\n| a b | b |\n| --- | --- |\n| b |  |\n\n| c |\n| --- |"), ("S", "d")]


def test_phones_by_key_with_label(table):
    assert found(table, "phones", "label", "phone", "key") == [("Hotline", "07151 131-00", "715113100"), ("Hotline", "0800-1", "8001")]


def test_opening_hours_need_three_weekdays(table, spark):
    assert found(table, "hours") == "- Montag: 8 - 12\n- Dienstag: 8 - 16\n- Freitag: 8"
    two = node_table(spark.createDataFrame([(1, "<dl><dt>Montag<dd>8<dt>Dienstag</dl>")], "page_id long, html string"), "html", "page_id")
    assert found(two, "hours") is None


def test_sections_skip_accordions_and_hidden(table):
    sections = found(table, "sections", "heading", "text")
    assert [h for h, _ in sections] == ["Tariffs", "Contact"]
    assert sections[0][1].startswith("Our tariffs are simple") and "no text" not in sections[0][1]


def test_broken_html_null_and_empty_pages(table):
    counts = {r["page_id"]: r["n"] for r in table.groupBy("page_id").count().withColumnRenamed("count", "n").collect()}
    assert 2 in counts and 3 not in counts and 4 not in counts


def test_all_extracts_in_one_row_a_page(table):
    every = {r["page_id"]: r["extracts"] for r in extract.all_extracts(table, ["page_id"]).collect()}
    assert set(every) == {1, 2} and every[1]["questions"] and every[2]["qa_groups"] is None
    assert every[1]["error"] is None


def test_label_resolution_tiers_and_empty_href(spark):
    links = spark.createDataFrame([(1, 1, "heating", "/x"), (1, 2, "district heating plans", "/y"), (1, 3, "district", "/z"), (1, 4, "all offers", "/o"), (1, 5, "offers", "")], "page_id int, pos int, text string, href string")
    labels = spark.createDataFrame([(1, 0, "District  heating", "http://a/b/"), (1, 1, "district heating network", "http://a/b/"), (1, 2, "Offers", "http://a/b/"), (1, 3, "nothing", "http://a/b/")], "page_id int, label_pos int, label string, base_url string")
    urls = [(r["label_pos"], r["url"]) for r in match.resolve_labels(labels, links, ["page_id"]).orderBy("label_pos").collect()]
    assert urls == [(0, "http://a/y"), (1, "http://a/z"), (2, "http://a/o")]


def test_references_need_their_semicolon(spark):
    html = '<title>A &amp; B&amp</title><a href="/x?a=1&copy=2&amp;b=&lt">&ltx &nosuch; &#65; &#65 &auml;&ampauml;</a><!-- &amp --><iframe>a & b</iframe>'
    t = node_table(spark.createDataFrame([(1, html)], "page_id long, html string"), "html", "page_id")
    assert rows(extract.titles(t, ["page_id"]), "title") == [("A & B&amp",)]
    assert rows(t.where("kind = 'link'"), "text", "href") == [("&ltx &nosuch; A &#65 ä&ampauml;", "/x?a=1&copy=2&b=&lt")]
    assert rows(t.where("kind = 'string'").orderBy("pos"), "text")[-1] == ("a & b",)
    assert nodes("﷐ &amp; &amp <b>&lt;</b>")[0]["text"] == "﷐ & &amp"


def test_rows_are_python_objects_a_slice_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    from docloom.functions import rows as R

    long = pa.array(["x" * 100_000] * 50)
    assert {len(p[0]) for p in R.sliced((long,))} == {10} and sum(len(p[0]) for p in R.sliced((long, long))) == 50
    assert max(len(p[0]) for p in R.sliced((pa.array(range(1000)),))) == R.SLICE_ROWS
    table = spark.range(0, 1000, 1, 2).select("id", R.by_row(lambda a, b: [a, b], "array<long>", F.col("id"), F.col("id") + 1).alias("v"), R.by_row(lambda a: None if a % 3 else str(a), "string", F.col("id")).alias("s"))
    assert [tuple(r) for r in table.orderBy("id").collect()] == [(k, [k, k + 1], None if k % 3 else str(k)) for k in range(1000)]


def test_parts_grow_with_the_pages(spark):
    docs = spark.createDataFrame([(k, "<h2>A</h2><p>" + "ä" * (extract.TASK_BYTES // 4) + "</p>") for k in range(6)] + [(9, None)], "page_id long, html string")
    parts = extract.page_partitions(docs, "html")
    assert parts == 4 and extract.page_partitions(docs.limit(0), "html") == 1
    made = extract.all_extracts(node_table(docs, "html", "page_id"), ["page_id"], parts)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "page_id" in plan and f", {parts}), REPARTITION_BY_NUM" in plan and plan.count("Exchange") == 1
    assert [r[0] for r in made.orderBy("page_id").select("page_id").collect()] == list(range(6))
