import random

import pytest
from pyspark.sql import functions as F

from docloom import schema
from docloom.functions import text as tx
from docloom.operators import extract, match, merge, placement
from docloom.operators.render import markdown
from docloom.plans.topics import enrich, quarantine
from docloom.schema import TREE
from docloom.sources import dom

ITEM = '<div class="accordion-item"><button class="accordion-button">{}</button><div class="accordion-collapse">{}</div></div>'


def seg(**k):
    return dict.fromkeys(("subheading", "text", "files", "contacts", "faqs")) | k


def page(*blocks, url="http://t/p"):
    return {"url": url, "title": None, "blocks": [{"heading": h, "segments": list(s)} for h, *s in blocks]}


def run(spark, pages, html, topic="t"):
    trees = spark.createDataFrame([(topic, "http://t", pages)], f"topic string, {TREE}")
    fetched = spark.createDataFrame([("http://t/p", html)], "url string, html string")
    return enrich(trees, fetched).first().asDict(recursive=True)["pages"]


def shape(p):
    return [(b["heading"], [{k: v for k, v in s.items() if v is not None} for s in b["segments"]]) for b in p["blocks"]]


def test_question_already_captured_is_not_added_twice(spark):
    answer = "We open at nine o'clock on every working day."
    got = run(spark, [page(("Questions", seg(text=f"When?\n{answer}")))], "<title>T</title><h2>Questions</h2>" + ITEM.format("When?", answer) + ITEM.format("Short", "no"))
    assert got[0]["title"] == "T"
    assert shape(got[0]) == [("Questions", [{"text": answer}, {"faqs": {"title": None, "QAs": [{"question": "Short", "answer": "no"}]}}])]


def test_label_alone_does_not_suppress_content(spark):
    got = run(spark, [page(("Works", seg(subheading="Current sites", text="see below")))], "<h2>Works</h2>" + ITEM.format("Current sites", "Main street until the end of May."))
    assert shape(got[0])[0][1][0] == {"text": "see below"}
    assert got[0]["blocks"][0]["segments"][1]["faqs"]["QAs"][0]["answer"] == "Main street until the end of May."


def test_files_replace_stale_ones_and_keep_a_more_specific_title(spark):
    html = "<h2>Downloads for supply</h2><a href=/a.pdf>New list</a><h2>Other things</h2><a href=/b.pdf>Second</a>"
    got = run(spark, [page(("Downloads", seg(files="stale")), ("Supply", seg(text="Text stays here.")))], html)
    assert shape(got[0]) == [("Supply", [{"text": "Text stays here."}]), ("Downloads for supply", [{"files": "New list"}]), ("Other things", [{"files": "Second"}])]
    more = run(spark, [page(("for supply", seg(text="Text.")))], html)
    assert shape(more[0])[0] == ("for supply", [{"text": "Text."}, {"subheading": "Downloads for supply"}, {"files": "New list"}])


def test_two_groups_at_one_subheading_flip(spark):
    html = "<h3>Grid connection</h3><a href=1.pdf>one</a><h3>Other grid</h3><a href=2.pdf>two</a><h3>Grid connection</h3><a href=3.pdf>three</a>"
    got = run(spark, [page(("B", seg(subheading="Grid connection"), seg(text="end")))], html)
    assert [s.get("files") or s.get("subheading") or s.get("text") for s in shape(got[0])[0][1]] == ["Grid connection", "three", "one", "end"]


def test_phones_and_hours_go_to_their_blocks(spark):
    html = "<strong>Desk</strong><a href=tel:071511>07151 1</a><a href=tel:0800>0800 55</a><dl><dt>Montag</dt><dd>8</dd><dt>Dienstag</dt><dd>9</dd><dt>Freitag</dt><dd>7</dd></dl>"
    got = run(spark, [page(("Kontakt", seg(text="Call +49 7151 1 now.")), ("Last", seg(text="x")))], html)
    assert shape(got[0])[0][1][1:] == [{"contacts": "Desk: 0800 55"}, {"subheading": "Öffnungszeiten", "text": "- Montag: 8\n- Dienstag: 9\n- Freitag: 7"}]
    assert shape(run(spark, [page()], html)[0]) == []


def test_prose_is_recovered_in_order(spark):
    html = "<h2>First</h2><p>Short.</p><h2>Second part</h2><p>This is a long enough sentence to be recovered by the engine.</p><h2>Downloads</h2><p>This is another long enough sentence, but a file section.</p>"
    got = run(spark, [page(("First", seg(text="a")), ("Third", seg(text="b")))], html)
    assert [b["heading"] for b in got[0]["blocks"]] == ["First", "Second part", "Third"]


def test_pages_without_url_or_fetch_stay_untouched(spark):
    dirty = page(("H", seg(text="- ")), url="")
    other = page(("H", seg(text="<script>")), url="http://t/missing")
    assert run(spark, [dirty, other], "<h2>x</h2>") == [dirty, other]


def test_pruning(spark):
    got = run(spark, [page(("A", seg(text="<link rel=x>\n[if lt IE 9]>"), seg(text=" - \n2. ")), ("B", seg(text="keep\n<!-- x")))], "<p>x")
    assert shape(got[0]) == [("B", [{"text": "keep"}])]


def test_topics_without_pages_stay(spark):
    trees = spark.createDataFrame([("t", "u", []), ("n", "u", None)], f"topic string, {TREE}")
    assert {r["topic"]: r["pages"] for r in enrich(trees, spark.createDataFrame([], "url string, html string")).collect()} == {"t": [], "n": None}


def linear(p, heading):
    """Where a heading leads by looking at every place of a page."""
    wanted = placement.squeeze(heading)
    places = []
    for k, b in enumerate(p.blocks):
        places += [(0, k, n + 1, placement.squeeze(s.subheading)) for n, s in enumerate(b.segments)]
        places.append((1, k, len(b.segments), placement.squeeze(b.heading)))
    ranked = [(level + (0 if name == wanted else 2), n, k, at) for n, (level, k, at, name) in enumerate(places) if placement.match(name, wanted)]
    return min(ranked)[2:] if ranked else None


def test_index_agrees_with_looking_at_every_place_while_a_page_grows():
    words = ["grid", "Grid connection", "grid connection terms", "Offers", "offers for all", "", None, "heat", "Downloads grid connection", "all", "al"]
    rng = random.Random(3)
    for _ in range(300):
        work = placement.Page(page(*[(rng.choice(words), *[seg(subheading=rng.choice(words), text=rng.choice([None, "x"])) for _ in range(rng.randint(0, 3))]) for _ in range(rng.randint(0, 3))]))
        for _ in range(12):
            wanted = rng.choice(words)
            found = work.locate(wanted)
            assert (found and (work.blocks.index(found[0]), found[1])) == linear(work, wanted)
            part = placement.squeeze(rng.choice(words))
            assert work.index.block_with(part) is next((b for b in work.blocks if part and part in placement.squeeze(b.heading)), None)
            before = next((b for name in reversed(work.trail) if name for b in work.blocks if name in placement.squeeze(b.heading)), None)
            assert work.block_before() is before
            work.trail.append(part)
            step = rng.randrange(4)
            if step == 0 and work.blocks:
                block = rng.choice(work.blocks)
                work.put(block, rng.randint(0, len(block.segments)), placement.Segment(subheading=rng.choice(words)), placement.Segment(text="t"))
            elif step == 1:
                work.open_block(rng.choice(words), placement.Segment(subheading=rng.choice(words)), rng.choice([None, 0, len(work.blocks)]))
            elif step == 2:
                work.release_files()


def test_labels_survive_many_insertions_at_one_place():
    work = placement.Page(page(("A", seg(subheading="first"), seg(subheading="last"))))
    for n in range(200):
        work.put(work.blocks[0], 1, placement.Segment(subheading=f"number {n}"))
        work.open_block(f"block {n}", placement.Segment(), 1)
    for items in (work.blocks, work.blocks[0].segments):
        labels = [x.label for x in items]
        assert labels == sorted(set(labels))
    assert [work.locate(f"number {n}")[1] for n in (199, 0)] == [2, 201]


def test_questions_to_a_page(spark):
    tree = page(("Intro",), ("Kontakt", seg(subheading="Öffnungszeiten heute"), seg(text="montag dienstag")), ("End",))
    df = spark.createDataFrame([(1, tree, ["Intro", "Nowhere", "More"]), (2, page(), ["x"]), (3, None, ["x"])], f"id int, page {schema.PAGE}, asked array<string>")
    rows = {r["id"]: r for r in df.select("id", merge.chosen(F.col("page")).alias("c"), merge.followed(F.col("page"), F.col("asked")).alias("f"), merge.located(F.col("page"), F.col("asked")).alias("l")).collect()}
    assert rows[1]["c"]["value"].asDict() == {"contact": 1, "hours": 1, "lacks_hours": True} and rows[1]["f"]["value"] == [None, 0, 0]
    assert [tuple(x) for x in rows[1]["l"]["value"]] == [(0, 0), (None, None), (None, None)]
    assert rows[2]["c"]["value"].asDict() == {"contact": None, "hours": None, "lacks_hours": True} and rows[3]["c"] is None


def test_a_page_that_breaks_is_put_in_quarantine(spark):
    def place(page, extracts):
        if "break" in page["url"]:
            raise RecursionError("too deep")
        return placement.place(page, extracts)

    pages = [page(("A", seg(text="- ")), url=f"http://t/{n}") for n in ("one", "break", "two")]
    trees = spark.createDataFrame([("t", "u", pages), ("other", "u", [page(("B", seg(text="b")), url="http://t/one")]), ("none", "u", None)], f"topic string, {TREE}")
    fetched = spark.createDataFrame([(p["url"], "<title>New</title><h2>Long enough</h2><p>A sentence that is long enough to be placed here.</p>") for p in pages], "url string, html string")
    made = enrich(trees, fetched, place).cache()
    got = {r["topic"]: r.asDict(recursive=True)["pages"] for r in made.collect()}
    assert [p["title"] for p in got["t"]] == ["New", None, "New"] and got["t"][1] == pages[1] and got["other"][0]["title"] == "New" and got["none"] is None
    assert [tuple(r) for r in quarantine(made).collect()] == [("t", 1, "http://t/break", "merge", "RecursionError: too deep")]


def test_a_page_that_cannot_be_parsed_is_put_in_quarantine(spark):
    broken = [dom.NODE | {"pos": 0, "end_pos": 0, "depth": 0, "parent_pos": 0, "kind": "error", "tag": "", "text": "ValueError: no"}]
    nodes = spark.createDataFrame([("t", 0, broken), ("t", 1, dom.nodes("<title>T</title>"))], f"topic string, page_ord int, nodes {schema.NODES}").select("topic", "page_ord", F.inline("nodes"))
    found = {r["page_ord"]: r["extracts"] for r in extract.all_extracts(nodes, ["topic", "page_ord"]).collect()}
    assert found[0]["error"] == "ValueError: no" and found[1]["error"] is None and found[1]["title"] == "T"


def test_parser_errors_are_nodes(monkeypatch):
    monkeypatch.setattr(dom, "parse", lambda html: 1 / 0)
    assert [(n["kind"], n["text"]) for n in dom.nodes("<p>")] == [("error", "ZeroDivisionError: division by zero")] and dom.nodes(None) is None


def test_markdown_worked_example(spark):
    pages = [{"url": "u", "title": None, "blocks": [{"heading": "## A", "segments": [seg(subheading="### S", text="x"), seg(faqs={"title": "t", "QAs": [{"question": "q", "answer": "a"}]}, files="f", contacts="c")]}]}]
    df = spark.createDataFrame([(pages,), ([],), (None,)], f"pages array<{schema.PAGE}>")
    assert [r["md"] for r in df.select(markdown(F.col("pages")).alias("md")).collect()] == ["*URL: u*\n\n## A\n\n### S\n\nx\n\nf\n\n**q**\n\na\n\nc\n\n---\n", "", ""]


@pytest.mark.parametrize(("phone", "key"), [("+49 7151 131-0", "71511310"), ("07151 131-0", "71511310"), ("0049 7151 1310", "04971511310"), ("+49 (0)7151 1310", "071511310"), ("", ""), (None, "")])
def test_phone_key(spark, phone, key):
    assert spark.createDataFrame([(phone,)], "p string").select(tx.phone_key(F.col("p"))).first()[0] == key


def test_text_functions(spark):
    row = spark.createDataFrame([("  A\n\tB ", "a--b | c", "x\ny\n", None)], "a string, b string, c string, n string").select(
        tx.norm(F.col("a")), tx.content_norm(F.col("b")), tx.lines(F.col("c")), tx.norm(F.col("n")), tx.strip(F.col("a")), tx.strip_hashes(F.lit("## x ")), tx.lines(F.lit("")), tx.is_blank_text(F.col("n")), tx.looks_like_prose(F.lit("a/b " * 30 + "."))
    )
    assert list(row.first()) == ["a b", "a b c", ["x", "y"], "", "A\n\tB", "x", [], True, False]


def test_pages_are_parsed_and_moved_once(spark):
    from docloom import registry

    for name in ("page_extracts", "page_markdown", "page_metrics", "file_link_flag", "page_title"):
        plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and plan.count("Exchange") == 1, name
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BatchEvalPython" not in registry.queries()["enriched_pages"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_present_answers_by_automaton_and_by_join(spark):
    answers = spark.createDataFrame([(1, "exactly14chars"), (2, "fifteen chars xx"), (3, "fifteen chars xx"), (4, "not there at all, is it")], "item int, answer string")
    blobs = spark.createDataFrame([(1, "exactly14chars and fifteen chars xx"), (2, "nothing"), (3, None), (4, "")], "doc int, blob string")
    for most in (100, 1):
        assert sorted(tuple(r) for r in match.present_answers(answers, blobs, "item", "doc", most).collect()) == [(2, 1), (3, 1)]


def test_parts_of_names_are_indexed_when_they_are_asked_for():
    from docloom.operators import placement

    page = {"url": "", "title": "", "blocks": [{"heading": f"Kontakt {k}", "segments": []} for k in range(50)]}
    work = placement.Page(page)
    assert work.contact_block() is work.blocks[0] and work.locate("Kontakt 7")[0] is work.blocks[7] and not work.index.grams
    assert work.locate("Kontakt 4")[0] is work.blocks[4] and work.locate("akt 49 und") is None and work.locate("ntakt 49")[0] is work.blocks[49]
    assert work.index.grams and not work.index.unread
    work.open_block("Neue Abteilung", placement.Segment())
    assert work.locate("Abteilung")[0] is work.blocks[50] and work.locate("die neue Abteilung hier")[0] is work.blocks[50]
    assert placement.squeeze_content("a---b -c|d") == "a b -c d" and not placement.is_prose("x" * 50 + "/. " + "y" * 39)
