"""Questions of structure, the gram index, incremental enriching and topic state, each against the plain way."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from docloom import schema
from docloom.operators import knowledge, monitor, search, structure
from docloom.plans import incremental, topics
from docloom.sources.dom import element_table, parse
from docloom.streaming.topic_state import compared, watch_topics

SEGMENT = dict.fromkeys(("subheading", "text", "files", "contacts", "faqs"))


def nested(rng, depth=0):
    if depth > 5 or rng.random() < 0.2:
        return "text"
    made = []
    for _ in range(rng.randint(1, 3)):
        tag, name = rng.choice(["div", "p", "ul", "li", "section"]), rng.choice(["", ' class="a"', ' class="b a"'])
        made.append(f"<{tag}{name}>{nested(rng, depth + 1)}" + (f"</{tag}>" if rng.random() < 0.8 else ""))
    return "".join(made)


def test_inside_and_enclosing_equal_walking_the_tree(spark):
    rng = random.Random(4)
    htmls = [nested(rng) for _ in range(25)] + ["", "no tags", "<br><p>x"]
    pages = spark.createDataFrame([(f"k{i}", i, h) for i, h in enumerate(htmls)] + [("none", 99, None)], "name string, page_id long, html string")
    nodes = element_table(pages, "html", "name", "page_id")
    questions = {"ul": (F.col("tag") == "ul", lambda e: e.tag == "ul"), "a": (structure.of_class("a"), lambda e: "a" in e.classes)}
    for when, told in questions.values():
        got = {(r["page_id"], r["pos"]): r["inside"] for r in structure.inside(nodes, when, ["name", "page_id"]).collect()}
        pairs = sorted((r["name"], r["page_id"], r["pos"], r["outer"], r["depth"]) for r in structure.enclosing(nodes, when, ["name", "page_id"]).collect())
        want, outer = {}, []
        for i, html in enumerate(htmls):
            for e in parse(html).walk():
                at, held = e.parent, []
                while at is not None and at.parent is not None:
                    held += [at.pos] if told(at) else []
                    at = at.parent
                want[i, e.pos] = bool(held)
                outer += [(f"k{i}", i, e.pos, pos, depth) for depth, pos in enumerate(held, 1)]
        assert got == want and pairs == sorted(outer) and any(want.values())
    plan = structure.inside(nodes, F.col("tag") == "ul", ["page_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan and plan.count("Exchange") == 1


def test_search_index_equals_looking_at_all_rows(spark, tmp_path):
    texts = ["The MIT License", "license: mit", "lic ense", "", "Straße ΟΔΟΣ", "İstanbul 100%", "a_b", "mitmit", "LICENSE " * 50, "licen", "cense lice"]
    table = spark.createDataFrame([(i, f"t{i % 3}", t) for i, t in enumerate(texts)] + [(50, "license", None), (51, None, "x")], schema.KNOWLEDGE)
    knowledge.load(table, str(tmp_path / "k"))
    for word in ("license", "LICENSE", "MIT", "it", "", "%", "a_b", "100%", "straße", "i̇st", "t1", "οδο", "nothing at all"):
        want = sorted(r["id"] for r in knowledge.search_all(table, word).collect())
        assert sorted(r["id"] for r in knowledge.find(spark, str(tmp_path / "k"), word).collect()) == want, word
    few = search.candidates(knowledge.stored(spark, str(tmp_path / "k")), spark.read.parquet(str(tmp_path / "k_grams")), "id", "license")
    assert sorted(r["id"] for r in few.collect()) == [0, 1, 8, 10, 50]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan) and "In(gram, [cen,ens,ice,lic,nse])" in plan
    knowledge.load(table.where("id = 6"), str(tmp_path / "k"))
    assert knowledge.find(spark, str(tmp_path / "k"), "license").count() == 0


def page(url, text):
    return {"url": url, "title": None, "blocks": [{"heading": "H", "segments": [SEGMENT | {"text": text}]}]}


def test_only_changed_pages_are_enriched_again(spark, tmp_path):
    made = lambda *rows: spark.createDataFrame(list(rows), f"topic string, {schema.TREE}")
    html = lambda n: f"<title>T{n}</title><h2>Section {n}</h2><p>A sentence that is long enough to be placed here, number {n}.</p>"
    fetched = lambda *ns: spark.createDataFrame([(f"http://t/{n}", html(f"{n}{v}")) for n, v in ns], "url string, html string")
    trees = made(("a", "u", [page("http://t/1", "x"), page("http://t/2", "y")]), ("b", "u", [page("http://t/1", "z"), page("", "no url")]), ("none", "u", None), ("empty", "u", []))
    key = lambda df: sorted(json.dumps(r.asDict(recursive=True)) for r in df.collect())
    paths = [str(tmp_path / f"p{k}") for k in range(5)]

    first, n = incremental.enrich_changed(trees, fetched((1, ""), (2, "")), None, paths[0])
    assert n == {"made": 4, "parsed": 3, "kept": 0} and key(first) == key(topics.enrich(trees, fetched((1, ""), (2, ""))))
    again, n = incremental.enrich_changed(trees, fetched((1, ""), (2, "")), paths[0], paths[1])
    assert n == {"made": 0, "parsed": 0, "kept": 4} and key(again) == key(first)
    third, n = incremental.enrich_changed(trees, fetched((1, ""), (2, "new")), paths[1], paths[2])
    assert n == {"made": 1, "parsed": 1, "kept": 3} and key(third) == key(topics.enrich(trees, fetched((1, ""), (2, "new"))))
    fewer = made(("a", "u", [page("http://t/2", "other"), page("http://t/2", "y")]))
    fourth, n = incremental.enrich_changed(fewer, fetched((1, ""), (2, "new")), paths[2], paths[3])
    assert n == {"made": 1, "parsed": 1, "kept": 1} and key(fourth) == key(topics.enrich(fewer, fetched((2, "new"))))

    def broken(page, extracts):
        raise ValueError("no")

    last, n = incremental.enrich_changed(fewer, fetched((2, "x")), paths[3], paths[4], broken)
    assert n["made"] == 2 and topics.quarantine(last).count() == 2
    _, n = incremental.enrich_changed(fewer, fetched((2, "x")), paths[4], str(tmp_path / "p6"))
    assert n == {"made": 2, "parsed": 2, "kept": 0}  # what broke is tried again


@pytest.mark.filterwarnings("ignore")
def test_topic_state_raises_the_alerts_of_the_batch_rules(spark, tmp_path):
    made = f"topic string, pages array<{schema.PAGE}>, at timestamp"
    faq = lambda n: [SEGMENT | {"faqs": {"title": None, "QAs": [{"question": f"q{i}", "answer": "a"} for i in range(n)]}}]
    tree = lambda pages, faqs, chars: [{"url": "u", "title": None, "blocks": [{"heading": "h", "segments": [*faq(faqs), SEGMENT | {"text": "x" * chars}]}]}] * pages
    rng, rounds = random.Random(8), []
    for k in range(5):
        rounds.append([(t, tree(rng.randint(1, 3), rng.randint(0, 9), rng.choice([10, 3000]))) for t in ("a", "b", "c") if rng.random() < 0.8])
    # two trees of one topic in one batch: the later one counts
    rounds[2].append(("d", tree(3, 5, 10)))
    rounds[2].append(("d", tree(1, 5, 10)))
    want, last = [], None
    for k, rows in enumerate(rounds):
        n = 0
        for t, pages in rows:
            df = spark.createDataFrame([(t, pages)], f"topic string, pages array<{schema.PAGE}>")
            new = monitor.metrics(df)
            old = spark.createDataFrame([last[t]], schema.METRICS) if last and t in last else monitor.no_metrics(spark)
            want += [(t, r["issues"]) for r in monitor.regressions(new, old).collect() if r["issues"]]
            last = (last or {}) | {t: tuple(new.first())}
            n += 1
        at = [f"2026-01-{k + 1:02d} 00:00:{i:02d}" for i in range(n)]
        spark.createDataFrame([(t, p, a) for (t, p), a in zip(rows, at, strict=True)], made.replace("at timestamp", "at string")).withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(spark.createDataFrame([], made).schema).parquet(str(tmp_path / "in"))
        watch_topics(stream, str(tmp_path / "alerts"), str(tmp_path / "cp")).awaitTermination()  # each round restarts from the checkpoint
    got = [(r["topic"], r["issues"]) for r in spark.read.parquet(str(tmp_path / "alerts")).orderBy("at").collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) > 2 and ("d", ["pages 3→1", "content"]) not in got
    assert compared(spark.readStream.schema(spark.createDataFrame([], made).schema).parquet(str(tmp_path / "in"))).isStreaming
