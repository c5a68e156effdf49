import pytest
from pyspark.sql import functions as F

from docloom import schema
from docloom.operators import chunk, knowledge, monitor, publish
from docloom.sources import config, trees, web
from docloom.streaming.snapshots import watch


@pytest.mark.parametrize(("p", "most", "overlap"), [(0, 800, 100), (40, 800, 100), (850, 800, 100), (851, 900, 100), (950, 1000, 100), (1250, 1200, 100), (1350, 1400, 150), (1750, 1800, 200), (1850, 1800, 200), (5000, 2000, 200)])
def test_chunk_sizes(spark, p, most, overlap):
    got = spark.createDataFrame([(p,)], "p int").select(chunk.params(F.col("p")).alias("c")).first()["c"]
    assert (got["max_characters"], got["new_after_n_chars"], got["overlap"]) == (most, most, overlap)


def test_section_lengths_and_p95(spark):
    docs = spark.createDataFrame([("a", "## A\np\n**Q?**\nans"), ("b", "**a** and **b**\nx"), ("c", ""), ("d", "\n \n# \n")], "name string, md string")
    got = sorted((r["name"], r["unit"], r["length"]) for r in chunk.section_lengths(docs, "name", "md").collect())
    assert got == [("a", 1, 6), ("a", 2, 10), ("b", 1, 17), ("d", 1, 2)] or got[:3] == [("a", 1, 6), ("a", 2, 10), ("b", 0, 17)]
    assert spark.range(1).select(chunk.p95(F.array(*[F.lit(x) for x in range(1, 21)]))).first()[0] == 20
    assert chunk.chunk_params(docs, "name", "md").count() == 4


def test_metrics_and_rules(spark):
    s = dict.fromkeys(("subheading", "text", "files", "contacts", "faqs"))
    pages = [{"url": "u", "title": None, "blocks": [{"heading": "h", "segments": [s | {"files": "a\n \nb"}, s | {"faqs": {"title": None, "QAs": [{"question": "q", "answer": "a"}]}}]}]}]
    df = spark.createDataFrame([("t", pages), ("e", [])], f"topic string, pages array<{schema.PAGE}>")
    got = {r["topic"]: tuple(r)[1:4] for r in monitor.metrics(df).collect()}
    assert got == {"t": (1, 1, 2), "e": (0, 0, 0)}
    m = lambda *rows: spark.createDataFrame(list(rows), schema.METRICS)
    old = m(("a", 6, 20, 9, 10000), ("b", 6, 20, 9, 10000))
    got = {r["topic"]: r["issues"] for r in monitor.regressions(m(("a", 6, 14, 0, 6000), ("b", 5, 13, 0, 5999), ("c", 0, 0, 0, 0)), old).collect()}
    assert got == {"a": [], "b": ["pages 6→5", "FAQ 20→13", "content 10000→5999 chars"], "c": []}
    assert monitor.run_summary(m(("b", 1, 2, 3, 4), ("a", 1, 0, 0, 9)), ["x"]).first()["summary"].split("\n") == ["2 ok, 1 failed", "total: 2 pages · 2 FAQ · 3 files", "• a: 1p, 0 FAQ, 0 files", "• b: 1p, 2 FAQ, 3 files", "failed: x"]
    assert monitor.run_summary(m(), []).first()["summary"] == "0 ok, 0 failed\ntotal: 0 pages · 0 FAQ · 0 files"


def test_upload_plan(spark):
    docs = spark.createDataFrame([("a", "new"), ("b", "same"), ("c", "first")], "name string, md string")
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("gone",)], "name string")
    sha = dict(docs.select("name", F.sha2("md", 256)).collect())
    state = spark.createDataFrame([("a", "1", "old", None, None), ("b", "2", sha["b"], None, None), ("z", "9", "q", None, None)], schema.UPLOAD_STATE)
    plan = publish.upload_plan(names, docs, state)
    assert {r["name"]: r["action"] for r in plan.collect()} == {"a": "replace", "b": "skip", "c": "upload", "gone": "missing"}
    assert {r["action"]: r["n"] for r in publish.tally(plan).collect()} == {"replace": 1, "skip": 1, "upload": 1, "missing": 1}
    assert [r["name"] for r in publish.removed_topics(names, state).collect()] == ["z"]


def test_knowledge_round_trip(spark, tmp_path):
    for name, text in (("heat.md", 'Line "one"\nÄpfel'), ("x.md.md", "AB"), ("skip.txt", "no")):
        (tmp_path / name).write_text(text, encoding="utf-8")
    table = knowledge.knowledge(knowledge.markdown_files(spark, str(tmp_path)))
    assert [(r["id"], r["topic"]) for r in table.orderBy("id").collect()] == [(1, "heat"), (2, "x")]
    assert [r["topic"] for r in knowledge.search_all(table, "äPF").collect()] == ["heat"] and knowledge.search_all(table, "%").count() == 0
    knowledge.export_csv(table, str(tmp_path / "out"))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert {r["content"] for r in back.collect()} == {'Line "one"\nÄpfel', "AB"}


def test_site_configuration(spark, tmp_path):
    good = tmp_path / "s.yaml"
    good.write_text("site: s\nroot_url: http://r\ntopics:\n  - {name: a, url: /a, subtopics: [x]}\n  - {name: b, path: [One, Two]}\n")
    site = config.load_site(good)
    assert site.topic("b").path == ["One", "Two"]
    topics = config.topics_table(spark, site)
    assert [r["name"] for r in config.select_topics(topics, "b, a,,b").collect()] == ["b", "a", "b"]
    assert config.select_topics(topics, None).count() == 2
    for wrong in ("extra: 1", "topics: [{name: a}]", "topics: [{name: a, path: [x], subtopics: [y]}]", "topics: [{name: a, url: u, more: 1}]", "topics: [{name: a, url: u}, {name: a, url: v}]"):
        bad = tmp_path / "bad.yaml"
        bad.write_text(f"site: s\nroot_url: r\n{wrong}\n")
        with pytest.raises(config.ConfigError):
            config.load_site(bad)
    with pytest.raises(KeyError):
        config.select_topics(topics, "nope")
    with pytest.raises(KeyError):
        site.topic("nope")
    with pytest.raises(FileNotFoundError):
        config.load_site(tmp_path / "none.yaml")


def test_navigation_and_task(spark, tmp_path):
    from docloom.functions.prompts import navigation, task

    df = spark.createDataFrame([("/a", None, "be exact"), (None, ["One", "Two"], None), ("http://o/x", ["y"], "")], "url string, path array<string>, instructions string")
    nav = [r[0] for r in df.select(navigation(F.col("url"), F.col("path"), "http://r/")).collect()]
    assert nav[0].endswith(": http://r/a") and "'One', then 'Two'" in nav[1] and nav[2].endswith(": http://o/x")
    sub = F.array(F.struct(F.lit("L").alias("label"), F.lit("U").alias("url")))
    assert "  - L: U" in df.select(task(F.lit("go"), F.col("instructions"), sub)).first()[0]


def test_fetch_encodes_and_ignores_bad_bytes():
    class Answer:
        def __enter__(self):
            return self

        def __exit__(self, *_):
            return None

        def read(self):
            return b"caf\xc3\xa9 \xff!"

    seen = []
    assert web.fetch_html("http://h/ä b%20?x=1", opener=lambda r, timeout: seen.append(r.full_url) or Answer()) == "café !"
    assert seen == ["http://h/%C3%A4%20b%20?x=1"]


def test_page_source_reports_failures(spark):
    rows = web.read_pages(spark, ["http://127.0.0.1:9/none"]).collect()
    assert [(r["url"], r["html"]) for r in rows] == [("http://127.0.0.1:9/none", None)] and rows[0]["error"]


def test_trees_json_and_stage(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"base_url": "b", "pages": [{"url": "u", "blocks": []}]}')
    (tmp_path / "in/bad.json").write_text("{not json")
    got = {r["topic"]: r["pages"] for r in trees.read_trees(spark, str(tmp_path / "in")).collect()}
    assert got["a"][0]["url"] == "u" and got.get("bad") is None
    stage = str(tmp_path / "stage")
    rows = lambda *r: spark.createDataFrame(list(r), "topic string, base_url string, pages array<string>")
    trees.write_stage(rows(("a", "1", []), ("b", "1", [])), stage)
    trees.write_stage(rows(("a", "2", [])), stage)
    assert {(r["topic"], r["base_url"]) for r in spark.read.parquet(stage).collect()} == {("a", 2), ("b", 1)} or {(r["topic"], str(r["base_url"])) for r in spark.read.parquet(stage).collect()} == {("a", "2"), ("b", "1")}


def test_snapshot_stream_raises_alerts_once(spark, tmp_path):
    made = f"topic string, pages array<{schema.PAGE}>"
    one = {"url": "u", "title": None, "blocks": []}
    for n, pages in enumerate(([one, one], [one])):
        spark.createDataFrame([("t", pages)], made).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(spark.createDataFrame([], made).schema).parquet(str(tmp_path / "in"))
        watch(stream, str(tmp_path / "snap"), str(tmp_path / "alerts"), str(tmp_path / "cp")).awaitTermination()
    alerts = spark.read.parquet(str(tmp_path / "alerts")).collect()
    assert [(r["topic"], r["issues"][0]) for r in alerts] == [("t", "pages 2→1")]
    assert spark.read.parquet(str(tmp_path / "snap")).count() == 2
