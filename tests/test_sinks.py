import argparse
import io
import json
from urllib.error import HTTPError

import pytest
from pyspark.sql import functions as F

from docloom import run, schema
from docloom.functions import text as tx
from docloom.functions.prompts import system_text
from docloom.operators import knowledge, monitor
from docloom.operators.publish import UploadHold
from docloom.plans import topics
from docloom.sinks import files, state
from docloom.sinks.remote import PUSH_LIMIT, KnowledgeBase, push
from docloom.sources.config import load_site, select_topics, topics_table
from test_publish import HttpService

SEGMENT = dict.fromkeys(("subheading", "text", "files", "contacts", "faqs"))


def tree(title, *texts):
    blocks = [{"heading": "H", "segments": [SEGMENT | {"text": t} for t in texts]}]
    return {"base_url": "http://x", "pages": [{"url": f"http://x/{title}", "title": title, "blocks": blocks}]}


class Service:
    """A knowledge base that answers from a script; an opener for calls within this process."""

    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def __call__(self, request, timeout):
        self.asked.append((request.get_method(), request.full_url, request.data))
        status, body = self.answers.pop(0) if self.answers else (201, json.dumps({"uploaded_files": [{"file_id": f"id{len(self.asked)}"}]}))
        if status >= 400:
            raise HTTPError(request.full_url, status, "no", {}, io.BytesIO(body.encode()))
        answer = io.BytesIO(body.encode())
        answer.status = status
        return answer


def test_remote_rules():
    service = Service((404, "gone"), (204, ""), (500, "x" * 500), (201, '{"uploaded_files": []}'), (200, "{}"))
    base = KnowledgeBase("http://k/up", "http://k/del", "secret", {"strategy": "7"}, service)
    base.delete("a")
    base.delete("b")
    with pytest.raises(RuntimeError, match="500 x{200}$"):
        base.delete("c")
    for _ in range(2):  # no id, and not created
        with pytest.raises(RuntimeError):
            base.upload("t.md", "text", {"overlap": 50})
    assert base.upload("t.md", "ä", {"overlap": 50}) == "id6"
    body = service.asked[-1][2].decode()
    assert 'name="strategy"\r\n\r\n7' in body and 'name="overlap"\r\n\r\n50' in body and 'filename="t.md"' in body and "ä" in body
    with pytest.raises(UploadHold):
        KnowledgeBase("u", "d", None).upload("t.md", "", {})
    sent = Service((200, ""))
    assert push("http://p", {"token": "t"}, sent)("title", "m" * 5000)
    assert sent.asked[0][2].endswith(b"message=" + b"m" * PUSH_LIMIT)


def test_previous_metrics_of_missing_and_unreadable_files(spark, tmp_path):
    assert monitor.previous_metrics(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "a.json").write_text(json.dumps(tree("a", "x")))
    (tmp_path / "bad.json").write_text("{not json")
    assert [(r["topic"], r["pages"]) for r in monitor.previous_metrics(spark, str(tmp_path)).collect()] == [("a", 1)]


def test_knowledge_replaces_what_was_loaded(spark, tmp_path):
    names = ["b.md", "aaab.md", "aaaa.md", "aa.md", "z.md"]
    table = knowledge.knowledge(spark.createDataFrame([(n, n) for n in names], "filename string, content string"))
    assert [(r["id"], r["topic"]) for r in table.orderBy("id").collect()] == [(k + 1, n[:-3]) for k, n in enumerate(sorted(names, key=lambda n: n[:-3]))]
    for rows in (table, table.where("topic = 'z'")):
        knowledge.load(rows, str(tmp_path / "k"))
    assert [r["topic"] for r in knowledge.stored(spark, str(tmp_path / "k")).collect()] == ["z"]


def test_faq_block(spark):
    s = lambda **x: SEGMENT | x
    pages = [
        [("Intro", [s()]), ("Häufige Fragen", [s()])],
        [("Intro", [s(subheading="FAQ zum Netz")])],
        [("Intro", [s()]), ("B", [s(faqs={"title": None, "QAs": []})])],
        [("Intro", [s(subheading="Was sind Fragen?")])],
        [],
    ]
    df = spark.createDataFrame([({"url": "u", "title": "", "blocks": [{"heading": h, "segments": x} for h, x in p]},) for p in pages], f"page {schema.PAGE}")
    assert [r[0] for r in df.select(tx.faq_block(F.col("page"), F.array(F.lit("was sind fragen?")))).collect()] == [1, 0, 1, None, None]


def test_run_captures_enriches_publishes_holds_and_resumes(spark, tmp_path):
    config, captured, out = tmp_path / "site.yaml", tmp_path / "in", tmp_path / "out"
    config.write_text("site: s\nroot_url: http://x\ntopics:\n  - {name: a, url: /a}\n  - {name: b, url: /b}\n  - {name: c, url: /c}\n")
    captured.mkdir()
    tries, told = [], []

    def capture(topic):
        tries.append(topic["name"])
        if topic["name"] == "c" or tries.count("b") < 2 and topic["name"] == "b":
            raise OSError("down")
        made = tree(topic["name"], "Some text.")
        (captured / f"{topic['name']}.json").write_text(json.dumps(made | {"pages": made["pages"] * 2}))

    fetch = lambda spark, urls: urls.selectExpr("url", "concat('<title>T', right(url, 1), '</title><p>x</p>') as html", "cast(null as string) as error")
    args = run.arguments(["--config", str(config), "--capture", str(captured), "--out", str(out), "--state", str(tmp_path / "state"), "--upload", "--retry-backoff", "0", "--retries", "1"])
    site, go = load_site(config), lambda base, capture=capture: run.run(spark, args, site, capture, lambda *x: told.append(x), base, fetch)
    with HttpService(fails={"b.md"}) as service:
        base = service.base()
        assert go(base) == run.HOLD and tries == ["a", "b", "b", "c", "c"]
        assert ("Capture failed", "topic 'c' failed") in told and told[-1][0] == "Upload on hold"
        assert (out / "a.md").read_text(encoding="utf-8").startswith("# Ta\n\n*URL: http://x/a*") and json.loads((out / "b.json").read_text())["pages"][0]["title"] == "Tb"
        assert sorted(name for _, name, _ in service.asked) == ["a.md", "b.md", "b.md"]
        service.asked.clear()
        service.fails.clear()
        (captured / "b.json").write_text(json.dumps(tree("b", "Some text.")))
        assert go(base, None) == 0
        assert [(m, name) for m, name, _ in service.asked] == [("POST", "b.md")]  # a is unchanged, b was on hold
    assert any(title == "Coverage lost" and "pages 2→1" in text for title, text in told)
    assert sorted((r["name"], r["file_id"]) for r in state.load_state(spark, str(tmp_path / "state")).collect()) == [("a.md", "id-a.md-1"), ("b.md", "id-b.md-1")]
    assert sorted(p.name for p in out.iterdir() if not p.name.startswith(".")) == ["a.json", "a.md", "b.json", "b.md"]
    assert files.exists(spark, str(out / "b.md")) and isinstance(args, argparse.Namespace)


def test_tasks_name_sub_pages_before_the_capture(spark, tmp_path):
    config = tmp_path / "site.yaml"
    config.write_text("site: s\nroot_url: http://x/\ntopics:\n  - {name: a, url: /a, subtopics: [Solar, Nowhere, Heat], instructions: be exact}\n  - {name: b, path: [One]}\n  - {name: c, url: 'http://y/c', subtopics: [Solar]}\n  - {name: d, url: /a, subtopics: [Heat]}\n")
    site = load_site(config)
    html = "<a href='/heat'>District heating plans</a><a href='s/solar.html'>Solar roofs</a><a href='/h'>Heat</a>"
    fetch = lambda spark, urls: urls.selectExpr("url", f'case when url like "http://x%" then "{html}" end as html', "cast(null as string) as error")
    rows = {r["name"]: r for r in topics.capture_tasks(select_topics(topics_table(spark, site), None), site.root_url, fetch).collect()}
    assert [tuple(s) for s in rows["a"]["subpages"]] == [("Solar", "http://x/s/solar.html"), ("Heat", "http://x/h")]
    assert [tuple(s) for s in rows["d"]["subpages"]] == [("Heat", "http://x/h")] and rows["b"]["subpages"] == rows["c"]["subpages"] == []
    assert "  - Solar: http://x/s/solar.html\n  - Heat: http://x/h" in rows["a"]["task"] and "be exact" in rows["a"]["task"] and "Sub-pages" not in rows["c"]["task"]
    out = tmp_path / "told"
    run.command(f"cp /dev/stdin {out}")(rows["a"])
    assert out.read_text().startswith(system_text()) and "array<struct<question:string" in system_text() and "http://x/h" in out.read_text()


def test_main_names_bad_input():
    for argv in (["--config", "/none.yaml"], ["--pdf"]):
        with pytest.raises(SystemExit, match="error"):
            run.main(argv)
