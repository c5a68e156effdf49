"""Publishing from executors, the state's log, and the file sink: repeats, lost tasks, holds, concurrent readers."""

import json
import os
import subprocess
import sys
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docloom import schema
from docloom.operators import publish
from docloom.sinks import files, state
from docloom.sinks.remote import KnowledgeBase


class HttpService:
    """A knowledge base on a local port: notes what it is asked, knows repeated keys, and refuses what it is told to."""

    def __init__(self, fails=()):
        self.asked, self.fails, self.ids, self.lock = [], set(fails), {}, threading.Lock()

    def __enter__(self):
        service = self

        class Handler(BaseHTTPRequestHandler):
            def answer(self, name, key):
                with service.lock:
                    service.asked.append((self.command, name, key))
                    if name in service.fails:
                        status, body = 500, "down"
                    elif self.command == "DELETE":
                        status, body = 204, ""
                    else:
                        n = Counter(x for x in service.ids.values() if x.startswith(f"id-{name}-"))
                        made = service.ids.setdefault(key, f"id-{name}-{len(n) + 1}")
                        status, body = 201, json.dumps({"uploaded_files": [{"file_id": made}]})
                self.send_response(status)
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body.encode())

            def do_POST(self):
                sent = self.rfile.read(int(self.headers["Content-Length"])).decode()
                self.answer(sent.split('filename="')[1].split('"')[0], self.headers["Idempotency-Key"])

            def do_DELETE(self):
                self.answer(self.path.rsplit("/", 1)[1], None)

            def log_message(self, *_):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_port}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        return self

    def __exit__(self, *_):
        self.server.shutdown()

    def base(self):
        return KnowledgeBase(f"{self.url}/up", f"{self.url}/del", "secret")


def planned(spark, path, *documents, now=lambda: "now", **more):
    """Publish documents (name, md) against the state at path."""
    docs = spark.createDataFrame(documents, "name string, md string")
    plan = publish.upload_plan(docs.select("name"), docs, state.load_state(spark, path))

    def go(base):
        return publish.publish(plan, docs, base.upload, base.delete, path, now=now, **more)

    return go


def rows_of(spark, path):
    return sorted((r["name"], r["file_id"]) for r in state.load_state(spark, path).collect())


def test_publish_replaces_skips_holds_and_resumes(spark, tmp_path):
    path = str(tmp_path / "state")
    with HttpService() as service:
        base = service.base()
        assert planned(spark, path, ("a.md", "one"), ("b.md", "two"))(base) == {"uploaded": 2, "skipped": 0}
        assert rows_of(spark, path) == [("a.md", "id-a.md-1"), ("b.md", "id-b.md-1")]
        service.asked.clear()
        assert planned(spark, path, ("a.md", "new"), ("b.md", "two"))(base) == {"uploaded": 1, "skipped": 1}
        assert [(m, n) for m, n, _ in service.asked] == [("DELETE", "id-a.md-1"), ("POST", "a.md")]
        row = state.load_state(spark, path).where("name = 'a.md'").first()
        assert row["uploaded_at"] == "now" and row["chunk_params"]["max_characters"] == 800
        # one task: documents in order, what follows a hold is left for later
        service.asked.clear()
        service.fails.add("b.md")
        with pytest.raises(publish.UploadHold, match="2 documents"):
            planned(spark, path, ("a.md", "x"), ("b.md", "x"), ("c.md", "x"), parallel=1)(base)
        assert [(m, n) for m, n, _ in service.asked] == [("DELETE", "id-a.md-2"), ("POST", "a.md"), ("DELETE", "id-b.md-1"), ("POST", "b.md"), ("POST", "b.md")]
        assert rows_of(spark, path) == [("a.md", "id-a.md-3"), ("b.md", "id-b.md-1")]
        service.fails.clear()
        assert planned(spark, path, ("a.md", "x"), ("b.md", "x"), ("c.md", "x"))(base) == {"uploaded": 2, "skipped": 1}
        # a text that comes back is a new change
        assert planned(spark, path, ("a.md", "one"))(base)["uploaded"] == 1
        assert rows_of(spark, path) == [("a.md", "id-a.md-4"), ("b.md", "id-b.md-2"), ("c.md", "id-c.md-1")]
        assert os.listdir(f"{path}/items") == []


DYING = """
import os, sys
sys.path[:0] = [{root!r}, {tests!r}]
os.environ["PYTHONPATH"] = {root!r} + os.pathsep + {tests!r}
from docloom.session import local_session, ship
from docloom.operators import publish
from docloom.sinks import state
from docloom.sinks.remote import KnowledgeBase
from test_publish import planned
spark = local_session("2,4", 2)
base = KnowledgeBase({url!r} + "/up", {url!r} + "/del", "secret")
marks = {marks!r}

def once(what):
    try:
        os.close(os.open(f"{{marks}}/{{what}}", os.O_CREAT | os.O_EXCL))
        return True
    except FileExistsError:
        return False

def upload(name, md, params, key):
    if name == "b.md" and once("before"):
        os._exit(1)  # the old document has gone, the new one is not there yet
    made = base.upload(name, md, params, key)
    if name == "c.md" and once("after"):
        os._exit(1)  # it is there, but nobody has noted it
    return made

class Dying:
    pass

dying = Dying()
dying.upload, dying.delete = upload, base.delete
print(planned(spark, {path!r}, *{documents!r}, parallel=1)(dying))
"""


def test_a_task_that_dies_repeats_nothing(spark, tmp_path):
    path, documents = str(tmp_path / "state"), [(f"{c}.md", f"new {c}") for c in "abcd"]
    with HttpService() as service:
        planned(spark, path, *[(n, "old") for n, _ in documents])(service.base())
        service.asked.clear()
        root, tests = Path(__file__).resolve().parent.parent, Path(__file__).resolve().parent
        script = DYING.format(root=str(root), tests=str(tests), url=service.url, marks=str(tmp_path), path=path, documents=documents)
        told = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
        assert "{'uploaded': 4, 'skipped': 0}" in told.stdout, told.stderr[-2000:]
        assert Counter(n for m, n, _ in service.asked if m == "DELETE") == Counter(f"id-{n}-1" for n, _ in documents)
        posts = [(n, key) for m, n, key in service.asked if m == "POST"]
        # c's upload was not noted, so it was asked for again, under the same key: the service has one copy
        assert Counter(n for n, _ in posts) == Counter({"a.md": 1, "b.md": 1, "c.md": 2, "d.md": 1}) and len(set(posts)) == 4
        assert rows_of(spark, path) == [(n, f"id-{n}-2") for n, _ in documents]


def test_what_a_lost_run_noted_counts(spark, tmp_path):
    """The driver dies after documents went up, before the state was saved."""
    path = str(tmp_path / "state")
    journal = publish.Journal(files.uri(spark, f"{path}/items/1"))
    chunks = {"max_characters": 800, "new_after_n_chars": 800, "overlap": 100}
    sha = publish.hashlib.sha256(b"one").hexdigest()
    journal.write(publish.same_upload("a.md", sha, None), name="a.md", file_id="kept", sha256=sha, chunk_params=chunks, uploaded_at="then", version=1)
    journal.write("k2", name="b.md", version=1)  # only its old file was deleted
    assert rows_of(spark, path) == [("a.md", "kept")] and state.next_version(spark, path) == 2
    with HttpService() as service:
        assert planned(spark, path, ("a.md", "one"), ("b.md", "two"))(service.base()) == {"uploaded": 1, "skipped": 1}
    state.compact(spark, path)
    assert rows_of(spark, path) == [("a.md", "kept"), ("b.md", "id-b.md-1")]


def test_ten_thousand_saves_are_one_job(spark, tmp_path):
    path = str(tmp_path / "state")
    rows = spark.range(10_000).select(F.concat("id", F.lit(".md")).alias("name"), F.concat(F.lit("f"), "id").alias("file_id"), F.lit("x").alias("sha256"), F.lit(None).cast(schema.CHUNKS).alias("chunk_params"), F.lit("now").alias("uploaded_at"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("saves", "")
    state.save(rows, path, 1)
    assert len(tracker.getJobIdsForGroup("saves")) == 1
    spark.sparkContext.setJobGroup("", "")
    assert state.load_state(spark, path).count() == 10_000


def test_readers_see_old_or_new_during_saves_and_compactions(spark, tmp_path):
    path, seen, stop = str(tmp_path / "state"), [], threading.Event()
    rows = lambda v: spark.range(50).select(F.concat("id", F.lit(".md")).alias("name"), F.lit(f"v{v}").alias("file_id"), F.lit("x").alias("sha256"), F.lit(None).cast(schema.CHUNKS).alias("chunk_params"), F.lit("now").alias("uploaded_at")).repartition(4)
    state.save(rows(1), path, 1)

    def read():
        while not stop.is_set():
            try:
                found = state.load_state(spark, path).collect()
                seen.append((len(found), {r["file_id"] for r in found}))
            except Exception as error:  # noqa: BLE001  a reader must never fail
                seen.append((0, {str(error)}))

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(2, 7):
        state.save(rows(v), path, v)
        state.compact(spark, path)
    stop.set()
    reader.join()
    assert len(seen) > 3 and all(n == 50 and len(kinds) == 1 for n, kinds in seen)
    assert {r["file_id"] for r in state.load_state(spark, path).collect()} == {"v6"}
    reads = lambda: len([b for b in os.listdir(path) if b.startswith("batch=")])
    assert reads() == 11  # nothing that a reader may have listed has gone
    state.compact(spark, path, grace=0)
    assert reads() == 2 and state.load_state(spark, path).count() == 50  # the two newest compactions


def test_state_of_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    assert state.load_state(spark, path).count() == 0 and state.next_version(spark, path) == 1
    state.compact(spark, path)
    assert not os.path.exists(path)


def test_files_are_written_by_executors_and_replaced(spark, tmp_path):
    out = tmp_path / "out"
    rows = lambda *r: spark.createDataFrame(list(r), "name string, content string").repartition(3)
    files.write_texts(rows(("a", "ä"), ("b", ""), ("c", None), (None, "x")), str(out), ".md")
    assert {p.name: p.read_text(encoding="utf-8") for p in out.iterdir()} == {"a.md": "ä", "b.md": ""}
    files.write_texts(rows(("a", "new")), str(out), ".md")
    assert {p.name: p.read_text() for p in out.iterdir()} == {"a.md": "new", "b.md": ""}
    (out / "keep.txt").write_text("other kind")
    rows(("z", "only")).write.format("docloom_files").mode("overwrite").option("suffix", ".md").save(files.uri(spark, str(out)))
    assert sorted(p.name for p in out.iterdir()) == ["keep.txt", "z.md"]
    files.write_texts(rows(("a", "x")).limit(0), str(out), ".md")
    assert sorted(p.name for p in out.iterdir()) == ["keep.txt", "z.md"]


@pytest.mark.parametrize("bad", ["../out", "a/b", "", ".hidden", "same"])
def test_a_failed_task_or_commit_leaves_no_file(spark, tmp_path, bad):
    out = tmp_path / "out"
    out.mkdir()
    (out / "old.md").write_text("old")
    names = [(f"n{i}", "x") for i in range(20)] + [("same", "y"), (bad, "y")]
    with pytest.raises(Exception, match="no name for a file|rows of one name"):
        files.write_texts(spark.createDataFrame(names, "name string, content string").repartition(4), str(out), ".md")
    assert [p.name for p in out.iterdir()] == ["old.md"]


def test_ten_thousand_files(spark, tmp_path):
    rows = spark.range(10_000).select(F.col("id").cast("string").alias("name"), F.lit("text").alias("content"))
    files.write_texts(rows, str(tmp_path / "many"), ".txt")
    assert len(os.listdir(tmp_path / "many")) == 10_000
