"""One run: configured topics to captured trees, enriched trees, Markdown, alerts and published documents.

    python -m docloom.run --config site.yaml --capture captured/ --out out/ [--upload --state state/]

The capture itself is outside: a command given with --capture-command is called for each topic, gets its task with the
addresses of its sub-pages, and leaves <topic>.json in the capture folder; without one, what lies there is taken. A topic whose capture fails stops no other.
"""

from __future__ import annotations

import argparse
import os
import subprocess
import sys
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.prompts import system_text
from docloom.operators import monitor, publish
from docloom.plans.topics import capture_tasks, enrich, quarantine
from docloom.sinks import files, state
from docloom.sinks.remote import KnowledgeBase, push
from docloom.sources import trees, web
from docloom.sources.config import ConfigError, Site, load_site, select_topics, topics_table

MOST_RETRIES, HOLD = 3, 2


@dataclass
class Processed:
    """What a run made: metrics with issues, their totals, topics without a readable tree, pages in quarantine, and the stage folder."""

    found: DataFrame
    totals: dict[str, int]
    lost: list[str]
    quarantine: DataFrame
    stage: str


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Capture, enrich, watch and publish a site's topics.")
    p.add_argument("--config", default="sites/site.yaml", help="site file")
    p.add_argument("--topics", default=None, help="names, comma-separated; all if left out")
    p.add_argument("--capture", default="captured", help="folder of <topic>.json trees")
    p.add_argument("--capture-command", default=None, help="called for each topic, with {topic} and {url} filled in and the task as its input")
    p.add_argument("--out", default="outputs", help="folder for enriched trees and Markdown")
    p.add_argument("--pdf", action="store_true", help="not offered: Markdown is converted outside")
    p.add_argument("--upload", action="store_true", help="publish changed documents")
    p.add_argument("--state", default="upload_state", help="table of what is published")
    p.add_argument("--delay", type=float, default=0.0, help="seconds between captures")
    p.add_argument("--retries", type=int, default=2, help=f"further attempts for a capture, {MOST_RETRIES} at most")
    p.add_argument("--retry-backoff", type=float, default=15.0, help="seconds before a further attempt")
    return p.parse_args(argv)


def attempt(action: Callable, retries: int, backoff: float, sleep: Callable = time.sleep) -> object:
    """The result of an action, tried again after a pause; the last failure is raised."""
    for left in range(max(0, min(retries, MOST_RETRIES)), -1, -1):
        try:
            return action()
        except Exception:  # noqa: BLE001  a capture may fail in any way
            if not left:
                raise
            sleep(backoff)
    return None


def capture_all(topics: Iterable, capture: Callable | None, retries: int, backoff: float, delay: float, sleep: Callable = time.sleep) -> tuple[list[str], list[str]]:
    """(captured, failed) names of topics."""
    done, failed = [], []
    for n, topic in enumerate(topics):
        if n and delay and capture:
            sleep(delay)
        try:
            if capture:
                attempt(lambda topic=topic: capture(topic), retries, backoff, sleep)
            done.append(topic["name"])
        except Exception:  # noqa: BLE001  one topic must not stop the others
            failed.append(topic["name"])
    return done, failed


def process(spark: SparkSession, names: list[str], captured: str, out: str, fetch: Callable = web.read_pages) -> Processed:
    """Enriched trees and Markdown are written, and compared with what lay there.

    Trees, URLs and pages stay tables: the trees are written once, as a stage table below `out`, with what is counted of
    them, and all that follows reads that table.
    """
    stage = f"{out.rstrip('/')}/_stage-{uuid.uuid4().hex}"
    wanted = spark.createDataFrame([(n,) for n in dict.fromkeys(names)], "topic string")
    read = trees.read_trees(spark, captured).join(F.broadcast(wanted), "topic").where("pages is not null")
    before = monitor.previous_metrics(spark, out)
    before.write.parquet(f"{stage}/before")  # the files it was read from are about to be replaced
    before = spark.read.schema(before.schema).parquet(f"{stage}/before")
    urls = read.select(F.explode("pages.url").alias("url")).where("url <> ''").distinct()
    made, totals = trees.stage(enrich(read, fetch(spark, urls)), f"{stage}/trees")
    files.write_trees(made, out)
    files.write_markdown(made, out)
    metrics = monitor.metrics(made)
    have = {r["topic"] for r in metrics.select("topic").collect()}  # of the listed names, so no more than those
    return Processed(metrics.join(monitor.regressions(metrics, before), "topic"), totals, [n for n in dict.fromkeys(names) if n not in have], quarantine(made), stage)


def run(spark: SparkSession, args: argparse.Namespace, site: Site, capture: Callable | None = None, notify: Callable = lambda title, text: None, base: KnowledgeBase | None = None, fetch: Callable = web.read_pages) -> int:
    """The whole run; 0, or HOLD where publishing has to go on later."""
    topics = select_topics(topics_table(spark, site), args.topics)
    if capture:
        topics = capture_tasks(topics, site.root_url, fetch)
    topics = topics.orderBy("ord").collect()  # a configuration
    done, failed = capture_all(topics, capture, args.retries, args.retry_backoff, args.delay)
    made = process(spark, done, args.capture, args.out, fetch) if done else None
    failed += made.lost if made else []
    for name in failed:
        notify("Capture failed", f"topic '{name}' failed")
    metrics = made.found.drop("issues") if made else monitor.no_metrics(spark)
    for row in made.found.where(F.size("issues") > 0).orderBy("topic").toLocalIterator() if made else []:
        notify("Coverage lost", f"{row['topic']}: {'; '.join(row['issues'])}")
    for row in made.quarantine.groupBy("topic").agg(F.count("*").alias("n"), F.min("error").alias("error")).orderBy("topic").toLocalIterator() if made else []:
        notify("Pages in quarantine", f"{row['topic']}: {row['n']}, {row['error']}")
    notify("Run finished with failures" if failed else "Run finished", monitor.run_summary(metrics, failed, known=made.totals if made else None).first()["summary"])
    if made:
        files.remove(spark, made.stage)
    if not args.upload or made is None:
        return 0
    documents = publish.markdown_documents(spark, args.out)
    names = spark.createDataFrame([(f"{n}.md",) for n in dict.fromkeys(done) if n not in failed], "name string")
    plan = publish.upload_plan(names, documents, state.load_state(spark, args.state))
    try:
        sums = publish.publish(plan, documents, base.upload, base.delete, args.state)
    except publish.UploadHold as hold:
        notify("Upload on hold", str(hold))
        return HOLD
    state.compact(spark, args.state)
    notify("Upload finished", f"uploaded {sums['uploaded']}, unchanged {sums['skipped']}")
    return 0


def command(template: str) -> Callable:
    """A capture that calls a program; it fails if the program does. The task goes to its standard input, behind the system text."""
    return lambda topic: subprocess.run([x.format(topic=topic["name"], url=topic["url"] or "") for x in template.split()], check=True, text=True, input=f"{system_text()}\n\n{topic['task']}")


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    if args.pdf:
        sys.exit("error: --pdf is not offered; convert the Markdown files")
    try:
        site = load_site(args.config)
        wanted = [x.strip() for x in (args.topics or "").split(",") if x.strip()]
        for name in wanted:
            site.topic(name)
    except (FileNotFoundError, ConfigError, KeyError) as error:
        sys.exit(f"error: {error}")
    spark = SparkSession.builder.appName("docloom").getOrCreate()
    env = os.environ.get
    base = KnowledgeBase(env("KNOWLEDGE_UPLOAD_URL", ""), env("KNOWLEDGE_DELETE_URL", ""), env("KNOWLEDGE_KEY"))
    notify = push(env("PUSH_URL"), {}) if env("PUSH_URL") else lambda title, text: print(f"{title}\n{text}")
    sys.exit(run(spark, args, site, command(args.capture_command) if args.capture_command else None, notify, base))


if __name__ == "__main__":
    main()
