"""Incremental publishing: what to upload, and a resumable sink that runs where the documents lie."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators.chunk import chunk_params
from docloom.operators.knowledge import markdown_files
from docloom.schema import CHUNKS

#: Tasks that talk to the remote service at once.
PARALLEL = 4


class UploadHold(RuntimeError):
    """An upload failed twice: state is saved, a later run goes on from there."""


def markdown_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(name, md) of the Markdown files of a folder; the name is the file's."""
    return markdown_files(spark, folder).select(F.col("filename").alias("name"), F.col("content").alias("md"))


def upload_plan(topics: DataFrame, documents: DataFrame, state: DataFrame) -> DataFrame:
    """(name, action, sha256, file_id) for each listed topic: upload, replace, skip or missing.

    topics: name. documents: name, md. state: name, file_id, sha256. Only listed topics are visited: what is no longer
    listed stays published.
    """
    current = documents.select("name", tx.sha256_text(F.col("md")).alias("sha256"))
    old = state.select("name", F.col("file_id"), F.col("sha256").alias("old_sha256"))
    joined = topics.select("name").join(current, "name", "left").join(old, "name", "left")
    action = F.when(F.col("sha256").isNull(), "missing").when(F.col("old_sha256").isNull(), "upload").when(F.col("sha256") == F.col("old_sha256"), "skip").otherwise("replace")
    return joined.select("name", action.alias("action"), "sha256", "file_id")


def tally(plan: DataFrame) -> DataFrame:
    """(action, n)."""
    return plan.groupBy("action").agg(F.count("*").alias("n"))


def removed_topics(topics: DataFrame, state: DataFrame) -> DataFrame:
    """State rows whose topic is no longer listed; for an opt-in clean-up."""
    return state.join(topics.select("name"), "name", "left_anti")


def with_retry(action: Callable, *args: object) -> object:
    """Try twice, then hold."""
    try:
        return action(*args)
    except Exception:  # noqa: BLE001  any failure of a remote service
        try:
            return action(*args)
        except Exception as error:
            raise UploadHold(str(error)) from error


def same_upload(name: str, sha256: str, replaced: str | None) -> str:
    """The key of one change: what is put up, in place of what. A change that is tried again has the same one."""
    return hashlib.sha256("\0".join((name, sha256, replaced or "")).encode()).hexdigest()


@dataclass
class Journal:
    """What tasks have done for each change, one small file each in a folder that all executors share."""

    folder: str

    def __post_init__(self) -> None:
        self.fs, self.at = arrow_fs.FileSystem.from_uri(self.folder)
        self.fs.create_dir(self.at, recursive=True)

    def read(self, key: str) -> dict:
        try:
            with self.fs.open_input_stream(f"{self.at}/{key}.json") as held:
                return json.loads(held.read())
        except FileNotFoundError:
            return {}

    def write(self, key: str, **row: object) -> None:
        """The file is there whole or not at all."""
        with self.fs.open_output_stream(f"{self.at}/_{key}") as out:
            out.write(json.dumps(row).encode())
        self.fs.move(f"{self.at}/_{key}", f"{self.at}/{key}.json")


def carry_out(rows: Iterator[dict], journal: Journal, upload: Callable, delete: Callable, version: int, now: Callable) -> Iterator[dict]:
    """Each row's change in turn: the old document is deleted, then the new one goes up. After a hold the rest is left for a later run.

    What the journal says is done is not done again, so a task that is repeated goes on where it broke off.
    """
    reason = None
    for row in rows:
        out = {"name": row["name"], "file_id": None, "sha256": row["sha256"], "chunk_params": row["chunk_params"], "uploaded_at": None, "hold": reason}
        if reason is None:
            key = same_upload(row["name"], row["sha256"], row["file_id"])
            done = journal.read(key)
            try:
                if row["action"] == "replace" and not done:
                    with_retry(delete, row["file_id"])
                    journal.write(key, name=row["name"], version=version)
                if not done.get("file_id"):
                    file_id = with_retry(upload, row["name"], row["md"], row["chunk_params"], key)
                    done = {"name": row["name"], "file_id": file_id, "sha256": row["sha256"], "chunk_params": row["chunk_params"], "uploaded_at": now(), "version": version}
                    journal.write(key, **done)
                out |= {"file_id": done["file_id"], "uploaded_at": done["uploaded_at"]}
            except UploadHold as error:
                reason = out["hold"] = str(error)
        yield out


def timestamp() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def publish(plan: DataFrame, documents: DataFrame, upload: Callable, delete: Callable, path: str, parallel: int = PARALLEL, now: Callable = timestamp) -> dict[str, int]:
    """Carry a plan out on the executors and add what was published to the state at path.

    Documents are dealt out by name; within a task they go in the order of their names. upload(name, md, params, key)
    gives the new file id; key is the same whenever the same change is tried again, for services that tell repeats by
    it. delete(file_id) treats an unknown id as done. Each task notes each step in the state's folder before it goes on,
    so a repeated task deletes and uploads nothing twice that was noted; a task lost between an upload and its note
    repeats that one upload, with its key. Where a call fails twice, its task stops, the others finish, all that was
    published is saved, and UploadHold is raised: a later run goes on from there. The job runs once: it writes the
    state, and the numbers are observed on the way.
    """
    from docloom.sinks import state
    from docloom.sinks.files import uri

    spark = plan.sparkSession
    version = state.next_version(spark, path)
    folder = uri(spark, f"{path}/items/{version}")
    work = plan.where("action in ('upload', 'replace')").join(documents.select("name", "md"), "name").join(chunk_params(documents, "name", "md"), "name")
    work = work.select("name", "action", "sha256", "file_id", "md", "chunk_params").repartition(parallel, "name").sortWithinPartitions("name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for out in carry_out(rows, Journal(folder), upload, delete, version, now):
            yield pa.RecordBatch.from_pylist([out], schema=told)

    chunks = pa.struct([(f, pa.int32()) for f in ("max_characters", "new_after_n_chars", "overlap")])
    told = pa.schema([("name", pa.string()), ("file_id", pa.string()), ("sha256", pa.string()), ("chunk_params", chunks), ("uploaded_at", pa.string()), ("hold", pa.string())])
    seen, skips = Observation(), plan.where("action = 'skip'").count()
    results = work.mapInArrow(run, f"name string, file_id string, sha256 string, chunk_params {CHUNKS}, uploaded_at string, hold string")
    results = results.observe(seen, F.count("file_id").alias("uploaded"), F.count("hold").alias("held"), F.min("hold").alias("reason"))
    state.save(results.where("file_id is not null"), path, version)
    state.forget(spark, path, [f"items/{version}"])
    numbers = seen.get
    if numbers["held"]:
        raise UploadHold(f"{numbers['held']} documents: {numbers['reason']}")
    return {"uploaded": numbers["uploaded"], "skipped": skips}
