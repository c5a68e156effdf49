"""The upload state as a log: rows are only added, and of each document the row of the newest version counts.

    <path>/batch=<id>/      rows of one save, or of one compaction
    <path>/items/<version>/ one JSON file for each document of a run that is under way, written by the executors

A batch is written beside the log under a name that readers skip, and put in place by one rename, so a reader sees all
of it or nothing. A compaction adds the newest rows as one more batch; what it read is deleted by a later compaction,
GRACE seconds on, so a reader that has listed the old files can still read them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.schema import UPLOAD_STATE
from docloom.sinks.files import file_system, remove

#: How long files that a compaction has read stay for readers that have listed them.
GRACE = 3600.0
LOGGED = f"{UPLOAD_STATE}, version long"
COLUMNS = ["name", "file_id", "sha256", "chunk_params", "uploaded_at"]


def listed(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing where there is none."""
    fs, at = file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


def log_rows(spark: SparkSession, path: str, batches: Iterable[str] | None = None) -> DataFrame:
    """All rows of the log, or of some of its batches, with versions."""
    items = batches is None
    batches = [b for b in listed(spark, path) if b.startswith("batch=")] if batches is None else list(batches)
    rows = spark.createDataFrame([], LOGGED)
    if batches:
        rows = rows.unionByName(spark.read.schema(LOGGED).parquet(*[f"{path}/{b}" for b in batches]))
    runs = listed(spark, f"{path}/items") if items else []
    if runs:
        found = spark.read.schema(LOGGED).option("pathGlobFilter", "*.json").option("ignoreMissingFiles", True).json([f"{path}/items/{r}" for r in runs])
        rows = rows.unionByName(found.where("file_id is not null").select(*rows.columns))  # no row yet where only the old file has gone
    return rows


def newest(rows: DataFrame) -> DataFrame:
    """Of each name the row of the newest version: partial maxima, so a document's history does not move."""
    rest = [c for c in rows.columns if c != "name"]
    found = rows.groupBy("name").agg(F.max_by(F.struct(*rest), "version").alias("r"))
    return found.select("name", *[F.col(f"r.{c}").alias(c) for c in rest])


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """What has been published; empty where there is no state yet."""
    return newest(log_rows(spark, path)).select(*COLUMNS)


def next_version(spark: SparkSession, path: str) -> int:
    return 1 + (log_rows(spark, path).agg(F.max("version")).first()[0] or 0)


def put(rows: DataFrame, path: str, replaces: list[str] | None = None) -> str:
    """Write rows as one batch and rename it into the log; its name."""
    spark, name = rows.sparkSession, uuid.uuid4().hex
    rows.write.parquet(f"{path}/_new-{name}")
    if replaces is not None:
        fs, at = file_system(spark, f"{path}/_new-{name}/_replaces.json")
        out = fs.create(at, True)
        out.write(bytearray(json.dumps({"batches": replaces, "at": time.time()}).encode()))
        out.close()
    fs, at = file_system(spark, f"{path}/_new-{name}")
    if not fs.rename(at, file_system(spark, f"{path}/batch={name}")[1]):
        raise OSError(f"batch {name} could not be put in place")
    return f"batch={name}"


def save(rows: DataFrame, path: str, version: int) -> None:
    """Add (name, file_id, sha256, chunk_params, uploaded_at) as one version: one job, whatever the number of rows."""
    put(rows.select(*COLUMNS).withColumn("version", F.lit(version).cast("long")), path)


def replaced(spark: SparkSession, path: str, batch: str, until: float) -> list[str]:
    """What a batch has read, if it is a compaction from before a time."""
    fs, at = file_system(spark, f"{path}/{batch}/_replaces.json")
    if not fs.exists(at):
        return []
    stream = fs.open(at)
    try:
        told = json.loads(bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()
    return told["batches"] if told["at"] <= until else []


def forget(spark: SparkSession, path: str, names: Iterable[str]) -> None:
    for name in names:
        remove(spark, f"{path}/{name}")


def compact(spark: SparkSession, path: str, grace: float = GRACE) -> None:
    """Put the newest rows into one batch; what an earlier compaction read longer than grace seconds ago is deleted."""
    batches = [b for b in listed(spark, path) if b.startswith("batch=")]
    if not batches:
        return
    old = {r for b in batches for r in replaced(spark, path, b, time.time() - grace)}
    put(newest(log_rows(spark, path, batches)), path, batches)
    forget(spark, path, old)
