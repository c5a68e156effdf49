"""What the training-data operators share: tables, durable intermediate results, components."""

from __future__ import annotations

import ctypes
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir.

    Where the session sets none, a local master gets a temporary folder, made once; a cluster gets an error, since
    no folder of one machine would do there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        held = context._jsc.sc().getCheckpointDir()
        if held.isEmpty():
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="docloom-"))
            held = context._jsc.sc().getCheckpointDir()
        found = held.get()
    return found.rstrip("/")


def materialize(df: DataFrame, name: str, **options: Any) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends at replicated files. options are the writer's."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/docloom/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.docloom_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a materialized table, once everything that reads it has been written itself."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(df.docloom_path)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of an Arrow batch for Python workers, where small_batches() holds. Spark's own limit is 64 MB, of which the JVM
#: has several copies at times and the worker another.
BATCH_BYTES = 8 << 20
#: The setting of each session in which small_batches() holds, and how often it was entered.
_own_limit: dict[SparkSession, tuple[str | None, int]] = {}
_limit_lock = threading.Lock()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python workers get batches of BATCH_BYTES and a row at most in what runs meanwhile; then the session's limit holds again."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    with _limit_lock:
        own, inside = _own_limit.get(spark) or (spark.conf.get(key, None), 0)
        spark.conf.set(key, str(BATCH_BYTES))
        _own_limit[spark] = own, inside + 1
    try:
        yield
    finally:
        with _limit_lock:
            own, inside = _own_limit.pop(spark)
            if inside > 1:
                _own_limit[spark] = own, inside - 1
            elif own is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, own)


#: What this Python worker keeps between tasks: the kind of work, and its caches by key.
_kept: dict[str, dict[Any, Any]] = {}


def begin(kind: str) -> None:
    """Drop what this Python worker keeps for any other kind of work.

    Workers are reused by all queries and stages of a session, so what one leaves behind would add to the next one's memory.
    """
    if kind not in _kept:
        old = bool(_kept)
        _kept.clear()
        _kept[kind] = {}
        if old:
            trim()


def worker_cache(kind: str, key: Any, make: Callable[[], Any]) -> Any:
    """A cache that a Python worker keeps from task to task of one kind of work."""
    begin(kind)
    held = _kept[kind]
    if key not in held:
        held[key] = make()
    return held[key]


def trim() -> None:
    """Give free memory back to the system, where the C library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def fits_broadcast(df: DataFrame, max_rows: int) -> bool:
    """Whether a materialized table has at most max_rows rows (its Parquet footers tell)."""
    return df.count() <= max_rows


#: Stands for a null doc_id.
NO_ID = -(2**63)
#: Ids of several texts that may be broadcast to the rows.
BROADCAST_SHARED = 1_000_000


def row_keys(docs: DataFrame) -> tuple[DataFrame, bool]:
    """((doc_id, text, key), whether any id has several texts): key tells rows apart that differ in id or text.

    It is the doc_id (NO_ID for null), and for an id that stands for several texts a hash of both, so that no text is
    taken for another one. Equal rows have equal keys. The ids' least and greatest hashes of texts find these ids, by
    partial aggregates of two numbers a row.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = rows.withColumn("key", F.coalesce("doc_id", F.lit(NO_ID)))
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    shared = named.groupBy(F.col("key").alias("shared")).agg(F.min(hashed).alias("low"), F.max(hashed).alias("high")).where("low < high").select("shared")
    shared = materialize(shared, "shared_ids")
    if shared.isEmpty():
        return named, False
    pick = F.broadcast(shared) if fits_broadcast(shared, BROADCAST_SHARED) else shared
    found = named.join(pick, F.col("key") == F.col("shared"), "left")
    return found.select("doc_id", "text", F.when(F.col("shared").isNotNull(), F.xxhash64("key", hashed)).otherwise(F.col("key")).alias("key")), True


def lower_ascii(column: Column) -> Column:
    """A-Z to a-z and nothing else; null stays null."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def spanning(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest node that the pairs connect it with."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Connected components: (id, component) with component the smallest id reachable.

    nodes has id, edges has a and b; both long. Alternates large-star and small-star rounds until
    the edge set is a star around each component's smallest id. Each round is written to the shared
    folder; nothing but one number for each round reaches the driver. Stars are built with partial
    minima, so a hub of any size pre-aggregates. Null ends and loops are ignored.
    """
    e = (
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    e = materialize(e, "edges")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s"))
            .select("s.u", "s.v")
            .where("u <> v")
            .distinct()
        )
        last, e = e, materialize(small, "star")
        release(last)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    found = e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    return nodes.select("id").distinct().join(found, "id", "left").select("id", F.least("id", F.coalesce("component", "id")).alias("component"))
