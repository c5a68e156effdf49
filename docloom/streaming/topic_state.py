"""Metrics of each topic kept as streaming state: a new tree is compared with the last one of its topic.

The state holds one row of numbers a topic and is dealt out by topic, so no history is read again; a topic that is not
seen for some time is forgotten. The rules themselves are those of the batch plan, as expressions on the compared rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from docloom.operators.monitor import issues, measure

COUNTS = ("pages", "faqs", "files", "chars")
STATE = ", ".join(f"{c} long" for c in COUNTS)
COMPARED = f"topic string, at timestamp, {STATE}, " + ", ".join(f"old_{c} long" for c in COUNTS)
#: The state store that this operator needs.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A topic that is not seen for so long has no last metrics.
KEEP_DAYS = 90


class LastMetrics(StatefulProcessor):
    """Puts the topic's last metrics beside each new row."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", STATE, self.keep_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803  names of the interface
        old = tuple(self.last.get()) if self.last.exists() else None
        told = sorted((row["at"], *(row[c] for c in COUNTS)) for row in rows)
        for at, *new in told:
            yield Row(topic=key[0], at=at, **dict(zip(COUNTS, new, strict=True)), **{f"old_{c}": x for c, x in zip(COUNTS, old or [None] * len(COUNTS), strict=True)})
            old = tuple(new)
        if told:
            self.last.update(old)


def use_state_store(spark: SparkSession) -> None:
    """State of this kind lives in the RocksDB store; a session that has another one set is left to its choice."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, "").endswith("HDFSBackedStateStoreProvider") or not spark.conf.get(key, ""):
        spark.conf.set(key, PROVIDER)


def compared(trees: DataFrame, keep_days: float = KEEP_DAYS) -> DataFrame:
    """(topic, at, pages, faqs, files, chars, issues) of a stream (topic, pages, at): each tree against the last one of its topic.

    Trees of a topic that come in one micro-batch are compared in the order of `at`.
    """
    use_state_store(trees.sparkSession)
    rows = trees.select("at", measure(F.col("topic"), F.col("pages")).alias("m")).select("at", "m.*")
    pairs = rows.groupBy("topic").transformWithState(LastMetrics(int(keep_days * 86_400_000)), COMPARED, "Append", "ProcessingTime")
    return pairs.select("topic", "at", *COUNTS, issues().alias("issues"))


def watch_topics(trees: DataFrame, alerts: str, checkpoint: str, keep_days: float = KEEP_DAYS) -> StreamingQuery:
    """Write what regressed to a table of alerts, each once, also over restarts from the checkpoint.

    It takes what is there and ends. Expiry is by processing time, for which batches without data would follow each
    other without end, so this query starts with those switched off; expired state goes with the batches that have data.
    """
    found = compared(trees, keep_days).where(F.size("issues") > 0)
    conf, idle = trees.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(idle)
    conf.set(idle, "false")
    try:
        return started(found, alerts, checkpoint)
    finally:
        conf.set(idle, before)


def started(found: DataFrame, alerts: str, checkpoint: str) -> StreamingQuery:
    return found.writeStream.format("parquet").outputMode("append").option("path", alerts).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
