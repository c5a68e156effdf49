"""Metrics over a stream of document trees: every micro-batch is compared with the last committed snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.operators.monitor import metrics, regressions
from docloom.schema import METRICS


def latest(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The newest metrics of each topic in a snapshot table, of batches before one; empty if there is none yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], METRICS)
    rows = spark.read.schema(f"{METRICS}, batch long").parquet(path)
    rows = rows if before is None else rows.where(F.col("batch") < before)
    names = [c for c in rows.columns if c not in ("topic", "batch")]
    newest = rows.groupBy("topic").agg(F.max_by(F.struct(*names), "batch").alias("m"))  # partial maxima: a topic's history never moves
    return newest.select("topic", *[F.col(f"m.{c}").alias(c) for c in names])


def watch(trees: DataFrame, snapshots: str, alerts: str, checkpoint: str) -> StreamingQuery:
    """Start a query over a stream of (topic, pages): metrics go to `snapshots`, regressions to `alerts`.

    Tables are partitioned by batch and overwritten by batch, so a batch that is repeated after a failure leaves one copy.
    """

    def commit(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = metrics(batch).persist()
        old = latest(spark, snapshots, number)  # a batch that is repeated does not meet itself
        found = regressions(new, old).where(F.size("issues") > 0)
        for rows, path in ((found, alerts), (new, snapshots)):
            rows.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
        new.unpersist()

    return trees.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
