"""Document trees as JSON, and their stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docloom.schema import TREE


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    """(topic, base_url, pages) of JSON files, the topic by file name. The schema is fixed; unreadable files give null pages."""
    rows = spark.read.schema(TREE).option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", "*.json").json(path)
    return rows.select(F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_name"), "/"), -1), r"\.json$", "").alias("topic"), "base_url", "pages")


def stage(trees: DataFrame, path: str) -> tuple[DataFrame, dict[str, int]]:
    """(the table read back, its totals): trees as Parquet, with the metrics of each topic beside them.

    One job writes the trees, counts each topic and observes the totals, so neither later metrics nor totals read a
    tree again. The totals are those of monitor.totals.
    """
    from docloom.operators import monitor

    seen = Observation()
    measured = trees.withColumn("measured", monitor.measure(F.col("topic"), F.col("pages")))
    measured.observe(seen, *monitor.totals(F.col("measured"))).write.parquet(path)
    return trees.sparkSession.read.schema(measured.schema).parquet(path), {k: v or 0 for k, v in seen.get.items()}


def write_stage(trees: DataFrame, path: str) -> None:
    """Overwrite the partitions of the topics in trees; topics that failed keep their old rows."""
    trees.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("topic").parquet(path)
