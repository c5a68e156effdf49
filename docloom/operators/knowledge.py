"""The knowledge table: Markdown files as rows, search and CSV export; and chat histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.operators import search
from docloom.schema import KNOWLEDGE

#: Characters by which topics are dealt out.
PREFIX = 3


def markdown_files(spark: SparkSession, folder: str) -> DataFrame:
    """(filename, content) of the .md files of a folder; empty files, which Spark's readers pass over, are left out."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(folder)
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("filename"), F.decode("content", "UTF-8").alias("content"))


def knowledge(files: DataFrame) -> DataFrame:
    """(id, topic, content): the topic is the file name without .md; ids count from 1 by topic and promise nothing across loads.

    Ids are given within topics of one beginning, on top of how many come before them, so no task holds all rows.
    """
    rows = files.select(F.replace("filename", F.lit(".md"), F.lit("")).alias("topic"), "content").withColumn("_start", F.left("topic", F.lit(PREFIX)))
    counts = rows.groupBy("_start").agg(F.count("*").alias("_n"))
    before = counts.select("_start", (F.sum("_n").over(Window.orderBy("_start")) - F.col("_n")).alias("_before"))  # a row for each beginning
    own = F.row_number().over(Window.partitionBy("_start").orderBy("topic", "content"))
    return rows.withColumn("_own", own).join(before, "_start").select((F.col("_before") + F.col("_own")).cast("long").alias("id"), "topic", "content")


def load(table: DataFrame, path: str) -> None:
    """Put the table, and the index that find() searches, in place of what the path held: old rows go, whatever topics they were of."""
    table.select(F.col("id").cast("long"), "topic", "content").write.mode("overwrite").parquet(path)
    search.postings(stored(table.sparkSession, path), "id", "topic", "content").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}_grams")


def find(spark: SparkSession, path: str, keyword: str) -> DataFrame:
    """search() of a loaded table by its index: only rows that hold all grams of the keyword are looked at."""
    grams = spark.read.schema(search.POSTINGS).parquet(f"{path}_grams")
    return search.candidates(stored(spark, path), grams, "id", keyword).where(holds(keyword))


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KNOWLEDGE).parquet(path)


def holds(keyword: str) -> Column:
    """Whether topic or content holds a keyword, in any case of letters."""
    plain = keyword.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return F.col("content").ilike(f"%{plain}%") | F.col("topic").ilike(f"%{plain}%")


def search_all(table: DataFrame, keyword: str) -> DataFrame:
    """Rows that hold the keyword, by looking at all of them."""
    return table.where(holds(keyword))


def export_csv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", False).csv(path)


def chat_history(turns: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """(conversation, history): the turns of each conversation in order, as role and content."""
    made = F.array_sort(F.collect_list(F.struct("turn", F.col("role"), F.col("text").alias("content"))))
    return turns.groupBy(conversation).agg(F.transform(made, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("history"))
