"""Coverage metrics, regressions against the last committed snapshot, and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.schema import METRICS
from docloom.sources.trees import read_trees

FAQ_FLOOR, CHARS_FLOOR, DETAIL_LIMIT = 0.7, 0.6, 700


def measure(topic: Column, pages: Column) -> Column:
    """A struct (topic, pages, faqs, files, chars). chars is the length of the tree's JSON with nulls written: our canonical length."""
    segments = F.flatten(F.transform(F.flatten(F.transform(pages, lambda x: x["blocks"])), lambda b: b["segments"]))
    faqs = F.aggregate(segments, F.lit(0), lambda s, x: s + F.coalesce(F.size(x["faqs"]["QAs"]), F.lit(0)) * x["faqs"].isNotNull().cast("int"))
    files = F.aggregate(segments, F.lit(0), lambda s, x: s + F.size(F.filter(tx.lines(F.coalesce(x["files"], F.lit(""))), lambda line: tx.strip(line) != "")))
    many = lambda x: F.coalesce(x, F.lit(0)).cast("long")
    size = F.when(pages.isNull(), 0).otherwise(F.size(pages))
    return F.struct(topic.alias("topic"), size.cast("long").alias("pages"), many(faqs).alias("faqs"), many(files).alias("files"), many(F.length(F.to_json(pages, {"ignoreNullFields": "false"}))).alias("chars"))


def metrics(trees: DataFrame, topic: str = "topic", pages: str = "pages") -> DataFrame:
    """(topic, pages, faqs, files, chars) of trees, or of a stage table, where they were measured as it was written."""
    if "measured" in trees.columns:
        return trees.select("measured.*")
    return trees.select(measure(F.col(topic), F.col(pages)).alias("m")).select("m.*")


def totals(measured: Column) -> list[Column]:
    """Aggregates (n, pages, faqs, files, size) of metrics; size is the summed length of the topics' lines."""
    return [F.count(measured).alias("n"), *[F.coalesce(F.sum(measured[c]), F.lit(0)).alias(c) for c in ("pages", "faqs", "files")], F.coalesce(F.sum(F.length(topic_line(measured))), F.lit(0)).alias("size")]


def no_metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], METRICS)


def previous_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The metrics of the topic files that a folder holds; none for a folder that is not there and for unreadable files."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return no_metrics(spark)
    return metrics(read_trees(spark, folder).where("pages is not null"))


def regressions(new: DataFrame, old: DataFrame) -> DataFrame:
    """(topic, issues): any decrease of pages, FAQs strictly below 70 %, characters strictly below 60 % of the old values.

    Without an old row there are no issues; files are counted but never compared.
    """
    o = old.select("topic", *[F.col(c).alias(f"old_{c}") for c in ("pages", "faqs", "chars")])
    return new.join(o, "topic", "left").select("topic", issues().alias("issues"))


def issues() -> Column:
    """The issues of rows that hold new metrics beside old_pages, old_faqs and old_chars."""
    change = lambda label, c, unit="": F.concat_ws("", F.lit(f"{label} "), f"old_{c}", F.lit("→"), c, F.lit(unit))
    # The texts of issues and summaries are what receivers of alerts read.
    rules = [
        F.when(F.col("pages") < F.col("old_pages"), change("pages", "pages")),
        F.when((F.col("old_faqs") > 0) & (F.col("faqs") < F.col("old_faqs") * FAQ_FLOOR), change("FAQ", "faqs")),
        F.when((F.col("old_chars") > 0) & (F.col("chars") < F.col("old_chars") * CHARS_FLOOR), change("content", "chars", " chars")),
    ]
    return F.array_compact(F.array(*rules))


def topic_line(m: Column) -> Column:
    return F.concat_ws("", F.lit("• "), m["topic"], F.lit(": "), m["pages"], F.lit("p, "), m["faqs"], F.lit(" FAQ, "), m["files"], F.lit(" files"))


def run_summary(per_topic: DataFrame, failed: list[str], order: str = "topic", known: dict[str, int] | None = None) -> DataFrame:
    """(summary): totals, the topics' lines in order if they are short together, and the failed topics.

    The lines are collected only where their summed length is below DETAIL_LIMIT, so the row stays small. known: the
    totals, where they were observed when the topics were written.
    """
    measured = F.struct("topic", "pages", "faqs", "files")
    sums = per_topic.sparkSession.range(1).select(*[F.lit(known[c]).alias(c) for c in ("n", "pages", "faqs", "files", "size")]) if known is not None else per_topic.agg(*totals(measured))
    short = per_topic.select(F.col(order).alias("o"), topic_line(measured).alias("line")).orderBy("o").limit(DETAIL_LIMIT)
    rows = short.agg(F.array_sort(F.collect_list(F.struct("o", "line"))).alias("rows"))
    head = F.concat_ws("", "n", F.lit(f" ok, {len(failed)} failed"))
    total = F.concat_ws("", F.lit("total: "), "pages", F.lit(" pages · "), "faqs", F.lit(" FAQ · "), "files", F.lit(" files"))
    detail = F.when((F.col("size") > 0) & (F.col("size") < DETAIL_LIMIT), F.array_join(F.col("rows.line"), "\n"))
    bad = F.lit(f"failed: {', '.join(failed)}") if failed else F.lit(None).cast("string")
    return sums.crossJoin(F.broadcast(rows)).select(F.concat_ws("\n", head, total, detail, bad).alias("summary"))  # one row each
