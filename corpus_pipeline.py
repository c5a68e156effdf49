"""The corpus pipeline: toxicity, line dedup, n-gram Jaccard join, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import materialize, table
from docloom.llm.lines import line_dedup
from docloom.llm.ngram_join import one_of_each_group
from docloom.llm.packing import best_fit_pack
from docloom.llm.pii import mask
from docloom.llm.queries import tokenizer_path
from docloom.llm.toxicity import reject_toxic
from docloom.session import ship


#: Words that a Python worker keeps encoded: fewer than packing alone would, as workers serve all stages in turn.
WORDS_KEPT = 50_000


def with_length(docs: DataFrame) -> DataFrame:
    """n_chars, where docs has it, follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model predicts to be toxic go."""
    ship(spark)
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut; a document of which nothing is left goes, one that was empty before stays."""
    ship(spark)
    cut = line_dedup(docs)
    return with_length(cut.where((F.col("n_deleted") == 0) | (F.col("n_deleted") < F.col("n_lines"))).select(*docs.columns))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    ship(spark)
    return one_of_each_group(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked by kind."""
    ship(spark)
    return with_length(mask(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    ship(spark)
    return best_fit_pack(docs, tokenizer_path("word_bpe_49k.json"), words=WORDS_KEPT)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Models, shingle groups and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each stage's output is a written table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
