"""Matching operators: labels to links, and answers in documents of any number. What goes where in a page is in placement."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote, urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udf
from pyspark.sql.pandas.types import to_arrow_schema

from docloom.functions import text as tx

#: Probes that one automaton holds.
MOST_PROBES = 200_000


def join_url(base: Column, href: Column) -> Column:
    return udf(lambda b, h: None if h is None else urljoin(b or "", h), "string", useArrow=True)(base, href)


def quote_url(url: Column) -> Column:
    """Characters outside ASCII as percent codes; codes and reserved characters stay."""
    return udf(lambda u: None if u is None else quote(u, safe="/:?#[]@!$&'()*+,;=~%"), "string", useArrow=True)(url)


def resolve_labels(labels: DataFrame, links: DataFrame, keys: list[str], base: str = "base_url") -> DataFrame:
    """(keys, label_pos, label, url) for labels of pages, in label order; labels without a link are left out.

    labels: keys, label_pos, label, base. links: keys, pos, text, href. A label takes the first link whose text equals it,
    else the first that contains it, else the first of at least eight characters that it contains. A tier whose first
    link has an empty href falls through to the next tier.
    """
    l = labels.withColumn("_l", tx.norm(F.col("label")))  # noqa: E741
    text = F.col("text")
    tier = F.when(text == F.col("_l"), 1).when(F.contains(text, F.col("_l")), 2).when(F.contains(F.col("_l"), text) & (F.length(text) >= tx.MIN_CONTAINED), 3)
    # a link can be first in a later tier although an earlier tier has taken it before: every tier it fits counts
    fits = F.array_compact(F.array(F.when(text == F.col("_l"), 1), F.when(F.contains(text, F.col("_l")), 2), F.when(F.contains(F.col("_l"), text) & (F.length(text) >= tx.MIN_CONTAINED), 3)))
    met = l.join(links, keys).where(tier.isNotNull()).withColumn("tier", F.explode(fits))
    first = met.groupBy(*keys, "label_pos", "label", base, "tier").agg(F.min_by("href", "pos").alias("href"))
    best = first.where("href <> ''").groupBy(*keys, "label_pos", "label", base).agg(F.min_by("href", "tier").alias("href"))
    return best.select(*keys, "label_pos", "label", join_url(F.col(base), F.col("href")).alias("url"))


def present_answers(answers: DataFrame, blobs: DataFrame, answer_key: str, blob_key: str, most: int = MOST_PROBES) -> DataFrame:
    """(answer_key, blob_key) of the answers whose beginning a blob holds, for any blob; answer and blob are content-normalised.

    Up to `most` probes, of at most 40 characters each, travel to the workers as one automaton that reads each blob once.
    Beyond that, probes and blobs meet by the hash of a probe's first characters, and only those that meet are compared.
    """
    probes = answers.where(F.length("answer") >= tx.MIN_ANSWER).select(answer_key, F.left("answer", F.lit(tx.ANSWER_PROBE)).alias("probe"))
    if probes.limit(most + 1).count() > most:
        places = F.sequence(F.lit(1), F.greatest(F.length("blob") - (tx.MIN_ANSWER - 1), F.lit(1)))
        starts = F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.substr("blob", i, F.lit(tx.MIN_ANSWER)))))
        wanted = probes.withColumn("h", F.xxhash64(F.left("probe", F.lit(tx.MIN_ANSWER))))
        found = blobs.select(blob_key, "blob", F.explode(starts).alias("h")).join(wanted, "h")
        return found.where(F.contains("blob", "probe")).select(answer_key, blob_key).distinct()
    keys: dict[str, list] = {}
    for row in probes.toLocalIterator():
        keys.setdefault(row["probe"], []).append(row[answer_key])
    shipped = answers.sparkSession.sparkContext.broadcast(keys)
    schema = T.StructType([answers.schema[answer_key], blobs.schema[blob_key]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for probe in shipped.value:
            machine.add_word(probe, probe)
        if shipped.value:
            machine.make_automaton()
        for batch in batches:
            hits = [(key, blob) for blob, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if text and shipped.value for probe in {p for _, p in machine.iter(text)} for key in shipped.value[probe]]
            if hits:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*hits, strict=True), to_arrow_schema(schema).types, strict=True)], names=schema.names)

    return blobs.select(blob_key, "blob").mapInArrow(read, schema)
