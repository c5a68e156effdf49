"""License scan: an exact set-similarity join of text blocks with licence templates.

Blocks are the lines of a text as sets of words, and all windows of its words, across lines, that are as
wide as a template divided by `threshold`: a wrapped template lies in such a window. Template words are ordered
from rare to frequent by how many documents hold them, counted over the whole corpus, and a block is the list of
its template words in that order. A block that holds at least the share `threshold` of a template's words must hold
one of the template's first n - need + 1 words (prefix filter), must have at least `need` words (length filter), and
from the first such word on it must still have `need` words in the global order (positional filter); only then is the
overlap counted. Windows are placed at the prefix words of a template, in texts that as a whole pass its filters.
Templates are a fixed list, so their index is a handful of literals inside the plan and blocks never move: the join
has no shuffle. Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import lower_ascii

WORD, BETWEEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The phrases of the base scan, as words, with their labels.
PHRASES = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
# Short notices in which licences are named, and opening sentences of licence texts.
TEMPLATES: list[tuple[str, str]] = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("proprietary", "all rights reserved no part of this work may be reproduced without the prior written permission of the owner"),
]
#: Share of a template's words that a block must hold.
THRESHOLD = 0.85


def words_of(text: Column) -> Column:
    """The words, by what stands between them: to extract each match would copy the text each time."""
    return F.array_remove(F.split(text, BETWEEN, -1), "")


def literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def document_counts(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> dict[str, int]:
    """In how many documents each template word occurs: one row a template word comes to the driver."""
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    held = docs.select(F.explode(F.array_intersect(words_of(lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))), literal(vocabulary))).alias("word"))
    found = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {w: found.get(w, 0) for w in vocabulary}


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row of docs.

    Null and empty texts have no words, null first_word and last_word, empty labels and score 0. score is the
    largest share of a template that a block holds among those that meet the threshold, and 1 where a base
    phrase stands. Repeated rows give repeated rows; columns besides doc_id and text are ignored.
    """
    counts = document_counts(docs, templates)
    index = []
    for label, text in templates:
        ordered = sorted(set(text.split()), key=lambda w: (counts[w], w))
        need = max(1, math.ceil(threshold * len(ordered) - 1e-9))
        width = math.ceil(len(text.split()) / threshold - 1e-9)
        index.append((label, ordered, need, ordered[: len(ordered) - need + 1], width))
    vocabulary = sorted(counts, key=lambda w: (counts[w], w))
    prefixes = literal([w for w in vocabulary if any(w in p for _, _, _, p, _ in index)])
    vocabulary = literal(vocabulary)
    least = min(need for _, _, need, _, _ in index)

    text = lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("low")).withColumn("words", words_of(F.col("low")))
    word = lambda i: F.get(F.col("words"), i)

    def hit(w: Column, i: Column) -> Column:
        found = F.lit(None).cast("struct<label:string,start:int>")
        for label, phrase in PHRASES.items():
            n = len(phrase)
            stands = i >= n - 1
            for k, part in enumerate(phrase[:-1]):
                stands = stands & (word(F.greatest(i - (n - 1 - k), F.lit(0))) == part)
            found = F.when(stands, F.struct(F.lit(label).alias("label"), (i - (n - 1)).alias("start"))).otherwise(found)
        return F.when(w == "license", found)

    no_hits = F.array().cast("array<struct<label:string,start:int>>")
    hits = F.when(F.contains("low", F.lit("license")), F.filter(F.transform("words", hit), lambda x: x.isNotNull())).otherwise(no_hits)

    def fits(block: Column, need: int, prefix: list[str]) -> Column:
        """Length, prefix and positional filter on a block's template words in the global order."""
        first = F.get(F.array_intersect(block, literal(prefix)), F.lit(0))
        return (F.size(block) >= need) & first.isNotNull() & (F.size(block) - F.array_position(block, first) + 1 >= need)

    def matched(block: Column) -> Column:
        tries = []
        for label, ordered, need, prefix, _ in index:
            n = len(ordered)
            share = F.size(F.array_intersect(literal(ordered), block)) / F.lit(float(n))
            tries.append(F.when(fits(block, need, prefix), F.when(share >= need / n, F.struct(F.lit(label).alias("label"), share.alias("share")))))
        return F.filter(F.array(*tries), lambda x: x.isNotNull())

    no_matches = F.array().cast("array<struct<label:string,share:double>>")
    # most lines go before their words are put in the global order
    hopeful = F.filter(F.transform(F.split("low", "\n", -1), words_of), lambda b: (F.size(b) >= least) & F.arrays_overlap(b, prefixes))
    blocks = F.filter(F.transform(hopeful, lambda b: F.array_intersect(vocabulary, b)), lambda b: F.size(b) >= least)
    matches = F.when(F.arrays_overlap("held", prefixes) & (F.size("held") >= least), F.flatten(F.transform(blocks, matched))).otherwise(no_matches)

    def windowed(ordered: list[str], need: int, prefix: list[str], width: int) -> Column:
        """The largest share of a template that a window holds, if it is enough. A window that is enough holds a prefix word."""
        n = len(ordered)
        count = lambda start, size: F.size(F.array_intersect(literal(ordered), F.slice(F.col("words"), start + 1, size)))
        places = F.filter(F.transform("words", lambda w, i: F.when(w.isin(prefix), i)), lambda i: i.isNotNull())
        first = lambda i: F.greatest(i - (width - 1), F.lit(0))
        near = F.filter(places, lambda i: count(first(i), i - first(i) + width) >= need)
        starts = F.array_distinct(F.flatten(F.transform(near, lambda i: F.sequence(first(i), i))))
        share = F.array_max(F.transform(starts, lambda i: count(i, F.lit(width)))) / F.lit(float(n))
        return F.when(fits(F.col("held"), need, prefix) & (F.size(F.array_intersect(literal(ordered), F.col("held"))) >= need), F.when(share >= need / n, share))

    # one line has no windows that its block does not hold
    wrapped = F.contains("low", F.lit("\n")) & (F.size("held") >= least)
    windows = F.array(*[F.struct(F.lit(label).alias("label"), windowed(ordered, need, prefix, width).alias("share")) for label, ordered, need, prefix, width in index])
    windows = F.when(wrapped, F.filter(windows, lambda x: x["share"].isNotNull())).otherwise(no_matches)

    rows = rows.withColumn("held", F.array_intersect(vocabulary, F.col("words"))).withColumns({"hits": hits, "matches": F.concat(matches, windows)})
    base, both = F.col("hits.label"), F.concat(F.col("hits.label"), F.col("matches.label"))
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size("hits").cast("long").alias("n_base"),
        F.array_min("hits.start").cast("long").alias("first_word"),
        F.array_max("hits.start").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(both)), ",").alias("labels"),
        F.when(F.size("hits") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("matches.share"), F.lit(0.0))).alias("score"),
    )
