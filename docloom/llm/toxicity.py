"""Toxicity by class-conditional Kneser-Ney models over words, expressions and letters.

Each class (toxic, ordinary) has two interpolated Kneser-Ney models, counted on a bounded, hash-ordered sample of
labelled rows: one of words given the word before, so that expressions of two words have a likelihood of their own,
and one of letter five- and four-grams, which knows words by how they are written. Both back off to counts that the
classes share and that come from all documents: a table of how often each word stands in the corpus, which grows with
it, and the letter three-grams. An expression that neither class has seen gets nearly the same likelihood from both.
A text is described by the difference of its log-likelihoods, length-normalised: of both models in the best window of
words, of both in the most telling places, and of letters in the whole text. A logistic curve fitted on held-back
training rows turns that into a probability.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import begin, materialize, worker_cache

#: Labelled rows of each class that the class models may learn from; every third is held back for the curve.
SAMPLE_PER_CLASS = 3000
WINDOW, TOP = 24, 3
#: Discounts of the shared model and of the class models; the latter takes what one document alone has for noise.
DISCOUNT, CLASS_DISCOUNT = 0.75, 1.0
#: Words whose score a Python worker keeps.
CACHE = 300_000
LETTERS = re.compile(r"[^\W\d_]+")
BITS, SIGNS = 8, 256
START, END = 0, 1
FEATURES = 5
U = np.uint64


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


# ---------------------------------------------------------------- letters and grams


def sign_table() -> np.ndarray:
    """Codes of the code points below 384: a-z, then Latin-1 letters, then pairs of Latin Extended-A."""
    table = np.full(0x180, OTHER, np.int64)
    table[START], table[END] = START, END
    table[ord("a") : ord("z") + 1] = np.arange(2, 28)
    table[0xDF:0x100] = np.arange(28, 61)
    table[0x100:0x180] = 61 + np.arange(128) // 2
    return table


#: From this code on, letters of other scripts: neighbouring letters, such as those of one alphabet, have codes of their own.
OTHER = 125
SIGN_TABLE = sign_table()


def signs(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where(points < 0x180, SIGN_TABLE[np.minimum(points, 0x17F)], OTHER + points % (SIGNS - OTHER))


def five_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the five letters that end at each letter of the words (and at their ends), and each one's word."""
    pad = "\x00\x00\x00\x00"
    codes = signs(pad + ("\x01" + pad).join(words) + "\x01")
    grams = np.zeros(len(codes) - 4, np.int64)
    for k in range(5):
        grams = grams << BITS | codes[k : k + len(grams)]
    last = codes[4:]
    word = np.cumsum(last == END) - (last == END)
    kept = last != START
    return grams[kept], word[kept]


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def word_keys(words: list[str]) -> np.ndarray:
    """64-bit names of words."""
    return pd.util.hash_array(np.array(words, object)) if words else np.zeros(0, np.uint64)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = (first * U(0x9E3779B97F4A7C15) ^ second) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(31))


# ---------------------------------------------------------------- models


def look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of sorted keys; 0 for keys that are not there."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


class SharedLetters:
    """P(c | two letters before), interpolated Kneser-Ney over three-gram counts of all documents."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        self.three, n = grams[order], counts[order].astype(float)
        two = np.bincount(self.three & SIGNS**2 - 1, minlength=SIGNS**2).reshape(SIGNS, SIGNS).astype(float)
        one = (two > 0).sum(axis=0) + 0.5
        total = two.sum(axis=1, keepdims=True)
        safe = np.maximum(total, 1)
        lower = one / one.sum()
        self.two = np.where(total > 0, np.maximum(two - DISCOUNT, 0) / safe + DISCOUNT * (two > 0).sum(axis=1, keepdims=True) / safe * lower, lower)
        head = self.three >> BITS
        total, kinds = np.bincount(head, n, SIGNS**2), np.bincount(head, minlength=SIGNS**2)
        self.left = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
        self.share = np.maximum(n - DISCOUNT, 0) / total[head]

    def likelihood(self, grams: np.ndarray) -> np.ndarray:
        three = grams & (1 << 3 * BITS) - 1
        return look(self.three, self.share, three) + self.left[three >> BITS] * self.two.ravel()[three & SIGNS**2 - 1]


class ClassLetters:
    """Five- and four-gram counts of one class as sorted codes."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        self.g5, self.n5 = grams[order], counts[order].astype(float)
        self.h4, self.t5, self.d5 = self.contexts(self.g5, self.n5)
        four, where, kinds = np.unique(self.g5 & (1 << 4 * BITS) - 1, return_inverse=True, return_counts=True)
        raw = np.bincount(where, self.n5, len(four))
        # a gram that begins before its word has no letters to its left: its own count stands for the continuations
        self.g4, self.n4 = four, np.where(four >> 3 * BITS == START, raw, kinds).astype(float)
        self.h3, self.t4, self.d4 = self.contexts(self.g4, self.n4)

    @staticmethod
    def contexts(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        heads, where, kinds = np.unique(grams >> BITS, return_inverse=True, return_counts=True)
        return heads, np.bincount(where, counts, len(heads)), kinds.astype(float)

    def likelihood(self, grams: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """P(last letter | four before)."""
        four = grams & (1 << 4 * BITS) - 1
        for g, keys, values, heads, totals, kinds in ((four, self.g4, self.n4, self.h3, self.t4, self.d4), (grams, self.g5, self.n5, self.h4, self.t5, self.d5)):
            n, total, kind = look(keys, values, g), look(heads, totals, g >> BITS), look(heads, kinds, g >> BITS)
            safe = np.maximum(total, 1)
            shared = np.where(total > 0, np.maximum(n - CLASS_DISCOUNT, 0) / safe + CLASS_DISCOUNT * np.minimum(kind / safe, 1) * shared, shared)
        return shared


class ClassWords:
    """P(word | word before) of one class: words by how many words they follow, pairs by how many documents hold them.

    words: (key, follows) and heads: (key, total, kinds), sorted by key; pairs: (key, n, head's total), sorted. What
    occurs once is discounted to nothing, so only the totals know of it.
    """

    def __init__(self, words: tuple[np.ndarray, ...], heads: tuple[np.ndarray, ...], pairs: tuple[np.ndarray, ...], follows: float, kinds: float):
        self.words, self.heads, self.pairs = words, heads, pairs
        self.follows, self.backoff = max(follows, 1.0), min(1.0, CLASS_DISCOUNT * kinds / max(follows, 1.0)) if follows else 1.0

    def of_word(self, keys: np.ndarray, shared: np.ndarray) -> np.ndarray:
        return np.maximum(look(*self.words, keys) - CLASS_DISCOUNT, 0) / self.follows + self.backoff * shared

    def left(self, keys: np.ndarray) -> np.ndarray:
        """What a word leaves for the words behind it that it was not seen with."""
        total, kinds = look(self.heads[0], self.heads[1], keys), look(self.heads[0], self.heads[2], keys)
        return np.where(total > 0, np.minimum(1.0, CLASS_DISCOUNT * kinds / np.maximum(total, 1)), 1.0)

    def of_pair(self, pairs: np.ndarray) -> np.ndarray:
        keys, n, total = self.pairs
        return look(keys, np.maximum(n - CLASS_DISCOUNT, 0) / np.maximum(total, 1), pairs)


@dataclass
class Model:
    """What scoring needs: bounded by the sample size and the number of letters, not by the corpus.

    shared_words: sorted keys and shares in the corpus of the words that a class knows. For a word that neither knows
    the share is the same factor in both likelihoods, so any number does.
    """

    letters: SharedLetters
    toxic: ClassLetters
    ordinary: ClassLetters
    toxic_words: ClassWords
    ordinary_words: ClassWords
    shared_words: tuple[np.ndarray, np.ndarray]
    rare: float
    weights: np.ndarray | None = None
    name: str = ""

    def word_scores(self, words: list[str]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) by letters."""
        if not words:
            return np.zeros(0)
        grams, word = five_grams(words)
        codes, where = np.unique(grams, return_inverse=True)
        base = self.letters.likelihood(codes)
        gain = np.log(self.toxic.likelihood(codes, base)) - np.log(self.ordinary.likelihood(codes, base))
        return np.bincount(word, gain[where], len(words))

    def probability(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(features))
        z = features @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


class Scorer:
    """Features of texts; keeps what it knows of words met before, up to CACHE of them."""

    def __init__(self, model: Model):
        self.model = model
        self.pairs = np.unique(np.concatenate((model.toxic_words.pairs[0], model.ordinary_words.pairs[0])))
        self.seen = np.stack([c.of_pair(self.pairs) for c in (model.toxic_words, model.ordinary_words)])
        self.marks = np.zeros(1 << 22, bool)  # by their last bits, to leave most pairs out before the search
        self.marks[(self.pairs & U(len(self.marks) - 1)).astype(np.int64)] = True
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        # letters' gain, size, P(word) by class, what it leaves by class, logs of the ratios of both
        self.table = np.zeros((8, 1 << 12))
        self.keys = np.zeros(1 << 12, np.uint64)

    def learn(self, words: list[str]) -> None:
        m, at, n = self.model, len(self.known), len(words)
        if at + n > len(self.keys):
            room = max(at + n, 2 * len(self.keys))
            self.table = np.hstack((self.table, np.zeros((8, room - self.table.shape[1]))))
            self.keys = np.concatenate((self.keys, np.zeros(room - len(self.keys), np.uint64)))
        keys = word_keys(words)
        shared = look(*m.shared_words, keys)
        shared = np.where(shared > 0, shared, m.rare)
        toxic, ordinary = m.toxic_words.of_word(keys, shared), m.ordinary_words.of_word(keys, shared)
        left_t, left_o = m.toxic_words.left(keys), m.ordinary_words.left(keys)
        self.keys[at : at + n] = keys
        self.table[:, at : at + n] = m.word_scores(words), np.fromiter(map(len, words), float, n) + 1, toxic, ordinary, left_t, left_o, np.log(toxic / ordinary), np.log(left_t / left_o)
        self.known.update(zip(words, range(at, at + n), strict=True))

    def expressions(self, index: np.ndarray) -> np.ndarray:
        """log P(word | word before, toxic) - log P(word | word before, ordinary) of each word of a text."""
        _, _, toxic, ordinary, left_t, left_o, of_word, of_left = self.table
        gain = of_word[index]
        before, after = index[:-1], index[1:]
        gain[1:] += of_left[before]  # as if no pair had been seen
        pairs = pair_keys(self.keys[before], self.keys[after])
        some = np.flatnonzero(self.marks[(pairs & U(len(self.marks) - 1)).astype(np.int64)])
        if len(some):
            at = np.minimum(np.searchsorted(self.pairs, pairs[some]), len(self.pairs) - 1)
            met = self.pairs[at] == pairs[some]
            some, at = some[met], at[met]
            v, w = before[some], after[some]
            gain[some + 1] = np.log((self.seen[0][at] + left_t[v] * toxic[w]) / (self.seen[1][at] + left_o[v] * ordinary[w]))
        return gain

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Log-likelihood differences: by letters in the best window, the top words and the whole text; by words in the best window and the top places."""
        split = [words_of(t) for t in texts]
        new = list({w for words in split for w in words}.difference(self.known))
        if len(self.known) + len(new) > CACHE:
            self.clear()
            new = list({w for words in split for w in words})
        if new:
            self.learn(new)
        out = np.zeros((len(texts), FEATURES))
        for k, words in enumerate(split):
            if not words:
                continue
            index = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            gain, size = self.table[0][index], self.table[1][index]
            a, b = np.concatenate([[0], np.cumsum(gain)]), np.concatenate([[0], np.cumsum(size)])
            width = min(WINDOW, len(words))
            best = ((a[width:] - a[:-width]) / (b[width:] - b[:-width])).max()
            said = self.expressions(index)
            c = np.concatenate([[0], np.cumsum(said)])
            top = lambda x: np.partition(x, -min(TOP, len(x)))[-min(TOP, len(x)) :].sum() / TOP
            out[k] = best, top(gain), a[-1] / b[-1], (c[width:] - c[:-width]).max() / width, top(said)
        return out


def scorer(model: Model) -> Scorer:
    """One scorer for each Python worker, of the model in use."""
    held = worker_cache("toxicity", "scorer", dict)
    if held.get("name") != model.name:
        held.clear()
        held.update(name=model.name, scorer=Scorer(model))
    return held["scorer"]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights and offset by Newton steps on standardised features."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    keep = np.diag([ridge * len(x) / 100] * (z.shape[1] - 1) + [1e-9])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + keep, z.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    slope = w[:-1] / scale
    return np.append(slope, w[-1] - slope @ mean)


# ---------------------------------------------------------------- counting and scoring


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(word, key, n): how often each letter three-gram (word: false) and each word (true) stands in all documents.

    The table grows with the corpus; it is written to the shared folder and summed before it is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("toxicity")
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                counts: Counter[str] = Counter()
                for t in batch.column(0)[at : at + 1024].to_pylist():
                    counts.update(words_of(t))
                if not counts:
                    continue
                words, times = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
                grams, word = five_grams(words)
                three, where = np.unique(grams & (1 << 3 * BITS) - 1, return_inverse=True)
                n = np.bincount(where, times[word], len(three)).astype(np.int64)
                for kind, keys, sums in ((False, three, n), (True, word_keys(words).view(np.int64), times)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind)), pa.array(keys, pa.int64()), pa.array(sums, pa.int64())], names=["word", "key", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "word boolean, key long, n long")
    return materialize(counted.groupBy("word", "key").agg(F.sum("n").alias("n")), "corpus_counts")


def training_rows(labels: DataFrame, limit: int) -> DataFrame:
    """(doc_id, toxic) of at most limit rows of each class, never held-out ones; conflicting labels count as toxic."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    rows = rows.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    some = rows.where("toxic = 1").orderBy(order, "doc_id").limit(limit).union(rows.where("toxic = 0").orderBy(order, "doc_id").limit(limit))
    return some


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on labelled rows of docs. Without rows of both classes the model has no curve and scores 0."""
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(training_rows(labels, limit)), "doc_id")
    # copies count once; a third of the texts is held back for the curve
    sample = sample.groupBy("text", "toxic").agg(F.min("doc_id").alias("doc_id")).withColumn("tune", F.pmod(F.xxhash64("text"), F.lit(3)) == 0)

    sample = materialize(sample, "toxicity_sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Five-grams (kind 0) by the words of each text, and pairs of words (kind 1), each once a text."""
        begin("toxicity")
        for batch in batches:
            for toxic in (0, 1):
                split = [words_of(t) for t, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if c == toxic]
                counts: Counter[str] = Counter()
                for words in split:
                    counts.update(set(words))
                if not counts:
                    continue
                grams, word = five_grams(list(counts))
                codes, where = np.unique(grams, return_inverse=True)
                times = np.fromiter(counts.values(), np.int64, len(counts))
                n = np.bincount(where, times[word], len(codes)).astype(np.int64)
                pairs = Counter(p for words in split for p in set(zip(words, words[1:], strict=False)))
                v, w = (word_keys([p[k] for p in pairs]).view(np.int64) for k in (0, 1))
                for kind, first, second, sums in ((0, codes, np.zeros(len(codes), np.int64), n), (1, v, w, np.fromiter(pairs.values(), np.int64, len(pairs)))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), x, np.int32)) for x in (toxic, kind)] + [pa.array(x, pa.int64()) for x in (first, second, sums)], names=["toxic", "kind", "a", "b", "n"])

    counted = sample.where("not tune").select("text", "toxic").mapInArrow(count, "toxic int, kind int, a long, b long, n long")
    counted = materialize(counted.groupBy("toxic", "kind", "a", "b").agg(F.sum("n").alias("n")), "class_counts")
    grams = counted.where("kind = 0").toPandas()
    letters = [ClassLetters(*(grams.loc[grams["toxic"] == c, k].to_numpy(np.int64) for k in ("a", "n"))) for c in (0, 1)]
    corpus = corpus_counts(docs)
    three = corpus.where("not word").toPandas()
    words, shared, rare = class_words(counted.where("kind = 1"), corpus.where("word"))
    model = Model(SharedLetters(three["key"].to_numpy(np.int64), three["n"].to_numpy(float)), letters[1], letters[0], words[1], words[0], shared, rare, name=uuid.uuid4().hex)
    columns = [f"f{k}" for k in range(FEATURES)]
    tune = scored(sample.where("tune").select("doc_id", "text", "toxic"), model, ["toxic"]).toPandas()
    x, y = tune[columns].to_numpy(), tune["toxic"].to_numpy(float)
    if len(set(y)) == 2:
        model.weights, model.name = logistic(x, y), uuid.uuid4().hex
    return model


def class_words(pairs: DataFrame, corpus: DataFrame) -> tuple[list[ClassWords], tuple[np.ndarray, np.ndarray], float]:
    """The word models of both classes, and the shares in the corpus of the words they know.

    pairs: (toxic, a, b, n) of the sample; corpus: (key, n) of all documents, of which the classes' words come to the driver.
    """

    def sorted_columns(pdf: pd.DataFrame, key: np.ndarray, *columns: str) -> tuple[np.ndarray, ...]:
        order = np.argsort(key)
        return key[order], *[pdf[c].to_numpy(float)[order] for c in columns]

    follows = pairs.groupBy("toxic", F.col("b").alias("key")).agg(F.count("*").alias("n"))
    heads = pairs.groupBy("toxic", F.col("a").alias("key")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.max("n").alias("most"))
    seen = pairs.where(F.col("n") > CLASS_DISCOUNT).join(heads.select("toxic", F.col("key").alias("a"), "total"), ["toxic", "a"]).toPandas()
    sums = {r["toxic"]: (float(r["follows"]), float(r["kinds"])) for r in follows.groupBy("toxic").agg(F.sum("n").alias("follows"), F.count("*").alias("kinds")).collect()}
    known, leading = follows.where(F.col("n") > CLASS_DISCOUNT).toPandas(), heads.where(F.col("most") > CLASS_DISCOUNT).toPandas()
    out = []
    for c in (0, 1):
        w, h, p = (x[x["toxic"] == c] for x in (known, leading, seen))
        of = lambda x, name="key": x[name].to_numpy(np.int64).view(np.uint64)
        out.append(ClassWords(sorted_columns(w, of(w), "n"), sorted_columns(h, of(h), "total", "kinds"), sorted_columns(p, pair_keys(of(p, "a"), of(p, "b")), "n", "total"), *sums.get(c, (0.0, 0.0))))
    total = corpus.agg(F.sum("n")).first()[0] or 1
    wanted = corpus.join(F.broadcast(follows.where(F.col("n") > CLASS_DISCOUNT).select("key").distinct()), "key").toPandas()
    keys = wanted["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return out, (keys[order], wanted["n"].to_numpy(float)[order] / total), 1 / total


def scored(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Features f0, f1, ... and the probability p beside the kept columns; the model travels once as a broadcast."""
    keep = keep or []
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = scorer(shipped.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = held.features(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *[pa.array(x[:, k]) for k in range(FEATURES)], pa.array(shipped.value.probability(x))], names=[*keep, *columns, "p"])

    columns = [f"f{k}" for k in range(FEATURES)]
    schema = docs.select(*keep).schema
    for c in (*columns, "p"):
        schema = schema.add(c, "double")
    return docs.select(F.col("text").cast("string"), *keep).mapInArrow(run, schema)


def score(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs.

    Null and empty texts score like a text without words. Labels of rows that are not in docs, or null, are
    not used; repeated rows give repeated rows; an empty table gives none.
    """
    model = train(docs, labels, limit)
    out = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, ["doc_id"])
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("p").alias("score"), (F.col("p") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_PER_CLASS) -> DataFrame:
    """docs without the rows that the model predicts to be toxic; columns as they are."""
    model = train(docs, labels, limit)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = scorer(shipped.value)
        for batch in batches:
            p = [shipped.value.probability(held.features(batch.column(at)[k : k + 512].to_pylist())) for k in range(0, batch.num_rows, 512)]
            if p:
                yield batch.filter(pa.array(np.concatenate(p) < 0.5))

    return docs.mapInArrow(run, docs.schema)
