import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import common, toxicity, vectors

DATA = "/root/testdata/sf0.1"


def brute(rows, threshold):
    near = {r["vec_id"]: set() for r in rows}
    groups = {}
    for r in rows:
        e = r["embedding"]
        if r["label"] is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e):
            groups.setdefault((r["label"], len(e)), []).append(r)
    for g in groups.values():
        x = np.array([r["embedding"] for r in g], float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        for i, j in zip(*np.nonzero(x @ x.T >= threshold), strict=True):
            if i != j:
                near[g[i]["vec_id"]].add(g[j]["vec_id"])
    group = {}
    for v in sorted(near):
        todo = [v] if v not in group else []
        while todo:
            u = todo.pop()
            if u not in group:
                group[u] = v
                todo += near[u]
    return {v: (len(near[v]), group[v], group[v] == v) for v in near}


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    centers = rng.normal(size=(5, 12))
    rows = [(i, [float(x) for x in (centers[i % 5] + rng.normal(size=12) * 0.12).astype("f4")], int(i % 2)) for i in range(300)]
    rows += [(400 + i, rows[0][1], 0) for i in range(20)] + [(500, None, 1), (501, [], 1), (502, [0.0] * 12, 1), (503, [1.0] * 12, None), (504, [float("nan")] * 12, 1), (505, [None] * 12, 1), (506, [1.0, 2.0], 1), (507, [2.0, 4.0], 1), (508, [1e30, 2e30], 1)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, label int, part int")
    got = {r["vec_id"]: tuple(r)[1:] for r in vectors.near_duplicates(df, tile=16).collect()}
    assert got == brute(df.collect(), 0.98)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_repeated_ids_stay_one_row_each(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.001], 0), (None, [1.0, 0.0], 0)], "vec_id long, embedding array<float>, label int")
    assert sorted(map(str, (tuple(r) for r in vectors.near_duplicates(df).collect()))) == sorted(map(str, [(1, 1, 1, True), (1, 0, 1, True), (2, 1, 1, False), (None, 0, None, None)]))


def test_components_of_long_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    nodes = spark.createDataFrame([(k,) for k in [*range(41), *range(100, 130), 200, 201, 999]], "id long")
    got = {r["id"]: r["component"] for r in common.components(nodes, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 201: 200, 999: 999}


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    rows = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out and toxic is not null").toPandas()
    assert all((zlib.crc32(str(d).encode()) % 5 == 0) for d in rows["doc_id"])
    bad, good = (rows.loc[rows["toxic"] == c, "score"].to_numpy() for c in (1, 0))
    auc = (bad[:, None] > good[None, :]).mean() + 0.5 * (bad[:, None] == good[None, :]).mean()
    assert auc > 0.9 and (good >= 0.5).mean() < 0.02


def test_likelihoods_sum_to_one():
    grams, word = toxicity.five_grams(["idiot", "ideal", "idiots", "глупо", "глупый"])
    model = toxicity.ClassLetters(*np.unique(grams, return_counts=True))
    shared = toxicity.SharedLetters(*np.unique(grams & (1 << 24) - 1, return_counts=True))
    for head in (int(grams[0]) >> 8, int(grams[3]) >> 8, int(grams[-3]) >> 8, 12345):
        every = np.array([head << 8 | c for c in range(toxicity.SIGNS)])
        assert shared.likelihood(every).sum() == pytest.approx(1)
        assert model.likelihood(every, shared.likelihood(every)).sum() == pytest.approx(1, abs=1e-6)
    # letters of one alphabet are told apart, also outside Latin
    assert all(len(set(toxicity.signs(alphabet).tolist())) == len(alphabet) for alphabet in ("абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"))


def brute_pairs(texts, corpus):
    """P(word | word before) from counts of one class, by the formula, over all words of the corpus."""
    pairs = collections.Counter(p for t in texts for p in set(zip(t, t[1:], strict=False)))
    follows, heads, kinds = collections.Counter(), collections.Counter(), collections.Counter()
    for (v, w), n in pairs.items():
        follows[w] += 1
        heads[v] += n
        kinds[v] += 1
    total, d = sum(corpus.values()), toxicity.CLASS_DISCOUNT

    def of(v, w):
        one = max(follows[w] - d, 0) / sum(follows.values()) + d * len(follows) / sum(follows.values()) * corpus[w] / total
        most = max((n for (a, _), n in pairs.items() if a == v), default=0)
        return one if most <= d else max(pairs[v, w] - d, 0) / heads[v] + min(1, d * kinds[v] / heads[v]) * one

    return of


def test_expressions_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    words = [a + b for a in ("ba", "ke", "lo", "mi") for b in "rstunv"]
    texts = [[str(w) for w in rng.choice(words[: 12 + 12 * (k % 2)], 30)] for k in range(60)]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    sample = toxicity.training_rows(labels, 100).join(docs, "doc_id").withColumn("tune", F.pmod(F.xxhash64("text"), F.lit(3)) == 0).where("not tune").collect()
    corpus = collections.Counter(w for t in texts for w in t)
    toxic, ordinary = (brute_pairs([r["text"].split() for r in sample if r["toxic"] == c], corpus) for c in (1, 0))
    scorer = toxicity.Scorer(model)
    scorer.learn(words)
    text = texts[1]
    got = scorer.expressions(np.array([scorer.known[w] for w in text]))
    known = lambda of, w: of(None, w)
    want = [np.log(known(toxic, text[0]) / known(ordinary, text[0]))] + [np.log(toxic(v, w) / ordinary(v, w)) for v, w in zip(text, text[1:], strict=False)]
    assert got == pytest.approx(want)


def test_no_labels_nulls_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, None, "x"), (None, "", "x"), (3, "퟿ \U0001f600 ñandú", "x")], "doc_id long, text string, toxic string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["predicted"] for r in toxicity.score(docs, none).collect()] == [0] * 4
    some = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, some).count() == 4 and toxicity.score(docs.limit(0), some).count() == 0
    assert toxicity.reject_toxic(docs, some).columns == docs.columns
