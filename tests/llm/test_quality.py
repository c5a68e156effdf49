"""The quality classifier: its features, its fit against the optimum's conditions, and its scores on held-out rows."""

import zlib

import numpy as np
from conftest import DATA

from docloom.llm.quality import BITS, WIDTH, Indicators, Model, dual_descent, log_ratios, score, train

SCHEMA = "doc_id long, text string"


def brute_indicators(text: bytes):
    """Distinct byte n-grams and repetition n-grams, each by its bucket, one at a time."""
    out, padded, words = set(), b" " + text + b" ", text.split()
    for n in (1, 2, 3, 4):
        for i in range(len(padded) - n + 1):
            x = (int.from_bytes(padded[i : i + n], "big") * 0x9E3779B1 + n * 0x85EBCA77) % 2**32
            x = (x ^ x >> 15) * 0x2C1B3C6D % 2**32
            out.add(x >> 32 - BITS)
    for k, gap in enumerate((1, 2)):
        same = "".join(str(int(a == b)) for a, b in zip(words, words[gap:], strict=False))
        for n in range(1, 7):
            out |= {(1 << BITS) + k * 128 + (1 << n) + int(same[i : i + n], 2) for i in range(len(same) - n + 1)}
    return sorted(out)


def test_indicators_of_texts():
    made = Indicators()
    for text in (b"", b"a", b"a a b a a a b", "Ünï ".encode() * 3, b"x\ty\nz " * 9, b"aaaa"):
        assert made.of(text).tolist() == brute_indicators(text)
    assert max(brute_indicators(b"a " * 20)) < WIDTH and not made.met.any()


def test_ratios_against_counting():
    rows, y = [np.array(r) for r in ([1, 2], [1, 3], [1, 2], [2, 4], [2])], np.array([1, 1, 1, -1, -1])
    ratio = log_ratios(rows, y)
    p, q = 3 + 2 + 1 + WIDTH, 2 + 1 + WIDTH
    assert np.isclose(ratio[1], np.log(4 / p) - np.log(1 / q)) and np.isclose(ratio[2], np.log(3 / p) - np.log(3 / q))
    assert ratio[3] == ratio[4] == ratio[5] == 0


def test_dual_descent_meets_the_conditions_of_the_optimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 6))
    y = np.where(x[:, 0] + 0.8 * rng.normal(size=80) > 0, 1.0, -1.0)
    rows = [np.arange(6)] * 80
    w, bias, a = dual_descent(rows, list(x), y, 6, cost=0.7, epochs=5000, enough=1e-9)
    assert np.allclose(w, (a * y) @ x) and np.isclose(bias, (a * y).sum())
    margin = y * (x @ w + bias)
    assert (margin[a == 0] >= 1 - 1e-6).all() and (margin[a == 0.7] <= 1 + 1e-6).all()
    inner = (a > 1e-9) & (a < 0.7 - 1e-9)
    assert np.allclose(margin[inner], 1, atol=1e-6)
    value = (w @ w + bias**2) / 2 + 0.7 * np.maximum(0, 1 - margin).sum()
    assert np.isclose(value, a.sum() - (w @ w + bias**2) / 2)  # the dual's value: no gap


def test_held_out_rows_are_told_apart_and_their_labels_not_used(spark):
    sf = DATA.parent / "sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = {r["doc_id"]: r for r in score(docs, labels).collect()}
    assert len(out) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in out.items())
    told = [(out[i]["score"], q) for i, q in truth.items() if i in out and out[i]["held_out"]]
    good, bad = [s for s, q in told if q == 1], [s for s, q in told if q == 0]
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.97
    assert np.mean([s >= 0.3 for s in good]) > 0.98
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality")
    again = {r["doc_id"]: r["score"] for r in score(docs, turned).collect()}
    assert all(again[i] == r["score"] for i, r in out.items())


def test_whole_score_against_the_formula(spark):
    docs = spark.createDataFrame([(i, ("good words stand here " if i % 2 else "### !! ### !! ") * (1 + i % 5) + str(i)) for i in range(120)], SCHEMA)
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality")
    model = train(docs, labels)
    assert model.slope > 0
    found = {r["doc_id"]: r["score"] for r in score(docs, labels).collect()}
    for r in docs.collect():
        b = brute_indicators(r["text"].encode())
        z = model.slope * (model.gain[b].sum() / np.sqrt(len(b)) + model.bias) + model.offset
        assert np.isclose(found[r["doc_id"]], 1 / (1 + np.exp(-z)), rtol=1e-6)
    assert all((s > 0.5) == bool(i % 2) for i, s in found.items())


def test_edges(spark):
    rows = [(1, None, 0.5), (2, "", 1.0), (None, "a b", None), (4, "a b", 2.0), (4, "a b", 2.0), (5, "word " * 200_000, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (None, 1), (77, 0)], "doc_id long, quality int")
    assert sorted((str(r["doc_id"]), r["score"]) for r in score(docs, labels).collect()) == [(i, 0.5) for i in ("1", "2", "4", "4", "5", "None")]
    both = spark.createDataFrame([(4, 1), (5, 0), (1, 0), (2, 1)], "doc_id long, quality int")
    found = {r["doc_id"]: r["score"] for r in score(docs, both).collect()}
    assert found[1] == found[2] and all(0 <= s <= 1 for s in found.values())
    assert score(docs.limit(0), both).count() == 0
    assert Model(np.zeros(WIDTH), 0.0).probability(np.zeros(1))[0] == 0.5
