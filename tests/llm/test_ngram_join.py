import collections
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest

from docloom.llm import ngram_join as N
from docloom.llm.queries import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    sets = {}
    for doc, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets[doc] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    group = {d: d for d in sets}
    holders = collections.defaultdict(list)
    for d in sorted(sets):
        shared = collections.Counter(e for s in sets[d] for e in holders[s])
        for e, both in shared.items():
            if 100 * both >= 75 * (len(sets[d]) + len(sets[e]) - both) and group[d] != group[e]:
                a, b = sorted((group[d], group[e]))
                group = {k: a if v == b else v for k, v in group.items()}
        for s in sets[d]:
            holders[s].append(d)
    return {d: (len(sets[d]), group[d]) for d in sets}


def made(n=150):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.choice([3, 4, 5, 6, 20, 40, 80]))) for _ in range(12)]
    rows = []
    for i in range(n):
        w = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = rng.choice("abcdefghij") + str(rng.randint(0, 3))
        if rng.random() < 0.3:
            w = w[: max(1, int(len(w) * rng.uniform(0.6, 1)))]
        rows.append((i * 3, " ".join(w) if rng.random() < 0.5 else "\n".join(w).upper()))
    return [*rows, (5000, None), (5001, ""), (5002, "  \n"), (5003, "a"), (5004, "A "), (5005, "É é a b c d"), (5006, "É é a b c d")]


def test_groups_equal_brute_force(spark):
    rows = made()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.jaccard_groups(docs).collect()}
    assert got == brute(rows)
    kept = {r["doc_id"] for r in N.one_of_each_group(docs).collect()}
    assert kept == {c for _, c in got.values()}


def test_null_ids_repeated_rows_and_empty_tables(spark):
    text = "one two three four five six"
    docs = spark.createDataFrame([(None, text), (4, text), (4, text), (9, text)], "doc_id long, text string")
    got = sorted(map(str, (tuple(r) for r in N.jaccard_groups(docs).collect())))
    assert got == sorted(map(str, [(None, 2, None), (4, 2, 4), (4, 2, 4), (9, 2, 4)]))
    assert N.jaccard_groups(docs.limit(0)).count() == 0
    assert sorted(str(r["doc_id"]) for r in N.one_of_each_group(docs).collect()) == ["4", "4", "None"]


def test_threshold_is_met_exactly(spark):
    words = [f"w{k}" for k in range(11)]
    # 7 shingles and 7 of which 6 are shared: 6 / 8 = 75 %
    rows = [(1, " ".join(words)), (2, " ".join([*words[:10], "x"])), (3, " ".join(["y", *words[1:10], "x"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in N.jaccard_groups(docs).collect()} == {1: 1, 2: 1, 3: 1} == {d: c for d, (_, c) in brute(rows).items()}


def brute_links(rows, percent=75):
    sets = {}
    for doc, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets[doc] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    linked = lambda a, b: a and b and 100 * len(a & b) >= percent * len(a | b)
    return {d: sum(bool(linked(sets[d], sets[e])) for e in sets if e != d) for d in sets}


@pytest.mark.parametrize(("tile", "chunk", "bands"), [(256, 1 << 20, 20), (4, 50, 3)])
def test_link_counts_equal_brute_force(spark, monkeypatch, tile, chunk, bands):
    monkeypatch.setattr(N, "LINK_TILE", tile)
    monkeypatch.setattr(N.parted, "__defaults__", (min(tile, 64) // 2,))
    monkeypatch.setattr(N, "BANDS", bands)
    monkeypatch.setattr(N, "LINK_CHUNK", chunk)
    rows = made(200)
    # one leader and many texts that differ from it, and from each other, by one word at the end or the beginning
    w = [f"w{k}" for k in range(40)]
    rows += [(6000 + k, " ".join([f"x{k}", *w[1:]] if k % 2 else [*w[: 39 - k % 5], f"y{k}"])) for k in range(40)] + [(7000, rows[0][1])]
    docs = spark.createDataFrame([*rows, rows[1], (None, rows[0][1])], "doc_id long, text string")
    got = N.jaccard_links(docs).collect()
    want, groups = brute_links(rows), brute(rows)
    assert len(got) == len(rows) + 2
    assert {r["doc_id"]: r["n_links"] for r in got if r["doc_id"] is not None} == want and [r["n_links"] for r in got if r["doc_id"] is None] == [0]
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == groups
    assert N.jaccard_links(docs.limit(0)).count() == 0 and any(n > 20 for n in want.values())


def test_clashing_columns(spark):
    text = "one two three four five six"
    docs = spark.createDataFrame([(1, text, 1, 2, 3), (2, text, 1, 2, 3)], "doc_id long, text string, gone int, component_id int, name int")
    kept = N.one_of_each_group(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, text, 1, 2, 3)]


def test_query_counts_links(spark):
    out = queries()["op3_ngram_jaccard_join"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_shingles", "component_id", "n_links"]


def test_levels_take_little_of_the_driver(spark):
    rows = [(i, f"{text} {i}", i) for i, (_, text) in enumerate(made())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own long").select("doc_id", "own", "text")
    sets = [N.shingle_set(t, 5) for _, t, _ in rows]
    tracemalloc.start()
    try:
        levels = N.frequency_levels(docs, 5, sum(map(len, sets)))
        assert tracemalloc.get_traced_memory()[1] < N.COUNTERS
    finally:
        tracemalloc.stop()
    counts = np.bincount(np.concatenate([(s & np.uint64(N.COUNTERS - 1)).astype(np.int64) for s in sets]), minlength=N.COUNTERS)
    mean = counts.mean()
    want = np.ceil(2 * np.log2(np.maximum(counts / (mean + 3 * np.sqrt(mean) + 1), 1)))
    assert want.max() > 0 and (np.frombuffer(b"".join(map(zlib.decompress, levels)), np.uint8) == want).all()
