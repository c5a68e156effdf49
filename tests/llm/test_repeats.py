import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from docloom.llm import repeats


def brute(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for (doc, _), b in zip(rows, raw, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        out.append((doc, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest(), left))
    return out


def made():
    rng = random.Random(2)
    rnd = lambda n: "".join(rng.choice("abé \n") for _ in range(n))
    common = [rnd(rng.randint(15, 60)) for _ in range(6)] + ["a" * 50, "ab" * 40]
    rows = [(i, "".join(rng.choice([rnd(rng.randint(0, 40)), rng.choice(common), rng.choice(common)[:30]]) for _ in range(rng.randint(0, 6)))) for i in range(100)]
    return [*rows, (900, None), (901, ""), (902, rows[3][1] + "z"), (903, "q" * 19)]


def test_equals_brute_force_whatever_way_names_are_merged(spark):
    rows = made()
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, name int")
    want = sorted((*a[:5], *b[2:4], a[5]) for a, b in zip(brute(rows, 20), brute(rows, 12), strict=True))
    for large in (10**6, 60):
        assert sorted(map(tuple, repeats.remove_repeats(docs, 20, 7, (12, 5), large).collect())) == want


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x" * 9 + "abcdefghij"), (1, "x" * 9 + "abcdefghij"), (None, "0123456789abcdef"), (3, "0123456789")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in repeats.remove_repeats(docs, 10, 4, (6, 3)).collect())
    assert got == [("1", 19), ("1", 19), ("3", 10), ("None", 10)]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_long_text(spark):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(60_000))
    docs = spark.createDataFrame([(1, text + "-" + text[10_000:10_500]), (2, "y")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in repeats.remove_repeats(docs).collect()}
    assert got == {1: (1000, 2), 2: (0, 0)}


def test_many_texts_are_hashed_and_compared_at_once(monkeypatch):
    rng = random.Random(4)
    texts = [repeats.raw("".join(rng.choice("ab \n") for _ in range(rng.choice([0, 5, 11, 12, 19, 20, 21, 90])))) for _ in range(300)]
    sizes = [(20, 7), (12, 5)]
    alone = [repeats.anchors([t], sizes) for t in texts]
    want = sorted((a, b, i, *rest) for i, f in enumerate(alone) for a, b, _, *rest in zip(*map(np.ndarray.tolist, f), strict=True))
    made, hashes = [], repeats.Hashes
    monkeypatch.setattr(repeats, "Hashes", lambda *a: made.append(a) or hashes(*a))
    assert sorted(zip(*map(np.ndarray.tolist, repeats.anchors(texts, sizes)), strict=True)) == want
    assert len(made) == 2

    contexts = [(k // 3, k % 2, bytes(rng.choice(b"ab") for _ in range((20, 12)[k % 2] + rng.randint(0, 6)))) for k in range(300)]
    columns = {"name": [c[0] for c in contexts], "which": [c[1] for c in contexts], "back": [7] * 300, "context": [c[2] for c in contexts]}
    keys, row, start = repeats.windows(pa.RecordBatch.from_pydict(columns), sizes)
    assert len(made) == 3
    strings = [(name, (20, 12)[which], at, context[at : at + (20, 12)[which]]) for name, which, context in contexts for at in range(len(context) - (20, 12)[which] + 1)]
    assert [(contexts[r][0], (20, 12)[contexts[r][1]], at) for r, at in zip(row.tolist(), start.tolist(), strict=True)] == [s[:3] for s in strings]
    seen = collections.Counter(strings)
    group = np.array([contexts[r][0] for r in row])
    assert repeats.found_twice(keys, group).tolist() == [seen[s] > 1 for s in strings]


def test_same_keys_of_other_groups_are_not_found_twice():
    keys, group = np.array([5, 5, 5, 6, 6, 7]), np.array([1, 2, 1, 1, 2, 3])
    assert repeats.found_twice(keys, group).tolist() == [True, False, True, False, False, False]
