"""Runs of periodic words against comparing every distance."""

import hashlib

import numpy as np
import pytest
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm.periodic import collapsed, digest, next_smaller, periodic_runs, runs_of, suffix_ranks
from docloom.llm.queries import op11_periodic_runs, planted

SCHEMA = "doc_id long, text string"


def brute_runs(words, min_length=6, min_exponent=4):
    """Maximal stretches of equal words p apart, for each p up; a stretch whose smallest period is less is not p's."""
    out = []
    for p in range(1, len(words) // min_exponent + 1):
        same = [words[i] == words[i + p] for i in range(len(words) - p)] + [False]
        at = 0
        for i, s in enumerate(same):
            if not s:
                n = i - at + p
                piece = words[at : at + n]
                if n >= max(min_length, min_exponent * p) and not any(piece[q:] == piece[:-q] for q in range(1, p)):
                    out.append((at, n, p))
                at = i + 1
    return sorted(out)


def brute_row(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    runs = brute_runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    s, n, p = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (doc_id, len(runs), s, n, p, 1000 * n // p if runs else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def told(documents, **kw):
    return [[tuple(r) for r in found.tolist()] for found in runs_of([[bytes([c]) for c in d] for d in documents], **kw)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4), st.integers(0, 10), st.integers(4, 6))
def test_random_texts_of_few_words(documents, min_length, min_exponent):
    documents = [bytes(d) for d in documents]
    expected = [brute_runs([bytes([c]) for c in d], min_length, min_exponent) for d in documents]
    assert told(documents, min_length=min_length, min_exponent=min_exponent) == expected


def test_runs_in_runs_at_both_ends_and_side_by_side():
    for d in (b"aaaaaaaa", b"abababababab", b"aabaabaabaabaab", b"a" * 8 + b"b" + b"a" * 8, b"ababababcdcdcdcd", b"xabcabcabcabcax", (b"a" * 6 + b"b") * 5, b"aaaaa", b"", b"a"):
        assert told([d]) == [brute_runs([bytes([c]) for c in d])]
    assert told([b"ab" * 6, b"ab" * 6, b"ba"]) == [[(0, 12, 2)], [(0, 12, 2)], []]


def test_long_periodic_text():
    rng = np.random.default_rng(3)
    root = rng.integers(0, 50, 700).tolist()
    words = [str(w).encode() for w in [999, *root * 9, *root[:123], 998]]
    assert [tuple(r) for r in runs_of([words])[0].tolist()] == [(1, 700 * 9 + 123, 700)]
    assert len(collapsed(words, runs_of([words])[0])) == 702


@given(st.lists(st.integers(0, 3), min_size=1, max_size=50))
def test_suffix_ranks_and_next_smaller(values):
    symbols = np.array([v + 1 for v in values] + [0])
    suffixes = [symbols[i:].tolist() for i in range(len(symbols))]
    assert suffix_ranks(symbols).tolist() == [sorted(suffixes).index(s) for s in suffixes]
    expected = [next((j for j in range(i + 1, len(values)) if values[j] < values[i]), len(values)) for i in range(len(values))]
    assert next_smaller(np.array(values)).tolist() == expected


def test_whole_table_against_brute_force(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    found = sorted(map(tuple, op11_periodic_runs(spark, str(DATA)).collect()))
    assert found == sorted(brute_row(r["doc_id"], r["text"]) for r in rows)
    assert sum(r[1] > 0 for r in found) > 5


def test_null_empty_repeated_and_clashing(spark):
    text = "x " + "a b c\td " * 5
    rows = [(1, None, 7, 1), (2, "", 7, 2), (3, text, 7, 3), (3, text, 7, 3), (None, text, None, None), (5, " \n\t", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int, start int")
    found = sorted(map(tuple, digest(periodic_runs(docs)).collect()), key=str)
    none, kept = hashlib.sha256(b"").hexdigest(), hashlib.sha256("x a b c d".encode()).hexdigest()
    run = (1, 1, 15, 3, 5000, hashlib.sha256(b"1,15,3\n").hexdigest(), kept)
    blank = (0, None, None, None, None, none, none)
    assert found == sorted([(1, *blank), (2, *blank), (3, *run), (3, *run), (None, *run), (5, *blank)], key=str)
    assert digest(periodic_runs(spark.createDataFrame([], SCHEMA))).count() == 0


def test_parameters(spark):
    docs = spark.createDataFrame([(1, "a b a b a b a b z z z z z")], SCHEMA)
    assert [list(map(tuple, r["runs"])) for r in periodic_runs(docs, min_length=0).collect()] == [[(0, 8, 2), (8, 5, 1)]]
    assert [list(map(tuple, r["runs"])) for r in periodic_runs(docs).collect()] == [[(0, 8, 2)]]
    with pytest.raises(ValueError):
        runs_of([[b"a"]], min_exponent=3)
