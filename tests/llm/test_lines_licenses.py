import math
import random
import re

from pyspark.sql import functions as F

from docloom.llm import licenses, lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(docs, least):
    """Every run of at least `least` words, of any number of lines, that an earlier place holds without overlap goes."""
    held = {k: [x for x in (t or "").split("\n") if WORD.search(x)] for k, t in docs}
    first, gone = {}, {k: set() for k in held}
    for k in sorted(held):
        for i in range(len(held[k])):
            for j in range(i, len(held[k])):
                run = tuple(held[k][i : j + 1])
                if sum(len(WORD.findall(x)) for x in run) >= least:
                    f = first.setdefault(run, (k, i))
                    if f != (k, i) and (f[0] != k or i >= f[1] + len(run)):
                        gone[k] |= set(range(i, j + 1))
    return {k: (len(held[k]), len(gone[k]), [x for i, x in enumerate(held[k]) if i not in gone[k]]) for k in held}


def test_whole_repeated_runs_go(spark):
    rng = random.Random(11)
    pool = ["a b c", "x y z w", "  ", "", "hello there general kenobi you are bold one two three", "q", "m n", "lorem ipsum dolor"]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(80)]
    long = " ".join(f"w{k}" for k in range(50))
    docs += [(100, f"{long}\nRead more here\nfirst end"), (101, f"{long}\nRead more here\nsecond end"), (102, None)]
    got = {r["doc_id"]: r for r in lines.line_dedup(spark.createDataFrame(docs, "doc_id long, text string"), 8).collect()}
    assert {k: (r["n_lines"], r["n_deleted"], [x for x in (r["text"] or "").split("\n") if WORD.search(x)]) for k, r in got.items()} == brute_runs(docs, 8)
    assert got[101]["text"] == "second end"


def test_line_runs_equal_brute_force(spark):
    rng = random.Random(5)
    pool = ["a b c", "x y z w", "  ", "", "hello there general kenobi you are bold one two three", "q", "m n", "lorem ipsum dolor"]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(60)] + [(70, None), (71, "")]
    df = spark.createDataFrame([(*d, "n", 5) for d in docs], "doc_id long, text string, n_lines string, other int")
    got = lines.line_dedup(df, 8)
    assert got.columns.count("n_lines") == 1 and "other" in got.columns
    rows = {r["doc_id"]: r for r in got.collect()}
    assert {k: (r["n_lines"], r["n_deleted"], [x for x in (r["text"] or "").split("\n") if WORD.search(x)]) for k, r in rows.items()} == brute_runs(docs, 8)
    assert rows[70]["text"] is None and rows[71]["text"] == ""
    assert lines.line_dedup(df.limit(0)).count() == 0


def test_clashing_columns(spark):
    text = "one two three four five six seven eight nine"
    names = ["cut", "key", "row", "all", "gone", "places", "docloom_lines", "n_runs"]
    df = spark.createDataFrame([(k, text, *[7] * len(names)) for k in (1, 2)], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    got = lines.line_dedup(df)
    assert got.columns == ["doc_id", "text", *names[:-1], "n_lines", "n_deleted", "n_runs", "n_longest"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, text, *[7] * 7, 1, 0, 0, 0), (2, "", *[7] * 7, 1, 1, 1, 1)]


def test_long_runs_and_repeated_rows(spark):
    shared = "\n".join(f"line {k}" for k in range(21))
    docs = [(1, f"only one\n{shared}"), (2, f"{shared}\nonly two"), (3, shared), (3, shared), (4, "line 3\nline 4\nother")]
    got = [(r["doc_id"], r["text"], r["n_deleted"], r["n_runs"], r["n_longest"]) for r in lines.line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    assert sorted(got) == [(1, docs[0][1], 0, 0, 0), (2, "only two", 21, 1, 16), (3, "", 21, 1, 16), (3, "", 21, 1, 16), (4, docs[4][1], 0, 0, 0)]


def test_ranks_follow_the_order_of_suffixes(spark):
    rng = random.Random(3)
    docs = [(i, "\n".join(rng.choice("pqrs") for _ in range(rng.randint(1, 12)))) for i in range(30)]
    table = lines.materialize(lines.line_table(spark.createDataFrame(docs, "doc_id long, text string"), 8), "lines")
    ids = {(r["key"], r["line"]): (r["a"], r["b"]) for r in table.collect()}
    places, _ = lines.ranked(table, ["a", "b"], 1)
    rank = {(r["key"], r["line"]): r["rank"] for r in places.collect()}
    for x in rank:
        for y in rank:
            assert (rank[x] < rank[y]) == (ids[x] < ids[y])


def test_null_and_repeated_ids(spark):
    text = "one two three four five six seven eight nine"
    df = spark.createDataFrame([(None, text), (5, text), (5, text)], "doc_id long, text string")
    assert sorted((str(r["doc_id"]), r["n_deleted"]) for r in lines.line_dedup(df).collect()) == [("5", 1), ("5", 1), ("None", 0)]


def test_native_plans(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for made in (lines.line_dedup(df), licenses.license_scan(df)):
        assert not re.search("Python|Arrow|Pandas", made._jdf.queryExecution().executedPlan().toString())


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_licenses_equal_brute_force(spark):
    rng = random.Random(7)
    parts = ["MIT", "License", "general", "public", "LICENSE", "apache", " ", "\n", "-", "é", "the", "gnu", "\x00", "KelvinK", "all rights reserved", "Released under the MIT License.", "licensed under cc by-nc 4.0"]
    docs = dict([(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for i in range(150)] + [(300, None), (301, "")])
    df = spark.createDataFrame([(k, t, "x") for k, t in docs.items()], "doc_id long, text string, score string")
    for r in licenses.license_scan(df).collect():
        low = (docs[r["doc_id"]] or "").translate(LOWER)
        words = LICENSE_WORD.findall(low)
        hits = [(i, label) for label, p in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p)] == p]
        labels, score = {x for _, x in hits}, 1.0 if hits else 0.0
        for block in low.split("\n"):
            held = set(LICENSE_WORD.findall(block))
            for label, text in licenses.TEMPLATES:
                t = set(text.split())
                if len(t & held) >= max(1, math.ceil(licenses.THRESHOLD * len(t) - 1e-9)):
                    labels.add(label)
                    score = max(score, len(t & held) / len(t))
        want = (len(words), len(hits), min(hits)[0] if hits else None, max(hits)[0] if hits else None, ",".join(sorted({x for _, x in hits})), ",".join(sorted(labels)))
        assert tuple(r)[1:7] == want and abs(r["score"] - score) < 1e-12
    assert licenses.license_scan(df.limit(0)).count() == 0
    assert licenses.license_scan(spark.createDataFrame([(None, "MIT license")], "doc_id long, text string")).select(F.max("n_base")).first()[0] == 1


def test_wrapped_templates_are_found(spark):
    rng = random.Random(3)
    docs, want = [], {}
    for k, (label, text) in enumerate(licenses.TEMPLATES):
        words = text.split()
        for at in {1, len(words) // 2, len(words) - 1}:
            docs.append((len(docs), "zz " * rng.randint(0, 40) + " ".join(words[:at]) + ",\n * " + " ".join(words[at:]) + " zz" * rng.randint(0, 40)))
            want[docs[-1][0]] = label
    docs.append((900, "all\n" + "zz " * 30 + "rights\nreserved"))
    docs.append((902, "Copyright the authors. All rights reserved."))
    docs.append((901, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided"))
    want[901] = "bsd"
    got = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(label in got[k]["labels"].split(",") and got[k]["score"] == 1 for k, label in want.items())
    assert all((got[k]["labels"], got[k]["score"]) == ("", 0) for k in (900, 902))


def test_windows_equal_brute_force(spark):
    rng = random.Random(9)
    parts = sorted({w for _, t in licenses.TEMPLATES for w in t.split()})
    docs = []
    for k in range(120):
        words = [rng.choice(parts) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            t = [w for w in rng.choice(licenses.TEMPLATES)[1].split() if rng.random() < 0.93]
            at = rng.randint(0, len(words))
            words[at:at] = t
        docs.append((k, "".join(w + rng.choice(" \n ") for w in words)))
    got = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for k, text in docs:
        words, shares = LICENSE_WORD.findall(text), {}
        for label, template in licenses.TEMPLATES:
            t = set(template.split())
            width = math.ceil(len(template.split()) / licenses.THRESHOLD - 1e-9)
            blocks = [set(LICENSE_WORD.findall(x)) for x in text.split("\n")] + [set(words[i : i + width]) for i in range(len(words))]
            share = max(len(t & b) for b in blocks) / len(t)
            if share >= math.ceil(licenses.THRESHOLD * len(t) - 1e-9) / len(t):
                shares[label] = max(share, shares.get(label, 0))
        base = {x for x in got[k]["base_labels"].split(",") if x}
        assert {x for x in got[k]["labels"].split(",") if x} == base | set(shares)
        assert abs(got[k]["score"] - (1 if base else max(shares.values(), default=0))) < 1e-12
