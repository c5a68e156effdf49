"""Very long texts, and columns of docs that are named like those an operator makes."""

from docloom.llm import licenses, lines, ngram_join, toxicity

SCHEMA = "doc_id long, text string"


def test_long_texts_are_read_whole(spark):
    words = [f"w{k % 5000}x{k // 5000}" for k in range(120_000)]
    text = " ".join(words)
    near = " ".join([*words[:-1], "other", "MIT", "License"])
    docs = spark.createDataFrame([(1, text), (2, near), (3, "MIT License")], SCHEMA)
    links = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_join.jaccard_links(docs).collect()}
    assert links == {1: (119_996, 1, 1), 2: (119_998, 1, 1), 3: (1, 3, 0)}
    found = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"]) for r in licenses.license_scan(docs).collect()}
    assert found == {1: (120_000, 0, None), 2: (120_002, 1, 120_000), 3: (2, 1, 0)}


def test_many_lines_and_a_long_line(spark):
    lined = "\n".join(f"line {k} of a text" for k in range(5000))
    wide = "word " * 100_000
    docs = spark.createDataFrame([(1, lined), (2, f"own beginning\n{lined}\nown end"), (3, wide), (4, f"{wide}\nmore")], SCHEMA)
    got = {r["doc_id"]: (r["n_lines"], r["n_deleted"], r["text"][:20]) for r in lines.line_dedup(docs).collect()}
    assert got == {1: (5000, 0, lined[:20]), 2: (5002, 5000, "own beginning\nown en"), 3: (1, 0, wide[:20]), 4: (2, 1, "more")}


def test_rejecting_keeps_all_columns(spark):
    bad, good = "you foul rotten zorg", "what a fine calm day"
    rows = [(k, f"{bad if k % 2 else good} number {k} " + "and so on " * (20_000 if k in (0, 1) else 1), 0.5, k, "x", 1) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p double, f0 long, toxic string, held_out int")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.columns == docs.columns
    found = {r["doc_id"]: tuple(r) for r in kept.collect()}
    assert all(found[k] == rows[k] for k in found) and sum(k % 2 == 0 for k in found) >= 55 and sum(k % 2 for k in found) <= 5
