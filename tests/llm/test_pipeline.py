import collections

import corpus_pipeline
import duckdb
import pandas
import pytest
from docloom.llm import lines, pii, toxicity
from docloom.llm.queries import oracle_sql, queries
from test_ngram_join import brute

DATA = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").cache()
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "pii", "packing"]
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns
        got = {r["doc_id"]: r for r in out.collect()}
        if name == "toxicity":
            told = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, spark.read.parquet(f"{DATA}/labels.parquet")).collect()}
            assert set(got) == {k for k, p in told.items() if not p} and len(got) < len(rows)
        if name == "near_duplicates":
            groups = brute([(k, r["text"]) for k, r in rows.items()])
            assert set(got) == {g for _, g in groups.values()} and len(got) < len(rows)
        if name in ("toxicity", "near_duplicates"):
            assert all(r == rows[k] for k, r in got.items())
        if name == "line_dedup":
            cut = {r["doc_id"]: r for r in lines.line_dedup(docs).collect()}
            assert {k: r["text"] for k, r in got.items()} == {k: r["text"] for k, r in cut.items() if not r["n_deleted"] or r["n_deleted"] < r["n_lines"]}
        if name == "pii":
            assert {k: r["text"] for k, r in got.items()} == {k: pii.masked(r["text"]) for k, r in rows.items()}
        assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_run_packs_what_is_left(spark):
    out = corpus_pipeline.run(spark, DATA).collect()
    held = collections.defaultdict(list)
    for r in out:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert 0 < len({r["doc_id"] for r in out}) < spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_all_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", oracle_sql())
def test_query_agrees_with_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        db.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got, want = queries()[name](spark, DATA).toPandas(), db.execute(oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda f: sorted(str([None if pandas.isna(x) else float(x) if isinstance(x, int | float) else x for x in row]) for row in f[columns].astype(object).itertuples(index=False, name=None))
    assert rows(got) == rows(want)
