"""Rows that share a doc_id but not a text are documents of their own: nothing that stands once is lost."""

import random

from test_ngram_join import brute as brute_groups
from test_ngram_join import brute_links
from test_repeats import brute as brute_repeats

from docloom.llm import ngram_join, repeats
from docloom.llm.common import row_keys
from docloom.llm.lines import line_dedup

SCHEMA = "doc_id long, text string"


def test_keys(spark):
    rows = [(1, "a"), (1, "a"), (2, "a"), (2, "b"), (None, "x"), (None, None), (3, None)]
    keyed, split = row_keys(spark.createDataFrame(rows, SCHEMA))
    keys = {(r["doc_id"], r["text"]): r["key"] for r in keyed.collect()}
    assert split and len(set(keys.values())) == len(keys) == 6 and keys[1, "a"] == 1 and keys[3, None] == 3
    keyed, split = row_keys(spark.createDataFrame(rows[:3], SCHEMA))
    assert not split and sorted(r["key"] for r in keyed.collect()) == [1, 1, 2]


def test_line_dedup_keeps_lines_that_stand_once(spark):
    shared = "one two three four five six seven eight nine"
    once = "these twelve words stand here and nowhere else in all the world"
    rows = [(1, f"{shared}\nend"), (2, f"{once}\nmore"), (2, f"{shared}\nother tail"), (None, f"{once} too\nz"), (None, f"y\n{shared}")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((str(r["doc_id"]), r["text"], r["n_deleted"]) for r in line_dedup(docs).collect())
    # the null id comes first, so its copy of the shared line is the one that stays
    assert got == sorted([("1", "end", 1), ("2", f"{once}\nmore", 0), ("2", "other tail", 1), ("None", f"{once} too\nz", 0), ("None", f"y\n{shared}", 0)])


def test_repeats_equal_brute_force(spark):
    rng = random.Random(5)
    rnd = lambda n: "".join(rng.choice("abé \n") for _ in range(n))
    common = [rnd(rng.randint(15, 60)) for _ in range(6)]
    rows = [(rng.choice([1, 2, 3, 4, None]), "".join(rng.choice([rnd(rng.randint(0, 40)), rng.choice(common)]) for _ in range(rng.randint(0, 5)))) for _ in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted((str(a[0]), *a[1:]) for a in brute_repeats(rows, 20))
    for large in (10**6, 60):
        found = repeats.remove_repeats(docs, 20, 7, (12, 5), large).collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in found) == want
    alone = "x" * 300 + "".join(rng.choice("0123456789") for _ in range(329))
    docs = spark.createDataFrame([(7, alone), (7, common[0] * 9), (8, common[0] * 9)], SCHEMA)
    assert {(r["doc_id"], r["n_bytes"]): r["n_removed"] for r in repeats.remove_repeats(docs, 20, 7).collect()}[7, 629] == 300


def test_groups_and_links_equal_brute_force_of_rows(spark):
    rng = random.Random(6)
    base = [[f"w{rng.randint(0, 99)}" for _ in range(40)] for _ in range(6)]
    texts = []
    for k in range(60):
        w = list(rng.choice(base))
        w[rng.randrange(40)] = f"x{k}"
        texts.append(" ".join(w[: rng.choice([3, 30, 40])]))
    texts = list(dict.fromkeys(texts))
    ids = [rng.randint(1, 20) for _ in texts]
    rows = list(enumerate(texts))  # what it would be with ids of their own
    groups, links = brute_groups(rows), brute_links(rows)
    least = {}
    for k, (_, g) in groups.items():
        least[g] = min(least.get(g, 10**9), ids[k])
    want = sorted((ids[k], groups[k][0], least[groups[k][1]], links[k]) for k, _ in rows)
    docs = spark.createDataFrame([(ids[k], t) for k, t in rows] + [(ids[0], texts[0])], SCHEMA)
    got = [tuple(r) for r in ngram_join.jaccard_links(docs).collect()]
    assert len(got) == len(rows) + 1
    got.remove((ids[0], groups[0][0], least[groups[0][1]], links[0]))
    assert sorted(got) == want
    kept = [(r["doc_id"], r["text"]) for r in ngram_join.one_of_each_group(docs).collect()]
    # one row of each group stays (equal rows are one document), with the group's smallest id
    place = {(ids[k], t): groups[k][1] for k, t in rows}
    assert sorted(place[x] for x in set(kept)) == sorted(least) and all(least[place[x]] == x[0] for x in kept)
