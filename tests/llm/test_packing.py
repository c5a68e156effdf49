import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docloom.llm.packing import Plan, WordEncoder, best_fit_pack, plan

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a  b\n\nC'S don't ÀÉ ﬁ ① <|endoftext|> x\tΣΑΣ   z\r\n é ́ q 12 34", "İstanbul K ﬀ.", "", " \n ", "...a.,b.,", "x." * 500, "word, word. word"]


def sequences(p, counts):
    found, ranks = {}, set()
    for size, first, stop, at, each, place in p.rows:
        for r in range(first, stop):
            assert (size, r) not in ranks
            ranks.add((size, r))
            found.setdefault(at + (r - first) // each, []).append((place + (r - first) % each * size, size))
    assert len(ranks) == counts.sum()
    for parts in found.values():
        at = 0
        for place, size in sorted(parts):
            assert place == at
            at += size
        assert at <= len(counts) - 1
    return found


def least(sizes, capacity):
    """The true number of sequences, by trying all places."""
    best = [len(sizes)]

    def put(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(rooms)
            return
        for n, room in enumerate(rooms):
            if room >= sizes[k]:
                put(k + 1, [*rooms[:n], room - sizes[k], *rooms[n + 1 :]])
        put(k + 1, [*rooms, capacity - sizes[k]])

    put(0, [])
    return best[0]


def test_plans_are_whole_and_gapless():
    rng = random.Random(0)
    for _ in range(200):
        capacity = rng.choice([10, 20, 50, 100])
        counts = np.zeros(capacity + 1, int)
        for _ in range(rng.randint(0, 60)):
            counts[rng.randint(1, capacity)] += 1
        p = plan(counts, capacity)
        assert len(sequences(p, counts)) == p.sequences


def test_reduction_keeps_the_optimum():
    rng = random.Random(1)
    for _ in range(60):
        sizes = sorted((rng.randint(1, 12) for _ in range(rng.randint(1, 8))), reverse=True)
        counts = np.bincount(sizes, minlength=13)
        p = Plan(counts, 12)
        p.reduce()
        rest = [s for s in range(12, 0, -1) for _ in range(p.left[s])]
        assert p.fixed + (least(rest, 12) if rest else 0) == least(sizes, 12)


def test_word_by_word_ids_are_the_tokenizers():
    for limit in (1, 10_000):
        encoder = WordEncoder(PATH, limit)
        for _ in range(2):
            assert [list(x) for x in encoder.encode(ODD)] == [e.ids for e in encoder.tokenizer.encode_batch(ODD, add_special_tokens=False)]


def test_pieces_and_places(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["heat", "pump", "grid", "fée"]) for _ in range(rng.choice([0, 1, 5, 30])))) for k in range(60)] + [(99, None), (7, "same"), (7, "same"), (None, "null id")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, piece int, length string")
    got = best_fit_pack(docs, PATH, capacity=8).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(doc, k, s, len(ids[s : s + 8]), zlib.crc32(np.array(ids[s : s + 8], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 8))]
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))
    held = {}
    for r in got:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 8
    assert len(held) <= -(-sum(r["length"] for r in got) // 8) * 1.2


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_small_tables(spark, rows):
    assert best_fit_pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH).count() == len(rows)
