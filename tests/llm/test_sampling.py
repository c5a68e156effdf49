import collections
import math

import public_tokenizers
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from docloom.llm import sentencepiece_sampling as S

PATH = public_tokenizers.path("piece_bpe_32k.model")


def every(sampler, text):
    """All segmentations of a short text with their probabilities, by enumeration."""
    v, out = sampler.vocabulary, [((), 1.0)]
    for unit in S.units(text, v):
        found = []

        def go(i, ids, p, unit=unit, found=found):
            if i == len(unit):
                found.append((ids, p))
                return
            single = False
            for j in range(i + 1, len(unit) + 1):
                piece = v.known.get(unit[i:j], -1)
                if piece >= 0:
                    single |= j == i + 1
                    go(j, (*ids, piece), p * math.exp(v.log_prob[piece]))
            if not single:
                b = unit[i].encode()
                go(i + 1, (*ids, *[v.byte_id[x] for x in b]), p * math.exp(v.rare * len(b)))

        go(0, (), 1.0)
        out = [(a + b, p * q) for a, p in out for b, q in found]
    total = sum(p for _, p in out)
    return {ids: p / total for ids, p in out}


def test_samples_follow_the_law_of_drawing_without_replacement():
    s, n = S.Sampler(PATH), 3000
    for text in ("tin", "ab €\n  x"):
        law = every(s, text)
        one, two, weight = collections.Counter(), collections.Counter(), 0.0
        for k in range(n):
            paths, threshold = s.batch([text], [k], 2)[0]
            ids = [tuple(s.ids(p).tolist()) for p in paths]
            assert len(set(ids)) == 2 and paths[0].value >= paths[1].value >= threshold
            assert all(abs(math.exp(p.log_prob) - law[i]) < 1e-5 for p, i in zip(paths, ids, strict=True))
            one[ids[0]] += 1
            two[ids[1]] += 1
            weight += sum(law[i] / math.exp(S.inclusion(p.log_prob, threshold)) for p, i in zip(paths, ids, strict=True)) / n
        second = collections.Counter()
        for a, p in law.items():
            for b, q in law.items():
                if a != b:
                    second[b] += p * q / (1 - p)
        assert all(abs(one[i] / n - p) < 0.04 for i, p in law.items())
        assert all(abs(two[i] / n - p) < 0.04 for i, p in second.items())
        assert abs(weight - 1) < 0.1  # importance weights sum to the whole mass


def test_texts_with_few_segmentations_give_few_samples():
    s = S.Sampler(PATH)
    law = every(s, "tin")
    paths, threshold = s.batch(["tin"], [5], 50)[0]
    assert len(paths) == len(law) and threshold == -math.inf and {tuple(s.ids(p).tolist()) for p in paths} == set(law)


def test_round_trip_and_independence_of_batches(spark):
    texts = ["", None, " two  spaces ", "línea\nß €\U0001f600\x00", "a" * 3000, "x y " * 50, "▁mark"]
    docs = spark.createDataFrame([(k, t, 9) for k, t in enumerate(texts)] + [(None, "no key", 9)], "doc_id long, text string, ids int")
    rows = S.encode_samples(docs, PATH, 3)
    back = S.decode(rows, PATH).collect()
    sp = SentencePieceProcessor(model_file=PATH)
    for r in back:
        want = "no key" if r["doc_id"] is None else (texts[r["doc_id"]] or "").replace("▁", " ")
        assert r["text"] == want and r["text_kept"] and sp.decode(r["ids"]) == want
    again = S.encode_samples(docs.repartition(5), PATH, 3).collect()
    key = lambda r: (str(r["doc_id"]), r["sample"], r["ids"])
    assert sorted(map(key, back)) == sorted(map(key, again))
    per = collections.Counter(r["doc_id"] for r in back)
    assert per[0] == per[1] == 1 and per[5] == 3
    assert S.encode_samples(docs.limit(0), PATH).count() == 0
    assert S.encoded_digest(docs, PATH).where(F.col("ids_crc32").isNull()).count() == 0


def test_small_caches_change_nothing(monkeypatch):
    texts = [f"word{k} grid heat pump {k}" for k in range(40)]
    whole = [[tuple(w.ids(p).tolist()) for p in paths] for w in [S.Sampler(PATH)] for paths, _ in w.batch(texts, list(range(40)), 2)]
    monkeypatch.setattr(S, "CACHE_EDGES", 10)
    s, parts = S.Sampler(PATH), []
    for k in range(0, 40, 3):
        found = s.batch(texts[k : k + 3], list(range(k, min(k + 3, 40))), 2)
        parts += [[tuple(s.ids(p).tolist()) for p in paths] for paths, _ in found]
    assert parts == whole


def test_each_sample_is_decoded_whole_from_its_ids():
    s = S.Sampler(PATH)
    texts = ["a word of words \U0001f600 ▁ ñ\n" * 3, "x" * 500, "�"]
    for text, (paths, _) in zip(texts, s.batch(texts, [3, 4, 5], 3), strict=True):
        samples = [s.ids(p) for p in paths]
        assert s.kept(samples, text) == [True] * len(paths) and len(paths) > 1 or text == texts[2]
        assert all(s.vocabulary.spelled(ids) == b"".join(s.vocabulary.bytes[i] for i in ids.tolist()) for ids in samples)
        assert s.kept([ids[1:] for ids in samples], text) == [False] * len(paths)
    # bytes that are no text are not taken for the sign that stands for such bytes
    space = s.vocabulary.known[S.SPACE]
    assert s.kept([S.np.array([space, s.vocabulary.byte_id[255]])], "�") == [False]


def test_sets_that_cannot_be_among_the_best_get_no_random_numbers(monkeypatch):
    s = S.Sampler(PATH)
    text = " ".join(f"heat{k} pump of the grid" for k in range(4000))
    drawn, uniform = [], S.uniform
    monkeypatch.setattr(S, "uniform", lambda keys, step: drawn.append(S.np.broadcast(keys, step).size) or uniform(keys, step))
    paths, _ = s.batch([text], [7], 2)[0]
    assert len(paths) == 2
    # each sample is walked once; only a few of the sets that branch off from it are looked at
    assert sum(drawn) < sum(len(p.edges) for p in paths) + 2000


def test_sets_left_out_are_not_among_the_best(monkeypatch):
    texts = ["the heat pump of a grid " * 60, "x" * 700, "ab €\n  x" * 90, "tin"]
    found = []
    for near in (10**9, S.NEAR, 1):
        monkeypatch.setattr(S, "NEAR", near)
        s = S.Sampler(PATH)
        drawn = [s.batch(texts, range(at, at + len(texts)), 4) for at in range(0, 80, len(texts))]
        found.append([([(p.value, p.log_prob, tuple(s.ids(p).tolist())) for p in paths], threshold) for batch in drawn for paths, threshold in batch])
    assert found[0] == found[1] == found[2]


def test_words_told_apart_by_arrow_are_those_of_each_text():
    v = S.Sampler(PATH).vocabulary
    texts = ["", "one two. one", "\n\nline,\n", " two  spaces ", "▁mark▁", "\x00é 中文 \U0001f600.", " ", "one"]
    for some in (texts, [*texts, "a\x1fb c"], [""], []):
        sizes, which, distinct = S.told_apart(some, v)
        want = [S.words(t, v) for t in some]
        assert sizes.tolist() == [len(w) for w in want] and len(set(distinct)) == len(distinct)
        assert distinct[which].tolist() == [w for ws in want for w in ws]
        assert all("".join(w) == (" " + t.replace(S.SPACE, " ") if t else "") for t, w in zip(some, want, strict=True))


def test_beginnings_of_pieces_are_found_in_their_slots():
    v = S.Sampler(PATH).vocabulary
    for length, (keys, pieces, first, most) in enumerate(v.beginnings):
        slots = (keys & S.U(S.SLOTS - 1)).astype(int)
        places = first[slots]
        assert all(0 <= k - p < most for k, p in enumerate(places.tolist()))
        assert sorted(pieces.tolist()) == sorted(i for b, i in v.known.items() if len(b) == length)
