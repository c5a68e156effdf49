import hashlib
import random
import re
import zlib

import pytest

from docloom.llm import media, pii


def test_lacings_round_trip():
    rng = random.Random(1)
    for _ in range(300):
        kind = rng.choice([media.NO_LACING, media.XIPH, media.FIXED, media.EBML_LACING])
        sizes = [7] * rng.randint(1, 9) if kind == media.FIXED else [rng.choice([0, 1, 5, 255, 300, 600]) for _ in range(rng.randint(1, 9) if kind else 1)]
        frames = [rng.randbytes(n) for n in sizes]
        body, found = media.laced_block(frames, 5, kind), media.Media()
        media.read_block(body, 0, len(body), 0, found, 0)
        assert [body[p.offset : p.offset + p.size] for p in found.packets] == frames


def test_payload_round_trip_tracks_times_and_cues():
    for n in (0, 1, 63, 64, 65, 511, 512, 5000, 200_000):
        payload, size = media.payload_of("x" * n)
        assert size == n and len(payload) % 64 == 0 and len(payload) >= max(64, n)
        data = media.encode(payload)
        found = media.parse(data)
        assert media.samples(data, found) == payload and found.doc_type == "matroska"
        assert found.tracks[1]["codec"] == "A_PCM/INT/LIT" and found.duration == len(payload) / 8
        assert [p.timestamp_ns for p in found.packets] == [k * 64_000_000 for k in range(len(found.packets))]
        segment = data.index(media.SEGMENT.to_bytes(4, "big"))
        _, body, _ = media.read_vint(data, segment + 4, False)
        assert [data[body + at : body + at + 4] for _, _, at in found.cues] == [media.CLUSTER.to_bytes(4, "big")] * len(found.clusters)


def test_unknown_sizes_and_block_groups():
    block = media.vint(1) + b"\x00\x02\x00" + b"abc"
    group = media.element(media.BLOCK_GROUP, media.element(media.BLOCK, block) + media.uint(media.BLOCK_DURATION, 3))
    cluster = media.CLUSTER.to_bytes(4, "big") + b"\xff" + media.uint(media.CLUSTER_TIMESTAMP, 10) + group
    data = media.SEGMENT.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + cluster + cluster
    found = media.parse(data)
    assert [(data[p.offset : p.offset + p.size], p.timestamp_ns, p.cluster) for p in found.packets] == [(b"abc", 12_000_000, 0), (b"abc", 12_000_000, 1)]


def test_keyframes_durations_and_cues():
    """Two tracks: 16-bit stereo samples, whose laces follow by their bytes, and frames of a default duration."""
    audio = media.element(media.AUDIO, media.element(media.SAMPLING_FREQUENCY, b"\x45\xfa\x00\x00") + media.uint(media.CHANNELS, 2) + media.uint(media.BIT_DEPTH, 16))  # 8000.0
    entry = lambda n, codec, *more: media.element(media.TRACK_ENTRY, media.uint(media.TRACK_NUMBER, n) + media.element(media.CODEC_ID, codec) + b"".join(more))
    tracks = media.element(media.TRACKS, entry(1, b"A_PCM/INT/LIT", audio) + entry(2, b"V_X", media.uint(media.DEFAULT_DURATION, 40_000_000)))
    group = lambda body, *more: media.element(media.BLOCK_GROUP, media.element(media.BLOCK, body) + b"".join(more))
    refers = media.element(media.REFERENCE_BLOCK, b"\xff")
    two = lambda track, relative: media.laced_block([b"a" * 320, b"b" * 320], relative, media.FIXED, track)
    body = media.uint(media.CLUSTER_TIMESTAMP, 100) + media.element(media.SIMPLE_BLOCK, two(1, 0)) + group(two(2, 5), refers) + group(two(2, 90)) + group(two(2, 200), media.uint(media.BLOCK_DURATION, 30))
    cluster = media.element(media.CLUSTER, body)
    cue = lambda time, at: media.element(media.CUE_POINT, media.uint(media.CUE_TIME, time) + media.element(media.CUE_TRACK_POSITIONS, media.uint(media.CUE_TRACK, 2) + media.uint(media.CUE_CLUSTER_POSITION, at)))
    data = media.element(media.SEGMENT, tracks + cluster + media.element(media.CUES, cue(190, len(tracks)) + cue(1, 3)))
    found = media.parse(data)
    got = [(p.track, p.timestamp_ns // 1_000_000, p.duration_ns // 1_000_000, p.keyframe) for p in found.packets]
    assert got == [(1, 100, 10, True), (1, 110, 10, True), (2, 105, 40, False), (2, 145, 40, False), (2, 190, 40, True), (2, 230, 40, True), (2, 300, 15, True), (2, 315, 15, True)]
    place = found.cue_places()[0]
    assert data[place[2] : place[2] + 4] == media.CLUSTER.to_bytes(4, "big") and place[3] == 0 and found.cue_places()[1][3] is None
    assert media.cued_packets(found) == {4}


def test_packet_tables(spark):
    good = media.encode(b"a" * 1024)
    df = spark.createDataFrame([(1, bytearray(good)), (2, None), (3, bytearray(b"\x00junk")), (4, bytearray(good[:-5])), (5, bytearray(b""))], "id long, media binary")
    rows = media.packets(df, "id", "media").collect()
    assert [(r["byte_size"], r["track"]) for r in rows if r["id"] == 1] == [(512, 1)] * 2
    assert [(r["duration_ns"], r["cue"]) for r in rows if r["id"] == 1] == [(64_000_000, True), (64_000_000, False)]
    assert {r["id"] for r in rows if r["error"]} == {3, 4} and not [r for r in rows if r["id"] in (2, 5)]


def test_media_digest(spark):
    texts = {1: "abc é", 2: None, 3: "", 4: "y" * 64, 5: "abc é"}
    got = {r["doc_id"]: r for r in media.media_digest(spark.createDataFrame([(k, t, 0) for k, t in texts.items()], "doc_id long, text string, media int")).collect()}
    for k, t in texts.items():
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (got[k]["n_bytes"], got[k]["payload_bytes"], got[k]["payload_sha256"], got[k]["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert tuple(got[1])[1:] == tuple(got[5])[1:] and got[1]["feature"] != got[4]["feature"]


EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found, key=pii.order)


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for alphabet in ("aB9.@-+ 1 2 0()%_:,x@..", "4 1-1111", "+1(5).-2 ", "255.0.10.99.1"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
            assert pii.detect(text) == plain(text)


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("mail john (at) mail [dot] example.com now", ["email:5:37"]),
        ("john at mail dot example dot com", ["email:0:32"]),
        ("jоhn@mаil.com!", ["email:0:13"]),
        ("call plus one five five five one two three four five six seven now", ["phone:5:62"]),
        ("４１１１ 1111 1111 1111", ["card:0:19"]),
        ("x a@b.co y c [at] d.com", ["email:2:8", "email:11:23"]),
        ("meet me at the dot. Two or three at noon, one on the list", []),
        ("", []),
    ],
)
def test_disguises_map_back_to_the_source(text, spans):
    assert pii.joined(pii.find(text)[1]) == ",".join(spans)


def test_tape_maps_every_character():
    tape = pii.Tape("abcdef").rewrite([(1, 3, "X"), (4, 5, "YZ")]).rewrite([(0, 2, "q")])
    assert tape.text == "qdYZf" and [tape.source(k) for k in range(5)] == [(0, 3), (3, 4), (4, 5), (4, 5), (5, 6)]


def test_digest_and_mask(spark):
    rows = [(1, "a@b.co and 10.0.0.1", "k"), (2, None, None), (3, "", "k"), (None, "é" * 10 + " +1 (555) 123-4567", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {r["doc_id"]: r for r in pii.digest(df).collect()}
    assert got[1]["spans"] == "email:0:6,ip:11:19" and (got[1]["n_email"], got[1]["n_ip"]) == (1, 1)
    assert got[1]["base_sha256"] == hashlib.sha256(b"email:0:6,ip:11:19").hexdigest() and got[2]["spans"] == got[3]["spans"] == ""
    masked = {r["doc_id"]: r for r in pii.mask(df).collect()}
    assert masked[1]["text"] == "[EMAIL] and [IP]" and masked[2]["text"] is None and masked[None]["text"].endswith(" [PHONE]") and masked[3]["spans"] == "k"
    assert pii.digest(df.limit(0)).count() == 0


def test_long_runs_take_linear_time():
    assert pii.find("9" * 200_000) == ([], []) and pii.find("a." * 100_000 + "@") == ([], [])


@pytest.mark.parametrize(
    "words",
    [
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "zéro une deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    ],
)
def test_every_digit_is_spelled_in_every_language(words):
    text = f"tel plus {words} x"
    assert [pii.SPELLED[w] for w in words.split()] == list("0123456789")
    assert pii.joined(pii.find(text)[1]) == f"phone:4:{len(text) - 2}" and pii.masked(text) == "tel [PHONE] x"


def test_french_articles_are_no_digits():
    assert pii.find("un chat, une souris et un, deux ou trois chiens") == ([], [])


@pytest.mark.parametrize(
    ("text", "spans", "masked"),
    [
        ("to jоhn@example.com!", "email:3:19,email:5:19", "to [EMAIL]!"),
        ("john@example.cоm", "email:0:14,email:0:16", "[EMAIL]"),
        ("john@mail.exаmple.com", "email:0:12,email:0:21", "[EMAIL]"),
        ("john@mail.example [dot] com x", "email:0:17,email:0:27", "[EMAIL] x"),
        ("a@b.co jоe@b.co a@b.co", "email:0:6,email:7:15,email:9:15,email:16:22", "[EMAIL] [EMAIL] [EMAIL]"),
    ],
)
def test_disguises_that_overlap_a_base_span_are_kept(text, spans, masked):
    base, every = pii.find(text)
    assert pii.joined(every) == spans and pii.masked(text) == masked and base == plain(text) and set(base) <= set(every)
