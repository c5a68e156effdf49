"""Matroska columns: write 8-bit samples as Matroska, and parse Matroska into packet tables.

The parser follows the element tree: variable-length ids and sizes, unknown sizes, clusters, simple
blocks and block groups, the three lacings, and cues. It works on the bytes of one value, so it runs
inside mapInArrow and holds one value at a time.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the format: element ids.
EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
DOC_TYPE, TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x4282, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, AUDIO = 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0xE1
SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xB5, 0x9F, 0x6264
CLUSTER_TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION = 0xE7, 0xA3, 0xA0, 0xA1, 0x9B
REFERENCE_BLOCK, DEFAULT_DURATION = 0xFB, 0x23E383
CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
NO_LACING, XIPH, FIXED, EBML_LACING = 0, 1, 2, 3

#: 8-bit samples a second, bytes in a frame, frames in a block, frames in a cluster.
RATE, FRAME, LACED, CLUSTER_FRAMES = 8000, 512, 4, 128


class MediaError(ValueError):
    """The bytes are not readable Matroska."""


@dataclass
class Packet:
    track: int
    timestamp_ns: int
    offset: int
    size: int
    keyframe: bool
    lacing: int
    lace: int
    cluster: int
    duration_ns: int | None


@dataclass
class Media:
    doc_type: str = ""
    scale: int = 1_000_000
    duration: float | None = None
    tracks: dict[int, dict] = field(default_factory=dict)
    packets: list[Packet] = field(default_factory=list)
    #: time, track and the cluster's place within the segment's data, as stored
    cues: list[tuple[int, int, int]] = field(default_factory=list)
    #: first byte of each cluster's data, and of each cluster as an element
    clusters: list[int] = field(default_factory=list)
    cluster_starts: list[int] = field(default_factory=list)
    segment: int = 0

    def cue_places(self) -> list[tuple[int, int, int, int | None]]:
        """(time in nanoseconds, track, first byte of the cluster's element, number of the cluster or None) of each cue."""
        numbers = {start: n for n, start in enumerate(self.cluster_starts)}
        return [(time * self.scale, track, self.segment + at, numbers.get(self.segment + at)) for time, track, at in self.cues]


# ---------------------------------------------------------------- reading


def read_vint(data: bytes, at: int, keep_marker: bool) -> tuple[int, int, bool]:
    """(value, next place, whether all value bits are set)."""
    if at >= len(data) or data[at] == 0:
        raise MediaError(f"no variable-length number at {at}")
    width = 9 - data[at].bit_length()
    if at + width > len(data):
        raise MediaError(f"number cut at {at}")
    raw = int.from_bytes(data[at : at + width], "big")
    value = raw & ((1 << 7 * width) - 1)
    return (raw if keep_marker else value), at + width, value == (1 << 7 * width) - 1


def elements(data: bytes, at: int, end: int, open_stops: frozenset[int] = frozenset()) -> Iterator[tuple[int, int, int]]:
    """(id, first byte, end) of the elements in data[at:end]; one of unknown size ends before an id in open_stops."""
    while at < end:
        kind, at, _ = read_vint(data, at, True)
        size, at, unknown = read_vint(data, at, False)
        if unknown:
            stop = at
            while stop < end:
                inner, body, _ = read_vint(data, stop, True)
                if inner in open_stops:
                    break
                length, body, open_too = read_vint(data, body, False)
                stop = end if open_too else body + length
            size = min(stop, end) - at
        if at + size > end:
            raise MediaError(f"element {kind:x} runs past its parent")
        yield kind, at, at + size
        at += size


def number(data: bytes, at: int, end: int) -> int:
    return int.from_bytes(data[at:end], "big")


def real(data: bytes, at: int, end: int) -> float:
    return {0: lambda: 0.0, 4: lambda: struct.unpack(">f", data[at:end])[0], 8: lambda: struct.unpack(">d", data[at:end])[0]}[end - at]()


def lace_sizes(data: bytes, at: int, end: int, lacing: int) -> tuple[list[int], int]:
    """Sizes of a block's frames and where the first begins."""
    if lacing == NO_LACING:
        return [end - at], at
    n, at = data[at] + 1, at + 1
    if lacing == FIXED:
        if (end - at) % n:
            raise MediaError("fixed lacing does not divide the block")
        return [(end - at) // n] * n, at
    sizes: list[int] = []
    for k in range(n - 1):
        if lacing == XIPH:
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            size, at = size + data[at], at + 1
        else:
            start = at
            value, at, _ = read_vint(data, at, False)
            width = at - start
            size = value if k == 0 else sizes[-1] + value - ((1 << (7 * width - 1)) - 1)
        sizes.append(size)
    last = end - at - sum(sizes)
    if last < 0 or min(sizes, default=0) < 0:
        raise MediaError("laced frames run past the block")
    return [*sizes, last], at


def frame_time(track: dict, size: int) -> int | None:
    """Nanoseconds of a frame: the track's default duration, or for uncompressed audio what its samples take; None if unknown."""
    if track.get("default_duration"):
        return track["default_duration"]
    rate, width = track.get("rate"), track.get("channels", 1) * track.get("bits", 0)
    if rate and width and track.get("codec", "").startswith("A_PCM"):
        return size * 8 * 1_000_000_000 // int(rate * width)
    return None


def read_block(data: bytes, at: int, end: int, base: int, media: Media, cluster: int, keyframe: bool | None = None, duration: int | None = None) -> None:
    """Packets of a block. A simple block tells by a flag whether it is a keyframe (None); a group's is one if it has no reference.

    A group's duration is shared by its laced frames. The first frame has the block's time; the others follow by the
    duration of those before them, and have the block's time where it is not known.
    """
    track, at, _ = read_vint(data, at, False)
    if at + 3 > end:
        raise MediaError("block cut")
    relative, flags = struct.unpack_from(">hB", data, at)
    lacing = flags >> 1 & 3
    sizes, at = lace_sizes(data, at + 3, end, lacing)
    start = (base + relative) * media.scale
    for k, size in enumerate(sizes):
        took = duration * media.scale // len(sizes) if duration is not None else frame_time(media.tracks.get(track, {}), size)
        media.packets.append(Packet(track, start, at, size, bool(flags & 0x80) if keyframe is None else keyframe, lacing, k, cluster, took))
        at += size
        start += took or 0


def parse(data: bytes) -> Media:
    """The tracks, packets and cues of a Matroska value; raises MediaError."""
    media = Media()
    try:
        for kind, at, end in elements(data, 0, len(data)):
            if kind == EBML:
                for k, a, e in elements(data, at, end):
                    if k == DOC_TYPE:
                        media.doc_type = data[a:e].rstrip(b"\0").decode("ascii")
            elif kind == SEGMENT:
                read_segment(data, at, end, media)
    except (IndexError, struct.error, KeyError, UnicodeDecodeError) as error:
        raise MediaError(str(error)) from error
    return media


def read_segment(data: bytes, at: int, end: int, media: Media) -> None:
    top = frozenset({CLUSTER, CUES, INFO, TRACKS})
    media.segment, start = at, at
    for kind, a, e in elements(data, at, end, top):
        first, start = start, e
        if kind == INFO:
            for k, x, y in elements(data, a, e):
                if k == TIMESTAMP_SCALE:
                    media.scale = number(data, x, y)
                elif k == DURATION:
                    media.duration = real(data, x, y)
        elif kind == TRACKS:
            for k, x, y in elements(data, a, e):
                if k == TRACK_ENTRY:
                    read_track(data, x, y, media)
        elif kind == CLUSTER:
            base, cluster = 0, len(media.clusters)
            media.clusters.append(a)
            media.cluster_starts.append(first)
            for k, x, y in elements(data, a, e):
                if k == CLUSTER_TIMESTAMP:
                    base = number(data, x, y)
                elif k == SIMPLE_BLOCK:
                    read_block(data, x, y, base, media, cluster)
                elif k == BLOCK_GROUP:
                    parts = list(elements(data, x, y))
                    refers = any(g == REFERENCE_BLOCK for g, _, _ in parts)
                    lasts = next((number(data, p, q) for g, p, q in parts if g == BLOCK_DURATION), None)
                    for g, p, q in parts:
                        if g == BLOCK:
                            read_block(data, p, q, base, media, cluster, not refers, lasts)
        elif kind == CUES:
            for k, x, y in elements(data, a, e):
                if k == CUE_POINT:
                    read_cue(data, x, y, media)


def read_track(data: bytes, at: int, end: int, media: Media) -> None:
    track: dict = {}
    for k, x, y in elements(data, at, end):
        if k in (TRACK_NUMBER, TRACK_TYPE, TRACK_UID, DEFAULT_DURATION):
            track[{TRACK_NUMBER: "number", TRACK_TYPE: "type", TRACK_UID: "uid", DEFAULT_DURATION: "default_duration"}[k]] = number(data, x, y)
        elif k == CODEC_ID:
            track["codec"] = data[x:y].rstrip(b"\0").decode("ascii")
        elif k == AUDIO:
            for a, p, q in elements(data, x, y):
                if a == SAMPLING_FREQUENCY:
                    track["rate"] = real(data, p, q)
                elif a in (CHANNELS, BIT_DEPTH):
                    track["channels" if a == CHANNELS else "bits"] = number(data, p, q)
    media.tracks[track["number"]] = track


def read_cue(data: bytes, at: int, end: int, media: Media) -> None:
    time = 0
    for k, x, y in elements(data, at, end):
        if k == CUE_TIME:
            time = number(data, x, y)
        elif k == CUE_TRACK_POSITIONS:
            found = {a: number(data, p, q) for a, p, q in elements(data, x, y)}
            media.cues.append((time, found.get(CUE_TRACK, 0), found.get(CUE_CLUSTER_POSITION, 0)))


# ---------------------------------------------------------------- writing


def vint(value: int, width: int = 0) -> bytes:
    width = width or next(w for w in range(1, 9) if value < (1 << 7 * w) - 1)
    return (value | 1 << 7 * width).to_bytes(width, "big")


def element(kind: int, body: bytes) -> bytes:
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def uint(kind: int, value: int) -> bytes:
    return element(kind, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def laced_block(frames: list[bytes], relative: int, lacing: int, track: int = 1) -> bytes:
    """A simple block's body; lacing FIXED needs frames of one size."""
    head = vint(track) + struct.pack(">hB", relative, 0x80 | lacing << 1)
    if lacing == NO_LACING:
        return head + frames[0]
    head += bytes([len(frames) - 1])
    sizes = [len(f) for f in frames]
    if lacing == XIPH:
        head += b"".join(b"\xff" * (s // 255) + bytes([s % 255]) for s in sizes[:-1])
    elif lacing == EBML_LACING and len(frames) > 1:
        head += vint(sizes[0])
        for a, b in zip(sizes, sizes[1:-1], strict=False):
            width = next(w for w in range(1, 9) if abs(b - a) < 1 << (7 * w - 1))
            head += vint(b - a + (1 << (7 * width - 1)) - 1, width)
    return head + b"".join(frames)


def encode(payload: bytes) -> bytes:
    """Store bytes as the 8-bit samples of one audio track.

    Full blocks have fixed lacing; the last block of a value, whose frames differ in size, alternates
    between EBML and Xiph lacing by the number of frames; a single frame has none.
    """
    frames = [payload[at : at + FRAME] for at in range(0, len(payload), FRAME)]
    step = FRAME * 1000 // RATE
    clusters, cues, at = [], [], 0
    info = element(INFO, uint(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(payload) * 1000 / RATE)) + element(MUXING_APP, b"docloom") + element(WRITING_APP, b"docloom"))
    audio = element(AUDIO, element(SAMPLING_FREQUENCY, struct.pack(">d", RATE)) + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8))
    tracks = element(TRACKS, element(TRACK_ENTRY, uint(TRACK_NUMBER, 1) + uint(TRACK_UID, 1) + uint(TRACK_TYPE, 2) + element(CODEC_ID, b"A_PCM/INT/LIT") + audio))
    at = len(info) + len(tracks)
    for first in range(0, len(frames), CLUSTER_FRAMES):
        part = frames[first : first + CLUSTER_FRAMES]
        body = [uint(CLUSTER_TIMESTAMP, first * step)]
        for k in range(0, len(part), LACED):
            group = part[k : k + LACED]
            even = len({len(f) for f in group}) == 1
            lacing = NO_LACING if len(group) == 1 else FIXED if even else EBML_LACING if len(group) % 2 else XIPH
            body.append(element(SIMPLE_BLOCK, laced_block(group, k * step, lacing)))
        made = element(CLUSTER, b"".join(body))
        cues.append(element(CUE_POINT, uint(CUE_TIME, first * step) + element(CUE_TRACK_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER_POSITION, at))))
        clusters.append(made)
        at += len(made)
    head = element(EBML, uint(0x4286, 1) + uint(0x42F7, 1) + uint(0x42F2, 4) + uint(0x42F3, 8) + element(DOC_TYPE, b"matroska") + uint(0x4287, 4) + uint(0x4285, 2))
    return head + element(SEGMENT, info + tracks + b"".join(clusters) + element(CUES, b"".join(cues)))


def samples(data: bytes, media: Media, track: int = 1) -> bytes:
    """The stored bytes of a track, in packet order."""
    return b"".join(data[p.offset : p.offset + p.size] for p in media.packets if p.track == track)


def cued_packets(media: Media) -> set[int]:
    """Numbers of the packets that cues point at."""
    of: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for n, p in enumerate(media.packets):
        of.setdefault((p.cluster, p.track), []).append((p.timestamp_ns, n))
    out = set()
    for time, track, _, cluster in media.cue_places():
        later = [x for x in of.get((cluster, track), []) if x[0] >= time] if cluster is not None else []
        if later:
            out.add(min(later)[1])
    return out


# ---------------------------------------------------------------- columns

PACKETS = "id long, track int, packet int, timestamp_ns long, byte_offset long, byte_size long, keyframe boolean, lacing int, lace int, cluster int, duration_ns long, cue boolean, error string"


def packets(values: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """A packet table of a binary column: one row for each packet.

    cue tells whether a cue points at the packet: the first of the cue's track at or after its time in the cluster that it
    names by byte place. A null value gives no rows; unreadable bytes give one row with error set and the rest null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("track", pa.int32()), ("packet", pa.int32()), ("timestamp_ns", pa.int64()), ("byte_offset", pa.int64()), ("byte_size", pa.int64()), ("keyframe", pa.bool_()), ("lacing", pa.int32()), ("lace", pa.int32()), ("cluster", pa.int32()), ("duration_ns", pa.int64()), ("cue", pa.bool_()), ("error", pa.string())])
        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                if not value.is_valid:
                    continue
                try:
                    found = parse(value.as_py())
                    cued = cued_packets(found)
                    rows = [(key.as_py(), p.track, n, p.timestamp_ns, p.offset, p.size, p.keyframe, p.lacing, p.lace, p.cluster, p.duration_ns, n in cued, None) for n, p in enumerate(found.packets)]
                except MediaError as error:
                    rows = [(key.as_py(), *[None] * 11, str(error))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return values.select(F.col(id_col).cast("long"), F.col(media_col).cast("binary")).mapInArrow(run, PACKETS)


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes padded with zeros to a positive multiple of 64, and their number before that."""
    raw = (text or "").encode()
    return raw + bytes(-len(raw) % 64 or (0 if raw else 64)), len(raw)


def media_column(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each text's payload stored as Matroska; null and empty texts are 64 zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 256):
                made = [(encode(p), n) for p, n in map(payload_of, texts[at : at + 256].to_pylist())]
                yield pa.RecordBatch.from_arrays([ids[at : at + 256], pa.array([n for _, n in made], pa.int64()), pa.array([m for m, _ in made], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def feature(data: bytes, media: Media, payload: bytes) -> str:
    """Counts of the container and the samples' level: equal bytes, equal text."""
    s = np.frombuffer(payload, np.uint8).astype(np.int64)
    turns = int(np.count_nonzero(np.diff(s > 127)))
    return f"packets={len(media.packets)};clusters={len(media.clusters)};cues={len(media.cues)};ms={media.packets[-1].timestamp_ns // 1_000_000 if media.packets else 0};sum={int(s.sum())};energy={int((s * s).sum())};turns={turns}"


def media_features(stored: DataFrame) -> DataFrame:
    """Parse stored media, read the samples back by their byte ranges, and describe both.

    Raises MediaError for bytes that are not Matroska, as they were written by media_column.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for key, n, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    media = parse(data)
                    payload = samples(data, media)
                    rows.append((key, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature(data, media, payload)))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in FEATURES.split(", ")])

    return stored.mapInArrow(run, FEATURES)


def media_digest(docs: DataFrame) -> DataFrame:
    """The digest columns of each document's stored media. Repeated rows give repeated rows."""
    return media_features(media_column(docs))
