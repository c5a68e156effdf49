"""Repeated byte strings: every byte covered by a `length`-byte string that starts at another place too.

The suffixes of a fixed sample of positions are named first and all other suffixes are merged through the
sampled one that follows them, as in the difference-cover construction of a suffix array. The sample
differs: a cover fixed by position holds 18 of 307 positions and pairs each suffix with 18 offsets, because
two suffixes agree only on some offset. Here the sample is fixed by content: in each string the start of its
least-hashed `gram` bytes. Equal strings then have their sampled position at the same offset, one position
in about 140 is sampled, and each suffix has one offset to be merged by.

1. Name: a sampled position is named by its gram; the strings that share it are a range of starts. Several lengths are
   sampled in one pass, each with names of its own.
2. Classes: positions with the same name and the same bytes around all their strings are one class; a class
   with two members settles all its strings at once, however many copies there are.
3. Merge: a name with several classes compares its classes' strings, offset by offset, in one place; where they are
   too many bytes for one place, the strings become rows that are counted.
4. Runs of repeated strings become byte spans, and the spans are cut from the texts.

Nothing is quadratic in a group: a class is counted, and a name's strings are sorted by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom.llm.common import begin, materialize, row_keys, shuffle_partitions

LENGTH, GRAM = 400, 128
#: Passages of over 50 words mostly have this many bytes; they are counted beside, not removed.
SHORT, SHORT_GRAM = 256, 96
#: Bytes of one name's classes that one task compares; above, their strings are counted as rows of their own.
LARGE = 16_000_000
#: Bytes of several texts that are hashed at once.
HASHED = 1 << 15
#: Contexts of several names that are compared at once.
TOGETHER = 1024

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2 ** 64."""
    if base not in _tables or len(_tables[base][0]) < n:
        size, made = max(n, 1 << 17), []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, U(b), np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        _tables[base] = tuple(made)
    up, down = _tables[base]
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Hashes:
    """Hashes of any ranges of some bytes."""

    def __init__(self, b: np.ndarray, base: int):
        up, self.down = powers(base, len(b) + 1)
        self.total = np.empty(len(b) + 1, np.uint64)
        self.total[0] = 0
        np.cumsum((b.astype(np.uint64) + U(1)) * up[:-1], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start])

    def each(self, width: int) -> np.ndarray:
        """What `of` mixes, for all ranges of a width."""
        found = self.total[width:] - self.total[:-width]
        found *= self.down[: len(found)]
        return found


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value in each window (the first of equals), by minima of windows twice as wide each time."""
    low = h & ~U(0xFFFFFFFF)
    low |= np.arange(len(h), dtype=np.uint64)
    k = 1
    while 2 * k <= width:
        low = np.minimum(low[:-k], low[k:])
        k *= 2
    if k < width:
        low = np.minimum(low[: k - width], low[width - k :])
    return (low & U(0xFFFFFFFF)).view(np.int64)


def anchors(texts: list[np.ndarray], sizes: list[tuple[int, int]]) -> tuple[np.ndarray, ...]:
    """(name, class hash, text, place in sizes, position, first start, last start) of each sampled position, for all (length, gram).

    The texts are hashed as one run of bytes; strings across their borders are left out.
    """
    b, lens = np.concatenate(texts), np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lens)
    found = [tuple(np.zeros(0, np.int64) for _ in range(7))]
    if len(b) >= min(length for length, _ in sizes):
        one, two = Hashes(b, BASES[0]), Hashes(b, BASES[1])
    for k, (length, gram) in enumerate(sizes):
        if len(b) < length:
            continue
        grams = one.each(gram)  # their upper halves are hashes enough to be ordered by
        least = sliding_least(grams, length - gram + 1)
        edge = np.ones(len(least), bool)
        np.not_equal(least[1:], least[:-1], out=edge[1:])
        borders = np.concatenate((ends, (ends - length + 1)[lens >= length]))  # where texts, and strings within them, end
        edge[borders[borders < len(least)]] = True
        low = np.flatnonzero(edge)
        high = np.concatenate((low[1:], [len(least)])) - 1
        text = np.searchsorted(ends, low, "right")
        inside = low + length <= ends[text]
        low, high, text = low[inside], high[inside], text[inside]
        place = least[low]
        shape = (place - low).astype(np.uint64) << U(32) | (high - low).astype(np.uint64)
        around = mix(two.of(low, high + length) + mix(shape))
        name = mix(mix(grams[place]) + U(length * BASES[0] & (1 << 64) - 1))
        first = (ends - lens)[text]
        found.append((name.view(np.int64), around.view(np.int64), text, np.full(len(place), k), place - first, low - first, high - first))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def raw(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


#: which length, place, starts before it and starts after the first, in one number: 1, 32, 15 and 15 bits.
SHIFT, PLACE = 15, 32


def sampled(texts: DataFrame, sizes: list[tuple[int, int]]) -> DataFrame:
    """(name, around, doc, spot): the sampled positions of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("repeats")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = [raw(t) for t in batch.column(1)[at : at + 256].to_pylist()]
                lens = np.cumsum([len(t) for t in texts])
                cuts = [0, *(np.flatnonzero(np.diff(lens // HASHED)) + 1).tolist(), len(texts)]
                found = [(a, *anchors(texts[a:z], sizes)) for a, z in zip(cuts, cuts[1:], strict=False)]
                name, around, text, which, place, low, high = (np.concatenate([f[k] + f[0] if k == 3 else f[k] for f in found]) for k in range(1, 8))
                doc = batch.column(0)[at : at + 256].to_numpy()[text]
                spot = which << 2 * SHIFT + PLACE | place << 2 * SHIFT | (place - low) << SHIFT | high - low
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (name, around, doc, spot)], names=["name", "around", "doc", "spot"])

    return texts.mapInArrow(run, "name long, around long, doc long, spot long")


def bits(low: int, width: int) -> Column:
    return F.shiftright("spot", low).bitwiseAND(F.lit((1 << width) - 1))


def which() -> Column:
    return F.shiftright("spot", 2 * SHIFT + PLACE)


def first_start() -> Column:
    return bits(2 * SHIFT, PLACE) - bits(SHIFT, SHIFT)


def last_stop(sizes: list[tuple[int, int]]) -> Column:
    """Where the last string of a sampled position ends."""
    return first_start() + bits(0, SHIFT) + F.get(F.array(*[F.lit(length) for length, _ in sizes]), which().cast("int"))


def windows(batch: pa.RecordBatch, sizes: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, start) of every string of the contexts in a batch of (name, n, which, back, context, ...), start within its context.

    Contexts are hashed many at a time, as one run of bytes.
    """
    contexts = batch.column("context").to_pylist()
    lens = np.fromiter(map(len, contexts), np.int64, len(contexts))
    length = np.array([length for length, _ in sizes])[batch.column("which").to_numpy()]
    back, step = batch.column("back").to_numpy(), max(1, ((1 << 17) - 1) // int(lens.max()))
    found = []
    for at in range(0, len(contexts), step):
        part = slice(at, at + step)
        hashes = Hashes(np.frombuffer(b"".join(contexts[part]), np.uint8), BASES[1])
        n = lens[part] - length[part] + 1
        row = np.repeat(np.arange(len(n)), n)
        start = np.arange(len(row)) - (np.cumsum(n) - n)[row]
        place = start + (np.cumsum(lens[part]) - lens[part])[row]
        found.append((hashes.of(place, place + length[part][row]) + (back[part][row] - start).astype(np.uint64), row + at, start))
    keys, row, start = (np.concatenate(c) for c in zip(*found, strict=True))
    return mix(keys).view(np.int64), row, start


def found_twice(keys: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Whether the same key occurs again in its group."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    if (group[order[1:]] != group[order[:-1]])[same].any():
        order = np.lexsort((keys, group))
        same = (keys[order[1:]] == keys[order[:-1]]) & (group[order[1:]] == group[order[:-1]])
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    return twice


def merged(contexts: DataFrame, sizes: list[tuple[int, int]]) -> DataFrame:
    """(which, doc, start, stop): repeated strings of single-member classes, by comparing the classes of each name."""

    def compared(rows: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """The columns of the result, for whole names."""
        keys, row, start = windows(rows, sizes)
        name, n, which, doc, low = (rows.column(c).to_numpy() for c in ("name", "n", "which", "doc", "low"))
        group = name[row]
        hit = found_twice((keys.view(np.uint64) + mix(group.view(np.uint64))).view(np.int64), group) & (n == 1)[row]
        other = row[1:] != row[:-1]
        first, last = hit.copy(), hit.copy()
        first[1:] &= ~hit[:-1] | other
        last[:-1] &= ~hit[1:] | other
        first, last = np.flatnonzero(first), np.flatnonzero(last)
        at = row[first]
        length = np.array([length for length, _ in sizes])[which[at]]
        return which[at], doc[at], low[at] + start[first], low[at] + start[last] + length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = table.combine_chunks().to_batches()[0]
            name = rows.column("name").to_numpy()
            cuts = [*(np.flatnonzero(name[1:] != name[:-1]) + 1).tolist(), len(name)]
            at = 0
            for here, after in zip(cuts, [*cuts[1:], None], strict=True):
                if after is None or after - at > TOGETHER:
                    found = compared(rows.slice(at, here - at))
                    at = here
                    if len(found[0]):
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["which", "doc", "start", "stop"])

        for batch in batches:
            if not batch.num_rows:
                continue
            name = batch.column("name").to_numpy()
            last = int(np.flatnonzero(name != name[-1])[-1]) + 1 if (name != name[-1]).any() else 0
            if held and (last or held[-1].column("name")[-1].as_py() != name[0]):
                head = [*held, batch.slice(0, last)] if last else held
                yield from flush(pa.Table.from_batches(head))
                held = []
            elif last:
                yield from flush(pa.Table.from_batches([batch.slice(0, last)]))
            held.append(batch.slice(last))
        if held:
            yield from flush(pa.Table.from_batches(held))

    placed = contexts.repartition(shuffle_partitions(contexts.sparkSession), "name").sortWithinPartitions("name")
    return placed.mapInArrow(run, "which long, doc long, start long, stop long")


def counted(contexts: DataFrame, sizes: list[tuple[int, int]]) -> DataFrame:
    """As merged, for names with too much text for one task: strings as rows, counted by key with partial sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                keys, row, inside = windows(part, sizes)
                low = part.column("low").to_numpy()[row]
                n = part.column("n").to_numpy()[row]
                columns = (part.column("name").to_numpy()[row], keys, part.column("which").to_numpy()[row], part.column("doc").to_numpy()[row], low + inside, n)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["name", "key", "which", "doc", "start", "n"])

    rows = contexts.mapInArrow(run, "name long, key long, which long, doc long, start long, n long")
    twice = materialize(rows.groupBy("name", "key").agg(F.count("*").alias("times")).where("times > 1").select("name", "key"), "strings")
    length = F.get(F.array(*[F.lit(length) for length, _ in sizes]), F.col("which").cast("int"))
    return rows.where("n = 1").join(twice, ["name", "key"]).select("which", "doc", "start", (F.col("start") + length).alias("stop"))


def repeated_spans(docs: DataFrame, sizes: list[tuple[int, int]], large: int = LARGE) -> DataFrame:
    """(which, doc, start, stop): byte ranges of UTF-8 texts that repeated strings cover; ranges may overlap or repeat.

    sizes holds at most two pairs (length, gram), and which is a place in it; doc is the key of common.row_keys.
    """
    return spans_of(row_keys(docs)[0].select(F.col("key").alias("doc"), "text"), sizes, large)


def spans_of(texts: DataFrame, sizes: list[tuple[int, int]], large: int) -> DataFrame:
    """repeated_spans of texts (doc, text)."""
    if not all(1 <= gram <= length < 1 << SHIFT for length, gram in sizes) or len(sizes) > 2:
        raise ValueError("gram must be at most length, and length below 32768; at most two lengths")
    found = sampled(texts, sizes)
    classes = found.groupBy("name", "around").agg(F.count("*").alias("n"), F.min(F.struct("doc", "spot")).alias("one")).select("name", "around", "n", "one.doc", "one.spot")
    # names by partial sums, so that a name which a third of all positions have is in no one task
    reach = last_stop(sizes) - first_start()
    names = classes.groupBy("name").agg(F.count("*").alias("kinds"), F.sum("n").alias("all"), F.sum(reach).alias("bytes")).where("`all` > 1").drop("all")
    shared = materialize(classes.join(names, "name"), "classes")
    settled = found.join(shared.where("n > 1").select("name", "around"), ["name", "around"])
    settled = settled.select(which().alias("which"), "doc", first_start().alias("start"), last_stop(sizes).alias("stop"))

    part = F.struct("name", "n", "bytes", which().alias("which"), first_start().alias("low"), last_stop(sizes).alias("end"), bits(SHIFT, SHIFT).alias("back"))
    asked = shared.where("kinds > 1").select("doc", part.alias("part")).groupBy("doc").agg(F.collect_set("part").alias("parts"))
    columns = ("name", "n", "bytes", "which", "doc", "low", "back")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, parts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                b = (text.as_py() or "").encode("utf-8", "surrogatepass")
                out += [(p["name"], p["n"], p["bytes"], p["which"], doc, p["low"], p["back"], b[p["low"] : p["end"]]) for p in parts.as_py()]
                if len(out) > 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    schema = pa.schema([(c, pa.int64()) for c in columns] + [("context", pa.binary())])
    contexts = texts.join(asked, "doc").select("doc", "text", "parts").mapInArrow(cut, ", ".join(f"{c} long" for c in columns) + ", context binary")
    contexts = materialize(contexts, "contexts")
    return settled.union(merged(contexts.where(F.col("bytes") <= large), sizes)).union(counted(contexts.where(F.col("bytes") > large), sizes))


DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_bytes long, n_passages long, kept binary"


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, short: tuple[int, int] = (SHORT, SHORT_GRAM), large: int = LARGE, keep_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_bytes, n_passages, kept) for each row of docs: its bytes without repeated strings.

    n_passage_bytes and n_passages are the bytes and runs that strings of the short length cover which start anywhere else too;
    they are told, and stay. kept may not be valid UTF-8, as strings are judged by bytes; it is null with keep_bytes=False. Texts
    below `length` bytes, empty and null ones lose nothing (null gives 0 bytes). Repeated rows are documents of their own, so texts
    of `length` bytes or more in them go wholly; rows of one doc_id with different texts are documents of their own. Empty tables
    give no rows.
    """
    rows = row_keys(docs)[0].withColumnRenamed("key", "doc")
    spans = spans_of(rows.select("doc", "text"), [(length, gram), short], large)
    by_doc = spans.groupBy(F.col("doc").alias("at")).agg(F.collect_set(F.struct("which", "start", "stop")).alias("spans"))
    joined = rows.join(by_doc, F.col("doc") == F.col("at"), "left").select("doc_id", "text", F.col("spans.which").alias("which"), F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops"))

    def covered(n: int, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, int]:
        """Which of n bytes the ranges cover, and in how many runs."""
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, stops, -1)
        gone = np.cumsum(change[:-1]) > 0
        return gone, int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                out = []
                for t, w, a, z in zip(*(batch.column(k)[at : at + 512] for k in (1, 2, 3, 4)), strict=True):
                    b = (t.as_py() or "").encode("utf-8", "surrogatepass")
                    if not a.is_valid:
                        out.append((len(b), 0, 0, hashlib.sha256(b).hexdigest(), 0, 0, b if keep_bytes else None))
                        continue
                    w, a, z = (np.asarray(x.values) for x in (w, a, z))
                    gone, runs = covered(len(b), a[w == 0], z[w == 0])
                    told, passages = covered(len(b), a[w == 1], z[w == 1])
                    left = np.frombuffer(b, np.uint8)[~gone].tobytes()
                    out.append((len(b), int(gone.sum()), runs, hashlib.sha256(left).hexdigest(), int(told.sum()), passages, left if keep_bytes else None))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + 512], *[pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]], names=[c.split()[0] for c in DIGEST.split(", ")])

    return joined.mapInArrow(run, DIGEST)
