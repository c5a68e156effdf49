"""Best-fit packing with Martello-Toth dominance reduction.

Documents become token pieces of at most `capacity` ids; pieces become gapless sequences. Only the
lengths matter to a packing, and there are at most `capacity` distinct ones, so the plan is made on
the histogram of lengths: a table whose size the capacity bounds, whatever the corpus. The plan says,
for each rank range of a length, which sequences take these pieces and at which place. Ranks are
given in salted parts of a length, so that a length that a third of all pieces have is spread out.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docloom.llm.common import materialize, shuffle_partitions, worker_cache

CAPACITY = 4096
END_ID = 1
#: Words that one Python worker keeps encoded; others are encoded again where they occur.
WORD_CACHE = 700_000
#: Single marks that may follow a word.
MARKS = ".,"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordEncoder:
    """Token ids of whole texts, word by word.

    The tokenizer's normaliser and splitter never look across a space or line feed (white space is
    dropped, no token holds any), so a text's ids are the ids of its space-separated parts in order.
    Parts repeat, so each is encoded once for as long as the bounded cache holds it. Parts that are
    letters only are encoded many at once, joined by spaces: each gives one token that ends a word.
    """

    def __init__(self, path: str, limit: int = WORD_CACHE):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.known = Tokenizer.from_file(path), limit, {}
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(size, bool)
        for token, k in self.tokenizer.get_vocab().items():
            self.ends[k] = token.endswith("</w>")

    def each(self, parts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def letters(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words of letters only."""
        out: dict[str, bytes] = {}
        groups = [words[at : at + 256] for at in range(0, len(words), 256)]
        for group, found in zip(groups, self.each([" ".join(g) for g in groups]), strict=True):
            last = np.flatnonzero(self.ends[np.frombuffer(found, self.kind)])
            if len(last) == len(group):
                width = self.kind.itemsize
                cuts = [0, *((last + 1) * width).tolist()]
                out.update(zip(group, (found[x:y] for x, y in zip(cuts, cuts[1:], strict=False)), strict=True))
            else:  # lowering or composing gave one of them more words or fewer
                out.update(zip(group, self.each(group), strict=True))
        return out

    def fresh(self, new: list[str]) -> dict[str, bytes]:
        """The ids of parts not met before: letters, letters with one mark behind, and all others."""
        stems = {w: w[:-1] if w[-1:] in MARKS and w[:-1].isalpha() else w for w in new}
        stems = {w: s.lower() if s.isascii() else s for w, s in stems.items()}
        words = self.letters(list({s for s in stems.values() if s.isalpha()}))
        marks = dict(zip(MARKS, self.each(list(MARKS)), strict=True))
        other = [w for w, s in stems.items() if s not in words]
        out = dict(zip(other, self.each(other), strict=True))
        for w, s in stems.items():
            if w not in out:
                out[w] = words[s] if w[-1] not in marks else words[s] + marks[w[-1]]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        known = self.known
        new = {w for p in parts for w in p if w not in known}
        if new:
            fresh = self.fresh(list(new))
            if len(known) + len(fresh) <= self.limit:
                known.update(fresh)
            else:
                for w in list(fresh)[: max(0, self.limit - len(known))]:
                    known[w] = fresh[w]
                known = _Both(known, fresh)
        return [np.frombuffer(b"".join(map(known.__getitem__, p)), self.kind) for p in parts]


class _Both:
    """Two dictionaries looked up as one."""

    def __init__(self, first: dict, second: dict):
        self.first, self.second = first, second

    def __getitem__(self, key: str) -> bytes:
        found = self.first.get(key)
        return self.second[key] if found is None else found


def encoder(path: str, words: int = WORD_CACHE) -> WordEncoder:
    """One encoder for each Python worker and tokenizer file."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return worker_cache("packing", (path, words), lambda: WordEncoder(path, words))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, words: int = WORD_CACHE) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a document's ids, then end_id, cut where longer than capacity.

    A null or empty text is the one piece [end_id]. Repeated rows give repeated pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, words).encode
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(ids), 128):
                out: list[tuple] = []
                for doc, tokens in zip(ids[at : at + 128], encode([t or "" for t in texts[at : at + 128].to_pylist()]), strict=True):
                    whole = np.empty(len(tokens) + 1, "<u4")
                    whole[:-1] = tokens
                    whole[-1] = end_id
                    for k, start in enumerate(range(0, len(whole), capacity)):
                        part = whole[start : start + capacity]
                        out.append((doc, k, start, len(part), zlib.crc32(part.tobytes())))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


class Plan:
    """Rows (size, first rank, last rank + 1, first sequence, pieces in each sequence, first place)."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.left, self.capacity = counts.astype(np.int64).copy(), capacity
        self.rank = np.zeros(capacity + 1, np.int64)
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        self.fixed = 0

    def take(self, size: int, first: int, bins: int, each: int, place: int) -> None:
        n = bins * each
        self.rows.append((size, int(self.rank[size]), int(self.rank[size]) + n, first, each, place))
        self.rank[size] += n
        self.left[size] -= n

    def fix(self, sizes: tuple[int, ...], times: int) -> None:
        """The same set of sizes, so many times, each in a sequence of its own."""
        place = 0
        for size in dict.fromkeys(sizes):
            each = sizes.count(size)
            self.take(size, self.sequences, times, each, place)
            place += size * each
        self.sequences += times
        self.fixed += times

    def reduce(self) -> None:
        """Martello-Toth reduction: fix each set that dominates every other feasible set with its largest piece.

        For the largest free piece w with room r = capacity - w, and k the largest piece that fits in r:
        {w} dominates if nothing fits; {w, k} if k fills r or no two pieces fit in r; {w, k, b}, with b the
        largest that fits beside k, if no three pieces fit and no pair in r has a smaller part above b.
        """
        present = [int(s) for s in np.flatnonzero(self.left)]
        for w in reversed(present):
            while self.left[w] > 0:
                room = self.capacity - w
                free = lambda s: int(self.left[s]) - (s == w)
                fits = [s for s in present[: bisect.bisect_right(present, room)] if free(s) > 0]
                if not fits:
                    self.fix((w,), int(self.left[w]))
                    break
                k, low = fits[-1], fits[0]
                times = int(self.left[w]) // 2 if k == w else int(min(self.left[w], self.left[k]))
                second = low if free(low) > 1 else (fits[1] if len(fits) > 1 else self.capacity)
                if k == room or low + second > room:
                    self.fix((w, k), times)
                    continue
                beside = [s for s in fits if s <= room - k and (s != k or free(k) > 1)]
                if beside and 3 * low > room:
                    b = beside[-1]
                    above = next((s for s in fits if s > b), self.capacity)
                    need = {s: (w, k, b).count(s) for s in (w, k, b)}
                    times = min(int(self.left[s]) // n for s, n in need.items())
                    if 2 * above > room and times:
                        self.fix((w, k, b), times)
                        continue
                break

    def best_fit(self) -> None:
        """Best-fit decreasing over what is left; sequences with the same room go together."""
        rooms: list[int] = []  # sorted; open[room] holds (first sequence, how many)
        opened: dict[int, list[tuple[int, int]]] = {}

        def put(room: int, first: int, n: int) -> None:
            if room and n:
                if room not in opened:
                    bisect.insort(rooms, room)
                opened.setdefault(room, []).append((first, n))

        for size in (int(s) for s in np.flatnonzero(self.left)[::-1]):
            while (n := int(self.left[size])) > 0:
                at = bisect.bisect_left(rooms, size)
                if at < len(rooms):
                    room = rooms[at]
                    first, bins = opened[room].pop()
                    if not opened[room]:
                        del opened[room]
                        rooms.pop(at)
                else:
                    room, first, bins = self.capacity, self.sequences, -(-n // (self.capacity // size))
                    self.sequences += bins
                each = room // size
                whole = min(bins, n // each)
                place = self.capacity - room
                if whole:
                    self.take(size, first, whole, each, place)
                    put(room - whole_size(size, each), first, whole)
                if whole < bins:
                    rest = n - whole * each
                    if rest:
                        self.take(size, first + whole, 1, rest, place)
                        put(room - whole_size(size, rest), first + whole, 1)
                    put(room, first + whole + bool(rest), bins - whole - bool(rest))


def whole_size(size: int, n: int) -> int:
    return size * n


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """The packing of a histogram: counts[s] pieces of size s."""
    p = Plan(counts, capacity)
    p.reduce()
    p.best_fit()
    return p


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (which must be materialized: they are read three times).

    Equal rows are interchangeable. No pieces give no sequences.
    """
    spark = found.sparkSession
    salts = shuffle_partitions(spark)
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    parts = materialize(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for row in parts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[row["length"]] = row["n"]
    made = plan(counts, capacity)
    rows = np.array(sorted(made.rows), np.int64).reshape(-1, 6)
    by_salt = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("length", "salt", F.coalesce(F.sum("n").over(by_salt), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(within) - 1).join(bases, ["length", "salt"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = rows[:, 0] << 44 | rows[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            size, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "place_rank"))
            row = rows[np.searchsorted(order, size << 44 | rank, side="right") - 1]
            inside = rank - row[:, 1]
            at = row[:, 3] + inside // row[:, 4], row[:, 5] + inside % row[:, 4] * size
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(at[0]), pa.array(at[1])], schema=out_schema)

    out_schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
    placed = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("place_rank"))
    return placed.mapInArrow(place, T._parse_datatype_string(PIECES + ", sequence_id long, offset long"))


def best_fit_pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, words: int = WORD_CACHE) -> DataFrame:
    """Pack all documents' tokens into as few sequences of at most `capacity` ids as the method finds.

    docs: doc_id, text; further columns are ignored. Null and empty texts give a piece of one id; a null
    doc_id is kept as null; an empty table gives no rows. Returns a row for each piece with sequence_id
    and offset; a sequence's pieces lie gapless from 0. words: how many words a Python worker keeps encoded, about 200 bytes
    each; the result does not depend on it.
    """
    return pack(materialize(pieces(docs, tokenizer, capacity, end_id, words), "pieces"), capacity)
