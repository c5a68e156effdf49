"""N-gram Jaccard join with set-relation skipping, exact for groups and numbers of links.

A document is the set of its distinct word shingles, as 64-bit hashes. Equal sets are one class. A global
order puts shingles that many documents hold last: their frequency level comes from one fixed-size count
table over all shingles of all documents, and any order gives the same result. Two classes that link share
one of the first n - ceil(J n) + 1 shingles of that order, so inverted lists hold only these prefixes.

Skipping by answers: each class first meets one leader - the class that heads most of its list blocks. The
verified overlaps with leaders are answers that others derive theirs from: classes linked with one leader
need not meet, since a group is known already; and Jaccard distance is a metric, so classes whose distances
to a common leader differ by more than 1 - J cannot link.

Skipping by index: a list does not hold classes but index blocks, tiles of classes with the same leader, the
same band of distances to it, the same band of sizes, and one answer to the question whether they are in its
group. A block's entry in a list has its bounds of size, position, distance and group, and two blocks of a list
meet only if these leave room for a link; lists whose classes are one group already are closed. What is left are
pairs of blocks, which are verified whole, as one product of small matrices; tasks return spanning edges.

Links are counted on top of the groups: a link never leaves its group, so all pairs of a group's classes whose
sizes leave room are verified, in tiles; tasks return sums for each class and never pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import begin, components, fits_broadcast, materialize, release, row_keys, shuffle_partitions, spanning

SHINGLE, PERCENT = 5, 75
#: Counters of the frequency table (a power of two), and slices in which it is summed.
COUNTERS, SLICES = 1 << 23, 64
#: Classes of one index block, and followers that meet their leader in one place.
TILE = 64
#: Bands of distances to a leader that index blocks are made of.
BANDS = 20
#: Sets of one tile when the links of a group are counted, and shingles that are counted at once.
LINK_TILE, LINK_CHUNK = 256, 1 << 20
#: Prefixes are read on by this share of the smaller set, so that a pair must share as many shingles more.
SLACK_SHARE = 16
#: Class ids that may be broadcast to pick out their texts; above, the texts are joined by shuffle.
BROADCAST_IDS = 2_000_000

U = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(int(BASE), -1, 1 << 64))
STEPS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse modulo 2 ** 64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, b in enumerate((BASE, INVERSE)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; of the whole sequence where there are fewer; empty without words."""
    if not text:
        return np.zeros(0, np.uint64)
    b = LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    gap = np.concatenate(([True], SPACE[b], [True]))
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = powers(len(b) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + U(1)) * up[: len(b)], dtype=np.uint64)))
    words = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    n = len(words)
    if n < size:
        h = np.zeros(1, np.uint64)
        for k in range(n):
            h = mix(h + words[k : k + 1] * STEPS[k % 5] + U(k + 1))
        return mix(h + U(n))
    h = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        h += words[k : n - size + 1 + k] * STEPS[k % 5]
    return np.unique(mix(h))


def set_name(s: np.ndarray) -> tuple[int, int]:
    """A 128-bit name of a set, as two signed numbers."""
    if not len(s):
        return 0, 0
    order = np.arange(1, len(s) + 1, dtype=np.uint64)
    sums = [np.sum(mix(s + order * BASE), dtype=np.uint64), np.sum(mix((s ^ STEPS[2]) * STEPS[3] + order * STEPS[4]), dtype=np.uint64)]
    one, two = mix(np.array(sums, np.uint64) + U(len(s))).view(np.int64)
    return int(one), int(two)


def need(n: int, m: int, percent: int = PERCENT) -> int:
    """Least intersection of linked sets of n and m members: 100 i >= percent (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


# ---------------------------------------------------------------- sets, levels, lists


def sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, own, n, name, more) of each row of (doc_id, own, text); name and more are the halves of the set's name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("ngrams")
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                found = [(len(s), *set_name(s)) for s in (shingle_set(t, size) for t in batch.column(2)[at : at + 512].to_pylist())]
                yield pa.RecordBatch.from_arrays([*[batch.column(k)[at : at + 512] for k in (0, 1)], *[pa.array(c, pa.int64()) for c in zip(*found, strict=True)]], names=["doc_id", "own", "n", "name", "more"])

    return docs.select("doc_id", "own", "text").mapInArrow(run, "doc_id long, own long, n long, name long, more long")


def told_apart(docs: DataFrame) -> tuple[DataFrame, bool]:
    """((doc_id, own, text), whether any id has several texts): doc_id is the key of common.row_keys (null for a null id), own the id itself."""
    keyed, split = row_keys(docs)
    return keyed.select(F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("doc_id"), F.col("doc_id").alias("own"), "text"), split


def with_own_ids(found: DataFrame, split: bool) -> DataFrame:
    """found (doc_id, own, component_id, ...) with own ids in place of keys: a component's is the smallest of its rows."""
    if not split:
        return found.drop("own")
    found = materialize(found, "keyed_groups")
    least = found.where("component_id is not null").groupBy("component_id").agg(F.min("own").alias("least"))
    rest = [F.col(c) for c in found.columns if c not in ("doc_id", "own", "n_shingles", "component_id")]
    return found.join(least, "component_id", "left").select(F.col("own").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"), *rest)


def frequency_levels(docs: DataFrame, size: int, total: int) -> list[bytes]:
    """A level for each counter, as compressed slices: 0 up to what chance makes of the mean count, then two more for each doubling.

    Every shingle of every document is counted; total is the number of shingles. Tasks send slices of their table,
    compressed; slices are summed as a stream and become levels where they are summed, so the driver holds nothing but
    compressed levels, a byte a counter at most, however large the corpus.
    """
    width = COUNTERS // SLICES
    mean = total / COUNTERS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("ngrams")
        table, held, n = np.zeros(COUNTERS, np.int64), [], 0
        for batch in batches:
            for t in batch.column(0):
                s = shingle_set(t.as_py(), size)
                held.append((s & U(COUNTERS - 1)).astype(np.int64))
                n += len(s)
                if n > 1 << 21:
                    table += np.bincount(np.concatenate(held), minlength=COUNTERS)
                    held, n = [], 0
        if held:
            table += np.bincount(np.concatenate(held), minlength=COUNTERS)
        for k in range(SLICES):
            part = zlib.compress(table[k * width : (k + 1) * width].astype("<u4").tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part], pa.binary())], names=["slice", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(zlib.decompress(part), "<u4")
                sums[k] = sums[k] + counts if k in sums else counts.astype(np.int64)
        for k, found in sums.items():
            level = np.ceil(2 * np.log2(np.maximum(found / (mean + 3 * np.sqrt(mean) + 1), 1))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(level.tobytes(), 1)], pa.binary())], names=["slice", "part"])

    schema = "slice int, part binary"
    counted = docs.select(F.col("text").cast("string")).mapInArrow(count, schema).repartition(SLICES, "slice").mapInArrow(add, schema)
    parts = {row["slice"]: bytes(row["part"]) for row in counted.collect()}  # SLICES rows
    return [parts[k] if k in parts else zlib.compress(bytes(width), 1) for k in range(SLICES)]


def entries(docs: DataFrame, levels: list[bytes], size: int, percent: int) -> DataFrame:
    """(token, name, n, place): the prefix of each set, once for each task that meets the set.

    Half of the name does here: two classes that shared it would only meet others in each other's lists too.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, met = np.frombuffer(b"".join(map(zlib.decompress, shipped.value)), np.uint8), set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                tokens, names, sizes, places = [], [], [], []
                for t in batch.column(0)[at : at + 256].to_pylist():
                    s = shingle_set(t, size)
                    (name, more), n = set_name(s), len(s)
                    if not n or (name, more) in met:
                        continue
                    met.add((name, more))
                    k = prefix_length(n, percent)
                    rare = np.argsort(level[(s & U(COUNTERS - 1)).astype(np.int64)], kind="stable")[:k]
                    tokens.append(s[rare].view(np.int64))
                    names.append(np.full(k, name))
                    sizes.append(np.full(k, n))
                    places.append(np.arange(k))
                if tokens:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in ((tokens, pa.int64()), (names, pa.int64()), (sizes, pa.int32()), (places, pa.int32()))], names=["token", "name", "n", "place"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "token long, name long, n int, place int")


def lists(found: DataFrame) -> DataFrame:
    """(token, name, n, place, held): entries of tokens that at least two classes hold, each once, with the list's length.

    Lists are found by partial minima and maxima and counted by partial sums, so that a token which a third of all
    classes hold is in no one task; entries then join what is known of their token, and a skewed join can be split.
    """
    shared = found.groupBy("token").agg(F.min("name").alias("low"), F.max("name").alias("high")).where("low < high").select("token")
    kept = materialize(found.join(shared, "token", "left_semi").distinct(), "shared")
    return kept.join(kept.groupBy("token").agg(F.count("*").alias("held")), "token")


def parted(rows: DataFrame, keys: list[str], tile: int = TILE) -> DataFrame:
    """rows with `part`, which deals the rows (rep, ...) of equal keys by hash into parts of about `tile` rows."""
    parts = rows.groupBy(*keys).agg(F.ceil(F.count("*") / tile).alias("parts"))
    return rows.join(parts, keys).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts"))).drop("parts")


def leaders(found: DataFrame, percent: int) -> DataFrame:
    """(name, leader): the class that heads most of a class's list blocks; classes that head their own have none.

    A block is headed by its most common member: the one whose prefix lies in the longest lists. Edited copies
    have shingles of their own, so this is what the others were copied from. Long sets show an eighth of their
    lists, the same for all sets; leaders only decide which pairs are verified first.
    """
    block = F.floor(F.log("n") / F.lit(float(np.log(100 / percent))))
    common = found.groupBy("name").agg((F.sum("held") / (F.max("n") - F.ceil(F.max("n") * percent / 100) + 1)).alias("common"))
    shown = found.where((F.col("n") <= 100) | (F.pmod(F.col("token"), F.lit(8)) == 0)).select("token", "name", block.alias("block"))
    shown = shown.join(common, "name")
    heads = shown.groupBy("token", "block").agg(F.max_by("name", F.struct("common", "name")).alias("leader"))
    counted = shown.join(heads, ["token", "block"]).where("name <> leader").groupBy("name", "leader").agg(F.count("*").alias("c"))
    return counted.groupBy("name").agg(F.max_by("leader", F.struct("c", "leader")).alias("leader"))


# ---------------------------------------------------------------- verification


def verify(pairs: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(x, y, both, nx, ny) for pairs (x, y, g) of representatives' doc_ids: sizes of both sets and of their intersection.

    Pairs of one g are verified together, so a text moves once for each g that needs it, not for each pair. A g holds
    at most two tiles of sets.
    """
    asked = pairs.groupBy("g", F.col("x").alias("doc_id")).agg(F.collect_list("y").alias("ys"))
    sides = asked.union(pairs.select("g", F.col("y").alias("doc_id"), F.array().cast("array<long>").alias("ys")).distinct())
    sides = materialize(sides.groupBy("g", "doc_id").agg(F.flatten(F.collect_list("ys")).alias("ys")), "sides")
    wanted = sides.select("doc_id").distinct()
    pick = F.broadcast(wanted) if fits_broadcast(wanted, BROADCAST_IDS) else wanted
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(pick, "doc_id", "left_semi")
    placed = sides.join(texts, "doc_id").select("g", "doc_id", "ys", "text").repartition(shuffle_partitions(docs.sparkSession), "g").sortWithinPartitions("g")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, asks = None, {}, []

        def answer() -> Iterator[pa.RecordBatch]:
            out = []
            for x, ys in asks:
                for y in ys:
                    if y in held:
                        out.append((x, y, len(np.intersect1d(held[x], held[y], assume_unique=True)), len(held[x]), len(held[y])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["x", "y", "both", "nx", "ny"])

        for batch in batches:
            for g, doc, ys, text in zip(*(batch.column(k) for k in range(4)), strict=True):
                if (g := g.as_py()) != group:
                    yield from answer()
                    group, held, asks = g, {}, []
                doc = doc.as_py()
                if doc not in held:
                    held[doc] = shingle_set(text.as_py(), size)
                    if ys := ys.as_py():
                        asks.append((doc, ys))
        yield from answer()

    return placed.mapInArrow(run, "x long, y long, both long, nx long, ny long")


def linked(percent: int) -> str:
    return f"100 * both >= {percent} * (nx + ny - both)"


def size_block(percent: int) -> Column:
    """Sizes of linked sets lie in the same or adjacent blocks; the small term keeps a power of the ratio out of the block below."""
    return F.floor(F.log("n") / F.lit(float(np.log(100 / percent))) + 1e-9)


def block_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(tile, tile2): index blocks that share a list and may hold a link between different groups; tile <= tile2.

    rows: (token, tile, leader, n, place, component, d) of open lists. Bounds are those of a block's classes within
    the list. For blocks of one class they are exact.
    """
    of = ["leader", "n_low", "n_high", "place", "low", "high", "d_low", "d_high"]
    entry = rows.groupBy("token", "tile").agg(
        F.min("leader").alias("leader"), F.min("n").alias("n_low"), F.max("n").alias("n_high"), F.min("place").alias("place"),
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("d").alias("d_low"), F.max("d").alias("d_high"),
    )
    entry = materialize(entry, "open")
    b = entry.select("token", F.col("tile").alias("tile2"), *[F.col(c).alias(f"{c}2") for c in of])
    # need: least intersection. A pair that links shares more than `slack` shingles among the first n - need + 1 + slack of each:
    # below the end of the shorter of these prefixes what is not shared is missing. slack is what the stored prefixes allow.
    needed = lambda n, m: F.ceil(percent * (F.col(n) + F.col(m)) / (100 + percent))
    beyond = lambda n, m: needed(n, m) - F.ceil(percent * F.col(n) / 100)
    share = lambda n, m: F.floor(F.least(n, m) / SLACK_SHARE)
    most = F.least(share("n_high", "n_high2"), beyond("n_low", "n_high2") + 1, beyond("n_low2", "n_high") + 1)
    one = (F.col("n_low") == F.col("n_high")) & (F.col("n_low2") == F.col("n_high2"))
    least = F.least(share("n_low", "n_low2"), beyond("n_high", "n_low2"), beyond("n_high2", "n_low")) - F.when(one, 0).otherwise(1)
    room = F.least(F.col("n_high") - F.col("place"), F.col("n_high2") - F.col("place2"))
    meet = (F.col("tile") <= F.col("tile2")) & (F.least("low", "low2") < F.greatest("high", "high2")) & (room >= needed("n_low", "n_low2") - most)
    meet = meet & (100 * F.col("n_high") >= percent * F.col("n_low2")) & (100 * F.col("n_high2") >= percent * F.col("n_low"))
    apart = F.greatest(F.col("d_low") - F.col("d_high2"), F.col("d_low2") - F.col("d_high")) > 1 - percent / 100 + 1e-9
    met = entry.join(b, "token").where(meet & ~((F.col("leader") == F.col("leader2")) & apart))
    return met.groupBy("tile", "tile2").agg(F.count("*").alias("shared"), F.min(least).alias("slack")).where("shared > slack").select("tile", "tile2")


def grouped(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, own, n, name, more) of each row of told_apart, and (name, more, rep, n, members, component) of each class; members are distinct doc_ids."""
    every = materialize(sets(docs, size), "sets")
    classes = materialize(every.where("n > 0 and doc_id is not null").groupBy("name", "more").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count_distinct("doc_id").alias("members")), "classes")
    named = docs.where("doc_id is not null")
    total = every.where("doc_id is not null").agg(F.sum("n")).first()[0] or 0
    prefixes = materialize(entries(named, frequency_levels(named, size, total), size, percent), "entries")
    found = materialize(lists(prefixes), "lists")
    release(prefixes)

    rep = classes.select("name", "rep")
    best = leaders(found, percent)
    ask = best.join(rep, "name").join(rep.select(F.col("name").alias("leader"), F.col("rep").alias("y")), "leader").select("rep", "y").where("rep <> y").distinct()
    ask = materialize(parted(ask, ["y"]).select(F.col("rep").alias("x"), "y", F.xxhash64("y", "part").alias("g")), "ask")
    answers = materialize(verify(ask, named, size).distinct(), "answers")
    first = answers.where(linked(percent)).select(F.col("x").alias("a"), F.col("y").alias("b"))
    nodes = classes.select(F.col("rep").alias("id"))
    groups = materialize(components(nodes, first), "groups")

    # what each class knows: its group, its distance from its leader, whether it is in the leader's group; blocks are made of that
    distance = 1 - F.col("both") / (F.col("nx") + F.col("ny") - F.col("both"))
    nearest = answers.select(F.col("x").alias("rep"), F.col("y").alias("leader"), distance.alias("d")).groupBy("rep").agg(F.min(F.struct("d", "leader")).alias("nearest"))
    known = classes.select("name", "rep", "n").join(groups, F.col("rep") == F.col("id")).drop("id").join(nearest, "rep", "left")
    known = known.select("name", "rep", "component", F.coalesce("nearest.leader", "rep").alias("leader"), F.coalesce("nearest.d", F.lit(0.0)).alias("d"), size_block(percent).alias("block"), F.floor(F.coalesce("nearest.d", F.lit(0.0)) * BANDS).alias("band"))
    known = known.join(groups.select(F.col("id").alias("leader"), F.col("component").alias("of_leader")), "leader").withColumn("own", F.col("component") == F.col("of_leader"))
    keys = ["leader", "own", "band", "block"]
    known = materialize(parted(known, keys).withColumn("tile", F.xxhash64(*keys, "part")).select("name", "rep", "component", "leader", "d", "tile"), "known")
    rows = found.select("token", "name", "n", "place").join(known, "name").drop("name")
    mixed = rows.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("token")
    pairs = materialize(block_pairs(rows.join(mixed, "token"), percent), "pairs")
    alone = F.col("tile") == F.col("tile2")
    both = pairs.select(F.xxhash64("tile", "tile2").alias("g"), alone.alias("alone"), F.explode(F.when(alone, F.array(F.struct(F.lit(True).alias("is_low"), F.col("tile")))).otherwise(F.array(F.struct(F.lit(True).alias("is_low"), F.col("tile")), F.struct(F.lit(False).alias("is_low"), F.col("tile2").alias("tile"))))).alias("side"))
    sides = both.select("g", "alone", "side.is_low", "side.tile").join(known.select("tile", "rep"), "tile").select("g", "rep", F.lit(1).cast("long").alias("members"), "is_low", "alone")

    def edges(reps: np.ndarray, members: np.ndarray, link: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        i, j = np.nonzero(link)
        least = spanning(i, j, len(reps))
        some = np.flatnonzero(least != np.arange(len(reps)))
        return reps[some], reps[least[some]]

    more = verify_tiles(sides, named, size, percent, edges, ("a", "b"))
    whole = components(nodes, first.union(more)).select(F.col("id").alias("rep"), "component")
    return every, classes.join(whole, "rep").select("name", "more", "rep", "n", "members", "component")


def of_class(every: DataFrame, classes: DataFrame) -> DataFrame:
    """every with the columns of the class of each row that has one."""
    return every.join(classes, (every["name"] == classes["name"]) & (every["more"] == classes["more"]) & (every["n"] > 0) & every["doc_id"].isNotNull(), "left")


def jaccard_groups(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs.

    Documents link when the Jaccard similarity of their shingle sets is at least percent / 100; component_id is the
    smallest doc_id reachable by links. Null, empty and wordless texts have no shingles and link with nothing.
    Equal sets link whatever their texts. A row with null doc_id has its n_shingles, links with nothing and has a
    null component_id. Equal rows are copies of one document; rows of one doc_id with different texts are documents of
    their own. Empty tables give no rows.
    """
    texts, split = told_apart(docs)
    every, classes = grouped(texts, size, percent)
    out = of_class(every, classes.select("name", "more", "component"))
    return with_own_ids(out.select(every["doc_id"], every["own"], every["n"].alias("n_shingles"), F.coalesce("component", every["doc_id"]).alias("component_id")), split)


def overlaps(sets: list[np.ndarray], first: int) -> np.ndarray:
    """Intersections of the first sets with all sets, as a matrix; sets are sorted, and are counted by ranges of hashes."""
    both = np.zeros((first, len(sets)), np.int64)
    total = sum(map(len, sets))
    steps = max(1, -(-total // LINK_CHUNK))
    bounds = [U((k << 64) // steps) for k in range(1, steps)]
    cuts = [[0, *np.searchsorted(s, bounds).tolist(), len(s)] for s in sets]
    for k in range(steps):
        parts = [s[c[k] : c[k + 1]] for s, c in zip(sets, cuts, strict=True)]
        _, token, held = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), [len(p) for p in parts])
        shared = held[token] > 1
        _, token = np.unique(token[shared], return_inverse=True)
        owner = owner[shared]
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        n = int(token[-1]) + 1 if len(token) else 0
        for at in range(0, n, 4096):
            low, high = np.searchsorted(token, [at, at + 4096])
            has = np.zeros((len(sets), min(4096, n - at)), np.float32)
            has[owner[low:high], token[low:high] - at] = 1
            both += (has[:first] @ has.T).astype(np.int64)
    return both


def verify_tiles(sides: DataFrame, docs: DataFrame, size: int, percent: int, answer: Callable, names: tuple[str, str]) -> DataFrame:
    """Two columns of longs that answer(reps, members, link, first) gives for each group g of classes.

    sides: (g, rep, members, is_low, alone), at most two tiles of classes for each g. link is a matrix of the low tile's
    classes, which come first, and all classes; a group that is alone is one tile, which meets itself.
    """
    sides = materialize(sides, "sides")
    wanted = sides.select("rep").distinct()
    pick = F.broadcast(wanted) if fits_broadcast(wanted, BROADCAST_IDS) else wanted
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text")).join(pick, "rep", "left_semi")
    placed = sides.join(texts, "rep").select("g", "rep", "members", "is_low", "alone", "text").repartition(shuffle_partitions(docs.sparkSession), "g").sortWithinPartitions("g")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, {}

        def found() -> Iterator[pa.RecordBatch]:
            rows = sorted(held.items(), key=lambda r: not r[1][1])
            first = sum(r[1][1] for r in rows)
            if len(rows) < 2 or not first:
                return
            n = np.array([len(r[1][3]) for r in rows])
            both = overlaps([r[1][3] for r in rows], first)
            link = 100 * both >= percent * (n[:first, None] + n[None, :] - both)
            if rows[0][1][2]:
                np.fill_diagonal(link, False)
            else:
                link[:, :first] = False
            one, two = answer(np.array([r[0] for r in rows], np.int64), np.array([r[1][0] for r in rows], np.int64), link, first)
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=list(names))

        for batch in batches:
            for g, rep, members, is_low, alone, text in zip(*(batch.column(k) for k in range(6)), strict=True):
                if (g := g.as_py()) != group:
                    yield from found()
                    group, held = g, {}
                if (rep := rep.as_py()) not in held:
                    held[rep] = members.as_py(), is_low.as_py(), alone.as_py(), shingle_set(text.as_py(), size)
        yield from found()

    return placed.mapInArrow(run, f"{names[0]} long, {names[1]} long")


def link_counts(classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(rep, links) of each class that has links to other classes: the number of documents in those.

    A group's classes are dealt into tiles, by size block if they are more than one tile; each pair of tiles whose
    blocks are the same or adjacent is verified whole. Sizes of linked sets are in the ratio percent / 100 at most,
    so they lie in the same or adjacent blocks.
    """
    counted = classes.groupBy("component").agg(F.count("*").alias("group_size")).where("group_size > 1")
    held = classes.join(counted, "component").select("component", "rep", "members", F.when(F.col("group_size") > LINK_TILE, size_block(percent)).otherwise(0).alias("block"))
    blocks = held.groupBy("component", "block").agg(F.ceil(F.count("*") / LINK_TILE).alias("tiles"))
    near = blocks.alias("b").join(blocks.alias("o"), (F.col("b.component") == F.col("o.component")) & (F.abs(F.col("b.block") - F.col("o.block")) <= 1))
    near = near.groupBy(F.col("b.component").alias("component"), F.col("b.block").alias("block")).agg(
        F.max("b.tiles").alias("tiles"), F.collect_list(F.struct(F.col("o.block").alias("block"), F.col("o.tiles").alias("tiles"))).alias("others")
    )
    dealt = held.join(near, ["component", "block"])
    mine = F.struct("block", F.pmod(F.xxhash64("rep"), F.col("tiles")).alias("part"))
    others = F.flatten(F.transform("others", lambda o: F.transform(F.sequence(F.lit(0).cast("long"), o["tiles"] - 1), lambda k: F.struct(o["block"].alias("block"), k.alias("part")))))
    dealt = dealt.select("component", "rep", "members", mine.alias("mine"), F.explode(others).alias("other"))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    sides = dealt.select(F.xxhash64("component", low, high).alias("g"), "rep", "members", (F.col("mine") == low).alias("is_low"), (low == high).alias("alone"))

    def sums(reps: np.ndarray, members: np.ndarray, link: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        found = link @ members
        found = np.concatenate((found, members[:first] @ link[:, first:]))
        some = np.flatnonzero(found)
        return reps[some], found[some]

    return verify_tiles(sides, docs, size, percent, sums, ("rep", "links")).groupBy("rep").agg(F.sum("links").alias("links"))


def jaccard_links(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for each row of docs: jaccard_groups and the number of links.

    n_links is the number of other documents (distinct ids and texts) that link with the row's; 0 for a null doc_id and
    for texts without shingles.
    """
    texts, split = told_apart(docs)
    every, classes = grouped(texts, size, percent)
    classes = materialize(classes, "grouped_classes")
    links = link_counts(classes, texts.where("doc_id is not null"), size, percent)
    of = classes.join(links, "rep", "left").select("name", "more", "component", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    out = of_class(every, of)
    found = out.select(every["doc_id"], every["own"], every["n"].alias("n_shingles"), F.coalesce("component", every["doc_id"]).alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))
    return with_own_ids(found, split)


def one_of_each_group(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs without documents that are not the first of their group; all columns kept, whatever their names; rows of null doc_id stay.

    The first has the smallest doc_id, and of several texts of that id the smallest key (common.row_keys); equal rows
    are one document.
    """
    columns = [f"c{k}" for k in range(len(docs.columns))]
    renamed = docs.toDF(*columns)
    ids, text = (F.col(columns[docs.columns.index(c)]).cast(kind) for c, kind in (("doc_id", "long"), ("text", "string")))
    named = renamed.withColumns({"own_id": ids, "own_hash": F.xxhash64(F.coalesce(text, F.lit("")))})
    texts, _ = told_apart(docs.select("doc_id", "text"))
    every, classes = grouped(texts, size, percent)
    found = of_class(every, classes.select("name", "more", "component")).select(every["doc_id"].alias("key"), every["own"], "component").where("component is not null")
    # rows of one set differ in text, maybe, and keys tell texts of one id apart
    found = materialize(found.distinct(), "grouped")
    first = found.groupBy("component").agg(F.min(F.struct("own", "key")).alias("first"))
    gone = found.join(first, "component").where(F.col("key") != F.col("first.key")).select("own", "key")
    gone = materialize(gone, "gone")
    pick = F.broadcast(gone) if fits_broadcast(gone, BROADCAST_IDS) else gone
    # a key is the id itself, or a hash of the id and the text
    kept = named.join(pick, (F.col("own_id") == F.col("own")) & F.col("key").isin(F.col("own_id"), F.xxhash64("own_id", "own_hash")), "left_anti")
    return kept.select(*columns).toDF(*docs.columns)
