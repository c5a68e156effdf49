"""Runs of periodic words by the runs theorem.

Every maximal repetition of period p holds, under one of two orders of the words, a root that is the longest Lyndon
word at its place. So for each order, the longest Lyndon word at a place ends before the next smaller value of the
inverse suffix array (under the opposite order: the next greater one); where such words of equal length follow each
other, they are extended to both sides by longest common extensions: least values of the LCP arrays of the text and of
the reversed text, by sparse tables.

Documents are dealt as they lie; nothing is shuffled. Within a task, the words of many documents are sorted at once,
with symbols that no two documents share, so copies in other documents lengthen nothing. A document takes memory of
about 60 bytes a word, and where it is periodic another 8 * log2(words) bytes a word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import begin

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Words that are sorted at once; a longer document is sorted alone.
CHUNK = 1 << 17

RUNS = "array<struct<start:long,length:long,period:long>>"


# ---------------------------------------------------------------- suffixes


def suffix_ranks(symbols: np.ndarray) -> np.ndarray:
    """The inverse suffix array, by prefix doubling of the places whose ranks are still shared.

    The last symbol must stand nowhere else, and no repeat may reach over it.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = starts(symbols[order])
    open_ = order[shared(rank[order])]
    k = 1
    while len(open_):
        old = rank[open_]
        key = old * (n + 1) + rank[np.minimum(open_ + k, n - 1)]
        by = np.argsort(key, kind="stable")
        open_, old = open_[by], old[by]
        # a group's places lie together: a subgroup's rank is the group's and the offset of its first place there
        new = starts(key[by]) - starts(old) + old
        rank[open_] = new
        open_ = open_[shared(new)]
        k *= 2
    return rank


def starts(values: np.ndarray) -> np.ndarray:
    """For each of sorted values, where its equals begin."""
    at = np.arange(len(values))
    return np.maximum.accumulate(np.where(np.diff(values, prepend=values[:1] - 1) != 0, at, 0)) if len(values) else at


def shared(sorted_ranks: np.ndarray) -> np.ndarray:
    """Whether another of the sorted ranks is the same."""
    same = np.diff(sorted_ranks) == 0
    return np.append(same, False) | np.insert(same, 0, False)


def next_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the next one with a smaller value, or the length. Places jump over what others have passed."""
    n = len(values)
    padded = np.append(values, -1)
    to = np.arange(1, n + 2)
    to[n] = n
    left = np.arange(n)
    while len(left):
        left = left[padded[to[left]] >= padded[left]]
        to[left] = to[to[left]]
    return to[:n]


def common_prefixes(symbols: list[int], rank: np.ndarray) -> np.ndarray:
    """lcp[r]: how many symbols the suffixes of ranks r and r + 1 have in common."""
    n = len(symbols)
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    follows, ranks = np.append(sa[1:], -1)[rank].tolist(), rank.tolist()
    lcp, h = np.zeros(n, np.int32), 0
    for i in range(n):
        j = follows[i]
        if j < 0:
            h = 0
            continue
        most = n - max(i, j)
        while h < most and symbols[i + h] == symbols[j + h]:
            h += 1
        lcp[ranks[i]] = h
        h = max(0, h - 1)
    return lcp


class Extensions:
    """Longest common extensions of pairs of places: range minima of the LCP array from a sparse table."""

    def __init__(self, symbols: np.ndarray):
        self.rank = suffix_ranks(symbols)
        self.levels = [common_prefixes(symbols.tolist(), self.rank)]
        while 2 << len(self.levels) - 1 <= len(symbols):
            last, half = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = np.minimum(self.rank[i], self.rank[j]), np.maximum(self.rank[i], self.rank[j])
        level = np.frexp((b - a).astype(float))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            at = level == k
            out[at] = np.minimum(self.levels[k][a[at]], self.levels[k][b[at] - (1 << k)])
        return out


# ---------------------------------------------------------------- runs


def roots(symbols: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of longest Lyndon words, under either order, that three times follow each other from there."""
    n = len(symbols)
    places, periods = [], []
    for values in (rank, n - 1 - rank):
        period = next_smaller(values) - np.arange(n)
        at = np.flatnonzero(np.arange(n) + 2 * period < n)
        p = period[at]
        kept = (period[at + p] == p) & (symbols[at] == symbols[at + p]) & (symbols[at] == symbols[at + 2 * p])
        places.append(at[kept])
        periods.append(p[kept])
    return np.concatenate(places), np.concatenate(periods)


def extended(symbols: np.ndarray, at: np.ndarray, p: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """Rows (start, length, period), sorted, of the runs that the roots of one document belong to.

    symbols ends with a symbol that stands nowhere else.
    """
    n = len(symbols)
    ahead = Extensions(symbols)
    back = Extensions(np.append(symbols[-2::-1], symbols[-1]))
    right = at + p + ahead.of(at, at + p)
    left = at.copy()
    inner = at > 0
    left[inner] -= back.of(n - 1 - at[inner], n - 1 - at[inner] - p[inner])
    length = right - left
    kept = (length >= min_length) & (length >= min_exponent * p)
    return np.unique(np.stack((left[kept], length[kept], p[kept]), axis=1), axis=0)


def runs_of(documents: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[np.ndarray]:
    """For each document's words its runs as sorted rows (start, length, period). min_exponent is at least 4."""
    if min_exponent < 4:
        raise ValueError("roots are told by three in a row: min_exponent is at least 4")
    names: dict[bytes, int] = {}
    sizes = np.fromiter(map(len, documents), np.int64, len(documents)) + 1
    first = np.cumsum(sizes) - sizes
    ids = np.zeros(int(sizes.sum()), np.int64)
    for words, at in zip(documents, first.tolist(), strict=True):
        ids[at : at + len(words)] = [names.setdefault(w, len(names) + 1) for w in words]
    doc = np.repeat(np.arange(len(documents)), sizes)
    symbols = doc * (len(names) + 1) + ids  # a document's end is its smallest symbol
    at, p = roots(symbols, suffix_ranks(symbols))
    where = np.argsort(doc[at], kind="stable")
    at, p = at[where], p[where]
    out = [np.zeros((0, 3), np.int64)] * len(documents)
    cut = np.searchsorted(doc[at], np.arange(len(documents) + 1))
    for k in np.flatnonzero(np.diff(cut)).tolist():
        part = slice(cut[k], cut[k + 1])
        out[k] = extended(symbols[first[k] : first[k] + sizes[k]], at[part] - first[k], p[part], min_length, min_exponent)
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


def periodic_runs(
    docs: DataFrame,
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """(doc_id, runs, text): each row's runs by start, then period, and its text without what repeats in them.

    Words are what stands between blanks; the text is the kept words joined by one blank. A run of period q has at
    least min_length and min_exponent * q words (min_exponent is 4 or more), and no neighbour extends it; overlapping
    runs of different periods are all told. rewrite(doc_id, words), if given, makes the words that are looked at.
    Null and empty texts have no runs and an empty text; repeated rows give repeated rows; a null doc_id stays null;
    an empty table gives none; other columns of docs are not looked at.
    """

    def told(ids: list[int | None], documents: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of(documents, min_length, min_exponent)
        rows = np.concatenate(found)
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in found]))).astype(np.int32)
        items = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], names=["start", "length", "period"])
        texts = [b" ".join(collapsed(w, r)) for w, r in zip(documents, found, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), items), pa.array(texts, pa.binary())], names=["doc_id", "runs", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("periodic")
        for batch in batches:
            ids: list[int | None] = []
            documents: list[list[bytes]] = []
            held = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                buffer = text.as_buffer() if text.is_valid else None
                words = buffer.to_pybytes().split() if buffer is not None else []
                words = rewrite(doc_id, words) if rewrite else words
                if documents and held + len(words) > CHUNK:
                    yield told(ids, documents)
                    ids, documents, held = [], [], 0
                ids.append(doc_id)
                documents.append(words)
                held += len(words) + 1
            if documents:
                yield told(ids, documents)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    out = rows.mapInArrow(run, f"doc_id long, runs {RUNS}, text binary")
    return out.select("doc_id", "runs", F.col("text").cast("string").alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """One row of numbers for each row of periodic_runs: the longest run (then the first, then the shortest period), and hashes."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("(1000 * longest.length) div (-longest.period)").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )
