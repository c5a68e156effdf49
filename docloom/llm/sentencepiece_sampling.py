"""SentencePiece encoding and decoding with sampled segmentations: Gumbel top-k without replacement.

A text's segmentations form a lattice over its characters. Pieces get Zipf probabilities by their rank in the
model's merge order, and backward sums over the lattice turn these into conditional probabilities, so the mass
of all completions of a partial segmentation is known exactly. The search is A* on perturbed mass: the queue
holds sets of segmentations - a prefix and the siblings left out at its last step - with the Gumbel maximum of
each set, conditioned on being below the value of the segmentation it branched off from. Popping the best set
and walking down from it emits the segmentation with the next largest perturbed probability: k pops give k
distinct segmentations, distributed as sampling without replacement, and the best set left gives the
threshold for the inclusion scores.

No piece crosses from a word into the next, so the lattice is a chain of lattices of words and marks. These are built
once and kept in a bounded cache; Arrow tells the words of a batch apart, and all of them walk down together. Random
numbers are hashes of the row key and the place in the row, so they don't depend on batches or tasks.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm.common import worker_cache

SAMPLES = 2
#: Added to ranks in the law of piece probabilities; edges that a worker's lattice cache may hold.
SHIFT, CACHE_EDGES = 10.0, 12_000_000
#: Power that flattens the pieces' probabilities, as in subword regularisation.
ALPHA = 0.3
SPACE = "▁"
CUT = "\x1f"
WORDS = re.compile(" +[^ ]*")
#: Sets of segmentations that are looked at first; noise raises a set's value by less than NOISE over the log of its mass.
NEAR, NOISE = 96, 37.0
#: Last bits of a hash that beginnings of pieces are found by.
SLOTS = 1 << 16
NO_KEY = -(2**63)

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def uniform(keys: np.ndarray, step: int | np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit keys and a counter."""
    h = mix(keys + np.asarray(step).astype(np.uint64) * U(0x9E3779B97F4A7C15))
    return ((h >> U(11)).astype(float) + 0.5) * 2.0**-53


class Vocabulary:
    """Pieces of a model file with Zipf log-probabilities and the bytes each decodes to."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = self.size = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        ranked = sorted(plain, key=lambda i: (-sp.get_score(i), i))
        weight = {i: 1 / (r + SHIFT) for r, i in enumerate(ranked)}
        total = sum(weight.values())
        self.log_prob = np.full(n, -np.inf)
        for i, w in weight.items():
            self.log_prob[i] = ALPHA * np.log(w / total)
        self.rare = float(self.log_prob[plain].min())
        self.bytes = [b""] * n
        self.byte_id = [0] * 256
        self.known: dict[str, int] = {}
        self.longest = 1
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif i in weight:
                self.bytes[i] = piece.replace(SPACE, " ").encode()
                self.longest = max(self.longest, len(piece))
                for k in range(1, len(piece)):
                    self.known.setdefault(piece[:k], -1)
                self.known[piece] = i
        # for each length, the hashes of all beginnings of pieces and the piece that ends there, or -1
        by_length: list[list[str]] = [[] for _ in range(self.longest + 1)]
        for beginning in self.known:
            by_length[len(beginning)].append(beginning)
        self.beginnings = []
        for length, found in enumerate(by_length):
            points = np.frombuffer("".join(found).encode("utf-32-le"), "<u4").reshape(len(found), length).astype(np.uint64)
            keys = np.zeros(len(found), np.uint64)
            for column in points.T:
                keys = mix(keys ^ (column + U(1)))
            slot = (keys & U(SLOTS - 1)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            starts = np.searchsorted(slot[order], np.arange(SLOTS + 1))
            first = np.where(np.diff(starts) > 0, starts[:-1], -1).astype(np.int32)  # keys of one slot follow each other from there on
            self.beginnings.append((keys[order], np.array([self.known[x] for x in found], np.int64)[order], first, int(np.diff(starts).max())))
        self.spelling = pa.array(self.bytes, pa.large_binary())
        self.crossing = any(SPACE in sp.id_to_piece(i).lstrip(SPACE) for i in plain)
        if self.crossing:
            raise ValueError("a piece of this model crosses a word boundary")
        # where no piece crosses, a word's lattice may be cut further: before line feeds, and before a mark that ends a word
        names = [sp.id_to_piece(i) for i in plain]
        self.lines = not any("\n" in name[1:] for name in names)
        marks = "".join(c for c in ".,;:!?" if not any(c == b and a.isalnum() for name in names for a, b in zip(name, name[1:], strict=False)))
        self.mark = re.compile(rf"[{re.escape(marks)}](?<=[^\W_].)(?=[ \n]|\Z)") if marks else None

    def expand(self, codes: np.ndarray) -> np.ndarray:
        """Ids from codes: a code of size + c is a character without a piece, as its UTF-8 bytes."""
        if not len(codes) or codes.max() < self.size:
            return codes
        out: list[int] = []
        for c in codes.tolist():
            if c < self.size:
                out.append(c)
            else:
                out += [self.byte_id[b] for b in chr(c - self.size).encode("utf-8", "surrogatepass")]
        return np.array(out, np.int64)

    def spelled(self, ids: np.ndarray) -> bytes:
        """The bytes that ids decode to."""
        return self.all_spelled([ids])[0]

    def all_spelled(self, samples: list[np.ndarray]) -> list[bytes]:
        """The bytes that each sample's ids decode to, all gathered at once."""
        if not samples:
            return []
        found = self.spelling.take(pa.array(np.concatenate(samples), pa.int64()))
        _, ends, data = found.buffers()
        cuts = np.frombuffer(ends, np.int64)[np.cumsum([0, *map(len, samples)])]
        return [data[lo:hi].to_pybytes() for lo, hi in itertools.pairwise(cuts.tolist())]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces' characters and byte pieces together, without the space put before the text."""
        return self.plain(b"".join(map(self.bytes.__getitem__, ids)))

    @staticmethod
    def plain(whole: bytes) -> str:
        return (whole[1:] if whole[:1] == b" " else whole).decode("utf-8", "replace")


def cut(text: str, vocabulary: Vocabulary) -> str:
    """A text that is not empty with one space in front, and CUT between its words; it holds no CUT of its own."""
    marked = " " + text.replace(SPACE, " ")
    if "  " in marked:
        return CUT.join(WORDS.findall(marked))
    if vocabulary.mark:
        marked = vocabulary.mark.sub(CUT + r"\g<0>", marked)
    if vocabulary.lines:
        marked = marked.replace("\n", CUT + "\n")
    return marked.replace(" ", CUT + " ")[1:]


def words(text: str, vocabulary: Vocabulary) -> list[str]:
    """Words with the spaces before them, cut where no piece crosses; the text gets one space in front, an empty text none."""
    if not text:
        return []
    return WORDS.findall(" " + text.replace(SPACE, " ")) if CUT in text else cut(text, vocabulary).split(CUT)


def units(text: str, vocabulary: Vocabulary) -> list[str]:
    """The words of a text, with spaces written as pieces do."""
    return [w.replace(" ", SPACE) for w in words(text, vocabulary)]


def told_apart(texts: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of words of each text, number of each word among the distinct ones, distinct words)."""
    if any(CUT in t for t in texts):
        split = pa.array([words(t, vocabulary) for t in texts], pa.list_(pa.large_string()))
    else:
        split = pc.split_pattern(pa.array([cut(t, vocabulary) if t else None for t in texts], pa.large_string()), CUT)
    found = split.flatten().dictionary_encode()
    sizes = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return sizes, found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary.to_numpy(zero_copy_only=False)


class Lattices:
    """Word lattices as rows of edges: a node's edges hold cumulative conditional probability in (0, 1], the likeliest first.

    A word of n characters has n + 1 nodes; the last is terminal and has no edges. An edge names the first edge of the node
    that it goes to, or -1 for a terminal one.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        # whole from the start: memory that is not written to yet takes no room, and growing would copy
        edges, nodes = max(CACHE_EDGES * 9 // 8, 1 << 16), max(CACHE_EDGES // 2, 1 << 16)
        self.cum, self.logs = np.zeros(edges, np.float32), np.zeros(edges, np.float32)
        self.codes, self.next = np.zeros(edges, np.int32), np.zeros(edges, np.int32)
        self.first = np.zeros(nodes, np.int32)
        self.clear()

    def clear(self) -> None:
        self.root: dict[str, int] = {}
        self.nodes = self.edges = 0

    def room(self, edges: int, nodes: int) -> None:
        def grown(x: np.ndarray, n: int) -> np.ndarray:
            if n <= len(x):
                return x
            out = np.zeros(max(n, len(x) * 3 // 2), x.dtype)
            out[: len(x)] = x
            return out

        self.cum, self.logs, self.codes, self.next = (grown(x, edges) for x in (self.cum, self.logs, self.codes, self.next))
        self.first = grown(self.first, nodes + 1)

    def add(self, words: list[str]) -> np.ndarray:
        """Put new words in, all at once: edges by length of piece, then backward sums by distance from a word's end.

        Gives each word's first edge.
        """
        v = self.v
        size = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        points[points == ord(" ")] = ord(SPACE)
        which = np.repeat(np.arange(len(words)), size)
        end = np.cumsum(size)[which]
        place = np.arange(len(points))
        node = place + which  # counted from this call's first node
        alive, h = place, np.zeros(len(points), np.uint64)
        grid = np.full((len(points), v.longest), -1, np.int32)  # pieces by where they begin and their length
        left_of, shifted = end - place, (points + 1).astype(np.uint64)
        for n in range(1, v.longest + 1):
            inside = left_of[alive] >= n
            alive, h = alive[inside], h[inside]
            if not len(alive):
                break
            h = mix(h ^ shifted[alive + n - 1])
            keys, pieces, first, most = v.beginnings[n]
            at = first[(h & U(SLOTS - 1)).astype(np.int64)]
            there = at >= 0
            alive, h, at = alive[there], h[there], at[there]
            met = keys[at] == h
            for _ in range(most - 1):
                rest = np.flatnonzero(~met)
                at[rest] = np.minimum(at[rest] + 1, len(keys) - 1)
                met[rest] = keys[at[rest]] == h[rest]
            alive, h, piece = alive[met], h[met], pieces[at[met]]
            hit = piece >= 0
            grid[alive[hit], n - 1] = piece[hit]
        bare = np.flatnonzero(grid[:, 0] < 0)  # characters without a piece: their bytes
        c = points[bare]
        grid[bare, 0] = np.where(c < 128, np.array(v.byte_id)[np.minimum(c, 127)], v.size + c)
        grid = grid.ravel()
        edge = np.flatnonzero(grid >= 0)  # by place, then by length
        begin, length = np.divmod(edge, v.longest)
        length += 1
        code = grid[edge]
        del grid
        heads = np.flatnonzero(length == 1)  # each place has an edge of one character
        each = np.diff(heads, append=len(edge))
        weight = v.log_prob[np.minimum(code, v.size - 1)]
        weight[heads[bare]] = v.rare * (1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000))
        # backward sums of log mass, for all words together, from their ends on
        mass = np.zeros(len(points) + len(words))
        longest = int(size.max())
        by_left = np.argsort(left_of.astype(np.uint16) if longest < 1 << 16 else left_of, kind="stable")
        steps = np.searchsorted(left_of[by_left], np.arange(1, longest + 2))
        counts = each[by_left]
        group = np.concatenate(([0], np.cumsum(counts)))
        order = np.arange(len(edge)) + np.repeat(heads[by_left] - group[:-1], counts)
        froms = node[begin]
        tos = froms + length
        w, t, by_left = weight[order], tos[order], node[by_left]
        for lo, hi in itertools.pairwise(steps.tolist()):
            x = w[group[lo] : group[hi]] + mass[t[group[lo] : group[hi]]]
            at = group[lo:hi] - group[lo]
            top = np.maximum.reduceat(x, at)
            mass[by_left[lo:hi]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, counts[lo:hi])), at))
        logs = weight + mass[tos] - mass[froms]
        part = np.exp(logs)
        order = np.argsort(begin + 0.999 * (1 - np.minimum(part, 1)), kind="stable")  # the likeliest of a place first
        code, logs, part, tos, length = code[order], logs[order], part[order], tos[order], length[order]
        share = np.cumsum(part)
        share -= np.repeat(share[heads] - part[heads], each)
        share[heads + each - 1] = 1.0
        e, k, m = self.edges, self.nodes, len(edge)
        total = len(points) + len(words)
        self.room(e + m, k + total)
        self.cum[e : e + m] = np.minimum(share, 1.0)
        self.logs[e : e + m] = np.where(np.repeat(each, each) == 1, 0.0, np.minimum(logs, 0))
        self.codes[e : e + m] = code
        counts = np.zeros(total, np.int64)
        counts[node] = each
        self.first[k] = e
        self.first[k + 1 : k + total + 1] = e + np.cumsum(counts)
        self.next[e : e + m] = np.where(left_of[begin] == length, -1, self.first[k + tos])
        roots = self.first[k + np.concatenate(([0], np.cumsum(size + 1)[:-1]))].astype(np.int64)
        self.root.update(zip(words, roots.tolist(), strict=True))
        self.nodes += total
        self.edges += m
        return roots

    def arrays(self) -> tuple[np.ndarray, ...]:
        """(cum, log share, next node's first edge, first edge of each node)."""
        m = self.edges
        return self.cum[:m], self.logs[:m], self.next[:m], self.first[: self.nodes + 1]

    def starts(self, words: np.ndarray) -> np.ndarray:
        """The first edges of distinct words; new ones are put in."""
        found = np.fromiter(map(self.root.get, words, itertools.repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(found < 0)
        if len(new) and self.edges > CACHE_EDGES:
            self.clear()
            new = np.arange(len(words))
        if len(new):
            found[new] = self.add(words[new].tolist())
        return found


def pick(cum: np.ndarray, edges: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """The edges that the draws fall on, from each node's first edge on; nodes have few edges, and the likeliest come first."""
    open_ = np.flatnonzero(cum[edges] < draw)
    while len(open_):
        edges[open_] += 1
        open_ = open_[cum[edges[open_]] < draw[open_]]
    return edges


def walk(tables: tuple[np.ndarray, ...], start: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of one sampled segmentation of each word, in order, and where each word's begin; start has their first edges."""
    cum, _, following, _ = tables
    here, word, found = start, np.arange(len(start)), []
    sizes = np.zeros(len(start), np.int64)
    while len(word):
        e = pick(cum, here.astype(np.int64), uniform(keys, len(found)))
        found.append((word, e))
        sizes[word] += 1
        here = following[e]
        go = np.flatnonzero(here >= 0)
        here, word, keys = here[go], word[go], keys[go]
    begins = np.concatenate(([0], np.cumsum(sizes)))
    edges = np.zeros(begins[-1], np.int64)
    for step, (word, e) in enumerate(found):
        edges[begins[word] + step] = e
    return edges, begins


class Path:
    """One emitted segmentation: edges, the word of each, its value, sums of logs up to each edge, and the sets that branch off from it."""

    def __init__(self, tables: tuple[np.ndarray, ...], edges: np.ndarray, owner: np.ndarray, value: float, since: int, key: np.ndarray, most: int, parent: Path | None = None):
        # up to since - 1, the edges are the parent's
        self.edges, self.owner, self.value = edges, owner, value
        same = max(since - 1, 0)
        logs = tables[1][edges[same:]].astype(float)
        total = self.total = np.concatenate(([0.0], np.cumsum(logs))) if parent is None else np.concatenate((parent.total[:same], np.cumsum(np.concatenate((parent.total[same : same + 1], logs)))))
        self.before, self.log_prob = total[:-1], float(total[-1])
        logs, before = logs[since - same :], self.before[since:]

        def values(lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
            at = lo + np.flatnonzero(logs[lo:hi] < 0)  # an edge without siblings leaves nothing out
            mass = before[at] + np.log(-np.expm1(logs[at]))
            noise = -np.log(uniform(key, at))
            return at, mass - np.log(np.exp(np.minimum(mass - value, 700)) + noise)

        # sums of logs only fall, and no noise makes up for more than NOISE: what lies behind that cannot be among the best
        hi = min(NEAR, len(logs))
        at, found = values(0, hi)
        if hi < len(logs):
            least = np.partition(found, -most)[-most] if len(found) >= most else -np.inf
            end = int(np.searchsorted(-before, NOISE - least, side="right"))
            if end > hi:
                more, further = values(hi, end)
                at, found = np.concatenate((at, more)), np.concatenate((found, further))
        best = np.argpartition(-found, most)[:most] if len(found) > most else np.arange(len(found))
        best = best[np.lexsort((best, -found[best]))]
        self.open = [(float(found[b]), since + int(at[b]), ()) for b in best if np.isfinite(found[b])]


def best_open(paths: list[Path]) -> tuple[float, int]:
    """The largest value of a set left, and the path that it branches off from; -1 if none is left."""
    value, _, at = max(((p.open[0][0], -n, n) for n, p in enumerate(paths) if p.open), default=(-np.inf, 0, -1))
    return value, at


class Branch:
    """The best set of a text's queue, popped: a prefix of its parent, another edge in its last word, and what is left out."""

    def __init__(self, tables: tuple[np.ndarray, ...], paths: list[Path], at: int, value: float, rnd: np.ndarray, draws: np.ndarray):
        # draws are the first numbers of rnd
        cum, logs, following, first = tables
        self.value = value
        self.parent = parent = paths[at]
        _, self.place, out = parent.open.pop(0)
        place = self.place
        edge = int(parent.edges[place])
        taken = out or (edge,)
        self.word = int(parent.owner[place])
        node = int(np.searchsorted(first, first.dtype.type(edge), side="right")) - 1  # of the same type, or the whole table would be converted
        rest = [e for e in range(int(first[node]), int(first[node + 1])) if e not in taken]
        shares = np.exp(logs[rest])
        chosen = rest[min(int(np.searchsorted(np.cumsum(shares), draws[0] * shares.sum())), len(rest) - 1)]
        left = [e for e in rest if e != chosen]
        if left:  # the siblings still left out, below the value just emitted
            mass = float(parent.before[place] + np.log(np.exp(logs[left]).sum()))
            again = mass - np.log(np.exp(min(mass - value, 700)) - np.log(draws[1]))
            parent.open = sorted([*parent.open, (float(again), place, (*taken, chosen))], key=lambda x: -x[0])
        self.new, here = [chosen], int(following[chosen])
        while here >= 0:
            step = len(self.new) + 1
            x, e = draws[step] if step < len(draws) else uniform(rnd, step)[0], here
            while cum[e] < x:
                e += 1
            self.new.append(e)
            here = int(following[e])


class Sampler:
    """Samples of many texts at once."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.lattices = Lattices(self.vocabulary)

    def batch(self, texts: list[str], keys: list[int], k: int) -> list[tuple[list[Path], float]]:
        sizes, which, distinct = told_apart(texts, self.vocabulary)
        cuts = np.concatenate(([0], np.cumsum(sizes)))
        seeds = mix(np.array([x & (1 << 64) - 1 for x in keys], np.uint64) + U(0xA0761D6478BD642F))
        if not len(which):
            return [([], -np.inf) for _ in texts]
        start = self.lattices.starts(distinct)[which]
        tables = self.lattices.arrays()
        inside = np.arange(len(which), dtype=np.int64) - np.repeat(cuts[:-1], sizes)
        place = np.repeat(seeds, sizes) + inside.astype(np.uint64) * U(0xE7037ED1A0B428DB)
        edges, begins = walk(tables, start, mix(place + mix(np.array([1], np.uint64))))
        owner = np.repeat(inside, np.diff(begins))
        at = begins[cuts]
        draws = mix(seeds[:, None] + np.arange(1, k + 2, dtype=np.uint64) * U(0xC2B2AE3D27D4EB4F))
        tops = -np.log(-np.log(uniform(draws[:, 0], 0)))
        paths: list[list[Path]] = [[] for _ in texts]
        for d in np.flatnonzero(sizes).tolist():
            paths[d].append(Path(tables, edges[at[d] : at[d + 1]], owner[at[d] : at[d + 1]], float(tops[d]), 0, draws[d, 1:2], k))
        for r in range(1, k):
            # each text's best set branches off from a path; only the words behind the branch are walked again, all texts' together
            best = [(d, *best_open(p)) for d, p in enumerate(paths) if len(p) == r]
            best = [(d, value, n) for d, value, n in best if n >= 0]
            if not best:
                break
            texts_asked = [d for d, _, _ in best]
            rnd = mix(mix(seeds[texts_asked]) + U(r))
            numbers = uniform(rnd[:, None], np.arange(12))
            asked = [(d, Branch(tables, paths[d], n, value, rnd[i : i + 1], numbers[i])) for i, (d, value, n) in enumerate(best)]
            low = np.array([cuts[d] + branch.word + 1 for d, branch in asked], np.int64)
            size = cuts[1:][texts_asked] - low
            ends = np.cumsum(size)
            index = np.arange(ends[-1]) + np.repeat(low - ends + size, size)
            edges, begins = walk(tables, start[index], mix(place[index] + mix(np.array([r + 1], np.uint64))))
            owner = np.repeat(inside[index], np.diff(begins))
            at = begins[np.concatenate(([0], ends))]
            for n, (d, branch) in enumerate(asked):
                tail, whose = edges[at[n] : at[n + 1]], owner[at[n] : at[n + 1]]
                parent, cut_at = branch.parent, branch.place
                whole = np.concatenate((parent.edges[:cut_at], branch.new, tail)).astype(np.int64, copy=False)
                owners = np.concatenate((parent.owner[:cut_at], np.full(len(branch.new), branch.word), whose)).astype(np.int64, copy=False)
                paths[d].append(Path(tables, whole, owners, branch.value, cut_at + 1, draws[d, r + 1 : r + 2], k, parent))
        return [(p, best_open(p)[0] if p else -np.inf) for p in paths]

    def ids(self, path: Path) -> np.ndarray:
        return self.vocabulary.expand(self.lattices.codes[path.edges].astype(np.int64))

    def kept(self, samples: list[np.ndarray], text: str) -> list[bool]:
        """Whether each segmentation's ids decode to the text; each is decoded whole."""
        return self.all_kept([samples], [text])[0]

    def all_kept(self, samples: list[list[np.ndarray]], texts: list[str]) -> list[list[bool]]:
        """kept for many texts."""
        found = iter(self.vocabulary.all_spelled([ids for of_text in samples for ids in of_text]))
        wanted = (b" " + text.replace(SPACE, " ").encode("utf-8", "surrogatepass") for text in texts)
        return [[next(found) == want for _ in of_text] for of_text, want in zip(samples, wanted, strict=True)]


def sampler(path: str) -> Sampler:
    """One sampler for each Python worker and model file."""
    return worker_cache("sentencepiece", path, lambda: Sampler(path))


def inclusion(log_prob: float, threshold: float) -> float:
    """log of the chance to be among the samples given the threshold: 1 - exp(-exp(log_prob - threshold))."""
    if threshold == -np.inf:
        return 0.0
    x = log_prob - threshold
    return float(np.log(-np.expm1(-np.exp(x)))) if x > -30 else float(x)


ENCODED = "doc_id long, sample int, log_prob double, perturbed double, log_inclusion double, n_ids long, ids array<int>, text_kept boolean"


def encode_samples(docs: DataFrame, model: str, k: int = SAMPLES, with_ids: bool = True) -> DataFrame:
    """k distinct segmentations (fewer where the text has fewer) of each whole text, as ids.

    sample counts from 0 by falling perturbed log-probability; log_prob is the segmentation's log-probability given
    the text; log_inclusion is the log of its inclusion probability given the threshold, for importance weights.
    text_kept says whether the ids decode to the text (a literal U+2581 decodes to a space). Null and empty texts have
    one segmentation without ids, of probability 1. Rows with equal doc_id draw alike.
    """
    return _encoded(docs, model, k, with_ids).drop("ids_crc32")


def encoded_digest(docs: DataFrame, model: str, k: int = SAMPLES) -> DataFrame:
    """As encode_samples, with the CRC-32 of the little-endian unsigned 32-bit ids in place of the ids."""
    return _encoded(docs, model, k, False).drop("ids")


def _encoded(docs: DataFrame, model: str, k: int, with_ids: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sampler(model)
        kinds = (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.int32()), pa.bool_(), pa.int64())
        names = [c.split()[0] for c in ENCODED.split(", ")] + ["ids_crc32"]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                keys, texts = batch.column(0)[at : at + 256].to_pylist(), [t or "" for t in batch.column(1)[at : at + 256].to_pylist()]
                out: list[tuple] = []
                drawn = s.batch(texts, [NO_KEY if x is None else x for x in keys], k)
                samples = [[s.ids(p) for p in paths] for paths, _ in drawn]
                for key, (paths, threshold), of_text, kept in zip(keys, drawn, samples, s.all_kept(samples, texts), strict=True):
                    if not paths:
                        out.append((key, 0, 0.0, 0.0, 0.0, 0, [] if with_ids else None, True, 0))
                    for n, (p, ids, same) in enumerate(zip(paths, of_text, kept, strict=True)):
                        out.append((key, n, p.log_prob, p.value, inclusion(p.log_prob, threshold), len(ids), ids.astype(np.int32) if with_ids else None, same, zlib.crc32(ids.astype("<u4").tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ENCODED + ", ids_crc32 long")


def decode(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """rows with text_col decoded from ids_col (array<int>); null ids give null."""
    kept = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != text_col])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = sampler(model).vocabulary
        for batch in batches:
            texts = [None if x is None else v.decode(x) for x in batch.column(batch.schema.get_field_index(ids_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text_col])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(text_col, T.StringType())]))
