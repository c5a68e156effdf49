"""Personal data with offset-preserving deobfuscation.

Two passes over each whole text. The base pass finds plain e-mail addresses, IP addresses, card and
phone numbers. The second normalises disguises - look-alike letters, full-width and other digits,
spelled digits, at/dot words - by small transducers that keep, for each output character, the source
span it came from; it detects on the normalised text and maps spans back. Spans that the second pass adds
may overlap base spans, but never equal one of their kind or lie inside it.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import begin

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")

# Letters of other alphabets that look like Latin ones.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ѡ": "w", "һ": "h", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
}
# Digits as words, in the four languages of the corpus; plus begins a phone number.
SPELLED = {
    "plus": "+",
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "une": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
#: Spelled digits count from so many in a row on.
SPELLED_RUN = 4
WORDS = "|".join(sorted(SPELLED, key=len, reverse=True))
SPELLED_DIGITS = re.compile(rf"(?i)(?<!\w)(?:{WORDS})(?:[ ,-]{{1,2}}(?:{WORDS}))+(?!\w)")
SPELLED_WORD = re.compile(rf"(?i)(?:{WORDS})")
AT = r"(?:\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*)"
DOT = r"(?:\s*[\[({<]\s*(?:dot|punkt|punto|point|\.)\s*[\])}>]\s*|\s+dot\s+)"
#: name at host dot top: bracketed signs anywhere; bare words only with a bare or bracketed dot behind.
DISGUISED = re.compile(
    rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]+(?:(?:\.|{DOT})[A-Za-z0-9_%+-]+)*"
    rf"(?:(?P<at>{AT})[A-Za-z0-9-]+(?:(?:\.|{DOT})[A-Za-z0-9-]+)+|(?P<bare>\s+at\s+)[A-Za-z0-9-]+(?:{DOT}[A-Za-z0-9-]+)+|@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*{DOT}[A-Za-z0-9-]+(?:(?:\.|{DOT})[A-Za-z0-9-]+)*)"
)
SIGN = re.compile(rf"(?i)(?P<at>{AT}|(?<=\w)\s+at\s+(?=\w))|(?P<dot>{DOT})")
MAYBE_DISGUISED = re.compile(r"(?i)[\[({<]\s*(?:at|@|dot|punkt|punto|point|\.)\s*[\])}>]|\sdot\s")
LETTERS = re.compile(r"[^\W\d_]+")
BRACKET = re.compile(r"[\[({<]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, walking from @ to @: linear in the text.

    A name is the run of name characters before an @, cut where the last match ends; the @ itself is
    no name character, so no other start can give a match.
    """
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
            floor = m.end()
        at = text.find("@", max(at + 1, floor))
    return found


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p.lstrip("0")) <= 3 else p) <= 255 for p in m[0].split("."))]


def cards(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CARD.finditer(text) if 12 <= len(m[0]) and 12 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d)]


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def detect(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of plain identifiers, by start, then kind; leftmost and non-overlapping for each kind."""
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for kind in ("ip", "card", "phone"):
            found += [(kind, *s) for s in FINDERS[kind](text)]
    return sorted(found, key=order)


def order(span: tuple[str, int, int]) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


class Tape:
    """A text with the source span of each of its characters, kept as runs of equal shift and single rewrites."""

    def __init__(self, text: str):
        self.text, self.starts, self.spans = text, [0], [(0, len(text), True)]

    def source(self, at: int) -> tuple[int, int]:
        """The source span of the character at a place."""
        k = bisect_right(self.starts, at) - 1
        start, end, plain = self.spans[k]
        return (start + at - self.starts[k], start + at - self.starts[k] + 1) if plain else (start, end)

    def back(self, start: int, end: int) -> tuple[int, int]:
        return self.source(start)[0], self.source(end - 1)[1]

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """Replace text[start:end] for each of the ordered, disjoint edits."""
        out, starts, spans, at, size = [], [], [], 0, 0

        def copy(upto: int) -> None:
            nonlocal at, size
            while at < upto:
                k = bisect_right(self.starts, at) - 1
                stop = min(upto, self.starts[k + 1] if k + 1 < len(self.starts) else len(self.text))
                start, end, plain = self.spans[k]
                starts.append(size)
                spans.append((start + at - self.starts[k], start + stop - self.starts[k], True) if plain else (start, end, False))
                out.append(self.text[at:stop])
                size += stop - at
                at = stop

        for start, end, new in edits:
            copy(start)
            a, b = self.back(start, end)
            starts.append(size)
            spans.append((a, b, False))
            out.append(new)
            size += len(new)
            at = end
        copy(len(self.text))
        tape = Tape("".join(out))
        if starts:
            tape.starts, tape.spans = starts, spans
        return tape


@cache
def plain_char(c: str) -> str | None:
    """The ASCII character that stands for a look-alike letter or a digit of another script."""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if c.isdecimal():
        return str(unicodedata.decimal(c))
    wide = unicodedata.normalize("NFKC", c)
    return wide if len(wide) == 1 and wide.isascii() and wide.isprintable() and unicodedata.east_asian_width(c) in "FH" else None


#: Letters of the corpus' languages stand for themselves; only what lies outside Latin-1 is looked at.
FOREIGN = re.compile(r"[^\x00-\xff]")


def fold_lookalikes(tape: Tape) -> Tape:
    """Look-alike letters and other scripts' digits become ASCII, one character for one."""
    text = tape.text
    edits = []
    for m in FOREIGN.finditer(text):
        new = plain_char(m[0])
        if new:
            edits.append((m.start(), m.end(), new))
    return tape.rewrite(edits) if edits else tape


def fold_spelled(tape: Tape) -> Tape:
    """Runs of at least SPELLED_RUN digit words become digits."""
    edits = []
    for m in SPELLED_DIGITS.finditer(tape.text):
        words = list(SPELLED_WORD.finditer(tape.text, *m.span()))
        if len(words) >= SPELLED_RUN:
            for k, w in enumerate(words):
                until = words[k + 1].start() if k + 1 < len(words) else w.end()
                edits.append((w.start(), until, SPELLED[w[0].lower()]))
    return tape.rewrite(edits) if edits else tape


def fold_signs(tape: Tape) -> Tape:
    """at and dot in disguise become @ and . inside what then reads as an address."""
    edits = []
    for m in DISGUISED.finditer(tape.text):
        edits += [(s.start(), s.end(), "@" if s["at"] else ".") for s in SIGN.finditer(tape.text, *m.span())]
    return tape.rewrite(edits) if edits else tape


def deobfuscate(text: str) -> Tape:
    tape = Tape(text)
    if not text.isascii():
        tape = fold_lookalikes(tape)
    low = tape.text.lower()
    if sum(map(SPELLED.__contains__, LETTERS.findall(low))) >= SPELLED_RUN:
        tape = fold_spelled(tape)
    if ("dot" in low or BRACKET.search(low)) and MAYBE_DISGUISED.search(tape.text):
        tape = fold_signs(tape)
    return tape


def find(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans) in code points of the source; a null text has none."""
    if not text:
        return [], []
    base = detect(text)
    tape = deobfuscate(text)
    if tape.text == text:
        return base, base
    taken = {k: ([s for kind, s, _ in base if kind == k], [e for kind, _, e in base if kind == k]) for k in KINDS}
    added = []
    for kind, start, end in detect(tape.text):
        a, b = tape.back(start, end)
        # spans of one kind do not overlap: only the last that begins at or before a can hold it
        firsts, ends = taken[kind]
        k = bisect_right(firsts, a) - 1
        if k < 0 or ends[k] < b:
            added.append((kind, a, b))
    return base, sorted(base + added, key=order)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


DIGEST = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def digest(docs: DataFrame) -> DataFrame:
    """Counts and hash of the base spans and the list of all spans of each document; null text: none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at in range(0, batch.num_rows, 512):
                found = [find(t) for t in batch.column(1)[at : at + 512].to_pylist()]
                counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
                hashes = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string())
                yield pa.RecordBatch.from_arrays([ids[at : at + 512], *counts, hashes, pa.array([joined(a) for _, a in found], pa.string())], names=[c.split()[0] for c in DIGEST.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, DIGEST)


def masked(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; of overlapping spans the widest reach is covered once."""
    if not text:
        return text
    out, at = [], 0
    for kind, start, end in find(text)[1]:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
            at = end
        elif end > at:
            at = end
    return "".join([*out, text[at:]]) if out else text


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with personal data masked in text_col; all other columns, and null texts, stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("pii")
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            column = pa.array([masked(t) for t in batch.column(k).to_pylist()], batch.schema.field(k).type)
            yield batch.set_column(k, batch.schema.field(k), column)

    return docs.mapInArrow(run, docs.schema)
