"""Placement of extracts within one page.

A group may attach to what an earlier group has added, so placement goes step by step within a page; pages are
independent rows. Headings are found by an index that follows every insertion: by name, and for containment by the
names' grams, so no heading is held against all others.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

from docloom.functions import text as tx

RULES, SLASHED = re.compile(r"-{2,}"), re.compile(r"\S*/\S*")
CONTACT, REACH, DAYS = re.compile(tx.CONTACT), re.compile(tx.REACH), tx.WEEKDAYS
SECTION_PROBE, DAYS_NEEDED = 60, 3
#: Length of the grams by which names are found that hold another one, and room between two labels.
GRAM, ROOM = 3, 1 << 32
FIELDS = ("subheading", "text", "files", "contacts", "faqs")


def squeeze(x: str | None) -> str:
    """functions.text.norm"""
    return " ".join((x or "").split()).lower()


def squeeze_content(x: str | None) -> str:
    """functions.text.content_norm"""
    x = x or ""
    return squeeze((RULES.sub(" ", x) if "--" in x else x).replace("|", " "))


def match(a: str, b: str) -> bool:
    """functions.text.headings_match"""
    if not a or not b:
        return False
    short, long = sorted((a, b), key=len)
    return a == b or (len(short) >= tx.MIN_CONTAINED and short in long)


def is_prose(text: str) -> bool:
    """functions.text.looks_like_prose"""
    clean = squeeze(SLASHED.sub(" ", text) if "/" in text else text)
    return len(clean) >= tx.MIN_PROSE and re.search("[.?!]", clean) is not None


class Segment:
    __slots__ = ("label", *FIELDS)

    def __init__(self, **filled: object):
        self.label = 0
        for name in FIELDS:
            setattr(self, name, filled.get(name))

    def told(self) -> dict:
        return {name: getattr(self, name) for name in FIELDS}


class Block:
    __slots__ = ("label", "heading", "segments")

    def __init__(self, heading: str | None, segments: list[Segment]):
        self.label, self.heading, self.segments = 0, heading, segments
        relabel(segments)


def relabel(items: list) -> None:
    for k, item in enumerate(items):
        item.label = k * ROOM


def insert(items: list, at: int, item: Segment | Block) -> None:
    """Put an item into a labelled list; its label lies between its neighbours'."""
    items.insert(at, item)
    low = items[at - 1].label if at else -ROOM
    item.label = (low + items[at + 1].label) // 2 if at + 1 < len(items) else low + ROOM
    if item.label in (low, items[at + 1].label if at + 1 < len(items) else None):
        relabel(items)


class Place:
    """A subheading, or a block heading (no segment)."""

    __slots__ = ("name", "block", "segment")

    def __init__(self, name: str, block: Block, segment: Segment | None):
        self.name, self.block, self.segment = name, block, segment

    def order(self) -> tuple[int, float]:
        return self.block.label, float("inf") if self.segment is None else self.segment.label


class HeadingIndex:
    """Places by name. Of places with one name only the first in the page is ever asked for."""

    def __init__(self) -> None:
        self.first: tuple[dict[str, Place], dict[str, Place]] = {}, {}  # subheadings, block headings
        self.grams: defaultdict[str, set[str]] = defaultdict(set)
        self.starts: defaultdict[str, set[str]] = defaultdict(set)
        self.unread: list[str] = []  # names whose parts are in neither yet: not every page is asked for parts
        self.found: dict[str, Place | None] = {}
        self.holding: dict[str, Block | None] = {}

    def add(self, place: Place) -> None:
        if not place.name:
            return
        level = self.first[place.segment is None]
        held = level.get(place.name)
        if held is None and place.name not in self.first[place.segment is not None]:
            self.unread.append(place.name)
        if held is None or place.order() < held.order():
            level[place.name] = place
            self.found.clear()
            self.holding.clear()

    def read(self) -> None:
        """Put the parts of new names in."""
        for name in self.unread:
            for k in range(len(name) - GRAM + 1):
                self.grams[name[k : k + GRAM]].add(name)
            if len(name) >= tx.MIN_CONTAINED:
                self.starts[name[: tx.MIN_CONTAINED]].add(name)
        self.unread.clear()

    def names_with(self, part: str) -> Iterator[str]:
        """Names that hold a part: those of its rarest gram, looked through."""
        self.read()
        if len(part) < GRAM:
            names = self.first[0].keys() | self.first[1].keys()
        else:
            names = min((self.grams.get(part[k : k + GRAM], ()) for k in range(len(part) - GRAM + 1)), key=len)
        return (n for n in names if part in n)

    def names_in(self, whole: str) -> Iterator[str]:
        """Names of at least MIN_CONTAINED characters that a text holds: those that begin as it does anywhere."""
        self.read()
        some = tx.MIN_CONTAINED
        return (n for k in range(len(whole) - some + 1) for n in self.starts.get(whole[k : k + some], ()) if whole.startswith(n, k))

    def find(self, wanted: str) -> Place | None:
        """Equal subheading, equal block heading, subheading by containment, block heading by containment; the first of its tier."""
        if wanted not in self.found:
            self.found[wanted] = next((p for p in self.tiers(wanted) if p is not None), None) if wanted else None
        return self.found[wanted]

    def tiers(self, wanted: str) -> Iterator[Place | None]:
        for level in self.first:
            yield level.get(wanted)
        names = set(self.names_in(wanted))
        if len(wanted) >= tx.MIN_CONTAINED:
            names.update(self.names_with(wanted))
        for level in self.first:
            yield min((level[n] for n in names if n in level), key=Place.order, default=None)

    def block_with(self, part: str) -> Block | None:
        """The first block whose heading holds a part."""
        if part not in self.holding:
            blocks = self.first[1]
            self.holding[part] = min((blocks[n].block for n in self.names_with(part) if n in blocks), key=lambda b: b.label, default=None) if part else None
        return self.holding[part]


class Page:
    """One page while extracts are placed into it."""

    def __init__(self, page: dict):
        self.page = page
        self.blocks = [Block(b["heading"], [Segment(**s) for s in b["segments"] or []]) for b in page["blocks"] or []]
        relabel(self.blocks)
        self.read()
        self.trail: list[str] = []
        self.nearest: tuple[HeadingIndex, int, int, Block | None] | None = None

    def read(self) -> None:
        """Index what the page holds now."""
        self.index = HeadingIndex()
        for block in self.blocks:
            self.learn(block)

    def learn(self, block: Block) -> None:
        self.index.add(Place(squeeze(block.heading), block, None))
        for segment in block.segments:
            self.index.add(Place(squeeze(segment.subheading), block, segment))

    def told(self) -> dict:
        return self.page | {"blocks": [{"heading": b.heading, "segments": [s.told() for s in b.segments]} for b in self.blocks]}

    # ---- where things go

    def locate(self, heading: str | None) -> tuple[Block, int] | None:
        """The block, and the place in it behind what the heading names."""
        place = self.index.find(squeeze(heading))
        if place is None:
            return None
        segments = place.block.segments
        return place.block, len(segments) if place.segment is None else segments.index(place.segment) + 1

    def put(self, block: Block, at: int, *segments: Segment) -> None:
        for k, segment in enumerate(segments):
            insert(block.segments, at + k, segment)
            self.index.add(Place(squeeze(segment.subheading), block, segment))

    def open_block(self, heading: str | None, segment: Segment, at: int | None = None) -> None:
        block = Block(heading, [segment])
        insert(self.blocks, len(self.blocks) if at is None else at, block)
        self.learn(block)

    def contact_block(self) -> Block:
        """The first block about contact, else the last."""
        return next((b for b in self.blocks if CONTACT.search(squeeze(b.heading))), self.blocks[-1])

    def hours_block(self) -> Block:
        """The first block with opening hours in a heading, else the first about contact, else the last."""
        title = tx.HOURS_TITLE.lower()[:-2]
        named = (b for b in self.blocks if any(title in squeeze(x) for x in (b.heading, *(s.subheading for s in b.segments))))
        return next(named, None) or next((b for b in self.blocks if REACH.search(squeeze(b.heading))), self.blocks[-1])

    def block_before(self) -> Block | None:
        """The block of the nearest of the headings passed so far that a block heading holds."""
        known = self.nearest
        at, block = (known[1], known[3]) if known and known[0] is self.index and known[2] == len(self.blocks) else (0, None)
        block = next((b for name in reversed(self.trail[at:]) if (b := self.index.block_with(name)) is not None), block)
        self.nearest = self.index, len(self.trail), len(self.blocks), block
        return block

    # ---- what is there already

    def texts(self, blocks: list[Block]) -> str:
        return squeeze_content(" ".join(x or "" for b in blocks for x in (b.heading, *(y for s in b.segments for y in (s.subheading, s.text)))))

    def strings(self) -> Iterator[str]:
        """Every text of the page in the order url, blocks, title."""
        yield self.page["url"] or ""
        for b in self.blocks:
            yield b.heading or ""
            for s in b.segments:
                yield from (x or "" for x in (s.subheading, s.text, s.files, s.contacts))
                if s.faqs:
                    yield s.faqs["title"] or ""
                    yield from (x or "" for q in s.faqs["QAs"] or [] for x in (q["question"], q["answer"]))
        yield self.page["title"] or ""

    def lacks_hours(self) -> bool:
        text = squeeze(" ".join(x for x in self.strings() if x))
        return sum(day in text for day in DAYS) < DAYS_NEEDED

    # ---- the steps

    def questions(self, groups: list[dict]) -> None:
        whole = self.texts(self.blocks)
        for group in groups:
            at = self.locate(group["heading"])
            held = whole if at is None else self.texts([at[0]])
            probes = ((q, squeeze_content(q["answer"])) for q in group["qas"])
            new = [q for q, a in probes if len(a) < tx.MIN_ANSWER or a[: tx.ANSWER_PROBE] not in held]
            segment = Segment(faqs={"title": None, "QAs": new})
            if new and at is None:
                self.open_block(group["heading"] or "FAQ", segment)
            elif new:
                self.put(*at, segment)

    def phones(self, phones: list[dict]) -> None:
        digits = re.sub(r"\D", "", "".join(self.strings()))
        lines = [f"{p['label']}: {p['phone']}" if p["label"] else p["phone"] for p in phones if p["key"] not in digits]
        if lines and self.blocks:
            block = self.contact_block()
            self.put(block, len(block.segments), Segment(contacts="\n".join(lines)))

    def hours(self, hours: str | None) -> None:
        if hours and self.blocks and self.lacks_hours():
            block = self.hours_block()
            self.put(block, len(block.segments), Segment(subheading=tx.HOURS_TITLE, text=hours))

    def files(self, groups: list[dict]) -> None:
        if groups:
            self.release_files()
        for group in groups:
            title, segment = group["heading"], Segment(files="\n".join(group["files"]))
            at = self.locate(title)
            if at is None:
                self.open_block(title or "Downloads", segment)
                continue
            block, place = at
            above = block.segments[place - 1].subheading if place else None
            named = not title or squeeze(title) == squeeze(block.heading) or match(squeeze(title), squeeze(above))
            self.put(block, place, *([segment] if named else [Segment(subheading=title), segment]))

    def release_files(self) -> None:
        """The page's own lists replace what was captured of them; a block that only announced downloads goes with them."""
        left = []
        for block in self.blocks:
            other = False
            for s in block.segments:
                s.files = None
                other |= bool(s.subheading or s.text or s.contacts or s.faqs)
            if other or not squeeze(block.heading).startswith("download"):
                left.append(block)
        if len(left) < len(self.blocks):
            self.blocks = left
            self.read()

    def prose(self, sections: list[dict]) -> None:
        held = self.texts(self.blocks)
        for section in sections:
            probe, name = squeeze_content(section["text"])[:SECTION_PROBE], squeeze(section["heading"])
            if is_prose(section["text"]) and not name.startswith("download") and not (probe and probe in held):
                segment, at = Segment(text=section["text"]), self.locate(section["heading"])
                if at is not None:
                    self.put(*at, segment)
                else:
                    before = self.block_before()
                    self.open_block(section["heading"], segment, None if before is None else self.blocks.index(before) + 1)
            self.trail.append(name)


def place(page: dict, extracts: dict) -> dict:
    """Extracts put into a page in the fixed order questions, phones, hours, files, prose."""
    work = Page(page)
    work.questions(extracts["qa_groups"] or [])
    work.phones(extracts["phones"] or [])
    work.hours(extracts["hours"])
    work.files(extracts["file_groups"] or [])
    work.prose(extracts["sections"] or [])
    return work.told()


# ---------------------------------------------------------------- questions about a page, answered as placement answers them


def located(page: dict, headings: list[str | None]) -> list[dict]:
    """Where what is found under each heading would go; nulls for nowhere."""
    work = Page(page)
    at = {id(b): k for k, b in enumerate(work.blocks)}
    found = map(work.locate, headings)
    return [{"block": None, "insert_at": None} if x is None else {"block": at[id(x[0])], "insert_at": x[1]} for x in found]


def followed(page: dict, headings: list[str | None]) -> list[int | None]:
    """For each heading the block behind which a new section of that heading would open; null for the end."""
    work = Page(page)
    at, out = {id(b): k for k, b in enumerate(work.blocks)}, []
    for heading in headings:
        before = work.block_before()
        out.append(None if before is None else at[id(before)])
        work.trail.append(squeeze(heading))
    return out


def chosen(page: dict) -> dict:
    """The blocks that phones and opening hours would go to, and whether the hours are missing."""
    work = Page(page)
    at = {id(b): k for k, b in enumerate(work.blocks)}
    contact, hours = (at[id(work.contact_block())], at[id(work.hours_block())]) if work.blocks else (None, None)
    return {"contact": contact, "hours": hours, "lacks_hours": work.lacks_hours()}
