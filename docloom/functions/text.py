"""Text functions as column expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in the sense of Unicode; Java's \s alone is ASCII.
BLANK = r"(?U)[\s\x1C-\x1F]+"
ENDS = r"^(?U)[\s\x1C-\x1F]+|(?U)[\s\x1C-\x1F]+$"
# File endings, weekdays, markup names and the words by which blocks are found must be these for right results.
FILE_LINK = r"(?i)\.(pdf|docx?|xlsx?|pptx?|zip|csv|txt|rtf|odt|ods)(?:$|[?#])"
WEEKDAYS = ("montag", "dienstag", "mittwoch", "donnerstag", "freitag", "samstag", "sonntag")
MARKUP_LINE = r"<\s*/?\s*(?:script|style|link|meta|head|body|html|!)"
CONTACT, REACH, HOURS_TITLE = "kontakt|erreichen|kunden-?center|servicecenter", "kontakt|erreichen", "Öffnungszeiten"
QUESTIONS = "faq|fragen"
MIN_CONTAINED, MIN_ANSWER, ANSWER_PROBE, MIN_PROSE = 8, 15, 40, 40


def strip(x: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(x, ENDS, "")


def norm(x: Column) -> Column:
    """White space collapsed, ends stripped, lower case; null gives the empty text."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), BLANK, " ")))


def content_norm(x: Column) -> Column:
    """norm after runs of hyphens and pipes became spaces: Markdown tables compare like plain text."""
    return norm(F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), "-{2,}", " "), r"\|", " "))


def lines(x: Column) -> Column:
    """Lines without their ends; a final line end opens no line, and an empty text has none."""
    parts = F.split(x, r"\R|[\x1C-\x1E]", -1)
    last = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return F.when(x == "", F.array().cast("array<string>")).otherwise(last)


def is_file_link(href: Column) -> Column:
    return F.coalesce(F.rlike(href, F.lit(FILE_LINK)), F.lit(False))


def is_weekday(day: Column) -> Column:
    return norm(day).isin(*WEEKDAYS)


def looks_like_prose(x: Column) -> Column:
    """At least MIN_PROSE characters and a sentence mark once tokens with slashes are gone."""
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\S*/\S*", " "), BLANK, " "))
    return (F.length(clean) >= MIN_PROSE) & F.rlike(clean, F.lit("[.?!]"))


def is_blank_text(x: Column) -> Column:
    """Null, white space, or nothing but list markers."""
    left = F.regexp_replace(strip(F.coalesce(x, F.lit(""))), r"(?mU)^\s*(?:[-*•]|\d+[.)])\s*", "")
    return strip(left) == ""


def strip_markup_lines(x: Column) -> Column:
    """Without lines of page source; null if nothing is left; an empty text stays."""

    def prose(line: Column) -> Column:
        low = F.lower(strip(line))
        return ~(F.rlike(low, F.lit(MARKUP_LINE)) | low.startswith("[if ") | F.contains(low, F.lit("endif]")))

    kept = strip(F.array_join(F.filter(lines(x), prose), "\n"))
    return F.when(x.isNull() | (x == ""), x).otherwise(F.nullif(kept, F.lit("")))


def phone_key(x: Column) -> Column:
    """Digits without the country code 49, or else without one leading 0."""
    digits = F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\D", "")
    return F.when(digits.startswith("49"), F.substr(digits, F.lit(3))).when(digits.startswith("0"), F.substr(digits, F.lit(2))).otherwise(digits)


def headings_match(a: Column, b: Column) -> Column:
    """Normalised headings that are equal, or of which one of at least MIN_CONTAINED characters lies in the other."""
    inside = lambda x, y: F.contains(y, x) & (F.length(x) >= MIN_CONTAINED)
    return (a != "") & (b != "") & ((a == b) | inside(a, b) | inside(b, a))


def faq_block(page: Column, questions: Column) -> Column:
    """Place of the first block of a page that is about questions, null if none is.

    A block is if its heading or a subheading says so or a segment holds questions; a subheading that repeats a question
    found on the page says nothing.
    """
    says = lambda x: F.rlike(norm(x), F.lit(QUESTIONS))
    told = lambda s: s["faqs"].isNotNull() | (says(s["subheading"]) & ~F.coalesce(F.array_contains(questions, norm(s["subheading"])), F.lit(False)))
    about = F.transform(page["blocks"], lambda b: says(b["heading"]) | F.coalesce(F.exists(b["segments"], told), F.lit(False)))
    return F.nullif(F.array_position(about, True), F.lit(0)) - 1


def answer_present(answer: Column, blob: Column) -> Column:
    """The beginning of a content-normalised answer of some length occurs in the blob."""
    return (F.length(answer) >= MIN_ANSWER) & F.contains(blob, F.left(answer, F.lit(ANSWER_PROBE)))


def strip_hashes(x: Column) -> Column:
    return strip(F.regexp_replace(F.coalesce(x, F.lit("")), "^#+", ""))


def sha256_text(x: Column) -> Column:
    return F.sha2(F.encode(x, "UTF-8"), 256)
