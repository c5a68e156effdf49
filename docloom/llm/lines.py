"""Line dedup: repeated runs of lines from the ranks of a suffix array over line-id sequences.

A document is a sequence of line ids: hashes of its lines that are not blank. Prefix doubling ranks all
suffixes of the corpus by their first 1, 2, 4, ... lines: the rank of 2m lines is the place of the pair of
ranks of its halves among all such pairs in order. A suffix whose first m lines occur nowhere else has its
place already and leaves the doubling, so each level holds the repeated runs of m lines only, and doubling
ends when the longest repeated run is passed. Suffixes with one rank at level m are an interval of the
suffix array whose longest common prefix has at least m lines; an interval of any other length is the pair
of the ranks of its first and last m lines.

A run counts from min_words words on. Every maximal repeated run of so many words is a union of repeated
runs that are the shortest from one of its lines on or up to one of its lines, and what they cover repeats.
So the later members of the intervals of these shortest runs are deleted, and with them the later copies of
all maximal repeated runs. Built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import NO_ID, materialize, release

#: A repeated run counts from so many words on.
MIN_WORDS = 8
WORD = r"[^\x20\x09-\x0D]+"


def key_of(docs: DataFrame) -> Column:
    """What tells documents apart, in the order of doc_id (null first): the id and a hash of the text, as an id may stand for several texts."""
    return F.struct(F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("text"))


def line_list(text: Column) -> Column:
    """Structs (line, n) of all lines of a text; n is a line's number of words."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.struct(x.alias("line"), F.regexp_count(x, F.lit(WORD)).alias("n")))


def pair_hash(*columns: Column) -> Column:
    return F.struct(F.xxhash64(F.lit(1), *columns).alias("a"), F.xxhash64(F.lit(2), *columns).alias("b"))


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """(row, key, line, a, b, runs): the id of each line that is not blank, and the lengths of the shortest runs of min_words words
    from it on, and from it up to any later line. row tells rows of docs apart, and line counts lines that are not blank."""
    rows = docs.select(key_of(docs).alias("key"), F.filter(line_list(docs["text"].cast("string")), lambda x: x["n"] > 0).alias("lines"))
    rows = rows.where(F.size("lines") > 0).withColumn("row", F.monotonically_increasing_id()).withColumn("n", F.col("lines.n"))

    def until(counts: Column) -> Column:
        """How many of the counts make min_words words; 0 if all are too few."""
        start = F.struct(F.lit(0).alias("lines"), F.lit(0).alias("words"))
        grow = lambda s, x: F.when(s["words"] >= min_words, s).otherwise(F.struct((s["lines"] + 1).alias("lines"), (s["words"] + x).alias("words")))
        return F.aggregate(counts, start, grow, lambda s: F.when(s["words"] >= min_words, s["lines"]).otherwise(0))

    def back(i: Column) -> Column:
        """Lines from line i backwards until min_words words; 0 if the document begins after."""
        held = F.least(i + 1, F.lit(min_words))
        return until(F.reverse(F.slice(F.col("n"), i + 2 - held, held)))

    rows = rows.withColumn("ahead", F.transform("n", lambda x, i: until(F.slice(F.col("n"), i + 1, min_words)))).withColumn("behind", F.transform("n", lambda x, i: back(i)))
    sizes = F.sequence(F.lit(1), F.lit(min_words))
    shortest = lambda i: F.filter(sizes, lambda d: (F.get(F.col("ahead"), i) == d) | (F.get(F.col("behind"), i + d - 1) == d))
    cells = F.transform("lines", lambda x, i: F.struct(pair_hash(x["line"]).alias("id"), shortest(i).alias("runs")))
    return rows.select("row", "key", F.posexplode(cells).alias("line", "cell")).select("row", "key", "line", "cell.id.a", "cell.id.b", "cell.runs")


def ranked(places: DataFrame, by: list[str], step: int) -> tuple[DataFrame, DataFrame]:
    """The places whose run of `step` lines, told by the columns `by`, occurs elsewhere too, with its rank; and the table of ranks.

    Runs are counted with partial sums, then put in order; a hot run is one row there, so the join back can split its places.
    """
    groups = places.groupBy(*by).agg(F.count("*").alias("n"), F.min(F.struct("key", "line")).alias("first")).where("n > 1")
    groups = materialize(groups.orderBy(*by).select(*by, F.monotonically_increasing_id().alias("place"), "first"), "ranks")
    copy = (F.col("key") != F.col("first.key")) | (F.col("line") >= F.col("first.line") + step)
    longer = F.filter("runs", lambda d: d >= step)
    return materialize(places.join(groups, by).select("row", "key", "line", longer.alias("runs"), F.col("place").alias("rank"), copy.alias("copy")), "places"), groups


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """(key, line, length): shortest runs that occurred before, in the order of doc_id and line; and (key, longest) of longer ones.

    A copy counts if it does not overlap the first occurrence. longest is the length of the longest run, of min_words lines or
    more, that doubling met as a copy.
    """
    lines = materialize(line_table(docs, min_words), "lines")
    places, groups = ranked(lines, ["a", "b"], 1)
    made, named, blocks, step = [lines, places, groups], [], [], 1
    while True:
        ahead = places.select(F.col("row").alias("row2"), F.col("line").alias("at"), F.col("rank").alias("next"))
        if step <= min_words:
            asked = places.select("row", "key", "line", "rank", F.explode(F.filter("runs", lambda d: d < 2 * step)).alias("length"))  # noqa: B023
            named.append(asked.join(ahead, F.expr(f"row = row2 and line + length - {step} = at")).select("key", "line", "length", "rank", "next"))
        if step >= min_words or not blocks:
            blocks.append(places.where(F.col("copy") & F.lit(step >= min_words)).select("key", F.lit(step).alias("length")))
        if places.isEmpty():
            break
        pairs = places.join(ahead, F.expr(f"row = row2 and line + {step} = at")).select("row", "key", "line", "runs", "rank", "next")
        step *= 2
        places, groups = ranked(pairs, ["rank", "next"], step)
        made += [places, groups]
    runs = materialize(reduce(DataFrame.union, named), "runs")
    longest = materialize(reduce(DataFrame.union, blocks).groupBy("key").agg(F.max("length").alias("longest")), "longest")
    for table in made:
        release(table)
    name = ["length", "rank", "next"]
    shared = runs.groupBy(*name).agg(F.count("*").alias("n"), F.min(F.struct("key", "line")).alias("first")).where("n > 1")
    copies = runs.join(shared, name).where((F.col("key") != F.col("first.key")) | (F.col("line") >= F.col("first.line") + F.col("length")))
    return copies.select("key", "line", "length"), longest


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with later copies of repeated line runs deleted from text, and n_lines, n_deleted, n_runs and n_longest added.

    The first occurrence, by doc_id (null first) and line, stays whole unless other runs delete parts of it;
    rows of one doc_id and one text count as one place and are cut alike; rows of one doc_id with different texts are
    documents of their own. Blank lines stay. A null text stays null;
    an empty text has no runs; an empty table gives an empty table. Columns of docs are kept, and a column
    of docs named like an added one is replaced. n_lines and n_deleted count non-blank lines; n_runs counts
    maximal deleted runs, and n_longest the lines of the longest run that the ranks tell to be a later copy: a shortest one, or a
    power of two lines.
    """
    copies, longest = later_copies(docs, min_words)
    covered = copies.select("key", "length", F.explode(F.sequence(F.col("line"), F.col("line") + F.col("length") - 1)).alias("line"))
    cut = covered.groupBy("key").agg(F.sort_array(F.collect_set("line")).alias("cut"), F.max("length").alias("length")).join(longest, "key", "left")
    cut = cut.select("key", "cut", F.greatest("length", "longest").alias("longest"))
    # the columns of docs travel as one, so that none of them can clash with those made here
    at = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key_of(docs).alias("key")).join(cut, "key", "left")
    text = F.col("row").getField("text")
    at = at.withColumn("all", line_list(text.cast("string")))
    touched = F.col("cut").isNotNull()
    numbered = F.filter(F.transform("all", lambda x, i: F.struct(i.alias("i"), x["n"].alias("n"))), lambda x: x["n"] > 0)
    at = at.withColumn("places", F.when(touched, F.transform(numbered, lambda x: x["i"])))
    at = at.withColumn("gone", F.when(touched, F.transform("cut", lambda k: F.get(F.col("places"), k))))
    keep = F.transform(F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.col("gone")), lambda i: F.get(F.col("all"), i)["line"])
    starts = F.filter(F.transform("cut", lambda k, i: (i == 0) | (k != F.get(F.col("cut"), F.greatest(i - 1, F.lit(0))) + 1)), lambda x: x)
    made = {
        "n_lines": F.size(F.filter("all", lambda x: x["n"] > 0)).cast("long"),
        "n_deleted": F.when(touched, F.size("cut")).otherwise(0).cast("long"),
        "n_runs": F.when(touched, F.size(starts)).otherwise(0).cast("long"),
        "n_longest": F.coalesce("longest", F.lit(0)).cast("long"),
    }
    kept = [(F.when(touched, F.array_join(keep, "\n")).otherwise(text) if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns if c not in made]
    return at.select(F.struct(*kept, *[column.alias(name) for name, column in made.items()]).alias("row")).select("row.*")
