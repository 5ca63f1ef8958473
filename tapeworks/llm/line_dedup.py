"""Repeated runs of lines, found by winnowing over line hashes. DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import WORD, stored

# White space that a line may hold besides blanks.
OTHER_SPACE = "\t\x0b\f\r"


def _key(doc_id: Column, text: Column) -> Column:
    """Names a document: equal rows are one document. Binary, of 128 bits."""
    return F.unhex(F.md5(F.concat_ws("\x1f", F.coalesce(doc_id.cast("string"), F.lit("\x1e")), text)))


def _trimmed(line: Column) -> Column:
    """A line without outer white space. Trimming by a set of signs is slow, and few lines need it."""
    plain = F.trim(line)
    others = [edge(sign) for sign in OTHER_SPACE for edge in (plain.startswith, plain.endswith)]
    return F.when(reduce(or_, others), F.trim(plain, F.lit(" " + OTHER_SPACE))).otherwise(plain)


def _words(trimmed: Column) -> Column:
    """Words of a trimmed line that is not empty; single blanks are counted without a pattern."""
    odd = reduce(or_, [trimmed.contains(x) for x in ("  ", *OTHER_SPACE)])
    blanks = F.octet_length(trimmed) - F.octet_length(F.replace(trimmed, F.lit(" "), F.lit("")))
    return F.when(odd, F.regexp_count(trimmed, F.lit(WORD))).otherwise(blanks + 1).cast("long")


def document_lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Lines with a word: doc_id, doc, line (place in the text), at (place among these), h, n, start.

    ``h`` is the hash of the trimmed line, ``n`` its words, ``start`` the words before it.
    """
    # The key comes before the lines are dealt out; beside the generator it would be computed per line.
    keyed = docs.select(docs[doc_id].alias("doc_id"), _key(docs[doc_id], docs[text]).alias("doc"),
                        F.split(docs[text], "\n", -1).alias("parts"))
    lines = (keyed.select("doc_id", "doc", F.posexplode("parts").alias("line", "raw"))
             .select("doc_id", "doc", "line", _trimmed(F.col("raw")).alias("raw"))
             .where(F.col("raw") != "")
             .select("doc_id", "doc", "line", F.xxhash64("raw").alias("h"), _words(F.col("raw")).alias("n")))
    in_order = Window.partitionBy("doc").orderBy("line")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    return (lines.repartition("doc").dropDuplicates(["doc", "line"])
            .withColumn("at", F.row_number().over(in_order))
            .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))))


def fingerprints(lines: DataFrame, min_words: int) -> DataFrame:
    """Windows of lines with their minimum: doc_id, doc, at, last, least, window.

    A window is the shortest run of lines from a start that has ``min_words`` words; the first lines
    whose starts lie within ``min_words`` words, so a range frame. Its least line hash is its
    fingerprint: two equal runs of that many words have an equal window, and so an equal fingerprint.
    Least hash and hash of all lines, 128 bits together, stand for the window.
    """
    frame = Window.partitionBy("doc").orderBy("start").rangeBetween(0, min_words - 1)
    whole = Window.partitionBy("doc")
    return (lines.withColumn("least", F.min("h").over(frame))
            .withColumn("window", F.xxhash64(F.collect_list("h").over(frame)))
            .withColumn("last", F.col("at") + F.count("*").over(frame) - 1)
            .withColumn("left", F.sum("n").over(whole) - F.col("start"))
            .where(F.col("left") >= min_words).select("doc_id", "doc", "at", "last", "least", "window"))


def _tails(lines: DataFrame, windows: DataFrame, again: DataFrame, min_words: int) -> DataFrame:
    """Lines behind repeated windows that go on with the match: doc, at, last.

    A run of equal lines is the union of its windows but for a tail of less than ``min_words`` words behind
    the last one. So only windows whose next one repeats nothing are extended, at each pair of documents
    and shift of their document under which they match; there line by line until one differs.
    """
    after = again.select("doc", (F.col("at") - 1).alias("at"))
    ends = again.select("doc", "at", "last", "least", "window").join(after, ["doc", "at"], "left_anti")
    shifts = again.select("doc", "doc0", "shift").distinct()
    source = windows.select(F.col("doc").alias("doc0"), F.col("at").alias("at0"), "least", "window")
    matched = (ends.join(shifts, "doc").withColumn("at0", F.col("at") - F.col("shift"))
               .join(source, ["doc0", "at0", "least", "window"]))
    places = F.sequence(F.col("last") + 1, F.col("last") + min_words - 1)
    steps = matched.select("doc", "doc0", "shift", "last", F.explode(places).alias("at"))
    mine = lines.select("doc", "at", "h")
    theirs = lines.select(F.col("doc").alias("doc0"), F.col("at").alias("at0"), F.col("h").alias("h0"))
    same = (steps.join(mine, ["doc", "at"]).withColumn("at0", F.col("at") - F.col("shift"))
            .join(theirs, ["doc0", "at0"]).where(F.col("h") == F.col("h0")))
    # Lines that follow the window without a gap.
    match = Window.partitionBy("doc", "doc0", "shift", "last").orderBy("at")
    on = same.withColumn("k", F.row_number().over(match)).where(F.col("at") - F.col("last") == F.col("k"))
    return on.groupBy("doc", (F.col("last") + 1).alias("from")).agg(F.max("at").alias("to"))


def repeated_lines(docs: DataFrame, min_words: int = 50, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Places of the lines that a repeated run holds: doc, line.

    1. Windows whose fingerprint occurs once in all documents repeat nothing and are left.
    2. Of the others, equal windows are joined to the first of them, in order of doc_id, then of the
       text, then of the line. A pair of places gives a pair of documents and a shift.
    3. A match is extended both ways to the whole run of equal lines. To the left and within, that is the
       union of its windows, which all repeat; to the right ``_tails`` adds what no window covers.

    The work grows with windows, ends of matches and shifts, not with lines times shifts: a text of n equal
    lines has n windows and one end.
    """
    lines = stored(document_lines(docs, doc_id, text), "lines")
    windows = stored(fingerprints(lines, min_words), "line-windows")
    # Stored before they are joined: beside a plain table the adaptive join can split a popular fingerprint.
    twice = stored(windows.groupBy("least").agg(F.count("*").alias("c")).where(F.col("c") > 1).select("least"), "line-least")
    candidates = stored(windows.join(twice, "least"), "line-candidates")
    place = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "doc", "at")
    first = stored(candidates.groupBy("least", "window").agg(F.min(place).alias("first"), F.count("*").alias("c"))
                   .where(F.col("c") > 1).drop("c"), "line-firsts")
    again = (candidates.withColumn("place", place).join(first, ["least", "window"])
             .where(F.col("place") != F.col("first"))
             .select("doc", "at", "last", "least", "window", F.col("first.doc").alias("doc0"),
                     (F.col("at") - F.col("first.at")).alias("shift")))
    again = stored(again, "line-again")
    ranges = again.select("doc", F.col("at").alias("from"), F.col("last").alias("to"))
    if min_words > 1:
        ranges = ranges.unionByName(_tails(lines, candidates, again, min_words))
    edges = ranges.select("doc", F.explode(F.array(
        F.struct(F.col("from").alias("at"), F.lit(1).alias("step")),
        F.struct((F.col("to") + 1).alias("at"), F.lit(-1).alias("step")))).alias("e"))
    edges = stored(edges.groupBy("doc", "e.at").agg(F.sum("e.step").alias("step")), "line-edges")
    # Lines stand in a range where more have begun than ended.
    known = lines.select("doc", "at", "line").join(edges.select("doc").distinct(), "doc", "left_semi")
    depth = F.sum(F.coalesce("step", F.lit(0))).over(Window.partitionBy("doc").orderBy("at"))
    return (known.join(edges, ["doc", "at"], "left").withColumn("depth", depth).where(F.col("depth") > 0)
            .select("doc", "line"))


def line_dedup(docs: DataFrame, min_words: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with repeated runs deleted from ``text``, and n_lines, n_removed.

    A run of equal lines (blank lines and outer white space aside) of ``min_words`` words or more stays
    where it stands first and goes where it comes again, in another document or the same. Lines
    elsewhere stay, however often they occur. NULL and empty texts stay as they are; equal rows (id and
    text) count as one document and get the same result; NULL ids come last; an empty table stays empty.
    Very long texts, also of one line over and over, cost in proportion to their length. Given columns of the
    names n_lines and n_removed are replaced; others of any name come along.
    """
    deleted = repeated_lines(docs, min_words, doc_id, text)
    deleted = stored(deleted.groupBy("doc").agg(F.collect_list("line").alias("gone")), "line-deletions")
    rows = docs.select(_key(docs[doc_id], docs[text]).alias("doc"), F.struct(*docs.columns).alias("row"))
    # One plan at every size: texts are dealt by key, and the deletions of a share are its lookup table.
    joined = rows.join(deleted.hint("shuffle_hash"), "doc", "left")
    whole = F.col("row").getField(text)
    lines = F.split(whole, "\n", -1)
    # The lines are bound once, and the places to keep come from a set.
    kept = F.transform(F.array(lines), lambda x: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("gone")), lambda k: F.get(x, k)))
    given = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(
        *[(F.when(F.col("gone").isNull(), whole).otherwise(F.array_join(F.get(kept, 0), "\n")) if c == text
           else F.col("row").getField(c)).alias(c) for c in given],
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("n_removed"))
