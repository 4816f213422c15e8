"""Line deduplication by a segment-partition edit join.

Lines of at least ``min_chars`` characters (white space at the ends aside; all but blank ones, if not given) are compared across all
documents: equal lines are alike, and lines of ``EDITS + 1`` characters and more are if at most ``EDITS`` single-character edits turn one into the other.  A line is split into ``EDITS + 1`` even segments; of two like
lines, at least one segment of the shorter stands unchanged in the longer, near its place.  So each distinct line gives index
rows (its segments, keyed by length, number and text) and probe rows (the substrings of itself that may equal a segment of a
line of the same length or up to ``EDITS`` shorter; positions as the edits left and right of a segment allow).  Matches are verified
with the banded edit distance of Spark.  Lines connected by links are one class; its first occurrence, by document id and
place, stays and the others go.

DataFrame functions only.  Line texts are never shuffled for grouping: lines travel as hashes (two 64-bit ones for equality),
and only the texts of matched lines are moved to be verified.

Defined results: null text has no lines and stays null; empty and blank lines, and those of fewer than ``min_chars`` characters, always stay; rows with the same
id and text are one document; null ids sort first; a text all of whose lines go becomes empty.  Extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabscore.llm.common import components, keep, read

EDITS = 2
MIN_CHARS = 1
#: Lines that share a segment beyond which their pairs are verified where they meet.
CROWD = 20
#: Bytes (about 100 a row, and 4 for each entry of its lists) up to which a side is sent to all executors.
BROADCAST_BYTES = 64_000_000


def small(df: DataFrame, entries: Column | None = None) -> DataFrame:
    """``df`` (kept before), marked for broadcast if its counted rows, with the entries of their lists, are small enough."""
    count = df.agg(F.count("*").alias("rows"), F.sum(F.lit(0) if entries is None else entries).alias("entries")).first()
    return F.broadcast(df) if 100 * count["rows"] + 4 * (count["entries"] or 0) <= BROADCAST_BYTES else df


def lines_of(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """``(doc, th, pos, line, a, b)`` of every line that takes part; ``a`` and ``b`` are hashes of the line."""
    src = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("t")).where("t is not null")
    rows = src.select("doc", F.xxhash64("t").alias("th"), F.posexplode_outer(F.split("t", "\n", -1)).alias("pos", "raw"))
    rows = rows.select("doc", "th", "pos", F.trim("raw").alias("line")).where(F.length("line") >= min_chars)
    return rows.select("doc", "th", "pos", "line", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))


def segment(length: Column, number: int | Column, edits: int) -> tuple[Column, Column]:
    """First character (from 1) and size of a segment of a line of that length: even sizes, the last ones longer."""
    parts = edits + 1
    size, more = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    longer = F.greatest(F.lit(0), F.lit(number) - (F.lit(parts) - more))  # longer segments before this one
    own = size + F.when(F.lit(number) >= F.lit(parts) - more, 1).otherwise(0)
    return size * number + longer + 1, own


def places(edits: int) -> list[tuple[int, int, int]]:
    """``(number, less, shift)`` of each substring of a line that may equal a segment: of a line ``less`` characters shorter, ``shift``
    characters from the segment's place there.  Those with neither are the line's own segments."""
    return [(i, less, shift) for less in range(edits + 1) for i in range(edits + 1)
            for shift in range(max(-i, less - (edits - i)), min(i, less + (edits - i)) + 1)]


def keys(lines: DataFrame, edits: int) -> DataFrame:
    """A row for each key of a line: the line's columns, ``k``, and ``own``, whether it is an index key of the line besides a probe key.

    The places are rows of a constant, so one short expression makes all keys and the line's length is counted once.  Where
    every character is a byte, places are found without a walk through the line; the hashes are those of the characters.
    """
    at = F.array(*[F.struct(*[F.lit(x).alias(name) for x, name in zip(place, ("number", "less", "shift"))]) for place in places(edits)])
    rows = lines.withColumn("chars", F.length("line")).withColumn("plain", F.octet_length("line") == F.col("chars"))
    rows = rows.withColumn("bytes", F.col("line").cast("binary")).select("*", F.explode(at).alias("at"))
    rows = rows.select(*lines.columns, "bytes", "plain", "at.number", (F.col("chars") - F.col("at.less")).alias("length"), "at.shift",
                       ((F.col("at.less") == 0) & (F.col("at.shift") == 0)).alias("own")).where(F.col("length") > edits)
    start, size = segment(F.col("length"), F.col("number"), edits)
    rows = rows.select(*lines.columns, "bytes", "plain", "number", "length", "own", (start + F.col("shift")).alias("start"), size.alias("size"))
    part = F.when(F.col("plain"), F.col("bytes").substr(F.col("start"), F.col("size"))).otherwise(F.col("line").substr(F.col("start"), F.col("size")).cast("binary"))
    return rows.select(*lines.columns, F.xxhash64("number", "length", part).alias("k"), "own")


def matches(lines: DataFrame, edits: int) -> DataFrame:
    """Pairs ``(u, v)``, ``u < v``, of line hashes that share a segment; and, as ``(u, null)``, the lines of crowded segments.

    Keys are first combined to the smallest and the largest line of each, which leaves those of two lines and more; only these
    keys' lines are moved.  Many variants of one line share its segments, and their pairs grow with the square of the group.  A
    segment of more than ``CROWD`` lines therefore gives no pairs here but its lines, which ``links`` verifies where they meet.
    """
    every = keys(lines.select("a", "line"), edits).select("a", "k", "own")
    ends = every.groupBy("k").agg(F.min("a").alias("low"), F.max("a").alias("high"), F.max("own").alias("own"))
    shared = small(keep(ends.where(F.col("own") & (F.col("low") != F.col("high"))).select("k")))
    rows = keep(every.join(shared, "k", "left_semi").distinct())
    counted = rows.where("own").select(F.col("a").alias("u"), "k").withColumn("n", F.count("*").over(Window.partitionBy("k")))  # sorted by k, as the join needs it
    pro = rows.select(F.col("a").alias("v"), "k").distinct()
    both = counted.where(F.col("n") <= CROWD).join(pro, "k").where("u != v")
    pairs = both.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    crowd = counted.where(F.col("n") > CROWD)
    own = crowd.select("u").unionByName(pro.join(crowd.select("k").distinct(), "k", "left_semi").select(F.col("v").alias("u")))
    return pairs.unionByName(own.select("u", F.lit(None).cast("long").alias("v"))).distinct()


def links(lines: DataFrame, edits: int) -> DataFrame:
    """Pairs ``(u, v)`` of line hashes whose texts are within the edits."""
    found = keep(matches(lines, edits))
    pairs, crowd = found.where("v is not null"), found.where("v is null").select(F.col("u").alias("a"))
    ids = small(keep(found.select(F.explode(F.array("u", "v")).alias("a")).where("a is not null").distinct()))
    texts = keep(lines.select("a", "line").join(ids, "a", "left_semi").distinct())
    both = (pairs.join(texts.select(F.col("a").alias("u"), F.col("line").alias("x")), "u")
            .join(texts.select(F.col("a").alias("v"), F.col("line").alias("y")), "v"))
    plain = both.where(F.levenshtein("x", "y", edits) >= 0).select("u", "v")
    # Crowded lines: the edit distance is a condition of the join itself, so only links leave it, and AQE splits a
    # crowded key among tasks.
    every = keys(texts.join(crowd, "a", "left_semi"), edits)
    ind = every.where("own").select(F.col("a").alias("u"), F.col("line").alias("x"), "k")
    pro = every.select(F.col("a").alias("v"), F.col("line").alias("y"), F.col("k").alias("k2"))
    close = ind.join(pro, (F.col("k") == F.col("k2")) & (F.col("u") != F.col("v")) & (F.levenshtein("x", "y", edits) >= 0))
    return plain.unionByName(close.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))).distinct()


def repeats(docs: DataFrame, key: str, text: str, edits: int, min_chars: int) -> DataFrame:
    """``(_gone_doc, _gone_th, _gone_within, _gone_abroad, _gone_chars)``: places of a document's lines that repeat one of its own, places of those that another
    document had before, and the characters of the latter."""
    lines = lines_of(docs, key, text, min_chars)
    alike = components(links(lines.where(F.length("line") > edits), edits))  # shorter lines have no edits + 1 segments
    alike = small(keep(alike.withColumnRenamed("id", "a")))
    # a class: the lines of a component, or equal lines
    own = lines.groupBy("a", "b").agg(F.count("*").alias("n")).join(alike, "a", "left").where("n > 1 or component_id is not null")
    own = own.select("a", "b", F.coalesce("component_id", "a").alias("c"), F.when(F.col("component_id").isNull(), F.col("b")).otherwise(0).alias("cb"))
    hit = lines.select("doc", "th", "pos", F.length("line").alias("chars"), "a", "b").join(small(keep(own)), ["a", "b"])
    # the class's lines within a document: the first of them goes only if another document had the class before
    per = keep(hit.groupBy("doc", "th", "c", "cb").agg(F.min("pos").alias("own"), F.collect_set("pos").alias("all"), F.min_by("chars", "pos").alias("chars")))
    first = small(keep(per.groupBy("c", "cb").agg(F.min(F.struct("doc", "th")).alias("first"))))
    per = per.join(first, ["c", "cb"]).withColumn("foreign", ~(F.col("first.doc").eqNullSafe(F.col("doc")) & (F.col("first.th") == F.col("th"))))
    per = per.select("doc", "th", F.array_except("all", F.array("own")).alias("within"),
                     F.when(F.col("foreign"), F.array("own")).otherwise(F.array().cast("array<int>")).alias("abroad"),
                     F.when(F.col("foreign"), F.col("chars")).otherwise(0).alias("chars"))
    return per.groupBy(F.col("doc").alias("_gone_doc"), F.col("th").alias("_gone_th")).agg(
        F.flatten(F.collect_list("within")).alias("_gone_within"), F.flatten(F.collect_list("abroad")).alias("_gone_abroad"), F.sum("chars").alias("_gone_chars"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS,
                most: float | None = None) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and ``n_lines`` and ``n_dropped`` added.

    ``most``: where lines that other documents had before make up more than this share of a document's characters,
    it is a copy as a whole and keeps them (a document-level stage decides about copies); its own repeats go nevertheless.
    """
    gone = small(keep(repeats(docs, key, text, edits, min_chars)), F.size("_gone_within") + F.size("_gone_abroad"))
    t = F.col(text).cast("string")
    rows = docs.join(gone, (F.xxhash64(t) == F.col("_gone_th")) & docs[key].eqNullSafe(F.col("_gone_doc")) & docs[text].isNotNull(), "left")
    gone_at = F.concat("_gone_within", "_gone_abroad")
    if most is not None:
        gone_at = F.when(F.col("_gone_chars") > F.length(t) * most, F.col("_gone_within")).otherwise(gone_at)
    gone_at = F.when(F.col("_gone_doc").isNotNull() | F.col("_gone_th").isNotNull(), gone_at)
    parts = F.split(t, "\n", -1)
    rows, gone_at = rows.withColumn("_gone_at", gone_at), F.col("_gone_at")
    # the text is split once; as an element of a transform it would be split for every line
    new = F.when(F.size(gone_at) > 0, F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(gone_at, i)), "\n")).otherwise(t)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return rows.select(*[new.alias(c) if c == text else docs[c] for c in names],
                       F.coalesce(F.octet_length(t) - F.octet_length(F.replace(t, F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long").alias("n_lines"),
                       F.when(F.size(gone_at) > 0, F.size(gone_at)).otherwise(0).cast("long").alias("n_dropped"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, n_lines, n_dropped, n_chars and crc32 of the text that stays."""
    out = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"),
                      F.crc32(F.col("text").cast("binary")).alias("kept_crc32"))


QUERIES = {"op7_line_dedup": op7_line_dedup}
