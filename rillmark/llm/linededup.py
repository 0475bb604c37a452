"""Line dedup over overlapping windows of three lines. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.base import free_name, stored

LINES = 3


def _windows(lines: str) -> str:
    """SQL for the windows over an array of (at, line): first and last line number and the hash of the lines.

    A text with fewer lines than a window has, but not none, is one window of all of them.
    """
    content = ", ".join(f"get({lines}, i + {k}).line" for k in range(LINES))
    last = ", ".join(f"get({lines}, i + {k}).at" for k in reversed(range(LINES)))
    return (
        f"CASE WHEN size({lines}) > 0 THEN transform(sequence(0, greatest(size({lines}) - {LINES}, 0)), i -> struct("
        f"get({lines}, i).at AS first, coalesce({last}) AS last,"
        f" unhex(md5(concat(least(size({lines}), {LINES}), '\\n', concat_ws('\\n', {content})))) AS hash)) END"
    )


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Windows that occurred before: ``doc, print, first, last`` (a row per later occurrence).

    A document is known by its id and the MD5 of its text.  The first occurrence of a window is that of
    the smallest id (null last), then of the smallest MD5, then of the smallest line.
    """
    lines = docs.select(
        F.col(doc_id).alias("doc"),
        F.unhex(F.md5(text)).alias("print"),
        F.expr(
            f"filter(transform(split(`{text}`, '\\n', -1), (l, i) -> struct(i AS at, trim(BOTH ' \\t\\r' FROM l) AS line)),"
            " x -> x.line <> '')"
        ).alias("lines"),
    )
    found = lines.select("doc", "print", F.explode(F.expr(_windows("lines"))).alias("w")).select("doc", "print", "w.*")
    place = F.struct(F.col("doc").isNull().alias("n"), "doc", "print", "first")
    found = stored(found.withColumn("place", place).drop("doc", "print", "first"), "line-windows")
    origins = found.groupBy("hash").agg(F.count("*").alias("times"), F.min("place").alias("origin")).where("times > 1")
    # written down, so that the join deals both sides anew and can split the rows of a frequent window
    origins = stored(origins.select("hash", "origin"), "repeated-windows")
    return found.join(origins, "hash").where("place > origin").select("place.doc", "place.print", "place.first", "last")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", spans_as: str | None = None) -> DataFrame:
    """All columns and rows, the text without the lines that a repeated window covers.

    Lines end at line feeds and are compared without blanks around them; blank lines belong to no
    window, but one between two covered lines goes with them.  Only later occurrences go; overlapping
    ones are merged into spans of lines.  A null text stays null, an empty one empty; rows that repeat an
    id and a text are one document and get the same result; an empty table gives no rows.  With
    ``spans_as`` the spans (line numbers, ends exclusive) are added under that name.
    """
    spans = spans_as or free_name(docs, "covered_lines")
    mine = free_name(docs, "text_print")
    # a set: repeated rows have the same windows, and only distinct ones are gathered
    lines = F.expr("array_sort(array_distinct(flatten(transform(collect_set(struct(first, last)), w -> sequence(w.first, w.last)))))")
    covered = repeated(docs, doc_id, text).groupBy("doc", "print").agg(lines.alias("c"))
    starts = "filter(c, (x, i) -> i = 0 OR get(c, i - 1) < x - 1)"
    ends = "transform(filter(c, (x, i) -> i = size(c) - 1 OR get(c, i + 1) > x + 1), x -> x + 1)"
    zipped = F.expr(f"zip_with({starts}, {ends}, (s, e) -> struct(s AS start, e AS end))")
    merged = covered.select("doc", "print", zipped.alias(spans))
    marked = docs.withColumn(mine, F.unhex(F.md5(text)))
    their_id, their_print = free_name(marked, "their_id"), free_name(marked, "their_print")
    merged = merged.withColumnsRenamed({"doc": their_id, "print": their_print})
    same = F.col(doc_id).eqNullSafe(F.col(their_id)) & F.col(mine).eqNullSafe(F.col(their_print))
    joined = marked.join(merged, same, "left").drop(their_id, their_print, mine)
    parts, at = f"split(`{text}`, '\\n', -1)", f"`{spans}`"
    kept = (
        f"flatten(transform(sequence(0, size({at})), j -> slice({parts}, coalesce(get({at}, j - 1).end, 0) + 1,"
        f" coalesce(get({at}, j).start, size({parts})) - coalesce(get({at}, j - 1).end, 0))))"
    )
    result = joined.withColumn(text, F.expr(f"CASE WHEN {at} IS NULL THEN `{text}` ELSE array_join({kept}, '\\n') END"))
    return result if spans_as else result.drop(spans)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, number of lines, of removed lines and spans, and the MD5 of what stays."""
    lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(text, "\n", -1)))
    done = dedup(docs.select(doc_id, text, lines.alias("n_lines")), doc_id, text, "spans")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))
    gone = F.aggregate(spans, F.lit(0), lambda a, s: a + s["end"] - s["start"])
    return done.select(
        doc_id,
        F.col("n_lines").cast("bigint").alias("n_lines"),
        gone.cast("bigint").alias("n_removed"),
        F.size(spans).cast("bigint").alias("n_spans"),
        F.md5(text).alias("kept_md5"),
    )
