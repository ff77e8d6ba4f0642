"""Removal of repeated passages by overlapping three-line windows.

Lines are the pieces of a text between line feeds. Every three consecutive
lines form a window with a 128-bit hash; of all windows with the same hash in
the whole table the first one stays (least doc_id, null ids last, then stored
row number and position), and the lines that any later one covers are removed.
Covered positions are merged, so a repeated passage of any length goes as one.
Only DataFrame functions are used.

With ``passage`` one line or two consecutive ones of more than that many words
form a window too, so long passages of one or two whole lines go as well,
whatever stands around them. The first copy of a line always stays, as all
windows have the same order. The query's SQL has three-line windows alone.

A window that very many documents share is counted with map-side partial
aggregation and joined back to one row per repeated window, which adaptive
execution splits if it is skewed.

Defined results: null texts stay null; texts of fewer than three lines have no
window without ``passage`` and stay as they are; windows of white space alone are not compared;
the windows of a repeated row are later occurrences; a text whose lines all go
becomes empty; other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import fresh, numbered, word_count

BLANK = " \t\r\x0b\x0c"
PASSAGE = 50  # words; longer passages of one or two lines are windows in the pipeline


def windows(rows: DataFrame, row: str, doc_id: str, text: str, passage: int | None = None) -> DataFrame:
    """(row, none, id, pos, span, w1, w2): a row for each window of ``span``
    lines with a visible character."""
    lines = F.split(F.col(text), "\n")
    words = (lambda x: [word_count(x).alias("words")]) if passage is not None else (lambda x: [])
    hashed = rows.select(F.col(row).alias("row"), F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"),
                         F.transform(lines, lambda x: F.struct(
                             F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b"),
                             (F.btrim(x, F.lit(BLANK)) != "").alias("seen"), *words(x))).alias("h"))

    def window(i):
        x, y, z = (F.get("h", i + k) for k in range(3))
        return F.struct(i.alias("pos"), F.lit(3).alias("span"), (x["seen"] | y["seen"] | z["seen"]).alias("seen"),
                        F.xxhash64(x["a"], y["a"], z["a"]).alias("w1"), F.xxhash64(x["b"], y["b"], z["b"]).alias("w2"))

    def long(i, span):
        parts = [F.get("h", i + k) for k in range(span)]
        many = sum((x["words"] for x in parts[1:]), parts[0]["words"]) > passage  # null past the last line
        return F.struct(i.alias("pos"), F.lit(span).alias("span"), many.alias("seen"),
                        F.xxhash64(F.lit(span), *(x["a"] for x in parts)).alias("w1"),
                        F.xxhash64(F.lit(span), *(x["b"] for x in parts)).alias("w2"))

    def found(least, spots):
        return (hashed.where(F.size("h") >= least).select("row", "none", "id", F.explode(spots).alias("w"))
                .where("w.seen").select("row", "none", "id", "w.pos", "w.span", "w.w1", "w.w2"))

    out = found(3, F.transform(F.sequence(F.lit(0), F.size("h") - 3), window))
    if passage is None:
        return out
    return out.union(found(1, F.flatten(F.transform(F.sequence(F.lit(0), F.size("h") - 1),
                                                    lambda i: F.array(long(i, 1), long(i, 2))))))


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_lines: str = "n_lines",
               n_removed: str = "n_removed", passage: int | None = None) -> DataFrame:
    """``docs`` with ``text`` rid of later occurrences, and the counts of lines
    before and removed (named by ``n_lines`` and ``n_removed``, which must be free)."""
    row, starts, kept = fresh(docs, "_row", "_starts", "_kept")
    rows = numbered(docs, "lines", row)
    found = windows(rows, row, doc_id, text, passage)
    first = (found.groupBy("w1", "w2").agg(F.min(F.struct("none", "id", "row", "pos")).alias("first"),
                                           F.count(F.lit(1)).alias("times"))
             .where("times > 1").select("w1", "w2", F.col("first.row").alias("first_row"), F.col("first.pos").alias("first_pos")))
    later = found.join(first, ["w1", "w2"]).where("row <> first_row or pos <> first_pos")
    covered = later.groupBy(F.col("row").alias(row)).agg(F.collect_set(F.struct("pos", "span")).alias(starts))
    lines = F.split(F.col(text), "\n")
    gone = F.flatten(F.transform(F.col(starts), lambda s: F.sequence(s["pos"], s["pos"] + s["span"] - 1)))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    out = rows.join(covered, row, "left").withColumn(kept, F.when(F.col(starts).isNotNull(), left))
    count = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long")
    return (out.withColumn(n_lines, count)
            .withColumn(n_removed, F.when(F.col(kept).isNull(), 0).otherwise(F.col(n_lines) - F.size(kept)).cast("long"))
            .withColumn(text, F.when(F.col(kept).isNull(), F.col(text)).otherwise(
                F.array_join(F.transform(F.col(kept), lambda i: F.get(lines, i)), "\n")))
            .drop(row, starts, kept))
