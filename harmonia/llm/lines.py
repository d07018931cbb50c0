"""Operator 10: line dedup by overlapping three-line windows (DataFrame functions only).

Each run of three consecutive lines is hashed (128 bits of MD5 over the
lines, which cannot hold a line feed).  A window found more than once
anywhere is repeated; all but its first occurrence (smallest doc_id, then
position) are later ones.  The lines covered by later occurrences, merged
over overlapping windows, are removed.  Windows of blank lines only do not
count.

Cases: null text stays null; texts under three lines are unchanged; a text
whose lines all go becomes empty; a document is a doc_id with a text (128
bits of its MD5): rows that repeat both count as one, rows of one doc_id, or
of none, with different texts are different documents; null doc_id sorts
first, then the text's MD5 decides; other columns are passed through (``_n_lines``, ``_n_removed`` and ``_n_spans`` are replaced); no rows: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmonia.llm.common import fresh

WINDOW = 3


def _identity(doc_id: str, text: str) -> Column:
    """What tells documents apart, in their order: doc_id, then the text."""
    return F.struct(F.col(doc_id).alias("id"), F.unhex(F.md5(F.col(text))).alias("t"))


def _windows(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    lines = F.split(F.col(text), "\n", -1)
    at = docs.select(_identity(doc_id, text).alias("d"), lines.alias("lines")).filter(F.size("lines") >= size)
    run = F.transform(F.sequence(F.lit(0), F.size("lines") - size), lambda i: F.struct(
        i.alias("pos"), F.array_join(F.slice("lines", i + 1, size), "\n").alias("body")))
    return (at.select("d", F.explode(F.filter(run, lambda r: F.trim(F.translate(r["body"], "\n\r\t", "   ")) != ""))
                      .alias("r"))
            .select("d", F.col("r.pos").alias("pos"), F.unhex(F.md5(F.col("r.body"))).alias("w")))


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Per document ``d`` (doc_id and digest of the text) the sorted positions of lines that
    later occurrences cover: ``d, gone``.

    Repeats are found by a partially aggregated count; hot windows meet in
    a join whose large partitions Spark can split.
    """
    occ = _windows(docs, doc_id, text, size)
    first = (occ.groupBy("w").agg(F.min(F.struct("d", "pos")).alias("f"), F.count("*").alias("n"))
             .filter("n > 1").select("w", "f"))
    later = (occ.join(first, "w").filter(~F.struct("d", "pos").eqNullSafe(F.col("f")))
             .groupBy("d").agg(F.collect_set("pos").alias("at")))
    covered = F.flatten(F.transform("at", lambda p: F.sequence(p, p + (size - 1))))
    return later.select("d", F.array_sort(F.array_distinct(covered)).alias("gone"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` with the cleaned ``text``, plus ``_n_lines``,
    ``_n_removed`` and ``_n_spans`` (runs of removed lines)."""
    who, out, parts = fresh(docs, "_d"), fresh(docs, "_gone"), fresh(docs, "_lines")
    gone = repeated_lines(docs, doc_id, text, size).withColumnsRenamed({"d": who, "gone": out})
    got = docs.join(gone, F.col(doc_id).eqNullSafe(F.col(f"{who}.id")) & (F.unhex(F.md5(F.col(text))) == F.col(f"{who}.t")), "left")
    none = F.array().cast("array<int>")
    got = got.withColumn(out, F.coalesce(out, none)).withColumn(parts, F.split(F.col(text), "\n", -1))
    # walk over the kept positions only: the complement of the removed ones
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(out))
    new = F.when(F.size(out) == 0, F.col(text)).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col(parts), i)), "\n"))
    starts = F.array_except(F.col(out), F.transform(F.col(out), lambda i: i + 1))
    return got.withColumns({
        text: new, "_n_lines": F.coalesce(F.size(parts), F.lit(0)).cast("bigint"),
        "_n_removed": F.size(out).cast("bigint"), "_n_spans": F.size(starts).cast("bigint"),
    }).drop(who, out, parts)
