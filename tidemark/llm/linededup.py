"""Removal of repeated passages: windows of three consecutive lines, found again anywhere in the corpus.

Lines are compared without surrounding blanks; blank lines belong to no window but go when they lie inside a removed
stretch. A passage repeated within other lines, or in a text of fewer than three, is not seen. A window's first occurrence is the one smallest by (doc_id, text hash, line); every line inside a later
occurrence is removed, after overlapping and touching occurrences have been merged into stretches.

Plan: windows are 16 bytes of hash and a place, combined by hash before the shuffle; only hashes that occur twice are
joined back. A very frequent window is one row on the small side of that join, so its occurrences can be split.

Defined results: a null text stays null; a text of fewer than three lines with content stays as it is; rows equal in
doc_id and text are one document written twice, and treated alike; a document whose lines all go keeps an empty text;
an empty table gives an empty result; other columns pass through and cannot clash with this module's names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import written

WIDTH = 3
DOC, HASH, CUTS = "tidemark_doc", "tidemark_hash", "tidemark_cuts"
BLANK = " \t\r\x0b\x0c"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each run of three lines with content: doc, hash of its text, two hashes of the run, first, last."""
    numbered = F.transform(
        lines_of(F.col(text_col)),
        lambda line, i: F.struct(i.alias("at"), F.trim(line, F.lit(BLANK)).alias("line")),
    )
    rows = docs.select(
        F.col(id_col).alias(DOC),
        F.xxhash64(text_col).alias(HASH),
        F.filter(numbered, lambda x: x["line"] != "").alias("lines"),
    ).where(F.size("lines") >= WIDTH)

    def run(i: Column) -> Column:
        own = [F.get(F.col("lines"), i + k) for k in range(WIDTH)]
        text = [x["line"] for x in own]
        return F.struct(
            F.xxhash64(*text).alias("w1"),
            F.xxhash64(F.lit(7), *text).alias("w2"),
            own[0]["at"].alias("first"),
            own[-1]["at"].alias("last"),
        )

    runs = F.transform(F.sequence(F.lit(0), F.size("lines") - WIDTH), run)
    return rows.select(DOC, HASH, F.inline(runs))


def stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with a later occurrence: its merged stretches as arrays of first and last lines, in order."""
    every = windows(docs, id_col, text_col)
    repeated = (
        every.groupBy("w1", "w2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(DOC, HASH, "first")).alias("origin"))
        .where("n > 1")
    )
    later = every.join(repeated.select("w1", "w2", "origin"), ["w1", "w2"]).where(
        ~F.struct(DOC, HASH, "first").eqNullSafe(F.col("origin"))
    )
    by_doc = Window.partitionBy(DOC, HASH).orderBy("first")
    reach = F.max("last").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.col("starts").cast("int")).over(by_doc.rowsBetween(Window.unboundedPreceding, 0))
    return (
        later.select(DOC, HASH, "first", "last")
        .withColumn("starts", F.coalesce(F.col("first") > reach + 1, F.lit(True)))
        .withColumn("island", island)
        .groupBy(DOC, HASH, "island")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .groupBy(DOC, HASH)
        .agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias(CUTS))
    )


def without(lines: Column, cuts: Column) -> Column:
    """The lines outside the sorted, disjoint cuts: the pieces between neighbours, put together."""

    def piece(i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(cuts, i - 1)["last"] + 1)
        end = F.when(i == F.size(cuts), F.size(lines)).otherwise(F.get(cuts, i)["first"])
        return F.slice(lines, start + 1, end - start)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(cuts)), piece))


def cut_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the struct column ``CUTS`` holding text (shortened), n_lines and n_removed."""
    found = written(stretches(docs, id_col, text_col), "stretches")
    found = found.select(F.struct(DOC, HASH, CUTS).alias(CUTS)).hint("merge")  # the same plan at every size
    same = F.col(id_col).eqNullSafe(F.col(f"{CUTS}.{DOC}")) & F.xxhash64(text_col).eqNullSafe(F.col(f"{CUTS}.{HASH}"))
    cuts, lines = F.col(f"{CUTS}.{CUTS}"), lines_of(F.col(text_col))
    removed = F.aggregate(cuts, F.lit(0), lambda n, c: n + c["last"] - c["first"] + 1)
    joined = docs.join(found, same, "left")
    return joined.withColumn(
        CUTS,
        F.struct(
            F.when(cuts.isNull(), F.col(text_col)).otherwise(F.array_join(without(lines, cuts), "\n")).alias("text"),
            F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        ),
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns as they were, with later occurrences cut out of the text."""
    return cut_lines(docs, id_col, text_col).select(
        *[F.col(f"{CUTS}.text").alias(name) if name == text_col else F.col(name) for name in docs.columns]
    )
