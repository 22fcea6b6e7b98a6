"""Benchmark decontamination: item-sized windows, SimHash, exact similarity.

Words are runs of letters and digits in lower case; a shingle is five words (a shorter item: all its words) and weighs
as many as its words have characters. A window of a document is as many words as a benchmark item has, placed so that a
shingle the two share falls on the same word of both; every window similar to an item shares one. A window's SimHash is
64 bits, each the sign of the weighted vote of its shingles' hashes. Windows whose print is within ``RADIUS`` bits of the
item's are verified exactly: shared weight over united weight of the shingle sets, at least ``similarity``.

Candidates are pairs of document and item that share a shingle of the item's prefix: its shingles in the order of how many
items hold them, rarest first, up to more than the weight that a similar window can lack. A window of enough similarity
shares one of these, and a shingle that many items share is in few prefixes, so the number of pairs follows the true
candidates and not the product of windows and items. All joins are by equality; no list grows with a document.

Anchoring at shared shingles takes the place of a fingerprint at every word, which plain SQL functions can only sum
afresh for each window. Where a pair shares enough weight but no such window is similar enough, windows at every word
between two alignments at most half an item apart and up to a quarter of an item beyond the outermost are tried as well.

The benchmark is the query set. Its shingles are broadcast in portions of at most ``portion`` rows, one pass over the
documents each.

Defined results: null or empty texts and items match nothing; a document shorter than an item is one window; equal rows
give equal rows of hits once; empty tables give no hits; extra columns pass through ``clean`` and do not clash.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import written

WIDTH = 5
BITS, RADIUS = 64, 26
DOC, HASH = "tidemark_doc", "tidemark_hash"
SEPARATORS = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SEPARATORS, -1), lambda w: w != "")


def runs(words: Column, make, width: int = WIDTH) -> Column:
    """``make`` of each run's words, first to last; a shorter sequence is one run."""
    n = F.size(words)
    whole = F.transform(
        F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))), lambda i: make(F.slice(words, i + 1, width), i)
    )
    return F.when(n >= 1, whole).otherwise(F.filter(whole, lambda _: F.lit(False)))


def run_hashes(words: Column, width: int = WIDTH) -> Column:
    """The runs' hashes in order; the separate words of a run hash faster than a slice of the array."""
    n = F.size(words)
    whole = F.transform(
        F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]),
    )
    return F.when(n >= 1, whole).otherwise(F.array().cast("array<bigint>"))


def weighted_runs(words: Column) -> Column:
    """Distinct shingles as structs of hash and weight."""
    return F.array_distinct(
        F.zip_with(
            run_hashes(words),
            runs(words, lambda own, _: F.length(F.array_join(own, ""))),
            lambda h, w: F.struct(h.alias("h"), w.alias("w")),
        )
    )


def fingerprint(shingles: Column) -> Column:
    """The SimHash: bit b is set if shingles with it outweigh those without."""
    bit = lambda b: F.aggregate(
        shingles, F.lit(0), lambda a, s: a + F.when(F.getbit(s["h"], b) == 1, s["w"]).otherwise(-s["w"])
    )
    bits = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.when(bit(b) > 0, b))
    return F.aggregate(
        F.filter(bits, lambda b: b.isNotNull()),
        F.lit(0).cast("long"),
        lambda a, b: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)),
    )


def items_of(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, n_words, shingles, total weight and fingerprint of each item with a word."""
    words = benchmark.select(
        F.col(id_col).alias("item_id"), words_of(F.coalesce(F.col(text_col), F.lit(""))).alias("words")
    ).where(F.size("words") > 0)
    shingled = words.select(
        "item_id", F.size("words").alias("n_words"), "words", weighted_runs(F.col("words")).alias("shingles")
    )
    return shingled.select(
        "item_id",
        "n_words",
        run_hashes(F.col("words")).alias("runs"),
        "shingles",
        fingerprint(F.col("shingles")).alias("print"),
    )


def place(size: Column, at: Column, n_words: Column, offset: Column) -> Column:
    """Where a window begins, moved inside the document."""
    return F.greatest(F.lit(0), F.least(at - offset, size - n_words))


def total(shingles: Column) -> Column:
    return F.aggregate(shingles, F.lit(0), lambda a, s: a + s["w"])


def prefixes(items: DataFrame, similarity: int) -> DataFrame:
    """item_id and h: an item's rarest shingles, of which every similar window holds one.

    A window of enough similarity holds shingles of at least ``similarity`` percent of the item's weight. Those before a
    shingle weigh together at most the rest in all of these, so not all of them can be lacking.
    """
    each = items.select("item_id", "weight", F.explode("shingles").alias("s")).select("item_id", "weight", "s.*")
    owners = each.groupBy("h").agg(F.count("*").alias("owners"))
    in_order = Window.partitionBy("item_id").orderBy("owners", "h").rowsBetween(Window.unboundedPreceding, 0)
    summed = each.join(owners, "h").withColumn("before", F.sum("w").over(in_order) - F.col("w"))
    return summed.where(100 * F.col("before") <= (100 - similarity) * F.col("weight")).select("item_id", "h")


def shingle_places(docs: DataFrame, widths: list[int]) -> list[tuple[int, DataFrame]]:
    """For each width: doc, hash, size in words, at and h of every run of words."""
    size = F.size("words").alias("size")
    places = lambda width: F.posexplode(run_hashes(F.col("words"), width)).alias("at", "h")
    return [(width, docs.select(DOC, HASH, size, places(width))) for width in widths]


def same(left: str, right: str, *names: str) -> Column:
    """Equal in all columns, null counting as a value."""
    return reduce(Column.__and__, [F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}")) for name in names])


def width_of(n_words: Column) -> Column:
    return F.least(n_words, F.lit(WIDTH))


def around(windows: DataFrame) -> DataFrame:
    """Windows at every word between two of a pair's windows at most half an item apart, and a quarter beyond the outermost.

    Words put in or left out shift what follows, so the best window may lie between two alignments or a little beyond them.
    """
    in_order = Window.partitionBy(DOC, HASH, "item_id").orderBy("start")
    half, quarter = F.expr("n_words div 2"), F.expr("n_words div 4")
    to_next = F.lead("start").over(in_order) - F.col("start")
    to_last = F.col("start") - F.lag("start").over(in_order)
    low = F.when(to_last <= half, F.col("start")).otherwise(F.greatest(F.lit(0), F.col("start") - quarter))
    end = F.greatest(F.col("start"), F.least(F.col("start") + quarter, F.col("size") - F.col("n_words")))
    high = F.when(to_next <= half, F.col("start") + to_next - 1).otherwise(end)
    spread = windows.withColumns({"low": low.cast("int"), "high": high.cast("int")})
    return spread.withColumn("start", F.explode(F.sequence("low", "high"))).drop("low", "high").distinct()


def shingle_sets(windows: DataFrame, texts: DataFrame, widths: list[int]) -> DataFrame:
    """The distinct shingles of every window, as structs of hash and weight.

    Only the places that windows cover are hashed; a document's list of them is no longer than its list of words.
    """
    last = F.greatest(F.col("start"), F.least(F.col("start") + F.col("n_words"), F.col("size")) - F.col("width"))
    spread = windows.withColumn("at", F.explode(F.sequence("start", last.cast("int"))))
    wanted = spread.select(DOC, HASH, "width", "at").distinct().groupBy(DOC, HASH, "width").agg(F.collect_list("at").alias("ats"))
    words = F.col("words")

    def shingle(at: Column) -> Column:
        hashed, weight = F.lit(None).cast("long"), F.lit(None).cast("int")
        for width in widths:
            own = [F.get(words, at + k) for k in range(width)]
            mine = F.col("width") == width
            hashed = F.when(mine, F.xxhash64(*own)).otherwise(hashed)
            length = sum((F.coalesce(F.length(word), F.lit(0)) for word in own), F.lit(0))
            weight = F.when(mine, length).otherwise(weight)
        return F.struct(at.alias("at"), hashed.alias("h"), weight.alias("w"))

    rows = wanted.alias("x").join(texts.alias("t"), same("x", "t", DOC, HASH)).select(f"x.{DOC}", f"x.{HASH}", "width", "ats", "words")
    places = rows.select(DOC, HASH, "width", F.explode(F.transform("ats", shingle)).alias("s")).select(DOC, HASH, "width", "s.*")
    each = spread.alias("w").join(places.alias("p"), same("w", "p", DOC, HASH, "width", "at")).select("w.*", "h", "p.w")
    key = (DOC, HASH, "item_id", "n_words", "start")
    return each.groupBy(*key).agg(F.collect_set(F.struct("h", "w")).alias("shingles"))


def verified(sets: DataFrame, items: DataFrame, similarity: int) -> DataFrame:
    """Windows whose print is within ``RADIUS`` bits of their item's and whose shingles are similar enough."""
    own = items.select("item_id", "print", "weight", F.col("shingles").alias("item_shingles"))
    hamming = F.bit_count(F.col("print").bitwiseXOR(fingerprint(F.col("shingles"))))
    united = total(F.col("shingles")) + F.col("weight") - F.col("shared")
    return (
        sets.join(own, "item_id")
        .withColumn("hamming", hamming)
        .where(F.col("hamming") <= RADIUS)
        .withColumn("shared", total(F.array_intersect("shingles", "item_shingles")))
        .withColumn("united", united)
        .where(100 * F.col("shared") >= similarity * F.col("united"))
        .select(DOC, HASH, "item_id", "start", "n_words", "hamming", "shared", "united")
    )


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    similarity: int = 75,
    portion: int = 1_000_000,
) -> DataFrame:
    """doc, text hash, item_id, start, n_words, hamming, shared and united weight of every verified window."""
    items = written(items_of(benchmark, item_id, item_text).withColumn("weight", total(F.col("shingles"))), "items")
    anchors = written(items.select("item_id", "n_words", F.posexplode("runs").alias("offset", "h")), "anchors")
    prefix = written(prefixes(items, similarity), "prefixes")
    widths = [r[0] for r in items.select(width_of(F.col("n_words"))).distinct().orderBy(width_of(F.col("n_words"))).collect()]
    named = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias(DOC), F.xxhash64(text_col).alias(HASH), F.col(text_col).alias("whole")
    )
    rows = named.select(DOC, HASH, words_of(F.col("whole")).alias("words"))

    # where shingles of the benchmark stand
    known = anchors.select("h", width_of(F.col("n_words")).alias("width")).distinct()
    parts = max(1, math.ceil(known.count() / portion))
    found = []
    for width, places in shingle_places(rows, widths):
        own = known.where(F.col("width") == width).select("h")
        for part in range(parts):
            some = own.where(F.pmod("h", F.lit(parts)) == part) if parts > 1 else own
            found.append(places.join(F.broadcast(some), "h").select(DOC, HASH, "size", F.lit(width).alias("width"), "at", "h"))
    empty = f"{DOC} {docs.schema[id_col].dataType.simpleString()}, {HASH} long, size int, width int, at int, h long"
    places = reduce(DataFrame.union, found) if found else docs.sparkSession.createDataFrame([], empty)
    places = written(places.distinct(), "places")

    # pairs of document and item that share enough weight at all, and their windows
    pairs = places.join(prefix, "h").select(DOC, HASH, "item_id").distinct()
    weights = items.select("item_id", "weight", F.explode("shingles").alias("s")).select("item_id", "weight", "s.*")
    wanted = pairs.join(anchors, "item_id").withColumn("width", width_of(F.col("n_words")))
    aligned = places.alias("p").join(wanted.alias("w"), same("p", "w", DOC, HASH, "width", "h"))
    start = place(F.col("size"), F.col("at"), F.col("n_words"), F.col("offset"))
    aligned = aligned.select(f"p.{DOC}", f"p.{HASH}", "item_id", "n_words", "size", "p.width", "p.h", start.alias("start"))
    aligned = written(aligned, "aligned")
    shared = aligned.select(DOC, HASH, "item_id", "h").distinct().join(weights, ["item_id", "h"])
    shared = shared.groupBy(DOC, HASH, "item_id", "weight").agg(F.sum("w").alias("w"))
    pairs = written(shared.where(100 * F.col("w") >= similarity * F.col("weight")).select(DOC, HASH, "item_id"), "pairs")
    first = aligned.drop("h").distinct().alias("a")
    first = first.join(pairs.alias("b"), same("a", "b", DOC, HASH, "item_id"), "left_semi").select("a.*")
    first = written(first, "windows")

    touched = pairs.select(DOC, HASH).distinct()
    texts = named.alias("d").join(touched.alias("t"), same("d", "t", DOC, HASH), "left_semi").groupBy(DOC, HASH)
    texts = texts.agg(F.first("whole").alias("whole")).select(DOC, HASH, words_of(F.col("whole")).alias("words"))
    texts = written(texts, "touched")
    hits = written(verified(shingle_sets(first, texts, widths), items, similarity), "hits-aligned").alias("h")
    rest = first.alias("w").join(hits, same("w", "h", DOC, HASH, "item_id"), "left_anti")
    more = written(around(rest), "windows-around")
    return hits.select("h.*").unionByName(verified(shingle_sets(more, texts, widths), items, similarity))


def best_hits(hits: DataFrame) -> DataFrame:
    """One row for each document and item: the most similar window, the first of equals."""
    score = F.col("shared") / F.col("united")
    best = F.max(F.struct(score.alias("similarity"), (-F.col("start")).alias("back"), "n_words", "hamming"))
    return hits.groupBy(DOC, HASH, "item_id").agg(best.alias("best"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, all columns as they were, in which no item was found."""
    hits = written(find(docs, benchmark, id_col, text_col, **options).select(DOC, HASH).distinct(), "hits")
    same = F.col(id_col).eqNullSafe(F.col(DOC)) & F.xxhash64(text_col).eqNullSafe(F.col(HASH))
    return docs.join(hits, same, "left_anti")
