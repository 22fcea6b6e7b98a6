"""Planted windows near the limit, and the number of pairs with a large benchmark."""

import random

from pyspark.sql import functions as F

from tidemark.llm import decontaminate as d

ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string"


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similarity(a, b):
    weight = lambda some: sum(len("".join(s)) for s in some)
    return weight(shingles(a) & shingles(b)) / weight(shingles(a) | shingles(b))


def made(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def test_no_planted_window_near_the_limit_is_lost(spark):
    """Items with one or more words replaced, dropped or put in, inside other text, at similarity 0.75 to 0.85."""
    rng = random.Random(8)
    items = {i: made(rng, rng.randint(30, 90)) for i in range(60)}
    docs, expected = [], set()
    for doc in range(600):
        item = rng.randrange(60)
        copy = list(items[item])
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(copy))
            kind = rng.randrange(3)
            copy[at : at + 1] = [made(rng, 1)[0]] if kind == 0 else [] if kind == 1 else [copy[at], made(rng, 1)[0]]
        text = made(rng, rng.randint(0, 40)) + copy + made(rng, rng.randint(0, 40))
        n = len(items[item])
        best = max(similarity(text[i : i + n], items[item]) for i in range(max(1, len(text) - n + 1)))
        docs.append((doc, " ".join(text)))
        if best >= 0.75:
            expected.add((doc, item, best < 0.85))
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], ITEMS)
    found = d.best_hits(d.find(spark.createDataFrame(docs, DOCS), benchmark))
    assert {(r[0], r.item_id) for r in found.collect()} == {(a, b) for a, b, _ in expected}
    assert sum(near for _, _, near in expected) > 50


def test_pairs_follow_true_candidates(spark, monkeypatch):
    """20,000 items of equal length that share their first words, and documents that all hold these words."""
    opening = "what is the answer to the following question of this test"
    n = 20_000
    body = lambda column: F.concat_ws(" ", *[F.hex(F.xxhash64(column, F.lit(k))) for k in range(30)])
    items = spark.range(n).select(F.col("id").alias("item_id"), F.concat_ws(" ", F.lit(opening), body("id")).alias("text"))
    plain = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit(opening), body(F.col("id") + n)).alias("text"))
    copies = items.where("item_id < 50").select((F.col("item_id") + 1000).alias("doc_id"), F.concat(F.lit("so "), "text").alias("text"))
    sizes = {}
    write = d.written
    monkeypatch.setattr(d, "written", lambda df, purpose: sizes.setdefault(purpose, write(df, purpose)))
    found = d.best_hits(d.find(plain.union(copies), items))
    assert {(r[0], r.item_id) for r in found.collect()} == {(i + 1000, i) for i in range(50)}
    assert sizes["pairs"].count() == 50 and sizes["windows"].count() == 50 and sizes["windows-around"].count() == 0


def test_short_items_and_documents(spark):
    benchmark = spark.createDataFrame([(1, "one two three"), (2, "Zwei"), (3, None), (4, " "), (5, "a b c d e f g h")], ITEMS)
    docs = spark.createDataFrame([(1, "x one two three y"), (2, "zwei"), (3, "a b c d e f g h"), (4, "one two"), (None, "b c d e f g h i"), (6, None), (1, "x one two three y")], DOCS)
    hits = d.best_hits(d.find(docs, benchmark))
    assert sorted((r[0] or 0, r.item_id) for r in hits.collect()) == [(1, 1), (2, 2), (3, 5)]
    kept = d.clean(docs, benchmark)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 6]
