"""Ranked search against a plain scorer: ties, repeated and null rows, hot strata, several query blocks."""

import random

import pytest

from tests.llm import brute
from tidemark.llm import ranked

DOCS, ITEMS = "doc_id long, text string, score long, m int", "item_id long, text string, rank int"


def search(spark, docs, items, settings):
    d = spark.createDataFrame([(*row, 1, 2) for row in docs], DOCS).repartition(4)
    i = spark.createDataFrame([(*row, 1) for row in items], ITEMS)
    return sorted(tuple(r) for r in ranked.search(ranked.build_index(d, settings), i, settings).collect())


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ärger", "ärger", "O'Neil", "x_y", "naïve", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(rng.randrange(300), " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 2, 5, 5, 40, 300])))) for _ in range(n)]
    docs += [(i, "w1 w2 w3 w4 w5") for i in range(500, 640)]  # one stratum of copies, all scores equal
    docs += [(None, "w7 w8"), (901, None), (902, ""), (903, " .,- "), (904, "W9\x00w9 W9"), (905, "w50 " * 5000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 12])))) for i in range(25)]
    items += [(100, None), (101, "..."), (102, "never seen"), (None, "w1"), (103, "w1"), (103, "W2 w1"), (104, "w1 w2 w3 w4 w5")]
    return docs, items


@pytest.mark.parametrize(
    "settings",
    [
        ranked.Settings(),
        ranked.Settings(top=7, block_postings=16, first_strata=1),
        ranked.Settings(top=3, block_postings=64, first_strata=2, block_pairs=10),
    ],
)
def test_against_a_plain_scorer(spark, settings):
    docs, items = corpus(3)
    assert search(spark, docs, items, settings) == brute.ranked(docs, items, settings.top)


def test_small_gathers_and_slices(spark, monkeypatch):
    monkeypatch.setattr(ranked, "GATHERED", 50)
    monkeypatch.setattr(ranked, "TEXT_BYTES", 64)
    docs, items = corpus(4, 100)
    assert search(spark, docs, items, ranked.Settings(top=5)) == brute.ranked(docs, items, 5)


def test_empty_sides(spark):
    docs, items = corpus(5, 20)
    assert search(spark, [], items, ranked.Settings()) == []
    assert search(spark, docs, [], ranked.Settings()) == []
    assert search(spark, [(1, None), (2, "--")], items, ranked.Settings()) == []


def test_blocks_hold_one_stratum_and_bounded_postings(spark):
    docs, _ = corpus(6)
    index = ranked.build_index(spark.createDataFrame([(*row, 1, 2) for row in docs], DOCS), ranked.Settings(block_postings=100))
    rows = index.blocks.collect()
    assert len([r for r in rows if len(r.doc_ids) > 100]) == 0
    assert sum(len(r.doc_ids) for r in rows) == index.n_docs == sum(bool(brute.terms(t)) for _, t in docs)
    for r in rows:
        tfs = [r.run_tfs[a:b] for a, b in zip(r.term_runs, r.term_runs[1:])]
        assert r.terms == sorted(r.terms) and all(x == sorted(set(x)) for x in tfs)


def test_bounds_rule_out_blocks():
    """A block whose bound stays below what an item needs is not scored."""
    import numpy as np

    batch = ranked.block_of(100, [1, 2], np.array([5, 5, 9]), np.array([1, 3, 1]), np.array([0, 1, 1]))
    block = ranked.Block(batch, 0)
    items = ranked.Items(np.array([5, 9]), np.array([0, 0]), np.array([0, 1]), np.array([10.0, 20.0]), np.zeros(1), None)
    best = ranked.Best(np.zeros(1), 50)
    ranked.visit(block, items, best)
    found = dict(zip(best.cut()[1].tolist(), best.cut()[2].tolist()))
    impact = lambda tf: 1_000_000_000 * tf // (1000 * tf + 2000)
    assert found == {1: 10 * impact(1), 2: 10 * impact(3) + 20 * impact(1)}
    best = ranked.Best(np.array([found[2] + 1.0]), 50)
    ranked.visit(block, items, best)
    assert not len(best.cut()[0])
