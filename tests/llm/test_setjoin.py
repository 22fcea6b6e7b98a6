"""What the set join compares: which pairs become candidates, and which of them are compared by their texts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import setjoin

U = np.uint64


@pytest.fixture
def long_texts(spark):
    """Thirty unrelated texts of 1,500 words that share a passage of 30, and an edited copy of each of the first five."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for i in range(30):
        words = [f"w{i}x{rng.random()}" for _ in range(1470)]
        at = rng.randrange(len(words))
        texts.append(words[:at] + passage + words[at:])
    for i in range(5):
        copy = list(texts[i])
        for _ in range(15):
            copy[rng.randrange(len(copy))] = f"e{rng.random()}"
        texts.append(copy)
    rows = [(i, " ".join(x)) for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def counting(monkeypatch, name, at):
    """From now on the rows that the function gets as its argument ``at`` are counted."""
    counts, real = [], getattr(setjoin, name)

    def counted(*args):
        counts.append(args[at].count())
        return real(*args)

    monkeypatch.setattr(setjoin, name, counted)
    return counts


def components_of(docs, settings):
    found = setjoin.with_components(setjoin.join_sets(docs, settings=settings)).collect()
    return {r.doc_id: r.component_id for r in found}


EXPECTED = {**{i: i for i in range(30)}, **{30 + i: i for i in range(5)}}


def test_frequency_table_grows_with_the_corpus(spark, long_texts, monkeypatch):
    """With 700 shingles a place no order could tell the passage from the rest, and it would make pairs of all texts."""
    candidates = counting(monkeypatch, "_verify", 2)
    assert components_of(long_texts, setjoin.Settings(buckets=64)) == EXPECTED
    assert sum(candidates) == 5


def test_parities_of_long_texts_rule_out_pairs(spark, long_texts, monkeypatch):
    """All shingles count as equally frequent, so the passage does make candidates; no text of theirs is compared."""
    monkeypatch.setattr(setjoin, "frequency_classes", lambda *args: np.zeros(1 << 20, "u1"))
    candidates = counting(monkeypatch, "_verify", 2)
    compared = counting(monkeypatch, "verified", 0)
    assert components_of(long_texts, setjoin.Settings()) == EXPECTED
    assert sum(candidates) > 50 and sum(compared) == 5


def test_parities_bound_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(200):
        sizes = rng.integers(0, 3000, 3)
        common, a, b = (rng.integers(0, 1 << 63, k, dtype=np.uint64) for k in sizes)
        x, y = (np.unique(np.concatenate([common, own])) for own in (a, b))
        apart = len(np.setxor1d(x, y))
        odd = [setjoin.parities(z) for z in (x, y)]
        assert setjoin.differing(*(z.tobytes() for z in odd)) <= apart
        few = [np.bincount(((z >> U(8)) & U(255)).astype(int), minlength=256) & 1 for z in (x, y)]
        assert [setjoin.folded(z, 32).tolist() for z in odd] == [np.packbits(z.astype("u1")).tolist() for z in few]


@pytest.mark.parametrize("buckets, places", [(64, 1 << 12), (1 << 14, 1 << 14), (1 << 16, 1 << 15)])
def test_frequency_classes(spark, buckets, places):
    """Counts sent in portions by several tasks, folded to the size of the corpus, are those of all shingles."""
    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(120))) for _ in range(60)] + [None, ""]
    s = setjoin.Settings(buckets=buckets, most_buckets=1 << 15, counted=300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    every = np.concatenate(setjoin.sets_of(pa.array(texts), s.width))
    assert 1 << 11 < len(every) <= 1 << 12
    counts = np.bincount((every >> U(64 - places.bit_length() + 1)).astype(int), minlength=places)
    found = setjoin.frequency_classes(setjoin.describe_sets(setjoin._rows(docs, "doc_id", "text"), s), len(every), s)
    assert found.tolist() == (8 * np.log2(counts + 1)).astype("u1").tolist()
    none = setjoin.describe_sets(setjoin._rows(docs.where("false"), "doc_id", "text"), s)
    assert not setjoin.frequency_classes(none, 0, s).any()
