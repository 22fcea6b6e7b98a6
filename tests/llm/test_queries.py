"""Registered queries against SQL, and the others against brute force over whole small tables."""

import re
import zlib

import pytest
import regex

from check import compare, oracle_connection
from tidemark.llm import licenses
from tidemark.llm.catalog import ORACLES, QUERIES, read


@pytest.fixture(scope="module")
def connection(medium):
    return oracle_connection(medium)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_oracle(spark, connection, medium, name):
    assert compare(spark, connection, medium, name) == ""


def test_control_conversation_is_read_back(spark, small):
    row = QUERIES["op3_chat"](spark, small).where("conv_id = -7").first()
    assert (row.n_turns, row.loss_chars) == (2, len(r"\### Assistant: </turn> ok"))


def test_decontamination_against_all_windows(spark, small):
    """Every window of every document against every item, on strings, without hashes or fingerprints."""

    def words(text):
        return [w for w in re.split(r"[^\w]|_", text.lower()) if w]

    def shingles(w):
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    def weight(some):
        return sum(len("".join(s)) for s in some)

    items = {r.item_id: words(r.text) for r in read(spark, small, "benchmark").collect()}
    owner = {}
    for item, w in items.items():
        for s in shingles(w):
            owner.setdefault(s, set()).add(item)
    expected = set()
    for row in read(spark, small, "documents").collect():
        w = words(row.text)
        near = {item for s in shingles(w) for item in owner.get(s, ())}
        for item in near:
            target, n = shingles(items[item]), len(items[item])
            for start in range(max(1, len(w) - n + 1)):
                own = shingles(w[start : start + n])
                if 100 * weight(own & target) >= 75 * weight(own | target):
                    expected.add((row.doc_id, item))
                    break
    found = {(r.doc_id, r.item_id) for r in QUERIES["op4_decontaminate"](spark, small).collect()}
    assert found == expected and expected


def brute_licences(text):
    low = (text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER))
    words = re.findall(licenses.WORD, low)
    places, base = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    labels, score = set(base), 0.8 if base else 0.0
    if text:
        low, found = re.sub(r"[ \t\n\x0b\f\r]+", " ", text.lower()), []
        for number, rule in enumerate(licenses.RULES):
            found += [(m.start(), m.end(), rule.priority, number, rule) for m in regex.finditer(rule.pattern, low)]
        for start, end, priority, number, rule in found:
            better = [
                o
                for o in found
                if o[0] <= start and o[1] >= end and o[2] <= priority and o[3] != number
                and ((o[0], -o[1], o[2], o[3]) < (start, -end, priority, number))
            ]
            if not better:
                labels.add(rule.label)
                score = max(score, rule.score)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


def test_licences_against_all_rules_without_gates(spark, small):
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op6_licenses"](spark, small).collect()}
    texts = {r.doc_id: r.text for r in read(spark, small, "documents").select("doc_id", "text").collect()}
    assert found == {i: brute_licences(t) for i, t in texts.items()}


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the Apache License, Version 2.0.", "apache-2"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
        ("Released under the MIT License. Licensed under CC BY-NC 4.0.", "cc-by-nc,mit"),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3"),
        ("see https://www.mozilla.org/MPL/2.0/", "mpl-2"),
        ("mit freundlichen Gruessen, license unknown", ""),
        (None, ""),
    ],
)
def test_licence_labels(spark, text, labels):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert licenses.scan(docs).first().labels == labels == brute_licences(text)[5]


def test_mixing_meets_the_targets(spark, medium):
    rows = QUERIES["op9_mixing"](spark, medium).collect()
    total = sum(r.n_tokens for r in rows)
    sums = [sum(r.n_tokens * r.rate * r.posterior[k] for r in rows) / total for k in range(3)]
    assert sums == pytest.approx([0.94, 0.02, 0.04], abs=1e-5)
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)


INSULT = re.compile("trash|idiot|worthless|pathetic|scum|loser|disgusting|stupid|moron|clown")


def test_toxicity_on_held_out_rows(spark):
    """Rows that were not trained on, at sf0.1; toxic texts without an English insult apart."""
    sf_dir = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in QUERIES["op10_toxicity"](spark, sf_dir).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    assert all(r.predicted == (r.score >= 0.7) for r in found.values())
    texts = {r.doc_id: r.text or "" for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    labels = {r.doc_id: r.toxic for r in read(spark, sf_dir, "labels").collect() if found[r.doc_id].held_out}
    english = {i for i, y in labels.items() if y == 1 and INSULT.search(texts[i].lower())}
    other = {i for i, y in labels.items() if y == 1} - english
    ordinary = {i for i, y in labels.items() if y == 0}
    share = {name: sum(found[i].predicted for i in some) / len(some) for name, some in (("en", english), ("other", other), ("ordinary", ordinary))}
    assert share["en"] >= 0.9 and share["other"] >= 0.85 and share["ordinary"] <= 0.02, share
    scores = sorted(found[i].score for i in ordinary)
    limit = scores[int(0.9 * len(scores))]
    assert sum(found[i].score > limit for i in english | other) >= 0.92 * len(english | other)
