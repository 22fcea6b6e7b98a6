"""Values as people write them, whole tables without prefilters, and long texts."""

import re
import time

import pytest

from tests.conftest import SMALL
from tidemark.llm import pii
from tidemark.llm.catalog import read

P = pii.Pseudonyms(b"key")


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("1990-03-05T10:00:00Z", "date", "1990-03-05"),
        ("born 2023-1-5.", "date", "2023-1-5"),
        ("on 2023-11-5", "date", "2023-11-5"),
        ("Password: Hunter2x", "secret", "Hunter2x"),
        ("PASSWORD=hunter2x", "secret", "hunter2x"),
        ("passwd=hunter2x", "secret", "hunter2x"),
        ("password = hunter2x", "secret", "hunter2x"),
        ('password="hunter2x"', "secret", "hunter2x"),
        ("password=hunter-xyz1", "secret", "hunter-xyz1"),
        ('{"api_key": "ab12-cd34"}', "secret", "ab12-cd34"),
        ("Token: abc.def_123", "secret", "abc.def_123"),
        ("josé@example.com", "email", "josé@example.com"),
        ("<a.b+c@mail.example.org>", "email", "a.b+c@mail.example.org"),
    ],
)
def test_usual_spellings(text, kind, value):
    found = pii.find(text, P)
    assert [(text[a:b], k) for a, b, k, _ in found] == [(value, kind)]
    new = found[0][3]
    assert new != value and len(new) == len(value) and getattr(P, kind)(new, back=True) == value


@pytest.mark.parametrize("text", ["a@b", "@", "x@@y.com", "the password is secret", "token: abc", "2023-13-45", "2023-01-5", "z" * 100 + "@"])
def test_no_value(text):
    assert pii.find(text, P) == []


def test_no_overlaps_and_no_loss_of_other_text(spark):
    """Every text of the table: spans are in order, what lies outside them stays, and pseudonyms lead back."""
    for row in read(spark, SMALL, "documents").collect():
        text, found = row.text or "", pii.find(row.text or "", P)
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
        new, spans = pii.replace(row.text, P)
        at = shift = 0
        for (start, end, kind, value), span in zip(found, spans, strict=True):
            assert new[at + shift : span["start"]] == text[at:start]
            assert new[span["start"] : span["start"] + span["length"]] == value
            assert getattr(P, kind)(value, back=True) == text[start:end]
            at, shift = end, span["start"] + span["length"] - end


def test_whole_table_without_prefilters(spark):
    """Every match of every pattern anywhere, validated, is covered by some value found."""
    for row in read(spark, SMALL, "documents").collect():
        text = row.text or ""
        covered = [(a, b) for a, b, _, _ in pii.find(text, P)]
        for kind, pattern in pii.PATTERNS:
            if kind == "card":
                continue  # cards beside other numbers have their own tests
            for match in re.finditer(pattern, text):
                start, end = match.span(1 if kind == "secret" else 0)
                if getattr(P, kind)(text[start:end]) is not None:
                    assert any(a < end and start < b for a, b in covered), (kind, match[0])


@pytest.mark.parametrize(
    "text",
    ["A1b2" * 250_000 + "@example.com", "ab@" * 300_000, "2024-01-15 " * 60_000, "password=" + "x" * 900_000, "0123456789abcdef" * 60_000, "1 2 " * 200_000, "a.b@c.org " * 60_000],
)
def test_a_megabyte_takes_seconds(text):
    started = time.time()
    pii.replace(text, P)
    assert time.time() - started < 20
