"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text: one of toxic windows, one of ordinary windows. A window is one word
between blanks, between pads that both dictionaries hold, so that even a short word is compressed and not merely stored. A
window that the toxic dictionary makes shorter than the ordinary one does gains that many bytes. The gains of all windows of
the whole text, counted by size, are calibrated into a score by a logistic curve, which is fitted on gains under dictionaries
of other labelled rows.

The labels mark texts, not windows, and most windows of a toxic text are ordinary. The toxic dictionary therefore takes those
windows of toxic texts that hold a part of 5 to 8 characters (blanks around the word included) which the likelihood ratio of
text counts ties to toxic texts: parts, not words, because an inflected word is rare in each of its forms. The commonest
windows stand last, nearest to what is compressed, in both dictionaries.

Dictionaries and curve are fitted on at most ``train_rows`` labelled rows a class, chosen by a hash of their ids, and of
these on texts of at most ``train_chars`` characters, so what the driver holds is bounded; every row is scored on its whole
text.

Defined results: a null or empty text has no gain and gets the score of none; without labels of both classes the
scores are 0; of several texts under one labelled id the smallest is trained on; equal texts score alike; a word longer than
``PIECE`` characters is several windows; an empty table gives an empty result; label, language, source and id are no input
of a score; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCORES = "doc_id long, score double"
WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PAD = bytes(range(1, 32))  # no word holds these bytes
TAIL = PAD[:12]  # zstandard looks for no match that begins in the last 8 bytes
PIECE = 64  # characters
PARTS = range(5, 9)  # characters
KNOWN = 1 << 17  # windows whose gain a task remembers
STEPS = (1, 2, 3, 4, 5, 6)  # bytes


@dataclass(frozen=True)
class Settings:
    train_rows: int = 2000  # labelled rows a class
    train_chars: int = 1 << 15  # longer texts are scored but not trained on
    dictionary: int = 8 << 10
    lift: float = 4.0
    ratio: float = 15.0  # likelihood ratio of a marked part
    level: int = 9
    ridge: float = 1e-4
    threshold: float = 0.7


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    level: int


def windows(text: str | None) -> Iterator[str]:
    """The lower-cased words of a text between blanks, long ones in pieces."""
    for word in WORD.findall((text or "").lower()):
        for at in range(0, len(word), PIECE):
            yield f" {word[at : at + PIECE]} "


@lru_cache(maxsize=KNOWN)
def parts(window: str) -> tuple[str, ...]:
    return tuple(window[at : at + size] for size in PARTS for at in range(len(window) - size + 1))


class Gains:
    """How much shorter the toxic dictionary makes a window; a window met before is not compressed again."""

    def __init__(self, toxic: bytes, ordinary: bytes, level: int):
        self.toxic, self.ordinary = (self.compressor(content, level) for content in (toxic, ordinary))
        self.known: dict[str, int] = {}

    @staticmethod
    def compressor(content: bytes, level: int) -> Callable[[bytes], bytes]:
        content += PAD
        parameters = zstandard.ZstdCompressionParameters.from_level(
            level, source_size=128, dict_size=len(content), write_content_size=0, write_checksum=0, write_dict_id=0
        )
        table = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        table.precompute_compress(compression_params=parameters)
        return zstandard.ZstdCompressor(dict_data=table, compression_params=parameters).compress

    def of(self, window: str) -> int:
        gain = self.known.get(window)
        if gain is None:
            data = PAD + window.encode() + TAIL
            gain = len(self.ordinary(data)) - len(self.toxic(data))
            if len(self.known) >= KNOWN:
                self.known.clear()
            self.known[window] = gain
        return gain

    def features(self, text: str | None) -> np.ndarray:
        """Logarithms of how many windows gain at least so many bytes, the share of clear gains, the largest, a constant."""
        gains = np.array([self.of(window) for window in windows(text)])
        if not len(gains):
            return np.array([0.0] * (len(STEPS) + 2) + [1.0])
        counts = [math.log1p(int((gains >= step).sum())) for step in STEPS]
        return np.array([*counts, 20 * float((gains >= 3).mean()), float(gains.max()) / 4, 1.0])


def marked(own: list[str], other: list[str], settings: Settings) -> set[str]:
    """Parts that mark one class's texts: in a ``lift`` times larger share of them than of the others', beyond chance."""

    def counts(texts: list[str]) -> Counter:
        found = Counter()
        for text in texts:
            found.update(set().union(*map(parts, set(windows(text)))))
        return found

    n_own, n_other = len(own), len(other)
    here, rest = counts(own), counts(other)
    found = set()
    for part, n in here.items():
        share, even = n / n_own, (n + rest[part]) / (n_own + n_other)
        if share < settings.lift * (rest[part] + 1) / (n_other + 2):
            continue
        ratio = n * math.log(share / even) + (rest[part] and rest[part] * math.log(rest[part] / n_other / even))
        if 2 * ratio >= settings.ratio:
            found.add(part)
    return found


def dictionary(counts: Counter, size: int) -> bytes:
    """Windows in ascending order of their number of occurrences, as many as fit."""
    chosen, held = [], 0
    for window, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        data = window.encode()
        if held + len(data) > size:
            break
        chosen.append(data)
        held += len(data)
    return b"".join(reversed(chosen))


def dictionaries(rows: list[tuple[str | None, int]], settings: Settings) -> tuple[bytes, bytes] | None:
    """The toxic and the ordinary dictionary."""
    texts = {label: list(dict.fromkeys((t or "").lower() for t, x in rows if x == label)) for label in (0, 1)}
    if not texts[0] or not texts[1]:
        return None
    marks = marked(texts[1], texts[0], settings)
    toxic = Counter(w for t in texts[1] for w in windows(t) if not marks.isdisjoint(parts(w)))
    ordinary = Counter(w for t in texts[0] for w in windows(t))
    return dictionary(toxic, settings.dictionary), dictionary(ordinary, settings.dictionary)


def cross_gains(rows: list[tuple[str | None, int]], settings: Settings) -> tuple[np.ndarray, np.ndarray] | None:
    """Features and labels of each half of the rows, under dictionaries of the other half."""
    halves = [rows[0::2], rows[1::2]]
    pairs = [dictionaries(some, settings) for some in halves]
    if not all(pairs):
        return None
    x = []
    for own, pair in zip(halves, reversed(pairs), strict=True):
        gains = Gains(*pair, settings.level)
        x += [gains.features(text) for text, _ in own]
    return np.stack(x), np.array([float(label) for half in halves for _, label in half])


def train(rows: list[tuple[str | None, int]], settings: Settings) -> Model | None:
    """Dictionaries from all rows, the curve from gains under dictionaries of other rows."""
    whole, crossed = dictionaries(rows, settings), cross_gains(rows, settings)
    if not whole or not crossed:
        return None
    return Model(*whole, tuple(map(float, fitted(*crossed, settings.ridge))), settings.level)


def fitted(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 50, prior: float = 0.35) -> np.ndarray:
    """Logistic regression by Newton steps, the toxic class given the weight ``prior`` whatever its share of the rows."""
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) / len(y) + ridge * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    return w


def held_out(id_col: str) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings) -> list[tuple[str | None, int]]:
    """At most ``train_rows`` labelled rows a class, by a hash of the id, and one text of bounded length for each: the ids
    chosen bound the broadcast, they and ``train_chars`` what is collected."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    chosen = None
    for label in (0, 1):
        some = (
            usable.where(F.col("toxic") == label)
            .select("doc_id", F.col("toxic").alias("label"))
            .distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(settings.train_rows)
        )
        chosen = some if chosen is None else chosen.union(some)
    short = F.coalesce(F.length("text"), F.lit(0)) <= settings.train_chars
    rows = docs.select(F.col("doc_id"), F.col("text")).where(short).join(F.broadcast(chosen), "doc_id")
    found = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect()
    return [(r.text, r.label) for r in sorted(found, key=lambda r: (r.doc_id * 2654435761 % 2**32, r.doc_id, r.text or ""))]


def score(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = train(training_rows(docs, labels, settings), settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(model.toxic, model.ordinary, model.level) if model else None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                if model is None:
                    scores = [0.0] * part.num_rows
                else:
                    scores = [
                        1 / (1 + math.exp(-float(np.clip(gains.features(text) @ model.weights, -30, 30))))
                        for text in part.column(1).to_pylist()
                    ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(run, SCORES).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= settings.threshold).cast("int").alias("predicted"),
    )
