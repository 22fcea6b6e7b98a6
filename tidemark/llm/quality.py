"""Quality rules whose failures are judged by host as well as by document.

Each text is measured (whole, in numpy over Arrow batches), each host gets the share of its documents that break a
rule, and that share is shrunk towards what hosts have in general: shares are taken as draws from a beta distribution
whose two parameters are fitted to all hosts by moments. A host whose shrunk share exceeds ``host_limit`` is rejected,
and its verdict is joined back to its documents.

Defined results: a null or empty text has no words and fails; a null host is a host of its own; equal rows are judged
alike and all returned; an empty table gives an empty result; columns other than those named are passed through, and
their names do not clash because measures and verdict travel in one struct each, under names of this package.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
NAMES = [part.split()[0] for part in MEASURES.split(", ")]
SYMBOLS = b"[#*$%&|<>]"
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[np.frombuffer(SYMBOLS[1:-1], np.uint8)] = True
WINDOW = 5
MEASURED, VERDICT = "tidemark_measured", "tidemark_verdict"


@dataclass(frozen=True)
class Limits:
    """Rules of a document, and the shrunk share of failing documents beyond which a host is rejected."""

    min_words: int = 10
    repeat_percent: int = 20
    symbol_percent: int = 50
    host_limit: float = 0.5


def repeated_words(runs: np.ndarray, n_words: int) -> int:
    """Words covered by runs found twice or more."""
    order = np.argsort(runs, kind="stable")
    same = runs[order[1:]] == runs[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(runs), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(n_words + 1, np.int64)
    steps[: len(runs)] += twice
    steps[WINDOW : WINDOW + len(runs)] -= twice
    return int(np.count_nonzero(np.cumsum(steps[:-1])))


def duplicate_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n") if text else ()
    if len(set(lines)) == len(lines):
        return 0
    seen: set[str] = set()
    found = 0
    for line in lines:
        if line in seen:
            found += bool(line.strip(" \t\n\r\x0b\x0c"))
        else:
            seen.add(line)
    return found


def measure_column(column: pa.Array) -> list[pa.Array]:
    data, bounds = words.buffers(column)
    starts, ends, firsts = words.spans(data, bounds)
    runs, run_bounds = words.shingle_hashes(words.word_hashes(data, starts, ends, False), firsts, WINDOW, False)

    def per_row(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    n_words = np.diff(firsts)
    repeats = [
        repeated_words(runs[a:b], n) if b - a > 1 else 0
        for a, b, n in zip(run_bounds[:-1], run_bounds[1:], n_words, strict=True)
    ]
    columns = [
        n_words,
        per_row(~words.IS_SPACE[data] & ((data & 0xC0) != 0x80)),
        per_row(IS_SYMBOL[data]),
        [duplicate_lines(text) for text in column.to_pylist()],
        repeats,
    ]
    return [pa.array(x, pa.int64()) for x in columns]


def measures(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The ``keep`` columns as they are, and the measures in a struct column named ``MEASURED``."""
    columns = [*keep, *([] if text in keep else [text])]
    at_text, width = columns.index(text), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                struct = pa.StructArray.from_arrays(measure_column(part.column(at_text)), names=NAMES)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:width], struct], names=[*part.schema.names[:width], MEASURED]
                )

    kept = docs.select(*[docs[name] for name in columns])
    schema = T.StructType(kept.schema.fields[:width]).add(MEASURED, T.StructType.fromDDL(MEASURES))
    return kept.mapInArrow(run, schema)


def base_failed(limits: Limits, m: str = MEASURED) -> Column:
    n = F.col(f"{m}.n_words")
    return (n < limits.min_words) | (100 * F.col(f"{m}.n_repeat_words") > limits.repeat_percent * n)


def rule_failed(limits: Limits, m: str = MEASURED) -> Column:
    """A document's own rules: too short, repetitive, or more symbols than the share of words allows."""
    return base_failed(limits, m) | (100 * F.col(f"{m}.n_symbols") > limits.symbol_percent * F.col(f"{m}.n_words"))


def host_verdicts(measured: DataFrame, host: str, limits: Limits) -> DataFrame:
    """host, n_docs, n_failed, shrunk_rate, host_rejected; one row a host, combined before the shuffle.

    With shares of mean m and variance v over hosts (weighted by documents, less what sampling alone explains), the
    prior is beta(a, b) with a + b = m (1 - m) / v - 1, and the shrunk share is (failed + a) / (documents + a + b). If
    hosts differ no more than by chance, a + b is held at its upper bound: all hosts count alike.
    """
    hosts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(rule_failed(limits).cast("long")).alias("n_failed")
    )
    moments = hosts.agg(
        F.sum("n_docs").alias("docs"),
        F.sum("n_failed").alias("failed"),
        F.count(F.lit(1)).alias("hosts"),
        F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("squares"),
    )
    a, b = beta_prior(*moments.first())
    rate = (F.col("n_failed") + a) / (F.col("n_docs") + a + b)
    return hosts.withColumn("shrunk_rate", rate).withColumn("host_rejected", rate > limits.host_limit)


def beta_prior(docs: int | None, failed: int | None, hosts: int, squares: float | None) -> tuple[float, float]:
    """The beta distribution that hosts' shares come from, by moments; four sums of the corpus are all it needs."""
    if not docs:
        return 0.5, 0.5
    m = failed / docs
    between = (squares - docs * m * m) / docs - m * (1 - m) * hosts / docs
    weight = min(1e6, max(1.0, m * (1 - m) / max(between, 1e-12) - 1))
    return m * weight, (1 - m) * weight


def judge(measured: DataFrame, verdicts: DataFrame, host: str, limits: Limits) -> DataFrame:
    """``measured`` with base_failed and kept: own rules hold and the host is not rejected."""
    verdicts = verdicts.select(F.struct("host", "shrunk_rate", "host_rejected").alias(VERDICT))
    return measured.join(verdicts, F.col(host).eqNullSafe(F.col(f"{VERDICT}.host")), "left")


def is_kept(limits: Limits) -> Column:
    return ~rule_failed(limits) & ~F.coalesce(f"{VERDICT}.host_rejected", F.lit(False))


def keep_good(docs: DataFrame, host: str = "source", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The documents, all columns as they were, that their own rules and their host's verdict let through."""
    measured = measures(docs, *docs.columns, text=text)
    verdicts = host_verdicts(measures(docs, host, text=text), host, limits)
    judged = judge(measured, verdicts, host, limits)
    return judged.where(is_kept(limits)).select(*[judged[name] for name in docs.columns])
