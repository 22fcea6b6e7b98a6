"""Mixing sources to target weights with soft membership.

A multinomial classifier over hashed words, trained on labelled rows, gives each document a posterior over domains. A
document's expected tokens in a domain are its tokens times that posterior. Nonnegative document rates are then fitted
by projected-gradient least squares so that the expected tokens of each domain, summed over documents at their rates,
meet the target weights' shares of all tokens.

The residual is one small vector, so a step needs one aggregation over the documents; the rates themselves are never
stored between steps, because a document's rate follows from its posterior and the list of past step vectors. Steps are
taken in the metric of the domains' overlap over the documents whose rate is not zero, so a handful of them is enough;
a step that does not lessen the largest residual is halved.

Defined results: a null or empty text has no tokens, the prior as its posterior and a rate that moves no total; equal
rows get equal rates; without labels there is one domain, and all rates are 1; an empty table gives an empty result;
extra columns pass through, and this module's are those of ``OUT``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words
from tidemark.llm.store import written

MEMBER = "tidemark_member"
MEMBER_TYPE = "n_tokens long, posterior array<double>"
OUT = ("n_tokens", "posterior", "rate", "copies", "target_error")
DOMAINS = ("plain", "junk", "toxic")


@dataclass(frozen=True)
class Settings:
    targets: dict[str, float] = field(default_factory=lambda: {"plain": 0.94, "junk": 0.02, "toxic": 0.04})
    train_rows: int = 20_000  # labelled rows the classifier is trained on, chosen by a hash of their ids
    buckets: int = 1 << 14
    smoothing: float = 0.5
    steps: int = 30
    tolerance: float = 1e-6


def domain() -> Column:
    """The domain a labelled row belongs to; null, and not trained on, if it has neither label."""
    known = F.coalesce("toxic", "quality").isNotNull()
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").when(known, "plain")


def hashed(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = words.buffers(column)
    starts, ends, firsts = words.spans(data, bounds)
    return (words.word_hashes(data, starts, ends, False) % np.uint64(buckets)).astype(np.int64), firsts


@dataclass(frozen=True)
class Classifier:
    domains: tuple[str, ...]
    prior: np.ndarray
    log_shares: np.ndarray  # domains x buckets

    def posteriors(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and posterior of each text. Evidence counts by the root of its length: words are not independent."""
        hashes, firsts = hashed(column, self.log_shares.shape[1])
        n = np.diff(firsts)
        logits = np.tile(np.log(self.prior), (len(n), 1))
        for k in range(len(self.domains)):
            sums = np.concatenate([[0.0], np.cumsum(self.log_shares[k][hashes])])
            logits[:, k] += (sums[firsts[1:]] - sums[firsts[:-1]]) / np.sqrt(np.maximum(n, 1))
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return n, p / p.sum(axis=1, keepdims=True)


def train(docs: DataFrame, labels: DataFrame, s: Settings) -> Classifier:
    """Word counts by domain are summed in Spark; what comes back is domains x buckets numbers at most."""
    chosen = (
        labels.where("doc_id IS NOT NULL")
        .select("doc_id", domain().alias("domain"))
        .where("domain IS NOT NULL")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "domain")
        .limit(s.train_rows)
    )
    rows = docs.select(F.col("doc_id"), F.col("text")).join(F.broadcast(chosen), "doc_id").select("domain", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            hashes, firsts = hashed(batch.column(1), s.buckets)
            for i, name in enumerate(names):
                own = sums.setdefault(name, np.zeros(s.buckets + 1, np.int64))
                np.add.at(own, hashes[firsts[i] : firsts[i + 1]], 1)
                own[-1] += 1  # documents
        for name, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at), pa.array(counts[at])], names=["domain", "bucket", "n"]
            )

    counts = rows.mapInArrow(run, "domain string, bucket long, n long").groupBy("domain", "bucket").agg(F.sum("n").alias("n"))
    found = counts.collect()
    names = tuple(d for d in DOMAINS if any(row.domain == d for row in found)) or DOMAINS[:1]
    table = np.full((len(names), s.buckets), s.smoothing)
    prior = np.ones(len(names))
    for row in found:
        k = names.index(row.domain)
        if row.bucket == s.buckets:
            prior[k] += row.n
        else:
            table[k, row.bucket] += row.n
    return Classifier(names, prior / prior.sum(), np.log(table / table.sum(axis=1, keepdims=True)))


def with_membership(docs: DataFrame, classifier: Classifier, *keep: str) -> DataFrame:
    """The ``keep`` columns and the struct ``MEMBER`` of tokens and posterior."""
    columns = [*keep, *([] if "text" in keep else ["text"])]
    at_text, width = columns.index("text"), len(keep)
    kept = docs.select(*[docs[name] for name in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                n, p = classifier.posteriors(part.column(at_text))
                bounds = pa.array(np.arange(len(n) + 1, dtype=np.int32) * p.shape[1])
                struct = pa.StructArray.from_arrays(
                    [pa.array(n), pa.ListArray.from_arrays(bounds, pa.array(p.reshape(-1)))], ["n_tokens", "posterior"]
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:width], struct], names=[*part.schema.names[:width], MEMBER]
                )

    schema = T.StructType(kept.schema.fields[:width]).add(MEMBER, T.StructType.fromDDL(MEMBER_TYPE))
    return kept.mapInArrow(run, schema)


def rate_of(posterior: Column, steps: list[np.ndarray]) -> Column:
    """The rate after the given steps, each a projection of (rate - posterior . step) onto the nonnegative numbers."""
    if not steps:
        return F.lit(1.0)
    vectors = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])
    dot = lambda v: F.aggregate(F.zip_with(posterior, v, lambda p, x: p * x), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(vectors, F.lit(1.0), lambda rate, v: F.greatest(F.lit(0.0), rate - dot(v)))


def fit(members: DataFrame, domains: tuple[str, ...], s: Settings) -> tuple[list[np.ndarray], float]:
    """The step vectors, and the largest difference left between a domain's share of tokens and its target.

    ``members`` has n_tokens and posterior. Targets that no nonnegative rates meet leave a difference above ``tolerance``.
    """
    k = len(domains)
    p = [F.get("posterior", F.lit(i)) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    weights = np.array([s.targets.get(d, 0.0) for d in domains])
    target = weights / weights.sum()
    steps: list[np.ndarray] = []
    best, error = np.inf, 0.0
    for number in range(s.steps + 1 if k > 1 else 0):
        rated = members.select("n_tokens", "posterior", rate_of(F.col("posterior"), steps).alias("rate"))
        free = F.when(F.col("rate") > 0, F.col("n_tokens")).otherwise(0)
        sums = rated.agg(
            F.sum("n_tokens").alias("total"),
            *[F.sum(F.col("n_tokens") * F.col("rate") * p[i]).alias(f"s{i}") for i in range(k)],
            *[F.sum(free * p[i] * p[j]).alias(f"m{i}_{j}") for i, j in pairs],
        ).first()
        if not sums.total:
            break
        residual = np.array([sums[f"s{i}"] for i in range(k)]) / sums.total - target
        error = np.abs(residual).max()
        if error <= s.tolerance or number == s.steps:
            break
        if error >= best:  # too long a step: documents left or entered zero on the way
            steps[-1] = steps[-1] / 2
            continue
        metric = np.zeros((k, k))
        for i, j in pairs:
            metric[i, j] = metric[j, i] = sums[f"m{i}_{j}"] / sums.total
        best = error
        steps.append(np.linalg.solve(metric + 1e-9 * np.eye(k), residual))
        if np.abs(steps[-1]).max() < 1e-12:
            break
    return steps, float(error)


def mix(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), *keep: str) -> DataFrame:
    """The ``keep`` columns (all but ``OUT`` ones if none are named), n_tokens, posterior, rate, copies and target_error.

    ``copies`` is the rate rounded so that its expectation is the rate, by a hash of id and text. ``target_error`` is the
    same in all rows: how far the worst domain's share of tokens is from its target. Input columns named like a result are
    replaced by it.
    """
    keep = keep or tuple(name for name in docs.columns if name not in OUT)
    classifier = train(docs, labels, settings)
    members = written(with_membership(docs, classifier, "doc_id").select(f"{MEMBER}.*"), "members")
    steps, error = fit(members, classifier.domains, settings)
    mixed = with_membership(docs, classifier, *keep)
    rate = rate_of(F.col(f"{MEMBER}.posterior"), steps)
    mixed = mixed.select(*[F.col(name) for name in keep], f"{MEMBER}.*", rate.alias("rate"))
    seed = [F.col(name) for name in ("doc_id", "text") if name in keep]
    chance = F.pmod(F.xxhash64(F.lit("mix"), *seed), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")).cast("long")
    return mixed.withColumn("copies", copies).withColumn("target_error", F.lit(error))
