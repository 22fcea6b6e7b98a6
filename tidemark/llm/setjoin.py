"""Exact n-gram Jaccard join of whole texts, with set-relation skipping.

A document's set is its distinct five-word shingles. Equal sets form one class at once. Classes are joined through
posting lists of their rare shingles: with shingles ordered from rare to frequent, two sets of Jaccard similarity t or
more share a shingle among the first n - ceil(2 t n / (1 + t)) + 1 of the smaller set and the first n - ceil(t n) + 1 of
the larger one. Frequencies are counted over all documents in a table that has a place for each shingle of a small corpus
and a fixed size from ``most_buckets`` on; the order they give is the same for all sets, so it decides the cost and never
the result. Order is by the count in steps of 9 %, so a shingle that tens of documents share mostly comes behind those of
one document also where each place holds many shingles.

* Lists are dealt by shingle into parts of a bounded size on average, joined one after another in numpy. A list is never
  split: that of one shingle is sorted in one task, however long. Its postings are sorted by (set size, position), pairs of
  neighbours are formed, and those whose sizes or positions rule a link out are masked (a shingle at position i leaves at
  most n - i common ones); no block is skipped.
* Answers are derived from similar sets: in a list longer than ``short`` entries, a set is first compared only with its
  neighbours in the list and the set in which the shingle comes first (the one with the fewest rare shingles: of a
  group of edited copies, the original). Sets that are linked, directly or not, then share all answers that
  matter for components, so a long list is dropped if all its sets are in one component, and otherwise only pairs
  between different components are compared. No pair between components is left out, so components are whole; pairs
  within one are not all compared, so the links found are some of all, enough to connect every component. The number of
  links of a set is not known, and no set's own answers are kept or derived.
* A candidate's parities (of classes of shingles, which hold an odd number) bound the difference of the two sets from below
  and rule out nearly all other pairs before any text is moved: first those of 256 classes, which say nothing of sets of
  more than about 450 shingles, then those of as many classes as a set has shingles.
* Candidates are verified exactly on the sets rebuilt from the whole texts. Only texts with a candidate are moved; a
  bitmap of fixed size, broadcast, keeps nearly all others from the shuffle.

Defined results: a null or empty text, or one without words, has the empty set and is linked with nothing; fewer words
than five count as one shingle; equal rows are in one component; a null doc_id joins like any other, the component id
being the smallest id that is not null; an empty table gives an empty result; extra columns are not read and cannot
clash. Sets are told apart by a 64-bit hash of their shingles' 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.graph import components
from tidemark.llm.store import written

U = np.uint64
PARITY = ["parity0", "parity1", "parity2", "parity3"]
SETS = f"doc_id long, text_hash long, n long, set_id long, {' long, '.join(PARITY)} long, odd binary, block int, counts binary"
POSTINGS = "part int, postings binary"
FOUND = "a long, b long, token long, n long, place long"
TEXTS = "set_id long, doc_id long, text_hash long, body binary"
LINKS = "a long, b long, linked boolean"
PAIRS = "a long, b long, a_doc long, a_hash long, b_doc long, b_hash long"
BLOCKS = 64  # of the frequency table
POSTING = np.dtype([("token", "u8"), ("set", "u8"), ("n", "u4"), ("place", "u4")])


@dataclass(frozen=True)
class Settings:
    width: int = 5
    percent: int = 75  # link when 100 * intersection >= percent * union
    buckets: int = 1 << 20  # frequency table, at least
    most_buckets: int = 1 << 24  # and at most
    per_part: int = 400_000  # postings a task joins at once
    flush: int = 1_000_000  # postings a task holds before it sends them
    counted: int = 4_000_000  # shingles a task holds before it sends their counts
    short: int = 8  # longest list whose pairs are compared directly
    near: int = 3  # neighbours in a longer list
    bitmap: int = 1 << 25  # bits that tell which texts have candidates

    def least(self, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """Shingles two sets of these sizes must share."""
        return -((-self.percent * (n_a + n_b)) // (100 + self.percent))

    def probe(self, n: np.ndarray) -> np.ndarray:
        return n + (-self.percent * n) // 100 + 1

    def index(self, n: np.ndarray) -> np.ndarray:
        return n + (-2 * self.percent * n) // (100 + self.percent) + 1


def sets_of(column: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, bounds = words.shingles(column, width, fold=True, short=True)
    return [np.unique(hashes[a:b]) if b - a > 1 else hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def parities(tokens: np.ndarray) -> np.ndarray:
    """Of as many classes as there are shingles (a power of two, 256 at least), which hold an odd number, as packed bits.

    Two sets differ in as many shingles at least as bits here. A shingle's class among fewer ones is the rest of its class.
    """
    n = max(256, 1 << max(0, len(tokens) - 1).bit_length())
    odd = np.bincount(((tokens >> U(8)) & U(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype("u1"))


def folded(odd: np.ndarray, size: int) -> np.ndarray:
    """The parities of fewer classes, of ``size`` bytes."""
    return np.bitwise_xor.reduce(odd.reshape(-1, size), axis=0)


def differing(x: bytes, y: bytes) -> int:
    """In how many shingles two sets differ at least, by their parities."""
    size = min(len(x), len(y))
    x, y = (folded(np.frombuffer(z, "u1"), size) for z in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def may_link(a: str, b: str, s: Settings) -> Column:
    """Whether sizes and parities allow a link: a link has at most (100 - p) / (100 + p) of both sizes not in common."""
    differing = sum(
        (F.bit_count(F.col(f"{a}{name}").bitwiseXOR(F.col(f"{b}{name}"))) for name in PARITY), start=F.lit(0)
    )
    return (100 + s.percent) * differing <= (100 - s.percent) * (F.col(f"{a}n") + F.col(f"{b}n"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")
    )


def pack_counts(held: list[np.ndarray], s: Settings) -> tuple[list[int], list[bytes]]:
    """For each block of the frequency table that has any: which places were met, and how often. Empties ``held``."""
    every = np.concatenate(held)
    held.clear()
    every.sort()
    step = s.most_buckets // BLOCKS
    starts = np.searchsorted(every, (np.arange(BLOCKS) * step).astype("u4"))
    blocks, packed = [], []
    for i, own in enumerate(np.split(every, starts[1:])):
        if not len(own):
            continue
        places, counts = np.unique(own, return_counts=True)
        both = np.stack([np.diff(places, prepend=np.uint32(i * step)), counts.astype("u4")])
        planes = np.ascontiguousarray(both.view("u1").reshape(2, -1, 4).transpose(0, 2, 1))
        blocks.append(i)
        packed.append(zstandard.compress(planes.tobytes(), 1))
    return blocks, packed


def unpack_counts(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The places within a block, each once, and their counts."""
    planes = np.frombuffer(zstandard.decompress(packed), "u1").reshape(2, 4, -1)
    gaps, counts = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("u4")[:, :, 0]
    return np.cumsum(gaps, dtype=np.int64), counts.astype(np.int64)


def describe_sets(rows: DataFrame, s: Settings) -> DataFrame:
    """A row for each document (its set's size, id and parities) and, per task, its part of the frequency table."""
    names = ["doc_id", "text_hash", "n", "set_id", *PARITY, "odd", "block", "counts"]

    def counts(held: list[np.ndarray]) -> pa.RecordBatch:
        blocks, packed = pack_counts(held, s)
        nothing = [pa.nulls(len(blocks), pa.int64())] * 8
        columns = [*nothing, pa.nulls(len(blocks), pa.binary()), pa.array(blocks, pa.int32()), pa.array(packed, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = U(64 - (s.most_buckets.bit_length() - 1))
        held: list[np.ndarray] = []
        size = 0
        for part in slices(batches):
            sets = sets_of(part.column(2), s.width)
            held.append((np.concatenate(sets) >> shift).astype("u4"))
            size += len(held[-1])
            odd = [parities(x) for x in sets]
            nothing = pa.nulls(len(sets))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([set_id(x) for x in sets], pa.int64()),
                    *[pa.array(x) for x in np.stack([folded(x, 32).view(np.int64) for x in odd]).T],
                    pa.array([x.tobytes() for x in odd], pa.binary()),
                    nothing.cast(pa.int32()),
                    nothing.cast(pa.binary()),
                ],
                names=names,
            )
            if size >= s.counted:
                yield counts(held)
                size = 0
        if size:
            yield counts(held)

    return rows.mapInArrow(run, SETS)


def frequency_classes(described: DataFrame, total: int, s: Settings) -> np.ndarray:
    """For each bucket of shingles eight times the binary logarithm of its count over all documents; one byte a bucket.

    There are as many buckets as the corpus has shingles (``total``), within the limits of the settings.
    """
    buckets = min(s.most_buckets, max(s.buckets, BLOCKS, 1 << max(0, total - 1).bit_length()))
    fold, step = s.most_buckets // buckets, buckets // BLOCKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                places, counts = unpack_counts(packed)
                np.add.at(sums.setdefault(block, np.zeros(step, np.int64)), places // fold, counts)
        for block, counts in sums.items():
            classes = np.minimum(8 * np.log2(counts + 1), 255).astype("u1").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([classes], pa.binary())], names=["block", "classes"]
            )

    parts = described.where("block IS NOT NULL").select("block", "counts").repartition(BLOCKS, "block")
    found = {row.block: row.classes for row in parts.mapInArrow(run, "block int, classes binary").collect()}
    return np.frombuffer(b"".join(found.get(i, bytes(step)) for i in range(BLOCKS)), "u1")


def pack(postings: np.ndarray) -> bytes:
    """Sorted by shingle, as byte planes: what is alike lies together."""
    tokens = np.diff(postings["token"], prepend=U(0))
    planes = [tokens.view("u1").reshape(-1, 8).T, np.ascontiguousarray(postings["set"]).view("u1").reshape(-1, 8).T]
    planes += [np.ascontiguousarray(postings[x]).view("u1").reshape(-1, 4).T for x in ("n", "place")]
    return zstandard.compress(np.concatenate(planes).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), "u1").reshape(24, -1)
    out = np.empty(planes.shape[1], POSTING)
    out["token"] = np.cumsum(np.ascontiguousarray(planes[:8].T).view("u8")[:, 0])
    out["set"] = np.ascontiguousarray(planes[8:16].T).view("u8")[:, 0]
    out["n"] = np.ascontiguousarray(planes[16:20].T).view("u4")[:, 0]
    out["place"] = np.ascontiguousarray(planes[20:].T).view("u4")[:, 0]
    return out


def posting_lists(rows: DataFrame, classes: np.ndarray, parts: int, s: Settings) -> DataFrame:
    """The rare shingles of every set, as one packed row for each task and part of the shingles."""
    table = rows.sparkSession.sparkContext.broadcast(classes)  # one byte a bucket, of bounded size

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        every = np.concatenate(held)
        part = (words.mix(every["token"]) % U(parts)).astype(np.int64)
        order = np.lexsort((every["token"], part))
        every, part = every[order], part[order]
        edges = np.searchsorted(part, np.arange(parts + 1))
        for at in range(0, parts, 64):
            own = [p for p in range(at, min(parts, at + 64)) if edges[p] < edges[p + 1]]
            blobs = [pack(every[edges[p] : edges[p + 1]]) for p in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "postings"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = table.value
        shift = U(64 - (len(classes).bit_length() - 1))
        held: list[np.ndarray] = []
        size, seen = 0, set()
        for part in slices(batches):
            for tokens in sets_of(part.column(2), s.width):
                n = len(tokens)
                own = set_id(tokens) if n else 0
                if not n or own in seen:
                    continue
                seen.add(own)
                own_classes = classes[(tokens >> shift).astype(np.int64)].astype(np.uint64)
                ordered = np.sort((own_classes << U(56)) | (tokens & U((1 << 56) - 1)))
                ordered = ordered[: int(s.probe(n))]
                new = np.empty(len(ordered), POSTING)
                new["token"], new["set"], new["n"], new["place"] = ordered, np.int64(own).view(U), n, np.arange(len(ordered))
                held.append(new)
                size += len(new)
            if size >= s.flush:
                yield from flush(held)
                held, size, seen = [], 0, set()
        if held:
            yield from flush(held)

    return rows.mapInArrow(run, POSTINGS)


def candidate_pairs(x: np.ndarray, y: np.ndarray, s: Settings) -> np.ndarray:
    """Which pairs of postings of one shingle (x no larger than y) pass the size and position filters."""
    n_x, n_y = x["n"].astype(np.int64), y["n"].astype(np.int64)
    left = np.minimum(n_x - x["place"], n_y - y["place"])  # all a first common shingle leaves, itself included
    return (100 * n_x >= s.percent * n_y) & (x["place"] < s.index(n_x)) & (left >= s.least(n_x, n_y))


def join_lists(lists: DataFrame, parts: int, s: Settings) -> DataFrame:
    """Candidate pairs (a, b), and the postings of lists too long to be compared directly (a, token, n, place)."""

    def pairs_of(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((p["set"], p["place"], p["n"], p["token"]))
        p = p[order]
        again = np.zeros(len(p), bool)
        again[1:] = (p["token"][1:] == p["token"][:-1]) & (p["set"][1:] == p["set"][:-1])
        p = p[~again]  # the same set, sent by several tasks
        edge = np.flatnonzero(np.concatenate([[True], p["token"][1:] != p["token"][:-1], [True]]))
        length = np.diff(edge)
        within = np.repeat(length, length)
        p = p[within > 1]
        length = length[length > 1]
        first = np.repeat(np.cumsum(length) - length, length)
        long = np.repeat(length > s.short, length)
        found = []
        at = np.arange(len(p))
        for step in range(1, s.short):
            x = at[: max(0, len(p) - step)]
            keep = (first[x] == first[x + step]) & ((step <= s.near) | ~long[x])
            found.append((x[keep], x[keep] + step))
        if len(p):
            rank = (p["place"].astype(np.int64) << 32) | (at - first)
            head = first + (np.repeat(np.minimum.reduceat(rank, np.unique(first)), length) & 0xFFFFFFFF)
            star = at[long & (at != head)]
            found.append((np.minimum(head[star], star), np.maximum(head[star], star)))
        x, y = (np.concatenate(side) for side in zip(*found, strict=True))
        keep = candidate_pairs(p[x], p[y], s)
        a, b = p["set"][x[keep]].view(np.int64), p["set"][y[keep]].view(np.int64)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pairs, p[long]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        at = None
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and part != at:
                    yield from found_in(np.concatenate(held))
                    held = []
                at = part
                held.append(unpack(packed))
        if held:
            yield from found_in(np.concatenate(held))

    def found_in(postings: np.ndarray) -> Iterator[pa.RecordBatch]:
        pairs, long = pairs_of(postings)
        nothing = pa.nulls(len(pairs), pa.int64())
        names = ["a", "b", "token", "n", "place"]
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), *[nothing] * 3], names=names)
        columns = [
            pa.array(long["set"].view(np.int64)),
            pa.nulls(len(long), pa.int64()),
            pa.array(long["token"].view(np.int64)),
            pa.array(long["n"].astype(np.int64)),
            pa.array(long["place"].astype(np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return lists.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, FOUND)


def bitmap_of(ids: DataFrame, bits: int) -> np.ndarray:
    """Bits set for the rows' (doc_id, text_hash): at most ``bits`` / 8 bytes, whatever the corpus."""
    place = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(bits))
    rows = (
        ids.select(place.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap"))
        .collect()
    )
    # buckets are numbered from 1 for bits 1..32768 of each; position is (bit - 1) mod 32768 for bit > 0
    out = np.zeros(bits // 8 + 8192, "u1")
    for row in rows:
        out[row.bucket * 4096 : row.bucket * 4096 + 4096] |= np.frombuffer(bytes(row.bitmap), "u1")
    return out


def texts_of(rows: DataFrame, involved: DataFrame, s: Settings) -> DataFrame:
    """set_id, doc_id, text_hash, body (compressed text) of the involved documents, and of a few more."""
    table = rows.sparkSession.sparkContext.broadcast(bitmap_of(involved, s.bitmap))
    place = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(s.bitmap))
    marked = rows.select(
        "doc_id",
        "text_hash",
        "text",
        F.bitmap_bucket_number(place).alias("bucket"),
        F.bitmap_bit_position(place).alias("position"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for part in slices(batches):
            bucket, position = (part.column(i).to_numpy() for i in (3, 4))
            byte = bits[bucket * 4096 + position // 8]
            part = part.filter(pa.array((byte >> (position % 8)) & 1 == 1))
            ids = [set_id(x) for x in sets_of(part.column(2), s.width)]
            bodies = [zstandard.compress((text or "").encode(), 3) for text in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), part.column(0), part.column(1), pa.array(bodies, pa.binary())],
                names=["set_id", "doc_id", "text_hash", "body"],
            )

    return marked.mapInArrow(run, TEXTS)


def verified(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose sets are similar enough, counted on the sets themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray | None] = (None, None)

        def sets(bodies: list[bytes]) -> list[np.ndarray]:
            return sets_of(pa.array([zstandard.decompress(x) for x in bodies], pa.binary()), s.width)

        for part in slices(batches):
            a, b = part.column(0).to_pylist(), part.column(1).to_pylist()
            bodies = part.column(2)
            new = [i for i, x in enumerate(a) if x != (a[i - 1] if i else last[0])]
            fresh = sets([bodies[i].as_py() for i in new])
            right = sets(part.column(3).to_pylist())
            linked, current, k = [], last[1], 0
            for i, other in enumerate(right):
                if k < len(new) and new[k] == i:
                    current, k = fresh[k], k + 1
                shared = len(np.intersect1d(current, other, assume_unique=True))
                linked.append(100 * shared >= s.percent * (len(current) + len(other) - shared))
            last = (a[-1], current)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
            )

    for side in ("a", "b"):
        own = texts.select(F.struct("set_id", "doc_id", "text_hash").alias(f"{side}_key"), F.col("body").alias(f"body_{side}"))
        same = [
            F.col(side) == F.col(f"{side}_key.set_id"),
            F.col(f"{side}_doc").eqNullSafe(F.col(f"{side}_key.doc_id")),
            F.col(f"{side}_hash") == F.col(f"{side}_key.text_hash"),
        ]
        pairs = pairs.join(own.hint("merge"), same[0] & same[1] & same[2]).drop(f"{side}_key")
    both = pairs.select("a", "b", "body_a", "body_b").sortWithinPartitions("a")
    return both.mapInArrow(run, LINKS).where("linked").select("a", "b").distinct()


def cross_pairs(long: DataFrame, classes: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """All candidate pairs of long lists whose sets are in different components so far."""
    own = long.join(labels.withColumnRenamed("node", "a"), "a", "left").select(
        "token", "a", "n", "place", F.coalesce("root", "a").alias("root")
    )
    mixed = own.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    bits = classes.select(F.col("set_id").alias("a"), *PARITY)
    own = written(own.join(mixed.select("token"), "token").join(bits, "a"), "mixed")
    p = F.lit(s.percent)
    x, y = own.alias("x"), own.alias("y")
    n_x, n_y = F.col("x.n"), F.col("y.n")
    left = F.least(n_x - F.col("x.place"), n_y - F.col("y.place"))
    index = n_x - F.ceil(2 * p * n_x / (100 + s.percent)) + 1
    near = (
        (n_x <= n_y)
        & (100 * n_x >= p * n_y)
        & (F.col("x.place") < index)
        & (left * (100 + s.percent) >= p * (n_x + n_y))
        & (F.col("x.root") != F.col("y.root"))
        & may_link("x.", "y.", s)
    )
    a, b = F.col("x.a"), F.col("y.a")
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & near)
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


@dataclass(frozen=True)
class Joined:
    """The documents' sets (doc_id, text_hash, n, set_id), links enough to connect each component, and each linked set's root."""

    sets: DataFrame
    links: DataFrame
    roots: DataFrame


def by_parities(pairs: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose own parities (a_odd, b_odd) allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024):
            both = zip(part.column("a_odd").to_pylist(), part.column("b_odd").to_pylist(), strict=True)
            apart = np.fromiter((differing(x, y) for x, y in both), np.int64, part.num_rows)
            sizes = part.column("a_n").to_numpy() + part.column("b_n").to_numpy()
            keep = (100 + s.percent) * apart <= (100 - s.percent) * sizes
            yield part.select(["a", "b", "a_doc", "a_hash", "b_doc", "b_hash"]).filter(pa.array(keep))

    return pairs.mapInArrow(run, PAIRS)


def _verify(rows: DataFrame, classes: DataFrame, pairs: DataFrame, s: Settings) -> DataFrame:
    """The links among the pairs. Each class is stood for by one document, whose text alone is moved."""
    for side in ("a", "b"):
        names = {"doc_id": "doc", "text_hash": "hash", "n": "n", "odd": "odd", **{name: name for name in PARITY}}
        own = classes.select(F.col("set_id").alias(side), *[F.col(k).alias(f"{side}_{v}") for k, v in names.items()])
        pairs = pairs.join(own, side)
    pairs = pairs.where(may_link("a_", "b_", s)).drop(*[f"{side}_{name}" for side in "ab" for name in PARITY])
    pairs = written(by_parities(pairs, s), "pairs")
    if pairs.isEmpty():
        return pairs.select("a", "b")
    involved = [pairs.select(F.col(f"{x}_doc").alias("doc_id"), F.col(f"{x}_hash").alias("text_hash")) for x in "ab"]
    texts = written(texts_of(rows, involved[0].union(involved[1]), s), "texts")
    return written(verified(pairs, texts, s), "verified")


def join_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> Joined:
    s = settings
    rows = _rows(docs, id_col, text_col)
    described = written(describe_sets(rows, s), "sets")
    sets = described.where("block IS NULL").select("doc_id", "text_hash", "n", "set_id")
    classes = (
        described.where("block IS NULL AND n > 0")
        .groupBy("set_id")
        .agg(
            F.min(F.struct("doc_id", "text_hash")).alias("one"),
            *[F.max(name).alias(name) for name in ("n", *PARITY, "odd")],  # the same in all rows of a class
        )
    ).select("set_id", "one.doc_id", "one.text_hash", "n", *PARITY, "odd")
    classes = written(classes, "classes")
    probes = F.sum(F.floor(F.col("n") * (100 - s.percent) / 100) + 1)
    total, shingles = classes.agg(probes, F.sum("n")).first()
    parts = max(1, -(-int(total or 0) // s.per_part))
    lists = posting_lists(rows, frequency_classes(described, shingles or 0, s), parts, s)
    found = written(join_lists(lists, parts, s), "found")
    pairs = written(found.where("b IS NOT NULL").select("a", "b").distinct(), "pairs")
    links = _verify(rows, classes, pairs, s)
    labels = components(links.toDF("u", "v"))
    long = found.where("token IS NOT NULL").select("a", "token", "n", "place")
    more = written(cross_pairs(long, classes, labels, s).join(pairs, ["a", "b"], "left_anti"), "cross")
    if not more.isEmpty():
        links = links.union(_verify(rows, classes, more, s))
        labels = components(links.toDF("u", "v"))
    return Joined(sets, links, labels)


def with_components(joined: Joined) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id, component_id and ``first``: whether the row is its component's first.

    The first is the smallest by (doc_id, text hash), null ids last; a document with the empty set is its own.
    """
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = joined.sets.where("n > 0").groupBy("set_id").agg(F.min(order).alias("one"))
    rooted = classes.join(joined.roots.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "set_id", F.coalesce("root", "set_id").alias("root"), "one"
    )
    firsts = rooted.groupBy("root").agg(F.min("one").alias("first_row"))
    named = written(rooted.join(firsts, "root").select("set_id", "first_row"), "components")
    rows = joined.sets.join(named, "set_id", "left")
    return rows.select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        "set_id",
        F.when(F.col("n") > 0, F.col("first_row.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce(order.eqNullSafe(F.col("first_row")), F.col("n") == 0).alias("first"),
    )


def keep_firsts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One document of each component, all columns as they were; documents with the empty set all stay."""
    found = with_components(join_sets(docs, id_col, text_col, settings))
    firsts = written(found.where("first OR n_shingles = 0").select("doc_id", "text_hash", "n_shingles"), "firsts")
    names = ["tidemark_none", "tidemark_doc", "tidemark_text", "tidemark_empty"]
    kept = firsts.select(
        F.col("doc_id").isNull().alias(names[0]),
        F.coalesce("doc_id", F.lit(0)).alias(names[1]),
        F.col("text_hash").alias(names[2]),
        (F.col("n_shingles") == 0).alias(names[3]),
    ).distinct()
    keyed = docs.withColumns(
        {
            names[0]: F.col(id_col).isNull(),
            names[1]: F.coalesce(F.col(id_col).cast("long"), F.lit(0)),
            names[2]: F.xxhash64(text_col),
        }
    ).join(kept, names[:3])
    once = keyed.where(~F.col(names[3])).dropDuplicates(names[:3])
    return once.union(keyed.where(names[3])).select(*docs.columns)
