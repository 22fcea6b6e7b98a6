"""Ranked lexical search over a length-stratified index.

Documents of equal length normaliser m form a stratum. Within a stratum, a term's postings are kept by term frequency, so
that a term's impact is computed once for each frequency and not for each posting. A stratum is stored as blocks of about
``block_postings`` postings, one row a block. A search runs in three passes over the index, each narrow:

1. the document and largest term frequency of every query term in every stratum, which give weights and stratum bounds;
2. the ``first_strata`` strata of the highest bound of each item, which give a score that ``top`` documents reach;
3. all blocks: items whose bound in a block stays below that score are passed over, the others are scored exactly. A task
   hands on at most ``top`` documents an item.

Terms are compared by 64-bit hashes: a chance collision of a query term with another term would count as that term. All
scores are whole numbers below 2^53 and exact. Items are searched in query blocks of about ``block_pairs`` (item, term)
pairs, which bound what the driver holds and sends out.

Defined results: a null or empty text has no term, a document without terms counts in no statistic; repeated rows are
documents of their own; a document with a null id counts in the statistics and is not returned; rows with one item_id form
one item with the terms of all its rows; an item with a null id is not searched; equal scores stand by ascending doc_id; an
empty table on either side gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.store import new_folder, written

FORWARD = "doc_id long, place long, n long, terms array<long>, tfs array<int>"
BLOCKS = (
    "m long, doc_ids array<long>, terms array<long>, term_runs array<int>, run_tfs array<int>, run_starts array<int>, docs array<int>"
)
STRATA = "m long, term long, df long, top_tf int"
HITS = "item int, doc_id long, score long"
RESULT = "item_id long, rank int, doc_id long, score long"
TEXT_BYTES = 1 << 20  # text tokenised at once
GATHERED = 1 << 19  # postings scored at once
# A reader holds a whole row group of wide rows, so groups are small and their size is looked at after every row.
ROW_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "8"}


def _folded() -> np.ndarray:
    """Bytes of terms as they are, A-Z lower-cased; all other ASCII bytes become a blank. Bytes from 0x80 up belong to terms."""
    table = np.full(256, 32, np.uint8)
    for low, high in ((48, 57), (97, 122), (128, 255)):
        table[low : high + 1] = np.arange(low, high + 1)
    table[65:91] = np.arange(97, 123)
    return table


FOLDED = _folded()


@dataclass(frozen=True)
class Settings:
    top: int = 50
    block_postings: int = 1 << 15
    first_strata: int = 8
    block_pairs: int = 1 << 20


@dataclass(frozen=True)
class Index:
    blocks: DataFrame
    n_docs: int
    n_terms: int


def slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text, one row at least."""
    _, bounds = words.buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def term_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of terms of each text, and its distinct term hashes with their frequencies and row bounds."""
    data, bounds = words.buffers(texts)
    data = FOLDED[data]
    starts, ends, firsts = words.spans(data, bounds)
    hashes = words.word_hashes(data, starts, ends, False).view(np.int64)
    lengths = np.diff(firsts)
    row = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return lengths, hashes[at], np.diff(np.append(at, len(hashes))), np.searchsorted(row[at], np.arange(len(lengths) + 1))


def as_lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def forward(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Terms and frequencies of every document that has a term; ``place`` is its place among its task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            for part in slices(batch, 1, TEXT_BYTES):
                lengths, terms, tfs, bounds = term_counts(part.column(1))
                columns = [
                    part.column(0),
                    pa.array(np.arange(place, place + part.num_rows)),
                    pa.array(lengths, pa.int64()),
                    as_lists(terms, bounds, pa.int64()),
                    as_lists(tfs, bounds, pa.int32()),
                ]
                place += part.num_rows
                out = pa.RecordBatch.from_arrays(columns, names=["doc_id", "place", "n", "terms", "tfs"])
                yield out.filter(pa.array(lengths > 0))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, FORWARD)


def block_of(m: int, ids: list, terms: np.ndarray, tfs: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    """One block: postings in the order of term, frequency and document."""
    order = np.lexsort((docs, tfs, terms))
    terms, tfs, docs = terms[order], tfs[order], docs[order]
    new_term = np.ones(len(terms), bool)
    new_term[1:] = terms[1:] != terms[:-1]
    new_run = new_term.copy()
    new_run[1:] |= tfs[1:] != tfs[:-1]
    term_at, run_at = np.flatnonzero(new_term), np.flatnonzero(new_run)
    values = [
        (ids, pa.int64()),
        (terms[term_at], pa.int64()),
        (np.append(np.searchsorted(run_at, term_at), len(run_at)), pa.int32()),
        (tfs[run_at], pa.int32()),
        (np.append(run_at, len(terms)), pa.int32()),
        (docs, pa.int32()),
    ]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind)) for x, kind in values]
    return pa.RecordBatch.from_arrays([pa.array([m], pa.int64()), *lists], names=[c.split()[0] for c in BLOCKS.split(", ")])


def blocks_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Blocks from documents in the order of m; a block ends with its stratum or at about ``size`` postings."""
    m, ids, parts, held = None, [], [], 0

    def closed() -> pa.RecordBatch:
        counts = [len(terms) for terms, _ in parts]
        docs = np.repeat(np.arange(len(parts)), counts)
        return block_of(m, ids, *(np.concatenate(x) for x in zip(*parts, strict=True)), docs)

    for batch in batches:
        normalisers = batch.column("m").to_numpy()
        names = batch.column("doc_id").to_pylist()
        terms, tfs = batch.column("terms"), batch.column("tfs")
        bounds = terms.offsets.to_numpy()
        all_terms, all_tfs = (x.values.to_numpy() for x in (terms, tfs))
        tf_bounds = tfs.offsets.to_numpy()
        for i, own in enumerate(normalisers):
            if parts and (own != m or held >= size):
                yield closed()
                ids, parts, held = [], [], 0
            m = own
            ids.append(names[i])
            some = all_terms[bounds[i] : bounds[i + 1]]
            # copies, so that a block does not hold on to its batches
            parts.append((some.copy(), all_tfs[tf_bounds[i] : tf_bounds[i + 1]].copy()))
            held += len(some)
    if parts:
        yield closed()


def build_index(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of all documents, written to the shared folder.

    Documents are dealt out by ranges of (m, place), so a stratum holding any share of the rows spreads over many tasks.
    """
    terms = written(forward(docs, id_col, text_col), "search-terms")
    n_docs, n_terms = terms.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.expr(f"50 + (50 * n * {n_docs}L) div {max(n_terms, 1)}L")
    rows = terms.select(m.alias("m"), "place", "doc_id", "terms", "tfs")
    rows = rows.repartitionByRange("m", "place").sortWithinPartitions("m").drop("place")
    blocks = rows.mapInArrow(lambda batches: blocks_of(batches, settings.block_postings), BLOCKS)
    path = new_folder(docs.sparkSession, "search-index")
    blocks.write.options(**ROW_GROUPS).parquet(path)
    return Index(docs.sparkSession.read.schema(blocks.schema).parquet(path), n_docs, n_terms)


class Block:
    """One row of the index as numpy arrays."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        self.m = batch.column("m")[row].as_py()
        for name in batch.schema.names[1:]:
            values = batch.column(name)[row].values
            if name == "doc_ids":
                self.known = values.is_valid().to_numpy(zero_copy_only=False)
                values = values.fill_null(0)
            setattr(self, name, values.to_numpy())

    def places(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which terms of the vocabulary the block holds, and where."""
        at = np.minimum(np.searchsorted(self.terms, vocabulary), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == vocabulary)
        return hit, at[hit]

    def impacts(self) -> np.ndarray:
        """One impact for each frequency of each term."""
        tf = self.run_tfs.astype(np.int64)
        return 1_000_000_000 * tf // (1000 * tf + 20 * self.m)


def stratum_rows(blocks: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Document frequency and largest term frequency of the vocabulary's terms, by stratum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row)
                hit, at = block.places(vocabulary)
                first, last = block.term_runs[at], block.term_runs[at + 1]
                columns = [
                    pa.array(np.full(len(hit), block.m)),
                    pa.array(vocabulary[hit]),
                    pa.array((block.run_starts[last] - block.run_starts[first]).astype(np.int64)),
                    pa.array(block.run_tfs[last - 1]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["m", "term", "df", "top_tf"])

    found = blocks.select("m", "terms", "term_runs", "run_tfs", "run_starts").mapInArrow(run, STRATA)
    return found.groupBy("m", "term").agg(F.sum("df").alias("df"), F.max("top_tf").alias("top_tf"))


@dataclass(frozen=True)
class Items:
    """A query block: pairs of item and term, sorted by item; ``term`` is a place in the vocabulary."""

    vocabulary: np.ndarray
    item: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    reached: np.ndarray  # a score that the item's ``top``-th document reaches at least
    strata: dict[int, np.ndarray] | None  # the items to visit in a stratum; None: all, everywhere


class Best:
    """The best documents of every item that one task has seen."""

    def __init__(self, reached: np.ndarray, top: int):
        self.reached, self.top = np.maximum(reached, 1.0), top
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        self.rows.append((item, doc, score))
        self.held += len(item)
        if self.held > 1 << 16:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keep ``top`` documents an item; the last of them is the score to reach from now on."""
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        item, doc, score = (np.concatenate(x) for x in zip(empty, *self.rows, strict=True))
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = rank == self.top - 1
        self.reached[item[last]] = np.maximum(self.reached[item[last]], score[last])
        kept = rank < self.top
        self.rows = [(item[kept], doc[kept], score[kept])]
        self.held = int(kept.sum())
        return self.rows[0]


def visit(block: Block, items: Items, best: Best) -> None:
    """Score a block's documents for every item whose bound reaches the score the item needs."""
    hit, at = block.places(items.vocabulary)
    if not len(hit):
        return
    impact = block.impacts().astype(float)
    first, last = block.term_runs[at], block.term_runs[at + 1]
    place = np.full(len(items.vocabulary), -1)
    place[hit] = np.arange(len(hit))
    pairs = np.flatnonzero(place[items.term] >= 0)
    if items.strata is not None:
        pairs = pairs[np.isin(items.item[pairs], items.strata.get(block.m, ()))]
    bound = np.bincount(
        items.item[pairs], items.weight[pairs] * impact[last - 1][place[items.term[pairs]]], len(best.reached)
    )
    pairs = pairs[bound[items.item[pairs]] >= best.reached[items.item[pairs]]]
    if not len(pairs):
        return
    begin, end = block.run_starts[first].astype(np.int64), block.run_starts[last].astype(np.int64)
    impact = np.repeat(impact, np.diff(block.run_starts))
    n_docs = len(block.doc_ids)
    item = items.item[pairs]
    own = place[items.term[pairs]]
    sizes = (end - begin)[own]
    heads = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
    work = np.add.reduceat(sizes, heads) + n_docs
    groups = np.cumsum(work) // GATHERED
    cuts = np.append(heads[np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))], len(pairs))
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        some, size = item[low:high], sizes[low:high]
        names, local = np.unique(some, return_inverse=True)
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        posting = np.repeat(begin[own[low:high]], size) + step
        scores = np.bincount(
            np.repeat(local * n_docs, size) + block.docs[posting],
            np.repeat(items.weight[pairs[low:high]], size) * impact[posting],
            len(names) * n_docs,
        ).reshape(len(names), n_docs)
        found, doc = np.nonzero((scores >= best.reached[names][:, None]) & block.known)
        best.add(names[found], block.doc_ids[doc], scores[found, doc])


def hits(blocks: DataFrame, items: Items, top: int) -> DataFrame:
    """The best documents of every item in each task's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(items.reached.copy(), top)
        for batch in batches:
            for row in range(batch.num_rows):
                visit(Block(batch, row), items, best)
        item, doc, score = best.cut()
        columns = [pa.array(item, pa.int32()), pa.array(doc, pa.int64()), pa.array(score.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return blocks.mapInArrow(run, HITS)


def ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def weight(n_docs: int) -> Column:
    return F.floor(1000 * F.ln(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    found = forward(items.where(F.col(id_col).isNotNull()), id_col, text_col)
    return found.select(F.col("doc_id").alias("item_id"), F.explode("terms").alias("term")).distinct()


def search_block(index: Index, pairs: DataFrame, settings: Settings) -> DataFrame | None:
    """The best documents of the items of one query block."""
    rows = pairs.select("item_id", "term").orderBy("item_id", "term").toArrow()
    if not rows.num_rows or not index.n_docs:
        return None
    names, item = np.unique(rows.column("item_id").to_numpy(), return_inverse=True)
    vocabulary, term = np.unique(rows.column("term").to_numpy(), return_inverse=True)
    strata = written(stratum_rows(index.blocks, vocabulary), "search-strata")
    weights = strata.groupBy("term").agg(F.sum("df").alias("df")).select("term", weight(index.n_docs).alias("w"))
    known = weights.toArrow()
    by_term = np.zeros(len(vocabulary))
    by_term[np.searchsorted(vocabulary, known.column("term").to_numpy())] = known.column("w").to_numpy()

    impact = F.expr("(1000000000L * top_tf) div (1000L * top_tf + 20L * m)")
    bounds = (
        strata.join(weights, "term").join(pairs, "term").groupBy("item_id", "m").agg(F.sum(F.col("w") * impact).alias("bound"))
    )
    order = Window.partitionBy("item_id").orderBy(F.desc("bound"), "m")
    first = bounds.withColumn("place", F.row_number().over(order)).where(F.col("place") <= settings.first_strata)
    visits: dict[int, list[int]] = {}
    for row in first.select("item_id", "m").collect():
        visits.setdefault(row.m, []).append(int(np.searchsorted(names, row.item_id)))

    query = Items(vocabulary, item, term, by_term[term], np.zeros(len(names)), {m: np.array(x) for m, x in visits.items()})
    some = index.blocks.where(F.col("m").isin(list(visits)))
    seen = ranked(hits(some, query, settings.top), settings.top).groupBy("item").agg(
        F.count("*").alias("n"), F.min("score").alias("score")
    )
    reached = np.zeros(len(names))
    for row in seen.where(F.col("n") == settings.top).collect():
        reached[row.item] = row.score
    whole = Items(vocabulary, item, term, by_term[term], reached, None)
    best = ranked(hits(index.blocks, whole, settings.top), settings.top)
    ids = index.blocks.sparkSession.createDataFrame(
        [(i, int(name)) for i, name in enumerate(names)], "item int, item_id long"
    )
    return best.join(ids, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(
    index: Index, items: DataFrame, settings: Settings = Settings(), id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """item_id, rank, doc_id and score of every item's ``top`` best documents with a score above 0."""
    spark = items.sparkSession
    pairs = written(item_terms(items, id_col, text_col), "search-items")
    n_blocks = max(1, -(-pairs.count() // settings.block_pairs))
    block = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks))
    results = [search_block(index, pairs.where(block == i), settings) for i in range(n_blocks)]
    results = [written(r, "search-results") if n_blocks > 1 else r for r in results if r is not None]
    out = results[0] if results else spark.createDataFrame([], RESULT)
    for more in results[1:]:
        out = out.union(more)
    return out
