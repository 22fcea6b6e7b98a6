"""A training corpus from raw documents: rules, line dedup, near duplicates, decontamination, mixing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, linededup, mixing, quality, setjoin
from tidemark.llm.catalog import read
from tidemark.llm.store import written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their own rules and their host's verdict let through."""
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated passages cut out; a document of which nothing is left goes."""
    return linededup.dedup_lines(docs).where(F.trim("text") != "")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return setjoin.keep_firsts(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the rate and the number of copies that meet the target weights."""
    return mixing.mix(docs, read(spark, sf_dir, "labels"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("line dedup", dedup_lines),
    ("near duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# The classifier, the fitted rates and 64-bit hashes are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None
