"""Queries of the operators, with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, decontaminate, ledger, licenses, linededup, mixing, pii, quality, ranked, repair, setjoin, toxicity, warc
from tidemark.llm.oracles import ORACLES as ORACLES
from tidemark.llm.store import new_folder, written

PII_KEY = os.environ.get("TIDEMARK_PII_KEY", "set TIDEMARK_PII_KEY to a secret of your own").encode()
CONTROL_CONVERSATION = -7
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(read(spark, sf_dir, "documents"), PII_KEY, "doc_id")
    spans = F.col(f"{pii.FOUND}.spans")
    return found.select(
        "doc_id", f"{pii.FOUND}.text", F.size(spans).cast("long").alias("n_values"), spans.alias("spans")
    )


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = setjoin.join_sets(read(spark, sf_dir, "documents"))
    return setjoin.with_components(joined).select("doc_id", "n_shingles", "component_id")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(CONTROL_CONVERSATION).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat.read_back(written(chat.format_chats(turns.union(control)), "chats"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    records = warc.plan_records(read(spark, sf_dir, "pages"), dedup_bytes=0)
    files = written(warc.write_archives(records, folder), "warc-files")
    found = warc.read_archives(spark, files, folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return decontaminate.best_hits(hits).select(
        F.col(decontaminate.DOC).alias("doc_id"),
        "item_id",
        "best.similarity",
        (-F.col("best.back")).alias("window_start"),
        F.col("best.n_words").alias("window_words"),
        "best.hamming",
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.cut_lines(read(spark, sf_dir, "documents")).select("doc_id", f"{linededup.CUTS}.*")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = quality.Limits()
    measured = written(quality.measures(read(spark, sf_dir, "documents"), "doc_id", "source"), "measures")
    judged = quality.judge(measured, quality.host_verdicts(measured, "source", limits), "source", limits)
    return judged.select(
        "doc_id",
        f"{quality.MEASURED}.*",
        quality.base_failed(limits).alias("base_failed"),
        quality.is_kept(limits).alias("kept"),
        F.coalesce(f"{quality.VERDICT}.host_rejected", F.lit(False)).alias("host_rejected"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), mixing.Settings(), "doc_id", "source"
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked.build_index(read(spark, sf_dir, "documents"))
    return ranked.search(index, read(spark, sf_dir, "benchmark"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    return repair.report(conversations, repair.repair(repair.damaged(conversations)))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = ledger.Ledger(spark, new_folder(spark, "secrets"))
    book.update(read(spark, sf_dir, "documents"))
    return ledger.digest(book.report())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_jaccard,
        op3_chat,
        op4_decontaminate,
        op5_warc,
        op6_licenses,
        op7_line_dedup,
        op8_quality,
        op9_mixing,
        op10_toxicity,
        op11_search,
        op12_repair,
        op13_secrets,
    )
}
