"""Command line of the jobs: ``spark-submit job.py <job>`` or ``python -m tidemark <job>``.

Settings come from the environment (see ``params.ENVIRONMENT``). Besides, every job needs
CHECKPOINT_LOCATION. What is written to a topic carries SCHEMA_ID; what is read from one must carry one of
INPUT_SCHEMA_IDS (comma-separated), and anything else stops the job or goes to FOREIGN_FOLDER. Instead, WRITER_SCHEMAS may
hold a JSON object of schema id and Avro schema: each message is then decoded by its own and resolved to the job's.
MAX_OFFSETS_PER_TRIGGER bounds a micro-batch (``strict-summary`` needs it) and MIN_PARTITIONS splits hot topic
partitions. The table jobs read JDBC_URL, JDBC_DRIVER, JDBC_USER and JDBC_PASSWORD; ``poll`` needs JDBC_SLICES and takes
JDBC_HASH_SQL with JDBC_HASH_PARTS; ``store`` takes CLASH_FOLDER.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from .functions import evolution
from .params import AlertParams, JobParams, ParameterError, SummaryParams
from .session import use_utc
from .sources import synthetic, topics
from .sources.database import JdbcTable
from .streaming import ingest, jobs


def _required(name: str) -> str:
    value = os.environ.get(name, "").strip()
    if not value:
        raise ParameterError(f"{name} must be set")
    return value


def _table() -> JdbcTable:
    named = {"driver": "JDBC_DRIVER", "user": "JDBC_USER", "password": "JDBC_PASSWORD"}
    options = {option: os.environ[name] for option, name in named.items() if os.environ.get(name)}
    return JdbcTable(_required("JDBC_URL"), os.environ.get("JDBC_TABLE", "sales_transactions"), options)


def _number(name: str, required: bool = False) -> int | None:
    text = _required(name) if required else os.environ.get(name, "").strip()
    if not text:
        return None
    if not text.isdigit() or int(text) < 1:
        raise ParameterError(f"{name}={text!r} is not a positive number")
    return int(text)


def _schema_ids():
    if os.environ.get("WRITER_SCHEMAS"):
        try:
            return evolution.read_registry(os.environ["WRITER_SCHEMAS"])
        except ValueError as error:
            raise ParameterError(f"WRITER_SCHEMAS: {error}") from error
    numbers = _required("INPUT_SCHEMA_IDS").split(",")
    if not all(number.strip().isdigit() for number in numbers):
        raise ParameterError("INPUT_SCHEMA_IDS must be numbers separated by commas")
    return frozenset(int(number) for number in numbers)


def _intake(bounded: bool = False) -> jobs.Intake:
    return jobs.Intake(
        _schema_ids(),
        _number("MAX_OFFSETS_PER_TRIGGER", required=bounded),
        _number("MIN_PARTITIONS"),
        os.environ.get("FOREIGN_FOLDER") or None,
    )


def _slicing() -> dict:
    found = {"slices": _number("JDBC_SLICES", required=True)}
    if os.environ.get("JDBC_HASH_SQL"):
        found |= {"hash_sql": os.environ["JDBC_HASH_SQL"], "hash_parts": _number("JDBC_HASH_PARTS", required=True)}
    return found


def start(spark: SparkSession, job: str):
    checkpoint = _required("CHECKPOINT_LOCATION")
    if job == "store":
        params = JobParams("store-transactions", "_transactions", "sales_transactions")
        table, intake = _table(), _intake()
        raw = topics.read_topic(spark, params, max_rows=intake.max_rows, min_partitions=intake.min_partitions)
        clashes = os.environ.get("CLASH_FOLDER") or None
        return ingest.store_transactions(raw, table, checkpoint, intake, clashes).start()
    schema_id = _number("SCHEMA_ID", required=True)
    if job == "alerts":
        return jobs.run_alerts(spark, AlertParams.from_env(), checkpoint, schema_id, _intake())
    if job == "summary":
        return jobs.run_summary(spark, SummaryParams.from_env(), checkpoint, schema_id, _intake())
    if job == "strict-summary":
        return jobs.run_strict_summary(spark, SummaryParams.from_env(), checkpoint, schema_id, _intake(bounded=True))
    if job == "poll":
        servers = SummaryParams.from_env().bootstrap_servers
        read = ingest.read_table(_table(), **_slicing())
        poll = ingest.TablePoll(read, ingest.send_sales(servers, schema_id), f"{checkpoint}/offsets")
        return ingest.poll_table(poll, ingest.clock_stream(spark), checkpoint).start()
    kind = job.removeprefix("generate-")
    target = {"telemetry": "sensor-telemetry", "transactions": "_transactions"}[kind]
    params = JobParams(job, "-", target)
    messages = ingest.generated_messages(kind, synthetic.row_stream(spark), schema_id)
    return topics.topic_writer(messages, params, checkpoint, "append").start()


JOBS = ("alerts", "summary", "strict-summary", "store", "poll", "generate-telemetry", "generate-transactions")


def main() -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    job = parser.parse_args().job
    spark = use_utc(SparkSession.builder.appName(f"tidemark-{job}").getOrCreate())
    start(spark, job)
    jobs.supervise(spark)


if __name__ == "__main__":
    main()
