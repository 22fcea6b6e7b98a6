"""The jobs end to end, with folders of raw messages in place of topics."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import wire
from tidemark.operators import lateness, rules, shape, summary
from tidemark.params import AlertParams, SummaryParams
from tidemark.schemas import ALERT, ENVELOPE, GENERATED_TRANSACTION, SUMMARY_WIRE, TELEMETRY, TRANSACTION
from tidemark.sources import database, replayed, synthetic, topics
from tidemark.streaming import batches, ingest, jobs

INTAKE = jobs.Intake(frozenset({3}), max_rows=1_000_000)  # the id that messages here carry


def as_topic(df, schema, folder):
    """Store records as raw messages: (key, value bytes, topic, partition, offset, timestamp)."""
    body = wire.framed(wire.encode_record(F.struct(*schema.names), schema), 3)
    df.select(
        F.col("key").cast("binary").alias("key"),
        body.alias("value"),
        F.lit("t").alias("topic"),
        "partition",
        "offset",
        F.col("record_time").alias("timestamp"),
    ).write.parquet(folder)


@pytest.fixture
def wired(spark, folder, monkeypatch):
    """Jobs read ``{folder}/in`` and write ``{folder}/out`` until the input is drained."""

    def read_topic(session, params, streaming=True, **limits):
        return session.readStream.schema(ENVELOPE).parquet(f"{folder}/in")

    def topic_writer(encoded, params, checkpoint, mode):
        class Once:
            def trigger(self, **_):
                return self

            def start(self):
                out = encoded.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
                write = lambda batch, n: batch.withColumn("n", F.lit(n)).write.mode("append").parquet(f"{folder}/out")
                return out.trigger(availableNow=True).foreachBatch(write).start()

        return Once()

    monkeypatch.setattr(topics, "read_topic", read_topic)
    monkeypatch.setattr(topics, "topic_writer", topic_writer)
    monkeypatch.setattr(topics, "write_topic", lambda encoded, params: encoded.write.mode("append").parquet(f"{folder}/out"))
    original = jobs.writer
    monkeypatch.setattr(jobs, "writer", lambda *a, **k: original(*a, **{**k, "once": True}))
    return folder


def decoded(spark, folder, schema):
    raw = spark.read.parquet(f"{folder}/out")
    value = wire.decode_record(wire.payload_if_framed("value"), schema)
    return raw.select(F.col("key").cast("string").alias("k"), value.alias("v")).select("k", "v.*")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_alert_job(spark, wired, small):
    telemetry = replayed.telemetry(replayed.events(spark, small))
    messages = telemetry.withColumns(
        {"key": F.col("sensor_id"), "partition": F.lit(0), "offset": F.lit(0).cast("bigint"), "record_time": F.current_timestamp()}
    )
    as_topic(messages, TELEMETRY, f"{wired}/in")
    jobs.run_alerts(spark, AlertParams(), f"{wired}/checkpoint", 42, INTAKE).awaitTermination()
    out = decoded(spark, wired, ALERT)
    assert same(out.drop("k"), rules.raise_alerts(telemetry))
    assert out.where("k <> sensor_id").count() == 0


@pytest.fixture
def sales_topic(spark, wired, small):
    """Record times differ from the payload's times, and only the former count."""
    sales = replayed.transactions(replayed.events(spark, small))
    messages = sales.withColumn("record_time", F.col("timestamp")).withColumn("timestamp", F.lit(datetime(2000, 1, 1)))
    as_topic(messages, TRANSACTION, f"{wired}/in")
    return sales


def test_summary_job(spark, wired, sales_topic):
    params = SummaryParams(window_minutes=60)
    jobs.run_summary(spark, params, f"{wired}/checkpoint", 42, INTAKE).awaitTermination()
    out = decoded(spark, wired, SUMMARY_WIRE)
    expected = summary.summarize(sales_topic, 60).withColumn("total_quantity", F.col("total_quantity").cast("int"))
    assert same(out.drop("k"), expected)
    assert out.where("k <> category").count() == 0


def test_strict_summary_job(spark, wired, sales_topic):
    params = SummaryParams(window_minutes=60)
    jobs.run_strict_summary(spark, params, f"{wired}/checkpoint", 42, INTAKE).awaitTermination()
    kept = lateness.drop_late(sales_topic, 60)
    expected = summary.summarize(kept, 60).withColumn("total_quantity", F.col("total_quantity").cast("int"))
    assert same(decoded(spark, wired, SUMMARY_WIRE).drop("k"), expected)


def test_store_job(spark, folder, monkeypatch):
    """All generated messages arrive at the table, rounded and timed by their record; foreign ones in their folder."""
    made = synthetic.transactions(synthetic.row_numbers(spark, 200)).withColumns(
        {"partition": F.lit(0), "offset": F.lit(0).cast("bigint"), "record_time": F.timestamp_seconds(F.lit(1_700_000_000) + F.monotonically_increasing_id())}
    )
    as_topic(made, GENERATED_TRANSACTION, f"{folder}/in")
    stray = spark.createDataFrame([(b"k", b"{json}", "t", 0, 9, datetime(2024, 1, 1))], ENVELOPE)
    stray.write.mode("append").parquet(f"{folder}/in")
    stored = f"{folder}/table"
    monkeypatch.setattr(
        database, "insert", lambda rows, table, connections: rows.write.mode("append").parquet(stored)
    )
    raw = spark.readStream.schema(ENVELOPE).parquet(f"{folder}/in")
    intake = replace(INTAKE, foreign_folder=f"{folder}/foreign")
    out = ingest.store_transactions(raw, database.JdbcTable("jdbc:none", "t"), f"{folder}/checkpoint", intake)
    out.trigger(availableNow=True).start().awaitTermination()
    table = spark.read.parquet(stored)
    assert table.count() == 200
    for query in spark.streams.active:
        query.processAllAvailable()
        query.stop()
    assert [r.offset for r in spark.read.parquet(f"{folder}/foreign").collect()] == [9]
    assert dict(table.dtypes)["price"] == "decimal(10,2)"
    assert table.where("timestamp IS NULL OR timestamp <> date_trunc('second', timestamp)").count() == 0


def test_poll_job(spark, folder, small):
    """Ticks read every row once, keep their offset, and repeat after a failure."""
    events = replayed.events(spark, small).cache()
    start = datetime(2024, 1, 1)
    hours = iter([24, 24, 300, 300, 300, 800])
    sent, fail = [], {"next": False}

    def send(rows):
        if fail["next"]:
            fail["next"] = False
            raise RuntimeError("broker away")
        sent.append(sorted(r.event_id for r in rows.select("event_id").collect()))

    poll = ingest.TablePoll(
        lambda session, last: database.read_increment(events, "ts", last, start + timedelta(hours=next(hours))),
        send,
        f"{folder}/offsets",
    )
    tick = spark.range(1)
    poll(tick, 0)
    poll(tick, 1)
    fail["next"] = True
    with pytest.raises(RuntimeError):
        poll(tick, 2)
    poll(tick, 2)
    poll(tick, 3)
    poll(tick, 4)
    assert sorted(i for rows in sent for i in rows) == list(range(1000))
    assert len(sent) == 3
    kept = spark.read.option("basePath", f"{folder}/offsets").parquet(f"{folder}/offsets")
    assert {r.batch_id for r in kept.select("batch_id").collect()} == {3, 4}
    events.unpersist()


def test_clock_drives_polls(spark, folder):
    seen = []
    poll = ingest.TablePoll(lambda s, last: (None, last), seen.append, f"{folder}/offsets")
    query = ingest.poll_table(poll, ingest.clock_stream(spark), f"{folder}/checkpoint", "0 seconds").start()
    try:
        query.processAllAvailable()
        assert batches.read_batch(spark, f"{folder}/offsets", query.lastProgress["batchId"], ingest.OFFSET).count() == 1
    finally:
        query.stop()
    assert seen == []


def test_sales_messages(spark, small):
    rows = shape.round_price(replayed.transactions(replayed.events(spark, small)))
    out = ingest.sales_messages(rows)
    assert out.columns == ["key", "value", "topic"]
    assert out.where("key <> value.category OR topic <> 'sales-transactions'").count() == 0
    assert out.schema["value"].dataType.names == TRANSACTION.names


@pytest.mark.parametrize(("kind", "schema", "key"), [("telemetry", TELEMETRY, "sensor_id"), ("transactions", GENERATED_TRANSACTION, "transaction_id")])
def test_generated_messages(spark, kind, schema, key):
    messages = ingest.generated_messages(kind, synthetic.row_numbers(spark, 50), 8)
    back = messages.select(
        F.col("key").cast("string").alias("k"), wire.decode_record(wire.payload_if_framed("value"), schema).alias("v")
    )
    assert back.where(f"k <> v.{key}").count() == 0 and back.count() == 50


def updates_folder(spark, folder):
    schema = "category string, window_start bigint, total bigint"
    parts = [[("a", 0, 1), ("b", 0, 5)], [("a", 0, 3)], [("a", 60, 7)], [("b", 0, 6)], [("a", 60, 8)]]
    for batch_id, rows in enumerate(parts):
        batches.write_batch(spark.createDataFrame(rows, schema), folder, batch_id)
    return spark.createDataFrame([], schema).schema


KEY = ["category", "window_start"]
LATEST = [("a", 0, 3), ("a", 60, 8), ("b", 0, 6)]


def newest(spark, folder, schema):
    return sorted(tuple(r) for r in batches.last_wins(batches.read_changelog(spark, folder, schema), KEY).collect())


def test_last_wins_after_a_repeated_batch(spark, folder):
    schema = updates_folder(spark, f"{folder}/u")
    assert newest(spark, f"{folder}/u", schema) == LATEST
    batches.write_batch(spark.createDataFrame([("a", 0, 3)], schema), f"{folder}/u", 1)
    assert newest(spark, f"{folder}/u", schema) == LATEST


def test_updates_can_be_written_to_few_files(spark, folder):
    frame = spark.range(0, 100, 1, 10).selectExpr("'a' AS category", "id AS window_start", "id AS total")
    batches.upsert_batches(f"{folder}/u", files=2)(frame, 0)
    assert len(spark.read.parquet(f"{folder}/u").inputFiles()) == 2


def test_compaction_keeps_the_table(spark, folder):
    schema = updates_folder(spark, f"{folder}/u")
    batches.compact(spark, f"{folder}/u", schema, KEY)
    assert batches.batch_ids(spark, f"{folder}/u") == [2, 3, 4]
    assert newest(spark, f"{folder}/u", schema) == LATEST
    batches.compact(spark, f"{folder}/u", schema, KEY)
    batches.write_batch(spark.createDataFrame([("a", 0, 9)], schema), f"{folder}/u", 5)
    assert newest(spark, f"{folder}/u", schema) == [("a", 0, 9), *LATEST[1:]]


def test_interrupted_compaction_is_harmless(spark, folder, monkeypatch):
    schema = updates_folder(spark, f"{folder}/u")
    with monkeypatch.context() as stopped:
        stopped.setattr(batches, "remove_batch", lambda *a: None)
        batches.compact(spark, f"{folder}/u", schema, KEY)
    assert batches.batch_ids(spark, f"{folder}/u") == [0, 1, 2, 3, 4]
    assert newest(spark, f"{folder}/u", schema) == LATEST
    batches.compact(spark, f"{folder}/u", schema, KEY)
    assert newest(spark, f"{folder}/u", schema) == LATEST
