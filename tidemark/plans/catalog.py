"""Every query the repository answers, as (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import evolution, wire
from ..operators import lateness, rules, shape, summary, tablekey
from ..params import AlertParams
from ..schemas import ALERT, SUMMARY, SUMMARY_WIRE, TELEMETRY, TRANSACTION
from ..session import shared_dir, use_rocksdb_state, written_to
from ..sources import database, replayed, synthetic, topics
from ..streaming import batches, ingest, jobs, keyed, processor, store, strict
from . import tables

Query = Callable[[SparkSession, str], DataFrame]


def _telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replayed.telemetry(replayed.events(spark, sf_dir))


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replayed.transactions(replayed.events(spark, sf_dir))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions reduced to the six fields of the record."""
    return _transactions(spark, sf_dir).select(*TRANSACTION.names)


# --- alerts ---------------------------------------------------------------------------------


def _alerts(*chosen: rules.Rule) -> Query:
    return lambda spark, sf_dir: rules.raise_alerts(_telemetry(spark, sf_dir), chosen or None)


def alerts_as_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = AlertParams(humidity_rule="above")
    return rules.raise_alerts(_telemetry(spark, sf_dir), rules.default_rules(params))


def alerts_custom_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = AlertParams(temperature_threshold=40.5, humidity_threshold=0.29)
    return rules.raise_alerts(_telemetry(spark, sf_dir), rules.default_rules(params))


def alerts_union_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-branch form; it scans twice and exists to check the single pass."""
    telemetry = _telemetry(spark, sf_dir)
    hot, dry = rules.default_rules()
    return rules.raise_alerts(telemetry, [hot]).unionByName(rules.raise_alerts(telemetry, [dry]))


def alerts_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = rules.keyed_alerts(rules.raise_alerts(_telemetry(spark, sf_dir)))
    return keyed.select("key", "value.alert_type", "value.timestamp")


def alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = replayed.telemetry(replayed.event_stream(spark, sf_dir))
    root = shared_dir(spark, "alerts-stream")
    jobs.alerts_to_files(stream, f"{root}/out", f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(ALERT).parquet(f"{root}/out")


# --- summaries ------------------------------------------------------------------------------


def _summary(window_minutes: int) -> Query:
    return lambda spark, sf_dir: summary.summarize(_transactions(spark, sf_dir), window_minutes)


def summary_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _transactions(spark, sf_dir).withColumn("key", F.nullif("key", F.lit("view")))
    return summary.summarize(keyed, 60)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded sales messages: published 90 minutes after their payload's time, every fifth without a value."""
    rows = _transactions(spark, sf_dir)
    value = F.when(F.col("quantity") % 5 != 0, F.struct(*TRANSACTION.names))
    return rows.select(
        "key", value.alias("value"), F.lit("sales-transactions").alias("topic"), "partition", "offset",
        (F.col("timestamp") + F.expr("INTERVAL 90 MINUTES")).alias("timestamp"),
    )


def summary_record_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows by the record time of messages; those without a value never count."""
    present = summary.with_key_and_value(_messages(spark, sf_dir), value="value")
    return summary.summarize(shape.unpack(present), 60, time_col="kafka_timestamp")


def summary_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = summary.keyed_summary(summary.summarize(_transactions(spark, sf_dir), 60))
    return keyed.select("key", "value.total_quantity", "value.window_start")


def window_aggregate_60min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other aggregates than the summary's over the same windows."""
    folds = [
        F.count(F.lit(1)).alias("sales"),
        F.min("price").alias("lowest"),
        F.max("price").alias("highest"),
        F.max("quantity").alias("largest"),
    ]
    return summary.window_aggregate(_transactions(spark, sf_dir), 60, folds)


def _summary_strict(window_minutes: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        kept = lateness.drop_late(
            _transactions(spark, sf_dir), window_minutes, work_dir=shared_dir(spark, "expiry")
        )
        return summary.summarize(kept, window_minutes)

    return query


def summary_strict_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyless records are skipped before they could advance the time of their partition."""
    keyed = _transactions(spark, sf_dir).withColumn("key", F.nullif("key", F.lit("view")))
    return summary.summarize(lateness.drop_late(keyed, 60, work_dir=shared_dir(spark, "expiry")), 60)


def summary_updates_60min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog of the strict summary, one update per accepted record."""
    accepted = lateness.drop_late(_transactions(spark, sf_dir), 60, work_dir=shared_dir(spark, "expiry"))
    return summary.update_stream(accepted, 60)


def summary_updates_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict changelog thinned to one update per window and commit, a commit coming every 500,000 offsets."""
    accepted = lateness.drop_late(_transactions(spark, sf_dir), 60, work_dir=shared_dir(spark, "expiry"))
    return summary.update_ticks(accepted, F.call_function("div", F.col("offset"), F.lit(500_000)), 60)


def summary_exact_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly totals of prices that are multiples of 2^-20."""
    fine = F.floor(F.col("price") * F.lit(2.0**20)) + F.pmod("offset", F.lit(1021))
    rows = _transactions(spark, sf_dir).withColumn("price", fine / F.lit(2.0**20))
    return summary.summarize_exact(rows, 60)


def late_metrics_60min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records three micro-batches of the strict summary kept and dropped, as the job reports them."""
    root = shared_dir(spark, "late-metrics")
    reported: dict[int, tuple[int, int]] = {}
    job = strict.StrictSummary(f"{root}/state", 60, report=lambda number, kept, late: reported.update({number: (kept, late)}))
    columns = ("key", "quantity", "price", "timestamp", "partition", "offset")
    for stream in _deliveries(spark, sf_dir, root, _third_of_offsets(spark, sf_dir), *columns):
        jobs.writer(stream, f"{root}/checkpoint", "append", once=True).foreachBatch(job).start().awaitTermination()
    rows = [(number, *counts) for number, counts in sorted(reported.items())]
    return spark.createDataFrame(rows, "batch_id long, kept long, late long")


def late_rows_60min(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = lateness.late_only(_transactions(spark, sf_dir), 60, work_dir=shared_dir(spark, "expiry"))
    return late.select("transaction_id", "partition", "offset", F.unix_micros("timestamp").alias("timestamp_us"))


def stream_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = lateness.with_stream_time(_transactions(spark, sf_dir))
    return timed.select(
        "partition",
        "offset",
        F.unix_micros("timestamp").alias("timestamp_us"),
        F.unix_micros("stream_time").alias("stream_time_us"),
    )


def _stream_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replayed.transactions(replayed.event_stream(use_rocksdb_state(spark), sf_dir))


def summary_stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = jobs.summary_updates(_stream_sales(spark, sf_dir))
    root = shared_dir(spark, "summary-update")
    jobs.summary_to_table(updates, f"{root}/updates", f"{root}/checkpoint", once=True).awaitTermination()
    changelog = batches.read_changelog(spark, f"{root}/updates", SUMMARY)
    return batches.last_wins(changelog, ["category", "window_start", "window_end"])


def summary_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = jobs.summary_updates(_stream_sales(spark, sf_dir))
    root = shared_dir(spark, "summary-append")
    jobs.closed_windows(updates, f"{root}/out", f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(SUMMARY).parquet(f"{root}/out")


def summary_stream_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries in offset order, each drained as one micro-batch before the next arrives."""
    arrivals = _transactions(spark, sf_dir).select("key", "quantity", "price", "timestamp", "partition", "offset")
    root = shared_dir(spark, "summary-strict")
    arrivals = written_to(arrivals, f"{root}/all")  # derived once; the offsets of a delivery are pushed to this table
    job = strict.StrictSummary(f"{root}/state", 60)
    end = arrivals.agg(F.max("offset")).first()[0] + 1
    for i in range(3):
        part = arrivals.where((F.col("offset") >= end * i // 3) & (F.col("offset") < end * (i + 1) // 3))
        part.write.parquet(f"{root}/arrivals/delivery={i}")
        stream = spark.readStream.schema(arrivals.schema).parquet(f"{root}/arrivals")
        jobs.writer(stream, f"{root}/checkpoint", "append", once=True).foreachBatch(job).start().awaitTermination()
    return job.result(spark)


def summary_stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals over three deliveries, each a new start on the same checkpoint, with every tenth record a delivery late.

    Deliveries are cut at noon, so a day's window is updated from two of them; a record is dropped if its day ended
    before the latest time of the deliveries before its own.
    """
    sales = _transactions(use_rocksdb_state(spark), sf_dir).select(
        "key", "quantity", "price", "timestamp", F.endswith("transaction_id", F.lit("0")).cast("int").alias("late")
    )
    cuts = sum((F.col("timestamp") >= f"2024-01-{day} 12:00:00").cast("int") for day in (11, 21))
    root = shared_dir(spark, "summary-batches")
    sales.withColumn("delivery", F.least(F.lit(2), cuts + F.col("late"))).write.partitionBy("delivery").parquet(f"{root}/arrivals")
    for i in range(3):
        arrived = spark.read.schema(sales.schema).parquet(f"{root}/arrivals/delivery={i}")
        arrived.write.mode("append").parquet(f"{root}/topic")
        stream = spark.readStream.schema(sales.schema).parquet(f"{root}/topic")
        updates = jobs.summary_updates(stream, 1440)
        jobs.summary_to_table(updates, f"{root}/updates", f"{root}/checkpoint", once=True).awaitTermination()
    changelog = batches.read_changelog(spark, f"{root}/updates", SUMMARY)
    return batches.last_wins(changelog, ["category", "window_start", "window_end"])


def _deliveries(spark: SparkSession, sf_dir: str, root: str, number: Column, *columns: str) -> Iterator[DataFrame]:
    """Three deliveries to one folder; each is there when its stream is handed out, for a new start on one checkpoint."""
    rows = written_to(_transactions(spark, sf_dir).withColumn("delivery", number).select(*columns, "delivery"), f"{root}/all")
    for i in range(3):
        rows.where(F.col("delivery") == i).drop("delivery").write.parquet(f"{root}/arrivals/delivery={i}")
        yield spark.readStream.schema(rows.drop("delivery").schema).parquet(f"{root}/arrivals")


def _by_time(*days: int) -> Column:
    """Which third a record's time falls in."""
    return sum((F.col("timestamp") >= f"2024-01-{day:02d} 12:00:00").cast("int") for day in days)


def _third_of_offsets(spark: SparkSession, sf_dir: str) -> Column:
    end = _transactions(spark, sf_dir).agg(F.max("offset")).first()[0] + 1
    return F.call_function("div", F.col("offset") * 3, F.lit(end)).cast("int")


def summary_upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of hourly totals as a reader sees it after each of three deliveries; every tenth record is a delivery late."""
    root = shared_dir(use_rocksdb_state(spark), "summary-keyed")
    late = F.endswith("transaction_id", F.lit("0")).cast("int")
    arrivals = _deliveries(
        spark, sf_dir, root, F.least(F.lit(2), _by_time(11, 21) + late), "key", "quantity", "price", "timestamp"
    )
    table = keyed.KeyedTable(f"{root}/table", SUMMARY, ("category", "window_start", "window_end"), buckets=16)
    seen = []
    for i, stream in enumerate(arrivals):
        summaries = summary.summarize(stream, 60)
        jobs.summary_to_keyed_table(summaries, table, f"{root}/checkpoint", once=True).awaitTermination()
        seen.append(table.read(spark).withColumn("delivery", F.lit(i)))
    return seen[0].union(seen[1]).union(seen[2])


def window_store_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the window store of a daily summary holds after three starts on one checkpoint."""
    root = shared_dir(use_rocksdb_state(spark), "window-store")
    for stream in _deliveries(spark, sf_dir, root, _by_time(11, 21), "key", "quantity", "price", "timestamp"):
        updates = jobs.summary_updates(stream, 1440)
        jobs.summary_to_table(updates, f"{root}/updates", f"{root}/checkpoint", once=True).awaitTermination()
    return store.open_windows(spark, f"{root}/checkpoint", 1440)


def summary_stream_processor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict summary by a stateful processor: three deliveries in offset order, three starts on one checkpoint."""
    root = shared_dir(use_rocksdb_state(spark), "summary-processor")
    third = _third_of_offsets(spark, sf_dir)
    columns = ("key", "quantity", "price", "timestamp", "partition", "offset")
    for stream in _deliveries(spark, sf_dir, root, third, *columns):
        updates = processor.strict_updates(stream, 60)
        write = batches.upsert_batches(f"{root}/updates")
        jobs.writer(updates, f"{root}/checkpoint", "update", once=True).foreachBatch(write).start().awaitTermination()
    return processor.result(batches.read_changelog(spark, f"{root}/updates", processor.UPDATES), 60)


def last_wins_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily running totals as an update stream, reduced to the newest update per category."""
    daily = summary.summarize(_transactions(spark, sf_dir), 1440)
    changelog = daily.withColumn("version", F.col("window_end")).drop("window_end")
    return batches.last_wins(changelog, ["category"], "version")


# --- ingest chain ---------------------------------------------------------------------------


def _sales_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = shape.round_price(_records(spark, sf_dir))
    return shape.envelope("sales_transactions")(table)


def shape_cast_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = shape.cast_field("price", "double")(_sales_envelope(spark, sf_dir))
    return shaped.select("value.transaction_id", "value.price")


def shape_route_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other record comes from a table whose name only contains the pattern."""
    rows = _transactions(spark, sf_dir)
    named = rows.select(
        "transaction_id",
        F.when(F.col("quantity") % 2 == 0, "sales_transactions").otherwise("x_sales_transactions").alias("topic"),
    )
    return shape.route_topic("sales_transactions", "sales-transactions")(named)


def shape_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = shape.chain(shape.value_to_key("category"), shape.extract_key_field("category"))
    return steps(_sales_envelope(spark, sf_dir)).select("key", "value.transaction_id")


def shape_key_from_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = shape.key_from("transaction_id")(_sales_envelope(spark, sf_dir))
    return keyed.select("key", "value.category")


def shape_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = shape.sales_chain()(_sales_envelope(spark, sf_dir))
    flat = shape.unpack(shaped)
    return flat.select(
        "key", "topic", "transaction_id", "product_id", "category", "quantity", "price",
        F.unix_micros("timestamp").alias("timestamp_us"),
    )


def shape_record_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name the chain gives a record's schema, as the encoder reads it back."""
    shaped = shape.sales_chain("sales.sales_transactions")(_sales_envelope(spark, sf_dir))
    return shaped.select("key", "value.transaction_id", F.lit(shape.record_name(shaped)).alias("record_name"))


def round_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices pass through FLOAT on their way to DECIMAL(10,2)."""
    floats = _transactions(spark, sf_dir).withColumn("price", F.col("price").cast("float"))
    return shape.round_price(floats).select("transaction_id", F.col("price").cast("double").alias("price"))


def default_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a time keep it to the microsecond; rows without one get whole seconds, after every time in the data."""
    rows = _records(spark, sf_dir)
    even = F.col("quantity") % 2 == 0
    given = tablekey.default_timestamp(rows.where(even))
    filled = tablekey.default_timestamp(rows.where(~even).drop("timestamp"))
    micros = F.unix_micros("timestamp")
    return given.select("transaction_id", micros.alias("given_us"), F.lit(None).cast("int").alias("whole")).union(
        filled.select("transaction_id", F.lit(None).cast("bigint"), (micros % 1_000_000 == 0).cast("int"))
    )


def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of an append: those to insert, and those whose table key several rows share."""
    alone, clashing = tablekey.split_clashes(_with_copies(spark, sf_dir))
    return alone.withColumn("clash", F.lit(0)).union(clashing.withColumn("clash", F.lit(1))).select(
        "transaction_id", F.unix_millis("timestamp").alias("timestamp_ms"), "quantity", "offset", "clash"
    )


def _with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions keyed by (user, hour), so that several rows share a table key."""
    return _transactions(spark, sf_dir).select(
        F.col("product_id").alias("transaction_id"),
        F.date_trunc("hour", "timestamp").alias("timestamp"),
        "category", "quantity", "offset",
    )


def table_key_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = tablekey.first_per_key(_with_copies(spark, sf_dir), order="offset")
    return first.select(
        "transaction_id", F.unix_millis("timestamp").alias("timestamp_ms"), "category", "quantity", "offset"
    )


def stream_key_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with every third one sent again in the next delivery; a start per delivery keeps the first of each key."""
    root = shared_dir(use_rocksdb_state(spark), "key-guard")
    rows = _transactions(spark, sf_dir).select("transaction_id", "timestamp", "quantity", "offset")
    rows = written_to(rows.withColumn("delivery", _by_time(11, 21)), f"{root}/all")
    for i in range(3):
        again = rows.where((F.col("delivery") == i - 1) & (F.pmod("offset", F.lit(3)) == 0))
        sent = rows.where(F.col("delivery") == i).union(again).withColumn("delivery", F.lit(i))
        sent.write.parquet(f"{root}/arrivals/n={i}")
        stream = spark.readStream.schema(sent.schema).parquet(f"{root}/arrivals").withWatermark("timestamp", "20 days")
        guarded = tablekey.first_per_key_stream(stream)
        out = jobs.writer(guarded, f"{root}/checkpoint", "append", once=True).format("parquet").option("path", f"{root}/out")
        out.start().awaitTermination()
    kept = spark.read.schema(sent.schema).parquet(f"{root}/out")
    return kept.withColumn("timestamp", F.unix_millis("timestamp"))


def table_key_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    conflicts = tablekey.duplicate_keys(_with_copies(spark, sf_dir))
    return conflicts.select("transaction_id", F.unix_millis("timestamp").alias("timestamp_ms"), "copies")


def incremental_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = database.newer_than(
        replayed.events(spark, sf_dir), "ts", datetime(2024, 1, 10), datetime(2024, 1, 20)
    )
    return replayed.transactions(rows).select("transaction_id", F.unix_micros("timestamp").alias("timestamp_us"))


def incremental_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five polls over the whole table; nothing is read twice or left out."""
    events = replayed.events(spark, sf_dir)
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    uppers = [first + (last - first) * i / 4 for i in range(1, 5)] + [last + timedelta(seconds=1)]
    return database.poll_numbers(events, "ts", uppers).select("event_id", "poll")


def incremental_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six polls of a table some of whose rows become visible up to twelve days after their time; each arrives once."""
    delay = F.when(F.col("event_id") % 10 == 0, F.col("event_id") % 13).otherwise(0)
    visible = F.col("ts") + F.make_dt_interval(delay)
    root = shared_dir(spark, "overlap")
    events = written_to(
        replayed.events(spark, sf_dir).select("event_id", "ts", visible.alias("visible")), f"{root}/table"
    )
    sent: list[DataFrame] = []
    now = {"upper": datetime(2024, 1, 5)}

    def read(session: SparkSession, last: datetime | None):
        shown = events.where(F.col("visible") < F.lit(now["upper"].isoformat(sep=" ")).cast("timestamp_ntz")).drop("visible")
        rows, newest = database.read_increment(shown, "ts", last, now["upper"])
        return (None, last) if newest is None or newest == last else (rows, newest)

    def send(rows: DataFrame) -> None:
        number = len(sent)
        sent.append(written_to(rows.select("event_id", F.lit(number).alias("poll")), f"{root}/sent/{number}"))

    poll = ingest.OverlappingPoll(read, send, f"{root}/state", ("event_id",), timedelta(days=13), "ts")
    tick = spark.range(1)
    for number, days in enumerate((5, 11, 12, 20, 30, 50)):
        now["upper"] = datetime(2024, 1, 1) + timedelta(days=days)
        poll(tick, number)
    out = sent[0]
    for more in sent[1:]:
        out = out.union(more)
    return out


# --- wire format ----------------------------------------------------------------------------


def wire_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of many schemas, one event type being foreign (wrong first byte)."""
    events = replayed.events(spark, sf_dir)
    body = F.col("event_type").cast("binary")
    message = F.when(
        F.col("event_type") == "error", F.concat(F.unhex(F.lit("7B")), F.col("props").cast("binary"))
    ).otherwise(wire.framed(body, F.col("user_id")))
    head = wire.header("message")
    return (
        events.select("event_id", message.alias("message"))
        .select("event_id", head.alias("h"))
        .select(
            "event_id", "h.magic", "h.schema_id", F.hex("h.payload").alias("payload_hex"),
            F.col("h.framed").cast("int").alias("framed"),
        )
    )


def _mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages with two schema ids, errors being unframed."""
    events = replayed.events(spark, sf_dir)
    number = F.when(F.col("event_type") == "view", 7).otherwise(8)
    body = F.col("event_type").cast("binary")
    value = F.when(F.col("event_type") != "error", wire.framed(body, number)).otherwise(body)
    return events.select("event_id", value.alias("value"))


def wire_foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to route away: no header, or a schema other than the expected one."""
    foreign = topics.foreign_messages(_mixed_messages(spark, sf_dir), {8})
    return foreign.select("event_id", F.hex("value").alias("value_hex"))


EVENT_TYPE = T.StructType([T.StructField("event_type", T.StringType())])


def wire_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message once: good ones with their record, empty ones, and foreign ones (wrong id, too short, unframed)."""
    events = replayed.events(spark, sf_dir)
    body = wire.encode_record(F.struct("event_type"), EVENT_TYPE)
    kind = F.col("event_id") % 6
    value = (
        F.when(kind == 0, F.lit(None).cast("binary"))
        .when(kind == 1, wire.framed(body, 77))
        .when(kind == 2, F.unhex(F.lit("0000")))
        .when(kind == 3, body)
        .otherwise(wire.framed(body, 8))
    )
    raw = events.select(
        "event_id", F.col("event_type").cast("binary").alias("key"), value.alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"),
    )
    good = topics.decode_topic(raw.where(topics.route({8}) != "foreign"), EVENT_TYPE, {8})
    foreign = topics.foreign_messages(raw, {8})
    return good.select(F.col("offset").alias("event_id"), F.lit(0).alias("foreign"), "value.event_type").union(
        foreign.select("event_id", F.lit(1), F.lit(None).cast("string"))
    )


def wire_alert_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts as the bytes a topic carries."""
    keyed = rules.keyed_alerts(rules.raise_alerts(_telemetry(spark, sf_dir)))
    message = wire.framed(wire.encode_record(F.col("value"), ALERT, "SensorAlerts"), 42)
    return keyed.select(F.hex(F.col("key").cast("binary")).alias("key_hex"), F.hex(message).alias("value_hex"))


def _round_trip(df: DataFrame, schema) -> DataFrame:
    message = wire.framed(wire.encode_record(F.struct(*df.columns), schema), 7)
    sent = df.select(message.alias("message"))
    return sent.select(wire.decode_record(wire.payload_if_framed("message"), schema).alias("r")).select("r.*")


def wire_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode, frame, unframe, decode; record times keep milliseconds."""
    back = _round_trip(_records(spark, sf_dir), TRANSACTION)
    return back.withColumn("timestamp", F.unix_millis("timestamp"))


def wire_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(_telemetry(spark, sf_dir), TELEMETRY)


def wire_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(summary.summarize(_transactions(spark, sf_dir), 60), SUMMARY_WIRE)


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, False) for name, kind in kinds.items()])


# Three writers of one topic: an early one (float prices, no product), one with another order and a field more, today's.
WRITERS = {
    11: _struct(transaction_id=T.StringType(), category=T.StringType(), quantity=T.IntegerType(), price=T.FloatType(),
                timestamp=T.TimestampType()),
    12: _struct(price=T.DoubleType(), channel=T.StringType(), timestamp=T.TimestampType(), item=T.StringType(),
                category=T.StringType(), transaction_id=T.StringType(), quantity=T.LongType()),
    13: TRANSACTION,
}
EVOLVED = evolution.Reader(
    T.StructType([T.StructField(f.name, T.LongType() if f.name == "quantity" else f.dataType, False) for f in TRANSACTION.fields]),
    {"product_id": "unknown"},
    {"product_id": ("item",)},
)


def wire_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic whose messages three writer schemas made, read as one; a fourth id is foreign."""
    rows = _transactions(spark, sf_dir).withColumn("channel", F.lit("web")).withColumn("item", F.col("product_id"))
    number = 11 + F.pmod("offset", F.lit(4))
    value = F.when(number == 14, wire.framed(F.col("category").cast("binary"), 14))
    for one, schema in WRITERS.items():
        sent = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        value = value.when(number == one, wire.framed(wire.encode_record(sent, schema), one))
    raw = rows.select(
        F.col("key").cast("binary").alias("key"), value.alias("value"), F.lit("sales-transactions").alias("topic"), "partition",
        "offset", "timestamp",
    )
    read = topics.decode_topic(raw, EVOLVED, WRITERS, on_foreign="leave")
    return read.where("value IS NOT NULL").select("offset", "value.*").withColumn("timestamp", F.unix_millis("timestamp"))


# --- synthetic rows -------------------------------------------------------------------------


def synth_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synthetic.telemetry(replayed.events(spark, sf_dir), "event_id")


def synth_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = synthetic.transactions(replayed.events(spark, sf_dir), "event_id")
    return rows.withColumn("price", F.col("price").cast("double"))


def synth_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated transactions as the table stores them, then as the sales topic receives them."""
    generated = synthetic.transactions(replayed.events(spark, sf_dir), "event_id").drop("key")
    stored = shape.round_price(tablekey.default_timestamp(generated))
    sent = shape.unpack(shape.sales_chain()(shape.envelope("sales_transactions")(stored)))
    return sent.groupBy("key", "topic").agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum("quantity").alias("total_quantity"),
        F.sum(F.col("price").cast("decimal(10,2)")).cast("double").alias("total_revenue"),
    )


# --- named tables ---------------------------------------------------------------------------


def named_tables_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.register_replayed(spark, sf_dir, 1440)
    return spark.sql(
        """
        SELECT 'alerts' AS source, alert_type AS name, count(*) AS records, cast(null AS double) AS revenue
        FROM alerts GROUP BY alert_type
        UNION ALL
        SELECT 'summary', category, count(*), cast(sum(cast(total_revenue AS decimal(18,2))) AS double)
        FROM summary GROUP BY category
        UNION ALL
        SELECT 'telemetry', sensor_id, count(*), null FROM telemetry GROUP BY sensor_id
        UNION ALL
        SELECT 'transactions', product_id, sum(quantity), null FROM transactions GROUP BY product_id
        """
    )


def named_functions_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameterised tables, each with two sets of arguments."""
    tables.register_replayed(spark, sf_dir, 60)
    tables.register_functions(spark)
    parts = [
        f"SELECT 'windows {n}' AS source, category AS name, count(*) AS records, sum(total_quantity) AS units FROM sales_windows({n}) GROUP BY category"
        for n in (15, 1440)
    ]
    parts += [
        f"SELECT 'alerts {hot}', alert_type, count(*), null FROM threshold_alerts({hot}D, {dry}D) GROUP BY alert_type"
        for hot, dry in ((35.0, 0.2), (45.0, 0.1))
    ]
    parts += [f"SELECT 'late {n}', cast(partition AS string), count(*), null FROM late_sales({n}) GROUP BY partition" for n in (15, 60)]
    return spark.sql(" UNION ALL ".join(parts))


QUERIES: dict[str, Query] = {
    "alerts_documented": _alerts(),
    "alerts_as_coded": alerts_as_coded,
    "alerts_custom_thresholds": alerts_custom_thresholds,
    "alert_temperature": _alerts(rules.high_temperature()),
    "alert_humidity_below": _alerts(rules.low_humidity()),
    "alert_humidity_above": _alerts(rules.low_humidity(mode="above")),
    "alerts_union_twin": alerts_union_twin,
    "alerts_keyed": alerts_keyed,
    "alerts_stream": alerts_stream,
    "summary_1min": _summary(1),
    "summary_7min": _summary(7),
    "summary_60min": _summary(60),
    "summary_1day": _summary(1440),
    "summary_null_key": summary_null_key,
    "summary_record_time": summary_record_time,
    "summary_keyed": summary_keyed,
    "window_aggregate_60min": window_aggregate_60min,
    "summary_strict_1min": _summary_strict(1),
    "summary_strict_60min": _summary_strict(60),
    "summary_strict_null_key": summary_strict_null_key,
    "summary_updates_60min": summary_updates_60min,
    "summary_updates_ticks": summary_updates_ticks,
    "summary_exact_double": summary_exact_double,
    "late_rows_60min": late_rows_60min,
    "late_metrics_60min": late_metrics_60min,
    "stream_time": stream_time,
    "summary_stream_update": summary_stream_update,
    "summary_stream_append": summary_stream_append,
    "summary_stream_strict": summary_stream_strict,
    "summary_stream_batches": summary_stream_batches,
    "summary_upsert_table": summary_upsert_table,
    "summary_stream_processor": summary_stream_processor,
    "window_store_open": window_store_open,
    "last_wins_table": last_wins_table,
    "shape_cast_price": shape_cast_price,
    "shape_route_topic": shape_route_topic,
    "shape_key": shape_key,
    "shape_key_from_field": shape_key_from_field,
    "shape_chain": shape_chain,
    "shape_record_name": shape_record_name,
    "round_price": round_price,
    "default_timestamp": default_timestamp,
    "append_rows": append_rows,
    "table_key_guard": table_key_guard,
    "table_key_conflicts": table_key_conflicts,
    "stream_key_guard": stream_key_guard,
    "incremental_read": incremental_read,
    "incremental_replay": incremental_replay,
    "incremental_overlap": incremental_overlap,
    "wire_header": wire_header,
    "wire_foreign": wire_foreign,
    "wire_routing": wire_routing,
    "wire_alert_bytes": wire_alert_bytes,
    "wire_transactions": wire_transactions,
    "wire_telemetry": wire_telemetry,
    "wire_summary": wire_summary,
    "wire_evolution": wire_evolution,
    "synth_telemetry": synth_telemetry,
    "synth_transactions": synth_transactions,
    "synth_ingest": synth_ingest,
    "named_tables_sql": named_tables_sql,
    "named_functions_sql": named_functions_sql,
}
