"""Shaping, table rules, incremental reads, topic options and parameters."""

from datetime import datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions import wire
from tidemark.operators import shape, tablekey
from tidemark.params import AlertParams, ParameterError, SummaryParams
from tidemark.plans import inspect
from tidemark.schemas import ALERT, ENVELOPE, TELEMETRY
from tidemark.sources import database, replayed, topics

T0 = datetime(2024, 1, 1)


def table(spark, *rows):
    return spark.createDataFrame(
        [(t, "p", "seeds", 1, p, T0 + timedelta(seconds=s)) for t, p, s in rows],
        "transaction_id string, product_id string, category string, quantity int, price float, timestamp timestamp_ntz",
    )


# --- shaping


@pytest.mark.parametrize(
    ("name", "routed"),
    [("sales_transactions", "sales-transactions"), ("x_sales_transactions", "x_sales_transactions"),
     ("sales_transactions2", "sales_transactions2")],
)
def test_route_needs_the_whole_name(spark, name, routed):
    df = spark.createDataFrame([(name,)], "topic string")
    assert shape.route_topic("sales_transactions", "sales-transactions")(df).first()[0] == routed


def test_route_alternatives_and_groups(spark):
    df = spark.createDataFrame([("db_sales",), ("web_sales",), ("db_sales_x",)], "topic string")
    got = [r[0] for r in shape.route_topic("db_(.*)s|web_(.*)", "$1$2")(df).collect()]
    assert got == ["sale", "sales", "db_sales_x"]


def test_sales_chain(spark):
    df = shape.envelope("sales_transactions")(shape.round_price(table(spark, ("t1", 123.456, 0))))
    out = shape.sales_chain("sales.sales_transactions")(df)
    assert dict(out.dtypes)["key"] == "string"
    assert out.schema["value"].dataType["price"].dataType.typeName() == "double"
    assert shape.record_name(out) == "sales.sales_transactions"
    row = out.first()
    assert (row.key, row.topic, row.value.price) == ("seeds", "sales-transactions", 123.46)


def test_unpack_keeps_both_times_apart(spark):
    df = shape.envelope("t")(table(spark, ("t1", 1.0, 5))).withColumn("timestamp", F.lit(T0))
    assert shape.unpack(df).select("kafka_timestamp", "timestamp").first() == (T0, T0 + timedelta(seconds=5))


# --- table rules


def test_default_timestamp(spark):
    given_time = table(spark, ("t1", 1.0, 5))
    assert tablekey.default_timestamp(given_time).first().timestamp == T0 + timedelta(seconds=5)
    filled = tablekey.default_timestamp(given_time.drop("timestamp")).first().timestamp
    assert filled.microsecond == 0


def test_first_per_key(spark):
    df = table(spark, ("t1", 1.0, 0), ("t1", 2.0, 0), ("t1", 3.0, 1)).withColumn("n", F.monotonically_increasing_id())
    kept = tablekey.first_per_key(df, order="n")
    assert kept.columns == df.columns
    assert sorted(r.price for r in kept.collect()) == [1.0, 3.0]
    assert tablekey.first_per_key(df).count() == 2
    assert tablekey.duplicate_keys(df).count() == 1


def test_stream_guard(spark, folder):
    rows = [("t1", 1.0, 0), ("t1", 1.0, 0), ("t2", 1.0, 0)]
    table(spark, *rows).withColumn("timestamp", F.col("timestamp").cast("timestamp")).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{folder}/in").schema).parquet(f"{folder}/in")
    guarded = tablekey.first_per_key_stream(stream.withWatermark("timestamp", "1 minute"))
    query = (
        guarded.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_prepared_rows_fit_the_table(spark):
    """Every row stays, also where the default time makes keys clash."""
    out = database.prepare_append(table(spark, ("t1", 123.456, 0), ("t1", 9.0, 0)).drop("timestamp"))
    assert dict(out.dtypes)["price"] == "decimal(10,2)" and "timestamp" in out.columns
    assert out.count() == 2


@pytest.fixture
def inserted(monkeypatch, folder):
    path = f"{folder}/table"
    monkeypatch.setattr(database, "insert", lambda rows, table, connections: rows.write.mode("append").parquet(path))
    return path


def many(spark, rows):
    """Generated ids repeat: there are far fewer than rows."""
    return spark.range(rows).select(
        F.concat(F.lit("t"), F.col("id") % 59_049).alias("transaction_id"), F.lit("p").alias("product_id"),
        F.lit("c").alias("category"), F.lit(1).alias("quantity"), F.lit(1.0).alias("price"),
    )


def test_a_large_append_fails_or_keeps_every_row(spark, inserted, folder):
    rows = many(spark, 1_000_000)
    with pytest.raises(database.KeyClash, match="t[0-9]+"):
        database.append(rows, None)
    database.append(rows, None, clash_folder=f"{folder}/clash")
    assert spark.read.parquet(f"{folder}/clash").count() == 1_000_000
    timed = rows.withColumn("timestamp", F.timestamp_seconds(F.lit(T0.timestamp()) + F.monotonically_increasing_id()))
    database.append(timed, None)
    assert spark.read.parquet(inserted).count() == 1_000_000


def test_clashing_rows_go_aside_whole(spark, inserted, folder):
    rows = table(spark, ("t1", 1.0, 0), ("t1", 2.0, 0), ("t1", 3.0, 1), ("t2", 4.0, 0))
    database.append(rows, None, clash_folder=f"{folder}/clash")
    assert sorted(r.price for r in spark.read.parquet(inserted).collect()) == [3, 4]
    assert sorted(r.price for r in spark.read.parquet(f"{folder}/clash").collect()) == [1, 2]


def test_default_times_are_now(spark):
    before = datetime.now().timestamp()
    made = tablekey.default_timestamp(many(spark, 3)).select(F.unix_micros("timestamp").alias("t")).collect()
    after = datetime.now().timestamp()
    assert all(int(before) <= r.t / 1e6 <= after and r.t % 1_000_000 == 0 for r in made)


# --- incremental reads


def seconds(df):
    return sorted(int((r.timestamp - T0).total_seconds()) for r in df.collect())


def test_increment_bounds_are_exclusive(spark):
    df = table(spark, *[(f"t{i}", 1.0, i) for i in range(6)])
    rows, offset = database.read_increment(df, "timestamp", T0 + timedelta(seconds=1), T0 + timedelta(seconds=4))
    assert seconds(rows) == [2, 3] and offset == T0 + timedelta(seconds=3)


def test_first_and_empty_polls(spark):
    df = table(spark, ("t0", 1.0, 0), ("t1", 1.0, 7))
    rows, offset = database.read_increment(df, "timestamp", None, T0 + timedelta(seconds=7))
    assert seconds(rows) == [0] and offset == T0
    rows, same = database.read_increment(df, "timestamp", offset, T0 + timedelta(seconds=7))
    assert rows.count() == 0 and same == offset


def test_poll_numbers_agree_with_polls(spark):
    df = table(spark, *[(f"t{i}", 1.0, i * i % 50) for i in range(40)])
    uppers = [T0 + timedelta(seconds=s) for s in (9, 9, 25, 49, 60)]
    one = sorted((r.transaction_id, r.poll) for r in database.poll_numbers(df, "timestamp", uppers).collect())
    polls = database.replay(df, "timestamp", uppers)
    assert one == sorted((r.transaction_id, i) for i, (rows, _) in enumerate(polls) for r in rows.collect())


def test_replay_reads_every_row_once(spark):
    df = table(spark, *[(f"t{i}", 1.0, i * i % 50) for i in range(40)])
    polls = database.replay(df, "timestamp", [T0 + timedelta(seconds=s) for s in (9, 9, 25, 60)])
    assert sorted(s for rows, _ in polls for s in seconds(rows)) == seconds(df)


def test_increment_bounds_reach_the_scan(spark, small):
    rows = database.newer_than(replayed.events(spark, small), "ts", datetime(2024, 1, 10), datetime(2024, 1, 20))
    plan = inspect.physical(rows)
    assert "GreaterThan(ts," in plan and "LessThan(ts," in plan


@given(st.integers(0, 1000), st.integers(0, 5000), st.integers(1, 9))
def test_slices_cover_the_span_without_overlap(start, width, slices):
    oldest, newest = T0 + timedelta(seconds=start), T0 + timedelta(seconds=start + width)
    spans = database.slice_predicates("ts", oldest, newest, slices)
    edges = [span.replace("ts >= ", "").replace("ts > ", "").split(" AND ts <= ") for span in spans]
    assert len(spans) == slices
    assert [span.startswith("ts >= ") for span in spans] == [True] + [False] * (slices - 1)
    assert all(high == low for (_, high), (low, _) in zip(edges, edges[1:]))
    assert edges[0][0] == database._literal(oldest) and edges[-1][1] == database._literal(newest)


def test_slices_can_be_split_by_a_hash():
    predicates = database.slice_predicates("ts", T0, T0 + timedelta(hours=1), 2, "CRC32(transaction_id)", 3)
    assert len(predicates) == 6 and predicates[-1].endswith("MOD(CRC32(transaction_id), 3) = 2")
    with pytest.raises(ValueError):
        database.slice_predicates("ts", T0, T0, 0)


@pytest.mark.parametrize("slices", [1, 4])
def test_slices_split_a_table_exactly(spark, slices):
    df = table(spark, *[(f"t{i}", 1.0, i) for i in range(50)])
    last = T0 + timedelta(seconds=49)
    predicates = database.slice_predicates("timestamp", T0, last, slices, "crc32(transaction_id)", 2)
    parts = [seconds(df.where(p)) for p in predicates]
    assert sorted(s for part in parts for s in part) == list(range(50))


def test_jdbc_options():
    source = database.JdbcTable("jdbc:x:y", "sales_transactions", {"driver": "d", "user": "u"})
    options = source.span_options("timestamp", T0, T0 + timedelta(seconds=1))
    assert options["query"] == (
        "SELECT min(timestamp) AS oldest, max(timestamp) AS newest FROM sales_transactions "
        "WHERE timestamp > TIMESTAMP '2024-01-01 00:00:00.000000' "
        "AND timestamp < TIMESTAMP '2024-01-01 00:00:01.000000'"
    )
    assert options["driver"] == "d" and options["fetchsize"] == "10000"
    assert database.time_bounds("ts", None, T0) == ["ts < TIMESTAMP '2024-01-01 00:00:00.000000'"]
    assert database.time_bounds("ts", T0, None)[1:] == ["ts < CURRENT_TIMESTAMP"]
    assert source.append_options(4)["numPartitions"] == "4"
    assert source.append_options()["dbtable"] == "sales_transactions"


class FakeReader:
    """Stands in for ``spark.read``: answers the span query and records the sliced read."""

    def __init__(self, spark, span):
        self.spark, self.span, self.calls = spark, span, []

    read = property(lambda self: self)

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.calls.append(options["query"])
        return self

    def load(self):
        return self.spark.createDataFrame([self.span], "oldest timestamp_ntz, newest timestamp_ntz")

    def jdbc(self, url, name, predicates, properties):
        self.calls.append((url, name, predicates, properties["preferTimestampNTZ"]))
        return "rows"


def test_jdbc_poll_reads_the_span_in_slices(spark):
    newest = T0 + timedelta(seconds=10)
    fake = FakeReader(spark, (T0, newest))
    source = database.JdbcTable("jdbc:x:y", "t")
    assert source.increment(fake, "ts", None, newest + timedelta(seconds=1), slices=5) == ("rows", newest)
    _, (url, name, predicates, ntz) = fake.calls
    assert (url, name, ntz, len(predicates)) == ("jdbc:x:y", "t", "true", 5)
    assert source.increment(FakeReader(spark, (None, None)), "ts", T0, newest) == (None, T0)


def test_jdbc_poll_takes_its_upper_bound_from_the_database(spark):
    newest = T0 + timedelta(seconds=10)
    fake = FakeReader(spark, (T0, newest))
    assert database.JdbcTable("jdbc:x:y", "t").increment(fake, "ts", T0)[1] == newest
    span, (_, _, predicates, _) = fake.calls
    assert span.endswith("ts > TIMESTAMP '2024-01-01 00:00:00.000000' AND ts < CURRENT_TIMESTAMP")
    assert predicates == [
        "ts >= TIMESTAMP '2024-01-01 00:00:00.000000' AND ts <= TIMESTAMP '2024-01-01 00:00:10.000000'"
    ]


# --- topics


def test_topic_options():
    params = SummaryParams(input_topic="in", output_topic="out")
    options = topics.reader_options(params, max_rows=1000, min_partitions=64)
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "in"
    assert options["maxOffsetsPerTrigger"] == "1000" and options["minPartitions"] == "64"
    assert topics.writer_options(params) == {
        "kafka.bootstrap.servers": params.bootstrap_servers,
        "topic": "out",
    }


def test_topic_source_needs_its_package(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        topics.read_topic(spark, AlertParams(), streaming=False)


def test_topic_round_trip_without_a_broker(spark):
    """The bytes one job sends are what the next one decodes."""
    alert = ("sensor_111", "LOW_HUMIDITY", 1741421301, "Humidity is below 20.0%")
    keyed = spark.createDataFrame([("sensor_111", alert)], "key string, value struct<sensor_id:string,alert_type:string,timestamp:bigint,details:string>")
    encoded = topics.encode_topic(keyed, 5, ALERT)
    assert dict(encoded.dtypes) == {"key": "binary", "value": "binary"}
    raw = encoded.select(
        "key", "value", F.lit("sensor-alerts").alias("topic"), F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    assert raw.columns == ENVELOPE.names
    back = topics.decode_topic(raw, ALERT, {5}).first()
    assert back.key == "sensor_111" and tuple(back.value) == alert


def test_foreign_messages_stop_or_go_aside(spark):
    raw = spark.createDataFrame([(b"k", b"{json}", "t", 3, 14, T0), (b"k", None, "t", 3, 15, T0)], ENVELOPE)
    with pytest.raises(Exception, match="foreign message in t, partition 3, offset 14"):
        topics.decode_topic(raw, TELEMETRY, {5}).collect()
    decoded = topics.decode_topic(raw, TELEMETRY, {5}, on_foreign="leave")
    assert [r.value for r in decoded.collect()] == [None, None]
    assert shape.unpack(decoded).count() == 0
    assert [r.offset for r in topics.foreign_messages(raw, {5}).collect()] == [14]
    framed = raw.limit(1).withColumn("value", F.unhex(F.lit("0000000005")))
    assert topics.foreign_messages(framed, {5}).count() == 0
    assert topics.foreign_messages(framed, {6}).count() == 1


def test_a_body_of_another_shape_is_damaged(spark):
    """A shorter reader schema leaves bytes over."""
    longer = StructType([StructField("a", StringType()), StructField("b", StringType())])
    shorter = StructType(longer.fields[:1])
    body = spark.createDataFrame([("x", "y")], longer).select(wire.encode_record(F.struct("a", "b"), longer).alias("body"))
    assert body.select(wire.decode_record(F.col("body"), shorter, fail_fast=False).alias("r")).first().r is None
    with pytest.raises(Exception, match="damaged"):
        body.select(wire.decode_record(F.col("body"), shorter)).collect()


def test_framing_accepts_a_column(spark):
    df = spark.createDataFrame([(258, b"x")], "id int, body binary")
    assert df.select(wire.framed(F.col("body"), F.col("id"))).first()[0] == b"\x00\x00\x00\x01\x02x"


# --- parameters


def test_defaults():
    summary, alerts = SummaryParams.from_env({}), AlertParams.from_env({})
    assert (summary.window_minutes, summary.input_topic, summary.output_topic) == (1, "sales-transactions", "sales-summary")
    assert (alerts.temperature_threshold, alerts.humidity_threshold, alerts.humidity_rule) == (35.0, 0.2, "below")


def test_environment_overrides_really_apply():
    env = {"INPUT_TOPIC": " in ", "OUTPUT_TOPIC": "out", "WINDOW_SIZE_MINUTES": "5", "APP_ID_CONFIG": "x"}
    params = SummaryParams.from_env(env)
    assert (params.input_topic, params.output_topic, params.window_minutes, params.app_id) == ("in", "out", 5, "x")
    alerts = AlertParams.from_env({"TEMPERATURE_THRESHOLD": "40", "HUMIDITY_THRESHOLD": "0.5"})
    assert (alerts.temperature_threshold, alerts.humidity_threshold) == (40.0, 0.5)


@pytest.mark.parametrize("value", ["0", "-1", "one", "1.5"])
def test_bad_window(value):
    with pytest.raises(ParameterError):
        SummaryParams.from_env({"WINDOW_SIZE_MINUTES": value})


@pytest.mark.parametrize(
    "env",
    [{"TEMPERATURE_THRESHOLD": "0"}, {"TEMPERATURE_THRESHOLD": "nan"}, {"HUMIDITY_THRESHOLD": "1.01"},
     {"HUMIDITY_THRESHOLD": "-0.1"}, {"HUMIDITY_THRESHOLD": "wet"}, {"HUMIDITY_RULE": "sideways"}],
)
def test_bad_alert_settings(env):
    with pytest.raises(ParameterError):
        AlertParams.from_env(env)
