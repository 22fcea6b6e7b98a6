"""Zero grace: the worked example, edges, and agreement with a literal evaluation."""

from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import lateness, scan, summary
from tidemark.plans import inspect
from tidemark.session import use_rocksdb_state
from tidemark.sources import replayed
from tidemark.streaming import batches, jobs, strict

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
RECORD = "key string, quantity int, price double, timestamp timestamp, partition int, offset bigint"

# (key, quantity, seconds) per micro-batch.
BATCHES = [
    [("a", 1, 10), ("a", 2, 59.999)],
    [("a", 4, 60), ("a", 8, 30)],
    [("a", 16, 40), ("b", 32, 80)],
    [("a", 64, 50)],
    [("a", 128, 180)],
    [("a", 256, 90)],
]
STRICT = {("a", 0): 3, ("a", 1): 4, ("b", 1): 32, ("a", 3): 128}
NATIVE = {("a", 0): 27, ("a", 1): 260, ("b", 1): 32, ("a", 3): 128}


def records(spark, rows):
    """rows: (key, quantity, seconds, partition, offset)"""
    data = [(k, q, 1.0, START + timedelta(seconds=s), p, o) for k, q, s, p, o in rows]
    return spark.createDataFrame(data, RECORD)


def numbered(parts):
    out, offset = [], 0
    for part in parts:
        out.append([(k, q, s, 0, offset + i) for i, (k, q, s) in enumerate(part)])
        offset += len(part)
    return out


def by_window(df, width_minutes=1):
    start = START.timestamp() * 1000
    return {(r.category, int((r.window_start - start) // (width_minutes * 60000))): r.total_quantity for r in df.collect()}


def deliver(spark, folder, parts):
    """Write one file per micro-batch, in order, and read them back one file at a time."""
    for i, part in enumerate(parts):
        records(spark, part).coalesce(1).write.parquet(f"{folder}/in/part={i}")
    return (
        spark.readStream.schema(RECORD)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .parquet(f"{folder}/in")
    )


def literal(rows, width=60):
    """Offsets kept by going through every partition record by record."""
    kept, seen = set(), {}
    for key, _, seconds, partition, offset in sorted(rows, key=lambda r: (r[3], r[4])):
        if key is None:
            continue
        seen[partition] = max(seen.get(partition, float("-inf")), seconds)
        now, base = seconds, START.timestamp()
        if ((base + now) // width + 1) * width > base + seen[partition]:
            kept.add((partition, offset))
    return kept


def test_worked_example_on_a_table(spark):
    rows = [row for part in numbered(BATCHES) for row in part]
    assert by_window(summary.summarize(lateness.drop_late(records(spark, rows), 1))) == STRICT


def test_worked_example_on_a_stream(spark, folder):
    stream = deliver(spark, folder, numbered(BATCHES))
    job = strict.StrictSummary(f"{folder}/state", 1)
    jobs.writer(stream, f"{folder}/checkpoint", "append", once=True).foreachBatch(job).start().awaitTermination()
    assert by_window(job.result(spark)) == STRICT
    assert job.updates(spark).count() == 4  # batches 4 and 6 hold late records only


def test_worked_example_with_the_native_watermark(spark, folder):
    stream = deliver(spark, folder, numbered(BATCHES))
    updates = jobs.summary_updates(stream)
    jobs.summary_to_table(updates, f"{folder}/updates", f"{folder}/checkpoint", once=True).awaitTermination()
    changelog = batches.read_changelog(spark, f"{folder}/updates", updates.schema)
    table = batches.last_wins(changelog, ["category", "window_start", "window_end"])
    assert by_window(table) == NATIVE


def test_stream_state_lives_in_rocksdb(spark, folder):
    use_rocksdb_state(spark)
    updates = jobs.summary_updates(deliver(spark, folder, numbered(BATCHES[:1])))
    jobs.summary_to_table(updates, f"{folder}/updates", f"{folder}/checkpoint", once=True).awaitTermination()
    names = {path.suffix for path in Path(f"{folder}/checkpoint/state").rglob("*") if path.is_file()}
    assert names & {".changelog", ".zip"} and ".delta" not in names


def test_window_end_itself_expires_the_window(spark):
    rows = [("a", 1, 60.0, 0, 0), ("a", 2, 59.999999, 0, 1), ("a", 4, 60.0, 0, 2)]
    assert {r.quantity for r in lateness.late_only(records(spark, rows), 1).collect()} == {2}


def test_partitions_have_their_own_time(spark):
    rows = [("a", 1, 600, 0, 0), ("b", 2, 5, 1, 0), ("a", 4, 5, 0, 1)]
    assert {r.quantity for r in lateness.drop_late(records(spark, rows), 1).collect()} == {1, 2}


def test_keyless_records_do_not_advance_time(spark):
    rows = [(None, 1, 600, 0, 0), ("a", 2, 5, 0, 1)]
    assert {r.quantity for r in lateness.drop_late(records(spark, rows), 1).collect()} == {2}


arrivals = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 600), st.integers(0, 2)), min_size=1, max_size=40
)
relaxed = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@relaxed
@given(arrivals, st.sampled_from([1, 2, 7]))
def test_expiry_offsets_agree_with_the_literal_rule(spark, drawn, minutes):
    rows = [(k, i, float(s), p, 3 * i) for i, (k, s, p) in enumerate(drawn)]
    kept = lateness.drop_late(records(spark, rows), minutes).select("partition", "offset").collect()
    assert {tuple(r) for r in kept} == literal(rows, minutes * 60)
    assert len(kept) == len(literal(rows, minutes * 60))


@relaxed
@given(arrivals, st.integers(1, 5), st.integers(0, 2))
def test_blocked_running_aggregates(spark, drawn, block, levels):
    rows = [("a", i, float(s), p, i) for i, (_, s, p) in enumerate(drawn)]
    outputs = {"top": scan.highest("seconds"), "sum": scan.total("seconds")}
    timed = records(spark, rows).withColumn("seconds", F.unix_seconds("timestamp") - int(START.timestamp()))
    got = scan.running(timed, ["partition"], "offset", outputs, block=block, levels=levels)
    top, total, expected = {}, {}, {}
    for _, _, seconds, partition, offset in rows:
        top[partition] = max(top.get(partition, -1), seconds)
        total[partition] = total.get(partition, 0) + seconds
        expected[partition, offset] = (top[partition], total[partition])
    assert {(r.partition, r.offset): (r.top, r.sum) for r in got.collect()} == expected


@relaxed
@given(arrivals)
def test_stream_time(spark, drawn):
    rows = [("a", i, float(s), p, i) for i, (_, s, p) in enumerate(drawn)]
    seen, expected = {}, {}
    for _, _, seconds, partition, offset in rows:
        seen[partition] = max(seen.get(partition, -1.0), seconds)
        expected[partition, offset] = START + timedelta(seconds=seen[partition])
    timed = lateness.with_stream_time(records(spark, rows), block=4)
    got = {(r.partition, r.offset): r.us for r in timed.select("partition", "offset", F.unix_micros("stream_time").alias("us")).collect()}
    assert got == {k: int(v.timestamp() * 1_000_000) for k, v in expected.items()}


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(arrivals, min_size=2, max_size=3))
def test_strict_stream_agrees_with_the_table(spark, tmp_path_factory, drawn):
    folder = str(tmp_path_factory.mktemp("strict"))
    offset, parts = 0, []
    for part in drawn:
        parts.append([(k, 1 + i, float(s), p, offset + i) for i, (k, s, p) in enumerate(part)])
        offset += len(part)
    job = strict.StrictSummary(f"{folder}/state", 1)
    stream = deliver(spark, folder, parts)
    jobs.writer(stream, f"{folder}/checkpoint", "append", once=True).foreachBatch(job).start().awaitTermination()
    everything = records(spark, [row for part in parts for row in part])
    assert by_window(job.result(spark)) == by_window(summary.summarize(lateness.drop_late(everything, 1)))


def test_repeated_batches_and_compaction_change_nothing(spark, folder):
    parts = numbered(BATCHES)
    job = strict.StrictSummary(f"{folder}/state", 1)
    for batch_id, part in enumerate(parts):
        job(records(spark, part), batch_id)
        if batch_id in (1, 2, 5):
            job(records(spark, part), batch_id)
        if batch_id in (3, 4):
            job.compact(spark)
            job(records(spark, part), batch_id)
    assert by_window(job.result(spark)) == STRICT


def test_state_holds_open_windows_only(spark, folder):
    job = strict.StrictSummary(f"{folder}/state", 1)
    for batch_id, part in enumerate(numbered(BATCHES)):
        job(records(spark, part), batch_id)
    last = len(BATCHES) - 1
    held = batches.read_batch(spark, f"{folder}/state/windows", last, strict.WINDOWS)
    assert [(r.category, r.total_quantity, r.changed) for r in held.collect()] == [("a", 128, 0)]
    changed_nothing = batches.read_batch(spark, f"{folder}/state/windows", 3, strict.WINDOWS)
    assert changed_nothing.count() == 0  # its untouched windows have been dropped from the log


def test_published_totals_cover_all_partitions(spark, folder):
    """A key in two partitions: a reader that keeps the last message per window holds the sum."""
    held = {}

    def publish(updates):
        held.update({(r.category, r.window_start): r.total_quantity for r in updates.collect()})

    job = strict.StrictSummary(f"{folder}/state", 1, publish=publish, compact_every=2)
    deliveries = [[("a", 1, 1, 0, 0), ("a", 2, 2, 1, 0)], [("a", 4, 3, 0, 1)], [("a", 8, 70, 0, 2), ("a", 16, 5, 1, 1)],
                  [("a", 32, 80, 1, 2)], [("a", 64, 81, 1, 3)], [("a", 128, 90, 0, 3)]]
    rows = "key string, quantity int, second int, partition int, offset long"
    for batch_id, part in enumerate(deliveries):
        timed = spark.createDataFrame(part, rows).withColumns(
            {"price": F.lit(1.0), "timestamp": F.timestamp_seconds(F.lit(1_704_067_200) + F.col("second"))}
        )
        job(timed, batch_id)
    expected = {(r.category, r.window_start): r.total_quantity for r in job.result(spark).collect()}
    assert held == expected and sorted(held.values()) == [23, 232]
    assert len(batches.batch_ids(spark, f"{folder}/state/windows")) < len(deliveries)


def jobs_started(spark, make):
    group = "lateness-definition"
    spark.sparkContext.setJobGroup(group, "")
    try:
        made = make()
        return made, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_job_runs_before_the_result_is_used(spark, small, folder):
    sales = replayed.transactions(replayed.events(spark, small))
    lazy, before = jobs_started(spark, lambda: lateness.drop_late(sales, 60))
    written, with_folder = jobs_started(spark, lambda: lateness.drop_late(sales, 60, work_dir=f"{folder}/expiry"))
    assert before == 0 and with_folder > 0
    assert lazy.count() == written.count() and lazy.exceptAll(written).count() == 0


def test_records_are_not_sorted_or_exchanged_while_the_expiry_table_is_small(spark, small, folder):
    kept = lateness.drop_late(replayed.transactions(replayed.events(spark, small)), 60, work_dir=f"{folder}/expiry")
    assert inspect.exchanges(kept) == 0 and inspect.broadcasts(kept) == 1
    assert inspect.exchanges(summary.summarize(kept, 60)) == 1


def test_large_expiry_table_is_joined_without_broadcast(spark, small, folder):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        sales = replayed.transactions(replayed.events(spark, small))
        kept = lateness.drop_late(sales, 60, work_dir=f"{folder}/expiry")
        assert inspect.broadcasts(kept) == 0
        assert kept.count() == 262
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("block", [1, 1000, 1 << 20])
def test_stream_time_does_not_depend_on_the_block(spark, small, block):
    timed = lateness.with_stream_time(replayed.transactions(replayed.events(spark, small)), block=block)
    total = timed.agg(F.sum(F.unix_micros("stream_time").cast("decimal(38,0)")), F.count("stream_time")).first()
    plain = lateness.with_stream_time(replayed.transactions(replayed.events(spark, small))).agg(
        F.sum(F.unix_micros("stream_time").cast("decimal(38,0)")), F.count("stream_time")
    )
    assert tuple(total) == tuple(plain.first())
