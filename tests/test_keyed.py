"""The keyed table, the window store and the stateful processor."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lateness, summary
from tidemark.session import use_rocksdb_state
from tidemark.streaming import batches, jobs, processor, store
from tidemark.streaming.keyed import KeyedTable

SCHEMA = "k string, v long"


@pytest.fixture
def table(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return KeyedTable(f"{folder}/table", schema, ["k"], buckets=8)


def rows(spark, **values):
    return spark.createDataFrame(list(values.items()), SCHEMA)


def held(df):
    return {r.k: r.v for r in df.collect()}


def files(table):
    return {os.path.join(at, name) for at, _, names in os.walk(f"{table.folder}/data") for name in names if name.endswith(".parquet")}


def test_reads_of_an_empty_table(spark, table):
    assert held(table.read(spark)) == {}
    assert table.upsert(rows(spark).limit(0), 0).generation == 0
    assert held(table.read(spark)) == {}


def test_a_batch_rewrites_only_its_buckets(spark, table):
    table.upsert(rows(spark, **{f"k{i}": i for i in range(40)}), 0)
    before, first = files(table), table.manifest(spark)
    now = table.upsert(rows(spark, k3=300, new=1), 1)
    assert before <= files(table)
    touched = {b for b, g in now.buckets.items() if g == now.generation}
    assert len(touched) <= 2 and all(now.buckets[b] == first.buckets[b] for b in first.buckets if b not in touched)
    expected = {f"k{i}": i for i in range(40)} | {"k3": 300, "new": 1}
    assert held(table.read(spark)) == expected


def test_a_reader_during_a_switch_sees_one_generation(spark, table):
    table.upsert(rows(spark, a=1, b=1, c=1), 0)
    reader = table.read(spark)
    table.upsert(rows(spark, a=2, b=2, c=2), 1)
    table.upsert(rows(spark, a=3), 2)
    assert held(reader) == {"a": 1, "b": 1, "c": 1}
    assert held(table.read(spark)) == {"a": 3, "b": 2, "c": 2}
    assert held(table.read(spark, generation=1)) == {"a": 2, "b": 2, "c": 2}


def test_a_batch_counts_once_and_a_stopped_one_is_written_anew(spark, table, monkeypatch):
    table.upsert(rows(spark, a=1), 0)
    with monkeypatch.context() as patched:
        patched.setattr(KeyedTable, "_switch", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            table.upsert(rows(spark, a=5, z=5), 1)
    assert held(table.read(spark)) == {"a": 1}
    table.upsert(rows(spark, a=2), 1)
    table.upsert(rows(spark, a=9), 1)
    assert held(table.read(spark)) == {"a": 2}


def test_a_second_writer_of_one_generation_fails(spark, table):
    table.upsert(rows(spark, a=1), 0)
    with pytest.raises(RuntimeError, match="another writer"):
        table._switch(spark, table.manifest(spark))


def test_the_newest_of_a_batch_wins(spark, table):
    table.upsert(rows(spark, a=100), 0)
    several = spark.createDataFrame([("a", 1, 1), ("a", 3, 9), ("a", 2, 5), ("b", 4, 0)], "k string, v long, version int")
    table.upsert(several, 1, order="version")
    assert held(table.read(spark)) == {"a": 3, "b": 4}


def test_vacuum_keeps_what_the_newest_manifests_name(spark, table):
    for i in range(5):
        table.upsert(rows(spark, a=i, **{f"x{i}": i}), i)
    expected = held(table.read(spark))
    removed = table.vacuum(spark, keep=2)
    assert removed and held(table.read(spark)) == expected
    assert held(table.read(spark, generation=3)) == {k: (3 if k == "a" else v) for k, v in expected.items() if k != "x4"}
    with pytest.raises(Exception):
        table.manifest(spark, 2)


BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)
SALES = "key string, quantity int, price double, timestamp timestamp, partition int, offset long"


def sales(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        late = rng.choice([0, 0, 0, 90, 200])
        at = BASE + timedelta(seconds=30 * i - 60 * late)
        out.append((rng.choice(["a", "b", None]), rng.randint(1, 5), rng.randint(0, 9999) / 100, at, i % 2, i))
    return out


def delivered(spark, folder, parts):
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SALES).write.parquet(f"{folder}/arrivals/delivery={i}")
        yield spark.readStream.schema(SALES).parquet(f"{folder}/arrivals")


def test_processor_is_exact_over_restarts(spark, folder):
    use_rocksdb_state(spark)
    every = sales(300, 4)
    for stream in delivered(spark, folder, [every[:90], every[90:91], every[91:220], every[220:]]):
        write = batches.upsert_batches(f"{folder}/updates")
        updates = processor.strict_updates(stream, 30)
        jobs.writer(updates, f"{folder}/checkpoint", "update", once=True).foreachBatch(write).start().awaitTermination()
    found = processor.result(batches.read_changelog(spark, f"{folder}/updates", processor.UPDATES), 30)
    whole = spark.createDataFrame(every, SALES)
    expected = summary.summarize(lateness.drop_late(whole, 30, work_dir=f"{folder}/expiry"), 30)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert lateness.late_only(whole.where("key IS NOT NULL"), 30, work_dir=f"{folder}/late").count() > 10


def test_the_window_store_holds_open_windows_only(spark, folder):
    """After each start the store has the windows that end after the latest time; earlier ones are gone."""
    use_rocksdb_state(spark)
    every = [row for row in sales(200, 7) if row[0]]
    every.sort(key=lambda row: row[3])
    seen = []
    for i, stream in enumerate(delivered(spark, folder, [every[:50], every[50:]])):
        updates = jobs.summary_updates(stream, 30)
        jobs.summary_to_table(updates, f"{folder}/updates", f"{folder}/checkpoint", once=True).awaitTermination()
        so_far = every[:50] if i == 0 else every
        latest = max(row[3] for row in so_far)
        whole = summary.summarize(spark.createDataFrame(so_far, SALES), 30)
        expected = whole.where(F.col("window_end") > int(latest.timestamp() * 1000))
        found = store.open_windows(spark, f"{folder}/checkpoint", 30)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
        assert 0 < found.count() < whole.count()
        seen.append(set(map(tuple, found.collect())))
    assert seen[0] != seen[1]
    assert store.stores(spark, f"{folder}/checkpoint").first().operatorName == "stateStoreSave"
