import pytest

from tidemark import __main__ as cli
from tidemark.params import ParameterError
from tidemark.streaming import jobs


class Stop(Exception):
    pass


def test_every_job_needs_a_checkpoint(spark, monkeypatch):
    monkeypatch.delenv("CHECKPOINT_LOCATION", raising=False)
    for job in cli.JOBS:
        with pytest.raises(ParameterError, match="CHECKPOINT_LOCATION"):
            cli.start(spark, job)


def test_jobs_read_their_settings(spark, monkeypatch):
    seen = {}

    def record(name):
        def run(session, params, checkpoint, schema_id, intake):
            seen[name] = (params, checkpoint, schema_id, intake)

        return run

    for name in ("run_alerts", "run_summary", "run_strict_summary"):
        monkeypatch.setattr(cli.jobs, name, record(name))
    monkeypatch.setenv("CHECKPOINT_LOCATION", "/x")
    monkeypatch.setenv("SCHEMA_ID", "9")
    monkeypatch.setenv("INPUT_SCHEMA_IDS", "7, 8")
    monkeypatch.setenv("MIN_PARTITIONS", "64")
    with pytest.raises(ParameterError, match="MAX_OFFSETS_PER_TRIGGER"):
        cli.start(spark, "strict-summary")
    monkeypatch.setenv("MAX_OFFSETS_PER_TRIGGER", "1000000")
    monkeypatch.setenv("WINDOW_SIZE_MINUTES", "5")
    monkeypatch.setenv("TEMPERATURE_THRESHOLD", "30")
    for job in ("alerts", "summary", "strict-summary"):
        cli.start(spark, job)
    assert seen["run_alerts"][0].temperature_threshold == 30.0
    assert seen["run_summary"][0].window_minutes == seen["run_strict_summary"][0].window_minutes == 5
    intake = jobs.Intake(frozenset({7, 8}), 1_000_000, 64)
    assert {entry[1:] for entry in seen.values()} == {("/x", 9, intake)}


@pytest.mark.parametrize("job", ["alerts", "summary", "poll", "generate-telemetry"])
def test_writing_jobs_need_a_schema_id(spark, monkeypatch, job):
    monkeypatch.setenv("CHECKPOINT_LOCATION", "/x")
    monkeypatch.delenv("SCHEMA_ID", raising=False)
    with pytest.raises(ParameterError, match="SCHEMA_ID"):
        cli.start(spark, job)


def test_polls_are_sliced(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(cli.ingest, "read_table", lambda table, **slicing: seen.update(slicing))
    monkeypatch.setattr(cli.ingest, "poll_table", lambda *a: (_ for _ in ()).throw(Stop()))
    for name, value in {"CHECKPOINT_LOCATION": "/x", "SCHEMA_ID": "1", "JDBC_URL": "jdbc:none"}.items():
        monkeypatch.setenv(name, value)
    with pytest.raises(ParameterError, match="JDBC_SLICES"):
        cli.start(spark, "poll")
    for name, value in {"JDBC_SLICES": "16", "JDBC_HASH_SQL": "crc32(transaction_id)", "JDBC_HASH_PARTS": "4"}.items():
        monkeypatch.setenv(name, value)
    with pytest.raises(Stop):
        cli.start(spark, "poll")
    assert seen == {"slices": 16, "hash_sql": "crc32(transaction_id)", "hash_parts": 4}


def test_table_jobs_need_a_url(spark, monkeypatch):
    monkeypatch.setenv("CHECKPOINT_LOCATION", "/x")
    monkeypatch.setenv("SCHEMA_ID", "1")
    monkeypatch.delenv("JDBC_URL", raising=False)
    with pytest.raises(ParameterError, match="JDBC_URL"):
        cli.start(spark, "poll")


@pytest.mark.parametrize(
    ("job", "topic"), [("generate-telemetry", "sensor-telemetry"), ("generate-transactions", "_transactions")]
)
def test_generators_write_to_their_topics(spark, monkeypatch, job, topic):
    def writer(messages, params, checkpoint, mode):
        assert messages.isStreaming and messages.columns == ["key", "value"]
        assert (params.output_topic, mode) == (topic, "append")
        raise Stop

    monkeypatch.setenv("CHECKPOINT_LOCATION", "/x")
    monkeypatch.setenv("SCHEMA_ID", "1")
    monkeypatch.setattr(cli.topics, "topic_writer", writer)
    with pytest.raises(Stop):
        cli.start(spark, job)
