from pyspark.sql import functions as F

from tidemark.plans import inspect, tables
from tidemark.sources import synthetic


def test_telemetry_domains(spark):
    df = synthetic.telemetry(synthetic.row_numbers(spark, 20_000))
    assert df.where(~F.col("sensor_id").rlike("^sensor_[1-9]{3}$")).count() == 0
    assert df.select("sensor_id").distinct().count() == 729
    outside = "temperature < 15 OR temperature >= 50 OR humidity < 0.05 OR humidity >= 0.7 OR soil_fertility < 40 OR soil_fertility >= 90"
    assert df.where(outside).count() == 0
    assert df.agg(F.min("timestamp"), F.max("timestamp")).first() == (1741421258, 1741421258 + 19_999)
    assert df.where("key <> sensor_id").count() == 0


def test_transaction_domains(spark):
    df = synthetic.transactions(synthetic.row_numbers(spark, 20_000))
    assert df.where(~F.col("transaction_id").rlike("^tx[1-9]{5}$")).count() == 0
    assert df.where(~F.col("product_id").rlike("^prod_[1-9]{3}$")).count() == 0
    assert {r[0] for r in df.select("category").distinct().collect()} == set(synthetic.CATEGORIES)
    assert {r[0] for r in df.select("quantity").distinct().collect()} == set(range(1, 10))
    assert df.where("price < 10 OR price >= 200.001").count() == 0
    assert "timestamp" not in df.columns and dict(df.dtypes)["price"] == "float"


def test_fields_are_even_and_independent(spark):
    df = synthetic.telemetry(synthetic.row_numbers(spark, 20_000))
    mean, corr = df.agg(F.avg("temperature"), F.corr("temperature", "humidity")).first()
    assert abs(mean - 32.5) < 0.3 and abs(corr) < 0.03


def test_rows_do_not_depend_on_parallelism(spark):
    one = synthetic.transactions(synthetic.row_numbers(spark, 500, 1))
    many = synthetic.transactions(synthetic.row_numbers(spark, 500, 13))
    assert one.exceptAll(many).count() == 0
    other = synthetic.transactions(synthetic.row_numbers(spark, 500, 1), seed=99)
    assert one.intersect(other).count() < 5


def test_generation_stays_in_the_jvm_without_exchange(spark):
    df = synthetic.transactions(synthetic.row_numbers(spark))
    assert inspect.exchanges(df) == 0 and inspect.python_nodes(df) == []


def test_endless_rows(spark):
    stream = synthetic.telemetry(synthetic.row_stream(spark, 5))
    assert stream.isStreaming and stream.columns[0] == "key"


def test_named_tables(spark, small):
    tables.register_replayed(spark, small)
    assert spark.table("alerts").count() == 634
    assert spark.sql("SELECT sum(total_quantity) FROM summary").first()[0] == 5386
    assert spark.table("telemetry").count() == spark.table("transactions").count() == 1000
