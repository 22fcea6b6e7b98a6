from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.operators import summary
from tidemark.plans import inspect
from tidemark.schemas import SUMMARY
from tidemark.sources import replayed

SALE = "key string, quantity int, price double, timestamp timestamp"


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def sales(spark, *rows):
    return spark.createDataFrame([(k, q, p, at(t)) for k, q, p, t in rows], SALE)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_documented_window(spark):
    rows = sales(
        spark,
        ("pesticides", 30, 200.0, "2025-03-09 07:27:00"),
        ("pesticides", 1, 72.54, "2025-03-09 07:27:59.999"),
        ("pesticides", 5, 1.0, "2025-03-09 07:28:00"),
    )
    assert result(summary.summarize(rows)) == [
        ("pesticides", 5, 1.0, 1741505280000, 1741505340000),
        ("pesticides", 31, 272.54, 1741505220000, 1741505280000),
    ]


def test_names_and_types(spark):
    out = summary.summarize(sales(spark, ("a", 1, 1.0, "2024-01-01 00:00:00")))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in SUMMARY]


def test_null_keys_never_aggregate(spark):
    rows = sales(spark, (None, 1, 1.0, "2024-01-01 00:00:00"), ("a", 2, 2.0, "2024-01-01 00:00:00"))
    assert [r.category for r in summary.summarize(rows).collect()] == ["a"]


def test_quantity_does_not_wrap(spark):
    rows = sales(spark, ("a", 2147483647, 1.0, "2024-01-01"), ("a", 1, 1.0, "2024-01-01"))
    assert summary.summarize(rows).first().total_quantity == 2147483648


def test_revenue_is_exact_and_counts_price_only(spark):
    rows = sales(spark, *[("a", 9, 0.1, "2024-01-01")] * 10)
    assert summary.summarize(rows).first().total_revenue == 1.0


def test_output_category_is_the_key_not_the_field(spark):
    rows = sales(spark, ("by-key", 1, 1.0, "2024-01-01")).withColumn("category", F.lit("by-field"))
    assert summary.summarize(rows).first().category == "by-key"


def test_windows_before_the_epoch(spark):
    (row,) = summary.summarize(sales(spark, ("a", 1, 1.0, "1969-12-31 23:59:30"))).collect()
    assert (row.window_start, row.window_end) == (-60000, 0)


@pytest.mark.parametrize("minutes", [0, -1])
def test_width_must_be_positive(spark, minutes):
    with pytest.raises(ValueError):
        summary.summarize(sales(spark, ("a", 1, 1.0, "2024-01-01")), minutes)


def test_one_exchange_after_partial_sums(spark, small):
    out = summary.summarize(replayed.transactions(replayed.events(spark, small)), 60)
    assert inspect.exchanges(out) == 1
    plan = inspect.physical(out)
    assert plan.index("partial_sum") > plan.index("Exchange")
    assert inspect.python_nodes(out) == []


def test_keyed_output(spark):
    out = summary.keyed_summary(summary.summarize(sales(spark, ("a", 1, 1.0, "2024-01-01"))))
    assert out.first().key == "a" and out.columns == ["key", "value"]


def test_cents_equal_the_decimal_cast(spark):
    """Whole cents, ties, near-ties, negative and large prices."""
    unit = F.shiftrightunsigned(F.xxhash64("id"), 11).cast("double") * 2.0**-53
    prices = spark.range(40_000).select(
        F.explode(
            F.array(
                F.round(unit * 200, 2),
                (F.floor(unit * 20_000) + 0.5) / 100,
                F.round(unit * 99_000_000, 2),
                -F.round(unit * 1000, 2),
                -(F.floor(unit * 2_000_000) + 0.5) / 100,
                unit * 1000,
                F.floor(unit * 20_000) / 100 + 0.0000099,
                F.round(unit * 200, 2).cast("float").cast("double"),
            )
        ).alias("price")
    )
    literal = (F.col("price").cast("decimal(10,2)") * 100).cast("bigint")
    assert prices.where(scalars.cents("price") != literal).count() == 0
    assert prices.where(scalars.cents("price").isNull()).count() == 0


@pytest.mark.parametrize("text", ["1e8", "-1e8", "1e300"])
def test_prices_beyond_the_column_raise(spark, text):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        spark.sql(f"SELECT {text}D AS price").select(scalars.cents("price")).collect()


def test_any_aggregates_over_the_same_windows(spark):
    rows = sales(spark, ("a", 1, 2.5, "2024-01-01 00:00:10"), ("a", 3, 1.5, "2024-01-01 00:00:50"))
    out = summary.window_aggregate(rows, 1, [F.max("price").alias("top"), F.count(F.lit(1)).alias("n")])
    assert out.columns == ["category", "window_start", "top", "n"]
    assert tuple(out.first()) == ("a", 1704067200000, 2.5, 2)
