"""Small column expressions used by the jobs; all stay inside generated JVM code."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"


def as_text(value: float) -> Column:
    """A double printed the way the JVM prints it (35.0, 28.999999999999996, 1.0E7)."""
    return F.lit(float(value)).cast("string")


def temperature_text(threshold: float) -> Column:
    return F.concat(F.lit("Temperature exceeded "), as_text(threshold), F.lit("°C"))


def humidity_text(threshold: float) -> Column:
    percent = (F.lit(float(threshold)) * F.lit(100.0)).cast("string")
    return F.concat(F.lit("Humidity is below "), percent, F.lit("%"))


def greater_than(column: str | Column, threshold: float) -> Column:
    """``column > threshold`` with IEEE meaning: NaN compares false (Spark ranks it highest)."""
    value = F.col(column) if isinstance(column, str) else column
    return (value > F.lit(float(threshold))) & ~F.isnan(value)


def less_than(column: str | Column, threshold: float) -> Column:
    """``column < threshold``; NaN is already false because Spark ranks it highest."""
    value = F.col(column) if isinstance(column, str) else column
    return value < F.lit(float(threshold))


def money(column: str | Column) -> Column:
    """Two decimals, as the transactions table stores prices."""
    return (F.col(column) if isinstance(column, str) else column).cast(MONEY)


def cents(column: str | Column) -> Column:
    """A price in whole hundredths, BIGINT, rounded half up as ``money`` rounds.

    Prices within a thousandth of a whole cent - all that ever had two decimals - take plain
    arithmetic, five times cheaper than the decimal cast that settles the rest.
    """
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    scaled = value * F.lit(100.0)
    nearest = F.floor(scaled + F.lit(0.5))
    plain = (F.abs(scaled - nearest) < F.lit(1e-3)) & (F.abs(nearest) < F.lit(10**10))
    return F.when(plain, nearest).otherwise((money(value) * 100).cast("bigint"))


def from_cents(column: str) -> Column:
    """Hundredths as a double, through a decimal so that large sums are rounded only once."""
    return (F.col(column).cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast("double")


def minutes(n: int) -> str:
    """Interval text for a window width."""
    if n <= 0:
        raise ValueError("a window must be at least one minute wide")
    return f"{n} minutes"


def epoch_ms(column: str | Column) -> Column:
    return F.unix_millis(F.col(column) if isinstance(column, str) else column)


def window_start(column: str | Column, window_minutes: int) -> Column:
    """Start of the tumbling, epoch-aligned window a time falls into, in epoch milliseconds."""
    now, width = epoch_ms(column), F.lit(_width_ms(window_minutes))
    return now - F.pmod(now, width)


def window_index(column: str | Column, window_minutes: int) -> Column:
    """Number of the window since the epoch; an INT, so that joins can pack their keys."""
    width = F.lit(_width_ms(window_minutes))
    return F.call_function("div", window_start(column, window_minutes), width).cast("int")


def _width_ms(window_minutes: int) -> int:
    minutes(window_minutes)
    return window_minutes * 60_000
