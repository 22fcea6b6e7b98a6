"""Synthetic field values as functions of a row number: same row, same seed, same value.

Being pure expressions of the row number they need no state, survive task retries and run at
any parallelism.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(row: Column, seed: int, slot: int) -> Column:
    """64 pseudo-random bits for one slot of one row."""
    return F.xxhash64(row.cast("bigint"), F.lit(seed).cast("bigint"), F.lit(slot).cast("bigint"))


def unit(row: Column, seed: int, slot: int) -> Column:
    """Uniform double in [0, 1) from the top 53 bits of a draw."""
    return F.shiftrightunsigned(draw(row, seed, slot), 11).cast("double") * F.lit(2.0**-53)


def pick(row: Column, seed: int, slot: int, n: int) -> Column:
    """Uniform integer in [0, n)."""
    return F.pmod(draw(row, seed, slot), F.lit(n).cast("bigint"))


def digits(prefix: str, count: int, row: Column, seed: int, slot: int) -> Column:
    """``prefix`` followed by ``count`` digits 1-9, all taken from one draw."""
    number = pick(row, seed, slot, 9**count)
    places = [(F.floor(number / F.lit(9**i)) % 9 + 1).cast("string") for i in reversed(range(count))]
    return F.concat(F.lit(prefix), *places)


def uniform(low: float, high: float, row: Column, seed: int, slot: int) -> Column:
    """Uniform double in [low, high)."""
    return F.lit(float(low)) + unit(row, seed, slot) * F.lit(float(high) - float(low))


def uniform_int(low: int, high: int, row: Column, seed: int, slot: int) -> Column:
    """Uniform integer in [low, high)."""
    return (F.lit(low) + pick(row, seed, slot, high - low)).cast("int")


def option(values: Sequence[str], row: Column, seed: int, slot: int) -> Column:
    choices = F.array(*(F.lit(v) for v in values))
    return F.element_at(choices, (pick(row, seed, slot, len(values)) + 1).cast("int"))


def iteration(start: int, step: int, row: Column) -> Column:
    return F.lit(start).cast("bigint") + row.cast("bigint") * F.lit(step)
