"""Sums of doubles that are exact and independent of the order of rows.

A double is cut into integer limbs of 30 bits, which are summed as BIGINT: partial sums of any rows in any order give the
same limbs. The total is put together as a whole number of units and rounded to a double once. With three limbs and a unit
of 2^-50, values may be multiples of 2^-50 below 2^40 in size, and 2^33 rows may be summed; a value outside raises.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMB_BITS, LIMBS = 30, 3
UNIT_EXPONENT = -50


def limbs(value: str | Column) -> list[Column]:
    """The limbs of a double, lowest first, each with the value's sign. Null stays null; what does not fit raises."""
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    # scaling by a power of two and cutting off whole parts are exact
    units = F.abs(value) * F.lit(2.0**-UNIT_EXPONENT)
    fits = (units < F.lit(2.0 ** (LIMB_BITS * LIMBS))) & ~F.isnan(value)
    # whole units: above 2^53 every double is whole
    whole = (units >= F.lit(2.0**53)) | (F.floor(F.least(units, F.lit(2.0**53))).cast("double") == units)
    sign = F.when(value < 0, -1).otherwise(1).cast("bigint")
    error = F.raise_error(F.concat(F.lit("no multiple of 2^-50 below 2^40: "), value.cast("string"))).cast("bigint")
    found = []
    for place in range(LIMBS):
        high = F.lit(2.0 ** (LIMB_BITS * (place + 1)))
        low = F.lit(2.0 ** (LIMB_BITS * place))
        rest = units % high
        limb = F.floor(rest / low).cast("bigint") * sign
        found.append(F.when(value.isNotNull(), F.when(fits & whole, limb).otherwise(error)))
    return found


def sums(value: str | Column, name: str) -> list[Column]:
    """One aggregate per limb, to be read by ``total``."""
    return [F.sum(limb).alias(f"{name}_{place}") for place, limb in enumerate(limbs(value))]


def total(name: str) -> Column:
    """The sum as the nearest double."""
    units = F.lit(Decimal(0)).cast("decimal(38,0)")
    for place in range(LIMBS):
        shift = F.lit(Decimal(2 ** (LIMB_BITS * place))).cast("decimal(19,0)")
        units = (units + F.col(f"{name}_{place}").cast("decimal(19,0)") * shift).cast("decimal(38,0)")
    return units.cast("double") * F.lit(2.0**UNIT_EXPONENT)
