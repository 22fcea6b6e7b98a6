"""Running aggregates over ordered, unbounded groups, split into bounded blocks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Running:
    """An aggregate that can be built from partial results: how to fold, and how to join two."""

    value: str
    fold: Callable[[Column], Column]
    join: Callable[[Column, Column], Column]


def highest(value: str) -> Running:
    return Running(value, F.max, F.greatest)


def total(value: str) -> Running:
    return Running(value, F.sum, lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b))


def running(
    df: DataFrame,
    by: Sequence[str],
    position: str,
    outputs: Mapping[str, Running],
    *,
    block: int = 1 << 20,
    inclusive: bool = True,
    levels: int = 2,
) -> DataFrame:
    """Add, per output, the aggregate of all rows of the group up to ``position``.

    A window over the whole group would sort it in one task. Instead rows are cut into blocks of
    ``block`` positions; block results are aggregated map-side and scanned by the same method one
    level up, and each block then needs only its own rows and the carried values. Rows are
    exchanged and sorted once: the join reuses the partitioning and order of the block window.
    """
    upto = Window.unboundedPreceding, 0 if inclusive else -1
    if levels == 0:
        whole = Window.partitionBy(*by).orderBy(position).rowsBetween(*upto)
        return df.withColumns({name: run.fold(F.col(run.value)).over(whole) for name, run in outputs.items()})

    block_no = f"__block_{levels}"
    carried = {name: f"__carried_{levels}_{name}" for name in outputs}
    blocked = df.withColumn(block_no, F.call_function("div", F.col(position), F.lit(block)).cast("bigint"))
    per_block = blocked.groupBy(*by, block_no).agg(
        *(run.fold(F.col(run.value)).alias(f"__of_block_{name}") for name, run in outputs.items())
    )
    before = {carried[name]: Running(f"__of_block_{name}", run.fold, run.join) for name, run in outputs.items()}
    carry = running(per_block, by, block_no, before, block=block, inclusive=False, levels=levels - 1)
    in_block = Window.partitionBy(*by, block_no).orderBy(position).rowsBetween(*upto)
    local = blocked.withColumns(
        {f"__in_block_{name}": run.fold(F.col(run.value)).over(in_block) for name, run in outputs.items()}
    )
    return local.join(carry.select(*by, block_no, *carried.values()), [*by, block_no], "left").select(
        *df.columns,
        *(run.join(F.col(carried[n]), F.col(f"__in_block_{n}")).alias(n) for n, run in outputs.items()),
    )
