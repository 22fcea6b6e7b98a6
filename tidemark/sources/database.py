"""Incremental reads from, and appends to, a database table over JDBC."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..operators.tablekey import default_timestamp, duplicate_keys, split_clashes
from ..schemas import TRANSACTION_TABLE_KEY


def _moment(df: DataFrame, ts_col: str, moment: datetime) -> Column:
    """A bound of the column's own type: a wall clock stays one, whatever zone Python runs in."""
    if isinstance(df.schema[ts_col].dataType, TimestampNTZType):
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(moment)


def newer_than(df: DataFrame, ts_col: str, last: datetime | None, upper: datetime) -> DataFrame:
    """``last < ts < upper``; both bounds are plain comparisons, so any source can push them."""
    bounded = df.where(F.col(ts_col) < _moment(df, ts_col, upper))
    return bounded if last is None else bounded.where(F.col(ts_col) > _moment(df, ts_col, last))


def read_increment(
    table: DataFrame, ts_col: str, last: datetime | None, upper: datetime
) -> tuple[DataFrame, datetime | None]:
    """One poll: the rows strictly between the last offset and now, and the new offset.

    The new offset is the highest time read; the rows are bounded by it, so a row that commits
    between the two reads is picked up next time instead of being skipped.
    """
    fresh = newer_than(table, ts_col, last, upper)
    newest = fresh.agg(F.max(ts_col)).first()[0]
    if newest is None:
        return fresh, last
    return fresh.where(F.col(ts_col) <= _moment(table, ts_col, newest)), newest


def unsent(rows: DataFrame, ts_col: str, key: Sequence[str], ledger: DataFrame | None) -> DataFrame:
    """The rows whose key and time are not in the ledger; a missing key part compares like any value."""
    if ledger is None or ts_col not in ledger.columns:
        return rows
    sent = ledger.select(*[F.col(name).alias(f"__{name}") for name in (*key, ts_col)])
    same = [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in (*key, ts_col)]
    return rows.join(sent, same, "left_anti")


def read_overlapping(
    table: DataFrame,
    ts_col: str,
    key: Sequence[str],
    last: datetime | None,
    upper: datetime,
    overlap: timedelta,
    ledger: DataFrame | None = None,
) -> tuple[DataFrame, datetime | None]:
    """One poll that also sees rows which became visible after a later time had been read, up to ``overlap`` behind it.

    ``ledger`` holds key and time of the rows already sent within the overlap. Returned are the rows not in it and the new
    offset; ``next_ledger`` gives what to keep. A row that becomes visible within ``overlap`` of its time is read once.
    """
    floor = None if last is None else last - overlap
    rows, newest = read_increment(table, ts_col, floor, upper)
    rows = unsent(rows, ts_col, key, ledger)
    if newest is None or (last is not None and newest < last):
        newest = last
    return rows, newest


def next_ledger(
    rows: DataFrame, ts_col: str, key: Sequence[str], newest: datetime, overlap: timedelta, ledger: DataFrame | None = None
) -> DataFrame:
    """Key and time of everything sent that the next poll will read again; older entries expire."""
    sent = rows.select(*key, ts_col)
    if ledger is not None and ts_col in ledger.columns:
        sent = sent.unionByName(ledger.select(*key, ts_col))
    return sent.where(F.col(ts_col) > _moment(sent, ts_col, newest - overlap))


def replay(
    table: DataFrame, ts_col: str, uppers: Sequence[datetime], last: datetime | None = None
) -> list[tuple[DataFrame, datetime | None]]:
    """Successive polls at the given clock readings: (rows, offset after the poll)."""
    polls = []
    for upper in uppers:
        rows, last = read_increment(table, ts_col, last, upper)
        polls.append((rows, last))
    return polls


def poll_numbers(table: DataFrame, ts_col: str, uppers: Sequence[datetime], name: str = "poll") -> DataFrame:
    """The rows that successive polls at the given, rising clock readings return, with the poll's number, in one scan.

    A row belongs to the first poll whose reading lies behind its time; ``replay`` reads the same rows poll by poll.
    """
    number = F.lit(0)
    for upper in uppers[:-1]:
        number = number + (F.col(ts_col) >= _moment(table, ts_col, upper)).cast("int")
    return newer_than(table, ts_col, None, uppers[-1]).withColumn(name, number)


@dataclass(frozen=True)
class JdbcTable:
    """Where a table lives. ``options`` takes driver, user, password, fetchsize and so on.

    Times are read without a zone, exactly as the database prints them, so an offset written
    back into a predicate means the same moment.
    """

    url: str
    name: str
    options: Mapping[str, str] = field(default_factory=dict)

    def _base(self) -> dict[str, str]:
        return {"url": self.url, "fetchsize": "10000", "preferTimestampNTZ": "true", **self.options}

    def span_options(self, ts_col: str, last: datetime | None, upper: datetime | None) -> dict[str, str]:
        """Let the database compute the span to read; one row crosses the network. Without ``upper`` its clock bounds it."""
        where = " AND ".join(time_bounds(ts_col, last, upper))
        columns = f"min({ts_col}) AS oldest, max({ts_col}) AS newest"
        return self._base() | {"query": f"SELECT {columns} FROM {self.name} WHERE {where}"}

    def increment(
        self,
        spark: SparkSession,
        ts_col: str,
        last: datetime | None,
        upper: datetime | None = None,
        slices: int = 1,
        hash_sql: str | None = None,
        hash_parts: int = 1,
    ) -> tuple[DataFrame | None, datetime | None]:
        """One poll over JDBC, read by ``slices * hash_parts`` tasks, up to ``upper`` or the database's own time."""
        span = spark.read.format("jdbc").options(**self.span_options(ts_col, last, upper)).load()
        oldest, newest = span.first()
        if newest is None:
            return None, last
        predicates = slice_predicates(ts_col, oldest, newest, slices, hash_sql, hash_parts)
        properties = {k: v for k, v in self._base().items() if k != "url"}
        return spark.read.jdbc(self.url, self.name, predicates=predicates, properties=properties), newest

    def append_options(self, connections: int = 8, batch: int = 10_000) -> dict[str, str]:
        return self._base() | {
            "dbtable": self.name,
            "numPartitions": str(connections),
            "batchsize": str(batch),
        }


def _literal(moment: datetime) -> str:
    return f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S.%f}'"


def time_bounds(ts_col: str, last: datetime | None, upper: datetime | None) -> list[str]:
    after = [] if last is None else [f"{ts_col} > {_literal(last)}"]
    return [*after, f"{ts_col} < {'CURRENT_TIMESTAMP' if upper is None else _literal(upper)}"]


def slice_predicates(
    ts_col: str,
    oldest: datetime,
    newest: datetime,
    slices: int,
    hash_sql: str | None = None,
    hash_parts: int = 1,
) -> list[str]:
    """Disjoint WHERE clauses that together cover ``oldest <= ts <= newest``.

    Time slices alone leave one hot second in one task; ``hash_sql`` (an integer expression of
    the database, for example a checksum of the row id) splits every slice further.
    """
    if slices < 1 or hash_parts < 1:
        raise ValueError("slices and hash_parts must be at least 1")
    edges = [oldest + (newest - oldest) * i / slices for i in range(slices)] + [newest]
    spans = [
        f"{ts_col} {'>' if i else '>='} {_literal(low)} AND {ts_col} <= {_literal(high)}"
        for i, (low, high) in enumerate(zip(edges, edges[1:]))
    ]
    if hash_sql is None or hash_parts == 1:
        return spans
    return [f"{span} AND MOD({hash_sql}, {hash_parts}) = {i}" for span in spans for i in range(hash_parts)]


class KeyClash(ValueError):
    """Rows of one append share a table key; nothing was written."""


def prepare_append(rows: DataFrame) -> DataFrame:
    """Rows as the table will hold them, all of them: default timestamp and two-decimal price."""
    return default_timestamp(rows).withColumn("price", F.col("price").cast("decimal(10,2)"))


def append(
    rows: DataFrame, table: JdbcTable, connections: int = 8, clash_folder: str | None = None, shown: int = 10
) -> None:
    """Insert every row. Rows that share a table key raise ``KeyClash`` before anything is written, as the table's own
    key would; with ``clash_folder`` they are kept there, all of them, and the other rows are inserted.
    """
    ready = prepare_append(rows)
    if clash_folder is None:
        clashes = duplicate_keys(ready).select(*TRANSACTION_TABLE_KEY).take(shown)
        if clashes:
            raise KeyClash(f"several rows for {', '.join(str(tuple(row)) for row in clashes)} and perhaps more keys")
    else:
        ready, clashing = split_clashes(ready)
        clashing.write.mode("overwrite").parquet(clash_folder)
    insert(ready, table, connections)


def insert(rows: DataFrame, table: JdbcTable, connections: int) -> None:
    rows.write.format("jdbc").options(**table.append_options(connections)).mode("append").save()


def append_batches(
    table: JdbcTable, connections: int = 8, clash_folder: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function appending every micro-batch. A repeated batch replaces its own clash folder's part."""

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = None if clash_folder is None else f"{clash_folder}/batch={batch_id}"
        batch = batch.persist()  # counted for clashes, then written
        try:
            append(batch, table, connections, folder)
        finally:
            batch.unpersist()

    return write
