"""Repair of conversation structure by a grammar-compressed dynamic program.

A turn becomes a symbol of its role initial and its first fault. Edits (keep, rerole, delete, insert) drive an automaton
for ``(s?(ua)+)?`` on the initials of the result, so a run of symbols is a matrix over its four states: the least cost from
state to state and, at that cost, the ASCII-least sequence of edits. Runs compose by the min-plus product. Re-Pair rounds
over the distinct runs of all conversations replace their most frequent pairs by new symbols; each rule's matrix is made
once, from the two below it, with ropes for its edits, and serves all conversations.

Equal costs never hide a wrong tie: two edit sequences over the same rows, one a prefix of the other, differ by inserts
alone and so in cost. The order of two sequences is thus the order of whatever follows them.

At scale: rows are put in order by ranges of (conversation, turn, role, text hash, copy), so a conversation of any length
spreads over many tasks, and cut into runs of at most ``RUN`` rows. Only a conversation's matrices (up to 16 sequences a
run) and, for the digest, its repaired text pass through one task, in order and one run at a time.

Defined results: a null conv_id is a conversation; a null role or text, and a null id or turn within the damage's key, is one
space; an empty role has no initial; rows of one turn stand by role, then by the SHA-256 of their text, equal ones adjacent;
a conversation without rows has zeros, an empty audit and the hash of the empty string; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import cmp_to_key, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import written

RUN_BITS = 10
RUN = 1 << RUN_BITS  # rows
ROUNDS, RULES_A_ROUND = 4, 32
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
CUT_OFF = 5  # of a truncated row that stays
SPACE = " \t\n\x0b\x0c\r"
STATES = range(4)  # nothing yet; after s; after u; after a
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}  # the initial an inserted or reroled turn takes
ROLES = {"u": "user", "a": "assistant"}
ENDS = (0, 3)
GONE = "d"  # a row that must be deleted; else s, u, a or x (other), in capitals if truncated

PLANS = "conv_id long, run long, state int, edits string, last boolean, cost long, audit string, gaps long, blank long, duplicate long, truncated long, illegal long"
TURNS = "conv_id long, pos long, sub int, edit string, role string, own_role string, turn long, text_hash string"
DIGEST = "conv_id long, repaired_sha256 string"


# --- the program: entries are (cost, rope), a rope is a text or a pair of ropes ---------------------------------------


def flat(rope) -> str:
    out, rest = [], [rope]
    while rest:
        top = rest.pop()
        if isinstance(top, str):
            out.append(top)
        else:
            rest += (top[1], top[0])
    return "".join(out)


def least(a, b):
    """The cheaper of two entries, of equal ones the ASCII-least; None is no way at all."""
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return min(a, b, key=lambda x: x[0])
    return a if flat(a[1]) <= flat(b[1]) else b


def product(left: Sequence, right: Sequence) -> list:
    """The min-plus product of two matrices, row by row."""
    out = [None] * 16
    for p in STATES:
        for q in STATES:
            for mid in STATES:
                a, b = left[4 * p + mid], right[4 * mid + q]
                if a and b:
                    out[4 * p + q] = least(out[4 * p + q], (a[0] + b[0], (a[1], b[1])))
    return out


def inserts() -> list:
    """Any number of inserts between two rows."""
    out = [None] * 16
    for p in STATES:
        q, text = p, ""
        while out[4 * p + q] is None:
            out[4 * p + q] = (COST[INSERT] * len(text), text)
            q, text = NEXT[q, WANTED[q]], text + INSERT
    return out


def edits_of(symbol: str) -> list:
    """The edits of one row."""
    out = [None] * 16
    more = CUT_OFF if symbol.isupper() else 0
    for p in STATES:
        out[5 * p] = (COST[DELETE], DELETE)
        if symbol == GONE:
            continue
        ways = [(WANTED[p], REROLE)]
        if (p, symbol.lower()) in NEXT:
            ways.append((symbol.lower(), KEEP))
        for initial, edit in ways:
            at = 4 * p + NEXT[p, initial]
            out[at] = least(out[at], (COST[edit] + more, edit))
    return out


INSERTS = inserts()
SYMBOLS = {symbol: product(INSERTS, edits_of(symbol)) for symbol in "suaxSUAX" + GONE}


class Grammar:
    """Rules in the order they were made, and a matrix for each symbol."""

    def __init__(self) -> None:
        self.rules: list[tuple[str, str]] = []
        self.matrices = dict(SYMBOLS)

    def add(self, pair: str) -> str:
        symbol = chr(0xE000 + len(self.rules))
        self.rules.append((pair, symbol))
        self.matrices[symbol] = product(self.matrices[pair[0]], self.matrices[pair[1]])
        return symbol

    def matrix(self, packed: str) -> list:
        """Of a whole run, by halves."""
        if len(packed) == 1:
            return self.matrices[packed]
        half = len(packed) // 2
        return product(self.matrix(packed[:half]), self.matrix(packed[half:]))


def packed(symbols: Column, rules: Iterable[tuple[str, str]]) -> Column:
    for pair, symbol in rules:
        symbols = F.replace(symbols, F.lit(pair), F.lit(symbol))
    return symbols


def learn(runs: DataFrame, rounds: int = ROUNDS, rules: int = RULES_A_ROUND) -> Grammar:
    """Re-Pair over distinct runs (symbols, n): each round adds the ``rules`` most frequent pairs found at least twice."""
    grammar = Grammar()
    for _ in range(rounds):
        now = runs.select("n", packed(F.col("symbols"), grammar.rules).alias("s")).where("length(s) > 1")
        pairs = now.select("n", F.explode(F.expr("transform(sequence(1, length(s) - 1), i -> substring(s, i, 2))")).alias("pair"))
        counts = pairs.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        top = counts.orderBy(F.desc("n"), "pair").limit(rules).collect()
        if not top:
            break
        for row in top:
            grammar.add(row.pair)
    return grammar


def matrices(runs: DataFrame, grammar: Grammar) -> DataFrame:
    """symbols, costs, audits of every distinct run; a cost of -1 is no way at all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [grammar.matrix(p) for p in part.column(1).to_pylist()]
                costs = [[-1 if e is None else e[0] for e in matrix] for matrix in found]
                audits = [["" if e is None else flat(e[1]) for e in matrix] for matrix in found]
                columns = [part.column(0), pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=["symbols", "costs", "audits"])

    rows = runs.select("symbols", packed(F.col("symbols"), grammar.rules).alias("packed"))
    return rows.mapInArrow(run, "symbols string, costs array<long>, audits array<string>")


class Path:
    """The cheapest edits of one conversation up to a run's end, for each state; fed with runs in order.

    Of two states' sequences only their order is kept, or by how many inserts one is longer than the other.
    """

    def __init__(self) -> None:
        self.best: list = [(0, None), None, None, None]  # cost, chain of (before, run, state, edits)
        self.order: dict[tuple[int, int], tuple[int, int]] = {(0, 0): (0, 0)}

    def compare(self, p: int, a: str, q: int, b: str) -> tuple[int, int]:
        """The order of state p's sequence and ``a`` against q's and ``b``: a sign, or 0 and the inserts b is longer by."""
        sign, longer = self.order[p, q]
        if sign:
            return sign, 0
        a, b = INSERT * max(-longer, 0) + a, INSERT * max(longer, 0) + b
        if b.startswith(a) or a.startswith(b):
            return 0, len(b) - len(a)
        return (-1, 0) if a < b else (1, 0)

    def choose(self, ways: list[tuple[int, int, str]]) -> tuple[int, int, str] | None:
        """Of (cost, state, edits), the cheapest and ASCII-least."""
        if not ways:
            return None
        cost = min(way[0] for way in ways)
        same = [way for way in ways if way[0] == cost]

        def order(x, y) -> int:
            sign, longer = self.compare(x[1], x[2], y[1], y[2])
            return sign or -longer

        return min(same, key=cmp_to_key(order))

    def feed(self, run: int, costs: Sequence[int], audits: Sequence[str]) -> None:
        ways: dict[int, list] = {q: [] for q in STATES}
        for p in STATES:
            if self.best[p]:
                for q in STATES:
                    if costs[4 * p + q] >= 0:
                        ways[q].append((self.best[p][0] + costs[4 * p + q], p, audits[4 * p + q]))
        chosen = {q: self.choose(some) for q, some in ways.items()}
        reached = [q for q in STATES if chosen[q]]
        order = {
            (x, y): self.compare(chosen[x][1], chosen[x][2], chosen[y][1], chosen[y][2]) for x in reached for y in reached
        }
        self.best = [
            (chosen[q][0], (self.best[chosen[q][1]][1], run, chosen[q][1], chosen[q][2])) if chosen[q] else None for q in STATES
        ]
        self.order = order

    def finish(self) -> tuple[int, list[tuple[int, int, str]]]:
        """The cost, and (run, state before it, edits) of every run."""
        ends = [
            (self.best[p][0] + INSERTS[4 * p + q][0], p, INSERTS[4 * p + q][1])
            for p in STATES
            if self.best[p]
            for q in ENDS
            if INSERTS[4 * p + q]
        ]
        cost, state, more = self.choose(ends)
        pieces, chain = [], self.best[state][1]
        while chain:
            chain, run, before, edits = chain
            pieces.append((run, before, edits + more))
            more = ""
        return cost, pieces[::-1]


# --- rows -----------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32 of ``conv_id:turn`` chooses."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("damage"),
    )
    damage = F.col("damage")
    return rows.where(damage != 0).select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(damage == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_"),
    ).drop("_")


def same(left: str, right: str, *names: str) -> Column:
    """Equal in all columns, null counting as a value."""
    matches = [F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}")) for name in names]
    return reduce(Column.__and__, matches)


def facts(turns: DataFrame) -> DataFrame:
    """Turns with the hash of their text and whether it is blank or ends without a mark."""
    bare = F.rtrim("text", F.lit(SPACE))
    return turns.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.sha2(F.col("text").cast("binary"), 256).alias("text_hash"),
        (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut_off"),
    )


def in_order(rows: DataFrame) -> DataFrame:
    """One row for each turn and copy, without texts, with its place ``pos`` in the order of all, its fault and symbol."""
    collapsed = rows.groupBy("conv_id", "turn", "role", "text_hash").agg(
        F.count("*").alias("copies"), F.first("blank").alias("blank"), F.first("cut_off").alias("cut_off")
    )
    firsts = collapsed.groupBy("conv_id", "role", "text_hash").agg(F.min(F.struct("turn")).alias("first"))
    seen = collapsed.alias("x").join(firsts.alias("y"), same("x", "y", "conv_id", "role", "text_hash")).select("x.*", "y.first")
    copies = seen.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    duplicate = (F.col("copy") > 1) | ~F.col("turn").eqNullSafe(F.col("first.turn"))
    fault = F.when(F.col("blank"), "blank").when(duplicate, "duplicate").when(F.col("cut_off"), "truncated").otherwise("")
    first = F.substring("role", 1, 1)
    initial = F.when(first.isin("s", "u", "a"), first).otherwise("x")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", F.upper("initial"))
    named = copies.select("conv_id", "turn", "role", "text_hash", "copy", fault.alias("fault"), initial.alias("initial"))
    keys = ("conv_id", "turn", "role", "text_hash", "copy")
    ordered = named.withColumn("symbol", symbol.otherwise(F.col("initial"))).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ordered.select("*", F.monotonically_increasing_id().alias("pos"))


def runs_of(ordered: DataFrame) -> DataFrame:
    """A conversation's rows in runs of at most ``RUN``, which the order of rows cuts."""
    row = F.struct("pos", "turn", "role", "text_hash", "symbol", "initial", "fault")
    run = F.shiftright("pos", RUN_BITS).alias("run")
    grouped = ordered.groupBy("conv_id", run).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    of = lambda field: F.concat_ws("", F.transform("rows", lambda x: x[field]))
    return grouped.select("conv_id", "run", "rows", of("symbol").alias("symbols"), of("initial").alias("initials"))


def counts_of(runs: DataFrame) -> DataFrame:
    """What the summary needs of a run besides its matrix."""
    rows = F.col("rows")
    turns = F.filter(F.transform(rows, lambda x: x["turn"]), lambda x: x.isNotNull())
    fault = lambda name: F.size(F.filter(rows, lambda x: x["fault"] == name)).cast("long").alias(name)
    return runs.select(
        "conv_id",
        "run",
        "symbols",
        "initials",
        F.array_min(turns).alias("low"),
        F.array_max(turns).alias("high"),
        F.size(F.array_distinct(turns)).cast("long").alias("turns"),
        *[fault(name) for name in ("blank", "duplicate", "truncated")],
    )


class Summary:
    """One conversation, fed with its runs in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.path, self.last = conv_id, Path(), ""
        self.low, self.high, self.turns, self.illegal = None, None, 0, 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def feed(self, row: dict) -> None:
        self.path.feed(row["run"], row["costs"], row["audits"])
        initials = self.last + row["initials"]
        self.illegal += sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))
        self.last = initials[-1:]
        for name in self.faults:
            self.faults[name] += row[name]
        if row["turns"]:
            # turns ascend, so one that two runs share is the last of the first and the first of the second
            self.turns += row["turns"] - (self.high == row["low"])
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]

    def rows(self) -> Iterator[tuple]:
        cost, pieces = self.path.finish()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        audit = "".join(edits for _, _, edits in pieces)
        for i, (run, state, edits) in enumerate(pieces):
            last = i == len(pieces) - 1
            more = (cost, audit, gaps, *self.faults.values(), self.illegal) if last else (None,) * 7
            yield (self.conv_id, run, state, edits, last, *more)


ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields]
    )


def in_batches(rows: Iterator[tuple], schema: str, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch_of(held, schema)
            held = []
    if held:
        yield batch_of(held, schema)


def rows_of(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield from batch.slice(at, size).to_pylist()


def by_conversation(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def plans(runs: DataFrame, found: DataFrame) -> DataFrame:
    """The edits of every run, and in a conversation's last row its summary."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None
        for row in rows_of(batches):
            if now is None or now.conv_id != row["conv_id"]:
                if now:
                    yield from now.rows()
                now = Summary(row["conv_id"])
            now.feed(row)
        if now:
            yield from now.rows()

    rows = counts_of(runs).join(found, "symbols").drop("symbols")
    return by_conversation(rows, "run").mapInArrow(lambda batches: in_batches(each(batches), PLANS), PLANS)


def edited(runs: DataFrame, planned: DataFrame) -> DataFrame:
    """The turns of the repaired conversations in order (pos, sub), without texts; inserted ones have no own_role."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for row in rows_of(batches, 16):
            state, at, sub = row["state"], 0, 0
            rows = row["rows"]
            for edit in row["edits"]:
                # inserts go before the next row; those after the last row go behind it
                own = rows[min(at, len(rows) - 1)]
                if edit != DELETE:
                    initial = own["initial"] if edit == KEEP else WANTED[state]
                    state = NEXT[state, initial]
                    role = own["role"] if edit == KEEP else ROLES[initial]
                    of = (None, None, None) if edit == INSERT else (own["role"], own["turn"], own["text_hash"])
                    yield (row["conv_id"], own["pos"], sub, edit, role, *of)
                sub += 1
                if edit != INSERT:
                    at += 1
                    sub = 0 if at < len(rows) else sub

    few = planned.select("conv_id", "run", "state", "edits")
    rows = runs.alias("x").join(few.alias("y"), same("x", "y", "conv_id", "run")).select("x.conv_id", "rows", "state", "edits")
    return rows.mapInArrow(lambda batches: in_batches(each(batches), TURNS), TURNS)


class Repaired:
    """Tables below the shared folder: ``turns`` in order (pos, sub) with their texts, ``summary`` one row a conversation."""

    def __init__(self, turns: DataFrame, summary: DataFrame):
        self.turns, self.summary = turns, summary


def repair(turns: DataFrame) -> Repaired:
    """Repair conversations (conv_id, turn, role, text without nulls in role and text)."""
    rows = written(facts(turns), "repair-rows")
    runs = written(runs_of(written(in_order(rows), "repair-order")), "repair-runs")
    distinct = written(runs.groupBy("symbols").agg(F.count("*").alias("n")), "repair-distinct")
    planned = written(plans(runs, written(matrices(distinct, learn(distinct)), "repair-matrices")), "repair-plans")
    kept = edited(runs, planned).alias("x")
    keys = ("conv_id", "turn", "role", "text_hash")
    texts = rows.groupBy(*keys).agg(F.first("text").alias("text")).withColumnRenamed("role", "own_role").alias("y")
    whole = kept.join(texts, same("x", "y", "conv_id", "turn", "own_role", "text_hash"), "left")
    repaired = whole.select("x.conv_id", "pos", "sub", "edit", "x.role", F.coalesce("text", F.lit("")).alias("text"))
    summary = planned.where("last").drop("run", "state", "edits", "last")
    return Repaired(written(repaired, "repair-turns"), summary)


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text``, newline-joined, read in order."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        conv, now = None, None
        for row in rows_of(batches):
            if now is None or conv != row["conv_id"]:
                if now is not None:
                    yield conv, now.hexdigest()
                conv, now = row["conv_id"], hashlib.sha256()
            else:
                now.update(b"\n")
            now.update(f"{row['role']}:{row['text']}".encode())
        if now is not None:
            yield conv, now.hexdigest()

    rows = by_conversation(turns, "pos", "sub").select("conv_id", "role", "text")
    return rows.mapInArrow(lambda batches: in_batches(each(batches), DIGEST), DIGEST)


def report(conversations: DataFrame, repaired: Repaired) -> DataFrame:
    """The summary and digest of every conversation, also of those without rows."""
    empty = F.lit(hashlib.sha256().hexdigest())
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("x")
    found = ids.join(repaired.summary.alias("y"), same("x", "y", "conv_id"), "left")
    found = found.join(digests(repaired.turns).alias("z"), same("x", "z", "conv_id"), "left")
    return found.select(
        "x.conv_id",
        *[F.coalesce(f"y.{name}", F.lit(0).cast("long")).alias(name) for name in numbers],
        F.coalesce("y.audit", F.lit("")).alias("audit"),
        F.coalesce("z.repaired_sha256", empty).alias("repaired_sha256"),
    )
