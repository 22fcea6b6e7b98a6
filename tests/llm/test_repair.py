"""Conversation repair against a plain dynamic program, and the algebra behind it."""

import itertools
import random

import pytest

from tests.llm import brute
from tidemark.llm import repair
from tidemark.llm.catalog import QUERIES, read

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, symbols string"


def report(conversations):
    found = repair.report(conversations, repair.repair(repair.damaged(conversations))).select(*COLUMNS).collect()
    return {r[0]: tuple(r)[1:] for r in found}


def made(seed, n=150):
    rng, rows = random.Random(seed), []
    for conv in [*range(n), None]:
        for i in range(rng.choice([1, 2, 3, 5, 8, 20, 60])):
            turn = rng.choice([None, *range(12)]) if rng.random() < 0.3 else i
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "assistant", "user"])
            texts = ["Hi.", "ok", "", " \n", "a? ", "b ", "same.", None, "x\u2028", "…", "¿no!\t"]
            rows.append((conv, turn, role, rng.choice(texts + [f"t{rng.random()}."] * 9), "x"))
    return rows + rows[:40]


def test_query_against_a_plain_program(spark, medium):
    rows = [tuple(r) for r in read(spark, medium, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op12_repair"](spark, medium).select(*COLUMNS).collect()}
    assert found == brute.repair_report(rows)


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_odd_rows_in_runs_of_any_length(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "RUN_BITS", bits)
    rows = made(bits)
    assert report(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute.repair_report([r[:4] for r in rows])


def test_empty_table_and_conversation_without_rows(spark):
    assert report(spark.createDataFrame([], SCHEMA)) == {}
    rows = [(7, turn, "user", "Hi.", "x") for turn in range(400) if not brute.damaged([(7, turn, "user", "Hi.")])][:3]
    found = report(spark.createDataFrame(rows, SCHEMA))
    assert found == brute.repair_report([r[:4] for r in rows]) and found[7][5:7] == (0, "")


def test_one_conversation_of_copies(spark):
    """A hot conversation: thousands of rows, most of them equal, some in one turn."""
    rows = [(1, i // 3, "user", "Same.", "x") for i in range(3000)] + [(1, i, "assistant", f"No {i}", "x") for i in range(1000)]
    assert report(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute.repair_report([r[:4] for r in rows])


def straight(symbols):
    """Least cost and edits over all sequences of edits, by trying them all."""
    best = None
    ways = [[e for e in "DKR" if s != repair.GONE or e == "D"] for s in symbols]
    for edits in itertools.product(*ways):
        for inserts in itertools.product(range(3), repeat=len(symbols) + 1):
            if sum(inserts) > 3:
                continue
            state, cost, audit = 0, 0, ""
            try:
                for symbol, edit, n in zip([*symbols, None], [*edits, None], inserts):
                    for _ in range(n):
                        state, cost, audit = repair.NEXT[state, repair.WANTED[state]], cost + 5, audit + "I"
                    if edit in ("K", "R"):
                        initial = symbol.lower() if edit == "K" else repair.WANTED[state]
                        state, cost = repair.NEXT[state, initial], cost + repair.COST[edit] + 5 * symbol.isupper()
                    elif edit == "D":
                        cost += 2
                    audit += edit or ""
            except KeyError:
                continue
            if state in (0, 3) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


@pytest.mark.parametrize("seed", range(12))
def test_matrices_against_all_edits(seed):
    rng = random.Random(seed)
    symbols = "".join(rng.choice("suaxSUAXdua") for _ in range(rng.randint(1, 4)))
    grammar = repair.Grammar()
    whole = repair.product(grammar.matrix(symbols), repair.INSERTS)
    cost, audit = min((e[0], repair.flat(e[1])) for e in (whole[0], whole[3]) if e)
    assert (cost, audit) == straight(symbols)


def test_grouping_and_rules_change_nothing(spark):
    """However a sequence is cut into runs and packed into rules, cost and audit are those of one pass."""
    rng = random.Random(2)
    texts = ["".join(rng.choice("uauauauasxd") for _ in range(rng.randint(1, 80))) for _ in range(80)]
    runs = spark.createDataFrame([(t, rng.randint(1, 5)) for t in texts], "symbols string, n long")
    grammar = repair.learn(runs)
    assert grammar.rules
    packed = {r.symbols: r for r in repair.matrices(runs.distinct(), grammar).collect()}
    assert min(len(p) for p in packed) >= 1
    for text in texts:
        plain = repair.Grammar().matrix(text)
        assert packed[text].costs == [-1 if e is None else e[0] for e in plain]
        assert packed[text].audits == ["" if e is None else repair.flat(e[1]) for e in plain]
        path, at, number = repair.Path(), 0, 0
        while at < len(text):
            step = rng.randint(1, 9)
            part = repair.Grammar().matrix(text[at : at + step])
            path.feed(number, [-1 if e is None else e[0] for e in part], ["" if e is None else repair.flat(e[1]) for e in part])
            at, number = at + step, number + 1
        cost, pieces = path.finish()
        whole = repair.product(plain, repair.INSERTS)
        assert (cost, "".join(p[2] for p in pieces)) == min((e[0], repair.flat(e[1])) for e in (whole[0], whole[3]) if e)


def test_repaired_turns_alternate(spark, medium):
    conversations = read(spark, medium, "conversations")
    turns = repair.repair(repair.damaged(conversations)).turns.orderBy("conv_id", "pos", "sub").collect()
    import re

    initials = {}
    for t in turns:
        initials[t.conv_id] = initials.get(t.conv_id, "") + t.role[:1]
        assert t.edit in "KRI" and (t.text == "") == (t.edit == "I")
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in initials.values())
