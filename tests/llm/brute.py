"""Plain Python versions of operators, written from their contracts and without the library's code."""

import hashlib
import math
import re
import zlib
from collections import Counter

AUTOMATON = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
ROLE = {"u": "user", "a": "assistant"}


def damaged(rows):
    """(conv_id, turn, role, text) rows after damage, in the order of their conversation."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        damage = zlib.crc32(key.encode()) % 20
        if damage == 0:
            continue
        text = "" if damage == 1 else re.sub("[.!?]", "", text) if damage == 2 else text
        role = "user" if damage == 4 else role
        out += [(conv, turn, role, text)] * (2 if damage == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2],
                                      hashlib.sha256(r[3].encode()).hexdigest()))


def repaired(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit and hash of one conversation's (turn, role, text) rows."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

    def grown(states):
        """States with the inserts that may follow."""
        todo = list(states)
        while todo:
            at = todo.pop()
            cost, audit, lines = states[at]
            for initial, to in AUTOMATON[at].items():
                way = (cost + 5, audit + "I", [*lines, f"{ROLE[initial]}:"]) if initial != "s" else None
                if way and (to not in states or way[:2] < states[to][:2]):
                    states[to] = way
                    todo.append(to)
        return states

    states = grown({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        after = {}

        def offer(to, way):
            if to not in after or way[:2] < after[to][:2]:
                after[to] = way

        for at, (cost, audit, lines) in states.items():
            offer(at, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if role[:1] in AUTOMATON[at]:
                offer(AUTOMATON[at][role[:1]], (cost + more, audit + "K", [*lines, f"{role}:{text}"]))
            for initial in "ua":
                if initial in AUTOMATON[at]:
                    offer(AUTOMATON[at][initial], (cost + 1 + more, audit + "R", [*lines, f"{ROLE[initial]}:{text}"]))
        states = grown(after)
    cost, audit, lines = min(states[at] for at in ("", "a") if at in states)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest


def repair_report(rows):
    """By conv_id, what ``op12`` returns."""
    after = {}
    for conv, turn, role, text in damaged(rows):
        after.setdefault(conv, []).append((turn, role, text))
    return {conv: repaired(after.get(conv, [])) for conv in {row[0] for row in rows}}


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, top):
    """(item_id, rank, doc_id, score) rows of (doc_id, text) and (item_id, text) rows."""
    counted = [(doc, Counter(terms(text))) for doc, text in docs]
    counted = [(doc, c) for doc, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        weights = {t: math.floor(1000 * math.log((2.0 * n_docs + 2) / (2 * df[t] + 1))) for t in own if df[t]}
        scores = []
        for doc, c in counted:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t, w in weights.items() if c[t])
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out)


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    """Spans of the base kinds in order: (start, kind's place, end)."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)
