"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force in tests/llm."""

WORDS = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 75 * (x.n + y.n - k)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
)
SELECT r.a AS doc_id, coalesce(max(n), 0) AS n_shingles, min(r.b) AS component_id
FROM reached r LEFT JOIN sizes ON sizes.doc_id = r.a GROUP BY r.a
"""

OP3 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) t(i)
), escaped AS (
  SELECT *, replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\e') AS coded,
    replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\e'), ':', '\c') AS coded_role FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum(length('### ') + length(coded_role) + length(': ') + length(coded) + length('</turn>') + 1)::BIGINT AS formatted_chars,
  sum((role = 'assistant')::INT)::BIGINT AS loss_spans
FROM escaped GROUP BY conv_id
"""

OP5 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), r AS (SELECT h, max(page_id) AS largest FROM p GROUP BY h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + ((
    ('0x' || substr(h, (1 + 5 * (i // 4))::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31))::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM p JOIN r USING (h)
"""

OP7 = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS pos, string_split(text, chr(10))[i] AS line,
    trim(string_split(text, chr(10))[i], ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS bare
  FROM documents, range(1, len(string_split(text, chr(10))) + 1) t(i)
), runs AS (
  SELECT doc_id, pos AS first, bare AS a, lead(bare, 1) OVER o AS b, lead(bare, 2) OVER o AS c, lead(pos, 2) OVER o AS last
  FROM lines WHERE bare <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, first) AS k FROM runs WHERE last IS NOT NULL
), gone AS (
  SELECT DISTINCT l.doc_id, l.pos FROM lines l JOIN ranked r ON r.doc_id = l.doc_id AND l.pos BETWEEN r.first AND r.last AND k > 1
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(l.line, chr(10) ORDER BY l.pos)
    FILTER (g.pos IS NULL), '') END AS text,
  count(l.pos) AS n_lines, count(g.pos) AS n_removed
FROM documents d LEFT JOIN lines l USING (doc_id) LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos
GROUP BY d.doc_id, d.text
"""

OP8 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w,
    string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), runs AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM d, range(1, len(w) - 3) t(i)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM runs) WHERE n > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(5) o(k) GROUP BY 1
), dups AS (
  SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines FROM (
    SELECT doc_id, s, count(*) AS n FROM (SELECT doc_id, unnest(l) AS s FROM d) WHERE regexp_matches(s, '{WORDS}') GROUP BY 1, 2
  ) GROUP BY 1
), m AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN dups USING (doc_id)
), j AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 50 * n_words AS failed FROM m
), h AS (SELECT source, count(*) AS n, sum(failed::INT) AS f FROM j GROUP BY 1),
s AS (SELECT sum(n) AS docs, sum(f) / sum(n) AS m, sum(f * f / n) AS squares, count(*) AS hosts FROM h),
v AS (SELECT m, least(1e6, greatest(1.0,
  m * (1 - m) / greatest((squares - docs * m * m) / docs - m * (1 - m) * hosts / docs, 1e-12) - 1)) AS weight FROM s),
r AS (SELECT source, (f + m * weight) / (n + weight) > 0.5 AS host_rejected FROM h, v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT failed AND NOT host_rejected AS kept, host_rejected
FROM j JOIN r ON r.source IS NOT DISTINCT FROM j.source
"""

OP11 = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), d AS (SELECT r, doc_id, w, len(w)::BIGINT AS n FROM t WHERE len(w) > 0),
s AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM d),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL
), p AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY ALL
), f AS (
  SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term), s
), scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll))))::BIGINT AS score
  FROM i JOIN f USING (term) JOIN p USING (term), s GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored
  WHERE score > 0 AND doc_id IS NOT NULL
) WHERE rank <= 50
"""


def _least(*ways: str) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1]"


def _way(state: str, cost: str, edit: str, line: str, when: str = "true") -> str:
    more = f" || chr(10) || {line}" if line else ""
    return (
        f"CASE WHEN {state} IS NOT NULL AND {when} THEN "
        f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 't': {state}.t{more}}} END"
    )


def _insert(state: str, role: str) -> str:
    return _way(state, "5", "I", f"'{role}:'")


def _keep(state: str, initial: str) -> str:
    return _way(state, "more", "K", "role || ':' || text", f"NOT gone AND initial = '{initial}'")


def _rerole(state: str, role: str) -> str:
    return _way(state, "1 + more", "R", f"'{role}:' || text", "NOT gone")


def _inserted(edits: str) -> str:
    """States s0 (nothing yet), s1 (after s), s2 (after u), s3 (after a) with the inserts that may follow."""
    u = f"SELECT *, {_least('e2', _insert('e0', 'user'), _insert('e1', 'user'))} AS u FROM ({edits})"
    a = f"SELECT *, {_least('e3', _insert('u', 'assistant'))} AS a FROM ({u})"
    return f"SELECT conv_id, pos, e0 AS s0, e1 AS s1, {_least('u', _insert('a', 'user'))} AS s2, a AS s3 FROM ({a})"


_NOTHING = "{'c': 0::BIGINT, 'a': '', 't': ''}"
_FIRST = f"SELECT conv_id, 0::BIGINT AS pos, {_NOTHING} AS e0, if(false, {_NOTHING}, NULL) AS e1, if(false, {_NOTHING}, NULL) AS e2, if(false, {_NOTHING}, NULL) AS e3 FROM ids"
_NEXT = f"""SELECT f.conv_id, f.pos, {_way('s0', '2', 'D', '')} AS e0,
    {_least(_way('s1', '2', 'D', ''), _keep('s0', 's'))} AS e1,
    {_least(_way('s2', '2', 'D', ''), *[x for s in ('s0', 's1', 's3') for x in (_keep(s, 'u'), _rerole(s, 'user'))])} AS e2,
    {_least(_way('s3', '2', 'D', ''), _keep('s2', 'a'), _rerole('s2', 'assistant'))} AS e3
  FROM step JOIN f ON f.conv_id IS NOT DISTINCT FROM step.conv_id AND f.pos = step.pos + 1"""

OP12 = rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), crc AS (
  SELECT *, xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(string_split(key, ''), lambda x: ord(x)::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]),
      lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END))) % 20 AS damage FROM src
), r AS (
  SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM crc, range(2) c(copy) WHERE damage <> 0 AND (copy = 0 OR damage = 3)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
    substr(role, 1, 1) AS initial, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM r
), d AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again FROM o),
f AS (
  SELECT *, bare = '' OR again AS gone, bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS cut_off,
    CASE WHEN right(bare, 1) IN ('.', '!', '?') THEN 0 ELSE 5 END AS more,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM d
), ids AS (SELECT DISTINCT conv_id FROM conversations),
step AS ({_inserted(_FIRST)} UNION ALL {_inserted(_NEXT)}),
ends AS (
  SELECT conv_id, {_least('s0', 's3')} AS best FROM step
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (bare = '') AS blank, count(*) FILTER (bare <> '' AND again) AS duplicate,
    count(*) FILTER (cut_off) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit,
  sha256(substr(best.t, 2)) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""

# The kinds of op13 in order, as patterns of DuckDB; one pass each, as a pattern that is a column is slow.
_KINDS = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", "AKIA[A-Z0-9]+"),
    ("hex", "[0-9a-f]+"),
    ("github", "gh[oprsu]_[A-Za-z0-9]{36}"),
    ("google", "AIza[A-Za-z0-9_-]{35}"),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("stripe", "[rs]k_live_[A-Za-z0-9]{16,}"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,1000}\.eyJ[A-Za-z0-9_-]{8,1000}\.[A-Za-z0-9_-]{8,}"),
    ("pem", "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    ("login", r"""://[^\x00-\x20/@:"']{1,64}:[^\x00-\x20/@:"']{3,128}@"""),
]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_FOUND = " UNION ALL ".join(
    f"SELECT r, {place} AS place, '{kind}' AS kind, regexp_extract_all(text, {_quoted(pattern)}) AS found, "
    f"string_split_regex(text, {_quoted(pattern)}) AS gaps FROM d"
    for place, (kind, pattern) in enumerate(_KINDS)
)

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({_FOUND}
), e AS (
  SELECT r, place, kind, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS f, unnest(gaps[:len(found)]) AS gap FROM m
), u AS (
  SELECT r, place, kind, f, sum(length(gap) + length(f)) OVER (PARTITION BY r, place ORDER BY i) AS stop FROM e
), s AS (
  SELECT r, place, kind, (stop - length(f))::BIGINT AS start, kind || ':' || (stop - length(f))::BIGINT || ':' || stop::BIGINT AS span
  FROM u WHERE CASE place WHEN 0 THEN length(regexp_extract(f, {_quoted(_KINDS[0][1])}, 2)) >= 8 WHEN 1 THEN length(f) >= 16
    WHEN 2 THEN length(f) >= 32 ELSE true END
), g AS (
  SELECT r, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
    count(*) FILTER (place = 2) AS n_hex, string_agg(span, ',' ORDER BY start, place) FILTER (place < 3) AS base,
    string_agg(span, ',' ORDER BY start, place) AS spans FROM s GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""

ORACLES: dict[str, str] = {
    "op2_jaccard": OP2,
    "op3_chat": OP3,
    "op5_warc": OP5,
    "op7_line_dedup": OP7,
    "op8_quality": OP8,
    "op11_search": OP11,
    "op12_repair": OP12,
    "op13_secrets": OP13,
}
