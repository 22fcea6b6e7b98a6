"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for operators and stages."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chat, decontaminate, graph, licenses, linededup, mixing, pii, quality, setjoin, toxicity, warc
from tidemark.llm.store import new_folder, written

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, measures string, root long, a long, rate double"
LONG = " ".join(f"w{i % 9973}x{i}" for i in range(60_000))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, "m", 7, 8, 0.5) for i, t, s in rows], SCHEMA)


@pytest.fixture
def odd(spark):
    body = " ".join(f"word{i}" for i in range(40))
    rows = [(1, None, "a"), (2, "", None), (None, body, "a"), (3, body, "a"), (3, body, "a"), (4, body + " end", "b"),
            (5, LONG, "b"), (6, "\x00 tab\tand\nline\nline\nline\nline", "b"), (None, None, None), (7, "  \n ", "a")]
    return documents(spark, rows)


@pytest.fixture
def none(spark):
    return documents(spark, [])


def tables(spark, folder):
    """A folder with the tables the stages read."""
    spark.createDataFrame([(0, " ".join(f"bench{i}" for i in range(30))), (1, None), (2, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(3, 1, 0), (4, 0, 1), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_on_odd_and_no_rows(spark, odd, none, folder):
    sf_dir = tables(spark, folder)
    for docs in (odd, none):
        n = docs.count()
        for _name, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, docs, sf_dir), "stage")
            assert out.count() <= n
            if stage is not corpus_pipeline.STAGES[-1][1]:
                assert out.columns == docs.columns


def test_operators_on_odd_and_no_rows(spark, odd, none, folder):
    sf_dir = tables(spark, folder)
    labels, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    for docs in (odd, none):
        n = docs.count()
        assert pii.pseudonymise(docs, b"k", *docs.columns).count() == n
        assert setjoin.with_components(setjoin.join_sets(docs)).count() == n
        assert licenses.scan(docs).count() == n
        assert linededup.cut_lines(docs).count() == n
        assert toxicity.score(docs, labels).count() == n
        assert toxicity.score(docs, labels.limit(0)).count() == n
        assert mixing.mix(docs, labels).count() == n
        assert mixing.mix(docs, labels.limit(0)).where("rate <> 1").count() == 0
        assert decontaminate.find(docs, benchmark).count() == 0
        assert decontaminate.find(docs, benchmark.limit(0)).count() == 0
        assert quality.keep_good(docs).count() <= n


def test_components_of_odd_rows(spark, odd):
    found = {(r.doc_id, r.n_shingles): r.component_id for r in setjoin.with_components(setjoin.join_sets(odd)).collect()}
    assert found[(None, 36)] == found[(3, 36)] == found[(4, 37)] == 3
    assert found[(1, 0)] == 1 and found[(2, 0)] == 2 and found[(None, 0)] is None
    kept = setjoin.keep_firsts(odd).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id in (3, 4)) == [3] and len(kept) == 7


def brute_components(texts):
    sets = []
    for text in texts:
        w = text.split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("short", [2, 8])
def test_components_of_edited_copies(spark, short):
    """Chains of edits, a common passage and exact copies, with lists cut short so that both ways of joining run."""
    rng = random.Random(short)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for family in range(12):
        base = [f"f{family}w{i}" for i in range(rng.randint(3, 90))] + passage * (family % 2)
        for _ in range(rng.randint(1, 14)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = f"e{rng.random()}"
            texts.append(" ".join(own))
            if rng.random() < 0.4:
                base = own
    texts += texts[:5] + ["", "one two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    joined = setjoin.join_sets(docs, settings=setjoin.Settings(short=short, near=1, per_part=300))
    found = {r.doc_id: r.component_id for r in setjoin.with_components(joined).collect()}
    assert [found[i] for i in range(len(texts))] == brute_components(texts)


def test_graph_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(50)] + [(rng.randint(100, 400), rng.randint(100, 400)) for _ in range(150)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {x: find(x) for u, v in edges if u != v for x in (u, v)}


def test_lines_of_repeated_rows_and_overlaps(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\nb\nc\nd\ny"), (3, "a\nb\n\nc"), (4, "q\nq\nq\nq\nq"), (5, "a\nb"), (1, "a\nb\nc\nd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r[linededup.CUTS].text) for r in linededup.cut_lines(docs).collect())
    assert found == [(1, "a\nb\nc\nd"), (1, "a\nb\nc\nd"), (2, "x\ny"), (3, ""), (4, "q"), (5, "a\nb")]


def test_pseudonyms_are_a_permutation():
    p = pii.Pseudonyms(b"key")
    days = {p.date(f"2024-02-{d:02d}") for d in range(1, 30)}
    assert len(days) == 29 and all(p.date(p.date(f"2024-02-{d:02d}"), back=True) == f"2024-02-{d:02d}" for d in range(1, 30))
    small = pii.Permutation(b"key", "x", 1000)
    assert sorted(small.walk(x, pii.any_number) for x in range(1000)) == list(range(1000))
    assert p.date("2024-02-30") is None and p.ipv4("1.2.3.400") is None and p.card("4316522678525457") is None
    card = p.card("4316522678525456")
    assert p.card("4316 5226 7852 5456").replace(" ", "") == card and p.card(card, back=True) == "4316522678525456"
    assert pii.Pseudonyms(b"other").card("4316522678525456") != card


def test_pseudonyms_link_across_documents(spark):
    docs = spark.createDataFrame([(1, "call +1 (830) 555-5433 or a.b@c.example.com"), (2, "x a.b@c.example.com, 10.1.2.3")], "doc_id long, text string")
    one, two = (r[1] for r in pii.pseudonymise(docs, b"k", "doc_id").orderBy("doc_id").collect())
    assert [s.kind for s in one.spans] == ["phone", "email"] and [s.kind for s in two.spans] == ["email", "ipv4"]
    values = lambda f: {s.kind: f.text[s.start : s.start + s.length] for s in f.spans}
    assert values(one)["email"] == values(two)["email"] != "a.b@c.example.com"


CHAT = "conv_id long, turn long, role string, text string, segment long"


def test_chat_round_trip(spark):
    import hashlib

    rng = random.Random(5)
    pieces = ["\\", "###", "### ", "</turn>", "\n", "\\e", "\\b", "é", "ok", ":", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "a:b", None, "\\c"]), rng.choice([None, "".join(rng.choices(pieces, k=6))]), 0)
            for c in range(12) for t in range(rng.randint(1, 200))]
    rows += [(None, 0, "user", "no id", 0), (None, None, "assistant", "no turn", 0)]
    turns = spark.createDataFrame(rows, CHAT).repartition(3)
    found = {r.conv_id: r for r in chat.read_back(chat.format_chats(turns, segment_turns=7)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1]))
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert found[conv].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (found[conv].loss_chars, found[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_chats(turns.limit(0))).count() == 0


def archive(spark, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    folder = new_folder(spark, "warc")
    files = written(warc.write_archives(warc.plan_records(pages, **options), folder, roll_bytes=20_000), "files")
    return folder, files, warc.read_archives(spark, files, folder)


def test_archives_round_trip(spark):
    rows = [(i, f"http://x/{i % 7} ü\r\n%", None if i % 5 == 0 else f"<p>{'é' * (i % 11) * 300}</p>", "d") for i in range(300)]
    rows += [(None, None, "", "d"), (None, None, "only", "d"), (1007, "twice", "same", "d"), (1007, "twice", "same", "d")]
    _, files, found = archive(spark, rows, dedup_bytes=0)
    found = [r.asDict() for r in found.collect()]
    assert files.count() > 1 and len(found) == len(rows)
    largest = {}
    for i, _, html, _ in rows:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if i is None else i)
    by_id = {i: (u, h or "") for i, u, h, _ in rows}
    for r in found:
        if r["page_id"] is not None:
            url, html = by_id[r["page_id"]]
            assert (r["url"], r["payload_bytes"], r["payload_digest"]) == (url, len(html.encode()), warc.sha1_base32(html.encode()))
            same = largest[html] == r["page_id"]
            assert (r["record_type"], r["refers_to"]) == (("response", None) if same else ("revisit", largest[html]))
    _, _, all_whole = archive(spark, rows, dedup_bytes=10**9)
    assert all_whole.where("record_type <> 'response'").count() == 0
    assert archive(spark, [], dedup_bytes=0)[2].count() == 0


def test_a_damaged_archive_raises(spark):
    folder, files, _ = archive(spark, [(1, "u", "payload " * 99, "d")], dedup_bytes=0)
    store, _ = warc.filesystem(folder)
    path = files.first().path
    with store.open_input_stream(path, compression=None) as stream:
        data = stream.read()
    with store.open_output_stream(path, compression=None) as out:
        out.write(data[:-20])
    with pytest.raises(ValueError, match="cut off"):
        list(warc.read_archive(store, path))
    changed = warc.member(warc.record(1, "u", b"payload", None).replace(b"payload", b"paydirt"), 6)
    with store.open_output_stream(path, compression=None) as out:
        out.write(changed)
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_archive(store, path))


def test_host_verdicts_are_shrunk_and_joined(spark):
    good = " ".join(f"plain{i}" for i in range(30))
    rows = [(i, good + str(i), "good") for i in range(60)] + [(100 + i, "short", "bad") for i in range(40)]
    rows += [(200, good, "bad"), (300, "short", "tiny"), (301, good, "tiny")]
    docs = documents(spark, rows)
    limits = quality.Limits()
    measured = quality.measures(docs, "doc_id", "source")
    verdicts = {r.host: r for r in quality.host_verdicts(measured, "source", limits).collect()}
    assert verdicts["bad"].host_rejected and not verdicts["good"].host_rejected and not verdicts["tiny"].host_rejected
    assert verdicts["bad"].shrunk_rate < 40 / 41
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == {*range(60), 301}


def test_planted_copies_and_items_go_and_clean_documents_stay(spark, folder):
    sf_dir = tables(spark, folder)
    item = " ".join(f"bench{i}" for i in range(30))
    clean = [(i, " ".join(f"c{i}w{k}" for k in range(80)), "s") for i in range(20)]
    near = clean[3][1].replace("c3w40", "edited")
    leaks = [(50, clean[4][1] + " L " + item, "s"), (51, item.replace("bench28", "changed"), "s")]
    docs = documents(spark, clean + [(40, clean[3][1], "s"), (41, near, "s")])
    kept = {r.doc_id for r in corpus_pipeline.keep_one_of_each(spark, docs, sf_dir).collect()}
    assert kept == set(range(20))
    docs = documents(spark, clean + leaks)
    kept = {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, sf_dir).select("doc_id").collect()}
    assert kept == set(range(20))
    assert docs.where(F.col("doc_id") == 50).count() == 1


def test_chat_of_huge_and_many_turns(spark):
    """A turn of 30 MB beside small ones: slices are cut between turns and segments read back the same."""
    import hashlib

    rows = [(1, i, ["user", "assistant"][i % 2], f"### t{i} \\ </turn>" * (1 + i % 3)) for i in range(300)]
    rows += [(2, 0, "user", "x"), (2, 1, "assistant", "ab# \\" * 6_000_000), (2, 2, "user", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.read_back(written(chat.format_chats(turns), "chats")).collect()}
    for conv in (1, 2):
        own = [(r[2], r[3] or "") for r in rows if r[0] == conv]
        every = "".join(f"{role}\n{text}\n" for role, text in own)
        loss = "".join(text for role, text in own if role == "assistant")
        assert found[conv].turns_sha256 == hashlib.sha256(every.encode()).hexdigest()
        assert (found[conv].loss_chars, found[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
