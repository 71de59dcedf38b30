"""WARC, chat, decontamination, packing, URL filter, vectors and the pipeline on small inputs."""

import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tradeloom.llm import chat, decontam, neardup, packing, urls, warc
from tradeloom.llm.queries import QUERIES, URL_RULES, tokenizer
from tradeloom.llm.scratch import new_path
from tradeloom.llm.sql import STATEMENTS
from conftest import SAMPLE_TABLES
from llm_data import documents, tuples


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_query_equals_sql(name, spark, folder):
    duck = duckdb.connect()
    for table in SAMPLE_TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    found = QUERIES[name](spark, folder)
    answer = duck.execute(STATEMENTS[name])
    columns = [c[0] for c in answer.description]
    assert set(columns) == set(found.columns)
    assert tuples(found.select(*columns)) == sorted(answer.fetchall(), key=repr)


# --- WARC ---------------------------------------------------------------------------------------------


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("row", urls.F.lit("x"))


def test_warc_round_trip(spark):
    rows = [
        (1, "http://a/", "<p>é</p>\r\n\r\nWARC/1.1\r\n"), (2, None, None), (3, "http://b/\r\nX: 1", ""), (5, "u", "same"),
        (4, "v", "same"), (4, "v", "same"), (None, "w", "same"), (6, "x", "long " * 50_000),
    ]
    folder = new_path(spark, "warc-test")
    index = warc.write(_pages(spark, rows), folder)
    got = tuples(warc.read(index, folder).select("page_id", "record_type", "refers_to", "payload_bytes", "payload"))
    payload = lambda t: bytearray((t or "").encode())
    expected = []
    for page_id, _, html in rows:
        refers = {3: 2, 5: 4}.get(page_id)
        body = None if refers else payload(html)
        expected.append((page_id, "revisit" if refers else "response", refers, len(payload(html)), body))
    assert got == sorted(expected, key=repr)
    some = warc.read(index.filter("page_id = 6"), folder)
    assert some.select("page_id", "payload_bytes").collect() == [(6, 250_000)]
    assert warc.round_trip(_pages(spark, rows).limit(0)).collect() == []


def test_ranges_are_joined():
    assert warc._ranges([(0, 10), (10, 5), (30, 5), (100, 5)], gap=20, most=50) == [(0, 35), (100, 5)]


# --- chat ---------------------------------------------------------------------------------------------


def test_chat_keeps_maximal_conversations(spark):
    logs = {
        1: ["a", "b"], 2: ["a", "b", "c"], 3: ["a", "b", "c"], 4: ["a", "x"], 5: ["b"], None: ["q"],
        6: [str(k) for k in range(700)], 7: [str(k) for k in range(600)], 8: ["b", "a"],
    }
    rows = [(c, k, "user" if k % 2 else None, t) for c, turns in logs.items() for k, t in enumerate(turns)]
    rows += [(2, 0, None, "a"), (9, None, "user", None)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns = turns.withColumns({"place": urls.F.lit(1), "chunk": urls.F.lit(1), "part": urls.F.lit(1)})
    found = chat.format_conversations(turns, part_turns=512)
    assert sorted(((r[0], r[1], r[2]) for r in found.collect()), key=repr) == sorted(
        [(2, 0, 3), (4, 0, 2), (None, 0, 1), (6, 0, 700), (6, 1, 700), (8, 0, 2), (9, 0, 1), (5, 0, 1)][:-1], key=repr
    )
    text = {(r["conv_id"], r["part"]): r["text"] for r in found.collect()}
    assert text[4, 0] == "<|im_start|>unknown\na<|im_end|>\n<|im_start|>user\nx<|im_end|>\n"
    assert text[6, 1].startswith("<|im_start|>unknown\n512<|im_end|>")
    assert chat.format_conversations(turns.limit(0)).collect() == []


# --- decontamination ------------------------------------------------------------------------------------


def _contaminated(spark, docs, items, **more):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    return decontam.contaminated(documents(spark, docs), benchmark, **more)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_leaks_and_reparameterised_questions(spark, limit):
    item = "A train leaves the station and travels 120 km in 3 hours toward Berlin, how fast did the train go on average?"
    other = item.replace("120 km", "250 miles").replace(" 3 ", " 5 ").replace("Berlin", "Madrid")
    twice = "Give 5 apples to the first child and 5 apples to the second child of this long row."
    docs = [
        (1, f"Some words before. {item} And after."), (2, f"Intro. {other}"), (3, "nothing of that kind at all " * 5),
        (4, " ".join(w + "***" for w in item.upper().split())), (5, twice.replace("5", "7")),
        (6, twice.replace("first child and 5", "first child and 9")), (7, None), (None, item), (8, ""),
    ]
    items = [(10, item), (11, twice), (12, None), (13, "two words"), (None, item), (14, item), (10, item)]
    found = _contaminated(spark, docs, items, broadcast_windows=limit)
    got = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in found.collect()}
    assert {k for k in got if k[0] != 4} == {(1, 10), (1, 14), (2, 10), (2, 14), (5, 11)}
    assert not got[1, 10] and got[2, 10] and got[5, 11]
    assert _contaminated(spark, [], items).collect() == [] and _contaminated(spark, docs, []).collect() == []


def test_verbatim_copies_without_literal_words(spark):
    items = [
        (1, "2 4 6 8 10 12 14 16 18 20"), (2, "17 + 25 = 42, 8 x 9 = 72, 100 / 4 = 25"),
        (3, "Anna Bert Carl Dora Emil Frida Georg Hanna Ida Jakob"),
    ]
    docs = [(i, f"We print: {text} and go on.") for i, text in items]
    docs += [(4, "Other: 3 5 7 9 11 13 15 17 19 21 end."), (5, "anna bert carl dora emil frida georg hanna ida jakob")]
    for limit in (1_000_000, 0):
        found = _contaminated(spark, docs, items, broadcast_windows=limit)
        assert {(r[0], r[1], r[2], r[3]) for r in found.collect()} == {
            (1, 1, 1.0, False), (2, 2, 1.0, False), (3, 3, 1.0, False), (5, 3, 1.0, False),
        }


def test_leaks_in_other_case_place_and_form(spark):
    item = "Tom has 3 apples. Mia buys 2. Tom gives Mia 1. How many apples does Mia have?"
    short, noun = "Bring the red box to Paris", "Der Hund frisst jeden Tag 3 Kilo Fleisch und trinkt Wasser"
    run = "They drove 120 km from York to Bath and then rested for a while near the old bridge"
    items = [(1, item), (2, short), (3, noun), (4, run)]
    docs = [
        (1, item.replace("Tom", "Ann").replace("Mia", "Bob").replace("3", "7").replace("2", "5")),
        (2, "He said: please, Bring the red box to Paris now"), (3, "and so he asked to bring the red box to paris"),
        (4, noun.upper().replace("3", "5")), (5, noun.lower().replace("3", "5")), (6, item.upper()),
        (7, run.replace("120 km", "90km").replace("York", "New York").replace("Bath", "Santa Fe")),
        (8, run.replace("and then", "and only much later then")),
    ]
    found = _contaminated(spark, docs, items)
    got = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in found.collect()}
    assert got == {
        (1, 1): True, (2, 2): False, (3, 2): False, (4, 3): True, (5, 3): True, (6, 1): False, (7, 4): True, (8, 4): False,
    }


def test_leaks_equal_plain_search(spark, folder):
    found = tuples(QUERIES["op6_decontamination"](spark, folder).select("doc_id", "item_id"))
    read = lambda t: [tuple(r) for r in spark.read.parquet(f"{folder}/{t}.parquet").select(*c[t]).collect()]
    c = {"documents": ("doc_id", "text"), "benchmark": ("item_id", "text")}
    texts = [(i, " ".join((t or "").lower().split())) for i, t in read("documents")]
    plain = [(d, i) for i, item in read("benchmark") for d, t in texts if " ".join(item.lower().split()[2:-2]) in t]
    assert set(plain) <= set(found) and len(found) <= len(plain) + 1


# --- packing ----------------------------------------------------------------------------------------------


def test_packing_is_a_partition_of_all_ids(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    docs = docs.unionAll(documents(spark, [(900, None), (901, ""), (None, "x <|endoftext|> y"), (902, "a"), (902, "a")], False))
    pieces = packing.pack(docs, tokenizer(), size=256).collect()
    from tokenizers import Tokenizer

    reader = Tokenizer.from_file(tokenizer()["path"])
    expected = defaultdict(list)
    for doc_id, text in docs.collect():
        ids = [*reader.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 256):
            part = np.array(ids[k : k + 256], "<u4")
            expected[doc_id].append((k, len(part), zlib.crc32(part.tobytes()), len(ids)))
    found, bins = defaultdict(list), defaultdict(list)
    for p in pieces:
        found[p["doc_id"]].append((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]))
        bins[p["sequence_id"]].append((p["offset"], p["length"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256


def test_first_fit_equals_plain_search():
    draw = random.Random(2)
    lengths = sorted((draw.randint(1, 100) for _ in range(500)), reverse=True)
    room, expected = [], []
    for length in lengths:
        k = next((k for k, r in enumerate(room) if r >= length), len(room))
        if k == len(room):
            room.append(100)
        expected.append((k, 100 - room[k]))
        room[k] -= length
    assert list(zip(*packing.first_fit(lengths, 100))) == expected
    assert packing.first_fit([], 100) == ([], [])


def test_packing_of_very_long_runs(spark):
    from tokenizers import Tokenizer

    reader = Tokenizer.from_file(tokenizer()["path"])
    runs = ["\n" * 1_000_000, " " * 1_000_000, "a\t" + "\r\n" * 500_000 + "b", "x" * 300_000, "=" * 1_000_000, " \n" * 9_999]
    ids = {i: [*reader.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(runs)}
    pieces = packing.pack(documents(spark, list(enumerate(runs))), tokenizer()).collect()
    for p in pieces:
        part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(ids[p["doc_id"]])
    assert sum(p["length"] for p in pieces) == sum(map(len, ids.values()))


def test_packing_wastes_little(spark, folder):
    pieces = packing.pack(spark.read.parquet(f"{folder}/documents.parquet"), tokenizer(), group_pieces=10**6)
    used, bins = pieces.agg({"length": "sum", "sequence_id": "approx_count_distinct"}).first()
    bins = pieces.select("sequence_id").distinct().count()
    assert pieces.agg({"length": "sum"}).first()[0] / (bins * 2048) > 0.8
    assert packing.pack(documents(spark, []), tokenizer()).collect() == []


# --- URL filter ---------------------------------------------------------------------------------------------


def test_redirects_and_canonical_links_carry_blocks(spark):
    link = '<link href="{}" rel="canonical">'
    rows = [
        (1, "http://a.net/x", '<meta http-equiv="refresh" content="0; url=https://shop.com/de/1">'),
        (2, "http://b.net/y#top", '<LINK rel=canonical href="http://a.net/x">'),
        (3, "http://c.net/", link.format("/z?q=1&amp;r=2")), (4, "http://c.net/z?q=1&r=2", link.format("//b.net/y")),
        (5, "http://Sub.ORG/y", link.format("http://b.net/y")), (6, "http://d.net/", "plain"), (7, None, None),
        (8, "no scheme", link.format("http://b.net/y")), (9, "https://example.org/en/12?x", None), (6, "http://d.net/", "plain"),
        (None, "http://x.example.org/es", link.format("mailto:a@b")), (10, "ftp://", ""),
    ]
    pages = _pages(spark, rows).withColumns({"place": urls.F.lit(1), "rule": urls.F.lit(2)})
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages, URL_RULES).collect()}
    assert got == {
        (1, "a.net", "/x", None, "block"), (2, "b.net", "/y", None, "block"), (3, "c.net", "/", None, "block"),
        (4, "c.net", "/z", None, "block"), (5, "sub.org", "/y", "org/", "allow"), (6, "d.net", "/", None, "allow"),
        (7, "", "", None, "allow"), (8, "", "", None, "allow"), (9, "example.org", "/en/12", "example.org/en/1", "block"),
        (None, "x.example.org", "/es", "org/", "allow"), (10, "", "", None, "allow"),
    }
    assert urls.judge(pages.limit(0), URL_RULES).collect() == []


def test_links_of_every_form_are_resolved(spark):
    link, meta = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="{}">'
    page = "http://h.net/a/b/c.html?q=1"
    forms = [
        (link.format("index.html"), "h.net/a/b/index.html"), (link.format("../de/1"), "h.net/a/de/1"),
        (link.format("?page=2"), "h.net/a/b/c.html?page=2"), (link.format("./x/../../y/."), "h.net/a/y/"),
        ('<base href="/root/">' + link.format("z"), "h.net/root/z"), (link.format("../../../../up"), "h.net/up"),
        (meta.format("0; url=/x;sid=1"), "h.net/x;sid=1"), (meta.format("0;URL=/x?a=1&amp;b=2"), "h.net/x?a=1&b=2"),
        (meta.format("0; url='/x&#x2F;y&#38;z'"), "h.net/x/y&z"), (meta.format("3, http://k.net/r?u=http://o.net/"), "k.net/r?u=http://o.net/"),
        (link.format("/r?u=http://o.net/"), "h.net/r?u=http://o.net/"), ("<meta content='0; url=&quot;/q&quot;' http-equiv=Refresh>", "h.net/q"),
        (link.format("mailto:a@b"), None), (link.format("#top"), None), ('<link rel="alternate" href="/canonical">', None),
        ('<META HTTP-EQUIV=refresh CONTENT=0;url=/plain>', "h.net/plain"), (link.format("a&#36;b"), "h.net/a/b/a$b"),
    ]
    rows = [(k, page.replace("h.net", f"h{k}.net"), html) for k, (html, _) in enumerate(forms)]
    both = link.format("/one") + link.format("two") + meta.format("0; url=/three") + meta.format("5; url=/four")
    rows.append((99, "http://m.net/", both))
    got = {(r["here"], r["there"]) for r in urls.aliases(_pages(spark, rows)).collect()}
    expected = {
        (f"h{k}.net/a/b/c.html?q=1", there.replace("h.net", f"h{k}.net")) for k, (_, there) in enumerate(forms) if there
    }
    assert got == expected | {("m.net/", f"m.net/{x}") for x in ("one", "two", "three", "four")}
    leads = [(1, "http://shop.com/a/b", '<meta http-equiv="refresh" content="0; url=../de/1">'), (2, "http://a.net/", link.format("b"))]
    verdicts = {r["page_id"]: r["verdict"] for r in urls.judge(_pages(spark, leads), URL_RULES).collect()}
    assert verdicts == {1: "block", 2: "allow"}


# --- vectors --------------------------------------------------------------------------------------------------


def _brute_vectors(rows, threshold):
    def usable(i, v):
        return i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = defaultdict(set)
    for p, (i, v) in enumerate(rows):
        for q, (j, w) in enumerate(rows):
            if p != q and usable(i, v) and usable(j, w) and len(v) == len(w):
                a, b = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold - 1e-12:
                    links[p].add(q)
    out = []
    for p, (i, _) in enumerate(rows):
        reach, todo = {p}, [p]
        while todo:
            for q in links[todo.pop()] - reach:
                reach.add(q)
                todo.append(q)
        least = min((rows[q][0] for q in reach if rows[q][0] is not None), default=None)
        out.append((i, len(links[p]), least, i is not None and i == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_equal_brute_force(spark, kind, monkeypatch):
    draw = np.random.default_rng(3)
    rows = []
    for _ in range(12):
        base = draw.normal(size=16)
        for _ in range(draw.integers(1, 9)):
            rows.append((len(rows) + 10, (base + 0.2 * draw.normal(size=16)).astype(np.float32).tolist()))
    rows += [(1, rows[4][1]), (2, rows[4][1]), (2, rows[4][1]), (3, [2 * x for x in rows[4][1]]), (None, rows[4][1])]
    rows += [(4, None), (5, []), (6, [0.0] * 16), (7, [float("nan")] * 16), (8, [None] * 16), (9, [1.0, 2.0]), (300, [2.0, 4.0])]
    rows += [(301, [1e30] * 16), (302, [-0.0, 1.0]), (303, [0.0, 1.0])]
    table = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").withColumn("rep", urls.F.lit(1))
    expected = _brute_vectors(rows, 0.9)
    assert tuples(neardup.near_duplicate_vectors(table, 0.9, recall=0.999999)) == expected
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 3)
    assert tuples(neardup.near_duplicate_vectors(table, 0.9, recall=0.999999)) == expected
    assert neardup.near_duplicate_vectors(table.limit(0)).collect() == []


def test_tables_reach_the_recall():
    for rows in (10, 10**4, 10**9):
        bits, tables = neardup.plan_tables(rows, 0.9, 0.99)
        assert 1 - (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** tables >= 0.99


# --- pipeline -------------------------------------------------------------------------------------------------


def test_pipeline_stages_hand_on_documents(spark, folder):
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    junk = [(900, None), (901, "1 2 3"), (None, "and the of that"), (0, "and the of that")]
    docs = docs.unionByName(documents(spark, junk, False), allowMissingColumns=True)
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append({r[0] for r in docs.select("doc_id").collect()})
    assert not {900, 901} & seen[0] and seen[0] >= seen[1] >= seen[2] >= seen[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r[0] for r in packed.select("doc_id").collect()} == seen[3]
