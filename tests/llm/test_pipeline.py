"""Each stage of the pipeline against brute force on the rows that the stage before kept."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
import test_ngram_join
import test_substring
from tradeloom.llm.queries import tokenizer
from tradeloom.llm.scratch import new_path


def _bag(rows):
    """Rows by id, text and one more column, which tells rows of equal id and text apart."""
    return Counter((r["doc_id"], r["text"], r["source"]) for r in rows)


def _planted(docs, items):
    """Rows to add: copies, near copies, shared passages, leaked items, rows without text, letter or id, and
    rows that share an id: with a copy, with a leak, and a hot one with texts of its own each."""
    draw = random.Random(5)
    texts = [r["text"] for r in docs if len((r["text"] or "").split()) > 80][:6]
    vocabulary = "stone river lamp cloud paper engine winter bread signal garden".split()
    passage = " ".join(draw.choices(vocabulary, k=60))
    near = texts[0].split()
    near[40] = "changed"
    own = [" ".join(f"own{k}word{n}" for n in range(90)) for k in range(2)]
    letters = lambda k: " ".join("".join(draw.choices("abcdefghij", k=7)) for _ in range(k))
    rows = [(9001, texts[0]), (9002, " ".join(near)), (9003, f"{own[0]} {passage} one"), (9004, f"two {passage} {own[1]}")]
    rows += [(9005, passage), (9006, f"Intro words. {items[0]} And a tail."), (9007, None), (9008, "12 34"), (9009, "")]
    rows += [(None, texts[3] + " and some words of its own"), (9001, letters(30)), (9001, None), (9006, letters(40))]
    rows += [(None, f"No id here. {items[1]} And a tail."), (None, letters(50)), (None, letters(20))]
    copied = letters(60)
    rows += [(None, copied), (9010, copied), (9010, copied), (9011, copied)]
    return rows + [(9012, letters(12)) for _ in range(40)]


def _with_more(docs):
    """Columns that documents may carry along: a name with a dot, a map, names that stages use inside."""
    return docs.withColumns(
        {"a.b": F.col("doc_id") % 7, "tags": F.create_map(F.lit("k"), "source"), "rest": F.lit("x"), "group": F.lit(1)}
    )


def test_stages_equal_brute_force(spark, folder):
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    items = [r["text"] for r in read("benchmark").orderBy("item_id").collect()]
    table = read("documents")
    rows = _planted(table.orderBy("doc_id").collect(), items)
    more = spark.createDataFrame([(i, t, f"planted{k}") for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, source string")
    docs = _with_more(table.withColumn("source", F.concat("source", F.lit(" "), "doc_id")).unionByName(more, allowMissingColumns=True))
    columns, types = docs.columns, docs.schema.simpleString()
    path = new_path(spark, "raw")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)

    before, after = [docs.collect()], []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns and docs.schema.simpleString() == types
        after.append(docs.collect())
        before.append(after[-1])
    keys = [[(r["doc_id"], r["text"], r["source"]) for r in rows] for rows in before]

    lettered = [r for r in before[0] if re.search(r"[^\W\d_]", r["text"] or "")]
    assert _bag(after[0]) == _bag(lettered)

    # The row that stays is the first by id, rows without id last; of equal ids and texts any will do.
    numbered = sorted(keys[1], key=lambda r: (r[0] is None, r[0] or 0))
    groups = {k: component for k, _, component in test_ngram_join.brute([(k, t) for k, (_, t, _) in enumerate(numbered)])}
    expected = Counter(numbered[k][:2] for k, component in groups.items() if k == component)
    assert Counter((r["doc_id"], r["text"]) for r in after[1]) == expected
    ids = Counter(r["doc_id"] for r in after[1])
    assert ids[9002] == ids[9011] == 0 and ids[9001] == ids[9010] == 1 and ids[9006] == 2 and ids[9012] == 40
    assert ids[None] == 3

    cut = Counter()
    of_id = defaultdict(list)
    for i, t, s in keys[2]:
        of_id[i].append(t)
    for i, _, gone, _, kept in test_substring.brute([k[:2] for k in keys[2]], 50):
        if gone and kept:
            cut[i, kept] += 1
    same = Counter((r["doc_id"], r["text"]) for r in after[2]) & Counter((i, t) for i, t, _ in keys[2])
    assert Counter((r["doc_id"], r["text"]) for r in after[2]) - same == cut - same
    assert 9005 not in {r["doc_id"] for r in after[2]}

    plain = [" ".join(item.lower().split()[2:-2]) for item in items]
    leaks = Counter(k for k in keys[3] if any(p in " ".join(k[1].lower().split()) for p in plain))
    gone = Counter(keys[3]) - _bag(after[3])
    assert leaks <= gone and sum((gone - leaks).values()) <= 1
    assert sum(i is None for i, _, _ in gone) == 1 and sum(i == 9006 for i, _, _ in gone) == 1
    assert 9006 in {r["doc_id"] for r in after[3]}

    from tokenizers import Tokenizer

    reader = Tokenizer.from_file(tokenizer()["path"])
    ids = defaultdict(list)
    for i, t, _ in keys[4]:
        ids[i].append([*reader.encode(t, add_special_tokens=False).ids, 1])
    sequences, covered = defaultdict(list), Counter()
    for p in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect():
        parts = [x[p["start"] : p["start"] + p["length"]] for x in ids[p["doc_id"]] if len(x) == p["doc_tokens"]]
        assert p["ids_crc32"] in {zlib.crc32(np.array(x, "<u4").tobytes()) for x in parts}
        covered[p["doc_id"]] += p["length"]
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    assert covered == Counter({i: sum(map(len, x)) for i, x in ids.items()})
    for places in sequences.values():
        ends = [a + n for a, n in sorted(places)]
        assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_no_documents(spark, folder, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
