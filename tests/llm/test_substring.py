import hashlib
import random

import pytest

from tradeloom.llm import substring
from llm_data import documents, passages, tuples


def brute(rows, width):
    first = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        if doc_id is not None:
            for k in range(len(words) - width + 1):
                key = tuple(words[k : k + width])
                first[key] = min(doc_id, first.get(key, doc_id))
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - width + 1):
            if doc_id is not None and first[tuple(words[k : k + width])] < doc_id:
                gone.update(range(k, k + width))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [1, 2, 7, 12, 50])
def test_equals_brute_force(spark, width):
    rows = passages(random.Random(width), width)
    found = substring.cut_repeated_windows(documents(spark, rows), width)
    assert tuples(found) == brute(rows, width)


def test_covers_hold_every_difference():
    for period, cover in substring.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_defined_edges(spark):
    rows = [(1, None), (2, ""), (None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (4, "x a b c d"), (5, " a b")]
    assert tuples(substring.cut_repeated_windows(documents(spark, rows), 3)) == brute(rows, 3)
    empty = documents(spark, [])
    assert substring.cut_repeated_windows(empty, 3).collect() == []


def test_rewriting_keeps_all_columns(spark):
    rows = [(1, "a  b\nc d"), (2, "z a b c d y"), (3, None), (None, "a b c d"), (4, "a b c d")]
    docs = documents(spark, rows)
    docs = docs.withColumn("extra value", docs.doc_id * 2)
    found = substring.without_repeated_windows(docs, 4)
    assert found.columns == [c for c in docs.columns] + ["n_removed"]
    got = {(r["doc_id"], r["text"], r["extra value"], r["n_removed"]) for r in found.collect()}
    assert got == {
        (1, "a  b\nc d", 2, 0), (2, "z y", 4, 4), (3, None, 6, 0), (None, "a b c d", None, 0), (4, "", 8, 4),
    }
