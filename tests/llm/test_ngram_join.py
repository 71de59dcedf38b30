import itertools
import random

import numpy as np
import pytest

from tradeloom.llm import ngram_join
from tradeloom.llm.components import connected_components
from llm_data import documents, tuples


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    least = {i: i for i, _ in rows if i is not None}
    links = []
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
            links.append((i, j))
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(least[i], least[j])
            if least[i] != low or least[j] != low:
                least[i] = least[j] = low
                changed = True
    return sorted(((i, len(s), least.get(i)) for i, s in sets), key=repr)


def corpus(draw):
    vocabulary = [f"W{k}" for k in range(300)]
    licence = draw.choices(vocabulary, k=25)
    rows = []
    for group in range(8):
        base = draw.choices(vocabulary, k=draw.randint(3, 80)) + (licence if group % 2 else [])
        for _ in range(draw.randint(1, 9)):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            rows.append((len(rows), " ".join(copy).lower() if draw.random() < 0.3 else "  ".join(copy)))
    rows += [(900, None), (901, ""), (902, rows[0][1]), (None, rows[0][1]), (3, rows[3][1]), (903, "a b"), (904, "A b")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = corpus(random.Random(seed))
    assert tuples(ngram_join.near_duplicate_groups(documents(spark, rows))) == brute(rows)


def test_one_id_with_two_texts_ties_their_groups(spark):
    a, b = "a b c d e f g h", "z y x w v u t s"
    rows = [(1, a), (2, b), (9, a), (9, b), (3, "q")]
    assert tuples(ngram_join.near_duplicate_groups(documents(spark, rows))) == [
        (1, 4, 1), (2, 4, 1), (3, 1, 3), (9, 4, 1), (9, 4, 1),
    ]


@pytest.mark.parametrize("pivots", [1, 16])
def test_large_cluster_is_split_into_blocks(spark, monkeypatch, pivots):
    rows = corpus(random.Random(4))
    # A chain of texts, each like the next only, and a second group that shares many shingles with it.
    words = [f"c{k}" for k in range(160)]
    rows += [(2000 + k, " ".join(words[3 * k : 3 * k + 60])) for k in range(30)]
    rows += [(3000 + k, " ".join(words[:30] + [f"x{n}" for n in range(20 + k)])) for k in range(12)]
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 100)
    monkeypatch.setattr(ngram_join, "PIVOTS", pivots)
    assert tuples(ngram_join.near_duplicate_groups(documents(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert ngram_join.near_duplicate_groups(documents(spark, [])).collect() == []


def test_window_hashes_tell_windows_apart():
    from tradeloom.llm.words import window_hashes

    values = np.arange(40, dtype=np.uint64) % np.uint64(13)
    for width in (1, 2, 3, 5, 8, 13, 20):
        hashes = window_hashes(values, width)
        assert len(hashes) == 41 - width
        for i, j in itertools.combinations(range(len(hashes)), 2):
            same = (values[i : i + width] == values[j : j + width]).all()
            assert (hashes[i] == hashes[j]) == same


def test_components(spark):
    chain = [(k, k + 1) for k in range(60)]
    star = [(1000, k) for k in range(1001, 1100)]
    loose = [(5000, 5000), (None, 5), (6000, 6001), (6001, 6000)]
    edges = spark.createDataFrame(chain + star + loose, "a bigint, b bigint")
    found = dict(tuples(connected_components(edges)))
    assert found == {
        **{k: 0 for k in range(61)}, **{k: 1000 for k in range(1000, 1100)}, 6000: 6000, 6001: 6000,
    }
