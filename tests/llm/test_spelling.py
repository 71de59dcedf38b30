import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from llm_data import documents
from tradeloom.llm import spelling


def brute(rows, least_letters=6, least=5, ratio=5, one_in=None):
    counts = Counter()
    lower = {a: a + 32 for a in range(ord("A"), ord("Z") + 1)}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if one_in and h % one_in == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_letters and n >= least}
    near, changed = defaultdict(set), defaultdict(list)
    for w in words:
        for k in range(len(w)):
            changed[w[:k], w[k + 1 :]].append(w)
            v = w[:k] + w[k + 1 :]
            if v in words:
                near[w].add(v)
                near[v].add(w)
    for group in changed.values():
        for w in group:
            near[w].update(v for v in group if v != w)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, n, len(near[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items()), key=repr)


def variants(df, **settings):
    columns = ("word", "n", "n_near", "form", "form_n", "root")
    return sorted((tuple(r[c] for c in columns) for r in spelling.spelling_variants(df, **settings).collect()), key=repr)


def corpus(draw):
    """Words and what edits make of them, over letters so few that edits often meet."""
    letters = "aabÀÿ×é"
    bases = ["".join(draw.choices(letters, k=draw.randint(5, 12))) for _ in range(60)]
    words = list(bases)
    for _ in range(3):
        for w in draw.sample(words, len(words) // 2):
            k = draw.randrange(len(w))
            words.append(draw.choice([w[:k] + w[k + 1 :], w[:k] + draw.choice(letters) + w[k:], w[:k] + "b" + w[k + 1 :]]))
    rows = []
    for doc_id in range(200):
        some = draw.choices(words, weights=[1 / (1 + k) for k in range(len(words))], k=60)
        rows.append((doc_id, draw.choice([" ", "1", "Ā", "\n"]).join(w.upper() if draw.random() < 0.1 else w for w in some)))
    return rows + [(7, rows[7][1]), (None, rows[3][1]), (900, None), (901, ""), (902, "12 3")]


@pytest.mark.parametrize("seed, one_in", [(1, None), (2, 7), (3, 199)])
def test_equals_brute_force(spark, seed, one_in):
    rows = corpus(random.Random(seed))
    assert variants(documents(spark, rows), misspelt_one_in=one_in) == brute(rows, one_in=one_in)


@pytest.mark.parametrize("least_letters", [2, 3])
def test_short_words(spark, least_letters):
    draw = random.Random(4)
    rows = [(k, " ".join("".join(draw.choices("abc", k=draw.randint(1, 4))) for _ in range(50))) for k in range(9)]
    settings = {"least_letters": least_letters, "least": 2, "ratio": 2}
    assert variants(documents(spark, rows), **settings) == brute(rows, **settings)


def test_words_about_the_length_of_the_longest_in_tries(spark):
    draw, at = random.Random(5), spelling.LONGEST
    words = []
    for size in (at - 1, at, at + 1, at + 2, 3 * at):
        base = "".join(draw.choices("ab", k=size))
        for k in (0, size // 2, size - 1):
            words += [base, base[:k] + base[k + 1 :], base[:k] + "c" + base[k + 1 :], base[:k] + "c" + base[k:]]
    rows = [(k, " ".join(words[: 3 + 9 * k])) for k in range(12)]
    got = variants(documents(spark, rows), least=1, ratio=2)
    assert got == brute(rows, least=1, ratio=2) and max(n for _, _, n, *_ in got) > 1


def test_chains_of_forms_end_at_the_root(spark):
    word, text = "abcdefgh", []
    for k in range(7):
        text += [word[:k] + "x" * k + word[k:]] * 2**k
    rows = [(1, " ".join(text))]
    got = variants(documents(spark, rows), least=1, ratio=2)
    assert got == brute(rows, least=1, ratio=2)


def test_very_long_texts_and_words(spark, monkeypatch):
    rows = [(1, "q" * 1_000_000 + " colour"), (2, "colour " * 200_000), (3, "color  " * 900), (4, "\n" * 1_000_000)]
    assert variants(documents(spark, rows)) == brute(rows)
    monkeypatch.setattr(spelling, "_AT_ONCE", 10)
    monkeypatch.setattr(spelling, "_KEPT_WORDS", 1)
    assert variants(documents(spark, rows)) == brute(rows)


def test_long_words_meet_by_what_is_left_of_them(spark):
    long = "ab" * 50_000
    rows = [(1, f"{long} {long} {long[:-1]}"), (2, long[:777] + "z" + long[778:])]
    assert variants(documents(spark, rows), least=1, ratio=2) == [
        (long[:-1], 1, 1, long, 2, long), (long, 2, 2, None, None, long), (long[:777] + "z" + long[778:], 1, 1, long, 2, long),
    ]


def test_empty_table(spark):
    assert variants(documents(spark, [])) == [] and variants(documents(spark, [(1, None)])) == []


def test_whole_table_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert variants(docs, misspelt_one_in=199) == brute(rows, one_in=199)
