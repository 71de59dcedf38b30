import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_data import documents
from tradeloom.llm import katz

BEGIN, END = "<begin>", "<end>"


class Brute:
    """The model of the module's docstring, word by word, in dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = [Counter() for _ in range(order + 1)]  # by length, of tuples
        for text in texts:
            words = [*[BEGIN] * (order - 1), *tokens(text)]
            for p in range(order - 1, len(words)):
                for k in range(1, order + 1):
                    self.counts[k][tuple(words[p - k + 1 : p + 1])] += 1
        self.after = defaultdict(dict)
        for k in range(1, order + 1):
            for gram, n in self.counts[k].items():
                self.after[gram[:-1]][gram[-1]] = n
        self.exponents = [
            katz.discount_exponent({r: n for r, n in Counter(c.values()).items() if r <= katz.FITTED}) for c in self.counts[1:]
        ]
        self.vocabulary = {w for (w,) in self.counts[1]}
        self.totals = {history: sum(seen.values()) for history, seen in self.after.items()}
        self.weights = {}

    def discounted(self, gram):
        n = self.counts[len(gram)][gram]
        return (1 + 1 / n) ** (self.exponents[len(gram) - 1] + 1) * n / self.totals[gram[:-1]]

    def weight(self, history):
        if history not in self.weights:
            self.weights[history] = self.computed_weight(history)
        return self.weights[history]

    def computed_weight(self, history):
        seen = self.after[history]
        left = 1 - sum(self.discounted((*history, w)) for w in seen)
        return left / (1 - sum(self.probability(history[1:], w) for w in seen) if history else 1)

    def probability(self, history, word):
        if self.after.get(history):
            if word in self.after[history]:
                return self.discounted((*history, word))
            return self.weight(history) * (self.probability(history[1:], word) if history else 1)
        return self.probability(history[1:], word) if history else 1

    def score(self, text):
        words = [*[BEGIN] * (self.order - 1), *tokens(text)]
        places = range(self.order - 1, len(words))
        return sum(math.log10(self.probability(tuple(words[p - self.order + 1 : p]), words[p])) for p in places)

    def base(self, text):
        n, v = sum(self.counts[1].values()), len(self.vocabulary)
        return sum(math.log10((self.counts[1][w,] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(text))


def tokens(text):
    return [*(w.decode() for w in (text or "").encode().lower().split()), END]


def trains(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 != 0


def training():
    return F.crc32(F.col("doc_id").cast("string")) % 3 != 0


def check(got, rows, order):
    model = Brute([t for i, t in rows if trains(i)], order)
    n = sum(model.counts[1].values())
    key = lambda r: (r[0] is None, r[0], *r[1:5], round(r[5], 6), round(r[6], 6))
    expected = [
        (i, not trains(i), len(tokens(t)), sum(w in model.vocabulary for w in tokens(t)), n, model.base(t), model.score(t))
        for i, t in rows
    ]
    got, expected = sorted(map(tuple, got), key=key), sorted(expected, key=key)
    assert len(got) == len(expected)
    for mine, theirs in zip(got, expected):
        assert mine[:5] == theirs[:5]
        assert mine[5:] == pytest.approx(theirs[5:], rel=1e-9, abs=1e-9)
    return model


def corpus(draw, size=60):
    words = ["a", "the", "The", "É", "x,", *(f"w{k}" for k in range(40))]
    weights = [1 / (1 + k) for k in range(len(words))]
    rows = [(i, draw.choice([" ", "\n"]).join(draw.choices(words, weights, k=draw.randint(0, 40)))) for i in range(size)]
    return rows + [(7, rows[7][1]), (None, rows[3][1]), (900, None), (901, ""), (902, " \n "), (903, "never seen words")]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_equals_brute_force(spark, order):
    rows = corpus(random.Random(order))
    got = katz.score_texts(documents(spark, rows), training(), order).collect()
    model = check(got, rows, order)
    # Probabilities of all words and of one unknown word add up to one after any history.
    everything = [*model.vocabulary, "unknown"]
    histories = [h for h in model.after if len(h) == order - 1][:40] + [("w1", "nowhere", "w2")[: order - 1]]
    for history in histories:
        assert sum(model.probability(history, w) for w in everything) == pytest.approx(1, abs=1e-9)


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    draw = random.Random(9)
    rows = corpus(draw, 12) + [(500 + k, " ".join(draw.choices(["p", "q", "r" * 70, "s"], k=200))) for k in range(6)]
    monkeypatch.setattr(katz, "PIECE_BYTES", 64)
    check(katz.score_texts(documents(spark, rows), training(), 3).collect(), rows, 3)


def test_pieces_keep_every_byte():
    for text in (b"", b"a", b"ab cd  ef\n" * 30, b"x" * 500 + b" y", b" " * 300):
        pieces = list(katz._pieces(text, 40))
        assert b"".join(pieces) == text and b" ".join(pieces).split() == text.split()


def test_very_long_texts(spark):
    rows = [(1, "q" * 1_000_000), (2, "a b " * 400_000), (3, "\n" * 1_000_000), (6, "b a"), (5, "a b a c")]
    got = {r["doc_id"]: r for r in katz.score_texts(documents(spark, rows), training()).collect()}
    assert {i: r["n_tokens"] for i, r in got.items()} == {1: 2, 2: 800_001, 3: 1, 5: 5, 6: 3}
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got.values())


def test_nothing_to_train_with(spark):
    rows = [(1, "a b"), (None, None)]
    got = katz.score_texts(documents(spark, rows), F.lit(None).cast("boolean")).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got) == [
        (1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0),
    ]
    assert katz.score_texts(documents(spark, []), training()).collect() == []


def test_counts_in_many_slices_add_up(spark):
    draw = random.Random(11)
    rows = [(i, " ".join(draw.choices("abcd", k=9))) for i in range(300)] + [(1000 + i, "a b c d") for i in range(100)]
    check(katz.score_texts(documents(spark, rows).repartition(23), training()).collect(), rows, 2)


def test_discounts_leave_something_at_every_count():
    assert katz.discount_exponent({}) == katz.discount_exponent({3: 7}) == -2
    assert -4 <= katz.discount_exponent({1: 1000, 2: 300, 3: 120, 4: 60}) < -1.1
    assert katz.discount_exponent({1: 1, 2: 50, 3: 400}) == -1.1


def test_whole_table_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = katz.score_texts(docs, training()).collect()
    check(got, rows, 2)
    held = [r for r in got if r["held_out"] and r["n_tokens"] > 20]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
