"""The learned operators: exactness of forward-backward, held-out accuracy, defined edges."""

import itertools
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import crf, langid, quality
from tradeloom.llm.queries import QUERIES
from llm_data import documents, tuples


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(1)
    scores, moves = draw.normal(size=(9, 3)), draw.normal(size=(3, 3))
    rows = crf.chains(np.array([5, 0, 4]), steps=4)
    found, pairs, _ = crf.marginals(scores, rows, moves, pairs=True)
    expected, expected_pairs = np.zeros((9, 3)), np.zeros((3, 3))
    for chain in rows:
        places = chain[chain >= 0]
        weights = {}
        for labels in itertools.product(range(3), repeat=len(places)):
            score = sum(scores[p, k] for p, k in zip(places, labels))
            weights[labels] = np.exp(score + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
        total = sum(weights.values())
        for labels, weight in weights.items():
            for p, k in zip(places, labels):
                expected[p, k] += weight / total
            for a, b in zip(labels, labels[1:]):
                expected_pairs[a, b] += weight / total
    assert np.allclose(found, expected) and np.allclose(pairs, expected_pairs)


def test_chains_cut_long_sequences():
    rows = crf.chains(np.array([3, 0, 5]), steps=4)
    assert rows.tolist() == [[0, 1, 2, -1], [3, 4, 5, 6], [7, -1, -1, -1]]


def test_language_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op4_language_id"](spark, folder).filter("held_out")
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    assert found.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def test_code_switched_words(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.learn_languages(docs, per_language=40)
    words = langid.word_languages(model, "the and of that der die und nicht 123 ***")
    assert [k for _, k in words] == ["en"] * 4 + ["de"] * 4 + ["und"] * 2


def test_language_edges(spark):
    docs = spark.createDataFrame(
        [(1, "uno dos", "es"), (2, "one two", "en"), (3, None, "en"), (4, "12 - !", "es"), (None, "one", None), (2, "one two", "en")],
        "doc_id bigint, text string, lang string",
    )
    model = langid.learn_languages(docs)
    got = {(r["doc_id"], r["lang_pred"], r["score"] > 0) for r in langid.identify(docs, model).collect()}
    assert {(1, "es", True), (2, "en", True), (3, "und", False), (4, "und", False), (None, "en", True)} == got
    untrained = langid.learn_languages(docs.filter("doc_id > 99"))
    assert {r["lang_pred"] for r in langid.identify(docs, untrained).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).collect() == []


def test_stage_without_languages_keeps_texts_with_letters(spark):
    rows = [(1, "uno dos", None), (2, None, None), (3, "12 - !", None), (None, "x", None), (4, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = langid.in_known_language(docs, langid.learn_languages(docs))
    assert tuples(kept.select("doc_id")) == [(1,), (None,)]


def test_every_byte_of_long_words_counts(spark):
    # Words of 100 bytes that differ behind their first 24 bytes only, and sentences without spaces.
    draw = np.random.default_rng(5)
    word = lambda letters: "x" * 30 + "".join(draw.choice(list(letters), 70))
    rows = [(k, word("abcd" if k % 2 else "wyzv"), "aa" if k % 2 else "zz") for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.learn_languages(docs.filter("doc_id < 40"))
    got = langid.identify(docs.filter("doc_id >= 40"), model).join(docs, "doc_id")
    assert got.filter("lang_pred = lang").count() == 40
    assert [k for _, k in langid.word_languages(model, f"{word('abcd')} {word('wyzv')} 1")] == ["aa", "zz", "und"]
    # Each run of bytes is in one piece, and a word's pieces weigh by its length.
    for length in (1, 24, 25, 26, 47, 48, 49, 300):
        found = langid.pieces(bytes(draw.integers(97, 123, length).astype(np.uint8)))
        features = langid.word_features(found)[:, 1:]
        assert (features < langid.FEATURES).sum() == sum(max(0, length + 3 - n) for n in (2, 3, 4))
        assert langid.piece_weights(found).sum() == (1 if length <= 24 else pytest.approx((length - 1) / 23))


def test_labelling_takes_memory_for_a_slice_not_for_a_batch():
    draw = np.random.default_rng(3)
    words = ["".join(draw.choice(list("abcdefgh"), 5)) for _ in range(500)]
    texts = [None if k % 50 == 7 else " ".join(draw.choice(words, 500)) for k in range(1300)]
    languages, model = langid.train([("aa", texts[0]), ("bb", "wyz vwx"), ("cc", "klm mno"), ("dd", "pqr stu")], 200)
    batch = pa.RecordBatch.from_pydict({"doc_id": range(1300), "text": texts})
    assert batch.nbytes > 3.5e6
    for run, rows in ((langid._known_only(languages, model), 1274), (langid._predicted(languages, model), 1300)):
        tracemalloc.start()
        found = sum(map(len, run(iter([batch]))))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found == rows and peak < 12 * batch.nbytes


def test_remembered_words_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(langid, "_KEPT_BYTES", 1000)
    languages, model = langid.train([("aa", "uno dos"), ("bb", "one two")], 10)
    scores = langid._WordScores(model)
    fresh = lambda words: langid._WordScores(model).look_up(words)
    for k in range(20):
        words = [b"-" * 400 + b"%d" % k, b"uno%d" % k, b"uno", b"7" * k]
        for got, expected in zip(scores.look_up(words), fresh(words)):
            assert np.array_equal(got, expected)
        assert sum(map(len, scores.known)) < 2000


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op1_quality_classifier"](spark, folder).filter("held_out")
    truth = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    assert found.join(truth, "doc_id").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.96


def test_quality_edges(spark):
    docs = documents(spark, [(1, "good words here."), (2, None), (3, " \n\t"), (None, "A"), (2, "### ***"), (4, "x " * 90_000)])
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (1, 1)], "doc_id bigint, quality int")
    model = quality.learn_quality(docs, labels)
    scored = tuples(quality.score_quality(docs, model).select("doc_id", "score"))
    assert len(scored) == 6 and all(0 <= s <= 1 for _, s in scored)
    assert (2, 0.0) in scored and (3, 0.0) in scored
    untrained = quality.learn_quality(docs, labels.limit(0))
    assert dict(tuples(quality.score_quality(docs, untrained).select("doc_id", "score")))[1] == 0.5
