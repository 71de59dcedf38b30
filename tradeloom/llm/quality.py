"""Document quality from lines labelled good or bad by a linear-chain conditional random field.

Each line that is not blank is a position. Its features are binned measures of its characters and words
and the same measures of the lines before and after it, and whether it equals one of them. Every line of
a training document has the document's label. Forward-backward gives each line's probability of being
good; a document's score is their mean weighted by line length.

The model is trained on a bounded sample: at most `train_docs` labelled documents of at most
`train_chars` characters, those with the smallest hash of the id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm import crf
from tradeloom.llm.words import slices

_BINS = 12
_RATIO = np.array([1e-9, 0.01, 0.03, 0.06, 0.1, 0.16, 0.25, 0.4, 0.6, 0.8, 0.97])
_COUNT = np.array([1.5, 2.5, 4.5, 8.5, 16.5, 32.5, 64.5, 128.5, 256.5])
_LENGTH = np.array([2.0, 3, 4, 4.7, 5.3, 6, 7, 8, 10, 14, 20])
_OWN, _BESIDE = 11, 6
SIZE = (_OWN + 2 * _BESIDE) * _BINS


def _classes() -> np.ndarray:
    """Kind of each byte: 0 other, 1 upper, 2 lower or part of a longer character, 3 digit, 4 space,
    5 sentence mark, 6 bar, 7 exclamation mark, 8 other symbol."""
    kinds = np.full(256, 8, np.uint8)
    kinds[65:91], kinds[97:123], kinds[128:], kinds[48:58] = 1, 2, 2, 3
    kinds[:33] = 4
    for mark in b".,;:'\"?-()":
        kinds[mark] = 5
    kinds[ord("|")], kinds[ord("!")] = 6, 7
    return kinds


class Lines:
    """The lines of some texts that are not blank, with their measures."""

    def __init__(self, texts: list):
        kept: list[bytes] = []
        counts, distinct, repeated = [], [], []
        self.lengths = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            before = None
            for line in (text or b"").split(b"\n"):
                words = line.split()
                if words:
                    kept.append(line)
                    counts.append(len(words))
                    distinct.append(len(set(words)))
                    repeated.append(line == before)
                    before = line
                    self.lengths[i] += 1
        self.sizes = np.fromiter(map(len, kept), np.int64, len(kept))
        self.features = self._features(kept, np.array(counts), np.array(distinct), np.array(repeated, bool))

    def _features(self, kept, counts, distinct, repeated) -> np.ndarray:
        if not kept:
            return np.empty((0, _OWN + 2 * _BESIDE), np.int32)
        kinds = _classes()[np.frombuffer(b"".join(kept), np.uint8)]
        begins = np.cumsum(self.sizes) - self.sizes
        shown = np.maximum(self.sizes - np.add.reduceat(kinds == 4, begins, dtype=np.int64), 1)

        def share(kind):
            return np.digitize(np.add.reduceat(kinds == kind, begins, dtype=np.int64) / shown, _RATIO)

        symbols, upper, bars, calls = share(8), share(1), share(6), share(7)
        variety = np.digitize(distinct / counts, _RATIO)
        words = np.digitize(counts, _COUNT)
        length = np.digitize(shown / counts, _LENGTH)
        ends = kinds[begins + self.sizes - 1]
        last = np.zeros(len(kept), np.int64)
        last[np.cumsum(self.lengths)[self.lengths > 0] - 1] = 1
        first = np.zeros(len(kept), np.int64)
        first[(np.cumsum(self.lengths) - self.lengths)[self.lengths > 0]] = 1
        again = np.append(repeated[1:], False)
        beside = [symbols, upper, bars, calls, variety, words]
        own = [
            symbols, upper, bars, calls, variety, words, length, share(3), share(5), ends,
            repeated + 2 * again,
        ]
        for column in beside:
            own.append(np.where(first, _BINS - 1, np.minimum(np.roll(column, 1), _BINS - 2)))
        for column in beside:
            own.append(np.where(last, _BINS - 1, np.minimum(np.roll(column, -1), _BINS - 2)))
        return (np.stack(own, 1) + _BINS * np.arange(len(own))).astype(np.int32)


def training_sample(docs: DataFrame, labels: DataFrame, train_docs: int, train_chars: int) -> DataFrame:
    """(doc_id, text, quality) of at most `train_docs` labelled documents."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    texts = docs.filter(F.length("text") <= train_chars).select("doc_id", "text")
    return texts.join(F.broadcast(chosen), "doc_id")


def train(sample: list[tuple[str, int]], rounds: int = 120) -> crf.Model:
    """The model learned from (text, quality) pairs; label 1 is good."""
    lines = Lines([text.encode() for text, _ in sample])
    truth = np.repeat(np.array([int(q > 0) for _, q in sample], np.int64), lines.lengths)
    if not len(truth):
        return crf.Model(np.zeros((SIZE + 1, 2), np.float32), np.zeros((2, 2), np.float32))
    kinds = np.arange(len(truth))
    return crf.fit(lines.features, kinds, crf.chains(lines.lengths), truth, 2, SIZE, rounds, rate=0.05, decay=1e-4)


def learn_quality(
    docs: DataFrame, labels: DataFrame, train_docs: int = 3000, train_chars: int = 40_000
) -> crf.Model:
    """A model from documents (doc_id, text) with `labels` (doc_id, quality)."""
    sample = training_sample(docs, labels, train_docs, train_chars).collect()
    return train([(r["text"], r["quality"]) for r in sorted(sample, key=lambda r: (r["doc_id"], r["text"]))])


def _scored(model: crf.Model):
    def run(batches):
        for rows, texts in slices(batches, "text"):
            lines = Lines(texts)
            score = np.zeros(len(texts))
            if len(lines.sizes):
                found = crf.marginals(
                    model.scores(lines.features), crf.chains(lines.lengths), model.transitions
                )[:, 1]
                document = np.repeat(np.arange(len(texts)), lines.lengths)
                total = np.bincount(document, lines.sizes, len(texts))
                good = np.bincount(document, lines.sizes * found.astype(np.float64), len(texts))
                score = np.clip(np.divide(good, total, out=score, where=total > 0), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(score, pa.float64()),
                    pa.array(lines.lengths, pa.int64()),
                ],
                names=["doc_id", "score", "n_lines"],
            )

    return run


def score_quality(docs: DataFrame, model: crf.Model) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, score (0 to 1), n_lines (not blank).

    NULL texts and texts of white space have no line and score 0. Any doc_id, NULL too, is passed
    through; repeated rows give repeated results; other columns are not read. Without training rows the
    score of a text with lines is one half. Chains are cut after 64 lines.
    """
    return docs.select("doc_id", "text").mapInArrow(_scored(model), "doc_id bigint, score double, n_lines bigint")
