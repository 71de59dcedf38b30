"""Language identification of words and documents with a linear-chain conditional random field.

Each word has a label, its language. Features of a word are the word itself (lexicon) and its runs of
two to four bytes with marks at both ends, which include its prefixes and suffixes; all are hashed. A word
of more than 24 bytes (also a sentence without spaces) is several positions of the chain, which share out
all its runs of bytes; in a document's mean they weigh by their lengths.
Transitions between the languages of neighbouring words are learned from code-switched training chains,
spliced from runs of words of documents in different languages. Forward-backward gives each word's
probabilities; a document's are their mean over words with letters.

The model is trained on a bounded sample: `per_language` documents of each language, those with the
smallest hash of the id, and `train_runs` runs of RUN words from them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm import crf
from tradeloom.llm.memory import releasing
from tradeloom.llm.words import Slice, slices

RUN = 8
FEATURES = 1 << 16
_BYTES = 24
_STEP = _BYTES - 1  # runs that begin in a piece of a longer word; the last ones need three bytes more
_WHOLE, _GOES_ON, _LAST = range(3)
_EDGES = "0123456789!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”‘’„…–—¿¡§°•"
_KEPT_WORDS = 200_000
_KEPT_BYTES = 16 << 20
_SLICE_BYTES = 1 << 19  # labelling takes about 35 times the bytes of a slice
UNKNOWN = "und"


def _plain(word: bytes) -> bytes:
    """The word as features see it: lower case, without digits and punctuation at its ends; empty if it
    has no letter."""
    text = word.decode("utf-8", "ignore").lower().strip(_EDGES)
    return text.encode() if text.isalpha() or any(map(str.isalpha, text)) else b""


def pieces(word: bytes) -> list[bytes]:
    """Positions of the chain that a plain word takes: each the word's lexicon number in two bytes, which
    piece it is, and its bytes with the marks. Words without letters are one empty piece."""
    if not word:
        return [b""]
    lexicon = (xxhash.xxh64_intdigest(word) % FEATURES).to_bytes(2, "little")
    marked = b"\x01" + word + b"\x02"
    if len(marked) <= _BYTES + 2:
        return [lexicon + bytes([_WHOLE]) + marked]
    last = -(-(len(marked) - _BYTES - 2) // _STEP) * _STEP
    found = [lexicon + bytes([_GOES_ON]) + marked[k : k + _BYTES + 2] for k in range(0, last, _STEP)]
    return [*found, lexicon + bytes([_LAST]) + marked[last:]]


def piece_weights(found: list[bytes]) -> np.ndarray:
    """What each piece counts in its document: 1 for a word, by length in longer words, 0 without letters."""
    lengths = np.fromiter(map(len, found), np.int64, len(found)) - 3
    last = np.fromiter((bool(p) and p[2] == _LAST for p in found), bool, len(found))
    return np.where(lengths <= 0, 0, np.where(last, (lengths - 3) / _STEP, 1.0))


def word_features(found: list[bytes]) -> np.ndarray:
    """A row of hashed feature numbers for each piece; FEATURES fills the row up."""
    count, width = len(found), _BYTES + 2
    raw = np.array(found, f"S{width + 3}").view(np.uint8).reshape(count, width + 3)
    grid = raw[:, 3:].astype(np.uint64)
    lengths = np.maximum(np.fromiter(map(len, found), np.int64, count) - 3, 0)
    begins = np.where(raw[:, 2] == _GOES_ON, _STEP, width)
    columns = [(raw[:, 0].astype(np.uint64) | raw[:, 1].astype(np.uint64) << np.uint64(8))[:, None]]
    for n in (2, 3, 4):
        code = np.full((count, width + 1 - n), n, np.uint64)
        for k in range(n):
            code = code * np.uint64(0x100000001B3) + grid[:, k : k + code.shape[1]]
        code = ((code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)) % np.uint64(FEATURES)
        at = np.arange(code.shape[1])[None, :]
        inside = (at + n <= lengths[:, None]) & (at < begins[:, None])
        columns.append(np.where(inside, code, np.uint64(FEATURES)))
    features = np.hstack(columns).astype(np.int32)
    features[lengths == 0] = FEATURES
    return features


class _Known(dict):
    """Numbers words in the order in which they come up."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class _WordScores:
    """Scores of words' pieces, kept for words seen before."""

    def __init__(self, model: crf.Model):
        self.model = model
        self.clear()

    def clear(self):
        self.known, self.done, self.bytes = _Known(), 0, 0
        self.scores = np.empty((0, self.model.weights.shape[1]), np.float32)
        self.weights = np.empty(0)
        self.first = np.zeros(1, np.int64)  # where each word's pieces begin

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores and weights of the words' pieces, and how many pieces each word has."""
        if len(self.known) > _KEPT_WORDS or len(self.scores) > 2 * _KEPT_WORDS or self.bytes > _KEPT_BYTES:
            self.clear()
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if len(self.known) > self.done:
            unseen = list(self.known)[self.done :]
            self.bytes += sum(map(len, unseen))
            parts = [pieces(_plain(w)) for w in unseen]
            new = [p for found in parts for p in found]
            scores = [self.model.scores(word_features(new[k : k + 16384])) for k in range(0, len(new), 16384)]
            self.scores = np.vstack([self.scores, *scores])
            self.weights = np.concatenate([self.weights, piece_weights(new)])
            counts = np.fromiter(map(len, parts), np.int64, len(parts))
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts)])
            self.done = len(self.known)
        counts = self.first[numbers + 1] - self.first[numbers]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        places = np.repeat(self.first[numbers], counts) + within
        return self.scores[places], self.weights[places], counts


def training_sample(docs: DataFrame, per_language: int) -> DataFrame:
    """(lang, text) of at most `per_language` documents of each language."""
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        docs.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
        .select("doc_id", "lang")
        .withColumn("__place", F.row_number().over(first))
        .filter(F.col("__place") <= per_language)
        .select("doc_id", "lang")
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("lang", "text")


def train(sample: list[tuple[str, str]], train_runs: int, seed: int = 7) -> tuple[list[str], crf.Model]:
    """The languages and the model learned from (lang, text) pairs."""
    languages = sorted({lang for lang, _ in sample})
    draw = np.random.default_rng(seed)
    runs: list[tuple[int, list[bytes]]] = []
    for lang, text in sorted(sample):
        words = [p for w in map(_plain, text.encode().split()) if w for p in pieces(w)]
        runs += [(languages.index(lang), words[k : k + RUN]) for k in range(0, len(words), RUN)]
    if not runs:
        return [], crf.Model(np.zeros((FEATURES + 1, 1), np.float32), np.zeros((1, 1), np.float32))
    runs = [runs[k] for k in draw.permutation(len(runs))[:train_runs]]
    known = _Known()
    kinds = np.array([known[w] for _, words in runs for w in words])
    truth = np.array([lang for lang, words in runs for _ in words])
    features = word_features(list(known))
    rows = crf.chains(np.array([len(kinds)]))
    return languages, crf.fit(features, kinds, rows, truth, len(languages), FEATURES)


def _labelled(languages: list[str], model: crf.Model, batches):
    """Slices of rows, each with its texts' languages, their shares, and which texts have letters."""
    scores = _WordScores(model)
    for rows, texts in slices(batches, "text", _SLICE_BYTES):
        words = Slice(texts)
        best, share = [UNKNOWN] * len(texts), np.zeros(len(texts))
        lettered = np.zeros(len(texts), bool)
        if words.words and not languages:
            lettered[:] = [any(map(_plain, words.words[a:b])) for a, b in zip(words.starts, words.starts[1:])]
        elif words.words:
            emitted, weights, counts = scores.look_up(words.words)
            document = np.repeat(np.repeat(np.arange(len(texts)), words.lengths), counts)
            lengths = np.bincount(document, minlength=len(texts))
            found = crf.marginals(emitted, crf.chains(lengths), model.transitions)
            sums = np.stack(
                [np.bincount(document, found[:, k] * weights, len(texts)) for k in range(len(languages))], 1
            )
            total = np.bincount(document, weights, len(texts))
            lettered = total > 0
            for i in np.flatnonzero(total):
                k = int(sums[i].argmax())
                best[i], share[i] = languages[k], min(1.0, sums[i, k] / total[i])
        yield rows, best, share, lettered


def _predicted(languages: list[str], model: crf.Model):
    def run(batches):
        for rows, best, share, _ in _labelled(languages, model, batches):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(best, pa.string()), pa.array(share, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return releasing(run)


def _known_only(languages: list[str], model: crf.Model):
    def run(batches):
        for rows, best, _, lettered in _labelled(languages, model, batches):
            kept = [has and (lang != UNKNOWN or not languages) for lang, has in zip(best, lettered.tolist())]
            yield rows.filter(pa.array(kept, pa.bool_()))

    return releasing(run)


def word_languages(model: tuple[list[str], crf.Model], text: str) -> list[tuple[str, str]]:
    """(word, language) of one text, for code-switched text; words without letters are `und`."""
    languages, field = model
    words = Slice([text.encode()])
    if not words.words or not languages:
        return [(w.decode(), UNKNOWN) for w in words.words]
    emitted, weights, counts = _WordScores(field).look_up(words.words)
    found = crf.marginals(emitted, crf.chains(np.array([len(emitted)])), field.transitions)
    word = np.repeat(np.arange(len(counts)), counts)
    sums = np.stack([np.bincount(word, found[:, k] * weights) for k in range(len(languages))], 1)
    return [(w.decode(), languages[k.argmax()] if k.any() else UNKNOWN) for w, k in zip(words.words, sums)]


def learn_languages(
    docs: DataFrame, per_language: int = 200, train_runs: int = 24_000
) -> tuple[list[str], crf.Model]:
    """A model from the rows of `docs` (doc_id, text, lang) that have all three."""
    sample = training_sample(docs, per_language).collect()
    return train([(r["lang"], r["text"]) for r in sample], train_runs)


def identify(docs: DataFrame, model: tuple[list[str], crf.Model]) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, lang_pred, score (0 to 1).

    lang_pred is `und` and score 0 for NULL texts, texts without letters, and if the training rows had
    no language. A tie goes to the language that sorts first. Any doc_id, NULL too, is passed through;
    repeated rows give repeated results; other columns are not read. Whole texts are labelled, with all
    bytes of every word; chains are cut after 64 positions.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _predicted(*model), "doc_id bigint, lang_pred string, score double"
    )


def in_known_language(docs: DataFrame, model: tuple[list[str], crf.Model]) -> DataFrame:
    """The rows of `docs` to which `identify` gives a language, with all their columns; if the training
    rows had no language, the rows whose text has a letter.

    Rows are judged one by one where they are read, so that no text is shuffled; rows without doc_id and
    repeated rows are judged like others.
    """
    # Spark takes names with dots apart on the way into Arrow batches.
    plain = docs.toDF(*(c if c == "text" else f"column_{i}" for i, c in enumerate(docs.columns)))
    return plain.mapInArrow(_known_only(*model), plain.schema).toDF(*docs.columns)
