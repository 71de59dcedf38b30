"""Katz backoff language model: Good-Turing discounted n-gram counts, exactly normalised backoff weights.

The probability of a word after a history of up to `order` - 1 words is

    P(w | h) = d(c(h w)) c(h w) / c(h)     where h w occurs in the training texts,
    P(w | h) = a(h) P(w | h')              otherwise, h' being h without its first word; a(h) = 1 if h is new.

Below the single words lies one class that stands for every unknown word. d(r) is the Good-Turing ratio
(r + 1) N(r + 1) / (r N(r)), the counts of counts N smoothed by a straight line between their logarithms
(Gale and Sampson), which leaves each history something to back off with. a(h) shares out what is left:

    a(h) = sum of (1 - d) c(h w) / c(h)  /  (1 - sum of P(w | h')), both over the words seen after h.

The work is the product of two tables, texts by n-grams, in blocks (see `blocks`):

1. each slice of texts sends the n-grams it has, with its counts, to ranges of hashes; a range sums them
   up and answers every slice; counts of counts and totals come from the same table of answers;
2. the texts are read again, and with the counts of its n-grams at hand a slice evaluates its words from the longest n-gram downwards. It
   puts out what its own n-grams add to the weights of their histories (an n-gram has one slice as its
   owner), and which weights its words need;
3. weights are summed up by history into a table, partitioned by order, and joined to the words that back off.

An n-gram or history that a third of the corpus shares is one entry per slice. Only texts outside the
training set can need a weight, so histories that none of them has are left out of the table.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.blocks import COLUMN_BYTES, by_column, first_of_runs
from tradeloom.llm.scratch import drop, save
from tradeloom.llm.words import column_of, slices, window_hashes
from tradeloom.operators.matching import join_side_keys

#: Bytes of text that a task evaluates at once; a longer text is read in pieces.
PIECE_BYTES = 4 << 20
#: Counts of counts up to this count draw the line between them.
FITTED = 64
_BEGIN, _END = np.uint64(0x5BE61F4A7C15D3A1), np.uint64(0x1CE4E5B9BF58476D)
_NO_PART = -1
_SENT = "block int, part bigint, data binary"
_FOUND = (
    "kind int, row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, "
    "score double, level int, history bigint, spare double, lower double"
)
_TEXT, _WEIGHT, _NEED = range(3)
_OTHER_SLICES = "the table of texts came in other slices when it was read again"


def _pieces(text: bytes, limit: int):
    """A text cut behind white space into pieces of about `limit` bytes."""
    begin = 0
    while len(text) - begin > limit:
        end = begin + limit
        while end < len(text) and not text[end : end + 1].isspace():
            end += 1
        yield text[begin:end]
        begin = end
    yield text[begin:]


class _Slice:
    """Words of some texts as hashes, each text behind `order` - 1 marks of its beginning (or, where a
    text goes on from an earlier slice, its last words) and before one of its end."""

    def __init__(self, order: int, hashes: np.ndarray, lengths: np.ndarray, trains: np.ndarray):
        """`lengths` are the texts', their leading words or marks included."""
        self.order, self.hashes = order, hashes
        size, ahead = len(hashes), order - 1
        self.text = np.repeat(np.arange(len(lengths)), lengths)
        self.within = np.arange(size) - (np.cumsum(lengths) - lengths)[self.text]
        self.scored = self.within >= ahead
        self.mark = ~self.scored & (hashes == _BEGIN)
        self.trains = trains[self.text] & self.scored
        # Hash of the k words up to each place, and where it lies within one text.
        self.grams, self.whole = [], []
        for k in range(1, order + 1):
            grams = np.zeros(size, np.uint64)
            if size >= k:
                grams[k - 1 :] = window_hashes(hashes, k)
            self.grams.append(grams)
            self.whole.append((self.within >= k - 1) & ~self.mark)

    def distinct(self, k: int):
        """Of the n-grams of k words: places, distinct hashes, and each place's number among them."""
        places = np.flatnonzero(self.whole[k - 1])
        grams, number = np.unique(self.grams[k - 1][places], return_inverse=True)
        return places, grams, number


def _packed_hashes(hashes: np.ndarray) -> bytes:
    """Ascending hashes by their differences, bytes of equal weight together, so that they compress."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked_hashes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _small(values: np.ndarray) -> np.ndarray:
    """Counts in the fewest bytes that hold them."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _state(order: int, texts: list) -> tuple:
    """(hashes, lengths, trains) of texts given as (train, words before, bytes, is the last piece)."""
    hashes, lengths = [], []
    for _, before, data, last in texts:
        words = data.lower().split()
        own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        ahead = np.full(order - 1, _BEGIN, np.uint64) if before is None else before
        parts = [ahead, own, np.array([_END] if last else [], np.uint64)]
        lengths.append(sum(map(len, parts)))
        hashes += parts
    return (
        np.concatenate(hashes) if hashes else np.empty(0, np.uint64),
        np.array(lengths, np.int64), np.array([t for t, *_ in texts], bool),
    )


def _pieces_of(rows: pa.RecordBatch, texts: list, order: int, first_row: int):
    """Lists of (row, doc_id, trains, words before, bytes, last) for a slice each: all texts of a slice, or
    one piece of a text that is too long for one."""
    ids, trains = rows.column("doc_id").to_pylist(), rows.column("trains").to_pylist()
    if len(texts) > 1 or len(texts[0] or b"") <= PIECE_BYTES:
        yield [(first_row + i, ids[i], trains[i], None, t or b"", True) for i, t in enumerate(texts)]
        return
    before, pieces = None, list(_pieces(texts[0], PIECE_BYTES))
    for i, piece in enumerate(pieces):
        yield [(first_row, ids[0], trains[0], before, piece, i == len(pieces) - 1)]
        words = piece.lower().split()[-(order - 1) :] if order > 1 else []
        own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        earlier = np.full(order - 1, _BEGIN, np.uint64) if before is None else before
        before = np.concatenate([earlier, own])[len(own) :]


def _numbered(batches, order: int):
    """Slices of texts, each with its number: the same ones whenever the same table is read."""
    task = TaskContext.get().partitionId()
    part, row = task << 32, task << 40
    for rows, texts in slices(batches, "text", PIECE_BYTES):
        for some in _pieces_of(rows, texts, order, row):
            yield part, some
            part += 1
        row += len(texts)


def _rows(block: list[int] | None, part: int, datas: list[bytes]) -> pa.RecordBatch:
    parts, datas = pa.array([part] * len(datas), pa.int64()), pa.array(datas, pa.binary())
    if block is None:
        return pa.RecordBatch.from_arrays([parts, datas], names=["part", "data"])
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), parts, datas], names=["block", "part", "data"])


def _sent(order: int, columns: int):
    """Per slice: to each range of hashes its n-grams with their counts."""

    def run(batches):
        for part, some in _numbered(batches, order):
            known = _Slice(order, *_state(order, [s[2:] for s in some]))
            sent: dict[int, list] = {}
            for k in range(1, order + 1):
                places, grams, number = known.distinct(k)
                counts = np.bincount(number, known.trains[places], len(grams)).astype(np.int64)
                asked = np.bincount(number, known.scored[places] & ~known.trains[places], len(grams)) > 0
                for column, own in by_column(grams, column_of(grams, columns)):
                    entry = (k, _packed_hashes(grams[own]), _small(counts[own]), np.packbits(asked[own]))
                    sent.setdefault(column, []).append(entry)
            yield _rows(list(sent), part, [pickle.dumps(entries, 5) for entries in sent.values()])

    return run


def _texts(order: int):
    """Per slice: its texts, compressed."""

    def run(batches):
        for part, some in _numbered(batches, order):
            yield _rows(None, part, [zstandard.compress(pickle.dumps(some, 5), 3)])

    return run


def _answered(order: int):
    """One range of hashes: to each slice the counts of its n-grams, whether it owns them, and whether a
    text outside the training set has them; and the range's counts of counts."""

    def run(table: pa.Table) -> pa.Table:
        column = table.column("block")[0].as_py()
        parts, datas = [], []
        entries: dict[int, list] = {k: [] for k in range(1, order + 1)}
        for part, data in zip(table.column("part").to_pylist(), table.column("data").to_pylist()):
            for k, hashes, counts, asked in pickle.loads(data):
                entries[k].append((part, _unpacked_hashes(hashes), counts, asked))
        answers: dict[int, list] = {}
        statistics = []
        for k, own in entries.items():
            if not own:
                continue
            own.sort(key=lambda e: e[0])
            sizes = [len(h) for _, h, _, _ in own]
            hashes = np.concatenate([h for _, h, _, _ in own])
            counts = np.concatenate([c.astype(np.int64) for _, _, c, _ in own])
            asked = np.concatenate([np.unpackbits(a, count=n).astype(bool) for (_, _, _, a), n in zip(own, sizes)])
            order_of = np.argsort(hashes, kind="stable")
            first = first_of_runs(hashes[order_of])
            run_of = np.cumsum(first) - 1
            totals = np.bincount(run_of, counts[order_of]).astype(np.int64)
            wanted = np.bincount(run_of, asked[order_of]) > 0
            # The owner is the first slice that trains with the n-gram.
            training = np.flatnonzero(counts[order_of] > 0)
            owners = training[first_of_runs(run_of[training])] if len(training) else training
            total, owned, met = np.empty_like(counts), np.zeros(len(counts), bool), np.empty(len(counts), bool)
            total[order_of], met[order_of] = totals[run_of], wanted[run_of]
            owned[order_of[owners]] = True
            begin = 0
            for (part, *_), size in zip(own, sizes):
                some = slice(begin, begin + size)
                answer = (k, _small(total[some]), np.packbits(owned[some]), np.packbits(met[some]))
                answers.setdefault(part, []).append(answer)
                begin += size
            seen = totals[totals > 0]
            statistics.append((k, np.bincount(seen[seen <= FITTED], minlength=FITTED + 1), len(seen), int(seen.sum())))
        for part, answer in answers.items():
            parts.append(part)
            datas.append(pickle.dumps((column, answer), 5))
        parts.append(_NO_PART)
        datas.append(pickle.dumps(statistics, 5))
        return pa.table({"part": pa.array(parts, pa.int64()), "data": pa.array(datas, pa.binary())})

    return run


def _statistics(batches):
    """(k, r, n): n n-grams of k words occur r times; r = -1: distinct n-grams, r = -2: all occurrences."""
    for batch in batches:
        out = []
        for data in batch.column("data").to_pylist():
            for k, counts, distinct, occurrences in pickle.loads(data):
                out += [(k, r, int(counts[r])) for r in np.flatnonzero(counts).tolist()]
                out += [(k, -1, distinct), (k, -2, occurrences)]
        columns = list(zip(*out)) if out else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k", "r", "n"])


def discount_exponent(counts: dict[int, int]) -> float:
    """The slope of the line through the logarithms of counts of counts (count: how many n-grams have it),
    each averaged over the counts between its neighbours that do not occur; below -1 in any case.

    d(r) is (1 + 1 / r) to the power of the slope + 1, which is less than 1 for every r.
    """
    seen = sorted(r for r, n in counts.items() if n > 0)
    if len(seen) < 2:
        return -2.0
    below = [0, *seen[:-1]]
    above = [*seen[1:], 2 * seen[-1] - seen[-2]]
    x = np.log(seen)
    y = np.log([counts[r] / (0.5 * (c - a)) for r, a, c in zip(seen, below, above)])
    slope = float(((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum())
    return min(-1.1, max(-4.0, slope))


def _evaluated(order: int, exponents: list[float], tokens: int, texts: int):
    """One slice: each text's known words and score so far, what its own n-grams add to the weights of
    histories, and the weights that its words need."""

    def discount(k: int, counts: np.ndarray) -> np.ndarray:
        return (1 + 1 / np.maximum(counts, 1)) ** (exponents[k - 1] + 1)

    def run(answered: pa.Table, again: pa.Table) -> pa.Table:
        if again.num_rows != 1:
            raise RuntimeError(_OTHER_SLICES)
        some = pickle.loads(zstandard.decompress(again.column("data")[0].as_py()))
        answers = sorted(map(pickle.loads, answered.column("data").to_pylist()), key=lambda a: a[0])
        known = _Slice(order, *_state(order, [s[2:] for s in some]))
        total, owned, wanted, first = [], [], [], []
        scored = np.flatnonzero(known.scored)
        for k in range(1, order + 1):
            own = [a for _, entries in answers for a in entries if a[0] == k]
            sizes = [len(a[1]) for a in own]
            join = lambda at, own=own, sizes=sizes: (
                np.concatenate([np.unpackbits(a[at], count=n) for a, n in zip(own, sizes)]).astype(bool)
                if own
                else np.empty(0, bool)
            )
            counts = np.concatenate([a[1].astype(np.int64) for a in own]) if own else np.empty(0, np.int64)
            places, grams, number = known.distinct(k)
            if len(counts) != len(grams):
                raise RuntimeError(_OTHER_SLICES)
            at_place = np.zeros(len(known.hashes), np.int64)
            at_place[places] = counts[number]
            total.append(at_place)
            asked = np.zeros(len(known.hashes), bool)
            asked[places] = join(3)[number]
            wanted.append(asked)
            # Where each n-gram that this slice owns is trained with.
            training = known.trains[places]
            at = np.full(len(grams), -1, np.int64)
            at[number[training][::-1]] = places[training][::-1]
            first.append(at[join(2)])
        history, preceding = [], []
        for k in range(1, order + 1):
            if k == 1:
                history.append(np.full(len(known.hashes), tokens, np.int64))
                preceding.append(np.zeros(len(known.hashes), np.uint64))
                continue
            before = np.zeros(len(known.hashes), np.int64)
            before[1:] = np.where(known.mark[:-1], texts, total[k - 2][:-1])
            history.append(before)
            hashes = np.zeros(len(known.hashes), np.uint64)
            hashes[1:] = known.grams[k - 2][:-1]
            preceding.append(hashes)

        text = known.text[scored]
        number = len(some)
        counts = total[0][scored]
        level = np.zeros(len(scored), np.int64)
        score = np.zeros(len(scored))
        for k in range(1, order + 1):
            c = total[k - 1][scored]
            there = c > 0
            level[there] = k
            score[there] = np.log10(discount(k, c[there]) * c[there] / history[k - 1][scored[there]])
        sums = lambda values: np.bincount(text, values, number)
        rows = {
            "row": [s[0] for s in some], "doc_id": [s[1] for s in some],
            "held_out": [not s[2] for s in some], "n_tokens": np.bincount(text, minlength=number),
            "n_known": sums(counts > 0).astype(np.int64), "base": sums(np.log10(counts + 0.1)), "score": sums(score),
        }

        weights, needs = [], []
        for k in range(1, order + 1):
            at = first[k - 1]
            if k > 1:
                at = at[known.mark[at - 1] | wanted[k - 2][at - 1]]
            c, h = total[k - 1][at], history[k - 1][at]
            spare = (1 - discount(k, c)) * c / h
            lower = np.zeros(len(at))
            if k > 1:
                c, h = total[k - 2][at], history[k - 2][at]
                lower = discount(k - 1, c) * c / h
            hashes, which = np.unique(preceding[k - 1][at], return_inverse=True)
            weights.append((k, hashes, np.bincount(which, spare, len(hashes)), np.bincount(which, lower, len(hashes))))
            missing = scored[(level < k) & (history[k - 1][scored] > 0)]
            ids = np.array(rows["row"], np.int64)[known.text[missing]]
            needs.append((k, ids, preceding[k - 1][missing]))
        return _table(rows, weights, needs)

    return run


def _table(rows: dict, weights: list, needs: list) -> pa.Table:
    """All three kinds of rows in the columns of _FOUND."""
    n = len(rows["row"])
    parts = [{"kind": np.full(n, _TEXT), **rows}]
    for k, hashes, spare, lower in weights:
        kind, level = np.full(len(hashes), _WEIGHT), np.full(len(hashes), k)
        parts.append({"kind": kind, "level": level, "history": hashes.view(np.int64), "spare": spare, "lower": lower})
    for k, ids, hashes in needs:
        kind, level = np.full(len(ids), _NEED), np.full(len(ids), k)
        parts.append({"kind": kind, "row": ids, "level": level, "history": hashes.view(np.int64)})
    types = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    fields = [f.split() for f in _FOUND.split(", ")]
    tables = [
        pa.table(
            {
                name: pa.array(p[name], types[kind]) if name in p else pa.nulls(len(p["kind"]), types[kind])
                for name, kind in fields
            }
        )
        for p in parts
    ]
    return pa.concat_tables(tables)


def score_texts(docs: DataFrame, trains: Column, order: int = 2) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    Rows for which `trains` is true train the model of n-grams up to `order`; all rows are scored. Words are
    runs other than white space, lower-cased (A-Z only); a text is its words and one end, counted as a
    token. n_known counts tokens that occur in the training texts, train_tokens all tokens of these. score
    is the logarithm (10) of the text's probability in the model of the module; base_score the same for
    single words with 0.1 added to each count and one unknown word.

    NULL and empty texts have one token, the end. Rows without doc_id, for which `trains` is NULL, do not
    train; repeated rows count each time. Without training texts every word is the unknown one: both scores
    are 0. An empty table gives no rows. Other columns are not read.

    `docs` is read twice and must come in the same order in the same partitions, as stored tables do; it is
    an error if it does not. What is shuffled grows with the distinct n-grams of a slice: about 1.6 times a
    compressed table for pairs, 3 times for triples.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text", F.coalesce(trains, F.lit(False)).alias("trains"))
    size, trained = texts.agg(F.sum(F.octet_length("text").cast("bigint")), F.count_if("trains")).first()
    columns = max(64, (size or 0) // COLUMN_BYTES)
    sent = texts.mapInArrow(_sent(order, columns), _SENT)
    answers, answers_path = save(sent.groupBy("block").applyInArrow(_answered(order), "part bigint, data binary"), "gram-counts")

    numbers = answers.filter(F.col("part") == _NO_PART).select("data").mapInArrow(_statistics, "k bigint, r bigint, n bigint")
    # At most FITTED + 2 rows per length of n-grams.
    found = {(r["k"], r["r"]): r["n"] for r in numbers.groupBy("k", "r").agg(F.sum("n").alias("n")).collect()}
    exponents = [discount_exponent({r: n for (j, r), n in found.items() if j == k and r > 0}) for k in range(1, order + 1)]
    vocabulary, tokens = found.get((1, -1), 0), found.get((1, -2), 0)

    again = texts.mapInArrow(_texts(order), "part bigint, data binary").groupBy("part")
    evaluated = (
        answers.filter(F.col("part") != _NO_PART)
        .groupBy("part")
        .cogroup(again)
        .applyInArrow(_evaluated(order, exponents, tokens, trained), _FOUND)
    )
    results, _ = save(evaluated, "gram-results", by="kind")
    drop(spark, answers_path)
    summed = results.filter(F.col("kind") == _WEIGHT).groupBy(*join_side_keys("level", "history"))
    weight = F.sum("spare") / (1 - F.sum("lower"))
    weights, _ = save(
        summed.agg(F.log10(weight).alias("weight")).select("level", "history", "weight"), "backoff-weights", by="level"
    )
    needs = results.filter(F.col("kind") == _NEED).select("row", "level", "history")
    parts = results.filter(F.col("kind") == _TEXT).select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score")
    none = {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "base": "double"}
    backed_off = needs.join(weights, ["level", "history"]).select(
        "row", *(F.lit(None).cast(t).alias(c) for c, t in none.items()), F.col("weight").alias("score")
    )
    per_token = math.log10(tokens + 0.1 * (vocabulary + 1))
    scored = parts.unionAll(backed_off).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.bool_or("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sum("base").alias("base"), F.sum("score").alias("score"),
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.lit(per_token) * F.col("n_tokens")).alias("base_score"), "score",
    )
