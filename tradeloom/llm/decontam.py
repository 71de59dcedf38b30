"""Benchmark decontamination by canonical templates.

Numbers, units behind them, and names become typed placeholders, a run of numbers or names one; the rest
of a text is lower-cased and stripped of punctuation. As case and sentence position tell names from other
words only in part, texts have four readings: every word by its value; numbers as placeholders; names
inside sentences too; capitalised words that open sentences too. Windows of `width` template words of
documents are hash-joined with those of benchmark items, under all readings. Matches of one document and
one item at one distance between their positions, or at neighbouring ones, are one occurrence; it counts
if each value in the item's slots stands for one value in the document's slots, so that a question with
other numbers or names is caught and a chance likeness of templates is not.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.memory import releasing
from tradeloom.llm.words import Slice, slices, window_hashes

# Units of measure that count as such behind a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms "
    "oz ounce ounces lb lbs pound pounds t ton tons ml cl l liter liters litre litres gallon gallons "
    "ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros usd eur percent % degree degrees kmh mph meter meters metre metres"
).split()

_LITERAL, _NUMBER, _UNIT, _NAME, _NOTHING = range(5)
_NUMBER_FORM = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(%|st|nd|rd|th)?")
_GLUED = re.compile(r"([+-]?\d[\d.,:/]*)-?([^\W\d_]+)")
_END_MARKS = ".!?:;|"
_ENDS = re.compile(rf"[{_END_MARKS}][\"')\]»”’]*$")
#: Words that a task remembers, by their bytes, and bytes of text that it has in hand at once.
_KEPT_BYTES = 8 << 20
_SLICE_BYTES = 1 << 20
_NEAR_BITS = 24


def _parsed(word: bytes) -> list[tuple[str, int, bool]]:
    """Cores of a word, a number and a unit glued to it apart: each with what it may be, and whether a
    sentence ends with it."""
    text = word.decode("utf-8", "replace")
    # Most words: letters alone, or letters and one mark.
    mark = "" if text.isalpha() else text[-1]
    if not mark or (not mark.isalnum() and text[:-1].isalpha()):
        core = text[:-1] if mark else text
        return [(*_of_letters(core), mark in _END_MARKS if mark else False)]
    begin, end = 0, len(text)
    while begin < end and not text[begin].isalnum():
        begin += 1
    while end > begin and not text[end - 1].isalnum():
        end -= 1
    core = text[begin:end]
    ends = bool(_ENDS.search(text)) if end < len(text) else False
    if not core:
        return [("%" if "%" in text else "", _UNIT if "%" in text else _NOTHING, ends)]
    if _NUMBER_FORM.fullmatch(core):
        return [(core, _NUMBER, ends)]
    low = core.lower()
    glued = None if low in _UNIT_SET else _GLUED.fullmatch(low)
    if glued and glued[2] in _UNIT_SET:
        return [(glued[1], _NUMBER, False), (glued[2], _UNIT, ends)]
    return [(*_of_letters(core), ends)]


def _of_letters(core: str) -> tuple[str, int]:
    """A core that is no number: in lower case, and what it may be."""
    low = core.lower()
    if low in _UNIT_SET:
        return low, _UNIT
    if low != core and len(core) > 1 and core[0].isupper() and core[1:] == core[1:].lower():
        return low, _NAME
    return low, _LITERAL


_UNIT_SET = frozenset(UNITS)


def _all_parsed(words: list[bytes]) -> tuple[list[str], list[int], list[bool], np.ndarray]:
    """Cores, kinds and sentence ends of many words, and how many cores each word has.

    Words of small letters alone are taken together, the others go through `_parsed`.
    """
    texts = b"\n".join(words).decode("utf-8", "replace").split("\n") if words else []
    cores = "\n".join(texts).lower().split("\n") if words else []
    kinds = [_UNIT if core in _UNIT_SET else _LITERAL for core in cores]
    ends, counts, several = [False] * len(cores), np.ones(len(cores), np.int64), {}
    for i, (text, core) in enumerate(zip(texts, cores)):
        if text != core or not text.isalpha():
            found = _parsed(words[i])
            cores[i], kinds[i], ends[i] = found[0]
            if len(found) > 1:
                several[i], counts[i] = found[1:], len(found)
    for i in sorted(several, reverse=True):
        more = list(zip(*several[i]))
        cores[i + 1 : i + 1], kinds[i + 1 : i + 1], ends[i + 1 : i + 1] = map(list, more)
    return cores, kinds, ends, counts


class _Vocabulary(dict):
    """Numbers words in the order in which they come up."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class Templates:
    """Words of texts, what each may be, and where each text begins; `reading` has their template words."""

    def __init__(self):
        self._clear()

    def _clear(self):
        self._numbers, self._done, self._bytes = _Vocabulary(), 0, 0
        self._cores: list[str] = []
        self._kinds, self._ends = np.empty(0, np.int8), np.empty(0, bool)
        self._hashes = np.empty(0, np.uint64)
        self._first = np.zeros(1, np.int64)  # where each word's cores begin

    def _learn(self) -> None:
        fresh = list(islice(self._numbers, self._done, None))
        self._bytes += sum(map(len, fresh)) + 16 * len(fresh)
        cores, kinds, ends, counts = _all_parsed(fresh)
        self._first = np.concatenate([self._first, self._first[-1] + np.cumsum(counts)])
        self._cores += cores
        self._kinds = np.concatenate([self._kinds, np.array(kinds, np.int8)])
        self._ends = np.concatenate([self._ends, np.array(ends, bool)])
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, cores), np.uint64, len(cores))
        self._hashes = np.concatenate([self._hashes, hashes])
        self._done = len(self._numbers)

    def read(self, texts: list) -> "Templates":
        """Takes in some texts; the attributes below are theirs then."""
        if self._bytes > _KEPT_BYTES:
            self._clear()
        words = Slice(texts)
        numbers = np.fromiter(map(self._numbers.__getitem__, words.words), np.int64, len(words.words))
        if len(self._numbers) > self._done:
            self._learn()
        document = np.repeat(np.arange(len(texts)), words.lengths)
        counts = self._first[numbers + 1] - self._first[numbers]
        document = np.repeat(document, counts)
        within = np.arange(len(document)) - np.repeat(np.cumsum(counts) - counts, counts)
        numbers = np.repeat(self._first[numbers], counts) + within
        kinds = self._kinds[numbers]
        opens = np.ones(len(numbers), bool)
        opens[1:] = self._ends[numbers[:-1]] | (document[1:] != document[:-1])
        there = kinds != _NOTHING
        # A sentence's end at a lone mark counts for the next word.
        after = np.cumsum(opens)[there]
        numbers, document, kinds = numbers[there], document[there], kinds[there]
        opens = np.ones(len(numbers), bool)
        opens[1:] = after[1:] != after[:-1]
        behind = np.zeros(len(kinds), bool)
        behind[1:] = (kinds[:-1] == _NUMBER) & (document[1:] == document[:-1])
        kinds = np.where((kinds == _UNIT) & ~behind, _LITERAL, kinds)
        self.numbers, self.kinds, self.opens, self.document = numbers, kinds, opens, document
        self.lengths = np.bincount(document, minlength=len(texts))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        return self

    def reading(self, level: int) -> "Reading":
        """Template words under one of the LEVELS."""
        return Reading(self, level)

    def values(self, begin: int, end: int) -> str:
        return " ".join(self._cores[n] for n in self.numbers[begin:end].tolist())


#: Readings: all words by value; numbers and units as placeholders; names inside sentences too;
#: capitalised words that open sentences too.
LEVELS = range(4)


class Reading:
    def __init__(self, templates: Templates, level: int):
        self.templates, self.level = templates, level
        kinds, document = templates.kinds, templates.document
        if level == 0:
            kinds = np.zeros_like(kinds)
        elif level < 3:
            kinds = np.where((kinds == _NAME) & (templates.opens if level == 2 else True), _LITERAL, kinds)
        # What sets this reading apart from the ones before it.
        if level == 1:
            own = (kinds == _NUMBER) | (kinds == _UNIT)
        else:
            own = (kinds == _NAME) & (templates.opens if level == 3 else True)
        goes_on = np.zeros(len(kinds), bool)
        goes_on[1:] = (kinds[1:] == kinds[:-1]) & (document[1:] == document[:-1])
        goes_on &= (kinds == _NUMBER) | (kinds == _NAME) & ~templates.opens
        self.places = np.flatnonzero(~goes_on)
        self.ends = np.append(self.places[1:], len(kinds))
        self.kinds, self.own = kinds[self.places], own[self.places]
        hashes = templates._hashes[templates.numbers[self.places]]
        self.hashes = np.where(self.kinds == _LITERAL, hashes, self.kinds.astype(np.uint64))
        self.lengths = np.bincount(document[self.places], minlength=len(templates.lengths))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, place and text of each window that no earlier reading has: all where words stand for
        themselves, else those of which half the words at least are literal."""
        counts = np.maximum(self.lengths - width + 1, 0)
        document = np.repeat(np.arange(len(counts)), counts)
        places = np.arange(counts.sum()) - (np.cumsum(counts) - counts)[document] + self.starts[document]
        if self.level:
            literal = np.concatenate([[0], np.cumsum(self.kinds == _LITERAL)])
            own = np.concatenate([[0], np.cumsum(self.own)])
            enough = 2 * (literal[places + width] - literal[places]) >= width
            enough &= own[places + width] > own[places]
            places, document = places[enough], document[enough]
        return window_hashes(self.hashes, width)[places], places, document

    def slots(self, begin: int, width: int) -> list[str]:
        """Values of the placeholders from a position on, each with its type's number."""
        some = slice(begin, begin + width)
        value = self.templates.values
        return [
            f"{k}:{value(b, e)}" if k else ""
            for k, b, e in zip(self.kinds[some].tolist(), self.places[some].tolist(), self.ends[some].tolist())
        ]

    def words(self, begin: int, width: int) -> tuple[list[int], list[int], list[str]]:
        """Of each word from a template word on: its position, its template word's number in the window,
        and the value it has as a slot, if this or another reading makes it one."""
        at, token, ours = [], [], []
        of = self.templates
        for t, slot in enumerate(self.slots(begin, width)):
            for p in range(self.places[begin + t], self.ends[begin + t]):
                kind = int(of.kinds[p])
                kind = _LITERAL if kind == _NAME and of.opens[p] else kind
                at.append(p)
                token.append(t)
                ours.append(slot or (f"{kind}:{of.values(p, p + 1)}" if kind else ""))
        return at, token, ours


_ITEM_WINDOWS = (
    "window bigint, item_id bigint, width int, item_level int, item_place int, item_words int, "
    "at array<int>, token array<int>, ours array<string>"
)
_HITS = "window bigint, row bigint, doc_id bigint, width int, level int, place int, slots array<string>"


def _item_windows(width: int, least: int):
    def run(batches):
        templates = Templates()
        for rows, texts in slices(batches, "text"):
            ids = rows.column("item_id").to_pylist()
            templates.read(texts)
            out = []
            for level in LEVELS:
                reading = templates.reading(level)
                for size in sorted({min(width, int(n)) for n in reading.lengths if n >= least}):
                    for h, p, d in zip(*map(np.ndarray.tolist, reading.windows(size))):
                        if min(width, int(reading.lengths[d])) == size and ids[d] is not None:
                            at, token, ours = reading.words(p, size)
                            start = int(templates.starts[d])
                            words = int(templates.lengths[d])
                            at = [int(a) - start for a in at]
                            out.append((_signed(h), ids[d], size, level, at[0], words, at, token, ours))
            yield _batch(out, _ITEM_WINDOWS)

    return run


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"bigint": pa.int64(), "int": pa.int32(), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32())}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields]
    )


def _document_windows(widths: list[int], known):
    """Windows of documents; with `known`, a broadcast sorted array of hashes, only those in it."""

    def run(batches):
        templates = Templates()
        wanted = known.value if known is not None else None
        if wanted is not None:
            near = np.zeros(1 << _NEAR_BITS, bool)
            near[wanted >> np.uint64(64 - _NEAR_BITS)] = True
        row = TaskContext.get().partitionId() << 40
        for rows, texts in slices(batches, "text", _SLICE_BYTES):
            ids = rows.column("doc_id").to_pylist()
            templates.read(texts)
            out = []
            reading = None
            for level in LEVELS:
                del reading
                reading = templates.reading(level)
                if level and not reading.own.any():
                    continue
                for width in widths:
                    hashes, places, document = reading.windows(width)
                    if wanted is not None:
                        maybe = np.flatnonzero(near[hashes >> np.uint64(64 - _NEAR_BITS)])
                        hashes, places, document = hashes[maybe], places[maybe], document[maybe]
                        at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                        hit = wanted[at] == hashes
                        hashes, places, document = hashes[hit], places[hit], document[hit]
                    begins = reading.places[places] - templates.starts[document]
                    for h, p, d, b in zip(hashes.tolist(), places.tolist(), document.tolist(), begins.tolist()):
                        out.append((_signed(h), row + d, ids[d], width, level, b, reading.slots(p, width)))
            row += len(ids)
            yield _batch(out, _HITS)

    return releasing(run)


def _groups() -> Column:
    """The occurrences that a matching window may belong to: (readings up to which count, kind, number).

    Kind 0 is one distance between the positions, kinds 1 and 2 are ranges of neighbouring distances that
    overlap by half.
    """
    half = F.floor((F.col("item_words") + 17) / 2)
    near = [F.floor(F.col("shift") / (2 * half)), F.floor((F.col("shift") + half) / (2 * half))]
    all_of = [(level, 0, F.col("shift")) for level in LEVELS]
    all_of += [(level, 1 + k, number) for level in LEVELS[2:] for k, number in enumerate(near)]
    return F.filter(
        F.array(*[
            F.struct(F.lit(level).alias("upto"), F.lit(kind).alias("kind"), number.cast("bigint").alias("number"))
            for level, kind, number in all_of
        ]),
        lambda g: g["upto"] >= F.col("met_level"),
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 8,
    coverage: float = 0.5,
    least: int = 4,
    broadcast_windows: int = 1_000_000,
) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, coverage, reparameterised.

    `docs` has doc_id and text, `benchmark` item_id and text. An item is found in a document if windows
    of `width` template words (the whole template of shorter items, `least` words at least) that match at
    one distance or at neighbouring ones cover the share `coverage` of the item's words or more, and every
    slot value of the item stands for one value in the document; or if windows of equal words cover the
    whole item. `reparameterised`: the best covering occurrence has a value that differs from the item's.
    Windows with more placeholders than literal words match by their values only, in whatever case.

    NULL and empty texts, items shorter than `least` words and rows without an id match nothing.
    Repeated rows give one result; items with equal texts are all found. Other columns are not read.

    While the benchmark has at most `broadcast_windows` windows, their hashes (8 bytes each) go to every
    task, which then passes on matching windows only; beyond that all windows are shuffled to the join.
    """
    spark = docs.sparkSession
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    windows = items.mapInArrow(_item_windows(width, least), _ITEM_WINDOWS)
    sizes = windows.groupBy("width").agg(F.count("*").alias("n")).collect()  # one row per width
    widths = sorted(r["width"] for r in sizes)
    known = None
    if sum(r["n"] for r in sizes) <= broadcast_windows:
        hashes = np.array([r["window"] for r in windows.select("window").distinct().collect()], np.int64)
        known = spark.sparkContext.broadcast(np.sort(hashes.view(np.uint64)))
    if not widths:
        return spark.createDataFrame([], "doc_id bigint, item_id bigint, coverage double, reparameterised boolean")
    hits = texts.mapInArrow(_document_windows(widths, known), _HITS)
    met = hits.join(windows, ["window", "width"])
    occurrence = ["doc_id", "row", "item_id", "item_words"]
    pieces = met.select(
        *occurrence,
        (F.col("place") - F.col("item_place")).alias("shift"),
        F.greatest("level", "item_level").alias("met_level"),
        F.explode(
            F.arrays_zip("at", "ours", F.transform("token", lambda t: F.get("slots", t)).alias("theirs"))
        ).alias("word"),
    )
    # One row per covered word of the item, distance and reading; a literal word stands for itself.
    theirs = F.when(F.col("word.theirs") == "", F.col("word.ours")).otherwise(F.col("word.theirs"))
    covered = pieces.select(
        *occurrence, "shift", "met_level", "word.at", "word.ours", theirs.alias("theirs")
    ).distinct()
    covered = covered.withColumn("occurrence", F.explode(_groups()))
    values = covered.groupBy(*occurrence, "occurrence").agg(
        F.count_distinct("at").alias("words"),
        F.count_distinct(F.when(F.col("ours") != "", F.col("ours"))).alias("values"),
        F.count_distinct(F.when(F.col("ours") != "", F.struct("ours", "theirs"))).alias("pairs"),
        F.bool_or(F.col("ours") != F.col("theirs")).alias("differs"),
    )
    share = F.col("words") / F.col("item_words")
    # Windows of equal words do not show where the words between them differ, unless there are none.
    enough = F.when(F.col("occurrence.upto") == 0, 1.0).otherwise(F.lit(coverage))
    found = values.filter((F.col("values") == F.col("pairs")) & (share >= enough))
    return found.groupBy("doc_id", "item_id").agg(
        F.max(share).alias("coverage"),
        F.min_by("differs", F.struct(-share, "differs")).alias("reparameterised"),
    )
