"""Substring deduplication: word windows that already start in an earlier document are cut out.

Difference-cover anchors. Positions whose remainder modulo a period lies in a difference cover are
anchors. Whatever two positions i and j, some shift k below the period makes i + k and j + k anchors
both, so two equal windows of `width` words share, k words in, an equal window of width - period + 1
words that starts at an anchor in both. Only anchors are hashed and compared (6 of 31 positions here);
where an anchor occurs in more than one document, the match is extended: the full windows around it are
hashed and the smallest document id of each decides.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tradeloom.llm.blocks import by_column, columns_for, exchange, first_of_runs
from tradeloom.llm.words import Slice, column_of, window_hashes

# Perfect difference covers (every remainder is a difference of two members).
COVERS = {1: (0,), 3: (0, 1), 7: (1, 2, 4), 13: (0, 1, 3, 9), 31: (1, 5, 11, 24, 25, 27)}

_MARKS = "doc_id bigint, __anchors binary"
_RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"


def _period(width: int) -> int:
    """The longest period that leaves anchors of two fifths of the window at least."""
    return max(p for p in COVERS if width - p + 1 >= max(1, 2 * width // 5))


def _anchors(words: Slice, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place in the slice and document of every anchor."""
    period = _period(width)
    covered = np.zeros(period, bool)
    covered[list(COVERS[period])] = True
    length = width - period + 1
    places, document = words.window_starts(length)
    long_enough = words.lengths[document] >= width
    chosen = covered[(places - words.starts[document]) % period] & long_enough
    places, document = places[chosen], document[chosen]
    return window_hashes(hashes, length)[places], places, document


def _shared_anchors(docs: DataFrame, width: int, columns: int) -> DataFrame:
    """(doc_id, anchors): the anchor hashes of each document that some other row has too."""

    def emit(rows, texts):
        ids = rows.column("doc_id").to_numpy(zero_copy_only=False)
        words = Slice(texts)
        hashes, _, document = _anchors(words, words.hashes(), width)
        order = np.lexsort((document, hashes))
        hashes, document = hashes[order], document[order]
        once = first_of_runs(hashes) | first_of_runs(document)
        hashes, document = hashes[once], document[once]
        first = first_of_runs(hashes)
        last = np.ones(len(first), bool)
        last[:-1] = first[1:]
        single = first & last
        # Shared within this part: known already, the column only hears of it.
        yield None, ("ids", ids)
        yield None, ("shared", document[~single].astype(np.uint32), hashes[~single])
        heads = np.flatnonzero(first)
        lone = single[heads]
        hashes, document = hashes[heads], document[heads].astype(np.uint32)
        for column, run in by_column(hashes, column_of(hashes, columns)):
            of = document[run]
            yield column, ("anchors", hashes[run], np.where(lone[run], of, np.uint32(0xFFFFFFFF)))

    def settle(entries):
        anchors = [(part, data[1], data[2]) for part, data in entries if data[0] == "anchors"]
        yield from ((part, data) for part, data in entries if data[0] != "anchors")
        if anchors:
            hashes = np.concatenate([h for _, h, _ in anchors])
            values, inverse, count = np.unique(hashes, return_inverse=True, return_counts=True)
            shared, at = count[inverse] > 1, 0
            for part, h, document in anchors:
                mine = shared[at : at + len(h)] & (document != 0xFFFFFFFF)
                at += len(h)
                if mine.any():
                    yield part, ("shared", document[mine], h[mine])

    def finish(datas):
        ids = next(d[1] for d in datas if d[0] == "ids")
        shared = [d for d in datas if d[0] == "shared"]
        document = np.concatenate([d[1] for d in shared])
        hashes = np.concatenate([d[2] for d in shared])
        order = np.lexsort((hashes, document))
        document, hashes = document[order], hashes[order]
        runs = [(k, np.unique(hashes[run]).tobytes()) for k, run in by_column(document, document)]
        return pa.table(
            {
                "doc_id": pa.array([int(ids[k]) for k, _ in runs], pa.int64()),
                "__anchors": pa.array([h for _, h in runs], pa.binary()),
            }
        )

    return exchange(docs, emit, settle, finish, columns, _MARKS)


def _marks(docs: DataFrame, width: int, columns: int) -> DataFrame:
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    marks = _shared_anchors(texts, width, columns)
    return marks.groupBy("doc_id").agg(F.collect_set("__anchors").alias("__anchors"))


def _counted(with_text: bool):
    def result(rows: list[tuple]) -> pa.Table:
        out = []
        for doc_id, _, words, kept, _ in rows:
            text = b" ".join(kept)
            shown = text.decode() if with_text else None
            out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest(), shown))
        columns = list(zip(*out)) if out else [[]] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return result


def _rewritten(rest_type: pa.DataType):
    def result(rows: list[tuple]) -> pa.Table:
        texts = [(b" ".join(kept) if len(kept) < len(words) else text).decode() for _, text, words, kept, _ in rows]
        return pa.table(
            {
                "doc_id": pa.array([r[0] for r in rows], pa.int64()),
                "text": pa.array(texts, pa.string()),
                "n_removed": pa.array([len(r[2]) - len(r[3]) for r in rows], pa.int64()),
                "rest": pa.array([r[4] for r in rows], rest_type),
            }
        )

    return result


def _candidates(words: Slice, hashes: np.ndarray, shared: np.ndarray, width: int) -> np.ndarray:
    """Places where a window starts that holds a shared anchor."""
    anchors, places, document = _anchors(words, hashes, width)
    hit = np.isin(anchors, shared)
    places, document = places[hit], document[hit]
    begin = np.maximum(places - _period(width) + 1, words.starts[document])
    end = np.minimum(places, words.starts[document + 1] - width)
    steps = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(steps, begin[begin <= end], 1)
    np.add.at(steps, end[begin <= end] + 1, -1)
    return np.flatnonzero(np.cumsum(steps[:-1]) > 0)


def _cut(marked: DataFrame, width: int, columns: int, schema, result) -> DataFrame:
    """Rows of `result` for documents that carry their shared anchors in `__anchors`, NULL if none.

    `result` gets a list of (doc_id, text, its words, which of them stay, rest) and gives a table; `rest`
    is the value of the column of this name, or None.
    """

    def emit(rows, texts):
        ids = rows.column("doc_id").to_pylist()
        marks = rows.column("__anchors").to_pylist()
        open_ = [i for i, m in enumerate(marks) if m and texts[i]]
        clean = sorted(set(range(len(ids))) - set(open_))
        rest = rows.column("rest").to_pylist() if "rest" in rows.schema.names else [None] * len(ids)
        done = [(ids[i], texts[i] or b"", words, words, rest[i]) for i in clean for words in [(texts[i] or b"").split()]]
        kept = [texts[i] for i in open_]
        yield None, ("rows", result(done))
        if not open_:
            return
        packed = pa.compress(b"".join(kept), codec="zstd", asbytes=True)
        yield None, ("texts", [ids[i] for i in open_], [len(t) for t in kept], packed, [rest[i] for i in open_])
        words = Slice(kept)
        shared = np.unique(np.frombuffer(b"".join(b for i in open_ for b in marks[i]), np.uint64))
        hashes = words.hashes()
        places = _candidates(words, hashes, shared, width)
        document = np.searchsorted(words.starts, places, "right") - 1
        ids = np.array([ids[i] for i in open_], np.int64)
        windows = window_hashes(hashes, width)[places] if len(places) else np.empty(0, np.uint64)
        order = np.lexsort((places, ids[document], windows))
        windows, places, document = windows[order], places[order].astype(np.uint32), document[order]
        first = first_of_runs(windows)
        heads = np.flatnonzero(first)
        head = heads[np.cumsum(first) - 1]
        # Of equal windows in this part, those of a later document go; the rest follow the first one.
        later = ids[document] > ids[document[head]]
        yield None, ("gone", places[later])
        like = ~later & ~first
        yield None, ("alike", places[like], places[head[like]])
        windows, places, document = windows[heads], places[heads], document[heads]
        # By place, a column's entries are nearby places of few documents, which packs well.
        which = column_of(windows, columns)
        order = np.lexsort((places, which))
        windows, places, document, which = windows[order], places[order], document[order], which[order]
        for column, run in by_column(which, which):
            own = np.flatnonzero(first_of_runs(document[run]))
            runs = np.diff(np.append(own, run.stop - run.start))
            gaps = np.diff(places[run], prepend=places.dtype.type(0))
            yield column, ("windows", windows[run], ids[document[run][own]], runs, gaps)

    def settle(entries):
        sent = [
            (part, data[1], np.repeat(data[2], data[3]), np.cumsum(data[4], dtype=np.uint32))
            for part, data in entries
            if data[0] == "windows"
        ]
        yield from ((part, data) for part, data in entries if data[0] != "windows")
        if sent:
            windows = np.concatenate([w for _, w, _, _ in sent])
            owner = np.concatenate([o for _, _, o, _ in sent])
            order = np.lexsort((owner, windows))
            first = first_of_runs(windows[order])
            earliest = owner[order][first][np.cumsum(first) - 1]
            later, at = np.empty(len(owner), bool), 0
            later[order] = owner[order] > earliest
            for part, w, _, places in sent:
                mine = later[at : at + len(w)]
                at += len(w)
                if mine.any():
                    yield part, ("gone", places[mine])

    def finish(datas):
        tables = [d[1] for d in datas if d[0] == "rows"]
        for _, ids, lengths, packed, rest in (d for d in datas if d[0] == "texts"):
            whole = pa.decompress(packed, sum(lengths), codec="zstd", asbytes=True)
            ends = np.cumsum(lengths)
            texts = [whole[e - n : e] for e, n in zip(ends.tolist(), lengths)]
            words = Slice(texts)
            gone = np.zeros(len(words.words) + 1, bool)
            for d in datas:
                if d[0] == "gone":
                    gone[d[1]] = True
            for d in datas:
                if d[0] == "alike":
                    gone[d[1]] |= gone[d[2]]
            steps = np.zeros(len(words.words) + width + 1, np.int64)
            starts = np.flatnonzero(gone)
            steps[starts] += 1
            steps[starts + width] -= 1
            stays = (np.cumsum(steps) == 0).tolist()
            done = []
            for i, doc_id in enumerate(ids):
                a, b = int(words.starts[i]), int(words.starts[i + 1])
                own = words.words[a:b]
                done.append((doc_id, texts[i], own, [w for w, s in zip(own, stays[a:b]) if s], rest[i]))
            tables.append(result(done))
        return pa.concat_tables(tables)

    return exchange(marked, emit, settle, finish, columns, schema)


def cut_repeated_windows(docs: DataFrame, width: int = 50, with_text: bool = True) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_words, n_removed, kept_sha256, kept.

    Every word of a window of `width` words goes whose word sequence also starts in a row with a smaller
    doc_id; windows are judged on the texts as given. `kept` is the rest, joined by one space (NULL
    unless `with_text`), kept_sha256 its lowercase hex digest.

    NULL and empty texts have no words. A row without doc_id is neither earlier nor later than any
    other: it keeps all its words and takes none from others. Rows with equal ids do not cut each other.
    Texts shorter than a window stay whole. Other columns of `docs` are not read.

    Equality of windows is decided by 64-bit hashes. Each shuffled entry stands for all equal windows of
    a slice of documents, so a passage that a third of the corpus repeats costs one entry per slice.
    """
    texts = docs.select("doc_id", "text")
    columns = columns_for(texts, "text")
    marks = _marks(texts, width, columns)
    marked = texts.join(marks, "doc_id", "left")
    return _cut(marked, width, columns, _RESULT, _counted(with_text))


def without_repeated_windows(docs: DataFrame, width: int = 50) -> DataFrame:
    """`docs` with `text` rewritten as by `cut_repeated_windows`, and n_removed; all columns stay.

    Texts of which nothing is removed stay as they are, white space and NULL included. Columns of `docs`
    named n_removed or __anchors are replaced or dropped. Only documents with a passage in common with
    others go through the exchange; the rest passes by.
    """
    docs = docs.drop("n_removed", "__anchors")
    names = [c for c in docs.columns if c not in ("doc_id", "text")]
    quoted = {c: "`" + c.replace("`", "``") + "`" for c in docs.columns}
    columns = columns_for(docs, "text")
    marks = _marks(docs, width, columns)
    inner = docs.select("doc_id", "text", F.struct(F.lit(0).alias("__0"), *(quoted[c] for c in names)).alias("rest"))
    none = F.lit(0).cast("bigint").alias("n_removed")
    clean = inner.join(marks, "doc_id", "left_anti").select("doc_id", "text", none, "rest")
    open_ = inner.join(marks, "doc_id")
    rest_type = to_arrow_type(inner.schema["rest"].dataType)
    schema = clean.schema
    changed = _cut(open_, width, columns, schema, _rewritten(rest_type))
    kept = (f"rest.{quoted[c]}" if c in names else c for c in docs.columns)
    return clean.unionAll(changed).select(*kept, "n_removed")
