"""Product codes of vectors, in exact integers, with LAESA pivots.

Vectors are scaled to integers and cut into equal parts; each part position has a codebook, refined by a
few rounds of assignment and averaging. A part's distances to some fixed pivots of its position are
computed once and stored beside it. In every round the distances between pivots and entries are computed
anew, which is a small table, and by the triangle inequality the difference between a part's and an
entry's distance to a pivot is a lower bound of the distance between the two. Entries are evaluated in
the order of their bounds, and evaluation, in exact integers, ends where the bound exceeds the best
distance so far.

Per round each task adds up its parts by entry; what reaches the driver are the codebooks, one row per
part position and entry, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.scratch import drop, save
from tradeloom.operators.matching import join_side_keys

#: Components beyond this leave no room for sums of squares in 64 bits.
_LARGEST = 1 << 27
_CHUNK = 4096
_STORED = "parts binary, pivots binary"
_SUMS = "part int, entry int, members bigint, total array<bigint>"
_CODES = "code string, error bigint"


def _scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value) of each component."""
    values = np.floor(values.astype(np.float64) * scale)
    if values.size and np.abs(values).max() > _LARGEST:
        raise OverflowError(f"a component times {scale} lies beyond {_LARGEST}")
    return values.astype(np.int32)


def choose_pivots(entries: np.ndarray, number: int) -> np.ndarray:
    """Of (parts, entries, width), `number` pivots per part position: the first entry, then each time the
    entry farthest from those chosen."""
    chosen = []
    for own in entries.astype(np.int64):
        places = [0]
        nearest = ((own - own[0]) ** 2).sum(1)
        while len(places) < min(number, len(own)):
            places.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, ((own - own[places[-1]]) ** 2).sum(1))
        chosen.append(own[places])
    return np.stack(chosen)


def distances(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances between all rows of two small or narrow integer tables."""
    found = np.empty((len(some), len(others)))
    for k, other in enumerate(others.astype(np.int64)):
        difference = some.astype(np.int64) - other
        found[:, k] = np.sqrt((difference * difference).sum(1))
    return found


def nearest_entries(
    parts: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, entry_pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Of each part: its nearest entry, ties to the lower index, and the squared distance; and how many
    distances were evaluated.

    `to_pivots` are the parts' distances to the pivots in single precision, `entry_pivots` the entries'.
    """
    bounds = np.abs(to_pivots[:, 0, None] - entry_pivots[None, :, 0])
    for p in range(1, to_pivots.shape[1]):
        np.maximum(bounds, np.abs(to_pivots[:, p, None] - entry_pivots[None, :, p]), out=bounds)
    # What rounding to single precision may have added.
    bounds -= 1e-6 * (to_pivots.max(1, keepdims=True) + entry_pivots.max())
    order = np.argsort(bounds, axis=1)
    bounds = np.take_along_axis(bounds, order, 1)
    best = np.full(len(parts), np.iinfo(np.int64).max)
    found = np.full(len(parts), len(entries))
    live, evaluated = np.arange(len(parts)), 0
    wide = entries.astype(np.int64)
    for step in range(len(entries)):
        if step:
            live = live[bounds[live, step] <= np.sqrt(best[live])]
            if not len(live):
                break
        entry = order[live, step]
        difference = parts[live] - wide[entry]
        squared = (difference * difference).sum(1)
        evaluated += len(live)
        better = (squared < best[live]) | ((squared == best[live]) & (entry < found[live]))
        best[live[better]], found[live[better]] = squared[better], entry[better]
    return found, best, evaluated


def _prepared(pivots: np.ndarray, scale: int):
    """Vectors in integers, and their parts' distances to the pivots."""
    positions, number, width = pivots.shape

    def run(batches):
        for batch in batches:
            vectors = batch.column("vector")
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            parts = _scaled(flat, scale).reshape(-1, positions, width)
            to_pivots = np.empty((len(parts), positions, number), np.float32)
            for j in range(positions):
                to_pivots[:, j] = distances(parts[:, j], pivots[j])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), batch.column("label"),
                    pa.array([p.tobytes() for p in parts], pa.binary()),
                    pa.array([p.tobytes() for p in to_pivots], pa.binary()),
                ],
                names=["vec_id", "label", "parts", "pivots"],
            )

    return run


def _assigned(batch: pa.RecordBatch, entries: np.ndarray, entry_pivots: np.ndarray):
    """Pieces of a batch: the rows' range, their parts, nearest entries and squared distances."""
    positions, _, width = entries.shape
    for begin in range(0, batch.num_rows, _CHUNK):
        some = batch.slice(begin, _CHUNK)
        rows = some.num_rows
        parts = np.frombuffer(b"".join(some.column("parts").to_pylist()), np.int32).reshape(rows, positions, width)
        to_pivots = np.frombuffer(b"".join(some.column("pivots").to_pylist()), np.float32)
        to_pivots = to_pivots.reshape(rows, positions, -1)
        found, squared = np.empty((rows, positions), np.int64), np.empty((rows, positions), np.int64)
        for j in range(positions):
            found[:, j], squared[:, j], _ = nearest_entries(
                parts[:, j], np.ascontiguousarray(to_pivots[:, j]), entries[j], entry_pivots[j]
            )
        yield some, parts, found, squared


def _summed(entries: np.ndarray, entry_pivots: np.ndarray):
    """Per part position and entry the number and the sum of its parts, one row each per task."""
    positions, size, width = entries.shape

    def run(batches):
        members = np.zeros((positions, size), np.int64)
        totals = np.zeros((positions, size, width), np.int64)
        for batch in batches:
            for _, parts, found, _ in _assigned(batch, entries, entry_pivots):
                for j in range(positions):
                    members[j] += np.bincount(found[:, j], minlength=size)
                    np.add.at(totals[j], found[:, j], parts[:, j])
        part, entry = np.nonzero(members)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(members[part, entry]),
                pa.array(totals[part, entry].tolist(), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "members", "total"],
        )

    return run


def _coded(entries: np.ndarray, entry_pivots: np.ndarray):
    def run(batches):
        for batch in batches:
            for some, _, found, squared in _assigned(batch, entries, entry_pivots):
                codes = [bytes(row).hex() for row in found.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [some.column("vec_id"), some.column("label"), pa.array(codes, pa.string()), pa.array(squared.sum(1))],
                    names=["vec_id", "label", "code", "error"],
                )

    return run


def encode_vectors(
    vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, pivots: int = 4, scale: int = 256
) -> DataFrame:
    """One row per kept row of `vectors` (vec_id, embedding, label): vec_id, code, error, label_error,
    codebooks_sha256.

    Component x becomes floor(scale * x); vectors are cut into `parts` equal consecutive parts. Codebooks
    begin as the parts of the `entries` (256 at most) smallest vec_ids and go through `rounds` rounds of
    assignment to the nearest entry (ties to the lower index) and replacement by the floor of the mean; an
    entry without parts stays. `code` has two hexadecimal digits per part, `error` is the sum of the
    squared distances, `label_error` its sum over rows of equal label, NULL labels together.

    Rows go whose vector is NULL or empty or holds NULL or non-finite components, whose length is no
    multiple of `parts`, or is another than that of the smallest vec_id kept. Rows without vec_id and
    repeated rows are rows like any other; of equal vec_ids the smaller vector comes first, NULL comes
    last. With fewer rows than entries the codebooks are as many as rows. An empty table gives no rows.
    Components beyond 2 ** 27 after scaling raise an error. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits per part: 1 to 256 entries")
    spark = vectors.sparkSession
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)) & ~F.isnan(x))
    rows = vectors.select(F.col("vec_id").cast("bigint"), "label", F.col("embedding").alias("vector"))
    rows = rows.filter(finite & (F.size("vector") > 0) & (F.size("vector") % parts == 0))
    in_order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    label = f"vec_id bigint, label {vectors.schema['label'].dataType.simpleString()}, "

    # At most `entries` rows reach the driver.
    first = rows.orderBy(*in_order).limit(entries).collect()
    result = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
    if not first:
        return spark.createDataFrame([], result)
    size = len(first[0]["vector"])
    rows = rows.filter(F.size("vector") == size)
    if any(len(r["vector"]) != size for r in first):
        first = rows.orderBy(*in_order).limit(entries).collect()
    books = _scaled(np.array([r["vector"] for r in first], np.float64), scale)
    books = np.ascontiguousarray(books.reshape(len(first), parts, size // parts).transpose(1, 0, 2)).astype(np.int64)

    fixed = choose_pivots(books, pivots)
    stored, stored_path = save(rows.mapInArrow(_prepared(fixed, scale), label + _STORED), "vector-parts")
    for _ in range(rounds):
        sums = stored.mapInArrow(_summed(books, _entry_pivots(books, fixed)), _SUMS)
        width = size // parts
        added = sums.groupBy("part", "entry").agg(
            F.sum("members").alias("members"), *(F.sum(F.col("total")[k]).alias(f"t{k}") for k in range(width))
        )
        # One row per part position and entry.
        for row in added.collect():
            books[row["part"], row["entry"]] = [row[f"t{k}"] // row["members"] for k in range(width)]
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

    coded, _ = save(stored.mapInArrow(_coded(books, _entry_pivots(books, fixed)), label + _CODES), "vector-codes")
    drop(spark, stored_path)
    by_label = coded.groupBy(*join_side_keys("label")).agg(F.sum("error").alias("label_error"))
    sums = by_label.select(F.col("label").alias("__label"), "label_error")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("__label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _entry_pivots(books: np.ndarray, fixed: np.ndarray) -> np.ndarray:
    return np.stack([distances(own, some) for own, some in zip(books, fixed)]).astype(np.float32)
