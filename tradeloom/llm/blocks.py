"""Exchange of hash blocks between parts of a collection and ranges of hashes, and back.

The matrix of documents by hashes is cut into blocks: rows by part (a slice of documents that one task
has in hand), columns by range of hashes. Three steps, each a Spark operator with a shuffle before the
next:

1. `emit` gets a slice of documents and yields (column, object) pairs;
2. `settle` gets all (part, object) pairs of one column and yields (part, object) pairs;
3. `finish` gets all objects of one part and yields result rows.

One shuffled row is a whole block, packed with numpy arrays, which costs a tenth of a row per hash. What
a hash occurs in often is summed up within each part before it is sent, so that one hash has at most one
entry per part in its column. The number of columns follows the amount of text, so that a column's size
does not.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeloom.llm.words import slices

_SENT = "block int, part bigint, data binary"
_BACK = "part bigint, data binary"
COLUMN_BYTES = 4 << 20


def columns_for(texts: DataFrame, column: str) -> int:
    """How many columns to use: one per COLUMN_BYTES of text, 64 at least."""
    size = texts.agg(F.sum(F.octet_length(column).cast("bigint"))).first()[0]
    return max(64, (size or 0) // COLUMN_BYTES)


def _sent(emit, columns: int, text: str):
    def run(batches):
        task, part = TaskContext.get().partitionId(), 0
        for rows, texts in slices(batches, text):
            key = (task << 32) + part
            part += 1
            spread = hash((task, part)) % columns
            sent = [(c if c is not None else spread, d) for c, d in emit(rows, texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c for c, _ in sent], pa.int32()),
                    pa.array([key] * len(sent), pa.int64()),
                    pa.array([pickle.dumps(d, 5) for _, d in sent], pa.binary()),
                ],
                names=["block", "part", "data"],
            )

    return run


def _settled(settle):
    def run(table: pa.Table) -> pa.Table:
        parts, datas = table.column("part").to_pylist(), table.column("data").to_pylist()
        back = list(settle([(p, pickle.loads(d)) for p, d in zip(parts, datas)]))
        return pa.table(
            {
                "part": pa.array([p for p, _ in back], pa.int64()),
                "data": pa.array([pickle.dumps(d, 5) for _, d in back], pa.binary()),
            }
        )

    return run


def _finished(finish):
    def run(table: pa.Table) -> pa.Table:
        return finish([pickle.loads(d) for d in table.column("data").to_pylist()])

    return run


def exchange(
    docs: DataFrame,
    emit: Callable[[pa.RecordBatch, list], Iterable[tuple[int | None, object]]],
    settle: Callable[[list[tuple[int, object]]], Iterable[tuple[int, object]]],
    finish: Callable[[list], pa.Table],
    columns: int,
    schema: str | StructType,
    text: str = "text",
) -> DataFrame:
    """The three steps over `docs`. A column of None in what `emit` yields means: any column."""
    sent = docs.mapInArrow(_sent(emit, columns, text), _SENT)
    back = sent.groupBy("block").applyInArrow(_settled(settle), _BACK)
    return back.groupBy("part").applyInArrow(_finished(finish), schema)


def by_column(hashes: np.ndarray, which: np.ndarray) -> Iterable[tuple[int, slice]]:
    """The runs of equal values in the ascending array `which`."""
    if len(hashes):
        cuts = np.flatnonzero(np.diff(which)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(which)]):
            yield int(which[begin]), slice(begin, end)


def first_of_runs(values: np.ndarray) -> np.ndarray:
    """Marks the first of each run of equal values."""
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    return first
