"""Packing of token sequences: first-fit decreasing with a tournament tree of bin capacities.

Documents are tokenised and cut into full sequences and a rest. Pieces are dealt at random into groups of
bounded size, and each group is packed on its own: pieces by descending length, each into the first bin
with room, found in a tournament tree whose inner nodes hold the larger capacity of their two children.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.words import slices

_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, draw bigint"
_PACKED = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
GROUP_PIECES = 8192
#: White space of this length or more in a row is beyond what `tiktoken` can safely split.
_LONG_SPACE = 10_000
_LONG_SPACES = re.compile(rf"\s{{{_LONG_SPACE}}}")


class Tokenizer:
    """Token ids of a tokenizer file, as the `tokenizers` library gives them without special tokens.

    If the same vocabulary is at hand as ranks (`ranks`, with its `pattern`), texts without a special
    token's string are encoded by `tiktoken`, which gives the same ids four times as fast. Its splitting
    into words takes stack for every blank of a run, so texts with very long runs go through `tokenizers`.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer as Reader

        self._reader = Reader.from_file(path)
        added = self._reader.get_added_tokens_decoder()
        self._special = [t.content for t in added.values()]
        self._fast = None
        if ranks and pattern:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self._fast is not None and not any(s in text for s in self._special):
            if len(text) < _LONG_SPACE or not _LONG_SPACES.search(text):
                return self._fast.encode_ordinary(text)
        return self._reader.encode(text, add_special_tokens=False).ids


def _cut(tokenizer: dict, size: int, end_id: int):
    def run(batches):
        reader = Tokenizer(**tokenizer)
        for rows, texts in slices(batches, "text"):
            out = []
            for doc_id, text, draw in zip(rows.column("doc_id").to_pylist(), texts, rows.column("draw").to_pylist()):
                ids = np.array([*(reader.ids(text.decode()) if text else ()), end_id], "<u4")
                for start in range(0, len(ids), size):
                    piece = ids[start : start + size]
                    out.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), draw))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "draw"],
            )

    return run


def first_fit(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each of the lengths (at most `size`), taken in the given order.

    The tree's leaves are the capacities left; the first bin with room is found from the root in as many
    steps as the tree has levels.
    """
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    room = [size] * (2 * leaves)
    bins, offsets = [], []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins.append(node - leaves)
        offsets.append(size - room[node])
        room[node] -= length
        node //= 2
        while node:
            larger = max(room[2 * node], room[2 * node + 1])
            if room[node] == larger:
                break
            room[node] = larger
            node //= 2
    return bins, offsets


def _packed(size: int):
    def run(key, pieces: pd.DataFrame) -> pd.DataFrame:
        order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
        pieces = pieces.sort_values(["length", *order], ascending=[False, *[True] * 4], kind="stable")
        bins, offsets = first_fit(pieces["length"].tolist(), size)
        pieces["sequence_id"] = (np.int64(key[0]) << 32) + np.array(bins, np.int64)
        pieces["offset"] = np.array(offsets, np.int64)
        return pieces[[f.split()[0] for f in _PACKED.split(", ")]]

    return run


def pack(
    docs: DataFrame, tokenizer: dict, size: int = 2048, end_id: int = 1, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """One row per piece of each row of `docs` (doc_id, text): doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset.

    A document's ids are those of its text, none if NULL or empty, and `end_id`. Pieces are cut at
    multiples of `size`; offsets are where they lie in their sequence of at most `size` ids. `tokenizer`
    holds the arguments of `Tokenizer`, whose files every executor must have.

    Rows without doc_id and repeated rows are documents like any other. Other columns are not read.
    Groups are drawn by a hash of id and text length with a random salt per row position, so that no id,
    however frequent, fills a group: a group has `group_pieces` pieces on average.
    """
    texts = docs.select("doc_id", "text")
    # A sequence takes size / 8 to size pieces of text; the estimate only sets the number of groups.
    weight = texts.agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("bigint")).alias("bytes")).first()
    pieces = weight["n"] + (weight["bytes"] or 0) // (2 * size)
    groups = max(16, pieces // group_pieces)
    drawn = texts.withColumn("draw", F.xxhash64("doc_id", F.octet_length("text"), F.monotonically_increasing_id()))
    cut = drawn.mapInArrow(_cut(tokenizer, size, end_id), _PIECES)
    grouped = cut.withColumn("group", F.pmod(F.xxhash64("draw", "start"), F.lit(groups)).cast("bigint")).drop("draw")
    return grouped.groupBy("group").applyInPandas(_packed(size), _PACKED)
