"""Near-duplicate embeddings: random-hyperplane sign hashing, exact cosines, connected components.

Each vector's signature in a table is the signs of its products with the table's random hyperplanes.
Vectors that agree in a table's signature share a bucket there; a bucket's vectors are compared by exact
cosines, as a product of two blocks of the matrix of unit vectors. A pair counts in the first table in
which it meets. Equal vectors are one vector with a weight. Only counts per vector and a spanning forest
of the links leave a task, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tradeloom.llm.blocks import by_column
from tradeloom.llm.components import connected_components
from tradeloom.llm.scratch import save
from tradeloom.operators.matching import join_side_keys

BLOCK_ROWS = 2048
_SIGNED = "rep bigint, weight bigint, vector binary, signatures binary, size int, bucket int, sign int"


def plan_tables(rows: int, threshold: float, recall: float, bucket_rows: int = 1024) -> tuple[int, int]:
    """Bits per signature and number of tables.

    Bits grow with the logarithm of the rows, so that vectors in no relation fill a bucket with
    `bucket_rows`; tables follow from the chance that a pair right at the threshold meets in one of them.
    """
    bits = min(30, max(4, math.ceil(math.log2(max(1, rows) / bucket_rows)) if rows > bucket_rows else 4))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def _units(matrix: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision, scaled first so that no square over- or underflows."""
    matrix = matrix.astype(np.float64)
    matrix = matrix / np.abs(matrix).max(1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(1, keepdims=True))


def _signed(bits: int, tables: int, seed: int):
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            vectors = batch.column("embedding")
            lengths = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            ids = batch.column("rep").to_numpy(zero_copy_only=False)
            weights = batch.column("weight").to_numpy(zero_copy_only=False)
            begins = np.cumsum(lengths) - lengths
            for size in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == size)
                matrix = flat[begins[rows][:, None] + np.arange(size)[None, :]]
                if size not in planes:
                    planes[size] = np.random.default_rng([seed, size]).standard_normal((size, tables * bits))
                for begin in range(0, len(rows), 1024):
                    some, given = rows[begin : begin + 1024], matrix[begin : begin + 1024]
                    signs = (_units(given) @ planes[size] > 0).reshape(len(some), tables, bits) @ powers
                    signs = signs.astype(np.int32)
                    packed = [s.tobytes() for s in signs]
                    blobs = [g.tobytes() for g in given]
                    for table in range(tables):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(ids[some], pa.int64()), pa.array(weights[some], pa.int64()),
                                pa.array(blobs, pa.binary()), pa.array(packed, pa.binary()),
                                pa.array(np.full(len(some), size, np.int32)),
                                pa.array(np.full(len(some), table, np.int32)), pa.array(signs[:, table]),
                            ],
                            names=["rep", "weight", "vector", "signatures", "size", "bucket", "sign"],
                        )

    return run


def _compare(threshold: float, kind: str):
    def bucket(ids, weights, units, signatures, left, right, table, counts, links):
        for begin in range(0, len(left), 256):
            rows = left[begin : begin + 256]
            near = units[rows] @ units[right].T >= threshold
            a, b = np.nonzero(near)
            a, b = rows[a], right[b]
            # Within a block each pair comes up twice; it counts for the row on the left.
            fresh = (ids[a] != ids[b]) & ~(signatures[a, :table] == signatures[b, :table]).any(1)
            a, b = a[fresh], b[fresh]
            counts[0] += np.bincount(a, weights[b], len(ids)).astype(np.int64)
            if right is not left:
                counts[0] += np.bincount(b, weights[a], len(ids)).astype(np.int64)
            # A forest: whatever joins two trees is a link, until no pair does.
            tree = counts[1]
            while len(a):
                apart = tree[a] != tree[b]
                a, b = a[apart], b[apart]
                for k in np.unique(tree[a], return_index=True)[1].tolist():
                    x, y = tree[a[k]], tree[b[k]]
                    if x != y:
                        links.append((int(ids[a[k]]), int(ids[b[k]])))
                        tree[tree == max(x, y)] = min(x, y)

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("rep").to_numpy()
        weights = table.column("weight").to_numpy()
        size = table.column("size").to_numpy()
        number = table.column("bucket").to_numpy()
        sign = table.column("sign").to_numpy()
        block = table.column("block").to_numpy()
        one, two = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        vectors, packed = table.column("vector").to_pylist(), table.column("signatures").to_pylist()
        rep, count, links = [], [], []
        order = np.lexsort((ids, sign, number, size))
        same = (np.diff(size[order]) == 0) & (np.diff(number[order]) == 0) & (np.diff(sign[order]) == 0)
        which = np.concatenate([[0], np.cumsum(~same)]) if len(order) else order
        for _, part in by_column(which, which):
            rows = order[part]
            if len(rows) < 2:
                continue
            units = _units(np.frombuffer(b"".join(vectors[r] for r in rows), kind).reshape(len(rows), -1))
            signatures = np.frombuffer(b"".join(packed[r] for r in rows), np.int32).reshape(len(rows), -1)
            left = np.flatnonzero(block[rows] == one)
            right = left if one == two else np.flatnonzero(block[rows] == two)
            counts = [np.zeros(len(rows), np.int64), np.arange(len(rows))]
            bucket(ids[rows], weights[rows], units, signatures, left, right, int(number[rows[0]]), counts, links)
            met = np.flatnonzero(counts[0])
            rep += ids[rows[met]].tolist()
            count += counts[0][met].tolist()
        return pa.table(
            {
                "a": pa.array(rep + [x for x, _ in links], pa.int64()),
                "b": pa.array([None] * len(rep) + [y for _, y in links], pa.int64()),
                "n": pa.array(count + [0] * len(links), pa.int64()),
            }
        )

    return run


def near_duplicate_vectors(
    vectors: DataFrame, threshold: float = 0.9, recall: float = 0.995, seed: int = 11
) -> DataFrame:
    """One row per row of `vectors` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Two rows link if the cosine of their vectors, in double precision, is `threshold` or more and they
    share a bucket, which a pair right at the threshold does with probability `recall`, closer ones more
    often, and equal ones always. n_links counts the other rows linked; component_id is the smallest
    vec_id reachable; kept marks the row with that id.

    Vectors that are NULL, empty, zero, or hold NULL or non-finite components link with nothing, nor do
    rows without vec_id, whose component is NULL and which are not kept. Vectors of different lengths do
    not link. Repeated rows are rows of their own that link with each other. Other columns are not read.
    """
    # Floats travel as floats, which takes half the space; cosines are of doubles all the same.
    single = vectors.schema["embedding"].dataType.elementType == FloatType()
    given = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", given.alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)) & ~F.isnan(x))
    usable = F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # Equal vectors are told by two hashes; 0.0 and -0.0 are made one before.
    plain = F.transform("embedding", lambda x: x + F.lit(0.0).cast("float" if single else "double"))
    keyed = rows.filter("usable").select(
        "vec_id", plain.alias("embedding"), F.xxhash64(plain).alias("key_a"), F.xxhash64(plain, F.lit(1)).alias("key_b")
    )
    key = ["key_a", "key_b"]
    classes = keyed.groupBy(*join_side_keys(*key)).agg(F.min("vec_id").alias("first_id"), F.count("*").alias("weight"))
    classes, _ = save(classes.select(*key, "first_id", "weight"), "vector-classes")
    firsts = classes.withColumnRenamed("first_id", "vec_id")
    chosen = keyed.join(firsts, ["vec_id", *key]).dropDuplicates(key)
    chosen = chosen.select(F.col("key_a").alias("rep"), "weight", "embedding")
    bits, tables = plan_tables(classes.count(), threshold, recall)
    signed = chosen.mapInArrow(_signed(bits, tables, seed), _SIGNED)
    place = ["size", "bucket", "sign"]
    sizes = signed.groupBy(*join_side_keys(*place)).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    # Most buckets are one block; only the larger ones need to be known to deal their rows.
    large, _ = save(sizes.filter("blocks > 1").select(*place, "blocks"), "large-buckets")
    placed = signed.join(large, place, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")})
    # Small buckets share a task: 2 ** (bits - 3) of them per table are eight to a task.
    alone = F.col("blocks") == 1
    low = F.when(alone, F.shiftright("sign", 3)).otherwise(F.col("sign"))
    grouped = pairs.groupBy("size", "bucket", alone.alias("alone"), low.alias("low"), "a", "b")
    met, _ = save(grouped.applyInArrow(_compare(threshold, "f4" if single else "f8"), "a bigint, b bigint, n bigint"), "vector-links")
    counts = met.filter("b IS NULL").groupBy(F.col("a").alias("key_a")).agg(F.sum("n").alias("others"))
    groups = connected_components(met.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "key_a")
    labelled = classes.join(counts, "key_a", "left").join(groups, "key_a", "left").select(
        *key, "first_id",
        (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "key_a").alias("component"),
    )
    labelled, _ = save(labelled, "vector-labels")
    smallest = labelled.groupBy(*join_side_keys("component")).agg(F.min("first_id").alias("component_id"))
    labelled, _ = save(labelled.join(smallest.select("component", "component_id"), "component"), "vector-groups")
    found = keyed.select("vec_id", *key).join(labelled, key).select("vec_id", "n_links", "component_id")
    rest = rows.filter("NOT usable").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return found.unionAll(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
