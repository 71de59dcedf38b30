"""Near-duplicate join on word n-grams by Jaccard similarity, as a blocked sparse matrix product.

Let row d of a 0/1 matrix mark the shingles of document d; the product of the matrix with its transpose
counts the shingles that two documents share. Two sets with a similarity of s or more share at least
s times the size of either, so all but a few rows drop out before the product:

1. Documents with equal sets are one row from here on (hash of the set).
2. Blocks of rows by ranges of shingles: a shingle that occurs in one row only adds to no count. Rows
   that share fewer than s * size shingles with all others together have no partner and go.
3. Of the rows left, ranges of shingles give each shingle's number of rows. A row's rarest shared
   shingles, one more than it could do without, must include one that a partner has among its own:
   rows that meet there, directly or through others, form a cluster.
4. Each cluster's rows go to one task, which multiplies them and drops counts below the bound that
   follows from the two sizes. Of the links found it returns a spanning forest; the connected components
   of all forests are the result.
5. A cluster of too many rows is cut into blocks. Each block is multiplied by itself and by a few rows of
   the cluster that go to every block, which makes one tree of most rows of a large group. A link that is
   still missing has an end outside the cluster's largest tree: those rows are multiplied by all blocks.
   So the work grows with the cluster and with what its largest group leaves, not with pairs of blocks.

Overlap counts never leave a task, and no list of pairs of a shingle's rows is ever made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.blocks import by_column, columns_for, exchange, first_of_runs
from tradeloom.llm.components import connected_components
from tradeloom.llm.scratch import save
from tradeloom.llm.words import Slice, column_of, window_hashes
from tradeloom.operators.matching import join_side_keys

BLOCK_SHINGLES = 2_000_000
PIVOTS = 16  # rows of a large cluster that go to all its blocks; sets the amount of work, not the result


def _bound(size, percent: int):
    """The least number of shared shingles that a set of this size needs."""
    return -(-size * percent // 100)


def _sets(texts: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending within it, and the text each belongs to.

    A text of fewer than `width` words has its whole sequence as its one shingle.
    """
    words = Slice(texts, lower=True)
    hashes = words.hashes()
    found, owners = [], []
    places, document = words.window_starts(width)
    found.append(window_hashes(hashes, width)[places])
    owners.append(document)
    for length in range(1, width):
        short = np.flatnonzero(words.lengths == length)
        if len(short):
            found.append(window_hashes(hashes, length)[words.starts[short]] ^ np.uint64(length))
            owners.append(short)
    shingles, document = np.concatenate(found), np.concatenate(owners)
    order = np.lexsort((shingles, document))
    shingles, document = shingles[order], document[order]
    once = first_of_runs(shingles) | first_of_runs(document)
    return shingles[once], document[once]


def _digests(shingles: np.ndarray, document: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set, whatever its order."""
    added, crossed = np.zeros(count, np.uint64), np.zeros(count, np.uint64)
    for k, run in by_column(document, document):
        added[k] = np.add.reduce(shingles[run])
        crossed[k] = np.bitwise_xor.reduce(shingles[run] * np.uint64(0xD6E8FEB86659FD93))
    return added, crossed


def _profiles(docs: DataFrame, width: int, columns: int) -> DataFrame:
    """(doc_id, n_shingles, digests, shared): shared is how many of the shingles other rows have too."""

    def emit(rows, texts):
        ids = rows.column("doc_id").to_pylist()
        shingles, document = _sets(texts, width)
        sizes = np.bincount(document, minlength=len(ids))
        digests = _digests(shingles, document, len(ids))
        order = np.argsort(shingles, kind="stable")
        shingles, document = shingles[order], document[order]
        first = first_of_runs(shingles)
        last = np.ones(len(first), bool)
        last[:-1] = first[1:]
        single = first & last
        yield None, ("rows", ids, sizes, digests, np.bincount(document[~single], minlength=len(ids)))
        heads = np.flatnonzero(first)
        lone, shingles, document = single[heads], shingles[heads], document[heads].astype(np.uint32)
        which = column_of(shingles, columns)
        for column, run in by_column(shingles, which):
            mine = lone[run]
            rest = shingles[run].astype(np.uint32)  # the range and these 32 bits tell shingles apart
            yield column, ("shingles", rest[mine], document[run][mine], rest[~mine])

    def settle(entries):
        sent = [(part, *data[1:]) for part, data in entries if data[0] == "shingles"]
        yield from ((part, data) for part, data in entries if data[0] != "shingles")
        if sent:
            everywhere = np.concatenate([*(lone for _, lone, _, _ in sent), *(known for *_, known in sent)])
            _, inverse, parts = np.unique(everywhere, return_inverse=True, return_counts=True)
            again, at = parts[inverse] > 1, 0
            for part, lone, document, _ in sent:
                shared = document[again[at : at + len(lone)]]
                at += len(lone)
                if len(shared):
                    which, count = np.unique(shared, return_counts=True)
                    yield part, ("shared", which, count)

    def finish(datas):
        _, ids, sizes, digests, shared = next(d for d in datas if d[0] == "rows")
        for d in datas:
            if d[0] == "shared":
                shared[d[1]] += d[2]
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_shingles": pa.array(sizes, pa.int64()),
                "digest_a": pa.array(digests[0].view(np.int64), pa.int64()),
                "digest_b": pa.array(digests[1].view(np.int64), pa.int64()),
                "shared": pa.array(shared, pa.int64()),
            }
        )

    schema = "doc_id bigint, n_shingles bigint, digest_a bigint, digest_b bigint, shared bigint"
    return exchange(docs, emit, settle, finish, columns, schema)


def _prefixes(docs: DataFrame, width: int, percent: int, columns: int) -> DataFrame:
    """(doc_id, shingles, rarest): the shared shingles of rows that may have a partner, the whole set's
    size, and the rarest ones, of which a partner has one among its own rarest."""

    def emit(rows, texts):
        ids = rows.column("doc_id").to_pylist()
        shingles, document = _sets(texts, width)
        yield None, ("rows", ids, shingles, document.astype(np.uint32))
        values, counts = np.unique(shingles, return_counts=True)
        for column, run in by_column(values, column_of(values, columns)):
            yield column, ("counts", values[run], counts[run].astype(np.uint32))

    def settle(entries):
        sent = [(part, *data[1:]) for part, data in entries if data[0] == "counts"]
        yield from ((part, data) for part, data in entries if data[0] != "counts")
        if sent:
            values, inverse = np.unique(np.concatenate([v for _, v, _ in sent]), return_inverse=True)
            total, at = np.bincount(inverse, np.concatenate([c for _, _, c in sent])), 0
            for part, v, _ in sent:
                rows_of = total[inverse[at : at + len(v)]]
                at += len(v)
                if (rows_of > 1).any():
                    yield part, ("frequent", v[rows_of > 1], rows_of[rows_of > 1].astype(np.int64))

    def finish(datas):
        _, ids, shingles, document = next(d for d in datas if d[0] == "rows")
        frequent = [d for d in datas if d[0] == "frequent"]
        values = np.concatenate([np.empty(0, np.uint64), *(d[1] for d in frequent)])
        counts = np.concatenate([np.empty(0, np.int64), *(d[2] for d in frequent)])
        order = np.argsort(values)
        values, counts = values[order], counts[order]
        out = []
        for k, run in by_column(document, document):
            own = shingles[run]
            at = np.minimum(np.searchsorted(values, own), max(0, len(values) - 1))
            met = values[at] == own if len(values) else np.zeros(len(own), bool)
            common, spare = own[met], int(met.sum()) - int(_bound(len(own), percent))
            if spare >= 0:
                rarest = np.lexsort((common, counts[at[met]]))[: spare + 1]
                out.append((ids[k], len(own), common.tobytes(), common[rarest].view(np.int64)))
        columns_ = list(zip(*out)) if out else [[]] * 4
        return pa.table(
            {
                "doc_id": pa.array(columns_[0], pa.int64()),
                "n_shingles": pa.array(columns_[1], pa.int64()),
                "shingles": pa.array(columns_[2], pa.binary()),
                "rarest": pa.array(columns_[3], pa.list_(pa.int64())),
            }
        )

    schema = "doc_id bigint, n_shingles bigint, shingles binary, rarest array<bigint>"
    return exchange(docs, emit, settle, finish, columns, schema)


class _Forest:
    """Union-find over row numbers that remembers the links which joined two trees."""

    def __init__(self, count: int):
        self.tree = np.arange(count)
        self.links: list[tuple[int, int]] = []

    def join(self, row: int, others: np.ndarray) -> None:
        for tree in np.unique(self.tree[others]):
            if tree != self.tree[row]:
                other = int(others[np.flatnonzero(self.tree[others] == tree)[0]])
                self.links.append((row, other))
                self.tree[self.tree == tree] = self.tree[row]


def _linked(sizes: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int):
    """A spanning forest of the links between rows marked `left` and rows marked `right`.

    Row by row: the counts of a row's shared shingles with all right rows are one row of the product.
    Rows are taken from outside the largest tree first; once all others are done, every link between two
    trees has been seen, for a link has one end outside the largest one.
    """
    count = len(sets)
    owner = np.repeat(np.arange(count), [len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    begins = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    kept = right[owner]
    by_value = np.argsort(column[kept], kind="stable")
    rows_of = owner[kept][by_value]
    pointer = np.concatenate([[0], np.cumsum(np.bincount(column[kept], minlength=len(values)))])
    forest, waiting = _Forest(count), left.copy()
    same = bool((left & right).any())
    turn = 0
    while waiting.any():
        if same and turn:
            largest = np.bincount(forest.tree).argmax()
            outside = np.flatnonzero(waiting & (forest.tree != largest))
        else:
            outside = np.flatnonzero(waiting)
        if not len(outside) or (forest.tree == forest.tree[0]).all():
            break
        # A few rows first, so that the largest tree shows early.
        for row in outside[: 4 if turn < 4 else 64]:
            waiting[row] = False
            mine = column[begins[row] : begins[row + 1]]
            lengths = pointer[mine + 1] - pointer[mine]
            before = np.cumsum(lengths) - lengths
            at = np.repeat(pointer[mine] - before, lengths) + np.arange(lengths.sum())
            overlap = np.bincount(rows_of[at], minlength=count)
            needed = percent * (sizes[row] + sizes)
            partners = np.flatnonzero((100 + percent) * overlap >= needed)
            partners = partners[(partners != row) & right[partners]]
            if len(partners):
                forest.join(row, partners)
        turn += 1
    return forest.links


def _product(percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        sizes = table.column("n_shingles").to_numpy()
        cluster = table.column("cluster").to_numpy()
        left = table.column("left").to_numpy(zero_copy_only=False)
        right = table.column("right").to_numpy(zero_copy_only=False)
        blobs = table.column("shingles").to_pylist()
        order = np.lexsort((ids, cluster))
        links = []
        for _, part in by_column(cluster[order], cluster[order]):
            rows = order[part]
            if len(rows) > 1:
                sets = [np.frombuffer(blobs[r], np.uint64) for r in rows]
                found = _linked(sizes[rows], sets, left[rows], right[rows], percent)
                links += [(int(ids[rows[x]]), int(ids[rows[y]])) for x, y in found]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


_ROW = ("doc_id", "n_shingles", "shingles", "cluster")


def _multiplied(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """(a, b): a spanning forest per task of the links between rows marked `left` and rows marked `right`."""
    return rows.groupBy(*keys).applyInArrow(_product(percent), "a bigint, b bigint")


def _within_blocks(large: DataFrame, percent: int) -> DataFrame:
    """Links within the blocks of large clusters, and of a few rows of each cluster to all its blocks."""
    drawn = Window.partitionBy("cluster").orderBy(F.xxhash64("doc_id"), "doc_id")
    pivots = (
        large.select("cluster", "doc_id").withColumn("__place", F.row_number().over(drawn))
        .filter(F.col("__place") <= PIVOTS).select("cluster", "doc_id").distinct()
    )
    elsewhere = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != F.col("block"))
    guests = large.join(pivots, ["cluster", "doc_id"]).withColumn("block", F.explode(elsewhere))
    both = [F.lit(True).alias("left"), F.lit(True).alias("right")]
    rows = large.select(*_ROW, "block", *both).unionAll(guests.select(*_ROW, "block", *both))
    return _multiplied(rows, ["cluster", "block"], percent)


def _across_blocks(large: DataFrame, inner: DataFrame, percent: int) -> DataFrame:
    """Links between rows outside each cluster's largest tree of `inner` and all rows of the cluster."""
    trees = connected_components(inner)
    labelled = (
        large.select("doc_id", "cluster", (F.octet_length("shingles") / 8).alias("entries"))
        .join(trees, F.col("doc_id") == F.col("node"), "left")
        .withColumn("tree", F.coalesce("component", "doc_id"))
    )
    counts = labelled.groupBy("cluster", "tree").agg(F.count("*").alias("n"))
    largest = counts.groupBy("cluster").agg(F.max_by("tree", F.struct("n", "tree")).alias("largest"))
    largest, _ = save(largest, "largest-trees")
    outside = labelled.join(largest, "cluster").filter("tree <> largest").select("doc_id", "cluster", "entries")
    outside, _ = save(outside, "outside")
    parts = outside.groupBy(*join_side_keys("cluster")).agg(
        F.ceil(F.sum("entries") / BLOCK_SHINGLES).cast("int").alias("parts")
    )
    parts, _ = save(parts.select("cluster", "parts"), "outside-parts")
    met = large.join(parts, "cluster")
    one = met.join(outside.select("cluster", "doc_id").distinct(), ["cluster", "doc_id"], "left_semi").select(
        *_ROW, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("parts")).cast("int").alias("part"),
        F.lit(True).alias("left"), F.lit(False).alias("right"),
    )
    other = met.select(
        *_ROW, "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(False).alias("left"), F.lit(True).alias("right"),
    )
    return _multiplied(one.unionAll(other), ["cluster", "block", "part"], percent)


def _cluster_links(rows: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of all clusters, a spanning forest of each task's."""
    members = rows.select("doc_id", "n_shingles", "shingles").join(
        clusters.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster")), "doc_id"
    )
    members, _ = save(members, "clusters")
    entries = F.octet_length("shingles") / 8
    sizes = members.groupBy(*join_side_keys("cluster")).agg(
        F.ceil(F.sum(entries) / BLOCK_SHINGLES).cast("int").alias("blocks")
    )
    divided, _ = save(sizes.filter("blocks > 1").select("cluster", "blocks"), "large-clusters")
    total = members.agg(F.sum(entries)).first()[0] or 0
    tasks = max(64, int(total // (BLOCK_SHINGLES // 4)))
    # Small clusters share a task.
    small = members.join(divided, "cluster", "left_anti").select(
        *_ROW, F.lit(True).alias("left"), F.lit(True).alias("right"),
        F.pmod(F.xxhash64("cluster"), F.lit(tasks)).alias("task"),
    )
    links = _multiplied(small, ["task"], percent)
    if divided.isEmpty():
        return links
    large = members.join(divided, "cluster").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    inner, _ = save(_within_blocks(large, percent), "block-links")
    return links.unionAll(inner).unionAll(_across_blocks(large, inner, percent))


def near_duplicate_groups(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id.

    A-Z are lower-cased and texts cut into words at ASCII white space. A text's set holds its distinct
    runs of `width` words, or its whole sequence if it has fewer. Two texts link when their sets'
    similarity is `percent` hundredths or more; component_id is the smallest doc_id reachable by links.

    NULL texts and texts without words have an empty set and link with nothing. A row without doc_id
    links with nothing and has no component. Rows with equal ids are one node. Other columns are ignored.
    Sets are compared by 64-bit hashes of their shingles.
    """
    texts = docs.select("doc_id", "text")
    columns = columns_for(texts, "text")
    profile, _ = save(_profiles(texts, width, columns), "profiles")
    key = ["n_shingles", "digest_a", "digest_b"]
    filled = profile.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes, _ = save(
        filled.groupBy(*join_side_keys(*key)).agg(F.min("doc_id").alias("first_id"), F.min("shared").alias("shared")).drop("__key_hash"),
        "classes",
    )
    open_ = classes.filter(F.col("shared") * 100 >= F.col("n_shingles") * percent)
    chosen = texts.join(open_.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    rows, _ = save(_prefixes(chosen, width, percent, columns), "prefixes")
    meets = rows.select("doc_id", F.explode("rarest").alias("shingle"))
    least = meets.groupBy(*join_side_keys("shingle")).agg(F.min("doc_id").alias("least_id"))
    stars = meets.join(least.select("shingle", "least_id"), "shingle").filter("doc_id <> least_id")
    clusters = connected_components(stars.select(F.col("doc_id").alias("a"), F.col("least_id").alias("b")))
    links = _cluster_links(rows, clusters, percent)
    # Rows with one id and several texts tie the classes of these texts together.
    several = filled.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    held = filled.join(several, "doc_id", "left_semi").join(classes.select(*key, "first_id"), key)
    lowest = held.groupBy("doc_id").agg(F.min("first_id").alias("lowest"))
    tied = held.join(lowest, "doc_id").filter("first_id <> lowest").distinct()
    links = links.unionAll(tied.select(F.col("first_id").alias("a"), F.col("lowest").alias("b")))
    groups = connected_components(links)
    labelled = classes.join(groups, F.col("first_id") == F.col("node"), "left").select(
        *key, F.xxhash64(*key).alias("__key_hash"), F.coalesce("component", "first_id").alias("component_id")
    )
    labelled, _ = save(labelled, "labelled")
    found = filled.join(labelled.drop("__key_hash"), key).select("doc_id", "n_shingles", "component_id")
    rest = profile.filter("doc_id IS NULL OR n_shingles = 0")
    return found.unionAll(rest.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
