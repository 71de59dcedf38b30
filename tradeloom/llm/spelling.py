"""Spelling variants of a corpus' words: a frontier of states that descends a trie level by level.

The trie over the words is a table of edges (node, letter, child), its nodes named by hashes of prefixes.
A state is a word, how many of its letters are read, the node reached, and the edits spent. Per level the
frontier is joined with that level's edges: a state without an edit goes on along its own letter, or
spends its edit on another letter or on leaving one out; a state whose edit is spent follows its letters.
States that have read their word with one edit spent end at a neighbour, if a word ends at their node.
An edge knows how long the words below it are, so that states which cannot end are not followed.

Edits are looked for in the second half of words only, once in the trie of the words and once in that of
the reversed words, so that no state branches near the root, where nodes have most children. Insertions
are the deletions of the other word. Hashes may collide, so neighbours are verified.

The descent takes a step per letter. Words of more than LONGEST letters, which occur in junk, meet by the
hashes of what an edit leaves of them instead.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.scratch import drop, save
from tradeloom.llm.words import mixed, slices
from tradeloom.operators.matching import join_side_keys

#: Words counted in a task before they are handed on, and letters of a text that are searched at once.
_KEPT_WORDS, _AT_ONCE = 200_000, 1 << 24
#: Words beyond this many letters do not go through the tries.
LONGEST = 48
_PREFIXES, _SUFFIXES = 0, 1
_BASE = 0x9E3779B97F4A7C15
_AS_CHANGED, _AS_SHORTENED, _WHOLE = range(3)


def counted_words(docs: DataFrame, misspelt_one_in: int | None, least_letters: int, least: int) -> DataFrame:
    """(word, n): the distinct words of `least_letters` or more that occur `least` times or more.

    Runs of letters are lower-cased (A-Z only). With `misspelt_one_in`, a run loses one letter wherever
    that number divides the CRC-32 of `<doc_id>:<run>`, which letter by the same checksum; a missing
    doc_id counts as empty text.
    """
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text").filter("text <> ''")
    partial = texts.mapInArrow(_counted(misspelt_one_in, least_letters), "word string, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _counted(misspelt_one_in: int | None, least_letters: int):
    # Shorter runs stay too short whatever becomes of them; bytes.lower() changes A-Z only.
    run_of = re.compile(f"[a-zÀ-ÿ]{{{least_letters},}}")

    def of_text(text: str) -> Counter:
        if len(text) <= _AT_ONCE:
            return Counter(run_of.findall(text))
        return Counter(m.group() for m in run_of.finditer(text))

    def batch(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
        )

    def run(batches):
        total: Counter = Counter()
        for rows, texts in slices(batches, "text"):
            for doc_id, text in zip(rows.column("id").to_pylist(), texts):
                found = of_text(text.lower().decode())
                if misspelt_one_in:
                    begun = zlib.crc32(f"{doc_id}:".encode())
                    for word in list(found):
                        checksum = zlib.crc32(word.encode(), begun)
                        if checksum % misspelt_one_in == 0:
                            place = checksum % len(word)
                            if len(word) > least_letters:
                                total[word[:place] + word[place + 1 :]] += found[word]
                            del found[word]
                total.update(found)
                if len(total) > _KEPT_WORDS:
                    yield batch(total)
                    total.clear()
        yield batch(total)

    return run


def _node(way: str, letters: str, length) -> Column:
    return F.xxhash64(F.col(way), F.substring(letters, F.lit(1), length))


def _edges(spelt: DataFrame, least_depth: int) -> DataFrame:
    """(depth, node, letter, child, lengths): each edge of both tries once, from `least_depth` down;
    `lengths` has a bit for each length of the words below."""
    levels = spelt.withColumn("depth", F.explode(F.sequence(F.lit(least_depth), F.length("letters") - 1)))
    edge = {
        "depth": F.col("depth"),
        "node": _node("way", "letters", F.col("depth")),
        "letter": F.substring("letters", F.col("depth") + 1, F.lit(1)),
        "child": _node("way", "letters", F.col("depth") + 1),
    }
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.length("letters"))
    edges = levels.select(*(c.alias(n) for n, c in edge.items()), bit.alias("bit"))
    return edges.groupBy(*edge).agg(F.bit_or("bit").alias("lengths"))


def _moves() -> Column:
    """What a state and an edge from its node lead to: structs (reads, edits, lost), none if nothing."""
    size, reads = F.length("letters"), F.col("reads")
    letter = lambda ahead: F.substring("letters", reads + 1 + ahead, F.lit(1))
    below = lambda length: F.getbit("lengths", length) == 1
    state = lambda ahead, edits, lost: F.struct(
        (reads + ahead).alias("reads"), F.lit(edits).alias("edits"), lost.alias("lost")
    )
    along = F.col("letter") == letter(0)
    free = F.col("edits") == 0
    on = F.when(free & along, state(1, 0, F.lit(False)))
    on = on.when(free & below(size), state(1, 1, F.lit(False)))
    on = on.when(~free & along & below(size - F.col("lost").cast("int")), state(1, 1, F.col("lost")))
    without = F.when(free & (F.col("letter") == letter(1)) & below(size - 1), state(2, 1, F.lit(True)))
    return F.array(on, without)


def _met_in_tries(words: DataFrame, least_letters: int) -> DataFrame:
    """(word, n, other, other_n, lost) of words at one edit: a letter of `word` changed, or `lost`.

    All words have LONGEST letters at most.
    """
    spark = words.sparkSession
    ways = F.explode(
        F.array(
            F.struct(F.lit(_PREFIXES).alias("way"), F.col("word").alias("letters")),
            F.struct(F.lit(_SUFFIXES).alias("way"), F.reverse("word").alias("letters")),
        )
    ).alias("as")
    spelt = words.select("word", "n", ways).select("word", "n", "as.*")
    totals = words.agg(F.max(F.length("word")).alias("letters"), F.count("*").alias("n")).first()
    shallowest = least_letters // 2
    files = max(8, totals["n"] // 500_000)
    edges, edges_path = save(
        _edges(spelt, shallowest).repartition(F.col("depth"), F.pmod("node", F.lit(files))), "trie-edges", by="depth"
    )
    # Edits of the first half of a word lie in the second half of the reversed one.
    half = F.floor(F.length("word") / 2)
    begins = F.when(F.col("way") == _PREFIXES, half).otherwise(F.length("word") - half).cast("int")
    entering = spelt.select(
        "word", "n", "way", "letters", begins.alias("reads"), F.lit(0).alias("edits"), F.lit(False).alias("lost"),
        _node("way", "letters", begins).alias("node"),
    )
    columns = entering.columns
    # The last letter left out takes no edge.
    ended = spelt.select("word", "n", "way", F.lit(True).alias("lost"), _node("way", "letters", F.length("letters") - 1).alias("node"))
    kept, paths, live = [ended], [], None
    for depth in range(shallowest, totals["letters"] or 0):
        frontier = entering.filter(F.col("reads") == depth)
        if live is not None:
            frontier = frontier.unionAll(live)
        level = edges.filter(F.col("depth") == depth).drop("depth")
        moved = frontier.join(level, "node").withColumn("move", F.explode(_moves())).filter("move IS NOT NULL")
        moved = moved.select("word", "n", "way", "letters", "move.*", F.col("child").alias("node")).select(*columns)
        reached, path = save(moved, "trie-frontier")
        more = F.col("reads") < F.length("letters")
        live = reached.filter(more)
        kept.append(reached.filter(~more & (F.col("edits") == 1)).select(*ended.columns))
        paths.append(path)
    ended = kept[0]
    for table in kept[1:]:
        ended = ended.unionAll(table)
    whole = spelt.select(
        "way", F.xxhash64("way", "letters").alias("node"), F.col("word").alias("other"), F.col("n").alias("other_n")
    )
    met = ended.join(whole, ["way", "node"]).filter(F.levenshtein("word", "other", 1) == 1)
    found, _ = save(met.select("word", "n", "other", "other_n", "lost").distinct(), "spelling-pairs")
    drop(spark, edges_path, *paths)
    return found


def _remains(batches):
    """Hashes of a word whole, and with each letter taken out, its place open or closed."""
    for batch in batches:
        ids = batch.column("id").to_pylist()
        for i, word in zip(ids, batch.column("word").to_pylist()):
            letters = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64)
            powers = np.full(len(letters), _BASE, np.uint64)
            powers[0] = 1
            terms = letters * powers.cumprod()
            ends = terms.cumsum()
            place = np.arange(len(letters))
            changed = mixed(mixed(ends[-1] - terms + np.uint64(len(letters))) ^ place.astype(np.uint64))
            # Letters behind the one taken out move one place to the front.
            inverse = np.uint64(pow(_BASE, -1, 1 << 64))
            shorter, at = np.unique(mixed(ends - terms + (ends[-1] - ends) * inverse), return_index=True)
            for role, hashes, places in (
                (_AS_CHANGED, changed, place), (_AS_SHORTENED, shorter, at), (_WHOLE, mixed(ends[-1:]), place[:1]),
            ):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(hashes), i, np.int64)), pa.array(np.full(len(hashes), role, np.int32)),
                        pa.array(hashes.view(np.int64)), pa.array(places, pa.int32()),
                    ],
                    names=["id", "role", "key", "place"],
                )


def _met_by_remains(words: DataFrame) -> DataFrame:
    """Like `_met_in_tries`, for pairs whose longer word has more than LONGEST letters."""
    long = words.filter(F.length("word") >= LONGEST).withColumn("id", F.xxhash64("word"))
    remains = long.select("id", "word").mapInArrow(_remains, "id bigint, role int, key bigint, place int")
    one = remains.select(F.col("id").alias("a"), F.col("role").alias("role_a"), "key", "place")
    two = remains.select(F.col("id").alias("b"), F.col("role").alias("role_b"), "key")
    changed = (F.col("role_a") == _AS_CHANGED) & (F.col("role_b") == _AS_CHANGED) & (F.col("a") != F.col("b"))
    lost = (F.col("role_a") == _AS_SHORTENED) & (F.col("role_b") == _WHOLE)
    pairs = one.join(two, "key").filter(changed | lost)
    pairs = pairs.groupBy("a", "b", lost.alias("lost")).agg(F.min("place").alias("place"))
    left = long.select(F.col("id").alias("a"), "word", "n")
    right = long.select(F.col("id").alias("b"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    met = pairs.join(left, "a").join(right, "b").filter(F.length("word") > LONGEST)
    without = lambda w: F.concat(
        F.substring(w, F.lit(1), F.col("place")), F.substring(w, F.col("place") + 2, F.length(w))
    )
    met = met.filter(without("word") == F.when(F.col("lost"), F.col("other")).otherwise(without("other")))
    return met.select("word", "n", "other", "other_n", "lost")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words of `forms` (word, form): where following forms ends."""
    spark = forms.sparkSession
    current, path = save(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        # Every step doubles the length followed.
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = current.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        following, following_path = save(step, "spelling-roots")
        drop(spark, path)
        current, path = following.select("word", "root"), following_path
        if following.filter("moved").isEmpty():
            return current


def spelling_variants(
    docs: DataFrame,
    least_letters: int = 6,
    least: int = 5,
    ratio: int = 5,
    misspelt_one_in: int | None = None,
) -> DataFrame:
    """One row per word of `docs` (doc_id, text): word, n, n_near, form, form_n, root.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF, lower-cased (A-Z only), of
    `least_letters` or more that occur `least` times or more (n). n_near counts the words that differ by
    one inserted, deleted or replaced letter; form is the most frequent of them (ties: the smallest in
    code-point order) if it occurs at least `ratio` times as often, else NULL; root is the word that forms lead
    to, the word itself without a form. For `misspelt_one_in` see `counted_words`.

    NULL and empty texts hold no words; repeated rows count each time; a missing doc_id is an id like
    any other. An empty table gives no rows. Other columns are not read.
    """
    if ratio < 2:
        raise ValueError("forms need not end if a form may be as frequent as its word")
    words, words_path = save(counted_words(docs, misspelt_one_in, least_letters, least), "spelling-words")
    tried = _met_in_tries(words.filter(F.length("word") <= LONGEST), least_letters)
    met = tried.unionAll(_met_by_remains(words))
    back = met.filter("lost").select(
        F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")
    )
    pairs = met.drop("lost").unionAll(back).distinct()
    near = pairs.groupBy(*join_side_keys("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), "other")).alias("best")
    )
    near, _ = save(near.select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.other").alias("best")), "spelling-near")
    enough = F.col("best_n") >= ratio * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n"),
    )
    roots = _roots(judged.filter("form IS NOT NULL"))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
