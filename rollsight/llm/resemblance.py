"""Near-duplicate documents by SimHash components and exact Jaccard likeness of their word shingles.

First every set of shingles gets a 64-bit SimHash; the index of `simhash_index` finds those at most
three bits apart, and each set of a component is compared with the component's first one. A likeness
of 0.8 is about ten bits, so more links are left than that index can reach. The rest is found
exactly, between sets that are not linked yet:

Two sets with a likeness of t or more have an element in common among the first
n - ceil(t n) + 1 of each, whatever order all elements are put in. So only these first shingles
are matched, every pair of 0.8 is among the candidates, and the likeness of each candidate is
then counted on the whole sets. The order is that of the hashes, but for shingles that many
documents start with: they go last, those of the most documents at the very end.

Texts never move for that: one scan counts first shingles, a second one makes the rows that are
matched, with the frequent ones in its closure, and a shuffle of (shingle, set, size) leaves only
shingles that several sets start with. Candidates are pruned by size and by how many first shingles
alike sets must share; whole sets are made anew for those left.

A key that more than `BUCKET_ROWS` sets still share is a group of near copies or a formula. Its
sets are first compared with one of them, a few times over; then those outside its largest
component are compared with all others of the key. Sets that are linked already need no pair, and
these comparisons are made inside the join on sketches: of each of 2,048 places a set's sketch says
whether an odd number of its shingles falls on it. Sketches differ in no more bits than the sets
differ in shingles, so pairs whose sketches are too far apart never become rows and none is lost. Two
sets that share crowded keys alone need several of them, so they also meet under one of the rarer:
each row knows how many crowded keys its set has from this one on, by ascending number of sets, and
a pair is made only where so few can be enough.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Shelf, fold_table, free_shuffles, run_starts, slices
from .components import connected_components
from .fingerprints import SEED, SHINGLE_WORDS, _mixed
from .simhash_index import majorities, near_pairs

LIKENESS = 0.8
BUCKET_ROWS = 16
# Shingles that may go last; they are part of the tasks' closures. Any choice gives the same pairs.
LAST_SHINGLES = 200_000
LEADER_ROUNDS = 3
KNOWN_WORDS = 500_000
# Sets a task remembers to have handed out, so that copies are handed out about once a task.
SEEN_SETS = 1_000_000
# Sets whose narrow (id, content) rows may be broadcast to the scan that makes them anew.
BROADCAST_SETS = 500_000
# 64-bit words of a sketch. Sets of over about 2,500 shingles fill it, so it tells few of those apart.
SKETCH_WORDS = 32
# Words of a folded sketch; a join's loop over many more is too long for the JVM to compile.
FOLDED_WORDS = 16


class _Known(dict):
    def __missing__(self, word):
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return found


def _rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    n = len(hashes) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for place in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[place:place + n]
    return _mixed(out).view(np.int64)


def shingle_sets(texts, known: dict, width: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """Per text its different word shingles in ascending order, as signed 64-bit hashes.

    They are those of `fingerprints.shingle_set`: a text of fewer words is one shingle, one
    without words has none.
    """
    table = fold_table(False)
    for part in slices(texts, 1_000_000):
        split = [raw.translate(table).split() for raw in part]
        edges = run_starts([len(words) for words in split]).tolist()
        hashes = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.uint64, edges[-1])
        rolled = _rolled(hashes, width) if len(hashes) >= width else np.zeros(0, np.int64)
        for a, b in zip(edges, edges[1:]):
            if b - a >= width:
                yield np.unique(rolled[a:b - width + 1])
            else:
                yield _rolled(hashes[a:b], b - a) if b > a else np.zeros(0, np.int64)


class Late(NamedTuple):
    """Shingles that go last, ascending, and their order among each other."""

    keys: np.ndarray
    order: np.ndarray


NONE_LATE = Late(np.zeros(0, np.int64), np.zeros(0, np.int64))


def first_shingles(shingles: np.ndarray, last: Late, likeness: float) -> np.ndarray:
    """The shingles of which an alike set must have one; those in `last` come last."""
    number = len(shingles) - math.ceil(likeness * len(shingles) - 1e-9) + 1
    if len(last.keys) and len(shingles):
        place = np.minimum(np.searchsorted(last.keys, shingles), len(last.keys) - 1)
        late = last.keys[place] == shingles
        behind = shingles[late][np.argsort(last.order[place[late]])]
        shingles = np.concatenate((shingles[~late], behind))
    return shingles[:number]


def set_simhash(shingles: np.ndarray) -> int:
    """Bits that more than half of a set's shingles have, as a signed 64-bit number."""
    return int(majorities(shingles.view(np.uint64), np.array([len(shingles)])).view(np.int64)[0])


def set_sketch(shingles: np.ndarray) -> np.ndarray:
    """A bit for every place on which an odd number of the shingles falls, as signed 64-bit words."""
    bits = 64 * SKETCH_WORDS
    fallen = np.bincount((shingles.view(np.uint64) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((fallen & 1).astype(np.uint8)).view(np.int64)


def _set_id(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes(), SEED) - 2 ** 63


def _identified(text: Column | str) -> Column:
    """Per text: the number of its set, the set's SimHash and its sketch."""

    @F.pandas_udf("node long, fp long, sketch array<long>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = _Known()
        for batch in batches:
            rows = [(_set_id(s), set_simhash(s), set_sketch(s)) for s in shingle_sets(batch, known)]
            yield pd.DataFrame(rows, columns=["node", "fp", "sketch"]).astype({"node": "int64", "fp": "int64"})

    return of(text)


def _starts(docs: DataFrame, likeness: float, last: Late) -> DataFrame:
    """(node, n, key): the first shingles of every set, once or a few times."""

    def cut(batches):
        known, seen = _Known(), set()
        for batch in batches:
            nodes, sizes, keys = [], [], []
            for found in shingle_sets(batch["text"], known):
                node = _set_id(found)
                if len(found) and node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    sizes.append(len(found))
                    keys.append(first_shingles(found, last, likeness))
            if len(seen) > SEEN_SETS:
                seen.clear()
            counts = [len(k) for k in keys]
            for a, b in _runs(counts):
                yield pd.DataFrame({
                    "node": np.repeat(np.array(nodes[a:b], dtype=np.int64), counts[a:b]),
                    "n": np.repeat(np.array(sizes[a:b], dtype=np.int64), counts[a:b]),
                    "key": np.concatenate(keys[a:b]),
                })

    return docs.select("text").mapInPandas(cut, "node long, n long, key long")


def _runs(counts: list[int], most: int = 500_000) -> Iterator[tuple[int, int]]:
    """Consecutive places whose counts add up to about `most`."""
    start = total = 0
    for place, count in enumerate(counts):
        total += count
        if total >= most:
            yield start, place + 1
            start, total = place + 1, 0
    if start < len(counts):
        yield start, len(counts)


def _shingles(text: Column | str) -> Column:
    @F.pandas_udf("array<long>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _Known()
        for batch in batches:
            yield pd.Series(list(shingle_sets(batch, known)), dtype=object)

    return of(text)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the sets in `wanted` (node, like.id, like.content), made from their texts."""
    found = wanted.select("node", F.col("like.id").alias("like_id"), F.col("like.content").alias("like_content"))
    if wanted.count() <= BROADCAST_SETS:
        found = F.broadcast(found)
    rows = docs.select(F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_content"), "text")
    same = F.col("own_id").eqNullSafe(F.col("like_id")) & (F.col("own_content") == F.col("like_content"))
    made = rows.join(found, same).select("node", _shingles("text").alias("shingles"))
    return made.groupBy("node").agg(F.first("shingles").alias("shingles"))


def _frequent(starts: DataFrame) -> Late:
    """Shingles that many sets start with; of `LAST_SHINGLES` the ones of the most sets."""
    counted = starts.groupBy("key").count()
    most = counted.where(F.col("count") > BUCKET_ROWS).orderBy(F.desc("count"), "key").limit(LAST_SHINGLES)
    keys = np.array([row["key"] for row in most.collect()], dtype=np.int64)[::-1]
    places = np.argsort(keys)
    return Late(keys[places], places)


def _shared(starts: DataFrame) -> DataFrame:
    """(key, node, n, count): first shingles of several sets; one shuffle, by the shingle."""
    once = starts.repartition("key").dropDuplicates(["key", "node"])
    return once.withColumn("count", F.count("*").over(W.partitionBy("key"))).where("count > 1")


class _Links:
    """Pairs found alike so far, and the components they make."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, likeness: float, shelf: Shelf):
        self.docs, self.nodes, self.likeness, self.shelf = docs, nodes, likeness, shelf
        self.links: DataFrame | None = None
        self.roots: DataFrame | None = None

    def add(self, pairs: DataFrame) -> None:
        """`pairs`: columns a, b; those whose likeness is high enough become links."""
        own = Shelf(self.shelf.spark)
        pairs = own.put(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = own.put(self.nodes.join(ends, "node", "left_semi"))
        sets = own.put(_sets(self.docs, wanted))
        both = pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")
        shared = F.size(F.array_intersect("left", "right"))
        found = both.select("a", "b", shared.alias("shared"), (F.size("left") + F.size("right")).alias("total"))
        alike = self.shelf.put(
            found.where(F.col("shared") / (F.col("total") - F.col("shared")) >= self.likeness).select("a", "b")
        )
        own.clear()
        self.links = alike if self.links is None else self.links.unionAll(alike)
        self.roots = self.shelf.put(connected_components(self.links, "a", "b"))

    def apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose ends are not linked yet."""
        left, right = self.roots.toDF("a", "a_root"), self.roots.toDF("b", "b_root")
        rooted = pairs.join(left, "a", "left").join(right, "b", "left")
        return rooted.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")

    def split(self, crowded: DataFrame) -> DataFrame:
        """Rows of the keys that still hold sets of several components, with their root."""
        rooted = self.shelf.put(
            crowded.select("key", "node", "n", "left").join(self.roots, "node", "left")
            .select("key", "node", "n", "left", F.coalesce("root", "node").alias("root"))
        )
        several = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        return self.shelf.put(rooted.join(several.where("low <> high").select("key"), "key", "left_semi"))


def _paired(left: DataFrame, right: DataFrame, likeness: float) -> DataFrame:
    """Pairs of different sets under one key whose sizes allow the likeness."""
    a, b = left.withColumnsRenamed({"node": "a", "n": "m"}), right.withColumnRenamed("node", "b")
    sizes = F.least("m", "n") >= F.greatest("m", "n") * likeness - 1e-6
    return a.join(b, "key").where((F.col("a") != F.col("b")) & sizes)


def _enough(common: Column, likeness: float) -> Column:
    """Whether sets of m and n shingles, `common` of them among the first of both, may be alike.

    What two sets share lies among the first shingles of both or behind the first ones of one.
    """
    behind = F.ceil(F.greatest("m", "n") * likeness - 1e-9) - 1
    needed = (F.col("m") + F.col("n")) * (likeness / (1 + likeness)) - 1e-6
    return common + behind >= needed


def _folded(sketch: str) -> Column:
    """The sketch's halves laid over each other: that of half as many places."""
    halves = F.slice(sketch, 1, FOLDED_WORDS), F.slice(sketch, FOLDED_WORDS + 1, FOLDED_WORDS)
    return F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y))


def _sketches_near(likeness: float) -> Column:
    """Whether sets of m and n shingles may be alike by their sketches, the folded ones first."""
    most = (F.col("m") + F.col("n")) * ((1 - likeness) / (1 + likeness)) + 1e-6
    words = [F.bit_count(F.col("a_folded")[k].bitwiseXOR(F.col("b_folded")[k])) for k in range(FOLDED_WORDS)]
    each = F.zip_with("a_sketch", "b_sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return (reduce(Column.__add__, words) <= most) & (F.aggregate(each, F.lit(0), Column.__add__) <= most)


def _promising(few: DataFrame, likeness: float) -> DataFrame:
    """Pairs under uncrowded keys that may have enough shingles in common.

    Of the first shingles those under uncrowded keys are counted, the crowded ones at most all
    shared.
    """
    a = few.withColumnsRenamed({"crowd": "a_crowd"})
    met = _paired(a, few.withColumnsRenamed({"crowd": "b_crowd"}), likeness).where("a < b")
    pairs = met.groupBy("a", "b").agg(
        F.count("*").alias("common"), F.first("m").alias("m"), F.first("n").alias("n"),
        F.first(F.least("a_crowd", "b_crowd")).alias("crowd"),
    )
    return pairs.where(_enough(F.col("common") + F.col("crowd"), likeness)).select("a", "b")


def _crowded_pairs(one: DataFrame, other: DataFrame, likeness: float) -> DataFrame:
    """Pairs under crowded keys that may be alike though they share no uncrowded one.

    Those that share one are among the promising pairs, or cannot be alike. Under the first
    crowded key that two sets share, they share no more than both have from it on.
    """
    pairs = _paired(one.withColumnRenamed("left", "a_left"), other.withColumnRenamed("left", "b_left"), likeness)
    return pairs.where(_enough(F.least("a_left", "b_left"), likeness))


def _led(rows: DataFrame, turn: int, likeness: float) -> DataFrame:
    leader = F.min_by(F.struct("node", "n", "left"), F.xxhash64("node", F.lit(turn))).alias("leader")
    leaders = rows.groupBy("key").agg(leader).select("key", "leader.*")
    return _crowded_pairs(rows.select("key", "node", "n", "left"), leaders, likeness).select("a", "b")


def _near_prints(nodes: DataFrame, shelf: Shelf) -> DataFrame:
    """(a, b): sets whose SimHashes are linked, each with the first set of its component."""
    linked = connected_components(near_pairs(nodes.select("fp")), "a", "b").toDF("print", "linked")
    rooted = shelf.put(
        nodes.join(linked, F.col("fp") == F.col("print"), "left")
        .select("node", F.coalesce("linked", "fp").alias("print_root"))
    )
    first = rooted.groupBy("print_root").agg(F.min("node").alias("a"))
    return rooted.join(first, "print_root").where("node <> a").select("a", F.col("node").alias("b"))


def components(docs: DataFrame, nodes: DataFrame, shared: DataFrame, likeness: float, shelf: Shelf) -> DataFrame:
    """(node, root) of all sets that have an alike one."""
    of_set = W.partitionBy("node")
    is_crowded = F.col("count") > BUCKET_ROWS
    rows = shelf.put(shared.withColumns({
        "crowd": F.sum(is_crowded.cast("long")).over(of_set),
        "left": F.row_number().over(of_set.orderBy(F.desc("count"), F.desc("key"))).cast("long"),
    }))
    few = rows.where(~is_crowded).select("key", "node", "n", "crowd")
    crowded = rows.where(is_crowded).select("key", "node", "n", "left")
    found = _Links(docs, nodes, likeness, shelf)
    found.add(_near_prints(nodes, shelf))
    rest = found.split(crowded)
    found.add(found.apart(_promising(few, likeness).unionAll(_led(rest, 0, likeness))))
    rest = found.split(rest)
    for turn in range(1, LEADER_ROUNDS):
        if rest.isEmpty():
            return found.roots
        found.add(_led(rest, turn, likeness))
        rest = found.split(rest)
    if rest.isEmpty():
        return found.roots
    main = (
        rest.groupBy("key", "root").count().groupBy("key")
        .agg(F.max_by("root", F.struct("count", "root")).alias("main"))
    )
    rest = shelf.put(rest.join(nodes.select("node", "sketch", _folded("sketch").alias("folded")), "node"))
    outside = rest.join(main, "key").where("root <> main").withColumnRenamed("root", "own")
    pairs = _crowded_pairs(
        outside.withColumnsRenamed({"sketch": "a_sketch", "folded": "a_folded"}),
        rest.withColumnsRenamed({"sketch": "b_sketch", "folded": "b_folded"}), likeness,
    )
    once = (F.col("root") == F.col("main")) | (F.col("a") < F.col("b"))
    found.add(pairs.where((F.col("own") != F.col("root")) & once).where(_sketches_near(likeness)).select("a", "b"))
    return found.roots


def alike(docs: DataFrame, also: tuple[Column, ...] = (), likeness: float = LIKENESS) -> DataFrame:
    """(doc_id, node, component_id, *also): one row per row of `docs`.

    component_id is the smallest non-null id of all documents that can be reached over pairs of
    at least `likeness`; null if all of them have null ids. Texts with the same shingles are one
    node. Null texts and texts without words are alike to each other only.
    """
    spark = docs.sparkSession
    free_shuffles(spark)
    shelf, result = Shelf(spark), Shelf(spark)
    like = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("content")).alias("like")
    stored = result.put(docs.select("doc_id", _identified("text").alias("s"), like, *also), keep=True)
    nodes = shelf.put(
        stored.select("s.node", "s.fp", "s.sketch", "doc_id", "like").groupBy("node")
        .agg(
            F.min("doc_id").alias("first"), F.min("like").alias("like"), F.min("fp").alias("fp"),
            F.first("sketch").alias("sketch"),
        )
    )
    last = _frequent(_starts(docs, likeness, NONE_LATE))
    free_shuffles(spark)
    shared = shelf.put(_shared(_starts(docs, likeness, last)))
    free_shuffles(spark)
    found = components(docs, nodes, shared, likeness, shelf)
    rooted = shelf.put(
        nodes.join(found, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = result.put(rooted.join(smallest, "root").select("node", "component_id"), keep=True)
    shelf.clear()
    marked = stored.withColumn("node", F.col("s.node")).drop("like", "s")
    return marked.join(named, "node").select(*marked.columns, "component_id")
