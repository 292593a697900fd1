"""MLlib's boosted trees for several labels over the same rows, grown together.

The trees are those `GBTClassifier` grows: its split candidates, its residuals, the split with the
greatest fall of variance, the first one on a tie. MLlib runs a job per level, tree and label over
rows of integers. Here each row is binned once to bytes, one job per level serves all labels, only the
smaller child of every split is summed up (the other one is its parent less that), and the counts at
the roots, which no round changes, are kept. Rows stay where they are; per level only sums per (node,
feature, bin) reach the driver.
"""

from __future__ import annotations

import pickle
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame, SparkSession

from ..functions.session import ensure_checkpoint_dir, scratch_folder

BLOCK_ROWS = 30_000
# Blocks per partition, at most; more partitions than this are summed up in steps, not on the driver.
BLOCKS_PER_PART, FEW_PARTS = 32, 64
# Rounds between two stored copies of the margins.
STORED_EVERY = 10
# A fall of variance below this share of the squared prediction is the rounding of sums, not a split.
NOISE = 1e-22
# A cut no bin exceeds: all rows go left.
NO_CUT = 2 ** 16 - 1


@dataclass(frozen=True)
class Label:
    """One label: its classifier's settings, the weight of a row of each class, the rows of each class."""

    name: str
    estimator: GBTClassifier
    fault: float
    normal: float
    rows: int
    faults: int


@dataclass(frozen=True)
class Columns:
    """Binned features of one label: positions in the block, MLlib's features and thresholds."""

    places: list[int]
    features: list[int]
    thresholds: list[np.ndarray]


# --- on the rows --------------------------------------------------------------------------


def pulls_of(truths: np.ndarray, margins: np.ndarray, labels: list[Label], first: bool) -> np.ndarray:
    """Weighted residuals a tree is fitted to: of the label (1, -1) at first, then the log loss's descent."""
    pulls = np.empty(truths.shape)
    for k, label in enumerate(labels):
        sign = np.where(truths[k], 1.0, -1.0)
        weight = np.where(truths[k], label.fault, label.normal)
        if first:
            pulls[k] = weight * sign
            continue
        with np.errstate(over="ignore"):
            pulls[k] = weight * (4.0 * sign / (1.0 + np.exp(2.0 * sign * margins[k])))
    return pulls


def nodes_of(bins: np.ndarray, column: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """Each row's node `depth` levels down; comparing bytes node by node is faster than looking cuts up."""
    node = np.ones(bins.shape[1], dtype=np.min_scalar_type((2 << depth) - 1))
    for level in range(depth):
        right = np.zeros(bins.shape[1], dtype=bool)
        for number in range(1 << level, 2 << level):
            if cut[number] == NO_CUT:
                continue
            here = bins[column[number]] > int(cut[number])
            if level:
                here &= node == number
            right |= here
        node += node
        node += right
    return node


def _counted(bins, truth, pull, depth, column, cut, wanted, places, width, known):
    """Sums of a block for one label: of the pulls, and per (feature, wanted node, bin) of pulls, rows and
    faults. Counts are left out when known."""
    size = len(wanted) * width
    sums = np.zeros((len(places), size))
    counts = None if known else np.zeros((2, len(places), size), dtype=np.int64)
    total = pull.sum()
    start, chosen = np.zeros(len(pull), dtype=np.intp), None
    if depth:
        slots = np.full(2 << depth, -1, dtype=np.intp)
        slots[wanted] = np.arange(len(wanted)) * width
        start = slots[nodes_of(bins, column, cut, depth)]
        chosen = np.flatnonzero(start >= 0)
        start, pull, truth = start[chosen], pull[chosen], truth[chosen]
    faults = np.flatnonzero(truth)
    for k, place in enumerate(places):
        at = start + (bins[place] if chosen is None else bins[place][chosen])
        sums[k] = np.bincount(at, pull, size)
        if not known:
            counts[0, k] = np.bincount(at, minlength=size)
            counts[1, k] = np.bincount(at[faults], minlength=size)
    return [total, sums, counts]


def _plus(one, other):
    if one is None or other is None:
        return None
    if isinstance(one, list):
        return [_plus(a, b) for a, b in zip(one, other)]
    return one + other


def _level(pairs, depth, tasks):
    """Sums of a partition: per label what `_counted` gives, then the leaves' squares of the tree before."""
    total = None
    for (bins, truths), (_, pulls, squares) in pairs:
        sums = [
            None if task is None else _counted(bins, truths[k], pulls[k], depth, *task)
            for k, task in enumerate(tasks)
        ]
        part = [*sums, squares]
        total = part if total is None else _plus(total, part)
    if total is not None:
        yield total


def _begun(block, labels):
    margins = np.zeros(block[1].shape)
    return margins, pulls_of(block[1], margins, labels, True), None


def _updated(pair, labels, depth, trees, step):
    """A block's margins and pulls after a round, and the weighted squares of the residuals its leaves had."""
    (bins, truths), (margins, pulls, _) = pair
    after, squares = np.empty_like(margins), np.zeros((len(labels), 1 << depth))
    for k, (column, cut, values) in enumerate(trees):
        place = nodes_of(bins, column, cut, depth).astype(np.intp) - (1 << depth)
        square = pulls[k] * pulls[k] / np.where(truths[k], labels[k].fault, labels[k].normal)
        squares[k] = np.bincount(place, square, 1 << depth)
        after[k] = margins[k] + step * values[place]
    return after, pulls_of(truths, after, labels, False), squares


def _packed(batches, columns, names, labels, width):
    """Batches of rows as numbered blocks of bins (a byte per binned feature and row) and labels."""
    import pyarrow as pa

    held, size, number = [], 0, 0
    task = TaskContext.get().partitionId()

    def block():
        bins = np.concatenate([b for b, _ in held], axis=1)
        truths = np.concatenate([t for _, t in held], axis=1)
        return pa.RecordBatch.from_pydict({
            "part": pa.array([task], pa.int32()), "number": pa.array([number], pa.int32()),
            "block": pa.array([pickle.dumps((bins, truths), protocol=5)], pa.binary()),
        })

    for batch in batches:
        values = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(names))]
        truths = [batch.column(len(names) + i).to_numpy(zero_copy_only=False) for i in range(len(labels))]
        bins = [np.searchsorted(edges, values[feature]) for feature, edges in columns]
        held.append((
            np.array(bins, dtype=np.min_scalar_type(width - 1)).reshape(len(columns), batch.num_rows),
            np.array(truths, dtype=bool).reshape(len(labels), batch.num_rows),
        ))
        size += batch.num_rows
        if size >= BLOCK_ROWS:
            yield block()
            held, size, number = [], 0, number + 1
    if size:
        yield block()


def _in_order(rows):
    for row in sorted(rows, key=lambda r: (r["part"], r["number"])):
        yield pickle.loads(row["block"])


# --- on the driver ------------------------------------------------------------------------


@dataclass
class Node:
    """Weight, weighted residuals and their squares, rows and faults; a split once there is one."""

    weight: float
    pull: float
    rows: int
    faults: int
    squares: float = 0.0
    split: tuple[int, float, float] | None = None  # feature, threshold, gain

    @property
    def value(self) -> float:
        return self.pull / self.weight if self.weight else 0.0

    @property
    def variance(self) -> float:
        return (self.squares - self.pull * self.pull / self.weight) / self.weight if self.weight else 0.0


@dataclass
class Tree:
    """A growing tree; nodes by heap number, the root is 1. A node without a split sends all rows left."""

    label: Label
    columns: Columns
    depth: int
    first: bool
    width: int
    nodes: dict[int, Node] = field(default_factory=dict)
    sums: dict[int, list[np.ndarray]] = field(default_factory=dict)

    def __post_init__(self):
        self.column = np.zeros(1 << self.depth, dtype=np.intp)
        self.cut = np.full(1 << self.depth, NO_CUT, dtype=np.uint16)

    def wanted(self, depth: int) -> list[int]:
        """The nodes to sum up: the root, or the child with fewer rows of each split."""
        if depth == 0:
            return [1]
        return [
            min((2 * n, 2 * n + 1), key=lambda child: self.nodes[child].rows)
            for n in range(1 << depth >> 1, 1 << depth) if n in self.nodes and self.nodes[n].split
        ]

    def take(self, wanted: list[int], total, pulls, counts) -> None:
        """The sums of a level; splits its nodes."""
        found, label = {}, self.label
        if wanted == [1]:
            pull = self._classes(label.rows, label.faults) if self.first else float(total)
            self.nodes[1] = Node(float(self._weight(label.rows, label.faults)), pull, label.rows, label.faults)
        for slot, number in enumerate(wanted):
            sums = [s.reshape(len(s), len(wanted), self.width)[:, slot] for s in (pulls, *counts)]
            found[number] = sums
            if number > 1:
                other = [whole - part for whole, part in zip(self.sums[number >> 1], sums)]
                other[0][other[1] == 0] = 0.0  # bins without rows hold nothing, not a rounding error
                found[number ^ 1] = other
        self.sums = found
        for number, sums in found.items():
            if self.columns.places:
                self._split(number, self.nodes[number], *sums)

    def _split(self, number: int, node: Node, pulls, rows, faults) -> None:
        pull, count, fault = (np.cumsum(s, axis=1) for s in (pulls, rows, faults))
        rest = node.pull - pull
        left, right = self._weight(count, fault), self._weight(node.rows - count, node.faults - fault)
        if self.first:
            pull, rest = self._classes(count, fault), self._classes(node.rows - count, node.faults - fault)
        with np.errstate(divide="ignore", invalid="ignore"):
            apart = pull / left - rest / right
            gain = left * right / (node.weight * node.weight) * apart * apart
        gain[(count == 0) | (count == node.rows)] = -1.0
        k, cut = divmod(int(np.argmax(gain)), self.width)
        if not gain[k, cut] > NOISE * node.value * node.value:
            return
        node.split = (self.columns.features[k], float(self.columns.thresholds[k][cut]), float(gain[k, cut]))
        self.column[number], self.cut[number] = self.columns.places[k], cut
        self.nodes[2 * number] = Node(
            float(left[k, cut]), float(pull[k, cut]), int(count[k, cut]), int(fault[k, cut])
        )
        self.nodes[2 * number + 1] = Node(
            float(right[k, cut]), float(rest[k, cut]),
            node.rows - int(count[k, cut]), node.faults - int(fault[k, cut]),
        )

    def _weight(self, rows, faults):
        return self.label.fault * faults + self.label.normal * (rows - faults)

    def _classes(self, rows, faults):
        """Weighted residuals of the first round, where they are the classes: exact, so pure nodes are flat."""
        return self.label.fault * faults - self.label.normal * (rows - faults)

    def _last(self, number: int) -> int:
        """Where the rows of a leaf end, from the left: those of an early leaf go on leftwards."""
        return (number << (self.depth + 1 - number.bit_length())) - (1 << self.depth)

    def values(self) -> np.ndarray:
        """Predictions of the last level."""
        found = np.zeros(1 << self.depth)
        for number, node in self.nodes.items():
            if not node.split:
                found[self._last(number)] = node.value
        return found

    def close(self, squares: np.ndarray) -> None:
        """Squares of the leaves, and from them of all nodes; the sums are not needed any more."""
        for number in sorted(self.nodes, reverse=True):
            node = self.nodes[number]
            if node.split:
                node.squares = self.nodes[2 * number].squares + self.nodes[2 * number + 1].squares
            else:
                node.squares = float(squares[self._last(number)])
        self.sums = {}


def _module(spark: SparkSession, name: str):
    """A Scala object."""
    return spark._jvm.java.lang.Class.forName(f"{name}$").getField("MODULE$").get(None)


def split_candidates(weighted: DataFrame, estimator: GBTClassifier) -> list[np.ndarray]:
    """MLlib's thresholds per feature; none for a feature with one value."""
    spark = weighted.sparkSession
    jvm = spark._jvm
    estimator._transfer_params_to_java()
    java = estimator._java_obj
    kind = jvm.org.apache.spark.mllib.tree.configuration.Algo.Classification()
    strategy = java.getOldBoostingStrategy(jvm.PythonUtils.toScalaMap({}), kind).treeStrategy()
    instances = _module(spark, "org.apache.spark.ml.util.DatasetUtils").extractInstances(
        java, weighted._jdf, jvm.scala.Option.apply(2)
    )
    metadata = jvm.org.apache.spark.ml.tree.impl.DecisionTreeMetadata.buildMetadata(instances, strategy, 1, "all")
    splits = _module(spark, "org.apache.spark.ml.tree.impl.RandomForest").findSplits(
        instances, metadata, estimator.getSeed()
    )
    return [np.array([split.threshold() for split in feature], dtype=float) for feature in splits]


def _shared_columns(candidates: list[list[np.ndarray]]) -> tuple[list, list[Columns]]:
    """The binned columns of a block, one for equal thresholds of a feature, and each label's share."""
    places, columns, of_labels = {}, [], []
    for thresholds in candidates:
        own = Columns([], [], [])
        for feature, edges in enumerate(thresholds):
            if not len(edges):
                continue
            key = (feature, edges.tobytes())
            if key not in places:
                places[key] = len(columns)
                columns.append((feature, edges))
            own.places.append(places[key])
            own.features.append(feature)
            own.thresholds.append(edges)
        of_labels.append(own)
    return columns, of_labels


def _one_by_one(rdd):
    """Blocks are large: they are stored and moved one at a time, so RDDs of them zip as they are."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


def _summed(parts):
    if parts.getNumPartitions() > FEW_PARTS:
        return parts.treeReduce(_plus)
    return reduce(_plus, parts.collect())


def _dropped(spark: SparkSession, path: str | None) -> None:
    if path:
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def grown(rows: DataFrame, names: list[str], labels: list[Label], truths: list[str], candidates) -> list[list[Tree]]:
    """All rounds of trees of every label, from rows of feature and label columns."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    plain = labels[0].estimator
    rounds, depth, step = plain.getMaxIter(), plain.getMaxDepth(), plain.getStepSize()
    columns, of_labels = _shared_columns(candidates)
    # MLlib finds about 31 thresholds of a feature; weights can make it some more.
    bins = 1 + max((len(edges) for _, edges in columns), default=0)
    blocks = -(-labels[0].rows // BLOCK_ROWS)
    width = max(1, min(blocks, spark.sparkContext.defaultParallelism), -(-blocks // BLOCKS_PER_PART))
    pack = partial(_packed, columns=columns, names=names, labels=truths, width=bins)
    numbered = rows.select(*names, *truths).mapInArrow(pack, "part int, number int, block binary")
    base = _one_by_one(numbered.rdd.repartition(width).mapPartitions(_in_order)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    # What tasks need of a label is its weights, not the classifier.
    weights = [Label(x.name, None, x.fault, x.normal, x.rows, x.faults) for x in labels]
    state = _one_by_one(base.map(partial(_begun, labels=weights)))
    found, root_counts, kept, stored = [], None, None, None
    for number in range(rounds):
        trees = [Tree(label, own, depth, number == 0, bins) for label, own in zip(weights, of_labels)]
        for level in range(depth):
            wanted = [tree.wanted(level) for tree in trees]
            if not any(wanted):
                break
            known = level == 0 and root_counts is not None
            tasks = [
                (tree.column, tree.cut, nodes, tree.columns.places, bins, known) if nodes else None
                for tree, nodes in zip(trees, wanted)
            ]
            *sums, squares = _summed(base.zip(state).mapPartitions(partial(_level, depth=level, tasks=tasks)))
            if level == 0:
                if number == 0:
                    root_counts = [part[2] for part in sums]
                else:
                    _close(found[-1], squares)
                    # The round's margins are stored now: those before and their file can go.
                    if kept is not None:
                        kept.unpersist()
                    kept = state
                    if state.getCheckpointFile():
                        _dropped(spark, stored)
                        stored = state.getCheckpointFile()
                sums = [[*part[:2], counts] for part, counts in zip(sums, root_counts)]
            for tree, nodes, part in zip(trees, wanted, sums):
                if part is not None:
                    tree.take(nodes, *part)
        found.append(trees)
        moves = [(tree.column, tree.cut, tree.values()) for tree in trees]
        update = partial(_updated, labels=weights, depth=depth, trees=moves, step=step if number else 1.0)
        state = _one_by_one(base.zip(state).map(update)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
        if number % STORED_EVERY == STORED_EVERY - 1 and number + 1 < rounds:
            state.checkpoint()
    _close(found[-1], _summed(state.map(lambda after: after[2])))
    for rdd in (kept, state, base):
        if rdd is not None:
            rdd.unpersist()
    _dropped(spark, stored)
    return [list(of_label) for of_label in zip(*found)]


def _close(trees: list[Tree], squares: np.ndarray) -> None:
    for tree, own in zip(trees, squares):
        tree.close(own)


def _saved_nodes(number: int, tree: Tree) -> list[tuple]:
    """The nodes of a tree as MLlib stores them, leaves of equal values merged as MLlib does."""
    merged = {}

    def value_of_leaf(at: int):
        if at not in merged:
            node = tree.nodes[at]
            left, right = (value_of_leaf(2 * at), value_of_leaf(2 * at + 1)) if node.split else (node.value,) * 2
            merged[at] = left if left is not None and left == right else None
        return merged[at]

    found = []

    def stored(at: int) -> int:
        own, node, value = len(found), tree.nodes[at], value_of_leaf(at)
        stats = (node.variance, [node.weight, node.pull, node.squares], node.rows)
        found.append(None)
        if value is not None:
            found[own] = (number, (own, value, *stats, -1.0, -1, -1, (-1, [], -1)))
        else:
            feature, threshold, gain = node.split
            left, right = stored(2 * at), stored(2 * at + 1)
            found[own] = (number, (own, node.value, *stats, gain, left, right, (feature, [threshold], -1)))
        return own

    stored(1)
    return found


def as_model(spark: SparkSession, estimator: GBTClassifier, trees: list[Tree], features: int):
    """Grown trees as MLlib's model: one of empty trees is stored, gets their nodes and is read back."""
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    ml = jvm.org.apache.spark.ml
    calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(array(jvm.double, 3), 0)
    empty = ml.tree.LeafNode(0.0, 0.0, calculator)
    made = array(ml.regression.DecisionTreeRegressionModel, len(trees))
    shares = array(jvm.double, len(trees))
    for k in range(len(trees)):
        made[k] = ml.regression.DecisionTreeRegressionModel(empty, features)
        shares[k] = estimator.getStepSize() if k else 1.0
    java = ml.classification.GBTClassificationModel(estimator.uid, made, shares, features)
    folder = scratch_folder(spark, "trees")
    estimator._copyValues(estimator._create_model(java)).write().save(folder)
    schema = spark.read.parquet(f"{folder}/data").schema
    nodes = [node for k, tree in enumerate(trees) for node in _saved_nodes(k, tree)]
    spark.createDataFrame(nodes, schema).write.mode("overwrite").parquet(f"{folder}/data")
    return GBTClassificationModel.load(folder)


def boosted(rows: DataFrame, names: list[str], truths: list[str], labels: list[Label], weighted: list[DataFrame]) -> dict:
    """A model per label. `rows` holds the feature columns `names` and a label column per label;
    `weighted` per label the vectors, label and weight its classifier would be fitted on."""
    if not labels:
        return {}
    spark = rows.sparkSession
    with ThreadPoolExecutor(len(labels)) as pool:
        candidates = list(pool.map(split_candidates, weighted, [label.estimator for label in labels]))
        trees = grown(rows, names, labels, truths, candidates)
        models = pool.map(lambda label, own: as_model(spark, label.estimator, own, len(names)), labels, trees)
        return {label.name: model for label, model in zip(labels, models)}
