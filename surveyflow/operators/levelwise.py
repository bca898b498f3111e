"""A random forest grown level by level, the same from the same rows wherever they lie.

Every choice follows from hashes: how often a row is in the bag of a tree from (seed, tree, key), the features that a node
may split on from (seed, tree, node). A level is one aggregate over (tree, node, feature, bin, class): tasks count into
arrays whose size follows from the parameters, the arrays of a node are added and searched for its best cut in one place,
and a cut a node is all that reaches the driver.
"""

from __future__ import annotations

import hashlib
import json
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyflow.operators.bins import feature_bins
from surveyflow.sources.scratch import materialize, scratch_path

# Functions of this module travel to the executors by value, so Python workers need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRIME = 2**31 - 1
#: Cells of the counting arrays of a task: 64 MB. Levels with more nodes are counted in several passes.
CELLS = 1 << 23
BATCH = 1 << 16


@dataclass(frozen=True)
class ForestRule:
    trees: int
    depth: int
    bins: int
    classes: int
    per_node: int
    bootstrap: bool = True
    seed: int = 42


def _hashed(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % PRIME


def bag_number(key: Column, seed: int) -> Column:
    """A number below 2^31 - 1 that stands for the key in all bags."""
    digits = F.substring(F.md5(F.concat(F.lit(f"bag:{seed}:"), key.cast("string"))), 1, 8)
    return F.conv(digits, 16, 10).cast("long") % PRIME


def poisson_steps() -> np.ndarray:
    """Numbers from which on a row is in a bag once, twice and so on: the distribution of Poisson(1)."""
    shares = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.floor(shares * PRIME).astype(np.int64)


def bag_weights(numbers: np.ndarray, seed: int, tree: int, bootstrap: bool) -> np.ndarray:
    """How often each row is in the bag of a tree."""
    if not bootstrap:
        return np.ones(len(numbers), dtype=np.int64)
    a, b = _hashed(f"{seed}:{tree}:a") or 1, _hashed(f"{seed}:{tree}:b")
    place = numbers * a + b
    if place.dtype.kind != "i":  # a null key among them
        return np.searchsorted(poisson_steps(), place % PRIME, side="right")
    for _ in range(2):  # the remainder by a prime of the form 2^31 - 1, without a division
        place = (place & PRIME) + (place >> 31)
    place[place >= PRIME] -= PRIME
    weights = np.zeros(len(place), dtype=np.int64)
    for step in poisson_steps():
        weights += place >= step
    return weights


def node_features(seed: int, tree: int, node: int, features: int, chosen: int) -> list[int]:
    """The features a node may split on, ascending: those with the smallest hashes."""
    if chosen >= features:
        return list(range(features))
    ranked = sorted((hashlib.md5(f"{seed}:{tree}:{node}:{f}".encode()).hexdigest(), f) for f in range(features))
    return sorted(f for _, f in ranked[:chosen])


@dataclass
class Node:
    counts: np.ndarray
    feature: int = -1
    bin: int = -1


def _score(counts: Sequence) -> np.ndarray | float:
    """Sum of squares over sum, the larger the purer; classes in order, so that it is the same everywhere."""
    squares, total = counts[0] * counts[0], counts[0]
    for n in counts[1:]:
        squares, total = squares + n * n, total + n
    return squares / total


@dataclass
class Level:
    """The open nodes of one pass and where their cells lie in the counting array."""

    depth: int
    nodes: list[tuple[int, int]]  # (tree, node), by tree
    subsets: np.ndarray  # (nodes, slots): features
    offsets: np.ndarray  # (nodes, slots): first cell
    ends: np.ndarray  # (nodes,): cell after the last
    numbers: dict[int, np.ndarray] = field(default_factory=dict)  # tree: number of each node of the level, or -1

    @classmethod
    def of(cls, depth: int, nodes, widths: np.ndarray, rule: ForestRule, features: int) -> Level:
        subsets = np.array([node_features(rule.seed, t, n, features, rule.per_node) for t, n in nodes])
        sizes = widths[subsets] * rule.classes
        starts = np.concatenate([[0], np.cumsum(sizes.ravel())])
        level = cls(depth, nodes, subsets, starts[:-1].reshape(sizes.shape), starts[sizes.shape[1] :: sizes.shape[1]])
        for number, (tree, node) in enumerate(nodes):
            held = level.numbers.setdefault(tree, np.full(1 << depth, -1, dtype=np.int64))
            held[node - (1 << depth)] = number
        return level


def _passes(nodes, widths: np.ndarray, rule: ForestRule, features: int) -> Iterator[list]:
    """Nodes in groups whose cells fit the counting array."""
    widest = int(np.sort(widths)[::-1][: rule.per_node].sum()) * rule.classes
    step = max(1, CELLS // widest)
    for start in range(0, len(nodes), step):
        yield nodes[start : start + step]


def _walk(splits: dict, tree: int, depth: int, bins: np.ndarray, base: np.ndarray) -> np.ndarray:
    """The node of ``depth`` that each row falls into, from all bins in a row and where those of each row start. A path that
    ends above goes on to the left, to nodes that nothing is counted for."""
    features, cuts = splits[tree]
    ends = features < 0
    features, cuts = np.where(ends, 0, features), np.where(ends, 65535, cuts).astype(np.uint16)
    node = np.ones(len(base), dtype=np.int64)
    for _ in range(depth):
        right = bins.take(base + features.take(node)) > cuts.take(node)
        node += node
        node += right
    return node


_COUNTED = pa.schema([("number", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary())])
_BEST = pa.schema([
    ("number", pa.int32()), ("total", pa.list_(pa.float64())), ("left", pa.list_(pa.float64())), ("feature", pa.int32()),
    ("bin", pa.int32()), ("score", pa.float64()),
])


def _count_level(rows: DataFrame, level: Level, splits: dict, rule: ForestRule, features: int) -> DataFrame:
    """Counts of the cells of every open node, added up in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(int(level.ends[-1]), dtype=np.int64)
        subsets, offsets = np.ascontiguousarray(level.subsets.T), np.ascontiguousarray(level.offsets.T)

        def count(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held)
            numbers, label = table.column("number").to_numpy(), table.column("label").to_numpy().astype(np.int64)
            bins = np.frombuffer(b"".join(table.column("bins").to_pylist()), dtype="<u2")
            for tree, of_node in level.numbers.items():
                weight = bag_weights(numbers, rule.seed, tree, rule.bootstrap)
                kept = np.flatnonzero(weight)
                number = of_node.take(_walk(splits, tree, level.depth, bins, kept * features) - (1 << level.depth))
                inside = np.flatnonzero(number >= 0)
                if not len(inside):
                    continue
                kept, number = kept.take(inside), number.take(inside)
                first, last = int(level.offsets[number.min(), 0]), int(level.ends[number.max()])
                base, own = kept * features, label.take(kept) - first
                cells = np.empty((len(subsets), len(kept)), dtype=np.int64)
                for held_cells, subset, offset in zip(cells, subsets, offsets):
                    np.multiply(bins.take(base + subset.take(number)), rule.classes, out=held_cells, dtype=np.int64)
                    held_cells += offset.take(number)
                    held_cells += own
                weights = np.tile(weight.take(kept).astype(np.float64), len(subsets))
                total[first:last] += np.bincount(cells.ravel(), weights=weights, minlength=last - first).astype(np.int64)

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BATCH:
                count(held)
                held, size = [], 0
        if size:
            count(held)
        made: list[tuple] = []
        for number, (start, end) in enumerate(zip(level.offsets[:, 0], level.ends)):
            cells = np.flatnonzero(total[start:end])
            if len(cells):
                made.append((number, cells.astype("<u4").tobytes(), total[start:end][cells].tobytes()))
            if len(made) == 256 or (made and number == len(level.ends) - 1):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), _COUNTED.types)], schema=_COUNTED)
                made = []

    return rows.mapInArrow(run, "number int, cells binary, counts binary")


def _best_cuts(counted: DataFrame, level: Level, widths: np.ndarray, rule: ForestRule) -> DataFrame:
    """Per node its class counts and the cut of the greatest score; ties go to the first feature, then the lowest cut."""

    def search(number: int, cells: np.ndarray) -> tuple:
        best = (number, None, None, -1, -1, -1.0)
        at = 0
        for feature in level.subsets[number]:
            size = int(widths[feature]) * rule.classes
            held = cells[at : at + size].reshape(-1, rule.classes).astype(np.float64)
            at += size
            upto = held.cumsum(axis=0)
            every = upto[-1]
            if best[1] is None:
                best = (number, every.tolist(), None, -1, -1, -1.0)
            left, right = upto[:-1].T, (every - upto[:-1]).T
            if not left.shape[1]:
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                score = _score(left) + _score(right)
            score = np.where((left.sum(axis=0) > 0) & (right.sum(axis=0) > 0), score, -1.0)
            cut = int(np.argmax(score))
            if score[cut] > best[5]:
                best = (number, every.tolist(), left[:, cut].tolist(), int(feature), cut, float(score[cut]))
        return best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cells = None, None

        def found():
            row = search(now, cells)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _BEST.types)], schema=_BEST)

        for batch in batches:
            for number, at, counts in zip(*(batch.column(c).to_pylist() for c in _COUNTED.names)):
                if number != now:
                    if now is not None:
                        yield found()
                    now, cells = number, np.zeros(int(level.ends[number] - level.offsets[number, 0]), dtype=np.int64)
                cells[np.frombuffer(at, dtype="<u4")] += np.frombuffer(counts, dtype=np.int64)
        if now is not None:
            yield found()

    schema = "number int, total array<double>, left array<double>, feature int, bin int, score double"
    return counted.repartition("number").sortWithinPartitions("number").mapInArrow(run, schema)


def binned_rows(train: DataFrame, key: str, label: str, features: str, cuts: list[np.ndarray], seed: int) -> DataFrame:
    """(number, label, bins): the rows as the levels read them, two bytes a feature; spread evenly, however few files they
    come from, and stored."""
    rows = train.select(bag_number(F.col(key), seed).alias("number"), F.col(label).cast("int").alias("label"), F.col(features).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
            bins = np.empty(values.shape, dtype="<u2")
            for f, edges in enumerate(cuts):
                bins[:, f] = np.searchsorted(edges, values[:, f], side="left")
            data = pa.array([row.tobytes() for row in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("number"), batch.column("label"), data], names=["number", "label", "bins"])

    return materialize(rows.mapInArrow(run, "number long, label int, bins binary").repartition("number"), "binned")


def grow(rows: DataFrame, widths: np.ndarray, rule: ForestRule) -> list[dict[int, Node]]:
    """The nodes of every tree by number (root 1, children 2n and 2n + 1) from stored (number, label, bins)."""
    trees: list[dict[int, Node]] = [{} for _ in range(rule.trees)]
    size = 1 << rule.depth + 1
    splits = {t: (np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int64)) for t in range(rule.trees)}
    open_nodes = [(t, 1) for t in range(rule.trees)]
    for depth in range(rule.depth):
        children = []
        for nodes in _passes(open_nodes, widths, rule, len(widths)):
            level = Level.of(depth, nodes, widths, rule, len(widths))
            counted = _count_level(rows, level, splits, rule, len(widths))
            for r in _best_cuts(counted, level, widths, rule).collect():
                tree, number = nodes[r["number"]]
                total = np.array(r["total"])
                node = trees[tree].setdefault(number, Node(total))
                if r["left"] is None or r["score"] <= _score(total):
                    continue
                node.feature, node.bin = r["feature"], r["bin"]
                left = np.array(r["left"])
                for side, counts in ((0, left), (1, total - left)):
                    trees[tree][2 * number + side] = Node(counts)
                    if np.count_nonzero(counts) > 1:
                        children.append((tree, 2 * number + side))
        for tree, number in open_nodes:
            node = trees[tree][number]
            splits[tree][0][number], splits[tree][1][number] = node.feature, node.bin
        open_nodes = sorted(children)
        if not open_nodes:
            break
    return trees


def _gini(counts: np.ndarray) -> float:
    total = float(counts.sum())
    return 1.0 - sum((float(n) / total) ** 2 for n in counts)


_NODE = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: long, "
    "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, "
    "leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def _stored_nodes(tree: int, nodes: dict[int, Node], cuts: list[np.ndarray]) -> list[tuple]:
    """The nodes of a tree as the library stores them: numbered in preorder, -1 for what a leaf lacks."""
    order: list[int] = []
    stack = [1]
    while stack:
        number = stack.pop()
        order.append(number)
        if nodes[number].feature >= 0:
            stack += [2 * number + 1, 2 * number]
    place = {number: i for i, number in enumerate(order)}
    rows = []
    for number in order:
        node = nodes[number]
        total, gini = float(node.counts.sum()), _gini(node.counts)
        gain, below, split = -1.0, (-1, -1), (-1, [], -1)
        if node.feature >= 0:
            left, right = nodes[2 * number].counts, nodes[2 * number + 1].counts
            gain = gini - float(left.sum()) / total * _gini(left) - float(right.sum()) / total * _gini(right)
            below = place[2 * number], place[2 * number + 1]
            split = (node.feature, [float(cuts[node.feature][node.bin])], -1)
        counts = [float(n) for n in node.counts]
        rows.append((tree, (place[number], float(np.argmax(node.counts)), gini, counts, int(total), gain, *below, split)))
    return rows


def as_library_model(
    spark: SparkSession, trees: list[dict[int, Node]], cuts: list[np.ndarray], rule: ForestRule, **columns: str
) -> RandomForestClassificationModel:
    """The forest as the library's model: written in its storage format and loaded, so that it scores, explains and is
    saved like any other. The number of nodes is bounded by the parameters."""
    path = scratch_path(spark, "forest")
    about = {"timestamp": 0, "sparkVersion": spark.version}
    params = {"maxDepth": rule.depth, "maxBins": rule.bins, "seed": rule.seed, "impurity": "gini"}
    defaults = {
        "cacheNodeIds": False, "checkpointInterval": 10, "featuresCol": "features", "labelCol": "label", "leafCol": "",
        "maxMemoryInMB": 256, "minInfoGain": 0.0, "minInstancesPerNode": 1, "minWeightFractionPerNode": 0.0,
        "predictionCol": "prediction", "probabilityCol": "probability", "rawPredictionCol": "rawPrediction",
    }
    of_forest = {"bootstrap": rule.bootstrap, "featureSubsetStrategy": str(rule.per_node), "numTrees": rule.trees, "subsamplingRate": 1.0}
    kind = "org.apache.spark.ml.classification."
    metadata = {
        "class": f"{kind}RandomForestClassificationModel", **about, "uid": "rfc_levelwise", "paramMap": params | of_forest | columns,
        "defaultParamMap": defaults, "numFeatures": len(cuts), "numClasses": rule.classes, "numTrees": rule.trees,
    }
    each = [
        json.dumps({"class": f"{kind}DecisionTreeClassificationModel", **about, "uid": f"dtc_levelwise_{t}", "paramMap": params, "defaultParamMap": defaults})
        for t in range(rule.trees)
    ]
    nodes = [row for t, held in enumerate(trees) for row in _stored_nodes(t, held, cuts)]
    spark.createDataFrame([(json.dumps(metadata),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(nodes, _NODE).coalesce(1).write.parquet(f"{path}/data")
    stored = [(t, text, 1.0) for t, text in enumerate(each)]
    spark.createDataFrame(stored, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    return RandomForestClassificationModel.load(path)


def splits_of(model: RandomForestClassificationModel) -> DataFrame:
    """(tree, node, feature, cut) of a model's splits, nodes numbered from the root 1 with children 2n and 2n + 1."""
    spark, path = SparkSession.active(), scratch_path(SparkSession.active(), "splits")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    found, level = [], {(tree, 0): 1 for tree in range(model.getNumTrees)}
    held = {(r["treeID"], r["id"]): r for r in nodes.collect()}  # bounded by trees and depth
    while level:
        below = {}
        for (tree, place), number in level.items():
            row = held[tree, place]
            if row["leftChild"] >= 0:
                found.append((tree, number, row["split"]["featureIndex"], row["split"]["leftCategoriesOrThreshold"][0]))
                below |= {(tree, row["leftChild"]): 2 * number, (tree, row["rightChild"]): 2 * number + 1}
        level = below
    return spark.createDataFrame(found, "tree int, node int, feature int, cut double")


def long_features(train: DataFrame, features: str | Column) -> DataFrame:
    """(feature, value) of every row, features by position."""
    return train.select(F.posexplode(features).alias("feature", "value"))


def fit_levelwise(train: DataFrame, key: str, label: str, features: str, rule: ForestRule, **columns: str) -> RandomForestClassificationModel:
    """A forest from (key, label, features as an array of doubles).

    The key must be unique for bags to differ by row; rows that share one share their bags. Labels are 0 to classes - 1.
    """
    held = feature_bins(long_features(train, features), rule.bins).select("feature", "bin", "cut").collect()
    if not held:
        raise ValueError("no rows to fit on")
    size = max(r["feature"] for r in held) + 1
    cuts = [np.array([r["cut"] for r in sorted(held, key=lambda r: r["bin"]) if r["feature"] == f and r["cut"] is not None]) for f in range(size)]
    widths = np.array([len(c) + 1 for c in cuts])
    rows = binned_rows(train, key, label, features, cuts, rule.seed)
    return as_library_model(train.sparkSession, grow(rows, widths, rule), cuts, rule, **columns)
