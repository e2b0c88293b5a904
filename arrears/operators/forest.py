"""Random forests grown on cells: each tree in one task, its draws of rows taken for all rows of a cell at once.

A bootstrap draws each row a Poisson(1) number of times, so it draws the ``n`` equal rows of a cell a Poisson(n) number of
times: the forest is one of all rows, and costs what its cells cost. The rest is as in Spark's forests: the root of the
number of features is drawn for each node, the split of the largest gain in Gini impurity is taken, siblings that predict
the same are one leaf, and what comes back is a model of Spark's.

Draws follow the seed, the tree and the level, not partitions; the first trees of a forest are a forest, and their tops
one of shallower trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from arrears.operators.cells import Cuts, _attributes
from arrears.operators.logistic_grid import _entries
from arrears.session import fresh_path

MOST_ENTRIES = 4_000_000  # set slots of all cells, which every task holds: 32 MB as numbers of cells and bins
HISTOGRAMS = 2_000_000  # bins of the nodes looked at together
LEAST_GAIN = 1e-12  # less is rounding

NODES = (
    "tree int, id int, prediction double, impurity double, neg double, pos double, gain double, left int, right int, "
    "feature int, threshold double"
)


@dataclass
class Held:
    """All cells as every task holds them: the bins their set slots fall into, and their rows of both classes."""

    row: np.ndarray  # of each set slot, its cell
    bin: np.ndarray  # and its bin, numbered through over all slots
    neg: np.ndarray
    pos: np.ndarray
    first: np.ndarray  # of each slot, its first bin
    zero: np.ndarray  # and the bin of zero
    slot: np.ndarray  # of each bin, its slot
    threshold: np.ndarray  # of each bin, what splits it from the next one


def plain(estimator: RandomForestClassifier) -> bool:
    """Whether the estimator asks for nothing but trees, depth and seed, which is all that is grown here."""
    ours = {"numTrees", "maxDepth", "seed", "cacheNodeIds"}
    return all(
        p.name in ours or not estimator.isSet(p) or estimator.getOrDefault(p) == estimator._defaultParamMap.get(p)
        for p in estimator.params
    )


def held(cells: DataFrame, cuts: Cuts, raw: bool) -> Held | None:
    """The cells in an order that follows from them, or None if they are too many or of one class only.

    Thresholds are numbers if ``raw``, else codes.
    """
    if any(len(a.get("vals", a.get("values", []))) > 2 or a.get("num_vals", 0) > 2 for a in (_attributes(cells) or {}).get("nominal", [])):
        return None

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = len(batch.column(0).flatten()[3].flatten()) + batch.num_rows
            yield pa.RecordBatch.from_pydict({"n": pa.array([many], pa.int64())})

    if (cells.select("features").mapInArrow(sizes, "n bigint").agg(F.sum("n")).first()[0] or 0) > MOST_ENTRIES:
        return None
    table = cells.select("features", F.col("label").cast("double"), "weight").toArrow().combine_chunks()
    if not table.num_rows:
        return None
    column = table.column(0).combine_chunks()
    row, slot, code = _entries(column)
    features = int(column.field("size")[0].as_py())
    label, weight = (table.column(k).to_numpy() for k in (1, 2))
    if set(np.unique(label)) != {0.0, 1.0}:
        return None
    code = code.astype(np.int64)
    least, most = np.zeros(features, np.int64), np.zeros(features, np.int64)
    np.minimum.at(least, slot, code)
    np.maximum.at(most, slot, code)
    first = np.concatenate([[0], np.cumsum(most - least + 1)])
    number = first[slot] + code - least[slot]
    # cells of the same slots and bins, whatever their label, are one; their order is that of their bins
    count = np.bincount(row, minlength=table.num_rows)
    wide = np.full((table.num_rows, count.max(initial=0)), -1, np.int32)
    wide[row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)] = number
    wide, at = np.unique(wide, axis=0, return_inverse=True)
    at = at.ravel()
    new_row, place = np.nonzero(wide >= 0)
    owner = np.repeat(np.arange(features), most - least + 1)
    codes = np.arange(first[-1]) - first[owner] + least[owner] + 0.5
    split = [cuts.threshold(s, c) if raw and c < most[s] else c for s, c in zip(owner.tolist(), codes.tolist())]
    return Held(
        new_row.astype(np.int32), wide[new_row, place],
        np.bincount(at, weight * (label == 0.0), len(wide)), np.bincount(at, weight * (label == 1.0), len(wide)),
        first[:-1], first[:-1] - least, owner, np.array(split),
    )


def _splits(data: Held, key, neg, pos, row, total, drawn) -> tuple[np.ndarray, np.ndarray]:
    """The best split of each of some nodes, as the last bin on its left, and its gain.

    ``key`` is the node of each entry times the bins, plus its bin; ``drawn`` the features each node may look at.
    """
    bins = len(data.slot)
    left = []
    for weight, whole in ((neg, total[:, :1]), (pos, total[:, 1:])):
        counted = np.bincount(key, weight[row], len(total) * bins).reshape(-1, bins)
        counted[:, data.zero] += whole - np.add.reduceat(counted, data.first, axis=1)
        left.append(np.cumsum(counted, axis=1) - data.slot * whole)  # bins of earlier slots hold all rows each
    right = [total[:, :1] - left[0], total[:, 1:] - left[1]]
    on_left, on_right = left[0] + left[1], right[0] + right[1]
    fine = (on_left >= 0.5) & (on_right >= 0.5) & drawn[:, data.slot]
    with np.errstate(divide="ignore", invalid="ignore"):
        purity = (left[0] ** 2 + left[1] ** 2) / on_left + (right[0] ** 2 + right[1] ** 2) / on_right
    rows = total.sum(1)
    gain = np.where(fine, purity / rows[:, None] - ((total**2).sum(1) / rows**2)[:, None], -1.0)
    best = gain.argmax(1)
    return best, gain[np.arange(len(best)), best]


def grow_tree(data: Held, seed: int, tree: int, depth: int) -> list[tuple]:
    """Rows of ``NODES`` without the tree, a node before its left part before its right part."""
    draw = np.random.default_rng([seed, tree])
    neg, pos = draw.poisson(data.neg).astype(float), draw.poisson(data.pos).astype(float)
    features, bins = len(data.first), len(data.slot)
    looked = math.ceil(math.sqrt(features))
    at = np.where(neg + pos > 0, 0, -1)  # of each cell, its node in the level, or -1 in a leaf
    kept = np.flatnonzero(at[data.row] >= 0)
    row, number = data.row[kept], data.bin[kept]
    of = data.slot[number]  # of each entry, its slot
    total = np.array([[neg.sum(), pos.sum()]])
    totals, split, gains, below = [total], [], [], []
    start = 0
    for level in range(depth + 1):
        many = len(total)
        best, gain = np.zeros(many, np.int64), np.full(many, -1.0)
        if level < depth:
            choose = np.random.default_rng([seed, tree, level])
            step = max(1, HISTOGRAMS // bins)
            for k in range(0, many, step):
                part = slice(k, min(k + step, many))
                size = part.stop - k
                drawn = np.zeros((size, features), bool)
                order = np.argsort(choose.random((size, features)), axis=1)[:, :looked]
                drawn[np.arange(size)[:, None], order] = True
                node = at[row] - k
                seen = drawn.ravel()[np.clip(node, 0, size - 1) * features + of]
                seen = np.flatnonzero(seen if many <= step else seen & (node >= 0) & (node < size))
                mine = row[seen]
                key = node[seen] * bins + number[seen]
                with np.errstate(divide="ignore", invalid="ignore"):
                    best[part], gain[part] = _splits(data, key, neg, pos, mine, total[part], drawn)
        cut = (gain > LEAST_GAIN) & (total.min(1) > 0)
        child = np.where(cut, start + many + 2 * (np.cumsum(cut) - 1), -1)
        split.append(np.where(cut, best, -1))
        gains.append(gain)
        below.append(child)
        if not cut.any():
            break
        # a cell's bin in the slot its node splits; slots that are not set are zero
        slot = np.where(cut, data.slot[best], -1)
        here = np.where(at >= 0, data.zero[slot[np.maximum(at, 0)]], 0)
        hit = np.flatnonzero(of == slot[at[row]])
        here[row[hit]] = number[hit]
        goes_on = (at >= 0) & cut[np.maximum(at, 0)]
        place = child[np.maximum(at, 0)] - start - many
        at = np.where(goes_on, place + (here > best[np.maximum(at, 0)]), -1)
        kept = np.flatnonzero(at[row] >= 0)
        row, number, of = row[kept], number[kept], of[kept]
        inside = np.flatnonzero(at >= 0)
        size = 2 * int(cut.sum())
        total = np.stack([np.bincount(at[inside], w[inside], size) for w in (neg, pos)], 1)
        totals.append(total)
        start += many
    totals, split, gains, below = (np.concatenate(x) for x in (totals, split, gains, below))
    return _in_preorder(data, totals, split.tolist(), gains.tolist(), below.tolist())


def _in_preorder(data: Held, totals: np.ndarray, split: list, gains: list, below: list) -> list[tuple]:
    said = (totals[:, 1] > totals[:, 0]).astype(float).tolist()
    leaf = [b < 0 for b in below]
    for k in range(len(below) - 1, -1, -1):  # children have larger numbers than their parents
        left = below[k]
        if left >= 0 and leaf[left] and leaf[left + 1] and said[left] == said[left + 1]:
            leaf[k] = True
            said[k] = said[left]
    out: list[list] = []
    todo: list[tuple[int, int | None, int]] = [(0, None, 0)]
    while todo:
        k, parent, side = todo.pop()
        mine = len(out)
        if parent is not None:
            out[parent][side] = mine
        neg, pos = totals[k].tolist()
        rows = neg + pos
        impurity = 1.0 - (neg * neg + pos * pos) / (rows * rows) if rows else 0.0
        if leaf[k]:
            out.append([mine, said[k], impurity, neg, pos, -1.0, -1, -1, -1, None])
        else:
            feature, threshold = int(data.slot[split[k]]), float(data.threshold[split[k]])
            out.append([mine, said[k], impurity, neg, pos, gains[k], -1, -1, feature, threshold])
            todo += [(below[k] + 1, mine, 7), (below[k], mine, 6)]
    return [tuple(n) for n in out]


def grow(estimator: RandomForestClassifier, data: Held) -> RandomForestClassificationModel:
    """The estimator's forest of the rows that the cells count."""
    spark = SparkSession.active()
    trees, depth, seed = estimator.getNumTrees(), estimator.getMaxDepth(), abs(estimator.getSeed())
    sent = spark.sparkContext.broadcast(vars(data))  # arrays only: executors may not have this package
    names = [f.split()[0] for f in NODES.split(", ")]
    kinds = [pa.int32() if f.endswith(" int") else pa.float64() for f in NODES.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Held(**sent.value)
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                columns = list(zip(*((tree, *node) for node in grow_tree(own, seed, tree, depth))))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    tasks = min(trees, 2 * spark.sparkContext.defaultParallelism)
    nodes = spark.range(0, trees, 1, tasks).mapInArrow(work, NODES)
    try:
        return _as_model(estimator, nodes, len(data.first))
    finally:
        sent.destroy()


def _as_model(estimator: RandomForestClassifier, nodes: DataFrame, features: int) -> RandomForestClassificationModel:
    """The nodes in the form Spark saves a forest in, with the parameters of a forest fitted to two rows."""
    spark = nodes.sparkSession
    schema = StructType([StructField("features", VectorUDT()), StructField("label", DoubleType())])
    two = spark.createDataFrame([(SparseVector(features, []), 0.0), (SparseVector(features, [0], [1.0]), 1.0)], schema)
    path = fresh_path(spark, "forest")
    estimator.fit(two).write().overwrite().save(path)
    saved = spark.read.parquet(f"{path}/data").schema
    node = F.struct(
        "id", "prediction", "impurity", F.array("neg", "pos").alias("impurityStats"),
        (F.col("neg") + F.col("pos")).cast("long").alias("rawCount"), "gain",
        F.col("left").alias("leftChild"), F.col("right").alias("rightChild"),
        F.struct(
            F.col("feature").alias("featureIndex"),
            F.when(F.col("threshold").isNull(), F.array().cast("array<double>")).otherwise(F.array("threshold")).alias("leftCategoriesOrThreshold"),
            F.lit(-1).alias("numCategories"),
        ).alias("split"),
    )
    kind = saved["nodeData"].dataType
    missing = {f.name for f in kind.fields} ^ {"id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"}
    if missing:
        raise RuntimeError(f"this Spark saves trees with other fields: {sorted(missing)}")
    rows = nodes.select(F.col("tree").alias("treeID"), node.cast(kind).alias("nodeData"))
    rows.select(*saved.names).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
