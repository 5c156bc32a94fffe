"""Gradient-boosted regression trees over packed rows (M5).

``PackedGBTRegressor`` fits what Spark's ``GBTRegressor`` fits (squared loss, the
same candidate splits, gains, stops and weights) and returns its
``GBTRegressionModel``.  Spark keeps an object per row and walks it, feature by
feature, in each of some 600 passes.  Here a row is 14 bytes or so: its bins, packed
into codes of several features each, and what is left to learn of its label.
Rows lie in blocks; a pass reads them and counts each code by node with numpy.
The histogram of one feature is a sum over its code's cells.  There is one pass per
level, and the pass of a root also takes the tree before it off the labels.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from contrail.operators import packed
from contrail.operators.packed import CODE_CELLS, MAX_DEPTH, Layout

#: Partial histograms are added on the driver up to here, beyond in the cluster first.
DRIVER_PARTS = 64
#: Gains this near are equal: the order in which sums are added must not choose.
TIE = 1e-9
EPSILON = float(np.finfo(float).eps)  # below it Spark takes an impurity for zero


def _summed(rows, *, layout: Layout, splits, depth: int, last: bool):
    parts = rows.mapPartitions(partial(packed.histograms, layout=layout, splits=splits, depth=depth, last=last))
    if parts.getNumPartitions() > DRIVER_PARTS:
        return parts.treeReduce(packed.added)
    hist, squares = zip(*parts.collect())
    return sum(hist), sum(squares)


def _variance(n, total, squares):
    return (squares - total * total / n) / n


@dataclass
class Node:
    n: float
    total: float
    squares: float
    gain: float = 0.0
    split: tuple[int, int] | None = None

    @property
    def prediction(self) -> float:
        return self.total / self.n


def _best_split(hist: np.ndarray, node: Node, layout: Layout, least_rows: int, least_gain: float):
    """(gain, feature, last bin of the left side), the first of equal ones, or None."""
    best = None
    starts = layout.starts()
    for f in range(len(layout.thresholds)):
        n, total = hist[:2, starts[f]:starts[f + 1] - 1].cumsum(axis=1)
        other, other_total = node.n - n, node.total - total
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = n * other * (total / n - other_total / other) ** 2 / node.n ** 2
        gain = np.where((n >= max(least_rows, 1)) & (other >= max(least_rows, 1)) & (gain >= least_gain), gain, 0.0)
        if len(gain) and gain.max() > (best[0] * (1 + TIE) if best else 0.0):
            at = int(np.argmax(gain >= gain.max() * (1 - TIE)))
            best = float(gain[at]), f, at
    return best


def _grown(histograms, layout: Layout, max_depth: int, least_rows: int, least_gain: float) -> dict[int, Node]:
    """A tree by heap number, a level per call of ``histograms(splits, depth, last)``."""
    tree: dict[int, Node] = {}
    for depth in range(max_depth):
        first, last = (1 << depth) - 1, depth == max_depth - 1
        if depth and not any(i >= first for i in tree):
            break
        hist, squares = histograms(splits={i: t.split for i, t in tree.items() if t.split}, depth=depth, last=last)
        starts = layout.starts()
        if not depth:
            tree[0] = Node(*hist[:2, 0, _any_feature(layout)].sum(axis=1), squares[0])
        for i in [i for i in tree if i >= first]:
            node, at = tree[i], hist[:, i - first]
            node.squares = squares[i - first]
            if abs(_variance(node.n, node.total, node.squares)) < EPSILON:
                continue
            found = _best_split(at, node, layout, least_rows, least_gain)
            if found is None:
                continue
            node.gain, f, b = found
            node.split = f, b
            left = at[:, starts[f]:starts[f] + b + 1].sum(axis=1)
            right = at[:, starts[f] + b + 1:starts[f + 1]].sum(axis=1)
            for child, side in ((2 * i + 1, left), (2 * i + 2, right)):
                tree[child] = Node(side[0], side[1], side[2] if last else 0.0)
    return tree


def _any_feature(layout: Layout) -> slice:
    f, starts = layout.codes[0][0][0], layout.starts()
    return slice(starts[f], starts[f + 1])


def _values(tree: dict[int, Node], max_depth: int) -> np.ndarray:
    """The prediction by place in level ``max_depth``; rows of an earlier leaf
    have gone left from there."""
    out = np.zeros(1 << max_depth)
    for i, node in tree.items():
        if node.split is None:
            while i < len(out) - 1:
                i = 2 * i + 1
            out[i - len(out) + 1] = node.prediction
    return out


def _forget(sc, path: str | None) -> None:
    if path:
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def _java_doubles(sc, values):
    out = sc._gateway.new_array(sc._jvm.double, len(values))
    sc._jvm.java.nio.ByteBuffer.wrap(np.array(values, ">f8").tobytes()).asDoubleBuffer().get(out)
    return out


class PackedGBTRegressor(GBTRegressor):
    """``GBTRegressor`` fitted as this module says.  Settings that it does not
    know (other losses, row or feature sampling, weights, a validation column,
    nominal features, deeper trees) are fitted by Spark."""

    def _known(self, categorical) -> bool:
        return (self.getLossType() == "squared" and self.getSubsamplingRate() == 1.0 and self.getFeatureSubsetStrategy() in ("all", "auto")
                and not self.isDefined(self.validationIndicatorCol) and not (self.isDefined(self.weightCol) and self.getWeightCol())
                and self.getMinWeightFractionPerNode() == 0.0 and 1 <= self.getMaxDepth() <= MAX_DEPTH
                and self.getMaxBins() <= CODE_CELLS and categorical.isEmpty())

    def _fit(self, dataset):
        sc = dataset.sparkSession.sparkContext
        ml = sc._jvm.org.apache.spark.ml
        self._transfer_params_to_java()
        categorical = ml.util.MetadataUtils.getCategoricalFeatures(dataset._jdf.schema().apply(self.getFeaturesCol()))
        n = dataset.count()
        if not n or not self._known(categorical):
            return super()._fit(dataset)
        layout = Layout.of(self._thresholds(sc, dataset, n, categorical))
        if not layout.codes:  # nothing to split on
            return super()._fit(dataset)
        rows = (dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
                .mapInArrow(partial(packed.packed, layout=layout), "codes binary, rest binary").rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK_DESER))
        trees = self._boosted(sc, rows, layout)
        weights = [1.0] + [self.getStepSize()] * (len(trees) - 1)
        model = GBTRegressionModel(self._java_model(sc, trees, weights, layout))
        model._resetUid(self.uid)
        return self._copyValues(model)

    def _thresholds(self, sc, dataset, n: int, categorical):
        """Spark's candidate splits, from its own sample of the rows.  The pass for them
        checks labels and features."""
        jvm = sc._jvm.org.apache.spark
        rows_of = getattr(getattr(jvm.ml.util, "DatasetUtils$"), "MODULE$")
        rows = rows_of.extractInstances(self._java_obj, dataset._jdf, getattr(rows_of, "extractInstances$default$3")())
        strategy = self._java_obj.getOldBoostingStrategy(categorical, jvm.mllib.tree.configuration.Algo.Regression()).treeStrategy()
        n_features, most = rows_of.getNumFeatures(dataset._jdf, self.getFeaturesCol()), min(self.getMaxBins(), n)
        bins = sc._gateway.new_array(sc._jvm.int, n_features)
        for f in range(n_features):
            bins[f] = most
        # as DecisionTreeMetadata.buildMetadata, which would read all rows to count them
        meta = jvm.ml.tree.impl.DecisionTreeMetadata(
            n_features, n, float(n), 0, most, categorical, categorical.keySet(), bins, strategy.impurity(), strategy.quantileCalculationStrategy(),
            strategy.maxDepth(), strategy.minInstancesPerNode(), strategy.minWeightFractionPerNode(), strategy.minInfoGain(), 1, n_features)
        found = getattr(getattr(jvm.ml.tree.impl, "RandomForest$"), "MODULE$").findSplits(rows, meta, self.getSeed())
        return [np.array([s.threshold() for s in feature]) for feature in found]

    def _boosted(self, sc, rows, layout: Layout) -> list[dict[int, Node]]:
        depth, every = self.getMaxDepth(), self.getCheckpointInterval()
        trees, before, kept = [], None, None

        def histograms(**what):
            nonlocal before
            found = _summed(rows, layout=layout, **what)
            if before is not None:
                before.unpersist()
                before = None
            return found

        for m in range(self.getMaxIter()):
            if m:  # the first tree learns the labels, the others twice what is left of them
                weight, factor = (1.0, 2.0) if m == 1 else (2 * self.getStepSize(), 1.0)
                splits = {i: t.split for i, t in trees[-1].items() if t.split}
                before, rows = rows, rows.mapPartitions(partial(packed.learnt, layout=layout, splits=splits, depth=depth, values=_values(trees[-1], depth),
                                                                weight=weight, factor=factor)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
                if every > 0 and m % every == 0 and sc.getCheckpointDir():  # cuts the lineage
                    rows.checkpoint()
            trees.append(_grown(histograms, layout, depth, self.getMinInstancesPerNode(), self.getMinInfoGain()))
            if rows.getCheckpointFile():
                _forget(sc, kept)
                kept = rows.getCheckpointFile()
        rows.unpersist()
        _forget(sc, kept)
        return trees

    def _java_model(self, sc, trees, weights, layout: Layout):
        jvm = sc._jvm.org.apache.spark
        calculator, split_class = jvm.mllib.tree.impurity.VarianceCalculator, jvm.ml.tree.ContinuousSplit
        inner_class, leaf_class, tree_class = jvm.ml.tree.InternalNode, jvm.ml.tree.LeafNode, jvm.ml.regression.DecisionTreeRegressionModel
        part = sc._jvm.java.util.Arrays.copyOfRange

        def node(tree, stats, place, i):
            t = tree[i]
            impurity, at = float(_variance(t.n, t.total, t.squares)), 3 * place[i]
            stats_of = calculator(part(stats, at, at + 3), int(t.n))
            if t.split:
                (left, leaf), (right, other_leaf) = node(tree, stats, place, 2 * i + 1), node(tree, stats, place, 2 * i + 2)
                if leaf is None or leaf != other_leaf:  # Spark, too, joins leaves that say the same
                    f, b = t.split
                    split = split_class(f, float(layout.thresholds[f][b]))
                    return inner_class(float(t.prediction), impurity, t.gain, left, right, split, stats_of), None
                return leaf_class(leaf, impurity, stats_of), leaf
            return leaf_class(float(t.prediction), impurity, stats_of), float(t.prediction)

        out = sc._gateway.new_array(tree_class, len(trees))
        for k, tree in enumerate(trees):
            stats = _java_doubles(sc, [x for t in tree.values() for x in (t.n, t.total, t.squares)])
            out[k] = tree_class(node(tree, stats, {i: at for at, i in enumerate(tree)}, 0)[0], len(layout.thresholds))
        model = jvm.ml.regression.GBTRegressionModel(self.uid, out, _java_doubles(sc, weights), len(layout.thresholds))
        return self._java_obj.copyValues(model, jvm.ml.param.ParamMap()).setParent(self._java_obj)
