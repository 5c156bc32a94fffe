"""Packed boosting: the trees that Spark's GBTRegressor grows, in fewer passes."""

import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from contrail.operators import boosting, ml, packed

_COLS = ["a", "b", "c", "d", "e"]


def _rows(spark, n, parts=3, seed=5):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c, d = rng.random(), rng.randrange(7), rng.randrange(300), rng.choice([-1.5, 0.0, 2.0])
        rows.append((a, float(b), float(c), d, 4.0, 10 * a * d + b % 3 + (c > 200) + rng.gauss(0, 1)))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*_COLS, "y"])).repartition(parts)
    return VectorAssembler(inputCols=_COLS, outputCol="features").transform(df).cache()


def _fitted(cls, rows, **params):
    return cls(featuresCol="features", labelCol="y", predictionCol="prediction", seed=42, **{"maxBins": 64} | params).fit(rows)


def _both(rows, **params):
    return [_fitted(cls, rows, **params) for cls in (GBTRegressor, boosting.PackedGBTRegressor)]


def _predicted(model, rows):
    return np.array([r.prediction for r in model.transform(rows).select("prediction").collect()])


@pytest.mark.parametrize("params", [{"maxIter": 12}, {"maxIter": 4, "maxDepth": 3, "stepSize": 0.5, "minInstancesPerNode": 20},
                                    {"maxIter": 3, "maxBins": 8, "minInfoGain": 0.05}])
def test_same_model_as_spark(spark, params):
    rows = _rows(spark, 4000)
    theirs, ours = _both(rows, **params)
    assert isinstance(ours, GBTRegressionModel) and ours.getNumTrees == params["maxIter"] and ours.treeWeights == theirs.treeWeights
    assert ours.numFeatures == theirs.numFeatures == 5
    np.testing.assert_allclose(_predicted(ours, rows), _predicted(theirs, rows), rtol=0, atol=1e-9)
    np.testing.assert_allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-9)
    assert [t.numNodes for t in ours.trees] == [t.numNodes for t in theirs.trees]


def test_many_blocks_and_parts_add_up(spark, monkeypatch):
    rows = _rows(spark, 3000)
    whole = _predicted(_fitted(boosting.PackedGBTRegressor, rows, maxIter=3), rows)
    monkeypatch.setattr(boosting, "DRIVER_PARTS", 1)  # added in the cluster
    np.testing.assert_allclose(_predicted(_fitted(boosting.PackedGBTRegressor, rows, maxIter=3), rows), whole, atol=1e-9)


def test_odd_rows(spark):
    for n in (1, 2, 5):
        rows = _rows(spark, n)
        theirs, ours = _both(rows, maxIter=3)
        np.testing.assert_allclose(_predicted(ours, rows), _predicted(theirs, rows), atol=1e-9)
    twice = _rows(spark, 300).withColumn("y", F.lit(2.5))  # nothing to learn
    for model in _both(twice, maxIter=2):
        assert {round(p, 9) for p in _predicted(model, twice)} == {2.5} and [t.numNodes for t in model.trees] == [1, 1]


def test_missing_features_and_labels_are_refused(spark):
    rows = _rows(spark, 50)
    for bad in (rows.withColumn("y", F.when(F.col("b") > 2, F.col("y"))), rows.withColumn("y", F.lit(float("nan")))):
        with pytest.raises(Exception, match="(?i)label"):
            _fitted(boosting.PackedGBTRegressor, bad, maxIter=2)


def test_other_settings_are_sparks(spark):
    rows = _rows(spark, 400)
    for params in ({"maxDepth": 6}, {"lossType": "absolute"}, {"subsamplingRate": 0.5}):
        theirs, ours = _both(rows, maxIter=2, **params)
        np.testing.assert_allclose(_predicted(ours, rows), _predicted(theirs, rows), atol=1e-9)


def test_codes_hold_every_bin():
    rng = np.random.default_rng(3)
    bins = [12, 7, 64, 64, 50, 5, 25, 25, 1]
    layout = packed.Layout.of([np.arange(n - 1) + 0.5 for n in bins])
    assert all(layout.cells(c) <= packed.CODE_CELLS for c in layout.codes) and len(layout.codes) == 3
    x, y = np.stack([rng.integers(0, n, 5000) for n in bins], 1), rng.normal(size=5000)
    codes = np.zeros((len(layout.codes), 5000), np.uint16)
    for into, code in zip(codes, layout.codes):
        for f, step in code:
            into += (x[:, f] * step).astype(np.uint16)
    splits = {0: (2, 30), 1: (4, 10), 2: (0, 5), 5: (7, 11)}
    right = {s: x[:, f] > b for s, (f, b) in splits.items()}
    node = 2 * right[0] + np.where(right[0], right[2], right[1])
    ((hist, squares),) = packed.histograms([(codes.tobytes(), y.tobytes())] * 2, layout, {s: v for s, v in splits.items() if s < 3}, 2, True)
    starts = layout.starts()
    for f, n in enumerate(bins[:-1]):
        for stat, w in enumerate((np.ones(5000), y, y * y)):
            want = 2 * np.bincount(node * n + x[:, f], w, 4 * n).reshape(4, n)
            np.testing.assert_allclose(hist[stat, :, starts[f]:starts[f + 1]], want, atol=1e-9)
    np.testing.assert_allclose(squares, 2 * np.bincount(node, y * y, 4))
    leaf = 2 * node + np.where(node == 2, right[5], False)
    ((_, rest),) = packed.learnt([(codes.tobytes(), y.tobytes())], layout, splits, 3, np.arange(8.0), 0.5, 2.0)
    np.testing.assert_allclose(np.frombuffer(rest), 2 * (y - 0.5 * leaf))


def test_five_stages_a_round(spark):
    """A round is one pass without a shuffle per level (Spark's own: two stages per level)."""
    rows, sc = _rows(spark, 500).withColumnRenamed("y", "arr_delay"), spark.sparkContext
    ran = {}
    for rounds in (2, 6):
        gbt = ml.build_pipeline("arr_delay", model="gbt", max_iter=rounds).getStages()[-1]
        sc.setJobGroup(f"boosting-{rounds}", "")
        try:
            gbt.fit(rows)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        seen = sc.statusTracker()
        stages = {s for j in seen.getJobIdsForGroup(f"boosting-{rounds}") for s in seen.getJobInfo(j).stageIds}
        ran[rounds] = sum(1 for s in map(seen.getStageInfo, stages) if s and s.numCompletedTasks)
    assert ran[6] - ran[2] <= 5 * 4
