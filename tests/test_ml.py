"""Model path: target choice, pipeline fit on the training part only,
beats the mean predictor, save/load round trip, heuristic fallback."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from contrail.operators import insight, ml
from contrail.operators.predict import predict_b
from contrail.plans.views import hot_history
from contrail.session import checkpoint_dir
from tests.conftest import SF_SMALL


def test_pick_target():
    assert ml.pick_target(["a", "arr_delay"], "arr_delay") == "arr_delay"
    assert ml.pick_target(["x", "dep_delay_minutes", "arr_delay"], None) == "dep_delay_minutes"
    assert ml.pick_target(["x", "dep_delay"], None) == "dep_delay"


def test_model_beats_mean_and_round_trips(spark):
    df = hot_history(spark, SF_SMALL)
    fitted, pred, metrics = ml.train(df, target="arr_delay", model="rf", num_trees=10)
    m = metrics.first()
    base = pred.agg(F.avg("arr_delay").alias("m")).first()["m"]
    base_mae = pred.agg(F.avg(F.abs(F.col("arr_delay") - F.lit(base)))).first()[0]
    assert m["mae"] < base_mae and m["r2"] > 0.5
    path = os.path.join(checkpoint_dir(spark), "models-test", uuid.uuid4().hex[:8])
    ml.save(fitted, path, metrics, "arr_delay")
    loaded = ml.load(spark, [os.path.join(path, "absent"), path])
    assert loaded is not None
    again = loaded.transform(pred.select(*df.columns))
    assert again.count() == pred.count()
    assert ml.predictor(None) is predict_b
    assert ml.load(spark, [os.path.join(path, "absent")]) is None
    with pytest.raises(FileNotFoundError):
        ml.load(spark, os.path.join(path, "absent"), required=True)
    # a missing category is served as it is trained: as the mode
    mode = ml.modes_of(insight.split(df.where("arr_delay is not null"))[0], ["origin"])["origin"]
    rows = df.orderBy("flight_id").limit(20).drop("predicted_delay", "prediction_confidence")
    blank, filled = ([r.predicted_delay for r in ml.predictor(loaded)(rows.withColumn("origin", F.lit(v).cast("string"))).orderBy("flight_id").collect()]
                     for v in (None, mode))
    assert blank == filled


def test_split_and_sample_repeat(spark):
    df = hot_history(spark, SF_SMALL)
    tr, te = insight.split(df)
    n = df.count()
    assert tr.count() + te.count() == n and 0.75 * n < tr.count() < 0.85 * n
    assert {r[0] for r in insight.sample(df, 50).select("flight_id").collect()} == {
        r[0] for r in insight.sample(df.repartition(7), 50).select("flight_id").collect()}


def test_gbt_fits(spark):
    df = hot_history(spark, SF_SMALL)
    _, _, metrics = ml.train(df, target="arr_delay", model="gbt", max_iter=5)
    assert metrics.first()["n"] > 0


def _counted(spark, df):
    """``df`` with an accumulator of the rows that were read from it."""
    read = spark.sparkContext.accumulator(0)

    def seen(x):
        read.add(1)
        return x

    return df.withColumn("month", F.udf(seen, "int")(F.col("month"))), read


def test_fitted_features_read_their_rows_once(spark):
    df, read = _counted(spark, hot_history(spark, SF_SMALL))
    assert ml.fitted_features(spark, df).count() > 0
    assert read.value == df.count()


def test_training_reads_its_rows_once(spark):
    df, read = _counted(spark, hot_history(spark, SF_SMALL))
    rows = ml.training_rows(df, target="arr_delay")
    for trees in (1, 2):
        _, pred, metrics = ml.train(df, target="arr_delay", model="rf", num_trees=trees, rows=rows, narrow=True)
        assert metrics.first()["n"] == pred.count()
    assert read.value == df.where("arr_delay is not null").count()
    tr, te = insight.split(hot_history(spark, SF_SMALL).where("arr_delay is not null"))
    for stored, part in zip(rows, (tr, te)):
        part = part.select(*stored.columns)
        assert stored.count() == part.count() and not stored.exceptAll(part).count()
