"""Model queries."""

import os
import uuid

from pyspark.sql import functions as F

from contrail.operators import ml
from contrail.plans.oracle_views import with_history, with_hot
from contrail.plans.registry import register
from contrail.plans.views import hot_events, hot_history
from contrail.session import checkpoint_dir

_NUM = ["crs_dep_time", "dep_delay", "arr_delay", "distance", "month", "day_of_week"]
_CAT = ["airline_code", "origin", "dest"]


def _census_sql() -> str:
    parts = [f"""SELECT '{c}' AS field, count(*) FILTER (WHERE "{c}" IS NULL) AS missing,
       round(median(CAST("{c}" AS DOUBLE)), 6) AS median, CAST(NULL AS VARCHAR) AS mode FROM hot""" for c in _NUM]
    parts += [f"""SELECT '{c}' AS field, count(*) FILTER (WHERE "{c}" IS NULL) AS missing,
       CAST(NULL AS DOUBLE) AS median,
       (SELECT "{c}" FROM hot WHERE "{c}" IS NOT NULL GROUP BY "{c}" ORDER BY count(*) DESC, "{c}" LIMIT 1) AS mode
FROM hot""" for c in _CAT]
    return with_hot("\n" + "\nUNION ALL ".join(parts))


@register("column_census", _census_sql())
def column_census(spark, sf):
    """Missing census, exact median and mode per column."""
    return ml.column_census(hot_events(spark, sf), _NUM, _CAT)


@register("model_train_eval")
def model_train_eval(spark, sf):
    """M1-M8: random forest (the README's model) on the 80 % hash split of
    the history, scored on the other 20 %, saved with its metadata, with
    the mean-predictor baseline alongside.  No SQL twin (a fitted model)."""
    fitted, pred, metrics = ml.train(hot_history(spark, sf), target="arr_delay", model="rf", narrow=True)
    path = os.path.join(checkpoint_dir(spark), "models", uuid.uuid4().hex[:12])
    ml.save(fitted, path, metrics, "arr_delay")
    return _with_baseline(metrics, pred)


@register("model_gbt_eval")
def model_gbt_eval(spark, sf):
    """M5 + M7: gradient-boosted trees (100 rounds) on the 80 % hash split of
    the history, scored on the other 20 %.  No SQL twin (a fitted model)."""
    _, pred, metrics = ml.train(hot_history(spark, sf), target="arr_delay", model="gbt", narrow=True)
    return _with_baseline(metrics, pred)


@register("scored_metrics", with_history("""
SELECT count(*) AS n, round(avg(abs(predicted_delay - arr_delay)), 6) AS mae,
       round(avg(pow(predicted_delay - arr_delay, 2)), 6) AS mse,
       round(sqrt(avg(pow(predicted_delay - arr_delay, 2))), 6) AS rmse,
       round(1e0 - avg(pow(predicted_delay - arr_delay, 2)) / var_pop(arr_delay), 6) AS r2
FROM hist WHERE predicted_delay IS NOT NULL AND arr_delay IS NOT NULL"""))
def scored_metrics(spark, sf):
    """M7: the model metrics over the scored history (predictor A against
    the arrival delay)."""
    return ml.regression_metrics(hot_history(spark, sf), "arr_delay", "predicted_delay")


def _with_baseline(metrics, pred):
    from contrail.operators.enrich import attach_scalars
    mean = pred.agg(F.avg("arr_delay").alias("_mean"))
    base = attach_scalars(pred.select("arr_delay"), mean).agg(
        F.avg(F.abs(F.col("arr_delay") - F.col("_mean"))).alias("baseline_mae"))
    return attach_scalars(metrics, base)


@register("model_stream_inference")
def model_stream_inference(spark, sf):
    """T6 + M9: fit on the history, save, load back, and score the events
    stream with the loaded model inside the ingest (``availableNow``)."""
    from contrail.plans.q_ingest import _event_stream
    from contrail.plans.views import PROCESSING_TIME
    from contrail.sources.stream import encode_events
    from contrail.sources.tables import events_as_flights
    from contrail.streaming import ingest
    fitted, _, metrics = ml.train(hot_history(spark, sf), target="arr_delay", model="rf", narrow=True)
    root = os.path.join(checkpoint_dir(spark), "models", uuid.uuid4().hex[:12])
    ml.save(fitted, root, metrics, "arr_delay")
    model = ml.load(spark, [os.path.join(root, "missing"), root])
    stores = ingest.default_stores(spark, "inference-" + uuid.uuid4().hex[:12])
    msgs = encode_events(events_as_flights(_event_stream(spark, sf)))
    ingest.run_ingest(spark, msgs, stores, predictor=ml.predictor(model), processing_time=PROCESSING_TIME)
    hot = ingest.read_hot(spark, stores)
    return hot.groupBy("airline_code").agg(F.count(F.lit(1)).alias("flights"),
                                           F.count("predicted_delay").alias("predicted"),
                                           F.avg("prediction_confidence").alias("avg_confidence"))
