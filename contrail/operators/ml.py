"""Delay model on Spark ML.

Pipeline: median fill (numbers, exact) and mode fill (strings) -> ``StringIndexer``
(alphabetical codes, unseen/missing kept) -> ``VectorAssembler`` ->
``StandardScaler`` -> ``GBTRegressor`` (fitted by ``boosting``; or ``RandomForestRegressor``).
Every stage is fitted on the training part only (the reference fits the
encoders and medians before its split).  The split is a hash of the id,
stable under repartitioning and retries.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.boosting import PackedGBTRegressor
from contrail.operators.insight import in_training, split
from contrail.operators.predict import predict_b
from contrail.operators.quality import field_modes, field_quantiles
from contrail.session import checkpoint_dir

NUMERIC_FEATURES = ["month", "day_of_week", "crs_dep_time", "distance", "dep_delay"]
CATEGORICAL_FEATURES = ["airline_code", "origin", "dest"]


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder.  A fit reads its rows
    some ten times (medians, modes, codes, moments, splits, trees, scores), and each
    would join and split the history again."""
    path = os.path.join(checkpoint_dir(df.sparkSession), "training", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pick_target(columns, preferred: str | None = "arr_delay") -> str:
    """M1: the explicit target if present; otherwise the first column
    naming both "delay" and "minute", else the first naming "delay"."""
    if preferred and preferred in columns:
        return preferred
    low = [c for c in columns if "delay" in c.lower()]
    both = [c for c in low if "minute" in c.lower()]
    if both:
        return both[0]
    if low:
        return low[0]
    raise ValueError("no delay column to predict")


def column_census(df: DataFrame, numeric, categorical) -> DataFrame:
    """Per column the missing count, the exact median (numeric) and
    the mode (categorical, ties -> smallest value), from the counts per value."""
    cols = list(numeric) + list(categorical)
    row = df.agg(*[F.struct(F.lit(c).alias("field"), F.count_if(F.col(c).isNull()).alias("missing")).alias(c) for c in cols])
    long = row.select(F.inline(F.array(*[F.col(c) for c in cols])))
    medians = field_quantiles(df, numeric, (0.5,)).withColumnRenamed("q0", "median")
    return (long.join(medians, "field", "left").join(field_modes(df, categorical), "field", "left")
            .select("field", "missing", "median", "mode"))


def modes_of(train: DataFrame, cols) -> dict[str, str | None]:
    """M2 (strings): the training mode of each column (a row per column)."""
    return {r["field"]: r["mode"] for r in field_modes(train, cols).collect()}


def medians_of(train: DataFrame, cols) -> dict[str, float]:
    """M2 (numbers): the exact training median of each column (a row per column)."""
    return {r["field"]: r["q0"] for r in field_quantiles(train, cols, (0.5,)).collect()}


def _inputs(numeric, categorical, modes: dict[str, str | None], medians: dict[str, float]) -> SQLTransformer:
    """The columns that the later stages read: numbers as doubles with the
    training median for a missing value (NaN counts as missing), strings with the
    training mode.  As a stage it is saved with the model, so training, batch and
    stream fill alike."""
    cols = [f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), CAST('{medians.get(c, 0.0)!r}' AS DOUBLE)) AS `{c}__imp`" for c in numeric]
    for c in categorical:
        mode = modes.get(c)
        text = "NULL" if mode is None else "'" + mode.replace("\\", "\\\\").replace("'", "\\'") + "'"
        cols.append(f"coalesce(`{c}`, {text}) AS `{c}__fill`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(cols)} FROM __THIS__")


def build_pipeline(target: str, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES, *, modes=None, medians=None,
                   model: str = "gbt", max_iter: int = 100, num_trees: int = 50, seed: int = 42) -> Pipeline:
    """M2-M6 as one Spark ML pipeline over the raw columns."""
    imputed = [f"{c}__imp" for c in numeric]
    indexed = [f"{c}__idx" for c in categorical]
    stages = [
        _inputs(numeric, categorical, modes or {}, medians or {}),
        StringIndexer(inputCols=[f"{c}__fill" for c in categorical], outputCols=indexed,
                      stringOrderType="alphabetAsc", handleInvalid="keep"),
        VectorAssembler(inputCols=imputed + indexed, outputCol="features_raw", handleInvalid="keep"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]
    if model == "gbt":
        stages.append(PackedGBTRegressor(featuresCol="features", labelCol=target, predictionCol="prediction",
                                         maxIter=max_iter, seed=seed, maxBins=64))
    elif model == "rf":
        stages.append(RandomForestRegressor(featuresCol="features", labelCol=target,
                                            predictionCol="prediction", numTrees=num_trees, seed=seed,
                                            maxBins=64))
    else:
        raise ValueError(model)
    return Pipeline(stages=stages)


def fitted_features(spark: SparkSession, train: DataFrame, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> DataFrame:
    """M2-M4: what the feature stages learn, one row each: field, fitted (median,
    mode, code, mean, std), value (text), number."""
    train = stored(train.select(*numeric, *categorical))
    modes, medians = modes_of(train, categorical), medians_of(train, numeric)
    stages = build_pipeline("unused", numeric, categorical, modes=modes, medians=medians).getStages()[:-1]
    fitted = Pipeline(stages=stages).fit(train).stages
    indexer, scaler = fitted[1], fitted[3]
    rows = [(c, "median", "", float(medians[c])) for c in numeric]
    rows += [(c, "mode", modes.get(c), 0.0) for c in categorical]
    rows += [(c, "code", label, float(i)) for c, labels in zip(categorical, indexer.labelsArray) for i, label in enumerate(labels)]
    for name, values in (("mean", scaler.mean), ("std", scaler.std)):  # per feature, numbers first
        rows += [(c, name, "", float(v)) for c, v in zip(numeric, values.toArray())]
    return spark.createDataFrame(rows, "field string, fitted string, value string, number double")


def regression_metrics(pred: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """M7: R^2, MAE, MSE, RMSE as one aggregate (rows with a target and a
    prediction)."""
    e = F.col(prediction) - F.col(target)
    p = pred.where(F.col(target).isNotNull() & F.col(prediction).isNotNull())
    stats = p.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                  F.var_pop(target).alias("var_y"), F.count(F.lit(1)).alias("n"))
    return stats.select("n", "mae", "mse", F.sqrt("mse").alias("rmse"),
                        (F.lit(1.0) - F.col("mse") / F.col("var_y")).alias("r2"))


def training_rows(df: DataFrame, *, target: str | None = "arr_delay", numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES,
                  train_pct: int = 80, seed: int = 42, key: str = "flight_id"):
    """The training and the test part of the hash split, both stored in one run
    over ``df``: the rows with a target, in the columns that a fit reads."""
    target = pick_target(df.columns, target)
    need = list(dict.fromkeys([*numeric, *categorical, target]))
    rows = stored(df.where(F.col(target).isNotNull()).select(*need, in_training(train_pct, seed, key).alias("__train")))
    return rows.where("__train").select(*need), rows.where("NOT __train").select(*need)


def train(df: DataFrame, *, target: str | None = "arr_delay", numeric=NUMERIC_FEATURES,
          categorical=CATEGORICAL_FEATURES, model: str = "gbt", max_iter: int = 100,
          num_trees: int = 50, train_pct: int = 80, seed: int = 42, key: str = "flight_id", rows=None, narrow: bool = False):
    """Fit on the hash-selected training part; returns (model, test
    predictions, metrics DataFrame).  ``rows``: the ``training_rows`` of ``df``, for a
    caller who fits more than once; ``narrow``: the predictions need no more columns than
    these have (else all of ``df``, read anew)."""
    target = pick_target(df.columns, target)
    numeric = [c for c in numeric if c != target]
    part = {"train_pct": train_pct, "seed": seed, "key": key}
    tr, te = rows or training_rows(df, target=target, numeric=numeric, categorical=categorical, **part)
    fitted = build_pipeline(target, numeric, categorical, modes=modes_of(tr, categorical), medians=medians_of(tr, numeric), model=model,
                            max_iter=max_iter, num_trees=num_trees, seed=seed).fit(tr)
    scored = fitted.transform(te)
    pred = scored if narrow else fitted.transform(split(df.where(F.col(target).isNotNull()), **part)[1])
    return fitted, pred, stored(regression_metrics(scored, target))


def save(model: PipelineModel, path: str, metrics: DataFrame, target: str,
         numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> None:
    """M8: model plus a metadata record (target, features, scores)."""
    model.write().overwrite().save(os.path.join(path, "model"))
    meta = metrics.select(F.lit(target).alias("target"),
                          F.lit(json.dumps([c for c in numeric if c != target])).alias("numeric_features"),
                          F.lit(json.dumps(list(categorical))).alias("categorical_features"), "*")
    meta.coalesce(1).write.mode("overwrite").json(os.path.join(path, "metadata"))


def load(spark: SparkSession, paths, *, required: bool = False) -> PipelineModel | None:
    """M9: the model at the first candidate path that holds one, else None.
    A model that is there but does not load raises, and so does, if
    ``required``, none at any path: a named model is never quietly replaced
    by the rules."""
    from contrail.streaming.ingest import _exists
    paths = [paths] if isinstance(paths, str) else list(paths)
    for p in paths:
        if _exists(spark, os.path.join(p, "model")):
            return PipelineModel.load(os.path.join(p, "model"))
    if required:
        raise FileNotFoundError(f"no model at {', '.join(paths)}")
    return None


def predictor(model: PipelineModel | None):
    """A ``DataFrame -> DataFrame`` predictor for the ingest: the
    model's transform (batch or stream) with confidence from the error
    bands, or the rule-based predictor B when there is no model.  The bands
    compare with the departure delay, the only delay known when a flight is
    scored, also for a model of the arrival delay."""
    if model is None:
        return predict_b

    def apply(df: DataFrame) -> DataFrame:
        cols = df.columns
        scored = model.transform(df)
        gap = F.abs(F.col("prediction") - F.col("dep_delay"))
        out = scored.withColumn("predicted_delay", F.round("prediction", 2)).withColumn(
            "prediction_confidence", F.when(gap < 10, 0.90).when(gap < 20, 0.75).otherwise(0.60))
        return out.select(*cols, "predicted_delay", "prediction_confidence")
    return apply
