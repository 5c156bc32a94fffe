"""Model registry (M8, M9, P11): saved models by their digest, and which one serves.

A model is saved under a folder named by the digest of its files, so a version
names exactly one model and never changes.  Which version serves is one commit of
the registry's manifest.  ``Serving`` looks that up once for each batch: a version
published while a stream runs scores the next batch, and each row says which
version scored it.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators import ml
from contrail.operators.predict import MODEL_VERSION, predict_b
from contrail.sources import manifest

_CURRENT = "current"


def digest(spark: SparkSession, path: str) -> str:
    """A digest of a saved model's files (a few for each stage)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    names = files.select(F.sha2("content", 256).alias("d"))
    return names.agg(F.sha2(F.array_join(F.sort_array(F.collect_list("d")), ""), 256).alias("v")).first()["v"][:16]


def publish(spark: SparkSession, root: str, model: PipelineModel, metrics: DataFrame, target: str) -> str:
    """Save a model and let it serve; returns its version."""
    base = root.rstrip("/")
    tmp = f"{base}/_new-{uuid.uuid4().hex}"
    ml.save(model, tmp, metrics, target)
    version = digest(spark, f"{tmp}/model")
    fs, p, jvm = manifest._fs(spark, tmp)
    home = jvm.org.apache.hadoop.fs.Path(f"{base}/{version}")
    if not fs.exists(home):
        fs.rename(p, home)
    serve(spark, root, version)
    return version


def serve(spark: SparkSession, root: str, version: str) -> None:
    """Let a saved version serve (also an older one, again)."""
    fs, p, _ = manifest._fs(spark, f"{root.rstrip('/')}/{version}/model")
    if not fs.exists(p):
        raise FileNotFoundError(f"no model {version} under {root}")
    manifest.commit(spark, root, manifest.snapshot(spark, root), run=_CURRENT, info={"version": version})


def current(spark: SparkSession, root: str) -> str | None:
    """The version that serves now."""
    return manifest.snapshot(spark, root).runs.get(_CURRENT, {}).get("version")


def load(spark: SparkSession, root: str, version: str) -> PipelineModel:
    """A version's model; raises if its files are not those that were saved."""
    path = f"{root.rstrip('/')}/{version}/model"
    if digest(spark, path) != version:
        raise ValueError(f"the files of model {version} have changed")
    return PipelineModel.load(path)


class Serving:
    """A predictor that scores with the version current when it is called; the
    rules where no model was published."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._loaded: tuple[str, PipelineModel] | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        version = current(self.spark, self.root)
        if version is None:
            return predict_b(df).withColumn("model_version", F.lit(MODEL_VERSION))
        if self._loaded is None or self._loaded[0] != version:
            self._loaded = (version, load(self.spark, self.root, version))
        return ml.predictor(self._loaded[1])(df).withColumn("model_version", F.lit(version))
