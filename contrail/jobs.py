"""Command-line jobs for ``spark-submit`` (what the scheduler runs).

    spark-submit -m contrail.jobs ingest  --stores <root> --source kafka --topic flight_events --servers host:9092
    spark-submit -m contrail.jobs archive --stores <root> --as-of 2024-01-31T00:00:00 --threshold-mb 300
    spark-submit -m contrail.jobs train   --input <history.csv|parquet> --model-out <path> --model gbt
    spark-submit -m contrail.jobs train   --input <history.csv|parquet> --registry <path> --model gbt
    spark-submit -m contrail.jobs warehouse --stores <root> --database flight_dw
    spark-submit -m contrail.jobs compact --stores <root>
    spark-submit -m contrail.jobs vacuum  --stores <root> --grace-seconds 3600

The stores root defaults to ``<spark.checkpoint.dir>/stores`` (shared
storage on a cluster).  Each job is safe to re-run: the ingest resumes from
its checkpoint and its writes are keyed, an archive run or a compaction is one
commit, the warehouse DDL is ``IF NOT EXISTS``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession


def _stores(spark: SparkSession, root: str | None, run: str = "main"):
    from contrail.streaming.ingest import Stores, default_stores
    return Stores(root, run) if root else Stores(default_stores(spark).root, run)


def ingest(spark: SparkSession, a) -> None:
    from contrail.operators import ml
    from contrail.sources.stream import open_stream
    from contrail.streaming.ingest import run_ingest
    msgs = open_stream(spark, a.source, path=a.path, topic=a.topic, servers=a.servers,
                       max_per_trigger=a.max_per_trigger)
    model = ml.load(spark, a.model, required=True) if a.model else None
    run_ingest(spark, msgs, _stores(spark, a.stores, a.run), predictor=ml.predictor(model), models=a.models,
               dedup_watermark=a.dedup_watermark, available_now=not a.continuous)


def archive(spark: SparkSession, a) -> None:
    from contrail.operators import retention
    meta = retention.archive(spark, _stores(spark, a.stores), a.as_of, keep_days=a.keep_days,
                             threshold_mb=a.threshold_mb)
    print(json.dumps({k: str(v) for k, v in meta.items()}))


def train(spark: SparkSession, a) -> None:
    from contrail.operators import ml
    from contrail.sources.files import read_history_csv
    df = read_history_csv(spark, a.input) if a.input.endswith(".csv") else spark.read.parquet(a.input)
    if "flight_id" not in df.columns:
        from pyspark.sql import functions as F
        df = df.withColumn("flight_id", F.xxhash64(*df.columns).cast("string"))
    fitted, _, metrics = ml.train(df, target=a.target, model=a.model, max_iter=a.max_iter)
    target = ml.pick_target(df.columns, a.target)
    out = metrics.first().asDict()
    if a.model_out:
        ml.save(fitted, a.model_out, metrics, target)
    if a.registry:
        from contrail.operators import registry
        out["version"] = registry.publish(spark, a.registry, fitted, metrics, target)
    print(json.dumps(out))


def compact(spark: SparkSession, a) -> None:
    from contrail.operators import compaction
    st = _stores(spark, a.stores)
    print(json.dumps({s: compaction.compact(spark, st, s, target_bytes=a.target_mb << 20) for s in compaction.DAY_COLUMNS}))


def vacuum(spark: SparkSession, a) -> None:
    from contrail.operators import retention
    print(json.dumps({"folders": retention.vacuum(spark, _stores(spark, a.stores), a.grace_seconds)}))


def warehouse(spark: SparkSession, a) -> None:
    from contrail.sources.warehouse import create_metadata, create_warehouse
    st = _stores(spark, a.stores)
    print(json.dumps(create_warehouse(spark, st, a.database) + create_metadata(spark, st, a.database)))


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="contrail.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--stores")
    i.add_argument("--run", default="main")
    i.add_argument("--source", default="kafka", choices=["kafka", "json", "text"])
    i.add_argument("--path")
    i.add_argument("--topic", default="flight_events")
    i.add_argument("--servers", default="localhost:9092")
    i.add_argument("--max-per-trigger", type=int, help="messages or files a trigger; all there is by default")
    i.add_argument("--model", nargs="*")
    i.add_argument("--models", help="a model registry: each batch is scored by the version that serves then")
    i.add_argument("--dedup-watermark")
    i.add_argument("--continuous", action="store_true")
    r = sub.add_parser("archive")
    r.add_argument("--stores")
    r.add_argument("--as-of", required=True)
    r.add_argument("--keep-days", type=int, default=7)
    r.add_argument("--threshold-mb", type=float)
    t = sub.add_parser("train")
    t.add_argument("--input", required=True)
    t.add_argument("--model-out")
    t.add_argument("--registry")
    t.add_argument("--target", default="arr_delay")
    t.add_argument("--model", default="gbt", choices=["gbt", "rf"])
    t.add_argument("--max-iter", type=int, default=100)
    w = sub.add_parser("warehouse")
    w.add_argument("--stores")
    w.add_argument("--database", default="flight_dw")
    c = sub.add_parser("compact")
    c.add_argument("--stores")
    c.add_argument("--target-mb", type=int, default=128)
    v = sub.add_parser("vacuum")
    v.add_argument("--stores")
    v.add_argument("--grace-seconds", type=float, default=3600.0)
    a = p.parse_args(argv)
    if a.job == "train" and not (a.model_out or a.registry):
        p.error("train needs --model-out or --registry")
    from contrail.session import job_spark
    spark = job_spark(f"contrail-{a.job}")
    {"ingest": ingest, "archive": archive, "train": train, "warehouse": warehouse, "compact": compact, "vacuum": vacuum}[a.job](spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
