"""Live windowed aggregates on a stream.

Watermarked tumbling or sliding windows per airline.  ``append`` mode
emits a window only once the watermark passes its end, so an
``availableNow`` drain of bounded input emits nothing for the last
windows; ``complete`` (bounded window count) or ``update`` into a keyed
overwrite are used instead.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def windowed_airline_delay(df: DataFrame, duration: str = "15 minutes", slide: str | None = None,
                           watermark: str = "10 minutes") -> DataFrame:
    """Mean departure delay and flights per (window, airline)."""
    et = F.col("timestamp").cast("timestamp")
    w = F.window("_et", duration, slide) if slide else F.window("_et", duration)
    return (df.withColumn("_et", et).withWatermark("_et", watermark)
            .where(F.col("airline_code").isNotNull())
            .groupBy(w.alias("w"), "airline_code")
            .agg(F.avg("dep_delay").alias("avg_delay"), F.count("flight_id").alias("flight_count"),
                 F.count(F.lit(1)).alias("events")))


def drain_to_table(spark: SparkSession, agg: DataFrame, out_path: str, checkpoint: str,
                   mode: str = "complete") -> DataFrame:
    """Run a streaming aggregate to completion (``availableNow``) and keep
    its final state as Parquet at ``out_path``; returns it as a batch
    DataFrame.  Each micro-batch of a ``complete`` aggregate replaces the
    table (idempotent on retry)."""
    if mode != "complete":
        raise ValueError("only a complete aggregate may replace its table; use drain_updates for the others")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    q = (agg.writeStream.outputMode(mode).foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)


def drain_updates(spark: SparkSession, agg: DataFrame, out_path: str, checkpoint: str,
                  keys=("w", "airline_code"), available_now: bool = True):
    """Run a watermarked aggregate in ``update`` mode: the watermark evicts
    finished windows from the state store (bounded state on an endless
    stream), and each micro-batch appends only the windows it changed under
    ``batch_id=N`` (overwritten on retry, so idempotent).  Read the
    current result with ``latest_windows``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = (agg.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")).start()
    if available_now:
        q.awaitTermination()
    return q


def latest_windows(spark: SparkSession, out_path: str, keys=("w", "airline_code")) -> DataFrame:
    """Latest version of every (window, key) row written by
    ``drain_updates``: one aggregate with ``max_by`` on the batch id."""
    df = spark.read.parquet(out_path)
    vals = [c for c in df.columns if c not in keys and c != "batch_id"]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*vals), "batch_id").alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])


def scratch(spark: SparkSession, name: str) -> tuple[str, str]:
    """(output, checkpoint) locations for one run under the shared folder."""
    from contrail.session import checkpoint_dir
    import uuid
    base = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    return os.path.join(base, "out"), os.path.join(base, "_checkpoint")
