"""Live windows that lose no late row.

A micro-batch is summed up into states that merge by addition, (sum, count) for
each window and airline, and committed as a part of its days; a window's value is
the sum over its parts, so a row counts in whatever batch it comes, however late.
The watermark (the latest event time of the batches before, less a delay) only
marks rows as late: they are counted, and kept in a side output of their own.
The parts of a day are folded into one again and again, so a reader finds few.

A batch and its watermark are one commit of the manifest: a batch that is run again
after it adds nothing.  One output belongs to one checkpoint.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.sources import manifest
from contrail.streaming.ingest import Stores, write_part

WINDOWS, LATE = "windows", "late"
#: Parts of a day that are left before they are folded.
MOST_PARTS = 6
_STATE = ["sum_delay", "n_delay", "flight_count", "events", "late"]


def states(rows: DataFrame, duration: str, slide: str | None = None) -> DataFrame:
    """Mergeable states of each (window, airline); ``_late`` marks late rows."""
    et = F.col("timestamp").cast("timestamp")
    w = F.window(et, duration, slide) if slide else F.window(et, duration)
    return (rows.where(F.col("airline_code").isNotNull() & F.col("timestamp").isNotNull()).groupBy(w.alias("w"), "airline_code")
            .agg(F.coalesce(F.sum("dep_delay"), F.lit(0.0)).alias("sum_delay"), F.count("dep_delay").alias("n_delay"), F.count("flight_id").alias("flight_count"),
                 F.count("*").alias("events"), F.count_if("_late").alias("late"))
            .select(F.to_date("w.start").alias("day"), F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                    "airline_code", *_STATE))


def _merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy("day", "window_start", "window_end", "airline_code").agg(*[F.sum(c).alias(c) for c in _STATE])


def _delay(text: str) -> dt.timedelta:
    number, unit = text.split()
    return dt.timedelta(**{unit if unit.endswith("s") else unit + "s": float(number)})


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the checkpoint gave its stream when it was made."""
    fs, p, jvm = manifest._fs(spark, f"{checkpoint.rstrip('/')}/metadata")
    stream = fs.open(p)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def add_batch(spark: SparkSession, root: str, batch: DataFrame, batch_id: int, run: str, duration: str, slide: str | None, watermark: str) -> None:
    """Commit one batch's states, late rows and new watermark."""
    snap = manifest.snapshot(spark, root)
    if set(snap.runs) - {run}:
        raise RuntimeError(f"{root} was filled from another checkpoint: give a fresh one its own output")
    mine = snap.runs.get(run)
    if mine and mine["batch"] >= batch_id:
        return
    mark = mine["watermark"] if mine else None
    late = F.lit(False) if mark is None else F.coalesce(F.col("timestamp") < F.lit(mark).cast("timestamp_ntz"), F.lit(False))
    rows = batch.withColumn("_late", late).persist()
    stores, name = Stores(root), f"b{batch_id}"
    try:
        new = states(rows, duration, slide).persist()
        st = rows.agg(F.max(F.col("timestamp").cast("timestamp_ntz")).alias("top"), F.count_if("_late").alias("late")).first()
        by_day = {str(r["day"]): r["count"] for r in new.groupBy("day").count().collect()}  # days of one batch
        add = write_part(new, stores, WINDOWS, name, "day", by_day)
        schemas = {WINDOWS: new.schema.json()}
        if st["late"]:
            side = rows.where("_late").drop("_late").withColumns({"day": F.to_date("timestamp"), "batch_id": F.lit(batch_id), "watermark": F.lit(mark).cast("timestamp_ntz")})
            add += write_part(side, stores, LATE, name, "day", {str(r["day"]): r["count"] for r in side.groupBy("day").count().collect()})
            schemas[LATE] = side.schema.json()
        new.unpersist()
    finally:
        rows.unpersist()
    top = None if st["top"] is None else (st["top"] - _delay(watermark)).isoformat(sep=" ")
    info = {"batch": batch_id, "watermark": max((m for m in (mark, top) if m), default=None), "late": (mine["late"] if mine else 0) + st["late"]}
    manifest.commit(spark, root, snap, add=add, schemas=schemas, run=run, info=info)
    fold(spark, root, by_day)


def fold(spark: SparkSession, root: str, days=None, most: int = MOST_PARTS) -> int:
    """Merge the parts of days that have many; returns how many parts went."""
    snap = manifest.snapshot(spark, root)
    per_day: dict[str, list] = {}
    for e in snap.of(WINDOWS, days):
        per_day.setdefault(e.day, []).append(e)
    due = [e for es in per_day.values() if len(es) > most for e in es]
    if not due:
        return 0
    merged = _merged(manifest.read(spark, root, snap, WINDOWS, due)).persist()
    try:
        by_day = {str(r["day"]): r["count"] for r in merged.groupBy("day").count().collect()}
        add = write_part(merged, Stores(root), WINDOWS, "fold", "day", by_day)
        manifest.commit(spark, root, snap, add=add, remove=[e.path for e in due])
    except manifest.Conflict:  # another fold was first
        return 0
    finally:
        merged.unpersist()
    return len(due)


def drain(spark: SparkSession, stream: DataFrame, root: str, checkpoint: str, duration: str = "15 minutes", slide: str | None = None,
          watermark: str = "10 minutes", available_now: bool = True):
    """Run the windows over a stream of flights."""
    def write(batch: DataFrame, batch_id: int) -> None:
        add_batch(spark, root, batch, batch_id, "windows-" + _stream_id(spark, checkpoint), duration, slide, watermark)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")).start()
    if available_now:
        q.awaitTermination()
    return q


def windows(spark: SparkSession, root: str, lo=None, hi=None) -> DataFrame:
    """The windows as they are now: window_start, window_end, airline_code,
    avg_delay, flight_count, events and how many of them were late."""
    snap = manifest.snapshot(spark, root)
    parts = manifest.read(spark, root, snap, WINDOWS, snap.of(WINDOWS, lo=lo, hi=hi))
    if parts is None:
        raise FileNotFoundError("no window was written yet")
    return _merged(parts).select("window_start", "window_end", "airline_code", F.try_divide("sum_delay", "n_delay").alias("avg_delay"), "flight_count", "events", "late")


def late_rows(spark: SparkSession, root: str) -> DataFrame | None:
    """The late rows, with the batch that brought them and its watermark."""
    return manifest.read(spark, root, manifest.snapshot(spark, root), LATE)
