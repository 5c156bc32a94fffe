"""Retention: move old rows from the hot store to the cold store (R1-R3,
K7, K8, U1).

1. R1 size trigger: bytes of the live hot folders > threshold.
2. R2 cutoff: ``timestamp < as_of - keep`` (a parameter, never ``now()``
   inside a query).
3. archive: the old rows of the live folders up to the cutoff's day are written to a
   new folder of the cold store; of the cutoff's own day, the rows that stay
   are written to a new hot folder;
4. verify: every row of the folders read is in one of the two, by count and by id;
5. commit: the manifest adds both and ends the folders read, in one step.  This
   is the purge (K8): from then on no reader finds the old folders;
6. record: one ``archive_metadata`` row, from what the commit says.

A run that stops before the commit leaves folders that nobody reads, one that stops
behind it leaves the record to the next run.  Of two runs over the same folders
one commits and the other ends with nothing archived.  Nothing is
deleted here: ``vacuum`` does that, hours later, when no reader can still hold the
old list.  ``history`` only reads.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.sources import manifest
from contrail.sources.manifest import Snapshot
from contrail.streaming.ingest import Stores, write_part

_RUN = "archive"


def store_size_mb(snap: Snapshot, store: str) -> float:
    """Bytes of the live folders of a store, in MB; no folder is listed."""
    return sum(e.bytes for e in snap.of(store)) / (1024.0 * 1024.0)


def should_archive(spark: SparkSession, stores: Stores, threshold_mb: float = 300.0) -> bool:
    """Strictly greater than the threshold."""
    return store_size_mb(manifest.snapshot(spark, stores.root), "hot") > threshold_mb


def cutoff_of(as_of, keep_days: int = 7) -> dt.datetime:
    """R2: the instant before which rows are archived."""
    t = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    return t - dt.timedelta(days=keep_days)


def _ntz(t: dt.datetime):
    """Exact TIMESTAMP_NTZ literal (text, so no time-zone conversion)."""
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def old_rows(hot: DataFrame, cutoff: dt.datetime) -> DataFrame:
    """Rows older than the cutoff; the ``event_date`` predicate prunes
    partitions, the ``timestamp`` one is pushed into the Parquet scan."""
    return hot.where((F.col("event_date") <= F.lit(cutoff.date().isoformat()).cast("date"))
                     & (F.col("timestamp") < _ntz(cutoff)))


def history(spark: SparkSession, stores: Stores, lo=None, hi=None, snap: Snapshot | None = None) -> DataFrame:
    """Hot and cold as one table (by column name), optionally limited to
    [lo, hi]; only folders of those days are read.  A row is live in one of
    them, whatever an archive run is doing meanwhile."""
    snap = snap or manifest.snapshot(spark, stores.root)
    first, last = (None if t is None else str(t)[:10] for t in (lo, hi))
    parts = []
    for store, name in (("hot", "hot"), ("cold_archive", "cold")):
        df = manifest.read(spark, stores.root, snap, store, snap.of(store, lo=first, hi=last))
        if df is not None:
            parts.append(df.withColumn("store", F.lit(name)))
    if not parts:
        raise FileNotFoundError("no hot or cold store yet")
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p, allowMissingColumns=True)
    if lo is not None:
        df = df.where((F.col("event_date") >= F.lit(lo).cast("date")) & (F.col("timestamp") >= F.lit(lo).cast("timestamp_ntz")))
    if hi is not None:
        df = df.where((F.col("event_date") <= F.lit(hi).cast("date")) & (F.col("timestamp") <= F.lit(hi).cast("timestamp_ntz")))
    return df


def archive(spark: SparkSession, stores: Stores, as_of, *, keep_days: int = 7,
            threshold_mb: float | None = None, archive_id: str | None = None) -> dict:
    """Archive -> verify -> commit -> record.  Returns the metadata."""
    root = stores.root
    snap = manifest.snapshot(spark, root)
    if _RUN in snap.runs:
        record_archive(spark, stores, snap.runs[_RUN])  # in case the last run stopped before it
    size_before = store_size_mb(snap, "hot")
    if threshold_mb is not None and not size_before > threshold_mb:
        return {"archived": False, "reason": "below threshold", "hot_size_mb": size_before}
    cutoff = cutoff_of(as_of, keep_days)
    boundary = cutoff.date().isoformat()
    archive_id = archive_id or f"archive_{cutoff:%Y%m%dT%H%M%S}_{uuid.uuid4().hex[:8]}"
    folders = snap.of("hot", hi=boundary)
    hot = manifest.read(spark, root, snap, "hot", folders)
    if hot is None:
        raise FileNotFoundError("no hot store yet")
    total = {(str(r["event_date"]), r["old"]): r["n"] for r in hot.groupBy("event_date", (F.col("timestamp") < _ntz(cutoff)).alias("old")).agg(F.count("*").alias("n")).collect()}
    old_by_day = {d: n for (d, old), n in total.items() if old}
    kept_by_day = {d: n for (d, old), n in total.items() if not old}
    folders = [e for e in folders if e.day in old_by_day]  # a day without old rows stays as it is
    count = sum(old_by_day.values())
    meta = {
        "archive_id": archive_id, "timestamp": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" "),
        "source": stores.hot, "record_count": count, "storage_location": stores.cold_archive, "hot_size_before_mb": size_before,
        "schema_definition": json.dumps([{"name": f.name, "type": f.dataType.simpleString()} for f in hot.schema.fields]),
        "threshold_date": cutoff.isoformat(sep=" "),
    }
    if not folders:
        return meta | {"archived": True, "verified": True}
    hot = manifest.read(spark, root, snap, "hot", folders)
    moved = old_rows(hot, cutoff).withColumn("archive_id", F.lit(archive_id))
    cold = write_part(moved, stores, "cold_archive", archive_id, "event_date", old_by_day)
    stays = [e for e in folders if e.day in kept_by_day]  # folders of the cutoff's day
    kept = []
    if stays:
        rest = manifest.read(spark, root, snap, "hot", stays).where(F.col("timestamp") >= _ntz(cutoff))
        kept = write_part(rest, stores, "hot", f"kept-{archive_id}", "event_date", kept_by_day)
    if not verify(spark, stores, snap, hot, cold + kept, moved.schema.json()):
        return meta | {"archived": False, "verified": False}
    try:
        purge(spark, stores, snap, folders, cold + kept, moved.schema.json(), meta)
    except manifest.Conflict:
        return meta | {"archived": False, "verified": True, "reason": "another run was first"}
    record_archive(spark, stores, meta)
    return meta | {"archived": True, "verified": True}


def verify(spark: SparkSession, stores: Stores, snap: Snapshot, hot: DataFrame, written, cold_schema: str) -> bool:
    """Whether the new folders hold the rows of ``hot``, each as often, by id."""
    there = Snapshot(snap.version, {e.path: e for e in written}, snap.schemas | {"cold_archive": cold_schema})
    new = [manifest.read(spark, stores.root, there, s, there.of(s)).select("event_date", "flight_id") for s in ("hot", "cold_archive") if there.of(s)]
    ids = hot.select("event_date", "flight_id", F.lit(1).alias("d"))
    for df in new:
        ids = ids.unionAll(df.select("event_date", "flight_id", F.lit(-1).alias("d")))
    return ids.groupBy("event_date", "flight_id").agg(F.sum("d").alias("d")).where("d != 0").limit(1).count() == 0


def purge(spark: SparkSession, stores: Stores, snap: Snapshot, folders, new, cold_schema: str, meta: dict) -> None:
    """K8: end the folders that were archived and begin the new ones, in one commit."""
    manifest.commit(spark, stores.root, snap, add=new, remove=[e.path for e in folders], schemas={"cold_archive": cold_schema}, run=_RUN, info=meta)


def record_archive(spark: SparkSession, stores: Stores, meta: dict) -> None:
    """K7: one archive_metadata row (schema as an array of structs); written
    again it is the same."""
    row = spark.createDataFrame(
        [(meta["archive_id"], meta["timestamp"], meta["source"], meta["record_count"], meta["storage_location"],
          float(meta["hot_size_before_mb"]), meta["schema_definition"], meta["threshold_date"], True)],
        "archive_id string, timestamp string, source string, record_count long, storage_location string, "
        "hot_size_before_mb double, schema_definition string, threshold_date string, verified boolean")
    row = row.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("timestamp", "threshold_date")})
    row = row.withColumn("schema", F.from_json("schema_definition", "array<struct<name:string,type:string>>"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{stores.meta('archive_metadata')}/run={meta['archive_id']}")


def vacuum(spark: SparkSession, stores: Stores, grace_seconds: float = 3600.0) -> int:
    """Delete folders that have not been live for ``grace_seconds`` (longer than
    any reader runs)."""
    return manifest.vacuum(spark, stores.root, stores.names, grace_seconds)
