"""Compaction of the stores (K2-K4): small folders of a day become few.

The live folders of a day are put into bins of at most ``target_bytes``, largest
first; a bin of several folders is rewritten as one, all bins in one Spark job, one
task for each bin.  One commit of the manifest swaps them, so readers see each row
once throughout, and a writer or archive run that was faster wins.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.sources import manifest
from contrail.sources.manifest import Entry
from contrail.streaming.ingest import Stores

#: The day column of each store.
DAY_COLUMNS = {"hot": "event_date", "cold_archive": "event_date", "cold": "processing_date", "warehouse/staging_flight_events": "processing_date",
               "warehouse/fact_flight_events": "processing_date", "warehouse/predictions": "prediction_date"}


def bins(entries: Iterable[Entry], target_bytes: int) -> list[list[Entry]]:
    """First fit, largest first, day by day; only bins that are worth a rewrite:
    several folders, or one folder of several small files."""
    out: list[list[Entry]] = []
    by_day: dict[str, list[Entry]] = {}
    for e in entries:
        by_day.setdefault(e.day, []).append(e)
    for day in sorted(by_day):
        open_bins: list[tuple[int, list[Entry]]] = []
        for e in sorted(by_day[day], key=lambda e: (-e.bytes, e.path)):
            if e.bytes > target_bytes:
                continue  # large enough as it is
            for i, (size, held) in enumerate(open_bins):
                if size + e.bytes <= target_bytes:
                    open_bins[i] = (size + e.bytes, held + [e])
                    break
            else:
                open_bins.append((e.bytes, [e]))
        out += [held for _, held in open_bins if len(held) > 1 or sum(e.files for e in held) > 1]
    return out


def compact(spark: SparkSession, stores: Stores, store: str = "hot", *, target_bytes: int = 128 << 20, lo: str | None = None, hi: str | None = None) -> dict:
    """Compact one store between two days; returns folders and files before and
    after.  A conflict leaves everything as it was."""
    snap = manifest.snapshot(spark, stores.root)
    live = snap.of(store, lo=lo, hi=hi)
    chosen = bins(live, target_bytes)
    before = {"folders_before": len(live), "files_before": sum(e.files for e in live)}
    if not chosen:
        return before | {"folders": len(live), "files": before["files_before"], "compacted": True}
    day = DAY_COLUMNS[store]
    numbered = [manifest.read(spark, stores.root, snap, store, held).withColumn("_bin", F.lit(i)) for i, held in enumerate(chosen)]
    folder = manifest.fresh(stores.root, store, "compact")
    _one_task_for_each(numbered, len(chosen)).write.partitionBy(day).parquet(folder)
    rows: dict[str, int] = {}
    for held in chosen:
        rows[held[0].day] = rows.get(held[0].day, 0) + sum(e.rows for e in held)
    new = manifest.entries_of(spark, stores.root, store, folder, day, rows)
    got = {str(r[0]): r[1] for r in spark.read.schema(numbered[0].schema).parquet(folder).groupBy(day).count().collect()}
    if got != rows:
        raise RuntimeError(f"compaction of {store} wrote {got}, expected {rows}")
    try:
        now = manifest.commit(spark, stores.root, snap, add=new, remove=[e.path for held in chosen for e in held])
    except manifest.Conflict:
        return before | {"folders": len(live), "files": before["files_before"], "compacted": False}
    after = now.of(store, lo=lo, hi=hi)
    return before | {"folders": len(after), "files": sum(e.files for e in after), "compacted": True}


def _one_task_for_each(parts: list[DataFrame], n: int) -> DataFrame:
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    return df.repartitionByRange(n, "_bin").drop("_bin")
