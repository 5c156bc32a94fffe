"""The keys that the hot and cold stores hold, by day.

Two stores of the manifest, one part for each write and day:

* ``keys``: the ids with their hash, sorted by it, so that a file's statistics
  tell which hashes it can hold;
* ``filters``: Bloom filters over them, as bitmaps of 32,768 bits; a day's
  write has a power of two of them, enough for ``BITS_PER_KEY`` bits for each id, and an
  id tests ``HASHES`` bits of the one bitmap its hash names.

A batch tests its ids against the filters of its own days; only days of ids that
may be there have their keys read.  ``fold`` merges parts of like size, so a
day of n ids has some log(n) parts, and each id is rewritten as often.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.sources import manifest
from contrail.sources.manifest import Entry, Snapshot

BITMAP = 8 * 4096  # bits of one bitmap of Spark's bitmap functions
BITS_PER_KEY = 12
HASHES = 4
#: Parts of one size class (a factor of 4) that are left before they are merged.
PER_CLASS = 4

KEYS, FILTERS = "keys", "filters"


def bitmaps(rows: int) -> int:
    """Bitmaps for so many ids: a power of two."""
    return 1 << max(0, math.ceil(math.log2(max(1, rows * BITS_PER_KEY / BITMAP))))


def _positions(h: Column) -> Column:
    """The bits of an id in its bitmap, from its hash."""
    again = F.xxhash64(h)
    return F.array(*[F.pmod(F.shiftright(again, 15 * i), F.lit(BITMAP)).cast("long") for i in range(HASHES)])


def _bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte.cast("long"), (position % 8).cast("int"))


def keyed(rows: DataFrame, key: str = "flight_id") -> DataFrame:
    return rows.select("event_date", F.col(key).alias("flight_id"), F.xxhash64(key).alias("h"))


def filters(keys: DataFrame, rows_by_day: dict[str, int]) -> DataFrame:
    """event_date, n_bitmaps, bitmap, bits."""
    sizes = F.create_map(*[x for d, n in sorted(rows_by_day.items()) for x in (F.lit(d), F.lit(bitmaps(n)))])
    placed = keys.select("event_date", "h", F.element_at(sizes, F.col("event_date").cast("string")).alias("n_bitmaps"))
    placed = placed.select("event_date", "n_bitmaps", F.pmod("h", "n_bitmaps").cast("int").alias("bitmap"), F.explode(_positions(F.col("h"))).alias("position"))
    return placed.groupBy("event_date", "n_bitmaps", "bitmap").agg(F.bitmap_construct_agg("position").alias("bits"))


def _write(df: DataFrame, root: str, store: str, part: str, rows: dict[str, int], order: list[str]) -> list[Entry]:
    folder = f"{root.rstrip('/')}/{store}/{part}"
    ready = df.hint("rebalance", F.col("event_date")).sortWithinPartitions("event_date", *order)
    ready.write.partitionBy("event_date").parquet(folder)
    return manifest.entries_of(df.sparkSession, root, store, folder, "event_date", rows)


def _index(keys: DataFrame, root: str, name: str, rows_by_day: dict[str, int]) -> tuple[list[Entry], dict[str, str]]:
    """Write keys and their filters into parts of one name."""
    part = manifest.fresh(root, KEYS, name).rsplit("/", 1)[1]
    bits = filters(keys, rows_by_day)
    entries = _write(keys, root, KEYS, part, rows_by_day, ["h"]) + _write(bits, root, FILTERS, part, rows_by_day, ["bitmap"])
    return entries, {KEYS: keys.schema.json(), FILTERS: bits.schema.json()}


def add(new: DataFrame, root: str, name: str, rows_by_day: dict[str, int]) -> tuple[list[Entry], dict[str, str]]:
    """Write the index of new rows; returns entries and schemas for their commit."""
    return _index(keyed(new), root, name, rows_by_day)


def maybe_present(spark: SparkSession, root: str, snap: Snapshot, ids: DataFrame, days) -> DataFrame | None:
    """The ids (event_date, flight_id, h) for which some filter of their day has
    all bits; None where their days have no filter."""
    parts = snap.of(FILTERS, days)
    if not parts:
        return None
    stored = manifest.read(spark, root, snap, FILTERS, parts).groupBy("event_date", "n_bitmaps", "bitmap").agg(F.bitmap_or_agg("bits").alias("bits"))
    sizes = stored.select("event_date", "n_bitmaps").distinct()  # a few for each day
    asked = ids.join(sizes, "event_date").withColumn("bitmap", F.pmod("h", "n_bitmaps").cast("int")).join(stored, ["event_date", "n_bitmaps", "bitmap"])
    at = _positions(F.col("h"))
    every = reduce(lambda a, b: a & b, [_bit(F.col("bits"), F.get(at, F.lit(i))) == 1 for i in range(HASHES)])
    return asked.where(every).select("event_date", "flight_id", "h").distinct()


def present(spark: SparkSession, root: str, snap: Snapshot, ids: DataFrame, days) -> DataFrame | None:
    """The ids (event_date, flight_id) that are stored; None for none at all."""
    asked = maybe_present(spark, root, snap, ids, days)
    if asked is None:
        return None
    asked = asked.persist()
    hit = [str(r[0]) for r in asked.select("event_date").distinct().collect()]  # days of one batch
    if not hit:
        asked.unpersist()
        return None
    keys = manifest.read(spark, root, snap, KEYS, snap.of(KEYS, hit))
    return asked.join(keys, ["event_date", "flight_id", "h"], "left_semi").select("event_date", "flight_id")


def _classes(parts: list[Entry]) -> dict[tuple[str, int], list[Entry]]:
    out: dict[tuple[str, int], list[Entry]] = {}
    for e in parts:
        out.setdefault((e.day, int(math.log(max(1, e.rows), 4))), []).append(e)
    return out


def fold(spark: SparkSession, root: str, days=None) -> int:
    """Merge parts of like size of a day, both keys and filters, in one commit;
    returns how many parts went.  What is stored does not change, so a conflict
    only means that another fold was first."""
    snap = manifest.snapshot(spark, root)
    due = [e for (_, _), es in _classes(snap.of(KEYS, days)).items() if len(es) > PER_CLASS for e in es]
    if not due:
        return 0
    rows: dict[str, int] = {}
    for e in due:
        rows[e.day] = rows.get(e.day, 0) + e.rows
    entries, schemas = _index(manifest.read(spark, root, snap, KEYS, due), root, "fold", rows)
    gone = [e.path for e in due] + [FILTERS + e.path[len(KEYS):] for e in due]
    try:
        manifest.commit(spark, root, snap, add=entries, remove=gone, schemas=schemas)
    except manifest.Conflict:
        return 0
    return len(gone)
