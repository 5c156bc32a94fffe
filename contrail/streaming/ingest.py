"""Streaming ingest.

stream -> decode -> clean -> predict -> ``foreachBatch(fan_out)``:

* hot store: keyed **insert-ignore** on ``flight_id``: one row per id inside the
  batch, then the ids that the key index (``key_index``) has for the batch's days
  go; no store folder is listed and no stored row is read for a new id;
* cold archive and warehouse staging: the same new rows; fact and prediction
  rows are views over staging (or materialised on request);
* dead letters: messages without an id, with their text, the kind of fault and
  where they came from;
* metadata: one ``batch_metadata`` row.

All folders of a batch become live in one commit of the manifest.  A batch that
stops before it leaves folders that nobody reads; run again, after the commit as
well, it finds its ids present and adds nothing.  Writes are ``REBALANCE``d: AQE cuts
a large day into several files and joins small ones, and ``compaction`` merges
what small batches leave.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.clean import clean_events, enriched_projection
from contrail.operators.predict import MODEL_VERSION, fact_projection, predict_b, prediction_projection
from contrail.schema import ARCHIVE_COLUMNS
from contrail.session import checkpoint_dir
from contrail.sources import manifest
from contrail.sources.manifest import Entry, Snapshot
from contrail.sources.stream import LETTER_COLUMNS, decode_events
from contrail.streaming import key_index


@dataclass(frozen=True)
class Stores:
    """Locations of the stores under one shared root; ``run`` names the
    stream checkpoint (a new name replays the source from the start)."""
    root: str
    run: str = "main"

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    @property
    def hot(self) -> str:
        return self.path("hot")

    @property
    def cold(self) -> str:
        return self.path("cold")

    @property
    def cold_archive(self) -> str:
        """Cold store written by the retention job."""
        return self.path("cold_archive")

    @property
    def quarantine(self) -> str:
        """Dead letters."""
        return self.path("quarantine")

    @property
    def names(self) -> tuple[str, ...]:
        """The stores that the manifest keeps."""
        return ("hot", "cold", "cold_archive", "quarantine", "mended", "warehouse/staging_flight_events",
                "warehouse/fact_flight_events", "warehouse/predictions", key_index.KEYS, key_index.FILTERS)

    def warehouse(self, table: str) -> str:
        return self.path(f"warehouse/{table}")

    def meta(self, table: str) -> str:
        return self.path(f"meta/{table}")

    @property
    def checkpoint(self) -> str:
        return self.path(f"_checkpoint/{self.run}")


def default_stores(spark: SparkSession, name: str = "stores") -> Stores:
    """Stores under the shared checkpoint folder of the session."""
    return Stores(os.path.join(checkpoint_dir(spark), name))


def _exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds table data: the folder exists and has a
    visible entry (a data file or a partition folder)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))


def prepare(decoded: DataFrame, *, predictor=predict_b, processing_time=None) -> DataFrame:
    """decode output -> enriched hot rows (narrow, no shuffle)."""
    cleaned = clean_events(decoded, processing_time=processing_time, derive_id=True)
    return enriched_projection(predictor(cleaned), ingestion_time=processing_time)


#: Columns that differ between two attempts at the same message.
_RUN_COLUMNS = ("ingestion_timestamp", "processing_timestamp", "processing_date", "batch_key")


def one_per_key(batch: DataFrame, key: str = "flight_id") -> DataFrame:
    """One row per key, the same one on every attempt: the least by two hashes
    of the message's own columns."""
    own = [c for c in batch.columns if c not in _RUN_COLUMNS]
    row = F.struct(*batch.columns)
    return batch.groupBy(key).agg(F.min_by(row, F.struct(F.xxhash64(*own), F.xxhash64(*own[::-1]))).alias("_row")).select("_row.*")


def insert_ignore(spark: SparkSession, batch: DataFrame, stores: Stores, snap: Snapshot, days: Iterable[str]) -> DataFrame:
    """Rows of ``batch`` whose id neither the hot store nor the archive
    holds.  Only the index of the batch's days is read."""
    rows = one_per_key(batch.where(F.col("flight_id").isNotNull()))
    known = key_index.present(spark, stores.root, snap, key_index.keyed(rows), days)
    return rows if known is None else rows.join(known, ["event_date", "flight_id"], "left_anti")


#: Rows of a day beyond which more than one task writes them, however small they are.
ROWS_PER_TASK = 250_000


def write_part(df: DataFrame, stores: Stores, store: str, name: str, day_column: str, rows: dict[str, int]) -> list[Entry]:
    """Write rows as a new part of a store; its entries are not live before they
    are committed.  AQE cuts days by their bytes and joins small ones; a day of
    many rows is cut by their number (``rows``: rows per day)."""
    folder = manifest.fresh(stores.root, store, name)
    slices = {d: -(-n // ROWS_PER_TASK) for d, n in rows.items()}
    if max(slices.values(), default=1) > 1:
        of_day = F.create_map(*[x for d, k in sorted(slices.items()) for x in (F.lit(d), F.lit(k))])
        own = [c for c in df.columns if c != day_column]
        ready = df.repartition(sum(slices.values()), F.col(day_column), F.pmod(F.xxhash64(*own), F.element_at(of_day, F.col(day_column).cast("string"))))
    else:
        ready = df.hint("rebalance", F.col(day_column))
    ready.write.partitionBy(day_column).parquet(folder)
    return manifest.entries_of(df.sparkSession, stores.root, store, folder, day_column, rows)


def dead_letters(rows: DataFrame, batch_key: str) -> DataFrame:
    """Rows without an id as letters: one for each text and position, with the
    number of times it stands there."""
    own = [c for c in rows.columns if c not in (*_RUN_COLUMNS, *LETTER_COLUMNS, "event_date")]
    raw = F.col("_raw") if "_raw" in rows.columns else F.lit(None).cast("string")
    error = F.col("_error") if "_error" in rows.columns else F.lit(None).cast("string")
    position = F.col("_position") if "_position" in rows.columns else F.lit(None).cast("string")
    letters = rows.where(F.col("flight_id").isNull()).select(
        F.coalesce(raw, F.to_json(F.struct(*own))).alias("raw"), F.coalesce(error, F.lit("no_key")).alias("error"), F.coalesce(position, F.lit("")).alias("position"),
        F.col("ingestion_timestamp").alias("arrived"), F.to_date("ingestion_timestamp").alias("arrival_date"))
    letters = letters.withColumn("letter_id", F.sha2(F.concat_ws("\x00", "position", "raw"), 256))
    return (letters.groupBy("letter_id").agg(F.min("raw").alias("raw"), F.min("error").alias("error"), F.min("position").alias("position"), F.min("arrived").alias("arrived"),
                                             F.min("arrival_date").alias("arrival_date"), F.count("*").alias("copies")).withColumn("batch_key", F.lit(batch_key)))


def _days(df: DataFrame, column: str) -> dict[str, int]:
    return {str(r[0]): r[1] for r in df.groupBy(column).count().collect() if r[0] is not None}  # days of one batch


def fan_out(spark: SparkSession, stores: Stores, batch: DataFrame, batch_id: int, *,
            materialize_projections: bool = False, replaces: Iterable[Entry] = (), mended: DataFrame | None = None, adds: Iterable[Entry] = ()) -> dict:
    """Write one micro-batch to every store and commit it (T8).  ``batch_key`` =
    ``<run>-<batch id>`` names the batch across checkpoints (batch ids restart at 0
    with a fresh checkpoint).  ``replaces``, ``adds``: folders that this commit
    ends and begins besides; ``mended``: letters that it settles (all for
    ``replay_dead_letters``)."""
    rows = (batch.withColumn("event_date", F.to_date("timestamp"))
            .withColumn("batch_key", F.lit(f"{stores.run}-{batch_id}")))
    if "model_version" not in rows.columns:
        rows = rows.withColumn("model_version", F.lit(MODEL_VERSION))
    rows = rows.persist()
    try:
        for attempt in range(8):
            try:
                return _fan_out(spark, stores, rows, batch_id, materialize_projections, list(replaces), mended, list(adds))
            except manifest.Conflict:  # another writer brought ids of these days: look them up again
                if attempt == 7:
                    raise
    finally:
        rows.unpersist()


def _fan_out(spark: SparkSession, stores: Stores, rows: DataFrame, batch_id: int, materialize: bool, replaces: list[Entry],
             mended: DataFrame | None, adds: list[Entry]) -> dict:
    bk = f"{stores.run}-{batch_id}"
    root = stores.root
    snap = manifest.snapshot(spark, root)
    # one job over the cached batch: NULL ids and event dates (a handful of days per micro-batch)
    st = rows.agg(F.count_if(F.col("flight_id").isNull()).alias("nulls"), F.collect_set(F.when(F.col("flight_id").isNotNull(), F.col("event_date"))).alias("days")).first()
    days = [str(d) for d in st["days"]]
    add: list[Entry] = list(adds)
    schemas: dict[str, str] = {}

    def put(df: DataFrame, store: str, day_column: str, count: dict[str, int]) -> None:
        add.extend(write_part(df, stores, store, bk, day_column, count))
        schemas[store] = df.schema.json()

    letters = 0
    if st["nulls"]:
        dead = dead_letters(rows, bk)
        for known in ("quarantine", "mended"):
            seen = manifest.read(spark, root, snap, known, [e for e in snap.of(known) if e not in replaces])
            if seen is not None:
                dead = dead.join(seen.select("letter_id"), "letter_id", "left_anti")
        dead = dead.persist()
        by_day = _days(dead, "arrival_date")
        letters = sum(by_day.values())
        if letters:
            put(dead, "quarantine", "arrival_date", by_day)
        dead.unpersist()
    new = insert_ignore(spark, rows.drop(*LETTER_COLUMNS), stores, snap, days).persist()
    try:
        measured = new.groupBy("event_date", "processing_date").agg(F.count("*").alias("n"), F.count_if(F.col("data_quality_score") < 1).alias("low")).collect()
        by_event: dict[str, int] = {}
        by_run: dict[str, int] = {}
        for r in measured:
            by_event[str(r["event_date"])] = by_event.get(str(r["event_date"]), 0) + r["n"]
            by_run[str(r["processing_date"])] = by_run.get(str(r["processing_date"]), 0) + r["n"]
        count, low = sum(by_event.values()), sum(r["low"] for r in measured)
        if count:
            writes = [lambda: put(new, "hot", "event_date", by_event),
                      lambda: put(new.select(*ARCHIVE_COLUMNS, "processing_date", "batch_key"), "cold", "processing_date", by_run),
                      lambda: put(new, "warehouse/staging_flight_events", "processing_date", by_run)]
            if materialize:
                # Fact and prediction rows are projections of staging; by default they are catalog
                # views over it (create_warehouse), which saves two copies of every batch.
                writes += [lambda: put(fact_projection(new).withColumn("batch_key", F.lit(bk)), "warehouse/fact_flight_events", "processing_date", by_run),
                           lambda: put(prediction_projection(new).withColumn("batch_key", F.lit(bk)), "warehouse/predictions", "prediction_date", by_run)]
            # the stores do not depend on one another before the commit: their jobs share the cluster
            with ThreadPoolExecutor(len(writes) + 1) as pool:
                index = pool.submit(key_index.add, new, root, bk, by_event)
                for done in [pool.submit(w) for w in writes]:
                    done.result()
                entries, index_schemas = index.result()
            add += entries
            schemas |= index_schemas
    finally:
        new.unpersist()
    if mended is not None:
        put(mended, "mended", "arrival_date", {})
    before = snap.runs.get(stores.run, {})
    if not add and not replaces and before.get("batch_key") == bk:  # this batch again: as its first commit left it
        _batch_metadata(spark, stores, before)
        return before
    info = {"batch_key": bk, "record_count": count, "low_quality": low, "dead_letters": letters, "schema": rows.schema.json(),
            "file_size_mb": sum(e.bytes for e in add if e.store == "cold") / (1024.0 * 1024.0),
            "storage_location": next((e.path.rsplit("/", 1)[0] for e in add if e.store == "cold"), "")}
    manifest.commit(spark, root, snap, add=add, remove=[e.path for e in replaces], schemas=schemas, run=stores.run, info=info,
                    guard=[(key_index.KEYS, d) for d in days])
    _batch_metadata(spark, stores, info)
    key_index.fold(spark, root, days)
    return info


def _batch_metadata(spark: SparkSession, stores: Stores, info: dict) -> None:
    """K6: the batch's row, from what its commit says; written again it is the same."""
    meta = spark.createDataFrame(
        [(info["batch_key"], info["record_count"], info["low_quality"], info["dead_letters"], info["file_size_mb"], f"archive_{info['batch_key']}",
          info["storage_location"], "flight_event_v1", "completed")],
        "batch_id string, record_count long, low_quality long, dead_letters long, file_size_mb double, archive_id string, "
        "storage_location string, schema_id string, processing_status string")
    (meta.withColumn("timestamp", F.current_timestamp()).withColumn("schema", F.lit(info["schema"])).coalesce(1)
     .write.mode("overwrite").parquet(f"{stores.meta('batch_metadata')}/batch_key={info['batch_key']}"))


def replay_dead_letters(spark: SparkSession, stores: Stores, mend, *, predictor=predict_b, processing_time=None) -> dict:
    """Send the dead letters through the ingest again, each text changed by ``mend``
    (Column -> Column; null leaves a letter where it is).  One commit adds what
    now has an id, ends the old letters and keeps those that still fail, so a
    replay that stops is run again and a mended message enters once."""
    snap = manifest.snapshot(spark, stores.root)
    parts = snap.of("quarantine")
    letters = manifest.read(spark, stores.root, snap, "quarantine", parts)
    if letters is None or not parts:
        return {"record_count": 0}
    tried = letters.withColumn("value", mend(F.col("raw"))).persist()
    try:
        messages = tried.select(F.coalesce("value", "raw").alias("value"), F.col("position").alias("source_position"), F.col("arrived").alias("kafka_timestamp"), "letter_id")
        decoded = prepare(decode_events(messages, fallback_time=F.col("kafka_timestamp")), predictor=predictor, processing_time=processing_time)
        settled = tried.join(_with_id(messages), "letter_id", "left_semi").select("letter_id", "arrival_date", "batch_key")
        run = Stores(stores.root, "mend")
        again = tried.join(settled.select("letter_id"), "letter_id", "left_anti").select(*letters.columns)
        return _replay(spark, run, snap, decoded.where(F.col("flight_id").isNotNull()), settled, again, parts)
    finally:
        tried.unpersist()


def _with_id(messages: DataFrame) -> DataFrame:
    """letter_id of the messages that decode to a row with an id."""
    decoded = clean_events(decode_events(messages, fallback_time=F.col("kafka_timestamp")), derive_id=True)
    return decoded.where(F.col("flight_id").isNotNull()).select("letter_id")


def _replay(spark: SparkSession, stores: Stores, snap: Snapshot, good: DataFrame, settled: DataFrame, again: DataFrame, parts: list[Entry]) -> dict:
    batch_id = int(snap.runs[stores.run]["batch_key"].rsplit("-", 1)[1]) + 1 if stores.run in snap.runs else 0
    kept = write_part(again, stores, "quarantine", f"{stores.run}-{batch_id}", "arrival_date", _days(again, "arrival_date"))
    return fan_out(spark, stores, good, batch_id, replaces=parts, mended=settled, adds=kept)


def run_ingest(spark: SparkSession, messages: DataFrame, stores: Stores, *,
               predictor=predict_b, models: str | None = None, processing_time=None, dedup_watermark: str | None = None,
               query_name: str | None = None, available_now: bool = True):
    """Drain the message stream (``availableNow``) through
    ``fan_out`` with a durable checkpoint, then stop.  ``dedup_watermark``
    adds in-stream de-duplication of ids within the watermark (T5); the
    durable dedup is the insert-ignore of the hot store.  ``models`` names a
    model registry: each batch is scored by the version that serves when it
    starts (T6), in place of ``predictor``."""
    # a message without a time takes the source's, which a replay sees again
    arrived = F.col("kafka_timestamp") if "kafka_timestamp" in messages.columns else None
    rows = clean_events(decode_events(messages, fallback_time=arrived), processing_time=processing_time, derive_id=True)
    if dedup_watermark:
        rows = dedup_in_stream(rows, dedup_watermark)
    if models:
        from contrail.operators.registry import Serving
        predictor = Serving(spark, models)

    def write(batch: DataFrame, batch_id: int) -> None:
        fan_out(spark, stores, enriched_projection(predictor(batch), ingestion_time=processing_time), batch_id)

    w = rows.writeStream.foreachBatch(write).option("checkpointLocation", stores.checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def dedup_in_stream(df: DataFrame, watermark: str = "10 minutes", key: str = "flight_id") -> DataFrame:
    """T5: one row per id among those that arrive within ``watermark`` of each
    other.  The state is kept by arrival, not by event time, so no row is
    ever too late for it: an event from last week passes like any other.
    Rows without an id all pass (they are quarantined later)."""
    return (df.withColumn("_arrival", F.current_timestamp())
            .withColumn("_id", F.coalesce(F.col(key), F.concat(F.lit("null-"), F.expr("uuid()"))))
            .withWatermark("_arrival", watermark)
            .dropDuplicatesWithinWatermark(["_id"]).drop("_arrival", "_id"))


def read_store(spark: SparkSession, stores: Stores, store: str = "hot", snap: Snapshot | None = None) -> DataFrame:
    """The live rows of a store."""
    snap = snap or manifest.snapshot(spark, stores.root)
    df = manifest.read(spark, stores.root, snap, store)
    if df is None:
        raise FileNotFoundError(f"nothing was written to {store} yet")
    return df


def read_hot(spark: SparkSession, stores: Stores) -> DataFrame:
    return read_store(spark, stores, "hot")
