"""The life of stored rows: dead letters, late rows, live enrichment, archive runs
that stop, compaction, catalogue and metadata, model versions, stored sketches."""

import os
import uuid

from pyspark.sql import functions as F

from contrail.operators import compaction, ml, registry, retention, sketches
from contrail.operators.enrich import enrich_stream
from contrail.operators.insight import split
from contrail.plans.oracle_views import FLIGHT_EVENTS, ts_text, with_history, with_hot
from contrail.plans.q_store import _CUT_MID, _decoded
from contrail.plans.registry import register
from contrail.plans.views import PROCESSING_TIME, hot_events, hot_history
from contrail.session import checkpoint_dir
from contrail.sources import manifest
from contrail.sources.airports import AIRPORTS, airports
from contrail.sources.stream import encode_events, open_stream
from contrail.sources.tables import airlines, event_airports, events_as_flights, flight_events, read_table
from contrail.streaming import ingest, windows


def _scratch(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


@register("retention_interrupted", "WITH " + FLIGHT_EVENTS + f"""
, n AS (SELECT count(*) FILTER (WHERE "timestamp" < {_CUT_MID}) AS old, count(*) FILTER (WHERE "timestamp" >= {_CUT_MID}) AS young FROM flight_events)
SELECT 'before' AS step, old + young AS hot, 0 AS cold FROM n
UNION ALL SELECT 'stopped', old + young, 0 FROM n
UNION ALL SELECT 'archived', young, old FROM n
UNION ALL SELECT 'again', young, old FROM n
UNION ALL SELECT 'vacuumed', young, old FROM n""")
def retention_interrupted(spark, sf):
    """What a reader finds before an archive run, after one that stopped
    with all its folders written, after a whole run, a second one and a vacuum."""
    stores = ingest.default_stores(spark, "interrupted-" + uuid.uuid4().hex[:12])
    ingest.fan_out(spark, stores, ingest.prepare(_decoded(spark, sf), processing_time=PROCESSING_TIME), 0)
    as_of = "2024-01-30 12:00:00"
    reads = []

    def read(step):
        h = retention.history(spark, stores)
        r = h.agg(F.count_if(F.col("store") == "hot").alias("hot"), F.count_if(F.col("store") == "cold").alias("cold")).first()
        reads.append((step, r["hot"], r["cold"]))

    read("before")
    moved = retention.old_rows(ingest.read_hot(spark, stores), retention.cutoff_of(as_of, 7))
    ingest.write_part(moved, stores, "cold_archive", "stopped", "event_date", {})  # a run that stops before its commit leaves this
    read("stopped")
    for step in ("archived", "again"):
        retention.archive(spark, stores, as_of, keep_days=7)
        read(step)
    retention.vacuum(spark, stores, 0)
    read("vacuumed")
    return spark.createDataFrame(reads, "step string, hot long, cold long")


_BAD = "event_id % 40 = 0"


@register("ingest_quarantine", "WITH " + FLIGHT_EVENTS + f"""
SELECT 'letter' AS kind, 'malformed' AS error, '{{"event": ' || event_id AS raw, 1 AS n FROM events WHERE {_BAD} AND event_id % 80 <> 0
UNION ALL SELECT 'mended', '', 'M_' || event_id, 1 FROM events WHERE {_BAD} AND event_id % 80 = 0
UNION ALL SELECT 'hot', '', '', count(*) FROM events WHERE NOT ({_BAD})""")
def ingest_quarantine(spark, sf):
    """S2, dead letters: every 40th message is cut short.  The stream is read twice
    (a fresh checkpoint the second time), half of the letters are mended and
    replayed, twice; the others keep their text."""
    events = read_table(spark, sf, "events")
    good = encode_events(events_as_flights(events.where("event_id % 40 != 0")))
    bad = events.where(_BAD).select(F.concat(F.lit('{"event": '), "event_id").alias("value"))
    src = _scratch(spark, "letters")
    good.union(bad).write.text(src)
    stores = ingest.Stores(_scratch(spark, "quarantine"))
    for run in ("first", "replay"):
        ingest.run_ingest(spark, open_stream(spark, "text", path=src), ingest.Stores(stores.root, run), processing_time=PROCESSING_TIME)

    def mend(raw):
        number = F.regexp_extract(raw, "([0-9]+)$", 1)
        whole = F.concat(F.lit('{"timestamp": "2024-02-01T00:00:00", "AIRLINE_CODE": "M", "ORIGIN": "'), number, F.lit('", "DEST": "X"}'))
        return F.when(number.cast("long") % 80 == 0, whole)

    for _ in range(2):
        ingest.replay_dead_letters(spark, stores, mend, processing_time=PROCESSING_TIME)
    hot = ingest.read_hot(spark, stores)
    letters = ingest.read_store(spark, stores, "quarantine").select(F.lit("letter").alias("kind"), "error", "raw", F.col("copies").alias("n"))
    mended = hot.where("airline_code = 'M'").groupBy("origin").agg(F.count("*").alias("n")).select(F.lit("mended").alias("kind"), F.lit("").alias("error"), F.concat(F.lit("M_"), "origin").alias("raw"), "n")
    rest = hot.where("airline_code != 'M'").agg(F.count("*").alias("n")).select(F.lit("hot").alias("kind"), F.lit("").alias("error"), F.lit("").alias("raw"), "n")
    return letters.union(mended).union(rest)


def _event_files(spark, sf, n: int) -> str:
    """The events as ``n`` files, event_id % n, in the order of their number."""
    src = _scratch(spark, "event-files")
    events = read_table(spark, sf, "events").withColumn("file", F.col("event_id") % n).persist()
    for i in range(n):
        events.where(F.col("file") == i).drop("file").coalesce(1).write.mode("append").parquet(src)
    events.unpersist()
    return src


def _event_stream(spark, sf, src: str):
    return events_as_flights(spark.readStream.schema(read_table(spark, sf, "events").schema).option("maxFilesPerTrigger", 1).parquet(src))


@register("stream_late_windows", with_hot(f"""
, tops AS (SELECT event_id % 6 AS b, max(ts) AS top FROM events GROUP BY 1),
marks AS (SELECT b, max(top) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 MINUTE AS mark FROM tops),
x AS (SELECT h.*, coalesce(h."timestamp" < m.mark, false) AS is_late FROM hot h JOIN marks m ON CAST(substr(h.flight_id, 2) AS BIGINT) % 6 = m.b)
SELECT {ts_text("time_bucket(INTERVAL 15 MINUTE, \"timestamp\", TIMESTAMP '1970-01-01 00:00:00')")} AS window_start, airline_code,
       round(avg(dep_delay), 6) AS avg_delay, count(flight_id) AS flight_count, count(*) AS events, count(*) FILTER (WHERE is_late) AS late
FROM x WHERE airline_code IS NOT NULL GROUP BY 1, 2"""))
def stream_late_windows(spark, sf):
    """15-minute windows with a watermark of ten minutes over six files in
    an order unrelated to time: most rows are late, and all count."""
    root = _scratch(spark, "late-windows")
    windows.drain(spark, _event_stream(spark, sf, _event_files(spark, sf, 6)), root, f"{root}-checkpoint", "15 minutes", watermark="10 minutes")
    late = windows.late_rows(spark, root)
    merged = windows.windows(spark, root).drop("window_end")
    if late is None or late.count() != merged.agg(F.sum("late")).first()[0]:
        raise RuntimeError("the side output does not hold the late rows")
    return merged


@register("stream_enrich", with_hot("""
, ap AS (SELECT 'A' || CAST(range AS VARCHAR) AS code, 'City ' || CAST(range AS VARCHAR) AS city FROM range(10)),
b AS (SELECT *, CAST(substr(flight_id, 2) AS BIGINT) % 3 AS file FROM hot)
SELECT b.flight_id, upper(b.airline_code) AS airline_name, o.city || CASE WHEN b.file = 2 THEN ' (new)' ELSE '' END AS origin_city,
       d.city || CASE WHEN b.file = 2 THEN ' (new)' ELSE '' END AS dest_city
FROM b LEFT JOIN ap o ON b.origin = o.code LEFT JOIN ap d ON b.dest = d.code"""))
def stream_enrich(spark, sf):
    """A stream of three files enriched with airline and airport names; the
    airports get new names after the second batch, which the third shows."""
    root = _scratch(spark, "enrich")
    event_airports(spark).write.parquet(f"{root}/airports/0")
    named = airlines(flight_events(spark, sf))

    def read_dims(own, batch_id):
        if batch_id == 2:  # someone publishes a new table
            event_airports(spark).withColumn("city", F.concat("city", F.lit(" (new)"))).write.mode("overwrite").parquet(f"{root}/airports/1")
        newest = max(f.getPath().getName() for f in _list(spark, f"{root}/airports"))
        return spark.read.parquet(f"{root}/airports/{newest}"), named

    def write(flights, batch_id):
        flights.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    enrich_stream(_event_stream(spark, sf, _event_files(spark, sf, 3)), read_dims, write, f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select("flight_id", "airline_name", "origin_city", "dest_city")


def _list(spark, path: str):
    fs, p, _ = manifest._fs(spark, path)
    return fs.listStatus(p)


@register("store_compaction", "WITH " + FLIGHT_EVENTS + """
, d AS (SELECT DISTINCT CAST("timestamp" AS DATE) AS day FROM flight_events)
SELECT 'hot' AS store, (SELECT count(*) FROM flight_events) AS flights, (SELECT count(*) FROM flight_events) AS ids, (SELECT count(*) FROM d) AS folders, (SELECT count(*) FROM d) AS files
UNION ALL SELECT 'staging', (SELECT count(*) FROM flight_events), (SELECT count(*) FROM flight_events), 1, 1
UNION ALL SELECT 'cold', (SELECT count(*) FROM flight_events), (SELECT count(*) FROM flight_events), 1, 1""")
def store_compaction(spark, sf):
    """K2-K4: four batches, each with rows of every day, then each store compacted:
    one folder and one file a day, the same rows."""
    stores = ingest.Stores(_scratch(spark, "compaction"))
    batch = ingest.prepare(_decoded(spark, sf), processing_time=PROCESSING_TIME).withColumn("_n", F.pmod(F.xxhash64("flight_id"), F.lit(4))).persist()
    for i in range(4):
        ingest.fan_out(spark, stores, batch.where(F.col("_n") == i).drop("_n"), i)
    batch.unpersist()
    out = []
    for name, store in (("hot", "hot"), ("staging", "warehouse/staging_flight_events"), ("cold", "cold")):
        done = compaction.compact(spark, stores, store)
        r = ingest.read_store(spark, stores, store).agg(F.count("*").alias("n"), F.count_distinct("flight_id").alias("ids")).first()
        out.append((name, r["n"], r["ids"], done["folders"], done["files"]))
    return spark.createDataFrame(out, "store string, flights long, ids long, folders long, files long")


@register("catalog_metadata", "WITH " + FLIGHT_EVENTS + f"""
, n AS (SELECT count(*) AS all_rows, count(*) FILTER (WHERE "timestamp" < {_CUT_MID}) AS old FROM flight_events)
SELECT 'batch_metadata' AS source, 'first-0' AS name, all_rows AS record_count, CAST(1 AS BIGINT) AS ok FROM n
UNION ALL SELECT 'batch_metadata', 'replay-0', 0, 1 FROM n
UNION ALL SELECT 'archive_metadata', 'archive-1', old, 1 FROM n
UNION ALL SELECT 'schema_metadata', 'staging_flight_events_v1', 25, 1 FROM n
UNION ALL SELECT 'schema_metadata', 'fact_flight_events_v1', 14, 1 FROM n
UNION ALL SELECT 'schema_metadata', 'predictions_v1', 11, 1 FROM n
UNION ALL SELECT 'catalog', 'staging_flight_events', all_rows, 1 FROM n
UNION ALL SELECT 'view', 'fact_flight_events', all_rows, 1 FROM n
UNION ALL SELECT 'view', 'predictions', all_rows, 1 FROM n
UNION ALL SELECT 'count_after_archive', 'hot', all_rows - old, 1 FROM n""")
def catalog_metadata(spark, sf):
    """Two batches (the second a replay) and an archive run, read
    through the catalogue and the metadata tables."""
    from contrail.sources.warehouse import catalog_stats, create_metadata, create_warehouse
    root = _scratch(spark, "catalog")
    batch = ingest.prepare(_decoded(spark, sf), processing_time=PROCESSING_TIME)
    for run in ("first", "replay"):
        ingest.fan_out(spark, ingest.Stores(root, run), batch, 0)
    stores = ingest.Stores(root)
    retention.archive(spark, stores, "2024-01-30 12:00:00", keep_days=7, archive_id="archive-1")
    db = "contrail_" + uuid.uuid4().hex[:10]
    create_warehouse(spark, stores, db)
    create_metadata(spark, stores, db)
    ok = lambda condition: F.when(condition, 1).otherwise(0).cast("long").alias("ok")
    rows = [
        spark.table(f"{db}.batch_metadata").select(F.lit("batch_metadata").alias("source"), F.col("batch_id").alias("name"), "record_count",
                                                   ok((F.col("processing_status") == "completed") & ((F.col("record_count") > 0) == (F.col("file_size_mb") > 0)))),
        spark.table(f"{db}.archive_metadata").select(F.lit("archive_metadata"), "archive_id", "record_count", ok(F.col("verified") & (F.size("schema") > 10))),
        spark.table(f"{db}.schema_metadata").select(F.lit("schema_metadata"), "schema_id", F.size(F.from_json("schema_definition", "array<struct<name:string,type:string>>")).cast("long"), ok(F.col("is_active"))),
        catalog_stats(spark, db).where("table_name like 'staging%'").select(F.lit("catalog"), "table_name", "total_rows", ok((F.col("files") > 0) & (F.col("total_bytes") > 0) & F.col("newest_file").isNotNull())),
        *[spark.table(f"{db}.{v}").agg(F.count("*").alias("n")).select(F.lit("view"), F.lit(v), "n", ok(F.col("n") > 0)) for v in ("fact_flight_events", "predictions")],
        ingest.read_hot(spark, stores).agg(F.count("*").alias("n")).select(F.lit("count_after_archive"), F.lit("hot"), "n", ok(F.col("n") >= 0)),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


@register("model_versions", with_hot("""
, b AS (SELECT CAST(substr(flight_id, 2) AS BIGINT) % 3 AS file FROM hot WHERE airline_code IS NOT NULL)
SELECT CASE file WHEN 0 THEN 'rules' WHEN 1 THEN 'first' ELSE 'second' END AS model, count(*) AS flights, count(*) AS named FROM b GROUP BY 1"""))
def model_versions(spark, sf):
    """Three batches of one stream: no model yet, a first version, a
    second one published while the stream runs; each row names its own."""
    root, models = _scratch(spark, "versions"), _scratch(spark, "models")
    train = hot_history(spark, sf)
    rows = ml.training_rows(train, target="arr_delay")  # both versions learn from them
    versions = {"v1.0": "rules"}

    def publish(batch_id):
        if batch_id in (1, 2) and len(versions) == batch_id:
            fitted, _, metrics = ml.train(train, target="arr_delay", model="rf", num_trees=2 * batch_id, rows=rows, narrow=True)
            versions[registry.publish(spark, models, fitted, metrics, "arr_delay")] = {1: "first", 2: "second"}[batch_id]

    src = _event_files(spark, sf, 3)
    serving = registry.Serving(spark, models)
    stores = ingest.Stores(root)
    from contrail.operators.clean import clean_events, enriched_projection
    cleaned = clean_events(_event_stream(spark, sf, src), processing_time=PROCESSING_TIME, derive_id=False)

    def write(batch, batch_id):
        publish(batch_id)
        ingest.fan_out(spark, stores, enriched_projection(serving(batch), ingestion_time=PROCESSING_TIME), batch_id)

    cleaned.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/_checkpoint/main").trigger(availableNow=True).start().awaitTermination()
    name = F.create_map(*[F.lit(x) for kv in versions.items() for x in kv])
    return (ingest.read_hot(spark, stores).groupBy(F.element_at(name, F.col("model_version")).alias("model"))
            .agg(F.count("*").alias("flights"), F.count("predicted_delay").alias("named")))


_MONTH = 'strftime("timestamp", \'%Y-%m\')'


@register("sketched_months", with_history(f"""
SELECT {_MONTH} AS month, count(*) AS flights, round(avg(dep_delay), 6) AS mean, min(dep_delay) AS min_value, max(dep_delay) AS max_value,
       round(100e0 * count(*) FILTER (WHERE dep_delay > 60) / count(*), 6) AS severe_pct, true AS distinct_ok, true AS median_ok
FROM hist GROUP BY 1"""))
def sketched_months(spark, sf):
    """Months out of the stored sketches of their days; the distinct ids
    and the median's rank are held against the rows, within the stated bounds."""
    history = hot_history(spark, sf)
    path = _scratch(spark, "sketches")
    sketches.by_day(history).write.parquet(path)
    month = F.date_format("day", "yyyy-MM").alias("month")
    found = sketches.answers(sketches.merged(spark.read.parquet(path), month))
    exact = (history.select(F.date_format("timestamp", "yyyy-MM").alias("month"), "flight_id", "origin", "dep_delay")
             .join(found.select("month", "q50"), "month").groupBy("month")
             .agg(F.count_distinct("flight_id").alias("ids"), F.count("dep_delay").alias("n"), F.count_if(F.col("dep_delay") < F.col("q50")).alias("below"),
                  F.count_if(F.col("dep_delay") <= F.col("q50")).alias("up_to")))
    near = F.abs(F.col("distinct_flight_id") - F.col("ids")) <= F.greatest(F.lit(1.0), F.col("ids") * sketches.DISTINCT_BOUND)
    slack = F.greatest(F.lit(1.0), F.col("n") * sketches.RANK_BOUND)
    middle = (F.col("below") <= F.col("n") * 0.5 + slack) & (F.col("up_to") >= F.col("n") * 0.5 - slack)
    return found.join(exact, "month").select("month", F.col("rows").alias("flights"), "mean", "min_value", "max_value", "severe_pct", near.alias("distinct_ok"), middle.alias("median_ok"))


_TRAIN = "CAST('0x' || substr(md5('42|' || coalesce(flight_id, '')), 1, 8) AS BIGINT) % 100 < 80"
_NUM, _CAT = ml.NUMERIC_FEATURES, ml.CATEGORICAL_FEATURES


@register("fitted_features", with_history(f"""
, tr AS (SELECT * FROM hist WHERE arr_delay IS NOT NULL AND {_TRAIN})
""" + "\nUNION ALL ".join([f"""SELECT '{c}' AS field, 'median' AS fitted, '' AS value, round(quantile_cont({c}, 0.5), 6) AS number FROM tr""" for c in _NUM]
                          + [f"""SELECT '{c}', 'mode', (SELECT {c} FROM tr WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1), 0e0""" for c in _CAT]
                          + [f"""SELECT '{c}', 'code', {c}, CAST(row_number() OVER (ORDER BY {c}) - 1 AS DOUBLE) FROM (SELECT DISTINCT {c} FROM tr WHERE {c} IS NOT NULL)""" for c in _CAT]
                          + [f"""SELECT '{c}', 'mean', '', round(avg(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM tr))), 6) FROM tr""" for c in _NUM]
                          + [f"""SELECT '{c}', 'std', '', round(stddev_samp(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM tr))), 6) FROM tr""" for c in _NUM])))
def fitted_features(spark, sf):
    """M1-M4: what the pipeline's stages learn on the training part: medians, modes,
    alphabetical codes, means and deviations."""
    history = hot_history(spark, sf)
    target = ml.pick_target(history.columns)
    train, _ = split(history.where(F.col(target).isNotNull()), 80, 42)
    return ml.fitted_features(spark, train)


@register("size_trigger", "WITH " + FLIGHT_EVENTS + f"""
SELECT 'below' AS step, false AS archived, (SELECT count(*) FROM flight_events) AS hot, 0 AS cold
UNION ALL SELECT 'above', true, (SELECT count(*) FROM flight_events WHERE "timestamp" >= {_CUT_MID}), (SELECT count(*) FROM flight_events WHERE "timestamp" < {_CUT_MID})""")
def size_trigger(spark, sf):
    """An archive run below its threshold does nothing, above it it moves rows."""
    stores = ingest.Stores(_scratch(spark, "trigger"))
    ingest.fan_out(spark, stores, ingest.prepare(_decoded(spark, sf), processing_time=PROCESSING_TIME), 0)
    size = retention.store_size_mb(manifest.snapshot(spark, stores.root), "hot")
    out = []
    for step, threshold in (("below", size), ("above", size / 2)):  # strictly greater
        due = retention.should_archive(spark, stores, threshold)
        done = retention.archive(spark, stores, "2024-01-30 12:00:00", threshold_mb=threshold)["archived"]
        h = retention.history(spark, stores).agg(F.count_if(F.col("store") == "hot").alias("hot"), F.count_if(F.col("store") == "cold").alias("cold")).first()
        out.append((step, due and done, h["hot"], h["cold"]))
    return spark.createDataFrame(out, "step string, archived boolean, hot long, cold long")


def _airport_values() -> str:
    return ", ".join(f"('{code}', {lat}e0, {lon}e0, '" + city.replace("'", "''") + "')" for code, lat, lon, city in AIRPORTS)


@register("known_airports", with_hot(f"""
, ap(code, lat, lon, city) AS (VALUES {_airport_values()}),
numbered AS (SELECT *, row_number() OVER (ORDER BY code) - 1 AS i FROM ap),
f AS (SELECT h.dep_delay, n.code FROM hot h LEFT JOIN numbered n ON (CAST(substr(h.flight_id, 2) AS BIGINT) % 50) = n.i)
SELECT ap.code AS airport, ap.city, ap.lat, ap.lon, count(*) AS flights, round(avg(f.dep_delay), 6) AS avg_delay
FROM f JOIN ap ON f.code = ap.code GROUP BY 1, 2, 3, 4"""))
def known_airports(spark, sf):
    """The table of 48 airports: flights are dealt to 50 codes, two of which it
    does not know; those are dropped."""
    codes = F.array(*[F.lit(c) for c in sorted(a[0] for a in AIRPORTS)])
    flights = hot_events(spark, sf).withColumn("airport", F.coalesce(F.get(codes, (F.substring("flight_id", 2, 20).cast("long") % 50).cast("int")), F.lit("XXX")))
    stats = flights.groupBy("airport").agg(F.count("*").alias("flights"), F.avg("dep_delay").alias("avg_delay"))
    return stats.join(airports(spark).withColumnRenamed("code", "airport"), "airport").select("airport", "city", "lat", "lon", "flights", "avg_delay")
