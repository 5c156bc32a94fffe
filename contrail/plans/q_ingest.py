"""Ingest-path queries: cleaning, prediction, projections, decoding,
enrichment and the streaming jobs (P1-P11, S2, J2, K1-K4, T1, T3, T5, T8).

The streaming queries drain a stream over the ``events`` file
(``availableNow``) into a scratch folder under the shared
``spark.checkpoint.dir`` and return the final state as a DataFrame.
"""

import uuid

from pyspark.sql import functions as F

from contrail.operators.clean import clean_events as _clean, enriched_projection
from contrail.operators.enrich import enrich_dims as _enrich
from contrail.operators.predict import fact_projection as _fact, predict_a, predict_b
from contrail.operators.predict import prediction_projection as _pred_proj
from contrail.plans.oracle_views import FLIGHT_EVENTS, ts_text, with_history, with_hot
from contrail.plans.registry import register
from contrail.plans.views import PROCESSING_TIME, hot_events, hot_history
from contrail.sources.stream import decode_events, encode_events
from contrail.sources.tables import (
    airlines, event_airports, events_as_flights, flight_events, read_table,
)
from contrail.streaming import ingest, live

_CAUSES = "delay_due_weather, delay_due_carrier, delay_due_nas, delay_due_late_aircraft"
_PT = "'2024-01-31 00:00:00.000000'"


def _cleaned(spark, sf):
    return _clean(flight_events(spark, sf), processing_time=PROCESSING_TIME, derive_id=True)


def _clean_sql(ts_expr: str = '"timestamp"') -> str:
    return f"""
, c0 AS (SELECT *, {ts_expr} AS ts_in FROM flight_events),
c AS (
  SELECT regexp_replace(CAST(ts_in AS VARCHAR), '[^0-9]', '', 'g') || '_' || airline_code || '_' || origin || '_'
           || dest AS flight_id,
         ts_in AS "timestamp", airline_code, origin, dest,
         coalesce(dep_delay, 0e0) AS dep_delay, coalesce(arr_delay, 0e0) AS arr_delay,
         CASE WHEN distance IS NULL OR distance <= 0 THEN 0e0 ELSE distance END AS distance,
         CASE WHEN dep_delay IS NOT NULL AND arr_delay IS NOT NULL AND distance IS NOT NULL AND distance > 0
              THEN 1e0 ELSE 0.5e0 END AS data_quality_score,
         crs_dep_time, month, day_of_week, {_CAUSES}
  FROM c0),
cb AS (SELECT *, round(dep_delay * 0.9e0 + CASE WHEN distance > 1000 THEN 5e0 ELSE 2e0 END, 2) AS predicted_delay,
              0.7e0 AS prediction_confidence FROM c)"""


@register("clean_events", "WITH " + FLIGHT_EVENTS + _clean_sql() + f"""
SELECT flight_id, {ts_text('"timestamp"')} AS "timestamp", airline_code, origin, dest, dep_delay, arr_delay,
       distance, predicted_delay, prediction_confidence, data_quality_score,
       {_PT} AS ingestion_timestamp, {_PT} AS processing_timestamp, DATE '2024-01-31' AS processing_date,
       crs_dep_time, month, day_of_week, {_CAUSES}
FROM cb""")
def clean_events(spark, sf):
    """The batch form of the ingest transformation."""
    return enriched_projection(predict_b(_cleaned(spark, sf)), ingestion_time=PROCESSING_TIME)


@register("predict_a", with_history("""
SELECT flight_id, month, dep_delay, distance, predicted_delay, prediction_confidence FROM hist"""))
def predict_a_history(spark, sf):
    """P7 + P9: predictor A over the history (all months, so the season
    term is exercised)."""
    return hot_history(spark, sf).select("flight_id", "month", "dep_delay", "distance", "predicted_delay",
                                         "prediction_confidence")


@register("predict_b", "WITH " + FLIGHT_EVENTS + _clean_sql() + """
SELECT flight_id, dep_delay, distance, predicted_delay, prediction_confidence FROM cb""")
def predict_b_events(spark, sf):
    return predict_b(_cleaned(spark, sf)).select("flight_id", "dep_delay", "distance", "predicted_delay",
                                                 "prediction_confidence")


@register("fact_projection", "WITH " + FLIGHT_EVENTS + _clean_sql() + f"""
SELECT flight_id, {ts_text('"timestamp"')} AS "timestamp", airline_code, origin, dest, dep_delay, arr_delay, distance,
       predicted_delay, round(abs(predicted_delay - dep_delay), 6) AS prediction_accuracy,
       {_PT} AS processing_timestamp, DATE '2024-01-31' AS processing_date
FROM cb""")
def fact_projection(spark, sf):
    """Warehouse fact rows."""
    return _fact(predict_b(_cleaned(spark, sf)))


@register("prediction_projection", "WITH " + FLIGHT_EVENTS + _clean_sql() + f"""
SELECT flight_id || '_pred' AS prediction_id, flight_id, {ts_text('"timestamp"')} AS "timestamp", predicted_delay,
       dep_delay AS actual_delay, round(abs(predicted_delay - dep_delay), 6) AS prediction_accuracy,
       'v1.0' AS model_version, {_PT} AS processing_timestamp, DATE '2024-01-31' AS prediction_date
FROM cb""")
def prediction_projection(spark, sf):
    """Warehouse prediction rows."""
    return _pred_proj(predict_b(_cleaned(spark, sf)))


@register("enrich_dims", with_hot("""
, ap AS (SELECT 'A' || CAST(range AS VARCHAR) AS code, 'City ' || CAST(range AS VARCHAR) AS city,
                CAST(range + 30 AS DOUBLE) AS lat, CAST(range * 5 - 120 AS DOUBLE) AS lon FROM range(10)),
al AS (SELECT DISTINCT airline_code, upper(airline_code) AS airline_name FROM hot WHERE airline_code IS NOT NULL)
SELECT h.flight_id, h.airline_code, al.airline_name, h.origin, o.city AS origin_city, o.lat AS origin_lat,
       o.lon AS origin_lon, h.dest, d.city AS dest_city, d.lat AS dest_lat, d.lon AS dest_lon
FROM hot h LEFT JOIN al ON h.airline_code = al.airline_code
LEFT JOIN ap o ON h.origin = o.code LEFT JOIN ap d ON h.dest = d.code"""))
def enrich_dims(spark, sf):
    """Airline names and both airports' attributes."""
    hot = hot_events(spark, sf)
    return _enrich(hot, event_airports(spark), airlines(hot)).select(
        "flight_id", "airline_code", "airline_name", "origin", "origin_city", "origin_lat", "origin_lon",
        "dest", "dest_city", "dest_lat", "dest_lon")


@register("decode_roundtrip", "WITH " + FLIGHT_EVENTS + f"""
SELECT {ts_text("date_trunc('millisecond', \"timestamp\")")} AS "timestamp", airline_code, origin, dest, crs_dep_time,
       dep_delay, arr_delay, distance, month, day_of_week
FROM flight_events""")
def decode_roundtrip(spark, sf):
    """S2 + P1: flights -> wire JSON -> decoded flights (time cut to ms)."""
    msgs = encode_events(flight_events(spark, sf))
    return decode_events(msgs).select("timestamp", "airline_code", "origin", "dest", "crs_dep_time",
                                      "dep_delay", "arr_delay", "distance", "month", "day_of_week")


def _event_stream(spark, sf):
    """``events`` as a file stream (only the events file of the folder)."""
    schema = read_table(spark, sf, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .option("maxFilesPerTrigger", 1).parquet(sf))


@register("stream_ingest", "WITH " + FLIGHT_EVENTS + _clean_sql("date_trunc('millisecond', \"timestamp\")") + """
SELECT CAST("timestamp" AS DATE) AS event_date, airline_code, count(*) AS flights,
       count(DISTINCT flight_id) AS ids, round(sum(predicted_delay), 6) AS sum_predicted,
       round(sum(data_quality_score), 6) AS quality_sum
FROM cb GROUP BY 1, 2""")
def stream_ingest(spark, sf):
    """The events replayed as a JSON message stream through
    the full ingest, twice (the second run with a fresh checkpoint re-reads
    everything); the keyed insert-ignore leaves one row per flight."""
    root = ingest.default_stores(spark, "ingest-" + uuid.uuid4().hex[:12]).root
    for run in ("first", "replay"):
        stores = ingest.Stores(root, run)
        msgs = encode_events(events_as_flights(_event_stream(spark, sf)))
        ingest.run_ingest(spark, msgs, stores, processing_time=PROCESSING_TIME)
    hot = ingest.read_hot(spark, stores)
    return (hot.groupBy("event_date", "airline_code")
            .agg(F.count(F.lit(1)).alias("flights"), F.count_distinct("flight_id").alias("ids"),
                 F.sum("predicted_delay").alias("sum_predicted"), F.sum("data_quality_score").alias("quality_sum")))


@register("stream_ingest_multibatch", "WITH " + FLIGHT_EVENTS + _clean_sql("date_trunc('millisecond', \"timestamp\")") + """
SELECT 'hot' AS store, count(*) AS flights, count(DISTINCT flight_id) AS ids, round(sum(dep_delay), 6) AS sum_delay FROM cb
UNION ALL SELECT 'staging', count(*), count(DISTINCT flight_id), round(sum(dep_delay), 6) FROM cb
UNION ALL SELECT 'cold', count(*), count(DISTINCT flight_id), round(sum(dep_delay), 6) FROM cb""")
def stream_ingest_multibatch(spark, sf):
    """The events as six files in an order unrelated to time,
    one file per micro-batch, in a session of their own and with the in-stream
    dedup; every store holds every flight once."""
    own = spark.newSession()
    root = ingest.default_stores(spark, "multibatch-" + uuid.uuid4().hex[:12]).root
    flights = events_as_flights(read_table(own, sf, "events"))
    encode_events(flights).repartition(6, F.xxhash64("value")).write.mode("overwrite").text(f"{root}/_messages")
    stores = ingest.Stores(root, "main")
    stream = own.readStream.option("maxFilesPerTrigger", 1).text(f"{root}/_messages")
    ingest.run_ingest(own, stream, stores, processing_time=PROCESSING_TIME, dedup_watermark="1 hour")

    def counts(name, store):
        return ingest.read_store(spark, stores, store).agg(
            F.count(F.lit(1)).alias("flights"), F.count_distinct("flight_id").alias("ids"),
            F.sum("dep_delay").alias("sum_delay")).select(F.lit(name).alias("store"), "*")

    return counts("hot", "hot").union(counts("staging", "warehouse/staging_flight_events")).union(counts("cold", "cold"))


@register("stream_tumbling", with_hot(f"""
SELECT {ts_text("time_bucket(INTERVAL 15 MINUTE, \"timestamp\", TIMESTAMP '1970-01-01 00:00:00')")} AS window_start,
       airline_code, round(avg(dep_delay), 6) AS avg_delay, count(flight_id) AS flight_count, count(*) AS events
FROM hot WHERE airline_code IS NOT NULL GROUP BY 1, 2"""))
def stream_tumbling(spark, sf):
    """15-minute windows per airline computed by a watermarked
    streaming aggregate in ``update`` mode (bounded state), drained with
    ``availableNow``; the latest version of each window is read back."""
    flights = events_as_flights(_event_stream(spark, sf))
    agg = live.windowed_airline_delay(flights, "15 minutes", watermark="31 days")
    out, ckpt = live.scratch(spark, "stream-tumbling")
    live.drain_updates(spark, agg, out, ckpt)
    res = live.latest_windows(spark, out)
    return res.select(F.date_format(F.col("w.start").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
                      .alias("window_start"), "airline_code", "avg_delay", "flight_count", "events")


@register("stream_dedup", with_hot("""
SELECT CAST("timestamp" AS DATE) AS event_date, count(*) AS flights, count(DISTINCT flight_id) AS ids
FROM hot GROUP BY 1"""))
def stream_dedup(spark, sf):
    """T5: every event arrives twice (two subscriptions of the same
    source); ``dropDuplicatesWithinWatermark`` keeps one per id."""
    a = events_as_flights(_event_stream(spark, sf))
    b = events_as_flights(_event_stream(spark, sf))
    deduped = ingest.dedup_in_stream(a.unionByName(b), "1 hour").select("flight_id", F.to_date("timestamp").alias("event_date"))
    out, ckpt = live.scratch(spark, "stream-dedup")
    deduped.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt) \
        .trigger(availableNow=True).start().awaitTermination()
    return (spark.read.parquet(out).groupBy("event_date")
            .agg(F.count(F.lit(1)).alias("flights"), F.count_distinct("flight_id").alias("ids")))


_BUCKET = "time_bucket(INTERVAL 15 MINUTE, \"timestamp\", TIMESTAMP '1970-01-01 00:00:00')"


@register("stream_sliding", with_hot(f"""
, w AS (SELECT {_BUCKET} AS ws, * FROM hot WHERE airline_code IS NOT NULL
        UNION ALL
        SELECT {_BUCKET} - INTERVAL 15 MINUTE AS ws, * FROM hot WHERE airline_code IS NOT NULL)
SELECT {ts_text("ws")} AS window_start, airline_code, round(avg(dep_delay), 6) AS avg_delay,
       count(flight_id) AS flight_count, count(*) AS events
FROM w GROUP BY ws, airline_code"""))
def stream_sliding(spark, sf):
    """30-minute windows sliding every 15 minutes per airline, on the
    stream (each event lands in two windows)."""
    flights = events_as_flights(_event_stream(spark, sf))
    agg = live.windowed_airline_delay(flights, "30 minutes", "15 minutes", watermark="31 days")
    out, ckpt = live.scratch(spark, "stream-sliding")
    live.drain_updates(spark, agg, out, ckpt)
    res = live.latest_windows(spark, out)
    return res.select(F.date_format(F.col("w.start").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
                      .alias("window_start"), "airline_code", "avg_delay", "flight_count", "events")
