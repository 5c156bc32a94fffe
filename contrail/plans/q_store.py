"""Store-level queries: retention split and round trip, hot+cold history,
warehouse tables (R1-R3, K5, K7, K8, U1, S8)."""

import uuid

from pyspark.sql import functions as F

from contrail.operators import retention
from contrail.plans.oracle_views import FLIGHT_EVENTS, with_history, with_hot
from contrail.plans.q_quality import HOT_COLUMNS
from contrail.plans.registry import register
from contrail.plans.views import AS_OF, PROCESSING_TIME, hot_events
from contrail.sources.tables import flight_events
from contrail.streaming import ingest

_CUT = "TIMESTAMP '2024-01-24 00:00:00'"


_PROPS_SQL = """
WITH kv AS (SELECT k AS field, json_extract_string(props, '$.' || k) AS v
            FROM (SELECT props, unnest(json_keys(props)) AS k FROM events WHERE props IS NOT NULL) t),
a AS (SELECT field, count(*) AS "rows", count(v) AS non_null,
             count(*) FILTER (WHERE v IS NOT NULL AND TRY_CAST(v AS BIGINT) IS NULL) AS not_int,
             count(*) FILTER (WHERE v IS NOT NULL AND TRY_CAST(v AS DOUBLE) IS NULL) AS not_num
      FROM kv GROUP BY field)
SELECT field, CASE WHEN non_null = 0 THEN 'null' WHEN not_int = 0 THEN 'bigint' WHEN not_num = 0 THEN 'double'
                   ELSE 'string' END AS type, "rows", non_null
FROM a"""


@register("retention_split", with_hot(f"""
SELECT CASE WHEN "timestamp" < {_CUT} THEN 'cold' ELSE 'hot' END AS store, count(*) AS records,
       min(CAST("timestamp" AS DATE)) AS first_date, max(CAST("timestamp" AS DATE)) AS last_date
FROM hot GROUP BY 1"""))
def retention_split(spark, sf):
    """R2: which rows a 7-day retention at ``as_of`` moves to cold."""
    cut = retention.cutoff_of(AS_OF, 7)
    return (hot_events(spark, sf)
            .select(F.when(F.col("timestamp") < F.lit(cut.isoformat(sep=" ")).cast("timestamp_ntz"), "cold")
                    .otherwise("hot")
                    .alias("store"), F.to_date("timestamp").alias("d"))
            .groupBy("store").agg(F.count(F.lit(1)).alias("records"), F.min("d").alias("first_date"),
                                  F.max("d").alias("last_date")))


_CUT_MID = "TIMESTAMP '2024-01-23 12:00:00'"


@register("retention_roundtrip", "WITH " + FLIGHT_EVENTS + f"""
SELECT CASE WHEN "timestamp" < {_CUT_MID} THEN 'cold' ELSE 'hot' END AS store,
       CAST("timestamp" AS DATE) AS event_date, count(*) AS records
FROM flight_events GROUP BY 1, 2""")
def retention_roundtrip(spark, sf):
    """R3 + K8 + U1: ingest the events as one batch into scratch stores,
    archive with a mid-day cutoff (2024-01-30 12:00 minus 7 days, so the
    boundary day is rewritten), run it twice (the second run finds nothing
    new), then read hot and cold as one history."""
    stores = ingest.default_stores(spark, "retention-" + uuid.uuid4().hex[:12])
    batch = ingest.prepare(_decoded(spark, sf), processing_time=PROCESSING_TIME)
    ingest.fan_out(spark, stores, batch, 0)
    for _ in range(2):
        retention.archive(spark, stores, "2024-01-30 12:00:00", keep_days=7)
    h = retention.history(spark, stores)
    return h.groupBy("store", "event_date").agg(F.count(F.lit(1)).alias("records"))


def _decoded(spark, sf):
    """Flight events with the same typing as the decoded stream (ids
    derived by the ingest)."""
    return flight_events(spark, sf).withColumn("_corrupt_record", F.lit(None).cast("string"))


@register("history_csv", with_history("""
SELECT CAST(month AS INTEGER) AS month, count(*) AS flights, count(dep_delay) AS dep_known,
       round(sum(dep_delay), 6) AS sum_dep_delay, round(sum(arr_delay), 6) AS sum_arr_delay,
       CAST(sum(crs_dep_time) AS BIGINT) AS sum_crs_dep_time
FROM hist GROUP BY 1"""))
def history_csv(spark, sf):
    """S5/S6 + P17 + P18: the history written as the reference's CSV file
    (under the shared folder) and read back: typed columns, month and
    weekday from the flight date, schedule time coerced to INT."""
    import os

    from contrail.session import checkpoint_dir
    from contrail.sources.files import read_history_csv, write_history_csv
    from contrail.sources.tables import flight_history
    path = os.path.join(checkpoint_dir(spark), "history-csv-" + uuid.uuid4().hex[:12])
    write_history_csv(flight_history(spark, sf), path)
    h = read_history_csv(spark, path)
    return h.groupBy("month").agg(F.count(F.lit(1)).alias("flights"), F.count("dep_delay").alias("dep_known"),
                                  F.sum("dep_delay").alias("sum_dep_delay"), F.sum("arr_delay").alias("sum_arr_delay"),
                                  F.sum("crs_dep_time").alias("sum_crs_dep_time"))


_SCHEMA = "\nUNION ALL ".join(
    f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS field,
       CASE any_value(typeof("{c}")) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
            WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(any_value(typeof("{c}"))) END AS type,
       count(*) AS "rows", count("{c}") AS non_null FROM hot"""
    for i, c in enumerate(HOT_COLUMNS))


@register("hot_schema", with_hot("\n" + _SCHEMA))
def hot_schema(spark, sf):
    """Field -> type of the hot view, with rows and non-missing values."""
    from contrail.operators.quality import schema_table
    return schema_table(hot_events(spark, sf).select(*HOT_COLUMNS))


@register("props_json_schema", _PROPS_SQL)
def props_json_schema(spark, sf):
    """S7 for JSON text: the schema of ``events.props`` merged over all rows."""
    from contrail.operators.quality import json_schema
    from contrail.sources.tables import read_table
    return json_schema(read_table(spark, sf, "events"), "props")
