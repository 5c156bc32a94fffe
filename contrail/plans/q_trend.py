"""Historical and streaming-page trend queries (A9-A11, A17, A18, A22-A24,
T1, T2, T4, L4)."""

from contrail.operators import trend
from contrail.plans.oracle_views import AS_OF, ts_text, with_history, with_hot
from contrail.plans.registry import register
from contrail.plans.views import AS_OF as SPARK_AS_OF, hot_events, hot_history

_DAILY = """
SELECT CAST("timestamp" AS DATE) AS date, round(avg(dep_delay), 6) AS avg_dep_delay,
       max(dep_delay) AS max_delay, min(dep_delay) AS min_delay, count(dep_delay) AS flight_count,
       round(avg(arr_delay), 6) AS avg_arr_delay
FROM {v} WHERE "timestamp" IS NOT NULL GROUP BY 1"""


@register("daily_stats", with_hot(_DAILY.format(v="hot")))
def daily_stats(spark, sf):
    return trend.daily_stats(hot_events(spark, sf))


@register("daily_stats_history", with_history(_DAILY.format(v="hist")))
def daily_stats_history(spark, sf):
    return trend.daily_stats(hot_history(spark, sf))


@register("hourly_stats", with_hot("""
SELECT CAST(hour("timestamp") AS INTEGER) AS hour, round(avg(dep_delay), 6) AS avg_delay,
       count(flight_id) AS flight_count
FROM hot WHERE "timestamp" IS NOT NULL GROUP BY 1"""))
def hourly_stats(spark, sf):
    return trend.hourly_stats(hot_events(spark, sf))


_SPINE = """spine AS (SELECT * FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'),
                       (4, 'Friday'), (5, 'Saturday'), (6, 'Sunday')) t(day_index, day_of_week))"""

_DOW = """
, """ + _SPINE + """,
a AS (SELECT CAST(isodow("timestamp") - 1 AS INTEGER) AS day_index, avg(dep_delay) AS av
      FROM {v} WHERE "timestamp" IS NOT NULL GROUP BY 1)
SELECT s.day_index, s.day_of_week,
       round(CASE WHEN a.day_index IS NULL THEN 0e0 ELSE a.av END, 6) AS avg_delay
FROM spine s LEFT JOIN a ON s.day_index = a.day_index"""


@register("dow_stats", with_hot(_DOW.format(v="hot")))
def dow_stats(spark, sf):
    return trend.dow_stats(hot_events(spark, sf))


@register("dow_stats_history", with_history(_DOW.format(v="hist")))
def dow_stats_history(spark, sf):
    return trend.dow_stats(hot_history(spark, sf))


_HEAT_COLS = ",\n       ".join(
    f"round(avg(dep_delay) FILTER (WHERE hour(\"timestamp\") = {h}), 6) AS h{h:02d}" for h in range(24))


@register("heatmap", with_hot(f"""
, {_SPINE},
p AS (SELECT CAST(isodow("timestamp") - 1 AS INTEGER) AS day_index,
       {_HEAT_COLS}
      FROM hot WHERE "timestamp" IS NOT NULL GROUP BY 1)
SELECT p.day_index, s.day_of_week, {", ".join(f"p.h{h:02d}" for h in range(24))}
FROM p JOIN spine s ON p.day_index = s.day_index"""))
def heatmap(spark, sf):
    return trend.heatmap(hot_events(spark, sf))


def _tumble_sql(minutes: int) -> str:
    return with_hot(f"""
SELECT {ts_text(f"time_bucket(INTERVAL {minutes} MINUTE, \"timestamp\", TIMESTAMP '1970-01-01 00:00:00')")} AS bucket_start,
       round(avg(dep_delay), 6) AS avg_delay, count(flight_id) AS flight_count
FROM hot WHERE "timestamp" IS NOT NULL GROUP BY 1""")


@register("tumbling_5m", _tumble_sql(5))
def tumbling_5m(spark, sf):
    return trend.tumbling(hot_events(spark, sf), "5 minutes")


@register("tumbling_15m", _tumble_sql(15))
def tumbling_15m(spark, sf):
    return trend.tumbling(hot_events(spark, sf), "15 minutes")


@register("hourly_trend", with_hot(f"""
SELECT {ts_text("date_trunc('hour', \"timestamp\")")} AS hour, round(avg(dep_delay), 6) AS avg_delay,
       count(airline_code) AS flight_count
FROM hot WHERE "timestamp" IS NOT NULL GROUP BY date_trunc('hour', "timestamp")
ORDER BY date_trunc('hour', "timestamp") DESC LIMIT 48"""))
def hourly_trend(spark, sf):
    return trend.hourly_trend(hot_events(spark, sf), 48)


@register("minute_counts_dense", with_hot(f"""
, r AS (SELECT CAST(ceil((epoch_us({AS_OF}) - epoch_us("timestamp")) / 60000000e0) AS INTEGER) AS minutes_ago,
               count(*) AS record_count
        FROM hot WHERE "timestamp" < {AS_OF} AND "timestamp" >= {AS_OF} - INTERVAL 10 MINUTE GROUP BY 1),
s AS (SELECT CAST(range AS INTEGER) AS minutes_ago FROM range(1, 11))
SELECT s.minutes_ago, strftime({AS_OF} - s.minutes_ago * INTERVAL 1 MINUTE, '%H:%M:%S') AS window_start,
       coalesce(r.record_count, 0) AS record_count
FROM s LEFT JOIN r ON s.minutes_ago = r.minutes_ago"""))
def minute_counts_dense(spark, sf):
    return trend.minute_counts(hot_events(spark, sf), SPARK_AS_OF, 10)


@register("throughput", with_hot(f"""
SELECT count(*) AS total_records,
       count(*) FILTER (WHERE "timestamp" >= {AS_OF} - INTERVAL 1 MINUTE AND "timestamp" <= {AS_OF}) AS last_minute,
       count(*) FILTER (WHERE "timestamp" >= {AS_OF} - INTERVAL 1 HOUR AND "timestamp" <= {AS_OF}) AS last_hour,
       round(count(*) FILTER (WHERE "timestamp" >= {AS_OF} - INTERVAL 1 HOUR AND "timestamp" <= {AS_OF}) / 60e0, 6)
         AS per_minute_rate,
       {ts_text('max("timestamp")')} AS latest_event,
       round((epoch_us({AS_OF}) - epoch_us(max("timestamp"))) / 1e6, 6) AS latency_seconds
FROM hot"""))
def throughput(spark, sf):
    return trend.throughput(hot_events(spark, sf), SPARK_AS_OF)


@register("freshness", with_hot(f"""
SELECT {ts_text('max("timestamp")')} AS latest_record, {ts_text('min("timestamp")')} AS oldest_record,
       round((epoch_us({AS_OF}) - epoch_us(max("timestamp"))) / 3.6e9, 6) AS age_hours
FROM hot"""))
def freshness(spark, sf):
    return trend.freshness(hot_events(spark, sf), SPARK_AS_OF)


@register("records_by_date", with_hot("""
SELECT CAST("timestamp" AS DATE) AS date, count(*) AS record_count
FROM hot WHERE "timestamp" IS NOT NULL GROUP BY 1"""))
def records_by_date(spark, sf):
    return trend.rows_per_date(hot_events(spark, sf), "timestamp")


@register("range_last_24h", with_hot(f"""
SELECT count(*) AS flights, round(avg(dep_delay), 6) AS avg_delay, count(DISTINCT airline_code) AS airlines
FROM hot WHERE "timestamp" >= {AS_OF} - INTERVAL 24 HOUR"""))
def range_last_24h(spark, sf):
    """P25: the last-24-hours preset."""
    from pyspark.sql import functions as F
    return trend.in_range(hot_events(spark, sf), SPARK_AS_OF, "24h").agg(
        F.count(F.lit(1)).alias("flights"), F.avg("dep_delay").alias("avg_delay"),
        F.count_distinct("airline_code").alias("airlines"))


@register("date_parts_by_day_name", with_hot("""
SELECT dayname("timestamp") AS day_name, CAST(hour("timestamp") AS INTEGER) AS hour, count(*) AS flights,
       count(DISTINCT CAST("timestamp" AS DATE)) AS dates
FROM hot GROUP BY 1, 2"""))
def date_parts_by_day_name(spark, sf):
    """Flights per (day name, hour) and the number of dates behind each."""
    from pyspark.sql import functions as F
    return (trend.date_parts(hot_events(spark, sf)).groupBy("day_name", "hour")
            .agg(F.count(F.lit(1)).alias("flights"), F.count_distinct("date").alias("dates")))


_SINCE = {"1h": f"{AS_OF} - INTERVAL 1 HOUR", "6h": f"{AS_OF} - INTERVAL 6 HOUR", "24h": f"{AS_OF} - INTERVAL 24 HOUR", "all": "TIMESTAMP '2020-01-01 00:00:00'"}


@register("range_presets", with_hot("\n" + "\nUNION ALL ".join(
    f"""SELECT '{p}' AS preset, count(*) AS flights, round(avg(dep_delay), 6) AS avg_delay, count(DISTINCT airline_code) AS airlines
FROM hot WHERE "timestamp" >= {since}""" for p, since in _SINCE.items())))
def range_presets(spark, sf):
    """P25: all presets in one scan: a row counts for each preset that holds it."""
    from pyspark.sql import functions as F
    hot = hot_events(spark, sf)
    held = [F.when(trend.since(SPARK_AS_OF, p) <= F.col("timestamp"), F.lit(p)) for p in _SINCE]
    some = hot.withColumn("preset", F.explode(F.array_compact(F.array(*held))))
    counted = some.groupBy("preset").agg(F.count(F.lit(1)).alias("flights"), F.avg("dep_delay").alias("avg_delay"), F.count_distinct("airline_code").alias("airlines"))
    every = spark.createDataFrame([(p,) for p in _SINCE], "preset string")  # a preset without rows is listed too
    return every.join(counted, "preset", "left").select("preset", F.coalesce("flights", F.lit(0)).alias("flights"), "avg_delay", F.coalesce("airlines", F.lit(0)).alias("airlines"))


@register("severity_bands", with_hot("""
SELECT airline_code, CASE WHEN dep_delay IS NULL THEN 'missing' WHEN dep_delay > 60 THEN 'severe' WHEN dep_delay > 15 THEN 'delayed'
                          WHEN dep_delay < 0 THEN 'early' ELSE 'on_time' END AS band,
       count(*) AS flights, round(avg(dep_delay), 6) AS avg_delay
FROM hot GROUP BY 1, 2"""))
def severity_bands(spark, sf):
    """Flights and mean delay by severity band and airline."""
    from pyspark.sql import functions as F

    from contrail.functions.columns import severity_band
    return (hot_events(spark, sf).groupBy("airline_code", severity_band("dep_delay").alias("band"))
            .agg(F.count(F.lit(1)).alias("flights"), F.avg("dep_delay").alias("avg_delay")))


@register("has_field", with_hot("""
SELECT 'dep_delay' AS field, count(*) AS having_field, count(dep_delay) AS having_value FROM hot
UNION ALL SELECT 'distance', count(*), count(distance) FROM hot
UNION ALL SELECT 'gate', 0, 0"""))
def has_field(spark, sf):
    """Rows that have a field, and that have a value in it; no row has a
    field that the table lacks."""
    from pyspark.sql import functions as F
    from contrail.operators.enrich import attach_scalars
    hot, out = hot_events(spark, sf), None
    for field in ("dep_delay", "distance", "gate"):
        both = trend.has_field(hot, field).agg(F.count(F.lit(1)).alias("having_field"))
        value = trend.has_field(hot, field, not_null=True).agg(F.count(F.lit(1)).alias("having_value"))
        row = attach_scalars(both, value).select(F.lit(field).alias("field"), "having_field", "having_value")
        out = row if out is None else out.union(row)
    return out
