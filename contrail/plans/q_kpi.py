"""Executive-overview queries."""

from contrail.operators import kpi
from contrail.plans.oracle_views import AS_OF_DAY, with_hot
from contrail.plans.registry import register
from contrail.plans.views import AS_OF_DAY as SPARK_AS_OF_DAY, hot_events
from contrail.sources.tables import event_airports


@register("top_airlines", with_hot("""
SELECT airline_code, round(avg(dep_delay), 6) AS avg_delay, count(dep_delay) AS flight_count
FROM hot WHERE airline_code IS NOT NULL
GROUP BY airline_code HAVING count(dep_delay) >= 5
ORDER BY avg(dep_delay) DESC NULLS LAST, airline_code LIMIT 10"""))
def top_airlines(spark, sf):
    return kpi.top_airlines(hot_events(spark, sf))


@register("kpi_row", with_hot(f"""
SELECT count(*) AS total_flights,
       count(*) FILTER (WHERE "timestamp" >= date_trunc('day', {AS_OF_DAY})) AS today_flights,
       round(avg(dep_delay), 6) AS avg_delay,
       round(100e0 * count(*) FILTER (WHERE dep_delay <= 15) / count(*), 6) AS on_time_pct,
       round(100e0 * count(*) FILTER (WHERE predicted_delay IS NOT NULL AND dep_delay IS NOT NULL
                                      AND abs(predicted_delay - dep_delay) <= 10)
             / nullif(count(*) FILTER (WHERE predicted_delay IS NOT NULL AND dep_delay IS NOT NULL), 0), 6)
         AS accuracy_pct,
       CASE WHEN avg(dep_delay) > 15 THEN 'above target' ELSE 'on target' END AS delay_verdict,
       CASE WHEN 100e0 * count(*) FILTER (WHERE dep_delay <= 15) / count(*) >= 80
            THEN 'meeting SLA' ELSE 'below SLA' END AS sla_verdict,
       CASE WHEN 100e0 * count(*) FILTER (WHERE predicted_delay IS NOT NULL AND dep_delay IS NOT NULL
                                          AND abs(predicted_delay - dep_delay) <= 10)
                 / nullif(count(*) FILTER (WHERE predicted_delay IS NOT NULL AND dep_delay IS NOT NULL), 0) >= 70
            THEN 'on target' ELSE 'below target' END AS accuracy_verdict
FROM hot"""))
def kpi_row(spark, sf):
    return kpi.kpi_row(hot_events(spark, sf), SPARK_AS_OF_DAY)


@register("delay_categories", with_hot("""
SELECT delay_category, count(*) AS flight_count FROM (
  SELECT CASE WHEN dep_delay <= 0 THEN 'Early/On-time'
              WHEN dep_delay <= 15 THEN 'Minor (1-15min)'
              WHEN dep_delay <= 30 THEN 'Moderate (16-30min)'
              WHEN dep_delay <= 60 THEN 'Significant (31-60min)'
              WHEN dep_delay > 60 THEN 'Severe (60+min)' END AS delay_category
  FROM hot) t
WHERE delay_category IS NOT NULL GROUP BY delay_category"""))
def delay_categories(spark, sf):
    return kpi.delay_categories(hot_events(spark, sf))


@register("top_origins", with_hot("""
SELECT origin, round(avg(dep_delay), 6) AS avg_delay, count(dep_delay) AS flight_count
FROM hot WHERE origin IS NOT NULL
GROUP BY origin HAVING count(dep_delay) >= 3
ORDER BY avg(dep_delay) DESC NULLS LAST, origin LIMIT 15"""))
def top_origins(spark, sf):
    return kpi.top_origins(hot_events(spark, sf))


@register("airport_stats", with_hot("""
, ap AS (SELECT 'A' || CAST(range AS VARCHAR) AS code, 'City ' || CAST(range AS VARCHAR) AS city,
                CAST(range + 30 AS DOUBLE) AS lat, CAST(range * 5 - 120 AS DOUBLE) AS lon FROM range(10)),
st AS (SELECT origin AS airport, avg(dep_delay) AS avg_delay, coalesce(sum(dep_delay), 0e0) AS total_delay,
              count(dep_delay) AS flight_count, count(DISTINCT airline_code) AS airlines
       FROM hot WHERE origin IS NOT NULL GROUP BY origin),
k AS (SELECT st.*, ap.lat, ap.lon, ap.city FROM st JOIN ap ON st.airport = ap.code
      WHERE ap.lat IS NOT NULL AND ap.lon IS NOT NULL)
SELECT airport, round(avg_delay, 6) AS avg_delay, round(total_delay, 6) AS total_delay, flight_count, airlines,
       lat, lon, city,
       round(10e0 + (total_delay - min(total_delay) OVER ())
             / (max(total_delay) OVER () - min(total_delay) OVER () + 1e0) * 50e0, 6) AS bubble_size
FROM k"""))
def airport_stats(spark, sf):
    return kpi.airport_stats(hot_events(spark, sf), event_airports(spark))


@register("quick_stats", with_hot("""
SELECT count(*) FILTER (WHERE dep_delay > 60) AS severe_count,
       round(100e0 * count(*) FILTER (WHERE dep_delay > 60) / count(*), 6) AS severe_pct,
       count(DISTINCT airline_code) AS airlines, count(DISTINCT origin) AS origins,
       count(DISTINCT dest) AS destinations, max(dep_delay) AS max_delay,
       round(median(dep_delay), 6) AS median_delay
FROM hot"""))
def quick_stats(spark, sf):
    return kpi.quick_stats(hot_events(spark, sf))


@register("counts_today", with_hot(f"""
SELECT count(*) AS total_flights,
       count(*) FILTER (WHERE "timestamp" >= date_trunc('day', {AS_OF_DAY})) AS today_flights
FROM hot"""))
def counts_today(spark, sf):
    return kpi.counts(hot_events(spark, sf), SPARK_AS_OF_DAY)
