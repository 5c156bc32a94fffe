"""Data-quality and delay-cause queries."""

from contrail.functions.columns import flight_id_expr
from contrail.operators import causes, quality
from contrail.plans.oracle_views import AS_OF, with_history, with_hot
from contrail.plans.registry import register
from contrail.plans.views import AS_OF as SPARK_AS_OF, hot_events
from contrail.sources.tables import flight_history

# Columns of the hot view, in order (the SQL twin enumerates them).
HOT_COLUMNS = ["flight_id", "timestamp", "airline_code", "origin", "dest", "crs_dep_time", "dep_delay",
               "arr_delay", "distance", "delay_due_weather", "delay_due_carrier", "delay_due_nas",
               "delay_due_late_aircraft", "month", "day_of_week", "predicted_delay", "prediction_confidence"]
_FLOATING = {"dep_delay", "arr_delay", "distance", "delay_due_weather", "delay_due_carrier", "delay_due_nas",
             "delay_due_late_aircraft", "predicted_delay", "prediction_confidence"}
_NUMERIC = ["crs_dep_time", "dep_delay", "arr_delay", "distance", "delay_due_weather", "delay_due_carrier",
            "delay_due_nas", "delay_due_late_aircraft", "month", "day_of_week", "predicted_delay",
            "prediction_confidence"]


def _miss(c: str) -> str:
    q = f'"{c}"'
    return f"{q} IS NULL OR isnan({q})" if c in _FLOATING else f"{q} IS NULL"


_MISSING = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS field, count(*) FILTER (WHERE {_miss(c)}) AS missing_count, count(*) AS n FROM hot"
    for c in HOT_COLUMNS)

_MISSING_SQL = f"""
, m AS (
  {_MISSING})
SELECT field, missing_count, round(100e0 * missing_count / n, 6) AS missing_pct FROM m WHERE missing_count > 0"""


@register("missing_values", with_hot(_MISSING_SQL))
def missing_values(spark, sf):
    return quality.missing_values(hot_events(spark, sf).select(*HOT_COLUMNS))


@register("dup_stats", with_hot("""
SELECT count(*) AS records,
       count(*) - count(DISTINCT flight_id) - CASE WHEN count(*) FILTER (WHERE flight_id IS NULL) > 0 THEN 1 ELSE 0 END
         AS duplicates,
       round(100e0 * (count(*) - count(DISTINCT flight_id)
             - CASE WHEN count(*) FILTER (WHERE flight_id IS NULL) > 0 THEN 1 ELSE 0 END) / count(*), 6)
         AS duplicate_pct
FROM hot"""))
def dup_stats(spark, sf):
    return quality.dup_stats(hot_events(spark, sf), "flight_id")


@register("dup_stats_history", with_history("""
, ids AS (SELECT regexp_replace(CAST("timestamp" AS VARCHAR), '[^0-9]', '', 'g') || '_' || airline_code || '_'
                 || origin || '_' || dest AS fid FROM flight_history)
SELECT count(*) AS records,
       count(*) - count(DISTINCT fid) - CASE WHEN count(*) FILTER (WHERE fid IS NULL) > 0 THEN 1 ELSE 0 END
         AS duplicates,
       round(100e0 * (count(*) - count(DISTINCT fid)
             - CASE WHEN count(*) FILTER (WHERE fid IS NULL) > 0 THEN 1 ELSE 0 END) / count(*), 6)
         AS duplicate_pct
FROM ids"""))
def dup_stats_history(spark, sf):
    """Ids derived by the ingest rule (time digits + airline + route)
    collide on day-granular history: the duplicate census finds them."""
    h = flight_history(spark, sf)
    return quality.dup_stats(h.select(flight_id_expr("timestamp", "airline_code", "origin", "dest")
                                      .alias("flight_id")), "flight_id")


@register("quality_score", with_hot(_MISSING_SQL.replace("SELECT field, missing_count", "SELECT field, missing_count", 1)
                                    .replace("\nSELECT field, missing_count, round(100e0 * missing_count / n, 6) AS missing_pct FROM m WHERE missing_count > 0",
                                             f"""
, mp AS (SELECT coalesce(sum(100e0 * missing_count / n), 0e0) AS missing_pct_sum FROM m WHERE missing_count > 0),
fr AS (SELECT (epoch_us({AS_OF}) - epoch_us(max("timestamp"))) / 3.6e9 AS age_hours FROM hot),
dp AS (SELECT 100e0 * (count(*) - count(DISTINCT flight_id)
              - CASE WHEN count(*) FILTER (WHERE flight_id IS NULL) > 0 THEN 1 ELSE 0 END) / count(*) AS duplicate_pct
       FROM hot),
s AS (SELECT missing_pct_sum, age_hours, duplicate_pct,
             greatest(100e0 - least(missing_pct_sum * 2e0, 50e0)
                      - CASE WHEN age_hours > 24 THEN least((age_hours - 24e0) / 24e0 * 10e0, 30e0) ELSE 0e0 END
                      - least(coalesce(duplicate_pct, 0e0), 20e0), 0e0) AS quality_score
      FROM mp, fr, dp)
SELECT round(missing_pct_sum, 6) AS missing_pct_sum, round(age_hours, 6) AS age_hours,
       round(duplicate_pct, 6) AS duplicate_pct, round(quality_score, 6) AS quality_score,
       CASE WHEN quality_score >= 90 THEN 'excellent' WHEN quality_score >= 70 THEN 'good'
            ELSE 'needs attention' END AS band
FROM s""")))
def quality_score(spark, sf):
    return quality.quality_score(hot_events(spark, sf).select(*HOT_COLUMNS), SPARK_AS_OF)


_DESCRIBE = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS field, count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
       min(x) AS min, round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50,
       round(quantile_cont(x, 0.75), 6) AS p75, max(x) AS max
FROM (SELECT CASE WHEN isnan(CAST("{c}" AS DOUBLE)) THEN NULL ELSE CAST("{c}" AS DOUBLE) END AS x FROM hot) t{i}"""
    for i, c in enumerate(_NUMERIC))


@register("describe_numeric", with_hot("\n" + _DESCRIBE))
def describe_numeric(spark, sf):
    return quality.describe_numeric(hot_events(spark, sf), _NUMERIC)


@register("cause_shares", with_hot("""
, l AS (SELECT airline_code, 'weather' AS cause, delay_due_weather AS minutes FROM hot WHERE airline_code IS NOT NULL
        UNION ALL SELECT airline_code, 'carrier', delay_due_carrier FROM hot WHERE airline_code IS NOT NULL
        UNION ALL SELECT airline_code, 'nas', delay_due_nas FROM hot WHERE airline_code IS NOT NULL
        UNION ALL SELECT airline_code, 'late_aircraft', delay_due_late_aircraft FROM hot WHERE airline_code IS NOT NULL),
a AS (SELECT airline_code, cause, coalesce(sum(minutes), 0e0) AS cause_minutes FROM l GROUP BY airline_code, cause)
SELECT airline_code, cause, round(cause_minutes, 6) AS cause_minutes,
       round(100e0 * cause_minutes / nullif(sum(cause_minutes) OVER (PARTITION BY airline_code), 0), 6) AS share_pct
FROM a"""))
def cause_shares(spark, sf):
    return causes.cause_shares(hot_events(spark, sf))


@register("distance_quantiles_history", with_history("""
SELECT p, round(v, 6) AS value FROM (
  SELECT 0.05e0 AS p, quantile_cont(distance, 0.05) AS v FROM hist
  UNION ALL SELECT 0.25e0, quantile_cont(distance, 0.25) FROM hist
  UNION ALL SELECT 0.5e0, quantile_cont(distance, 0.5) FROM hist
  UNION ALL SELECT 0.75e0, quantile_cont(distance, 0.75) FROM hist
  UNION ALL SELECT 0.95e0, quantile_cont(distance, 0.95) FROM hist) t"""))
def distance_quantiles_history(spark, sf):
    """Exact quantiles of a continuous column (distance) by distributed rank."""
    from contrail.plans.views import hot_history
    return quality.exact_quantiles(hot_history(spark, sf), "distance", (0.05, 0.25, 0.5, 0.75, 0.95))
