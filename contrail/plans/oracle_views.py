"""DuckDB definitions of the analysis views, prepended as CTEs to every
oracle query (only the base tables are registered in the oracle)."""

FLIGHT_EVENTS = """
flight_events AS (
  SELECT 'F' || CAST(event_id AS VARCHAR) AS flight_id,
         ts AS "timestamp",
         event_type AS airline_code,
         'A' || CAST(user_id % 12 AS VARCHAR) AS origin,
         'A' || CAST(k % 12 AS VARCHAR) AS dest,
         CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS crs_dep_time,
         CASE WHEN user_id % 17 = 0 THEN NULL ELSE floor(value) - 20e0 END AS dep_delay,
         CASE WHEN k % 23 = 0 THEN NULL
              ELSE floor(value) - 20e0 + CAST(k % 21 AS DOUBLE) - 10e0 END AS arr_delay,
         CASE WHEN k % 31 = 30 THEN NULL ELSE CAST(k * 25 AS DOUBLE) END AS distance,
         CASE WHEN value >= 20 AND event_id % 4 = 0 THEN floor(value) - 20e0 ELSE 0e0 END AS delay_due_weather,
         CASE WHEN value >= 20 AND event_id % 4 = 1 THEN floor(value) - 20e0 ELSE 0e0 END AS delay_due_carrier,
         CASE WHEN value >= 20 AND event_id % 4 = 2 THEN floor(value) - 20e0 ELSE 0e0 END AS delay_due_nas,
         CASE WHEN value >= 20 AND event_id % 4 = 3 THEN floor(value) - 20e0 ELSE 0e0 END AS delay_due_late_aircraft,
         CAST(month(ts) AS INTEGER) AS month,
         CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
)"""

FLIGHT_HISTORY = """
flight_history AS (
  SELECT 'H' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) || '_'
             || CAST(l_partkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR) AS flight_id,
         l_shipdate AS "timestamp",
         o_orderpriority AS airline_code,
         ns.n_name AS origin,
         nc.n_name AS dest,
         CAST((l_orderkey % 24) * 100 + l_partkey % 60 AS INTEGER) AS crs_dep_time,
         CASE WHEN l_linenumber = 7 AND l_quantity < 5 THEN NULL ELSE l_quantity * 2 - 30 END AS dep_delay,
         l_quantity * 2 - 35 + l_linenumber AS arr_delay,
         l_extendedprice / 50 AS distance,
         CAST(NULL AS DOUBLE) AS delay_due_weather,
         CAST(NULL AS DOUBLE) AS delay_due_carrier,
         CAST(NULL AS DOUBLE) AS delay_due_nas,
         CAST(NULL AS DOUBLE) AS delay_due_late_aircraft,
         CAST(month(l_shipdate) AS INTEGER) AS month,
         CAST(isodow(l_shipdate) - 1 AS INTEGER) AS day_of_week
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ns ON s_nationkey = ns.n_nationkey
  JOIN nation nc ON c_nationkey = nc.n_nationkey
)"""


def _predict_a(src: str, name: str) -> str:
    return f"""
{name}_p AS (
  SELECT *, round(dep_delay * 0.85e0 + CASE WHEN distance > 1000 THEN 5e0 ELSE 2e0 END
                  + CASE WHEN month IN (11, 12, 1) THEN 3e0 ELSE 0e0 END, 2) AS predicted_delay
  FROM {src}
),
{name} AS (
  SELECT *, CASE WHEN abs(predicted_delay - dep_delay) < 10 THEN 0.9e0
                 WHEN abs(predicted_delay - dep_delay) < 20 THEN 0.75e0
                 ELSE 0.6e0 END AS prediction_confidence
  FROM {name}_p
)"""


HOT = FLIGHT_EVENTS + "," + _predict_a("flight_events", "hot")
HOT_HISTORY = FLIGHT_HISTORY + "," + _predict_a("flight_history", "hist")

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
AS_OF_DAY = "TIMESTAMP '2024-01-30 20:00:00'"


def with_hot(body: str) -> str:
    """``WITH <hot view> , <more CTEs or nothing> SELECT ...``"""
    return "WITH " + HOT + body


def with_history(body: str) -> str:
    return "WITH " + HOT_HISTORY + body


# Timestamp text in the comparison form (matches views.present).
def ts_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"
