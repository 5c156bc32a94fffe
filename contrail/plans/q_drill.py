"""OLAP drill-down queries."""

from contrail.operators import drill
from contrail.plans.oracle_views import with_history, with_hot
from contrail.plans.registry import register
from contrail.plans.views import hot_events, hot_history


@register("drill_airline", with_hot("""
SELECT airline_code, round(avg(dep_delay), 6) AS avg_delay, count(dep_delay) AS flight_count,
       round(avg(arr_delay), 6) AS avg_arr_delay
FROM hot WHERE airline_code IS NOT NULL GROUP BY airline_code"""))
def drill_airline(spark, sf):
    return drill.by_airline(hot_events(spark, sf))


@register("drill_origin", with_hot("""
SELECT origin, round(avg(dep_delay), 6) AS avg_delay, count(dep_delay) AS flight_count
FROM hot WHERE origin IS NOT NULL GROUP BY origin
ORDER BY avg(dep_delay) DESC NULLS LAST, origin LIMIT 20"""))
def drill_origin(spark, sf):
    return drill.by_origin(hot_events(spark, sf))


@register("drill_dest", with_hot("""
SELECT dest AS destination, round(avg(arr_delay), 6) AS avg_delay, count(arr_delay) AS flight_count
FROM hot WHERE dest IS NOT NULL GROUP BY dest
ORDER BY avg(arr_delay) DESC NULLS LAST, dest LIMIT 20"""))
def drill_dest(spark, sf):
    return drill.by_dest(hot_events(spark, sf))


_ROUTE = """
SELECT route, round(avg(dep_delay), 6) AS avg_delay, count(dep_delay) AS flight_count
FROM (SELECT origin || ' → ' || dest AS route, dep_delay FROM {v}) t
WHERE route IS NOT NULL GROUP BY route HAVING count(dep_delay) >= 5
ORDER BY avg(dep_delay) DESC NULLS LAST, route LIMIT 20"""


@register("drill_route", with_hot(_ROUTE.format(v="hot")))
def drill_route(spark, sf):
    return drill.by_route(hot_events(spark, sf))


@register("drill_route_history", with_history(_ROUTE.format(v="hist")))
def drill_route_history(spark, sf):
    return drill.by_route(hot_history(spark, sf))


_GSETS = """
SELECT level, airline_code, origin, dest, round(avg_dep_delay, 6) AS avg_dep_delay, dep_count,
       round(avg_arr_delay, 6) AS avg_arr_delay, arr_count
FROM (SELECT CASE grouping(airline_code, origin, dest) WHEN 3 THEN 'airline' WHEN 5 THEN 'origin'
                  WHEN 6 THEN 'dest' WHEN 4 THEN 'route' END AS level,
             grouping(airline_code, origin, dest) AS gid,
             airline_code, origin, dest, avg(dep_delay) AS avg_dep_delay, count(dep_delay) AS dep_count,
             avg(arr_delay) AS avg_arr_delay, count(arr_delay) AS arr_count
      FROM {v}
      GROUP BY GROUPING SETS ((airline_code), (origin), (dest), (origin, dest))) g
WHERE (gid <> 3 OR airline_code IS NOT NULL)
  AND (gid NOT IN (5, 4) OR origin IS NOT NULL)
  AND (gid NOT IN (6, 4) OR dest IS NOT NULL)"""


@register("drill_grouping_sets", with_hot(_GSETS.format(v="hot")))
def drill_grouping_sets(spark, sf):
    return drill.grouping_sets(hot_events(spark, sf))


@register("drill_grouping_sets_history", with_history(_GSETS.format(v="hist")))
def drill_grouping_sets_history(spark, sf):
    return drill.grouping_sets(hot_history(spark, sf))
