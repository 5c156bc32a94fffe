"""OLAP drill-down (A12, L3): airline, origin, destination and route
levels, one by one or all four in a single GROUPING SETS pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.columns import route_label


def _top(df: DataFrame, key: str, top: int | None) -> DataFrame:
    return df if top is None else df.orderBy(F.desc_nulls_last("avg_delay"), F.asc(key)).limit(top)


def by_airline(df: DataFrame, top: int | None = None) -> DataFrame:
    return _top(df.where(F.col("airline_code").isNotNull()).groupBy("airline_code")
                .agg(F.avg("dep_delay").alias("avg_delay"), F.count("dep_delay").alias("flight_count"),
                     F.avg("arr_delay").alias("avg_arr_delay")), "airline_code", top)


def by_origin(df: DataFrame, top: int | None = 20) -> DataFrame:
    return _top(df.where(F.col("origin").isNotNull()).groupBy("origin")
                .agg(F.avg("dep_delay").alias("avg_delay"), F.count("dep_delay").alias("flight_count")),
                "origin", top)


def by_dest(df: DataFrame, top: int | None = 20) -> DataFrame:
    """Destination level measures the **arrival** delay."""
    return _top(df.where(F.col("dest").isNotNull()).groupBy(F.col("dest").alias("destination"))
                .agg(F.avg("arr_delay").alias("avg_delay"), F.count("arr_delay").alias("flight_count")),
                "destination", top)


def by_route(df: DataFrame, top: int | None = 20, min_count: int = 5) -> DataFrame:
    return _top(df.select(route_label("origin", "dest").alias("route"), "dep_delay")
                .where(F.col("route").isNotNull()).groupBy("route")
                .agg(F.avg("dep_delay").alias("avg_delay"), F.count("dep_delay").alias("flight_count"))
                .where(F.col("flight_count") >= min_count), "route", top)


def grouping_sets(df: DataFrame) -> DataFrame:
    """All four levels in one pass (Expand + one hash aggregate):
    GROUPING SETS ((airline), (origin), (dest), (origin, dest)).

    ``level`` names the set; groups whose own key is NULL are dropped, as
    pandas drops missing keys (the rolled-up NULLs are told apart with
    ``grouping``)."""
    keys = ["airline_code", "origin", "dest"]
    g = df.groupingSets([[F.col("airline_code")], [F.col("origin")], [F.col("dest")],
                         [F.col("origin"), F.col("dest")]], *keys)
    out = g.agg(F.grouping_id(*keys).alias("gid"),
                F.avg("dep_delay").alias("avg_dep_delay"), F.count("dep_delay").alias("dep_count"),
                F.avg("arr_delay").alias("avg_arr_delay"), F.count("arr_delay").alias("arr_count"))
    level = (F.when(F.col("gid") == 3, "airline").when(F.col("gid") == 5, "origin")
             .when(F.col("gid") == 6, "dest").when(F.col("gid") == 4, "route"))
    keep = (((F.col("gid") != 3) | F.col("airline_code").isNotNull())
            & ((~F.col("gid").isin(5, 4)) | F.col("origin").isNotNull())
            & ((~F.col("gid").isin(6, 4)) | F.col("dest").isNotNull()))
    return out.where(keep).select(level.alias("level"), *keys, "avg_dep_delay", "dep_count",
                                  "avg_arr_delay", "arr_count")
