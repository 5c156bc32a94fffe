"""Flight views over the supplied TPC-H-like tables.

``flight_events`` maps the ``events`` table onto the flight schema (sub-day
timestamps, missing values); ``flight_history`` maps ``lineitem`` and its
dimensions onto it (years of dates, all months).  Both are lazy DataFrames:
Catalyst prunes the columns a query does not use and pushes its filters into
the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.schema import CAUSE_COLUMNS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d(x) -> Column:
    """Double literal (a Python float literal would still be DOUBLE, but
    integer arithmetic must be lifted explicitly)."""
    return F.lit(float(x))


def flight_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as flight events (FIXTURES.md B1)."""
    return events_as_flights(read_table(spark, sf_dir, "events"))


def events_as_flights(ev: DataFrame) -> DataFrame:
    """The B1 mapping as a narrow projection: works on a batch or a stream
    of ``events`` rows."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    v = F.floor("value").cast("double") - _d(20)
    cause = {c: F.when((F.col("value") >= 20) & (F.col("event_id") % 4 == i), v)
             .otherwise(_d(0)) for i, c in enumerate(CAUSE_COLUMNS)}
    return (ev.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))
            .select(
                F.concat(F.lit("F"), F.col("event_id")).alias("flight_id"),
                F.col("ts").alias("timestamp"),
                F.col("event_type").alias("airline_code"),
                F.concat(F.lit("A"), F.col("user_id") % 12).alias("origin"),
                F.concat(F.lit("A"), F.col("k") % 12).alias("dest"),
                (F.hour("ts") * 100 + F.minute("ts")).cast("int").alias("crs_dep_time"),
                F.when(F.col("user_id") % 17 == 0, F.lit(None).cast("double"))
                .otherwise(v).alias("dep_delay"),
                F.when(F.col("k") % 23 == 0, F.lit(None).cast("double"))
                .otherwise(v + (F.col("k") % 21).cast("double") - _d(10)).alias("arr_delay"),
                F.when(F.col("k") % 31 == 30, F.lit(None).cast("double"))
                .otherwise((F.col("k") * 25).cast("double")).alias("distance"),
                *[cause[c].alias(c) for c in CAUSE_COLUMNS],
                F.month("ts").alias("month"),
                F.weekday("ts").alias("day_of_week"),
            ))


def flight_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` joined to its order, supplier, customer and their nations
    (FIXTURES.md B2).  ``nation`` has a fixed size (25 rows) and is the only
    side broadcast by hint; the big joins are left to Catalyst/AQE."""
    li = read_table(spark, sf_dir, "lineitem")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = read_table(spark, sf_dir, "nation")
    ns = F.broadcast(na.select(F.col("n_nationkey").alias("s_nationkey"),
                               F.col("n_name").alias("origin")))
    nc = F.broadcast(na.select(F.col("n_nationkey").alias("c_nationkey"),
                               F.col("n_name").alias("dest")))
    j = (li.join(od, li.l_orderkey == od.o_orderkey)
         .join(su, li.l_suppkey == su.s_suppkey)
         .join(cu, od.o_custkey == cu.c_custkey)
         .join(ns, "s_nationkey").join(nc, "c_nationkey"))
    q = F.col("l_quantity")
    return j.select(
        F.concat(F.lit("H"), "l_orderkey", F.lit("_"), "l_linenumber", F.lit("_"),
                 "l_partkey", F.lit("_"), "l_suppkey").alias("flight_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("o_orderpriority").alias("airline_code"),
        "origin", "dest",
        ((F.col("l_orderkey") % 24) * 100 + F.col("l_partkey") % 60).cast("int").alias("crs_dep_time"),
        F.when((F.col("l_linenumber") == 7) & (q < 5), F.lit(None).cast("double"))
        .otherwise(q * 2 - 30).alias("dep_delay"),
        (q * 2 - 35 + F.col("l_linenumber")).alias("arr_delay"),
        (F.col("l_extendedprice") / 50).alias("distance"),
        *[F.lit(None).cast("double").alias(c) for c in CAUSE_COLUMNS],
        F.month("l_shipdate").alias("month"),
        F.weekday("l_shipdate").alias("day_of_week"),
    )


# The 10 known airports of the events fixture (A10 and A11 are
# deliberately unknown).  code, city, lat, lon follow one rule:
# city "City <i>", lat 30 + i, lon -120 + 5 * i.
def event_airports(spark: SparkSession) -> DataFrame:
    return spark.range(10).select(
        F.concat(F.lit("A"), F.col("id")).alias("code"),
        F.concat(F.lit("City "), F.col("id")).alias("city"),
        (F.col("id") + 30).cast("double").alias("lat"),
        (F.col("id") * 5 - 120).cast("double").alias("lon"),
    )


def airlines(flights: DataFrame) -> DataFrame:
    """Airline dimension derived from the data: code and an upper-case name."""
    return (flights.select("airline_code").where(F.col("airline_code").isNotNull())
            .distinct()
            .select("airline_code", F.upper("airline_code").alias("airline_name")))
