"""Dimension lookups.

Dimensions are joined without hints: Catalyst broadcasts one whose statistics
or, under AQE, measured size is below ``spark.sql.autoBroadcastJoinThreshold``
and shuffles a larger one.  Building a plan runs no job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(facts: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Facts ⨝ dim on ``key``."""
    return facts.join(dim, key, how)


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row.

    Written as an equi-join on a constant key against the broadcast row
    (a global aggregate has exactly one row), so the plan is a
    BroadcastHashJoin: no cartesian product and no single-task window."""
    k = "__scalar_key"
    return (df.withColumn(k, F.lit(1))
            .join(F.broadcast(one_row.withColumn(k, F.lit(1))), k, "inner")
            .drop(k))


def enrich_dims(flights: DataFrame, airports: DataFrame, airlines: DataFrame) -> DataFrame:
    """Flights (batch or stream) ⨝ airline names ⨝ airports twice
    (origin and destination under their own column names).  Left joins:
    an unknown code keeps the flight with NULL attributes."""
    a = airports.select("code", "city", "lat", "lon")
    org = a.select(F.col("code").alias("origin"), F.col("city").alias("origin_city"),
                   F.col("lat").alias("origin_lat"), F.col("lon").alias("origin_lon"))
    dst = a.select(F.col("code").alias("dest"), F.col("city").alias("dest_city"),
                   F.col("lat").alias("dest_lat"), F.col("lon").alias("dest_lon"))
    return (flights
            .join(airlines, "airline_code", "left")
            .join(org, "origin", "left")
            .join(dst, "dest", "left"))


def enrich_stream(stream: DataFrame, read_dims: Callable, write: Callable, checkpoint: str, available_now: bool = True):
    """J2 on a stream: ``read_dims(spark, batch_id)`` -> (airports, airlines) is
    called at each micro-batch, so a dimension that changes while the stream runs
    holds from the next batch on; ``write(flights, batch_id)`` stores the batch and
    must bear a repeated batch."""
    def each(batch: DataFrame, batch_id: int) -> None:
        airports, airlines = read_dims(batch.sparkSession, batch_id)
        write(enrich_dims(batch, airports, airlines), batch_id)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")).start()
    if available_now:
        q.awaitTermination()
    return q
