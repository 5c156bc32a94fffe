"""File scans of flight history and training data.

CSV is read with a header and without schema inference (inference is an
extra full pass); the needed columns are selected by name and typed with
``try_cast``, so a malformed value becomes NULL (or 0 for the schedule
time, as the reference coerces it) instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.columns import coerce_int

# Columns of the flight history file, in the reference's order.
HISTORY_COLUMNS = [
    "FL_DATE", "AIRLINE_CODE", "ORIGIN", "DEST", "CRS_DEP_TIME", "DEP_DELAY", "ARR_DELAY", "DISTANCE",
    "DELAY_DUE_WEATHER", "DELAY_DUE_CARRIER", "DELAY_DUE_NAS", "DELAY_DUE_LATE_AIRCRAFT",
]
_DOUBLES = ["DEP_DELAY", "ARR_DELAY", "DISTANCE", "DELAY_DUE_WEATHER", "DELAY_DUE_CARRIER", "DELAY_DUE_NAS",
            "DELAY_DUE_LATE_AIRCRAFT"]


def read_history_csv(spark: SparkSession, path: str, *, sample_rows: int | None = None,
                     sample_fraction: float | None = None, seed: int = 42) -> DataFrame:
    """S5/S6 + P17 + P18: the history CSV as typed flights.

    ``sample_rows`` keeps a repeatable top-k by a seeded hash (the
    reference samples 10,000 rows); ``sample_fraction`` a Bernoulli sample.
    Without either, the whole file is read."""
    raw = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    day = F.to_date(F.col("FL_DATE"))
    df = raw.select(
        day.cast("timestamp_ntz").alias("timestamp"),
        F.col("AIRLINE_CODE").alias("airline_code"),
        F.col("ORIGIN").alias("origin"),
        F.col("DEST").alias("dest"),
        coerce_int("CRS_DEP_TIME").alias("crs_dep_time"),
        *[F.col(c).try_cast("double").alias(c.lower()) for c in _DOUBLES],
        F.month(day).alias("month"),
        F.weekday(day).alias("day_of_week"),
    )
    if sample_fraction is not None:
        df = df.sample(fraction=sample_fraction, seed=seed)
    if sample_rows is not None:
        key = F.xxhash64(*[F.col(c) for c in ("timestamp", "airline_code", "origin", "dest", "crs_dep_time")],
                         F.lit(seed))
        df = df.orderBy(key).limit(sample_rows)
    return df


def write_history_csv(flights: DataFrame, path: str) -> None:
    """Flights -> history CSV with the reference's header (for replays)."""
    flights.select(
        F.date_format("timestamp", "yyyy-MM-dd").alias("FL_DATE"),
        F.col("airline_code").alias("AIRLINE_CODE"), F.col("origin").alias("ORIGIN"),
        F.col("dest").alias("DEST"), F.col("crs_dep_time").alias("CRS_DEP_TIME"),
        *[F.col(c.lower()).alias(c) for c in _DOUBLES],
    ).write.mode("overwrite").option("header", "true").csv(path)
