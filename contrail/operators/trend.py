"""Time-bucketed trends.

Buckets are computed as columns and aggregated with a normal hash
aggregate (partial + final), so a bucket holding a large share of the rows
is combined map-side before the shuffle.  Fixed-size outputs (7 weekdays,
24 hours, N minutes) are densified with a small generated spine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.columns import DAY_NAMES, dbl


def _ts(as_of):
    return F.lit(as_of).cast("timestamp_ntz")


def daily_stats(df: DataFrame) -> DataFrame:
    """Per calendar day: mean/max/min/count of departure delay and mean
    arrival delay."""
    return (df.where(F.col("timestamp").isNotNull())
            .groupBy(F.to_date("timestamp").alias("date"))
            .agg(F.avg("dep_delay").alias("avg_dep_delay"), F.max("dep_delay").alias("max_delay"),
                 F.min("dep_delay").alias("min_delay"), F.count("dep_delay").alias("flight_count"),
                 F.avg("arr_delay").alias("avg_arr_delay")))


def hourly_stats(df: DataFrame) -> DataFrame:
    """A10: per hour of day: mean delay and number of flights (non-null id)."""
    return (df.where(F.col("timestamp").isNotNull())
            .groupBy(F.hour("timestamp").alias("hour"))
            .agg(F.avg("dep_delay").alias("avg_delay"), F.count("flight_id").alias("flight_count")))


def _day_spine(spark):
    return spark.createDataFrame([(i, d) for i, d in enumerate(DAY_NAMES)],
                                 "day_index int, day_of_week string")


def dow_stats(df: DataFrame) -> DataFrame:
    """Mean delay per weekday, Monday..Sunday; a weekday without any
    flight is 0 (only absent days are filled, a present all-missing day
    stays NULL)."""
    agg = (df.where(F.col("timestamp").isNotNull())
           .groupBy(F.weekday("timestamp").alias("day_index"))
           .agg(F.avg("dep_delay").alias("_avg"), F.lit(1).alias("_present")))
    spine = _day_spine(df.sparkSession)
    return (spine.join(F.broadcast(agg), "day_index", "left")
            .select("day_index", "day_of_week",
                    F.when(F.col("_present").isNull(), dbl(0)).otherwise(F.col("_avg")).alias("avg_delay")))


def heatmap(df: DataFrame) -> DataFrame:
    """Mean delay pivoted weekday x hour (columns h00..h23); only
    weekdays that occur, ordered Monday first by ``day_index``.  The pivot
    values are given explicitly, which saves the distinct-values job."""
    hours = list(range(24))
    p = (df.where(F.col("timestamp").isNotNull())
         .withColumn("hour", F.hour("timestamp"))
         .groupBy(F.weekday("timestamp").alias("day_index"))
         .pivot("hour", hours).agg(F.avg("dep_delay")))
    p = p.select("day_index", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])
    spine = _day_spine(df.sparkSession)
    return p.join(F.broadcast(spine), "day_index").select("day_index", "day_of_week", *[f"h{h:02d}" for h in hours])


def tumbling(df: DataFrame, duration: str = "5 minutes") -> DataFrame:
    """Epoch-aligned tumbling buckets: mean delay and flights (non-null
    id) per bucket; works on batch and streaming frames alike."""
    return (df.where(F.col("timestamp").isNotNull())
            .groupBy(F.window("timestamp", duration).alias("w"))
            .agg(F.avg("dep_delay").alias("avg_delay"), F.count("flight_id").alias("flight_count"))
            .select(F.col("w.start").alias("bucket_start"), "avg_delay", "flight_count"))


def hourly_trend(df: DataFrame, last: int = 48) -> DataFrame:
    """T4 + L4: mean delay and flights (non-null airline) per clock hour,
    the ``last`` most recent non-empty hours."""
    return (df.where(F.col("timestamp").isNotNull())
            .groupBy(F.date_trunc("HOUR", "timestamp").alias("hour"))
            .agg(F.avg("dep_delay").alias("avg_delay"), F.count("airline_code").alias("flight_count"))
            .orderBy(F.desc("hour")).limit(last))


def minute_counts(df: DataFrame, as_of, minutes: int = 10, ts_col: str = "timestamp") -> DataFrame:
    """Rows per one-minute window [as_of - i min, as_of - (i-1) min) for
    i = minutes..1, empty minutes as 0 -- one filtered aggregate plus a
    ``minutes``-row spine instead of one count query per minute."""
    end = _ts(as_of)
    d = F.timestamp_diff("MICROSECOND", F.col(ts_col), end)
    recent = (df.where((F.col(ts_col) < end) & (F.col(ts_col) >= end - F.expr(f"INTERVAL {minutes} MINUTES")))
              .groupBy(F.ceil(d / F.lit(60_000_000)).cast("int").alias("minutes_ago"))
              .agg(F.count(F.lit(1)).alias("record_count")))
    spine = df.sparkSession.range(1, minutes + 1).select(F.col("id").cast("int").alias("minutes_ago"))
    return (spine.join(F.broadcast(recent), "minutes_ago", "left")
            .select("minutes_ago",
                    F.date_format(F.timestamp_add("MINUTE", -F.col("minutes_ago"), end), "HH:mm:ss").alias("window_start"),
                    F.coalesce("record_count", F.lit(0).cast("bigint")).alias("record_count")))


def throughput(df: DataFrame, as_of, ts_col: str = "timestamp") -> DataFrame:
    """A22 + A23: rows in the last minute and hour before ``as_of``, the
    per-minute rate of the last hour, total rows, latest event and the
    latency from it to ``as_of`` (seconds)."""
    end = _ts(as_of)
    t = F.col(ts_col)
    last_hour = F.count_if((t >= end - F.expr("INTERVAL 1 HOUR")) & (t <= end))
    return (df.agg(F.count(F.lit(1)).alias("total_records"),
                   F.count_if((t >= end - F.expr("INTERVAL 1 MINUTE")) & (t <= end)).alias("last_minute"),
                   last_hour.alias("last_hour"),
                   (last_hour / dbl(60)).alias("per_minute_rate"),
                   F.max(t).alias("latest_event"))
            .withColumn("latency_seconds",
                        F.timestamp_diff("MICROSECOND", F.col("latest_event"), end) / dbl(1e6)))


def freshness(df: DataFrame, as_of, ts_col: str = "timestamp") -> DataFrame:
    """Latest and oldest event and the age of the latest in hours."""
    end = _ts(as_of)
    return (df.agg(F.max(ts_col).alias("latest_record"), F.min(ts_col).alias("oldest_record"))
            .withColumn("age_hours", F.timestamp_diff("MICROSECOND", F.col("latest_record"), end) / dbl(3.6e9)))


def rows_per_date(df: DataFrame, ts_col: str = "ingestion_timestamp") -> DataFrame:
    """Rows per ingestion date."""
    return (df.where(F.col(ts_col).isNotNull())
            .groupBy(F.to_date(ts_col).alias("date"))
            .agg(F.count(F.lit(1)).alias("record_count")))



# The range presets of the streaming page.
RANGE_PRESETS = {"1h": "1 HOUR", "6h": "6 HOURS", "24h": "24 HOURS"}


def in_range(df: DataFrame, as_of, preset: str = "24h", ts_col: str = "timestamp") -> DataFrame:
    """P25: rows of the last 1 / 6 / 24 hours before ``as_of`` (``all`` =
    since 2020-01-01); a plain timestamp predicate, pushed into the scan."""
    return df.where(F.col(ts_col) >= since(as_of, preset))


def since(as_of, preset: str):
    """The instant a preset begins at."""
    if preset == "all":
        return F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    return _ts(as_of) - F.expr(f"INTERVAL {RANGE_PRESETS[preset]}")


def has_field(df: DataFrame, field: str, *, not_null: bool = False) -> DataFrame:
    """Rows that have a field.  In a table with a schema each row has it, a
    missing value included; ``not_null`` keeps only rows with a value (NaN is a
    value, as in the original)."""
    if field not in df.columns:
        return df.where(F.lit(False))
    return df.where(F.col(field).isNotNull()) if not_null else df


def date_parts(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Calendar date, hour and day name of each row."""
    return df.withColumns({"date": F.to_date(ts_col), "hour": F.hour(ts_col),
                           "day_name": F.date_format(ts_col, "EEEE")})
