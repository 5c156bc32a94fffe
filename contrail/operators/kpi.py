"""Executive KPIs (A1-A8, L2, J1): one-pass global aggregates and
group-by + top-k reports.

Group keys are filtered ``IS NOT NULL`` first (pandas drops missing keys),
means skip NULL (pandas skip-NaN) and percentage denominators are
``count(*)`` (pandas ``len(df)``).  Every top-k is ``orderBy(...).limit(k)``,
which Spark plans as TakeOrderedAndProject: a per-partition top-k and a
k-row merge, never a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.columns import dbl, delay_category, pct, safe_div
from contrail.operators.enrich import attach_scalars, lookup_join


def counts(df: DataFrame, as_of) -> DataFrame:
    """A1: total rows and rows since midnight of ``as_of`` (one scan)."""
    day0 = F.date_trunc("DAY", F.lit(as_of).cast("timestamp_ntz"))
    return df.agg(F.count(F.lit(1)).alias("total_flights"),
                  F.count_if(F.col("timestamp") >= day0).alias("today_flights"))


def kpi_row(df: DataFrame, as_of, *, delay_target: float = 15.0, sla_pct: float = 80.0,
            accuracy_target: float = 70.0, tolerance: float = 10.0) -> DataFrame:
    """A1 + A2 + A3 in one aggregate: counts, average delay, on-time share
    (delay <= 15 over all rows), prediction hit rate (|error| <= tolerance
    over rows with both values) and the three verdicts."""
    day0 = F.date_trunc("DAY", F.lit(as_of).cast("timestamp_ntz"))
    both = F.col("predicted_delay").isNotNull() & F.col("dep_delay").isNotNull()
    hit = both & (F.abs(F.col("predicted_delay") - F.col("dep_delay")) <= tolerance)
    agg = df.agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.count_if(F.col("timestamp") >= day0).alias("today_flights"),
        F.avg("dep_delay").alias("avg_delay"),
        pct(F.count_if(F.col("dep_delay") <= 15), F.count(F.lit(1))).alias("on_time_pct"),
        pct(F.count_if(hit), F.count_if(both)).alias("accuracy_pct"),
    )
    return agg.withColumns({
        "delay_verdict": F.when(F.col("avg_delay") > delay_target, "above target").otherwise("on target"),
        "sla_verdict": F.when(F.col("on_time_pct") >= sla_pct, "meeting SLA").otherwise("below SLA"),
        "accuracy_verdict": F.when(F.col("accuracy_pct") >= accuracy_target, "on target").otherwise("below target"),
    })


def delay_categories(df: DataFrame, delay: str = "dep_delay") -> DataFrame:
    """A4: flights per right-closed delay category (missing delays dropped)."""
    return (df.select(delay_category(delay).alias("delay_category"))
            .where(F.col("delay_category").isNotNull())
            .groupBy("delay_category").agg(F.count(F.lit(1)).alias("flight_count")))


def group_delay(df: DataFrame, key: str, *, min_count: int = 1, top: int | None = None,
                delay: str = "dep_delay") -> DataFrame:
    """Mean delay and non-missing count per key, HAVING count >= min_count,
    optionally the ``top`` highest means (ties broken by key)."""
    out = (df.where(F.col(key).isNotNull()).groupBy(key)
           .agg(F.avg(delay).alias("avg_delay"), F.count(delay).alias("flight_count"))
           .where(F.col("flight_count") >= min_count))
    if top is not None:
        out = out.orderBy(F.desc_nulls_last("avg_delay"), F.asc(key)).limit(top)
    return out


def top_airlines(df: DataFrame, k: int = 10, min_count: int = 5) -> DataFrame:
    """A5 + L2: top airlines by mean departure delay, at least 5 flights."""
    return group_delay(df, "airline_code", min_count=min_count, top=k)


def top_origins(df: DataFrame, k: int = 15, min_count: int = 3) -> DataFrame:
    """A6 + L2: top origin airports by mean departure delay, at least 3."""
    return group_delay(df, "origin", min_count=min_count, top=k)


def airport_stats(df: DataFrame, airports: DataFrame) -> DataFrame:
    """A7 + J1 + P26: per origin mean/sum/count of delay and distinct
    airlines, enriched with coordinates (unknown airports dropped) and a
    bubble size scaled between the smallest and largest total delay."""
    stats = (df.where(F.col("origin").isNotNull()).groupBy(F.col("origin").alias("airport"))
             .agg(F.avg("dep_delay").alias("avg_delay"),
                  F.coalesce(F.sum("dep_delay"), dbl(0)).alias("total_delay"),
                  F.count("dep_delay").alias("flight_count"),
                  F.count_distinct("airline_code").alias("airlines")))
    known = lookup_join(stats, airports.select(F.col("code").alias("airport"), "lat", "lon", "city"),
                        "airport", how="inner")
    known = known.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    # One-row min/max aggregate joined back (a global window would need
    # one task).
    bounds = known.agg(F.min("total_delay").alias("_lo"), F.max("total_delay").alias("_hi"))
    return (attach_scalars(known, bounds)
            .withColumn("bubble_size", dbl(10) + safe_div(F.col("total_delay") - F.col("_lo"),
                                                          F.col("_hi") - F.col("_lo") + dbl(1)) * dbl(50))
            .drop("_lo", "_hi"))


def quick_stats(df: DataFrame, *, approx: bool = False) -> DataFrame:
    """Severe delays (> 60) count and share, distinct airlines, origins
    and destinations, max and median delay.  The exact median comes from the
    range-partitioned counts per value (``quality.field_quantiles``): no task
    holds the values.  ``approx=True`` swaps in HyperLogLog distinct counts and
    an approximate percentile; for stored sketches see ``operators.sketches``."""
    nd = F.approx_count_distinct if approx else F.count_distinct
    severe = F.count_if(F.col("dep_delay") > 60)
    out = df.agg(severe.alias("severe_count"), pct(severe, F.count(F.lit(1))).alias("severe_pct"), nd("airline_code").alias("airlines"), nd("origin").alias("origins"),
                 nd("dest").alias("destinations"), F.max("dep_delay").alias("max_delay"),
                 *([F.percentile_approx("dep_delay", 0.5, 10000).alias("median_delay")] if approx else []))
    if approx:
        return out
    from contrail.operators.quality import field_quantiles
    return attach_scalars(out, field_quantiles(df, ["dep_delay"], (0.5,)).agg(F.max("q0").alias("median_delay")))
