"""Stored sketches of a day (A7, A8, A19): distinct counts and quantiles that
merge, so a month is read from its days and no row is scanned again.

* distinct values: HyperLogLog with 2**14 registers, relative standard error
  0.81 %; ``DISTINCT_BOUND`` is three of them;
* quantiles: KLL with k = 800; the rank of an answer is off by less than
  ``RANK_BOUND`` of the rows with 99 % confidence (merging keeps the bound).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_REGISTERS = 14
DISTINCT_BOUND = 0.025
KLL_K = 800
RANK_BOUND = 0.0045

DISTINCT = ("flight_id", "airline_code", "origin", "dest")


def by_day(df: DataFrame, value: str = "dep_delay", distinct=DISTINCT, ts_col: str = "timestamp") -> DataFrame:
    """One row per day: rows, rows with a value, its sum and extremes, sketches."""
    x = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    return df.groupBy(F.to_date(ts_col).alias("day")).agg(
        F.count("*").alias("n"), F.count(x).alias("n_value"), F.coalesce(F.sum(x), F.lit(0.0)).alias("sum_value"), F.min(x).alias("min_value"), F.max(x).alias("max_value"),
        F.count_if(x > 60).alias("n_severe"), F.kll_sketch_agg_double(x, KLL_K).alias("quantiles"),
        *[F.hll_sketch_agg(c, LG_REGISTERS).alias(f"d_{c}") for c in distinct])


def merged(days: DataFrame, *keys: Column | str) -> DataFrame:
    """Sketches of longer periods; the result merges again."""
    distinct = [c for c in days.columns if c.startswith("d_")]
    return days.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("n", "n_value", "sum_value", "n_severe")], F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.kll_merge_agg_double("quantiles", KLL_K).alias("quantiles"), *[F.hll_union_agg(c).alias(c) for c in distinct])


def answers(sketched: DataFrame, probs=(0.5,)) -> DataFrame:
    """The figures that the sketches give: counts, mean, severe share, distinct
    values, quantiles (``q50`` for 0.5)."""
    held = ("n", "n_value", "sum_value", "n_severe", "min_value", "max_value", "quantiles")
    distinct = [c for c in sketched.columns if c.startswith("d_")]
    keys = [c for c in sketched.columns if c not in held and c not in distinct]
    quantile = lambda p: F.when(F.col("n_value") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p))))
    return sketched.select(
        *keys, F.col("n").alias("rows"), "min_value", "max_value", F.try_divide("sum_value", "n_value").alias("mean"), F.try_divide(F.col("n_severe") * 100.0, F.col("n")).alias("severe_pct"),
        *[F.hll_sketch_estimate(c).alias(f"distinct_{c[2:]}") for c in distinct], *[quantile(p).alias(f"q{round(100 * p)}") for p in probs])
