"""Prediction insight and streaming-page analytics (A13-A15, A25, A26,
P20-P22, P27, W3, L1, L6-L8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.columns import (
    abs_error, anomaly_score, board_time, dbl, flight_number, flight_status,
    pct, relative_error, squared_error,
)
from contrail.operators.enrich import attach_scalars


def pred_metrics(df: DataFrame, tolerance: float = 10.0) -> DataFrame:
    """MAE, RMSE, MAPE (error / (|actual| + 1), in %) and the share of
    predictions within ``tolerance`` minutes over all rows."""
    e = abs_error()
    return df.agg(
        F.avg(e).alias("mae"),
        F.sqrt(F.avg(squared_error())).alias("rmse"),
        (F.avg(relative_error()) * dbl(100)).alias("mape"),
        pct(F.count_if(e <= tolerance), F.count(F.lit(1))).alias("accuracy_pct"),
        F.count(F.lit(1)).alias("predictions"),
    )


def daily_error(df: DataFrame) -> DataFrame:
    """Mean absolute error per day."""
    return (df.where(F.col("timestamp").isNotNull())
            .groupBy(F.to_date("timestamp").alias("date")).agg(F.avg(abs_error()).alias("avg_error")))


def anomalies(df: DataFrame, threshold: float = 1.0, top: int | None = 50) -> DataFrame:
    """P20 + P21: rows whose anomaly score |p - d| / (|p| + 1) exceeds the
    threshold, latest first (``top`` rows, ties by id)."""
    out = (df.select("timestamp", "flight_id", "airline_code", "origin", "dest", "predicted_delay",
                     "dep_delay", anomaly_score().alias("anomaly_score"))
           .where(F.col("anomaly_score") > threshold))
    if top is not None:
        out = out.orderBy(F.desc("timestamp"), F.asc("flight_id")).limit(top)
    return out


def anomaly_count(df: DataFrame, threshold: float = 1.0) -> DataFrame:
    return df.agg(F.count_if(anomaly_score() > threshold).alias("anomalies"),
                  F.count(F.lit(1)).alias("rows"))


def confidence_split(df: DataFrame, threshold: float = 0.7) -> DataFrame:
    """A15 + P22: high (>= threshold) vs low confidence: count and mean
    absolute error."""
    band = F.when(F.col("prediction_confidence") >= threshold, "high") \
        .when(F.col("prediction_confidence") < threshold, "low")
    return (df.select(band.alias("band"), abs_error().alias("err")).where(F.col("band").isNotNull())
            .groupBy("band").agg(F.count(F.lit(1)).alias("predictions"), F.avg("err").alias("avg_error")))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Exact equal-width histogram between the column's min and max.  The
    rows are read once, into counts per value; bounds and bins are both made
    from those."""
    x = F.col(col)
    counts = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    # the bounds use ``n`` too: both sides then need the same exchange, which is run once
    pair = F.struct("x", "n")
    bounds = counts.agg(F.min(pair)["x"].alias("lo"), F.max(pair)["x"].alias("hi"))
    width = (F.col("hi") - F.col("lo")) / dbl(bins)
    raw = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * dbl(bins))
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.least(raw.cast("int"), F.lit(bins - 1)))
    return (attach_scalars(counts, bounds).select(b.alias("bucket"), "lo", "hi", width.alias("w"), "n")
            .groupBy("bucket", "lo", "w").agg(F.sum("n").alias("frequency"))
            .select("bucket", (F.col("lo") + F.col("bucket") * F.col("w")).alias("bin_lo"),
                    (F.col("lo") + (F.col("bucket") + 1) * F.col("w")).alias("bin_hi"), "frequency"))


def ols(df: DataFrame, y: str, x) -> DataFrame:
    """Least-squares line y = a + b x with R^2 (regr_* aggregates)."""
    xc = F.col(x) if isinstance(x, str) else x
    return (df.select(F.col(y).alias("y"), xc.alias("x"))
            .agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
                 F.regr_r2("y", "x").alias("r2"), F.regr_count("y", "x").alias("n")))


#: A fixed instant that co-moments are summed around.
_ORIGIN = "2000-01-01 00:00:00"


def ols_over_time(df: DataFrame, y: str = "dep_delay") -> DataFrame:
    """A26 + P27: trend of ``y`` against hours elapsed since the first event, in one
    pass: the moments are taken around a fixed instant, and the line is moved to
    the first event afterwards (slope and R^2 do not depend on it)."""
    origin = F.lit(_ORIGIN).cast("timestamp_ntz")
    hours = lambda t: F.timestamp_diff("MICROSECOND", origin, t) / dbl(3.6e9)
    line = (df.select(F.col(y).alias("y"), hours(F.col("timestamp").cast("timestamp_ntz")).alias("x"), F.col("timestamp").cast("timestamp_ntz").alias("t"))
            .agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("at_origin"), F.regr_r2("y", "x").alias("r2"),
                 F.regr_count("y", "x").alias("n"), F.min("t").alias("t0")))
    return line.select("slope", (F.col("at_origin") + F.col("slope") * hours(F.col("t0"))).alias("intercept"), "r2", "n")


def latest(df: DataFrame, n: int, cols=None) -> DataFrame:
    """L1: the ``n`` latest rows (ties by id)."""
    out = df.orderBy(F.desc("timestamp"), F.asc("flight_id")).limit(n)
    return out.select(*cols) if cols else out


def latest_stats(df: DataFrame, n: int = 100, col: str = "dep_delay") -> DataFrame:
    """Mean, max and min of the ``n`` latest rows."""
    return latest(df, n).agg(F.avg(col).alias("window_avg"), F.max(col).alias("window_max"),
                             F.min(col).alias("window_min"))


def board(df: DataFrame, n: int = 20) -> DataFrame:
    """L8 + P13 + P15: latest flights with a known delay, formatted."""
    return (df.select("timestamp", "flight_id", board_time("timestamp").alias("time"),
                      flight_number("airline_code", "flight_id").alias("flight"), "origin", "dest",
                      flight_status("dep_delay").alias("status"), "dep_delay", "predicted_delay")
            .where(F.col("status") != "PENDING")
            .orderBy(F.desc("timestamp"), F.asc("flight_id")).limit(n)
            .drop("timestamp"))


def _seeded_md5(key: str, seed: int):
    """Hex MD5 of ``seed|key`` (a missing key counts as empty): a hash that any
    engine can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def sample(df: DataFrame, n: int = 500, seed: int = 42, key: str = "flight_id",
           require=("predicted_delay", "dep_delay")) -> DataFrame:
    """Repeatable sample of at most ``n`` complete rows: the ``n`` rows
    with the smallest seeded hash of the key (top-k, not a full sort)."""
    out = df.dropna(subset=list(require)) if require else df
    return out.orderBy(_seeded_md5(key, seed), F.asc(key)).limit(n)


def in_training(train_pct: int = 80, seed: int = 42, key: str = "flight_id"):
    """Whether a row belongs to the training part, by a hash of its key."""
    return F.conv(F.substring(_seeded_md5(key, seed), 1, 8), 16, 10).cast("long") % 100 < train_pct


def split(df: DataFrame, train_pct: int = 80, seed: int = 42, key: str = "flight_id"):
    """Hash split by key, stable under repartitioning and retries."""
    b = in_training(train_pct, seed, key)
    return df.where(b), df.where(~b)
