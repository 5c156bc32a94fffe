"""Block + halo rolling mean equals the plain window and pandas."""

import pandas as pd
from pyspark.sql import functions as F

from contrail.operators.rolling import global_row_number, rolling_mean, rolling_mean_plain
from contrail.plans.views import hot_events
from tests.conftest import SF_SMALL


def _events(spark):
    return hot_events(spark, SF_SMALL).select("timestamp", "flight_id", "airline_code", "dep_delay")


def test_global_row_number_is_dense_and_ordered(spark):
    g = global_row_number(_events(spark), ["timestamp", "flight_id"], partitions=5)
    rows = g.orderBy("__rn").collect()
    assert [r["__rn"] for r in rows] == list(range(len(rows)))
    keys = [(r.timestamp, r.flight_id) for r in rows]
    assert keys == sorted(keys)


def test_block_halo_equals_plain_window_and_pandas(spark):
    df = _events(spark)
    for n, block in ((10, 7), (3, 50), (1, 4)):
        a = rolling_mean(df, "dep_delay", n, block_rows=block, partitions=5).select("flight_id", F.col("rolling_avg").alias("a"))
        b = rolling_mean_plain(df, "dep_delay", n).select("flight_id", F.col("rolling_avg").alias("b"))
        bad = a.join(b, "flight_id").where(~F.col("a").eqNullSafe(F.col("b")) &
                                           (F.abs(F.col("a") - F.col("b")) > 1e-9))
        assert bad.count() == 0, (n, block)
        assert a.count() == df.count()
    pdf = df.toPandas().sort_values(["timestamp", "flight_id"])
    exp = pdf["dep_delay"].rolling(10, min_periods=1).mean()
    got = rolling_mean(df, "dep_delay", 10, block_rows=13).toPandas().sort_values(["timestamp", "flight_id"])
    assert ((got["rolling_avg"].values - exp.values) ** 2 < 1e-12).sum() == len(exp) - exp.isna().sum()


def test_block_halo_partitioned(spark):
    df = _events(spark)
    a = rolling_mean(df, "dep_delay", 5, partition_by="airline_code", block_rows=11, partitions=3) \
        .select("flight_id", F.col("rolling_avg").alias("a"))
    b = rolling_mean_plain(df, "dep_delay", 5, partition_by="airline_code").select("flight_id", F.col("rolling_avg").alias("b"))
    assert a.join(b, "flight_id").where(~F.col("a").eqNullSafe(F.col("b")) & (F.abs(F.col("a") - F.col("b")) > 1e-9)).count() == 0


def test_pandas_cross_checks(spark):
    """describe(), duplicated() and a grouped mean against pandas."""
    from contrail.operators import quality
    df = _events(spark)
    pdf = df.toPandas()
    d = {r.field: r for r in quality.describe_numeric(df, ["dep_delay"]).collect()}["dep_delay"]
    p = pdf["dep_delay"].describe()
    assert d["count"] == p["count"]
    for k, q in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
                 ("p75", "75%"), ("max", "max")):
        assert abs(d[k] - p[q]) < 1e-9, k
    keyed = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "flight_id string")
    assert quality.dup_stats(keyed).first().duplicates == int(pd.Series(["a", "a", None, None, "b"]).duplicated().sum())


def test_field_quantiles_equal_percentile(spark):
    """Quantiles from counts per value against Spark's own, with a value that
    most rows share and a column without values."""
    from contrail.operators import quality
    from contrail.plans.views import hot_history
    df = hot_history(spark, SF_SMALL).select("distance", "dep_delay", F.lit(None).cast("double").alias("none"),
                                             F.when(F.col("dep_delay") > 60, F.col("dep_delay")).otherwise(1.0).alias("flat"))
    got = {r.field: r for r in quality.field_quantiles(df, df.columns).collect()}
    assert set(got) == {"distance", "dep_delay", "flat"}
    for c, r in got.items():
        want = df.agg(F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
        assert all(abs(x - y) < 1e-9 for x, y in zip((r.q0, r.q1, r.q2), want)), c
    assert {r.field: r["count"] for r in quality.describe_numeric(df).collect()}["none"] == 0
