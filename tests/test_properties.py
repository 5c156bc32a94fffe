"""Property checks against pandas on random frames."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contrail.functions import columns as C
from contrail.operators import quality
from contrail.operators.rolling import rolling_mean

delays = st.lists(st.one_of(st.none(), st.integers(-30, 200).map(float),
                            st.sampled_from([0.0, 15.0, 30.0, 60.0, 14.99, 60.01])), min_size=1, max_size=40)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(delays)
def test_category_counts_match_pandas(spark, ds):
    df = spark.createDataFrame([(float(d) if d is not None else None,) for d in ds], "dep_delay double")
    from contrail.operators.kpi import delay_categories
    got = {r.delay_category: r.flight_count for r in delay_categories(df).collect()}
    cut = pd.cut(pd.Series(ds, dtype="float64"), bins=[-math.inf, 0, 15, 30, 60, math.inf],
                 labels=C.DELAY_CATEGORY_LABELS).value_counts()
    assert got == {k: int(v) for k, v in cut.items() if v > 0}


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"])), min_size=1, max_size=30))
def test_duplicates_match_pandas(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "flight_id string")
    assert quality.dup_stats(df).first().duplicates == int(pd.Series(ids, dtype="object").duplicated().sum())


@SETTINGS
@given(delays, st.integers(1, 6), st.integers(1, 7))
def test_rolling_matches_pandas(spark, ds, n, block):
    rows = [(i, f"F{i:03d}", d) for i, d in enumerate(ds)]
    df = (spark.createDataFrame(rows, "i int, flight_id string, dep_delay double")
          .withColumn("timestamp", F.timestamp_seconds(F.col("i") * 60).cast("timestamp_ntz")))
    got = [r.rolling_avg for r in rolling_mean(df, "dep_delay", n, block_rows=block, partitions=3)
           .orderBy("i").collect()]
    exp = pd.Series(ds, dtype="float64").rolling(n, min_periods=1).mean().tolist()
    for g, e in zip(got, exp):
        assert (g is None and math.isnan(e)) or abs(g - e) < 1e-9
