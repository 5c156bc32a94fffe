"""Hand-made boundary rows for the scalar expressions."""

import math

import pandas as pd
from pyspark.sql import functions as F

from contrail.functions.columns import parse_event_time
from contrail.functions import columns as C
from contrail.operators.clean import clean_events, nan_to_null

BOUNDARY = [-0.01, 0.0, 14.99, 15.0, 15.01, 30.0, 59.99, 60.0, 60.01, None, float("nan")]


def _delays(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(BOUNDARY)], "i int, d double")


def test_delay_category_matches_pandas_cut(spark):
    got = {r.i: r.c for r in _delays(spark).select("i", C.delay_category("d").alias("c")).collect()}
    cut = pd.cut(pd.Series(BOUNDARY, dtype="float64"), bins=[-float("inf"), 0, 15, 30, 60, float("inf")],
                 labels=C.DELAY_CATEGORY_LABELS)
    for i, v in enumerate(cut):
        exp = None if pd.isna(v) else str(v)
        if BOUNDARY[i] is not None and math.isnan(BOUNDARY[i]):
            # Spark orders NaN above every number; nan_to_null runs first in
            # the pipeline, so the operator never sees NaN.
            continue
        assert got[i] == exp, (BOUNDARY[i], got[i], exp)


def test_flight_status_left_closed(spark):
    got = {r.i: r.s for r in _delays(spark).select("i", C.flight_status("d").alias("s")).collect()}
    exp = ["EARLY", "ON TIME", "ON TIME", "DELAYED", "DELAYED", "DELAYED", "DELAYED", "SEVERE", "SEVERE",
           "PENDING", "PENDING"]
    assert [got[i] for i in range(len(BOUNDARY))] == exp


def test_severity_band(spark):
    got = [r.s for r in _delays(spark).orderBy("i").select(C.severity_band("d").alias("s")).collect()]
    assert got[:9] == ["early", "on_time", "on_time", "on_time", "delayed", "delayed", "delayed", "delayed",
                       "severe"]
    assert got[9] == "missing"


def test_nan_to_null_makes_avg_skip_like_pandas(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert math.isnan(df.agg(F.avg("x")).first()[0])
    assert nan_to_null(df, ["x"]).agg(F.avg("x")).first()[0] == 2.0 == pd.Series([1.0, math.nan, 3.0, None]).mean()


def test_quality_score_nan_counts_as_present(spark):
    rows = [(1.0, 2.0, 100.0), (None, 2.0, 100.0), (1.0, 2.0, 0.0), (float("nan"), 2.0, 100.0),
            (1.0, 2.0, float("nan"))]
    df = spark.createDataFrame(rows, "dep_delay double, arr_delay double, distance double") \
        .withColumns({"timestamp": F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"),
                      "airline_code": F.lit("AA"), "origin": F.lit("X"), "dest": F.lit("Y")})
    out = [r.data_quality_score for r in clean_events(df, derive_id=False).collect()]
    assert out == [1.0, 0.5, 0.5, 1.0, 1.0]
    out2 = [r.data_quality_score for r in clean_events(df, derive_id=False, nan_is_missing=True).collect()]
    assert out2 == [1.0, 0.5, 0.5, 0.5, 0.5]
    cleaned = clean_events(df, derive_id=False).collect()
    assert cleaned[1].dep_delay == 0.0 and cleaned[2].distance == 0.0
    assert cleaned[3].dep_delay is None  # NaN passes imputation, then becomes NULL


def test_parse_event_time_variants(spark):
    df = spark.createDataFrame([("2025-12-17T09:23:27.796123",), ("2025-12-17T09:23:27",), ("garbage",), (None,)],
                               "s string")
    fb = F.lit("2030-01-01 00:00:00").cast("timestamp")
    out = [r.t for r in df.select(parse_event_time("s", fb).cast("timestamp_ntz").alias("t")).collect()]
    assert str(out[0]) == "2025-12-17 09:23:27.796000"
    assert str(out[1]) == "2025-12-17 09:23:27"
    assert out[2] is None
    assert str(out[3]) == "2030-01-01 00:00:00"


def test_flight_id_rule_and_null_part(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:07.800", "AA", "X", "Y"), ("2024-01-01 00:00:07", None, "X", "Y")],
                               "t string, a string, o string, d string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    out = [r.f for r in df.select(C.flight_id_expr("t", "a", "o", "d").alias("f")).collect()]
    assert out == ["202401010000078_AA_X_Y", None]  # trailing zero trimmed, NULL part -> NULL id


def test_coerce_int(spark):
    df = spark.createDataFrame([("12.7",), ("zz",), (None,), ("800",)], "x string")
    assert [r.v for r in df.select(C.coerce_int("x").alias("v")).collect()] == [12, 0, 0, 800]


def test_flight_number_and_route(spark):
    df = spark.createDataFrame([("AA", "F12"), ("BB", "F12345")], "a string, f string")
    assert [r.n for r in df.select(C.flight_number("a", "f").alias("n")).collect()] == ["AA F12", "BB 2345"]
    r = spark.createDataFrame([("X", "Y"), ("X", None)], "o string, d string") \
        .select(C.route_label("o", "d").alias("r")).collect()
    assert [x.r for x in r] == ["X → Y", None]


def test_event_time_accepts_zones_and_any_fraction(spark):
    rows = ["2025-12-17T09:23:27Z", "2025-12-17T10:23:27.1+01:00", "2025-12-17T09:23:27.123456789", "2025-12-17", "garbage", "2025-12-17T09:23:27"]
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    got = [r[0] for r in df.select(parse_event_time("s").cast("string")).collect()]
    assert got == ["2025-12-17 09:23:27", "2025-12-17 09:23:27.1", "2025-12-17 09:23:27.123", None, None, "2025-12-17 09:23:27"]
