"""Live windows with late rows, the model registry, stored sketches, one-scan plans."""

import os

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from contrail.operators import insight, ml, quality, registry, sketches, trend
from contrail.operators.kpi import quick_stats
from contrail.plans.views import hot_events
from contrail.sources import manifest
from contrail.streaming import windows
from tests.conftest import SF_SMALL

ROW = "timestamp timestamp_ntz, airline_code string, dep_delay double, flight_id string"


def _rows(spark, rows):
    return spark.createDataFrame([(t, a, d, i) for t, a, d, i in rows], "t string, airline_code string, dep_delay double, flight_id string").select(
        F.col("t").cast("timestamp_ntz").alias("timestamp"), "airline_code", "dep_delay", "flight_id")


def _windows(spark, root):
    return {(str(r.window_start), r.airline_code): (r.avg_delay, r.flight_count, r.events, r.late) for r in windows.windows(spark, root).collect()}


def test_late_rows_count_and_batches_count_once(spark, tmp_path):
    root = str(tmp_path / "w")
    batches = [[("2024-01-01 10:00:00", "A", 10.0, "1"), ("2024-01-01 12:00:00", "A", 20.0, "2")],
               [("2024-01-01 10:05:00", "A", 30.0, "3"), ("2024-01-01 11:55:00", "A", None, "4"), ("2024-01-01 11:49:59", "B", 5.0, None), (None, "A", 1.0, "x")],
               [("2024-01-01 10:10:00", None, 1.0, "5")]]
    for i, rows in enumerate(batches):
        for _ in range(2):  # a batch that is run again adds nothing
            windows.add_batch(spark, root, _rows(spark, rows), i, "run", "15 minutes", None, "10 minutes")
    assert _windows(spark, root) == {("2024-01-01 10:00:00", "A"): (20.0, 2, 2, 1), ("2024-01-01 12:00:00", "A"): (20.0, 1, 1, 0),
                                     ("2024-01-01 11:45:00", "A"): (None, 1, 1, 0), ("2024-01-01 11:45:00", "B"): (5.0, 0, 1, 1)}
    late = {(r.flight_id, r.batch_id, str(r.watermark)) for r in windows.late_rows(spark, root).collect()}
    assert late == {("3", 1, "2024-01-01 11:50:00"), (None, 1, "2024-01-01 11:50:00"), ("5", 2, "2024-01-01 11:50:00")}
    assert manifest.snapshot(spark, root).runs["run"]["late"] == 3
    with pytest.raises(RuntimeError, match="another checkpoint"):
        windows.add_batch(spark, root, _rows(spark, batches[0]), 0, "other", "15 minutes", None, "10 minutes")


def test_folding_keeps_the_windows(spark, tmp_path):
    root = str(tmp_path / "w")
    for i in range(windows.MOST_PARTS + 3):
        windows.add_batch(spark, root, _rows(spark, [("2024-01-01 10:00:00", "A", float(i), str(i))]), i, "run", "15 minutes", None, "10 minutes")
        assert len(manifest.snapshot(spark, root).of(windows.WINDOWS)) <= windows.MOST_PARTS
    n = windows.MOST_PARTS + 3
    assert _windows(spark, root) == {("2024-01-01 10:00:00", "A"): (sum(range(n)) / n, n, n, 0)}


def _model(spark, minutes):
    """A 'model' that predicts a constant."""
    return Pipeline(stages=[SQLTransformer(statement=f"SELECT *, {float(minutes)} AS prediction FROM __THIS__")]).fit(spark.range(1))


def test_versions_of_models(spark, tmp_path):
    root = str(tmp_path / "models")
    metrics = spark.createDataFrame([(1.0,)], "mae double")
    rows = spark.createDataFrame([(1.0, 500.0)], "dep_delay double, distance double")
    serving = registry.Serving(spark, root)
    score = lambda: tuple(serving(rows).select("predicted_delay", "model_version").first())
    assert registry.current(spark, root) is None and score() == (2.9, "v1.0")
    one = registry.publish(spark, root, _model(spark, 11), metrics, "arr_delay")
    assert score() == (11.0, one) and len(one) == 16
    two = registry.publish(spark, root, _model(spark, 22), metrics, "arr_delay")
    assert one != two and score() == (22.0, two)
    registry.serve(spark, root, one)  # back to the older one
    assert score() == (11.0, one) and {one, two} <= set(os.listdir(root))
    with pytest.raises(FileNotFoundError):
        registry.serve(spark, root, "none")
    some = next(os.path.join(d, f) for d, _, fs in os.walk(f"{root}/{two}/model") for f in fs if f.startswith("part-"))
    with open(some, "a") as f:
        f.write(" ")
    crc = os.path.join(os.path.dirname(some), f".{os.path.basename(some)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    registry.serve(spark, root, two)
    with pytest.raises(ValueError, match="have changed"):
        score()


def test_missing_numbers_take_the_exact_median(spark):
    rows = [(f"f{i}", "A", "B", "C", 1, 1, i, 100.0, float(i), float(i)) for i in range(1, 11)] + [("n", None, "B", "C", 1, 1, None, float("nan"), None, 3.0)]
    df = spark.createDataFrame(rows, "flight_id string, airline_code string, origin string, dest string, month int, day_of_week int, crs_dep_time int, distance double, dep_delay double, arr_delay double")
    got = {(r.field, r.fitted): r.number for r in ml.fitted_features(spark, df).collect() if r.fitted in ("median", "mean")}
    assert got["crs_dep_time", "median"] == 5.5 and got["distance", "median"] == 100.0
    assert abs(got["crs_dep_time", "mean"] - 5.5) < 1e-9 and abs(got["dep_delay", "mean"] - 5.5) < 1e-9


def test_sketches_merge_within_their_bounds(spark):
    df = spark.range(200000).select(F.concat(F.lit("f"), F.col("id") % 60000).alias("flight_id"), F.lit("A").alias("airline_code"), F.lit("o").alias("origin"), F.lit("d").alias("dest"),
                                    (F.pmod(F.xxhash64("id"), F.lit(100000)) / 100.0).alias("dep_delay"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("timestamp"))
    days = sketches.by_day(df).cache()
    r = sketches.answers(sketches.merged(sketches.merged(days, (F.dayofmonth("day") % 3).alias("k"))), (0.1, 0.5, 0.9)).first()
    assert r.rows == 200000 and abs(r.distinct_flight_id / 60000 - 1) < sketches.DISTINCT_BOUND and r.distinct_origin == 1
    values = sorted(x.dep_delay for x in df.select("dep_delay").collect())
    import bisect
    for p, q in ((0.1, r.q10), (0.5, r.q50), (0.9, r.q90)):
        assert bisect.bisect_left(values, q) / len(values) <= p + sketches.RANK_BOUND and bisect.bisect_right(values, q) / len(values) >= p - sketches.RANK_BOUND
    empty = sketches.answers(sketches.merged(sketches.by_day(df.where("id < 0" if "id" in df.columns else "flight_id = 'none'")))).first()
    assert empty.rows is None and empty.q50 is None


def _scans(df):
    """Times that the plan reads the events (a reused exchange reads nothing)."""
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan parquet")


@pytest.mark.parametrize("make", [lambda d: quality.quality_score(d.select("flight_id", "timestamp", "dep_delay"), "2024-01-31 00:00:00"), lambda d: insight.ols_over_time(d)])
def test_one_scan(spark, make):
    assert _scans(make(hot_events(spark, SF_SMALL))) == 1


def test_histogram_reads_its_rows_once(spark):
    df = insight.histogram(hot_events(spark, SF_SMALL), "dep_delay", 10)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    final = final[:final.index("Initial Plan")] if "Initial Plan" in final else final
    assert "ReusedExchange" in final and final.count("FileScan parquet") == 1


def test_presets_and_fields(spark):
    hot = hot_events(spark, SF_SMALL)
    counts = [trend.in_range(hot, "2024-01-30 20:00:00", p).count() for p in ("1h", "6h", "24h", "all")]
    assert counts == sorted(counts) and counts[-1] == hot.count()
    assert trend.has_field(hot, "gate").count() == 0 and trend.has_field(hot, "dep_delay").count() == hot.count() > trend.has_field(hot, "dep_delay", not_null=True).count()
    assert quick_stats(hot.where("dep_delay is null")).first().median_delay is None
