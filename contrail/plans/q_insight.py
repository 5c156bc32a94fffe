"""Prediction-insight and streaming-page queries (A13-A15, A25, A26,
P20-P22, W1-W3, L1, L8)."""

from pyspark.sql import functions as F

from contrail.operators import insight, rolling
from contrail.plans.oracle_views import ts_text, with_hot
from contrail.plans.registry import register
from contrail.plans.views import hot_events

_ERR = "abs(predicted_delay - dep_delay)"


@register("pred_metrics", with_hot(f"""
SELECT round(avg({_ERR}), 6) AS mae,
       round(sqrt(avg(pow(predicted_delay - dep_delay, 2))), 6) AS rmse,
       round(avg({_ERR} / (abs(dep_delay) + 1e0)) * 100e0, 6) AS mape,
       round(100e0 * count(*) FILTER (WHERE {_ERR} <= 10) / count(*), 6) AS accuracy_pct,
       count(*) AS predictions
FROM hot"""))
def pred_metrics(spark, sf):
    return insight.pred_metrics(hot_events(spark, sf))


@register("daily_error", with_hot(f"""
SELECT CAST("timestamp" AS DATE) AS date, round(avg({_ERR}), 6) AS avg_error
FROM hot WHERE "timestamp" IS NOT NULL GROUP BY 1"""))
def daily_error(spark, sf):
    return insight.daily_error(hot_events(spark, sf))


_SCORE = f"{_ERR} / (abs(predicted_delay) + 1e0)"


@register("anomalies", with_hot(f"""
SELECT {ts_text('"timestamp"')} AS "timestamp", flight_id, airline_code, origin, dest, predicted_delay, dep_delay,
       round({_SCORE}, 6) AS anomaly_score
FROM hot WHERE {_SCORE} > 1.0
ORDER BY "timestamp" DESC, flight_id LIMIT 50"""))
def anomalies(spark, sf):
    return insight.anomalies(hot_events(spark, sf), 1.0, 50)


@register("anomaly_count", with_hot(f"""
SELECT count(*) FILTER (WHERE {_SCORE} > 1.0) AS anomalies, count(*) AS "rows" FROM hot"""))
def anomaly_count(spark, sf):
    return insight.anomaly_count(hot_events(spark, sf), 1.0)


@register("confidence_split", with_hot(f"""
SELECT band, count(*) AS predictions, round(avg(err), 6) AS avg_error
FROM (SELECT CASE WHEN prediction_confidence >= 0.7 THEN 'high'
                  WHEN prediction_confidence < 0.7 THEN 'low' END AS band, {_ERR} AS err FROM hot) t
WHERE band IS NOT NULL GROUP BY band"""))
def confidence_split(spark, sf):
    return insight.confidence_split(hot_events(spark, sf), 0.7)


def _hist_sql(col: str, bins: int) -> str:
    return with_hot(f"""
, v AS (SELECT {col} AS x FROM hot WHERE {col} IS NOT NULL AND NOT isnan({col})),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
t AS (SELECT CASE WHEN hi = lo THEN 0
                  ELSE least(CAST(floor((x - lo) / (hi - lo) * {bins}e0) AS INTEGER), {bins - 1}) END AS bucket,
             lo, (hi - lo) / {bins}e0 AS w
      FROM v, b)
SELECT bucket, round(lo + bucket * w, 6) AS bin_lo, round(lo + (bucket + 1) * w, 6) AS bin_hi,
       count(*) AS frequency
FROM t GROUP BY bucket, lo, w""")


@register("hist_delay", _hist_sql("dep_delay", 30))
def hist_delay(spark, sf):
    return insight.histogram(hot_events(spark, sf), "dep_delay", 30)


@register("hist_predicted", _hist_sql("predicted_delay", 30))
def hist_predicted(spark, sf):
    return insight.histogram(hot_events(spark, sf), "predicted_delay", 30)


@register("hist_confidence", _hist_sql("prediction_confidence", 20))
def hist_confidence(spark, sf):
    return insight.histogram(hot_events(spark, sf), "prediction_confidence", 20)


@register("ols_time", with_hot("""
, t0 AS (SELECT min("timestamp") AS t0 FROM hot),
xy AS (SELECT dep_delay AS y, (epoch_us("timestamp") - epoch_us(t0)) / 3.6e9 AS x FROM hot, t0)
SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
       round(regr_r2(y, x), 6) AS r2, CAST(regr_count(y, x) AS BIGINT) AS n
FROM xy"""))
def ols_time(spark, sf):
    return insight.ols_over_time(hot_events(spark, sf), "dep_delay")


@register("ols_pred", with_hot("""
SELECT round(regr_slope(dep_delay, predicted_delay), 6) AS slope,
       round(regr_intercept(dep_delay, predicted_delay), 6) AS intercept,
       round(regr_r2(dep_delay, predicted_delay), 6) AS r2, CAST(regr_count(dep_delay, predicted_delay) AS BIGINT) AS n
FROM hot"""))
def ols_pred(spark, sf):
    return insight.ols(hot_events(spark, sf), "dep_delay", "predicted_delay")


_ROLL = """
SELECT {ts} AS "timestamp", flight_id, airline_code, dep_delay,
       round(avg(dep_delay) OVER ({part}ORDER BY "timestamp", flight_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6)
         AS rolling_avg
FROM hot"""


@register("rolling_mean", with_hot(_ROLL.format(ts=ts_text('"timestamp"'), part="")))
def rolling_mean(spark, sf):
    df = hot_events(spark, sf).select("timestamp", "flight_id", "airline_code", "dep_delay")
    return rolling.rolling_mean(df, "dep_delay", 10, block_rows=1000)


@register("rolling_by_airline", with_hot(_ROLL.format(ts=ts_text('"timestamp"'), part="PARTITION BY airline_code ")))
def rolling_by_airline(spark, sf):
    df = hot_events(spark, sf).select("timestamp", "flight_id", "airline_code", "dep_delay")
    return rolling.rolling_mean(df, "dep_delay", 10, partition_by="airline_code", block_rows=1000)


@register("latest_100_stats", with_hot("""
SELECT round(avg(dep_delay), 6) AS window_avg, max(dep_delay) AS window_max, min(dep_delay) AS window_min
FROM (SELECT dep_delay FROM hot ORDER BY "timestamp" DESC, flight_id LIMIT 100) t"""))
def latest_100_stats(spark, sf):
    return insight.latest_stats(hot_events(spark, sf), 100)


@register("latest_board", with_hot("""
SELECT strftime("timestamp", '%H:%M') AS time, flight_id, airline_code || ' ' || right(flight_id, 4) AS flight,
       origin, dest, status, dep_delay, predicted_delay
FROM (SELECT *, CASE WHEN dep_delay IS NULL OR isnan(dep_delay) THEN 'PENDING' WHEN dep_delay < 0 THEN 'EARLY'
                     WHEN dep_delay < 15 THEN 'ON TIME' WHEN dep_delay < 60 THEN 'DELAYED'
                     ELSE 'SEVERE' END AS status FROM hot) t
WHERE status <> 'PENDING'
ORDER BY "timestamp" DESC, flight_id LIMIT 20"""))
def latest_board(spark, sf):
    return insight.board(hot_events(spark, sf), 20)


@register("top_latest", with_hot(f"""
SELECT {ts_text('"timestamp"')} AS "timestamp", flight_id, airline_code, origin, dest, dep_delay, predicted_delay
FROM hot ORDER BY "timestamp" DESC, flight_id LIMIT 10"""))
def top_latest(spark, sf):
    return insight.latest(hot_events(spark, sf), 10, ["timestamp", "flight_id", "airline_code", "origin",
                                                      "dest", "dep_delay", "predicted_delay"])


@register("sample_500", with_hot("""
SELECT flight_id, predicted_delay, dep_delay FROM hot
WHERE predicted_delay IS NOT NULL AND dep_delay IS NOT NULL
ORDER BY md5('42|' || flight_id), flight_id LIMIT 500"""))
def sample_500(spark, sf):
    """Repeatable 500-row sample in the order of a seeded MD5."""
    return insight.sample(hot_events(spark, sf), 500, 42).select(
        "flight_id", "predicted_delay", "dep_delay")


@register("train_test_split", with_hot("""
SELECT CASE WHEN CAST('0x' || substr(md5('42|' || coalesce(flight_id, '')), 1, 8) AS BIGINT) % 100 < 80
            THEN 'train' ELSE 'test' END AS part, count(*) AS count
FROM hot GROUP BY 1"""))
def train_test_split(spark, sf):
    """Sizes of the hash split."""
    tr, te = insight.split(hot_events(spark, sf), 80, 42)
    return (tr.select(F.lit("train").alias("part")).unionByName(te.select(F.lit("test").alias("part")))
            .groupBy("part").count())
