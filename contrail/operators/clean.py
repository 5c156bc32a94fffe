"""Staging: quality score, imputation, processing time, flight id.

Everything here is a narrow projection, so a stream or a table is cleaned
without a shuffle and the whole chain fuses into one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.columns import dbl, flight_id_expr

DELAY_COLUMNS = ("dep_delay", "arr_delay", "distance")


def _missing(c: str, nan_is_missing: bool) -> Column:
    m = F.col(c).isNull()
    return (m | F.isnan(c)) if nan_is_missing else m


def quality_score(nan_is_missing: bool = False) -> Column:
    """1.0 when both delays and a positive distance are present, else 0.5.

    As in the reference a NaN counts as present (and NaN > 0 is true in
    Spark); ``nan_is_missing=True`` scores it 0.5 instead."""
    ok = ~_missing("dep_delay", nan_is_missing) & ~_missing("arr_delay", nan_is_missing) \
        & ~_missing("distance", nan_is_missing) & (F.col("distance") > 0)
    return F.when(ok, dbl(1)).otherwise(dbl(0.5))


def nan_to_null(df: DataFrame, cols=None) -> DataFrame:
    """NaN -> NULL in the given double columns, so that every aggregate
    downstream skips it like pandas does (Spark's avg would return NaN)."""
    cols = list(cols) if cols is not None else [
        f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols})


def clean_events(df: DataFrame, *, processing_time=None, derive_id: bool = True,
                 impute: bool = True, nan_is_missing: bool = False) -> DataFrame:
    """Clean typed flight events.

    * ``processing_time``: a literal instant for reproducible runs; default
      ``current_timestamp()`` (one value per query/micro-batch).
    * ``derive_id``: build the id from time, airline and route (the
      reference's rule); otherwise keep the incoming ``flight_id``.
    * ``impute``: NULL delays -> 0.0, NULL or non-positive distance -> 0.0.
    """
    pt = F.current_timestamp() if processing_time is None else F.lit(processing_time).cast("timestamp")
    out = df.withColumns({
        "processing_timestamp": pt,
        "data_quality_score": quality_score(nan_is_missing),
    })
    if impute:
        out = out.withColumns({
            "dep_delay": F.coalesce(F.col("dep_delay"), dbl(0)),
            "arr_delay": F.coalesce(F.col("arr_delay"), dbl(0)),
            "distance": F.when(F.col("distance").isNull() | (F.col("distance") <= 0), dbl(0))
            .otherwise(F.col("distance")),
        })
    out = out.withColumn("processing_date", F.to_date("processing_timestamp"))
    if derive_id:
        out = out.withColumn("flight_id", flight_id_expr("timestamp", "airline_code", "origin", "dest"))
    return nan_to_null(out, [c for c in DELAY_COLUMNS if c in out.columns])


def enriched_projection(df: DataFrame, *, ingestion_time=None, keep_extra: bool = True) -> DataFrame:
    """Final hot-table projection (P10).  One ingestion instant per
    query/batch.  ``keep_extra`` keeps the schedule, calendar and cause
    columns the analytics use (the reference drops them)."""
    it = F.current_timestamp() if ingestion_time is None else F.lit(ingestion_time).cast("timestamp")
    base = ["flight_id", "timestamp", "airline_code", "origin", "dest", "dep_delay",
            "arr_delay", "distance", "predicted_delay", "prediction_confidence",
            "data_quality_score"]
    extra = [c for c in ("crs_dep_time", "month", "day_of_week", "delay_due_weather",
                         "delay_due_carrier", "delay_due_nas", "delay_due_late_aircraft")
             if keep_extra and c in df.columns] + [c for c in ("model_version",) if c in df.columns]
    letters = [c for c in ("_raw", "_error", "_position") if c in df.columns]  # of messages without an id
    return df.select(*base, it.alias("ingestion_timestamp"), "processing_timestamp",
                     "processing_date", *extra, *letters)
