"""Schemas of the flight event at each stage of its life."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire format of one event (JSON object per message).  Month, DayOfWeek and
# CRS_DEP_TIME are read as DOUBLE and cast afterwards: ``from_json`` turns a
# float-typed ``5.0`` into NULL when the field is declared INT.
RAW_EVENT = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("AIRLINE_CODE", T.StringType()),
    T.StructField("ORIGIN", T.StringType()),
    T.StructField("DEST", T.StringType()),
    T.StructField("DEP_DELAY", T.DoubleType()),
    T.StructField("ARR_DELAY", T.DoubleType()),
    T.StructField("DISTANCE", T.DoubleType()),
    T.StructField("DELAY_DUE_WEATHER", T.DoubleType()),
    T.StructField("DELAY_DUE_CARRIER", T.DoubleType()),
    T.StructField("DELAY_DUE_NAS", T.DoubleType()),
    T.StructField("DELAY_DUE_LATE_AIRCRAFT", T.DoubleType()),
    T.StructField("Month", T.DoubleType()),
    T.StructField("DayOfWeek", T.DoubleType()),
    T.StructField("CRS_DEP_TIME", T.DoubleType()),
])

CAUSE_COLUMNS = ["delay_due_weather", "delay_due_carrier", "delay_due_nas",
                 "delay_due_late_aircraft"]

# Columns kept by the per-batch cold archive.
ARCHIVE_COLUMNS = [
    "flight_id", "timestamp", "airline_code", "origin", "dest", "dep_delay",
    "arr_delay", "distance", "processing_timestamp",
]
