"""Analysis views over the supplied tables.

``hot_events`` is the hot table as the analytics see it: flight events with
the model-path prediction (predictor A) and missing values kept, so that
the pandas skip-missing semantics of every operator are exercised.
``hot_history`` is the same over the lineitem-derived history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators.clean import nan_to_null
from contrail.operators.predict import predict_a
from contrail.sources.tables import flight_events, flight_history

# Fixed analysis instant of the events fixture (data ends 2024-01-30).
AS_OF = "2024-01-31 00:00:00"
# Fixed instant for "today" KPIs: inside the last day of the fixture.
AS_OF_DAY = "2024-01-30 20:00:00"
# Fixed processing instant for reproducible cleaning.
PROCESSING_TIME = "2024-01-31 00:00:00"


def hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_a(nan_to_null(flight_events(spark, sf_dir), ["dep_delay", "arr_delay", "distance"]))


def hot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_a(flight_history(spark, sf_dir))


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparison form: doubles rounded, timestamps as text with micros."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
