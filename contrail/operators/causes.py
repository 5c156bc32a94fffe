"""Delay-cause attribution (A27): minutes and share per cause and airline.

The four cause columns are unpivoted and summed per (airline, cause) with a
partial aggregate; the share is a window over that aggregate, which is
bounded by airlines x 4 rows, never over the raw events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.columns import pct
from contrail.schema import CAUSE_COLUMNS

# Cause names in column order.
CAUSE_NAMES = ["weather", "carrier", "nas", "late_aircraft"]


def cause_shares(df: DataFrame, key: str = "airline_code") -> DataFrame:
    long = (df.where(F.col(key).isNotNull())
            .select(key, F.stack(F.lit(len(CAUSE_COLUMNS)),
                                 *[x for n, c in zip(CAUSE_NAMES, CAUSE_COLUMNS) for x in (F.lit(n), F.col(c))])
                    .alias("cause", "minutes")))
    agg = long.groupBy(key, "cause").agg(F.coalesce(F.sum("minutes"), F.lit(0.0)).alias("cause_minutes"))
    total = F.sum("cause_minutes").over(Window.partitionBy(key))
    return agg.withColumn("share_pct", pct(F.col("cause_minutes"), total))
