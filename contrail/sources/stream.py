"""Stream sources.

``open_stream`` returns a streaming DataFrame with one text column
``value``, ``kafka_timestamp`` (the broker's time, or when a file was last
changed) and ``source_position`` (topic, partition and offset, or the file).
Both are the same whenever the source is read again.  Kafka is a configuration of the same function; the Kafka connector
jar is not bundled, so locally the file sources are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.columns import parse_event_time
from contrail.schema import RAW_EVENT


def open_stream(spark: SparkSession, fmt: str = "kafka", *, path: str | None = None,
                topic: str | None = None, servers: str | None = None,
                max_per_trigger: int | None = None, schema: T.StructType | None = None,
                options: dict[str, str] | None = None) -> DataFrame:
    """Open the event stream.

    * ``kafka``: subscribe ``topic`` from the earliest offset,
      ``maxOffsetsPerTrigger = max_per_trigger``, ``minPartitions`` = the
      cluster's parallelism.
    * ``text`` / ``json``: one JSON document per line under ``path``,
      ``maxFilesPerTrigger = max_per_trigger``.
    * ``parquet``: a table of events under ``path`` (``schema`` required).

    Without ``max_per_trigger`` a trigger takes all there is.
    """
    opts = dict(options or {})
    r = spark.readStream
    if fmt == "kafka":
        r = (r.format("kafka").option("kafka.bootstrap.servers", servers or "localhost:9092")
             .option("subscribe", topic or "flight_events").option("startingOffsets", "earliest"))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        # Split each trigger's offset ranges over the cluster's cores (no
        # shuffle), so JSON decoding of a few hot topic partitions is
        # parallel.
        r = r.option("minPartitions", str(spark.sparkContext.defaultParallelism))
        df = r.options(**opts).load()
        return df.select(F.col("value").cast("string").alias("value"),
                         F.col("timestamp").alias("kafka_timestamp"),
                         F.concat_ws(":", "topic", "partition", "offset").alias("source_position"))
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    if fmt in ("text", "json"):
        df = r.options(**opts).text(path)
        return df.select("value", F.col("_metadata.file_modification_time").alias("kafka_timestamp"),
                         F.col("_metadata.file_path").alias("source_position"))
    if fmt == "parquet":
        return r.schema(schema).options(**opts).parquet(path)
    raise ValueError(f"unknown stream format {fmt!r}")


#: What a message that gets no id leaves behind.
LETTER_COLUMNS = ("_raw", "_error", "_position")

_DECODE_SCHEMA = T.StructType(RAW_EVENT.fields + [T.StructField("_corrupt_record", T.StringType())])


def decode_events(df: DataFrame, value: str = "value", fallback_time=None) -> DataFrame:
    """S2 + P1: JSON text -> typed flight events (lower-case names).

    PERMISSIVE parsing: a malformed document yields NULL fields and keeps
    its text in ``_corrupt_record``.  ``NaN`` literals are accepted.  A message
    that can get no id keeps its text (``_raw``), the kind of fault (``_error``:
    empty, malformed, bad_time, missing_field) and its ``source_position`` (``_position``).
    Month, DayOfWeek and CRS_DEP_TIME are read as DOUBLE and cast, so
    ``5.0`` is not lost."""
    data = F.from_json(F.col(value), _DECODE_SCHEMA,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record",
                        "allowNonNumericNumbers": "true"})
    keep = [c for c in df.columns if c not in (value, "source_position")]
    position = F.col("source_position") if "source_position" in df.columns else F.lit(None).cast("string")
    p = df.select(data.alias("d"), F.col(value).alias("_raw"), position.alias("_position"), *keep)
    ts = parse_event_time(F.col("d.timestamp"), fallback_time)
    fields = F.col("d.AIRLINE_CODE").isNull() | F.col("d.ORIGIN").isNull() | F.col("d.DEST").isNull()
    fault = (F.when(F.coalesce(F.trim("_raw"), F.lit("")) == "", "empty").when(F.col("d._corrupt_record").isNotNull() & (fields | ts.isNull()), "malformed")
             .when(ts.isNull(), "bad_time").when(fields, "missing_field"))
    return p.select(
        F.lit(None).cast("string").alias("flight_id"),
        ts.cast("timestamp_ntz").alias("timestamp"),
        F.col("d.AIRLINE_CODE").alias("airline_code"),
        F.col("d.ORIGIN").alias("origin"),
        F.col("d.DEST").alias("dest"),
        F.col("d.CRS_DEP_TIME").try_cast("int").alias("crs_dep_time"),
        F.col("d.DEP_DELAY").alias("dep_delay"),
        F.col("d.ARR_DELAY").alias("arr_delay"),
        F.col("d.DISTANCE").alias("distance"),
        F.col("d.DELAY_DUE_WEATHER").alias("delay_due_weather"),
        F.col("d.DELAY_DUE_CARRIER").alias("delay_due_carrier"),
        F.col("d.DELAY_DUE_NAS").alias("delay_due_nas"),
        F.col("d.DELAY_DUE_LATE_AIRCRAFT").alias("delay_due_late_aircraft"),
        F.col("d.Month").try_cast("int").alias("month"),
        F.col("d.DayOfWeek").try_cast("int").alias("day_of_week"),
        F.col("d._corrupt_record").alias("_corrupt_record"),
        F.when(fault.isNotNull(), F.coalesce("_raw", F.lit(""))).alias("_raw"), fault.alias("_error"), F.when(fault.isNotNull(), F.col("_position")).alias("_position"),
        *keep,
    )


def encode_events(flights: DataFrame) -> DataFrame:
    """Inverse of ``decode_events`` (wire JSON, upper-case keys, ISO time
    with microseconds): used to replay a table as a message stream."""
    s = F.struct(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("airline_code").alias("AIRLINE_CODE"), F.col("origin").alias("ORIGIN"),
        F.col("dest").alias("DEST"), F.col("dep_delay").alias("DEP_DELAY"),
        F.col("arr_delay").alias("ARR_DELAY"), F.col("distance").alias("DISTANCE"),
        F.col("delay_due_weather").alias("DELAY_DUE_WEATHER"),
        F.col("delay_due_carrier").alias("DELAY_DUE_CARRIER"),
        F.col("delay_due_nas").alias("DELAY_DUE_NAS"),
        F.col("delay_due_late_aircraft").alias("DELAY_DUE_LATE_AIRCRAFT"),
        F.col("month").alias("Month"), F.col("day_of_week").alias("DayOfWeek"),
        F.col("crs_dep_time").alias("CRS_DEP_TIME"))
    return flights.select(F.to_json(s, {"ignoreNullFields": "false"}).alias("value"))

