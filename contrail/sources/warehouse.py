"""Warehouse and metadata tables in the Spark catalog.

The stores written by the ingest and retention jobs are exposed as
external Parquet tables (``CREATE TABLE IF NOT EXISTS ... USING PARQUET
PARTITIONED BY ... LOCATION``).  Their partitions are the live folders of the
manifest: ``create_warehouse`` adds those that are new and drops those that have
ended.  Metadata tables pick up new folders with ``ALTER TABLE ... RECOVER PARTITIONS``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.sources import manifest
from contrail.streaming.ingest import Stores, _exists

# Column lists of the tables (partition columns last, declared once).
DDL = {
    "staging_flight_events": (
        "flight_id STRING, timestamp TIMESTAMP_NTZ, airline_code STRING, origin STRING, dest STRING, "
        "dep_delay DOUBLE, arr_delay DOUBLE, distance DOUBLE, predicted_delay DOUBLE, "
        "prediction_confidence DOUBLE, data_quality_score DOUBLE, ingestion_timestamp TIMESTAMP, "
        "processing_timestamp TIMESTAMP, crs_dep_time INT, month INT, day_of_week INT, "
        "delay_due_weather DOUBLE, delay_due_carrier DOUBLE, delay_due_nas DOUBLE, "
        "delay_due_late_aircraft DOUBLE, event_date DATE, batch_key STRING, model_version STRING, processing_date DATE, part STRING",
        "processing_date, part"),
    "fact_flight_events": (
        "flight_id STRING, timestamp TIMESTAMP_NTZ, airline_code STRING, origin STRING, dest STRING, "
        "dep_delay DOUBLE, arr_delay DOUBLE, distance DOUBLE, predicted_delay DOUBLE, "
        "prediction_accuracy DOUBLE, processing_timestamp TIMESTAMP, batch_key STRING, processing_date DATE, part STRING",
        "processing_date, part"),
    "predictions": (
        "prediction_id STRING, flight_id STRING, timestamp TIMESTAMP_NTZ, predicted_delay DOUBLE, "
        "actual_delay DOUBLE, prediction_accuracy DOUBLE, model_version STRING, "
        "processing_timestamp TIMESTAMP, batch_key STRING, prediction_date DATE, part STRING",
        "prediction_date, part"),
}


# Fact and prediction rows as views over staging (same columns as
# operators.predict.fact_projection / prediction_projection).
VIEWS = {
    "fact_flight_events": """SELECT flight_id, timestamp, airline_code, origin, dest, dep_delay, arr_delay, distance,
       predicted_delay, abs(predicted_delay - dep_delay) AS prediction_accuracy, processing_timestamp,
       processing_date, batch_key, part FROM {db}.staging_flight_events""",
    "predictions": """SELECT concat(flight_id, '_pred') AS prediction_id, flight_id, timestamp, predicted_delay,
       dep_delay AS actual_delay, abs(predicted_delay - dep_delay) AS prediction_accuracy,
       coalesce(model_version, 'v1.0') AS model_version, processing_timestamp, processing_date AS prediction_date, batch_key, part
       FROM {db}.staging_flight_events""",
}


def create_warehouse(spark: SparkSession, stores: Stores, database: str = "flight_dw") -> list[str]:
    """K5: create the database and the tables if absent; returns the table
    names.  Idempotent.  Fact and prediction tables are views over staging
    unless the ingest materialised them (``materialize_projections``)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    made = []
    snap = manifest.snapshot(spark, stores.root)
    for name, (cols, parts) in DDL.items():
        loc = stores.warehouse(name)
        if name in VIEWS and not snap.of(f"warehouse/{name}"):
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS " + VIEWS[name].format(db=database))
            made.append(f"{database}.{name}")
            continue
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING PARQUET "
                  f"PARTITIONED BY ({parts}) LOCATION '{loc}'")
        _sync_partitions(spark, stores, snap, name, f"{database}.{name}", parts.split(", ")[0])
        made.append(f"{database}.{name}")
    return made


def _sync_partitions(spark: SparkSession, stores: Stores, snap: manifest.Snapshot, name: str, table: str, day_column: str) -> None:
    """Make the table's partitions the live folders of the store."""
    live = {(e.day, e.path.split("/part=")[1].split("/")[0]): e.path for e in snap.of(f"warehouse/{name}")}
    known = set()
    for (spec,) in spark.sql(f"SHOW PARTITIONS {table}").collect():  # names of folders
        values = dict(x.split("=", 1) for x in spec.split("/"))
        known.add((values[day_column], values["part"]))
    todo = [("ADD IF NOT EXISTS", k, f" LOCATION '{stores.path(path)}'") for k, path in sorted(live.items()) if k not in known]
    todo += [("DROP IF EXISTS", k, "") for k in sorted(known - set(live))]
    for verb in ("ADD IF NOT EXISTS", "DROP IF EXISTS"):
        specs = [(k, where) for v, k, where in todo if v == verb]
        for at in range(0, len(specs), 500):
            some = [f"PARTITION ({day_column}=DATE'{d}', part='{part}'){where}" for (d, part), where in specs[at:at + 500]]
            spark.sql(f"ALTER TABLE {table} {verb} " + (" " if verb.startswith("ADD") else ", ").join(some))
    spark.sql(f"REFRESH TABLE {table}")


def create_metadata(spark: SparkSession, stores: Stores, database: str = "flight_dw",
                    schema_version: str = "1") -> list[str]:
    """K5 (metadata): ``batch_metadata`` and ``archive_metadata`` over the
    folders the jobs write (one partition per batch / archive), and
    ``schema_metadata``: one active row per warehouse table with its schema
    as JSON, rewritten idempotently."""
    import datetime as dt
    import json
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    made = []
    for name, key in (("batch_metadata", "batch_key"), ("archive_metadata", "archive_id")):
        loc = stores.meta(name)
        if _exists(spark, loc):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} USING PARQUET LOCATION '{loc}'")
            spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")
            made.append(f"{database}.{name}")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = []
    for name, (cols, parts) in DDL.items():
        fields = [{"name": c.strip().split(" ")[0], "type": c.strip().split(" ", 1)[1]} for c in cols.split(",")]
        rows.append((f"{name}_v{schema_version}", schema_version, name, json.dumps(fields), now, True))
    loc = stores.meta("schema_metadata")
    (spark.createDataFrame(rows, "schema_id string, schema_version string, table_name string, "
                                 "schema_definition string, created_timestamp timestamp_ntz, is_active boolean")
     .write.mode("overwrite").parquet(loc))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.schema_metadata USING PARQUET LOCATION '{loc}'")
    spark.sql(f"REFRESH TABLE {database}.schema_metadata")
    made.append(f"{database}.schema_metadata")
    return made


def catalog_stats(spark: SparkSession, database: str = "flight_dw") -> DataFrame:
    """Per table of the database: files, bytes, rows and newest file
    time (file sizes counted once each; rows from a plain count, which
    Parquet answers from footers)."""
    parts = []
    for t in spark.catalog.listTables(database):  # table names only: bounded
        if t.tableType == "VIEW":  # no files of its own
            continue
        df = spark.table(f"{database}.{t.name}")
        parts.append(df.select(F.lit(t.name).alias("table_name"), "_metadata.file_path",
                               "_metadata.file_size", "_metadata.file_modification_time"))
    if not parts:
        return spark.createDataFrame([], "table_name string, files long, total_bytes long, "
                                         "total_rows long, newest_file timestamp")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    rows = u.groupBy("table_name").agg(F.count(F.lit(1)).alias("total_rows"))
    files = (u.select("table_name", "file_path", "file_size", "file_modification_time").distinct()
             .groupBy("table_name").agg(F.count(F.lit(1)).alias("files"),
                                        F.sum("file_size").alias("total_bytes"),
                                        F.max("file_modification_time").alias("newest_file")))
    return files.join(rows, "table_name")
