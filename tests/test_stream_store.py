"""Stream = batch, idempotent retries and replays, retention invariants."""

from pyspark.sql import functions as F

from contrail.operators import retention
from contrail.plans.views import PROCESSING_TIME
from contrail.sources.stream import decode_events, encode_events
from contrail.sources.tables import flight_events
from contrail.streaming import ingest
from tests.conftest import SF_SMALL


def _batch(spark):
    msgs = encode_events(flight_events(spark, SF_SMALL))
    return ingest.prepare(decode_events(msgs), processing_time=PROCESSING_TIME)


def _snapshot(spark, stores, store="hot"):
    return sorted(tuple(r) for r in ingest.read_store(spark, stores, store)
                  .select("flight_id", "dep_delay", "predicted_delay").collect())


def test_fan_out_retry_and_replay_are_idempotent(spark, scratch):
    b = _batch(spark)
    n = b.count()
    ingest.fan_out(spark, scratch, b, 0)
    first = _snapshot(spark, scratch)
    assert len(first) == n
    ingest.fan_out(spark, scratch, b, 0)          # retried batch 0
    assert _snapshot(spark, scratch) == first
    replay = ingest.Stores(scratch.root, "replay")  # fresh checkpoint: ids restart at 0
    ingest.fan_out(spark, replay, b, 0)
    assert _snapshot(spark, scratch) == first
    wh = ingest.read_store(spark, scratch, "warehouse/staging_flight_events")
    assert wh.count() == n                         # replay added nothing new
    meta = spark.read.parquet(scratch.meta("batch_metadata"))
    counts = {r.batch_key: r.record_count for r in meta.collect()}
    assert counts == {"main-0": n, "replay-0": 0}


def test_null_ids_are_quarantined(spark, scratch):
    b = _batch(spark).limit(20).withColumn(
        "flight_id", F.when(F.col("dep_delay") > 0, F.col("flight_id")))
    ingest.fan_out(spark, scratch, b, 0)
    hot = ingest.read_hot(spark, scratch).count()
    q = ingest.read_store(spark, scratch, "quarantine").count()
    assert hot + q == 20 and q > 0


def test_stream_equals_batch(spark, scratch):
    src = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    stream = (spark.readStream.schema(src.schema).option("pathGlobFilter", "events.parquet")
              .option("maxFilesPerTrigger", 1).parquet(SF_SMALL))
    from contrail.sources.tables import events_as_flights
    ingest.run_ingest(spark, encode_events(events_as_flights(stream)), scratch, processing_time=PROCESSING_TIME)
    got = _snapshot(spark, scratch)
    b = _batch(spark)
    exp = sorted(tuple(r) for r in b.select("flight_id", "dep_delay", "predicted_delay").collect())
    assert got == exp


def test_retention_moves_without_loss_or_overlap(spark, scratch):
    b = _batch(spark)
    ingest.fan_out(spark, scratch, b, 0)
    before = _snapshot(spark, scratch)
    as_of = "2024-01-30 12:00:00"
    cutoff = retention.cutoff_of(as_of, 7)
    # failure injected after the archive write, before the purge: rerun
    orig = retention.purge
    retention.purge = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("boom"))
    try:
        try:
            retention.archive(spark, scratch, as_of)
        except RuntimeError:
            pass
    finally:
        retention.purge = orig
    meta = retention.archive(spark, scratch, as_of)
    assert meta["archived"]
    hot = ingest.read_hot(spark, scratch)
    cold = ingest.read_store(spark, scratch, "cold_archive")
    assert hot.where(F.col("timestamp") < F.lit(cutoff)).count() == 0
    assert cold.where(F.col("timestamp") >= F.lit(cutoff)).count() == 0
    assert cold.groupBy("flight_id").count().where("count > 1").count() == 0
    union = sorted(tuple(r) for r in hot.select("flight_id", "dep_delay", "predicted_delay")
                   .unionByName(cold.select("flight_id", "dep_delay", "predicted_delay")).collect())
    assert union == before
    h = retention.history(spark, scratch, lo="2024-01-10 00:00:00", hi="2024-01-20 00:00:00")
    assert h.where((F.col("timestamp") < "2024-01-10") | (F.col("timestamp") > "2024-01-20")).count() == 0
    assert not retention.archive(spark, scratch, as_of, threshold_mb=1e9)["archived"]


def test_warehouse_tables(spark, scratch):
    from contrail.sources.warehouse import catalog_stats, create_warehouse
    ingest.fan_out(spark, scratch, _batch(spark), 0)
    db = "contrail_test_dw"
    tables = create_warehouse(spark, scratch, db)
    assert len(tables) == 3
    mat = ingest.Stores(scratch.root + "-materialized")
    ingest.fan_out(spark, mat, _batch(spark), 0, materialize_projections=True)
    assert ingest.read_store(spark, mat, "warehouse/fact_flight_events").count() == _batch(spark).count()
    staging = ingest.read_store(spark, scratch, "warehouse/staging_flight_events")
    from contrail.operators.predict import fact_projection, prediction_projection
    fact = spark.table(f"{db}.fact_flight_events").drop("batch_key", "part")
    assert sorted(map(tuple, fact.collect())) == sorted(map(tuple, fact_projection(staging).collect()))
    pred = spark.table(f"{db}.predictions").drop("batch_key", "part")
    assert sorted(map(tuple, pred.collect())) == sorted(map(tuple, prediction_projection(staging).collect()))
    st = {r.table_name: r for r in catalog_stats(spark, db).collect()}
    assert st["staging_flight_events"].total_rows == staging.count() and st["staging_flight_events"].total_bytes > 0
    from contrail.sources.warehouse import create_metadata
    meta = create_metadata(spark, scratch, db)
    assert f"{db}.batch_metadata" in meta
    assert spark.table(f"{db}.schema_metadata").count() == 3
    assert spark.table(f"{db}.batch_metadata").where("record_count > 0").count() == 1


def test_update_mode_windows_equal_complete(spark, tmp_path):
    from contrail.sources.tables import events_as_flights
    from contrail.streaming import live
    src = spark.read.parquet(f"{SF_SMALL}/events.parquet")

    def stream():
        return events_as_flights(spark.readStream.schema(src.schema).option("pathGlobFilter", "events.parquet")
                                 .option("maxFilesPerTrigger", 1).parquet(SF_SMALL))
    a = live.windowed_airline_delay(stream(), "1 hour", watermark="31 days")
    live.drain_updates(spark, a, str(tmp_path / "u"), str(tmp_path / "uc"))
    got = live.latest_windows(spark, str(tmp_path / "u"))
    b = live.windowed_airline_delay(stream(), "1 hour", watermark="31 days")
    exp = live.drain_to_table(spark, b, str(tmp_path / "c"), str(tmp_path / "cc"), mode="complete")
    key = ["w", "airline_code", "flight_count", "events"]
    assert sorted(tuple(r) for r in got.select(*key).collect()) == sorted(tuple(r) for r in exp.select(*key).collect())


def test_duplicate_choice_does_not_depend_on_order(spark):
    rows = [("a", i, float(i % 7)) for i in range(50)] + [("b", 1, 2.0)]
    one = spark.createDataFrame(rows, "flight_id string, x int, y double")
    other = spark.createDataFrame(rows[::-1], "flight_id string, x int, y double").repartition(7)
    assert sorted(map(tuple, ingest.one_per_key(one).collect())) == sorted(map(tuple, ingest.one_per_key(other).collect()))


def test_rows_without_id_and_late_rows_pass_the_dedup(spark, tmp_path):
    src = str(tmp_path / "in")
    for k, day in enumerate(("2024-02-20", "2024-01-01", "2024-03-01")):
        spark.createDataFrame([(None, day), (None, day), ("x", day), (f"y{k}", day)], "flight_id string, d string").coalesce(1).write.mode("append").json(src)
    stream = spark.readStream.schema("flight_id string, d string").option("maxFilesPerTrigger", 1).json(src)
    out = ingest.dedup_in_stream(stream.withColumn("timestamp", F.col("d").cast("timestamp_ntz")), "1 hour")
    out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = [r.flight_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert got.count(None) == 6 and got.count("x") == 1 and len(got) == 10


def test_job_session_overrides_nothing_of_the_submit_command(spark):
    from contrail.session import job_spark
    conf = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",)}
    s = job_spark("x")
    assert s.sparkContext.master == spark.sparkContext.master and s.conf.get("spark.sql.shuffle.partitions") == conf["spark.sql.shuffle.partitions"]
