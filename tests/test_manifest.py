"""The manifest: readers at every step of archive, compaction and ingest, writers
that meet, stops at any step, the key index, dead letters."""

import os
import random

import pytest
from pyspark.sql import functions as F

from contrail.operators import compaction, retention
from contrail.plans.views import PROCESSING_TIME
from contrail.sources import manifest
from contrail.sources.manifest import Entry
from contrail.sources.stream import decode_events, encode_events, open_stream
from contrail.sources.tables import flight_events
from contrail.streaming import ingest, key_index
from tests.conftest import SF_SMALL

AS_OF = "2024-01-30 12:00:00"


def _messages(spark):
    return encode_events(flight_events(spark, SF_SMALL))


def _batch(spark):
    return ingest.prepare(decode_events(_messages(spark)), processing_time=PROCESSING_TIME)


def _rows(df):
    return sorted(tuple(r) for r in df.select("flight_id", "dep_delay", "predicted_delay").collect())


def _everything(spark, stores):
    return _rows(retention.history(spark, stores))


def _folders(stores, store):
    """Day folders on disk."""
    base = stores.path(store)
    return {f"{store}/{p}/{d}" for p in os.listdir(base) if p.startswith("part=") for d in os.listdir(f"{base}/{p}") if "=" in d}


def _watch(monkeypatch, spark, stores, seen):
    """Call ``history`` before and after every step of a writer."""
    def around(module, name):
        real = getattr(module, name)

        def step(*a, **k):
            seen.append(_everything(spark, stores))
            out = real(*a, **k)
            seen.append(_everything(spark, stores))
            return out
        monkeypatch.setattr(module, name, step)
    for module, name in ((retention, "write_part"), (retention, "verify"), (manifest, "_publish"), (retention, "purge"), (retention, "record_archive"),
                         (compaction, "_one_task_for_each")):
        around(module, name)


def test_a_reader_at_every_step_sees_each_row_once(spark, scratch, monkeypatch):
    ingest.fan_out(spark, scratch, _batch(spark), 0)
    before, seen = _everything(spark, scratch), []
    held = retention.history(spark, scratch)  # planned now, run after the purge
    _watch(monkeypatch, spark, scratch, seen)
    assert retention.archive(spark, scratch, AS_OF)["archived"]
    assert compaction.compact(spark, scratch, "hot")["compacted"]
    monkeypatch.undo()
    assert len(seen) >= 10 and all(s == before for s in seen)
    assert _rows(held) == before and retention.vacuum(spark, scratch) == 0  # nothing is old enough to go
    assert retention.vacuum(spark, scratch, 0) > 0
    assert _everything(spark, scratch) == before
    live = manifest.snapshot(spark, scratch.root)
    for store in ("hot", "cold_archive"):
        assert _folders(scratch, store) == {e.path for e in live.of(store)}
    cut = F.lit(str(retention.cutoff_of(AS_OF, 7))).cast("timestamp_ntz")
    assert ingest.read_hot(spark, scratch).where(F.col("timestamp") < cut).count() == 0
    assert ingest.read_store(spark, scratch, "cold_archive").where(F.col("timestamp") >= cut).count() == 0
    assert spark.read.parquet(scratch.meta("archive_metadata")).count() == 1


def test_of_two_archive_runs_one_wins(spark, scratch, monkeypatch):
    ingest.fan_out(spark, scratch, _batch(spark), 0)
    before = _everything(spark, scratch)
    real, inner = retention.verify, []

    def meanwhile(*a):
        monkeypatch.setattr(retention, "verify", real)
        inner.append(retention.archive(spark, scratch, AS_OF))
        return real(*a)

    monkeypatch.setattr(retention, "verify", meanwhile)
    outer = retention.archive(spark, scratch, AS_OF)
    assert inner[0]["archived"] and not outer["archived"] and outer["reason"] == "another run was first"
    assert _everything(spark, scratch) == before and spark.read.parquet(scratch.meta("archive_metadata")).count() == 1


@pytest.mark.parametrize("step", ["write_part", "verify", "purge", "record_archive"])
def test_an_archive_run_that_stops_anywhere_is_run_again(spark, scratch, monkeypatch, step):
    b = _batch(spark)
    ingest.fan_out(spark, scratch, b, 0)
    before = _everything(spark, scratch)
    real = getattr(retention, step)

    def stops(*a, **k):
        if step == "write_part":
            real(*a, **k)
        raise RuntimeError("stopped")

    monkeypatch.setattr(retention, step, stops)
    with pytest.raises(RuntimeError, match="stopped"):
        retention.archive(spark, scratch, AS_OF)
    monkeypatch.setattr(retention, step, real)
    assert _everything(spark, scratch) == before
    late = b.limit(1).withColumn("flight_id", F.lit("late")).withColumn("timestamp", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
    ingest.fan_out(spark, scratch, late, 7)  # a late row into an old day
    assert retention.archive(spark, scratch, AS_OF)["archived"]
    got = _everything(spark, scratch)
    assert [x for x in got if x[0] != "late"] == before and sum(x[0] == "late" for x in got) == 1
    ingest.fan_out(spark, ingest.Stores(scratch.root, "replay"), b, 0)  # archived ids are still known
    assert _everything(spark, scratch) == got
    assert spark.read.parquet(scratch.meta("archive_metadata")).count() == (2 if step == "record_archive" else 1)


def test_commits(spark, tmp_path):
    root = str(tmp_path / "m")
    e = [Entry("hot", f"hot/part=p{i}/event_date=2024-01-0{1 + i % 3}", f"2024-01-0{1 + i % 3}", 1, 1, 10) for i in range(40)]
    snap = manifest.snapshot(spark, root)
    for x in e:  # all made from the same version: appends never conflict
        manifest.commit(spark, root, snap, add=[x])
    now = manifest.snapshot(spark, root)
    assert now.version == 40 and set(now.entries) == {x.path for x in e}
    assert manifest.snapshot(spark, root, 17).version == 17 and len(manifest.snapshot(spark, root, 17).entries) == 17
    assert {x.day for x in now.of("hot", lo="2024-01-02", hi="2024-01-02")} == {"2024-01-02"}
    manifest.commit(spark, root, now, remove=[e[0].path])
    with pytest.raises(manifest.Conflict):
        manifest.commit(spark, root, now, remove=[e[0].path])
    with pytest.raises(manifest.Conflict):
        manifest.commit(spark, root, snap, add=[], guard=[("hot", "2024-01-02")])
    manifest.commit(spark, root, snap, add=[], guard=[("hot", "2024-02-02")])
    for link in (True, False):  # a number is taken once, by either way
        n = manifest.snapshot(spark, root).version + 1
        body = {"version": n, "time": 0, "add": [], "remove": [], "new_schemas": {}, "run": None, "info": {}}
        assert manifest._publish(spark, root, n, body, link) and not manifest._publish(spark, root, n, body, link)
    assert not [f for f in os.listdir(f"{root}/_manifest") if f.endswith(".tmp")]


def _ids(spark, day, numbers):
    return spark.createDataFrame([(f"f{i}",) for i in numbers], "flight_id string").withColumn("event_date", F.lit(day).cast("date"))


def test_key_index_finds_every_id_and_stays_small(spark, tmp_path):
    root, day = str(tmp_path / "k"), "2024-01-05"
    most = 0
    for i in range(20):
        entries, schemas = key_index.add(_ids(spark, day, range(100 * i, 100 * i + 100)), root, f"b{i}", {day: 100})
        manifest.commit(spark, root, manifest.snapshot(spark, root), add=entries, schemas=schemas)
        key_index.fold(spark, root, [day])
        most = max(most, len(manifest.snapshot(spark, root).of(key_index.KEYS)))
    snap = manifest.snapshot(spark, root)
    assert most <= 2 * key_index.PER_CLASS and len(snap.of(key_index.FILTERS)) == len(snap.of(key_index.KEYS))
    asked = key_index.keyed(_ids(spark, day, range(1000, 3000)))
    assert {r.flight_id for r in key_index.present(spark, root, snap, asked, [day]).collect()} == {f"f{i}" for i in range(1000, 2000)}
    maybe = {r.flight_id for r in key_index.maybe_present(spark, root, snap, asked, [day]).collect()}
    assert maybe >= {f"f{i}" for i in range(1000, 2000)} and len(maybe) < 1000 + 60  # few that are not there
    assert key_index.present(spark, root, snap, key_index.keyed(_ids(spark, "2024-02-01", [1])), ["2024-02-01"]) is None


def test_a_batch_reads_its_days_only(spark, scratch):
    b = _batch(spark)
    ingest.fan_out(spark, scratch, b, 0)
    snap = manifest.snapshot(spark, scratch.root)
    day = "2024-01-09"
    ids = key_index.keyed(b.where(F.to_date("timestamp") == day).withColumn("event_date", F.to_date("timestamp")))
    files = key_index.maybe_present(spark, scratch.root, snap, ids, [day]).inputFiles()
    assert any("/filters/" in f for f in files) and all(f"event_date={day}" in f for f in files if "/filters/" in f) and not any("/hot/" in f for f in files)


def test_two_writers_of_the_same_ids(spark, scratch, monkeypatch):
    b, real, calls = _batch(spark), manifest.commit, []

    def slow(*a, **k):
        if not calls:
            calls.append(1)
            ingest.fan_out(spark, ingest.Stores(scratch.root, "other"), b, 0)
        return real(*a, **k)

    monkeypatch.setattr(manifest, "commit", slow)
    ingest.fan_out(spark, scratch, b, 0)
    hot = ingest.read_hot(spark, scratch)
    assert hot.count() == hot.select("flight_id").distinct().count() == b.count()


def test_large_days_are_cut_and_small_batches_compacted(spark, scratch):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        big = spark.range(40000).select(F.sha2(F.col("id").cast("string"), 256).alias("flight_id"), F.lit("2024-01-05").cast("date").alias("event_date"))
        cut = ingest.write_part(big, scratch, "hot", "x", "event_date", {"2024-01-05": 40000})
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(cut) == 1 and cut[0].files > 2
    b = _batch(spark).withColumn("n", F.pmod(F.xxhash64("flight_id"), F.lit(4))).persist()
    for i in range(4):
        ingest.fan_out(spark, scratch, b.where(F.col("n") == i).drop("n"), i)
    stores = ("hot", "cold", "warehouse/staging_flight_events")
    before = {s: sorted(map(str, ingest.read_store(spark, scratch, s).collect())) for s in stores}
    days = {s: len({e.day for e in manifest.snapshot(spark, scratch.root).of(s)}) for s in stores}
    for s in stores:
        out = compaction.compact(spark, scratch, s)
        assert out["compacted"] and out["files"] == out["folders"] == days[s] < out["files_before"]
        assert sorted(map(str, ingest.read_store(spark, scratch, s).collect())) == before[s]
        assert compaction.compact(spark, scratch, s)["files"] == days[s]
    retention.vacuum(spark, scratch, 0)
    assert {s: sorted(map(str, ingest.read_store(spark, scratch, s).collect())) for s in stores} == before


def test_bins():
    rng = random.Random(1)
    entries = [Entry("hot", f"p{i}", f"d{i % 3}", 1, 1, rng.randrange(1, 60)) for i in range(60)] + [Entry("hot", "big", "d0", 1, 3, 500)]
    made = compaction.bins(entries, 100)
    assert all(sum(e.bytes for e in held) <= 100 and len({e.day for e in held}) == 1 for held in made)
    assert len({e.path for held in made for e in held}) == sum(map(len, made)) and "big" not in {e.path for held in made for e in held}


def _mixed(spark):
    good = _messages(spark).limit(40).withColumn("source_position", F.lit("file-1"))
    bad = [('{"timestamp": "2024-01-01T00:00:00", "AIRLINE_CODE": "X"', "file-1"), ("", "file-1"), (None, "file-2"), ("not json", "file-1"), ("not json", "file-2"), ("not json", "file-2"),
           ('{"timestamp": "yesterday", "AIRLINE_CODE": "A", "ORIGIN": "B", "DEST": "C"}', "file-1"), ('{"timestamp": "2024-01-01T00:00:00", "AIRLINE_CODE": "A", "ORIGIN": "B"}', "file-1")]
    return good.select("value", "source_position").union(spark.createDataFrame(bad, "value string, source_position string"))


def test_dead_letters_keep_their_text_and_enter_once_mended(spark, scratch):
    batch = ingest.prepare(decode_events(_mixed(spark)), processing_time=PROCESSING_TIME)
    ingest.fan_out(spark, scratch, batch, 0)
    ingest.fan_out(spark, scratch, batch, 0)  # again
    ingest.fan_out(spark, ingest.Stores(scratch.root, "replay"), batch, 0)  # and from a fresh checkpoint
    letters = ingest.read_store(spark, scratch, "quarantine").collect()
    assert sorted((r.error, r.raw, r.position, r.copies) for r in letters) == sorted([
        ("malformed", '{"timestamp": "2024-01-01T00:00:00", "AIRLINE_CODE": "X"', "file-1", 1), ("empty", "", "file-1", 1), ("empty", "", "file-2", 1),
        ("malformed", "not json", "file-1", 1), ("malformed", "not json", "file-2", 2),
        ("bad_time", '{"timestamp": "yesterday", "AIRLINE_CODE": "A", "ORIGIN": "B", "DEST": "C"}', "file-1", 1),
        ("missing_field", '{"timestamp": "2024-01-01T00:00:00", "AIRLINE_CODE": "A", "ORIGIN": "B"}', "file-1", 1)])
    n = ingest.read_hot(spark, scratch).count()

    def mend(raw):
        return F.when(raw.contains("yesterday"), F.replace(raw, F.lit("yesterday"), F.lit("2024-01-02T03:04:05")))

    for _ in range(2):
        ingest.replay_dead_letters(spark, scratch, mend, processing_time=PROCESSING_TIME)
    hot = ingest.read_hot(spark, scratch)
    assert hot.count() == n + 1 and hot.where("flight_id = '20240102030405_A_B_C'").count() == 1
    assert ingest.read_store(spark, scratch, "quarantine").count() == 6
    ingest.fan_out(spark, ingest.Stores(scratch.root, "third"), batch, 0)  # the bad message comes once more
    assert ingest.read_store(spark, scratch, "quarantine").count() == 6 and ingest.read_hot(spark, scratch).count() == n + 1


def test_messages_without_a_time_keep_their_id_on_replay(spark, scratch, tmp_path):
    lines = [(f'{{"AIRLINE_CODE": "A{i}", "ORIGIN": "B", "DEST": "C", "DEP_DELAY": 1}}',) for i in range(5)] + [("broken",)]
    src = str(tmp_path / "in")
    spark.createDataFrame(lines, "value string").coalesce(2).write.text(src)
    for run in ("first", "replay"):
        ingest.run_ingest(spark, open_stream(spark, "text", path=src, max_per_trigger=1), ingest.Stores(scratch.root, run), processing_time=PROCESSING_TIME)
    assert ingest.read_hot(spark, scratch).count() == 5
    letters = ingest.read_store(spark, scratch, "quarantine").collect()
    assert [(r.raw, r.error) for r in letters] == [("broken", "malformed")] and src in letters[0].position
