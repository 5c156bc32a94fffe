"""Spark session helpers.

The library never assumes a local filesystem: shared locations (checkpoints,
warehouse, hot/cold stores) are always read from the session configuration
or passed in explicitly.  ``get_spark`` is only a convenience for tests,
benchmarks and the command line.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A dimension is only ever broadcast by its measured size; keep the
    # automatic threshold at Spark's default instead of raising it.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def _driver_memory() -> str:
    """Local mode: 8g, or 60 % of physical memory on a smaller machine."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        return f"{max(1, min(8, int(total * 0.6 / 2**30)))}g"
    except (ValueError, OSError, AttributeError):
        return "4g"


def get_spark(master: str | None = None, app: str = "contrail",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library expects."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = os.environ.get("CONTRAIL_DRIVER_MEMORY", _driver_memory())
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def job_spark(app: str) -> SparkSession:
    """The session of a submitted job: master, memory and partition counts
    are those of the submit command and its configuration; only what the
    results depend on is set here."""
    spark = (SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true").getOrCreate())
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is always used as
    is; a cluster session without it is an error.  Only in local mode
    (tests) a fresh scratch folder is created when it is unset and recorded
    in the session so that later calls agree.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: checkpoints and stores "
                               "must survive the loss of any one machine")
        path = tempfile.mkdtemp(prefix="contrail-ckpt-")  # local mode (tests) only
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path
