"""Rolling mean over the last *n* rows (W1, W2) without a single-task window.

A plain ``Window.orderBy(ts)`` without ``partitionBy`` moves every row into
one task.  Here the rows are numbered globally and cut into blocks of
``block_rows`` consecutive rows; the last ``n - 1`` rows of each block are
copied into the next block as a halo, so each block computes its windows
independently and in parallel, and the halo rows are dropped afterwards.

Global numbering: range-partition on the order keys, sort each partition,
number the rows inside it (``monotonically_increasing_id`` carries the
partition index in its upper bits and the position in the lower 33), add
the partition's offset (a prefix sum over the per-partition counts, one row
per partition).  The numbered rows are checkpointed once so that the
counts and the rows come from the same range partitioning.  The numbering
must be evaluated in the stage right after the range exchange:
``spark_partition_id`` inside a union would return the union's index.

With ``partition_by`` (W2) the global order is (key, ts, id) and the
window is partitioned by (block, key): a key holding a third of all rows
is spread over many blocks instead of one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import checkpoint_dir

_LOW33 = (1 << 33) - 1


def global_row_number(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """Add ``__rn`` (0-based) in ``order``; distributed, no single task.

    The range-partitioned, sorted and locally numbered rows are written
    once with ``checkpoint()`` (to the shared ``spark.checkpoint.dir``):
    range bounds are sampled anew whenever a plan is executed, so the
    per-partition counts and the rows must come from one materialisation.
    This also cuts the lineage, so a lost executor re-reads the checkpoint
    instead of re-sampling."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)))
              .checkpoint(eager=True))
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # One row per partition: the prefix sum is over ``n`` rows only.
    offsets = counts.select(
        "__pid", (F.sum("__cnt").over(Window.orderBy("__pid")) - F.col("__cnt")).alias("__off"))
    return (ranged.join(F.broadcast(offsets), "__pid")
            .withColumn("__rn", F.col("__off") + F.col("__local"))
            .drop("__pid", "__local", "__off"))


def rolling_mean(df: DataFrame, value: str = "dep_delay", n: int = 10, *,
                 order=("timestamp", "flight_id"), partition_by: str | None = None,
                 out: str = "rolling_avg", block_rows: int = 1_000_000,
                 partitions: int | None = None) -> DataFrame:
    """Mean of ``value`` over the current and the ``n - 1`` previous rows
    (pandas ``rolling(n, min_periods=1).mean()``: missing values skipped,
    NULL when the window has none)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    B = max(block_rows, n - 1, 1)
    keys = ([partition_by] if partition_by else []) + list(order)
    numbered = global_row_number(df, keys, partitions).withColumn("__blk", F.floor(F.col("__rn") / B))
    # Each row goes to its own block; the last n - 1 rows of a block are also
    # emitted (flagged as halo) into the next one.  One ``explode`` instead
    # of a union keeps the numbering in the stage that computed it (inside a
    # union, partition ids are the union's).
    own = F.struct(F.col("__blk").alias("b"), F.lit(False).alias("h"))
    nxt = F.when((F.col("__rn") % B) >= B - (n - 1),
                 F.struct((F.col("__blk") + 1).alias("b"), F.lit(True).alias("h")))
    copies = F.filter(F.array(own, nxt), lambda x: x.isNotNull()) if n > 1 else F.array(own)
    both = (numbered.withColumn("__c", F.explode(copies))
            .withColumn("__blk", F.col("__c.b")).withColumn("__halo", F.col("__c.h")).drop("__c"))
    part = ["__blk"] + ([partition_by] if partition_by else [])
    w = Window.partitionBy(*part).orderBy("__rn").rowsBetween(-(n - 1), 0)
    return (both.withColumn(out, F.avg(value).over(w))
            .where(~F.col("__halo")).drop("__blk", "__halo", "__rn"))


def rolling_mean_plain(df: DataFrame, value: str = "dep_delay", n: int = 10, *,
                       order=("timestamp", "flight_id"), partition_by: str | None = None,
                       out: str = "rolling_avg") -> DataFrame:
    """Reference implementation with a plain window (single task when not
    partitioned); used by tests to check ``rolling_mean``."""
    w = (Window.partitionBy(partition_by) if partition_by else Window).orderBy(*order) \
        .rowsBetween(-(n - 1), 0)
    return df.withColumn(out, F.avg(value).over(w))
