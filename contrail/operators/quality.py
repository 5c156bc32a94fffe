"""Data-quality profiling.

Each profile is one aggregate over the whole table (the reference caps its
sample at 10,000 rows; here nothing is capped), followed by an unpivot of
the single result row into one row per column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.columns import dbl, pct
from contrail.session import checkpoint_dir

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def _missing(df: DataFrame, c: str):
    f = df.schema[c]
    m = F.col(c).isNull()
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        m = m | F.isnan(c)
    return m


def missing_values(df: DataFrame, cols=None) -> DataFrame:
    """Per column the number and share of missing values (NULL, or NaN
    in floating columns), only columns with any, most missing first."""
    cols = list(cols or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(_missing(df, c)).alias(c) for c in cols])
    long = row.unpivot("__n", cols, "field", "missing_count")
    return (long.where(F.col("missing_count") > 0)
            .select("field", "missing_count", pct("missing_count", "__n").alias("missing_pct")))


def dup_stats(df: DataFrame, key: str = "flight_id") -> DataFrame:
    """Duplicated keys as pandas counts them (missing keys equal each
    other): rows - distinct non-missing keys - (1 if any key is missing)."""
    n = F.count(F.lit(1))
    d = F.count_distinct(key)
    z = F.count_if(F.col(key).isNull())
    dups = n - d - F.when(z > 0, 1).otherwise(0)
    return df.agg(n.alias("records"), dups.alias("duplicates"), pct(dups, n).alias("duplicate_pct"))


def quality_score(df: DataFrame, as_of, key: str = "flight_id", ts_col: str = "timestamp") -> DataFrame:
    """100 - min(2 * sum(missing %), 50)
    - (age > 24 h ? min((age - 24) / 24 * 10, 30) : 0) - min(duplicate %, 20),
    floored at 0, with its band (>= 90 excellent, >= 70 good, else poor).  One
    aggregate over one scan."""
    n = F.count(F.lit(1))
    missing = [pct(F.count_if(_missing(df, c)), n) for c in df.columns]
    copies = n - F.count_distinct(key) - F.when(F.count_if(F.col(key).isNull()) > 0, 1).otherwise(0)
    row = df.agg(F.coalesce(reduce(lambda a, b: a + b, missing), dbl(0)).alias("missing_pct_sum"), F.max(ts_col).alias("_latest"), pct(copies, n).alias("duplicate_pct"))
    end = F.lit(str(as_of)).cast("timestamp_ntz")
    parts = row.select("missing_pct_sum", (F.timestamp_diff("MICROSECOND", F.col("_latest"), end) / dbl(3.6e9)).alias("age_hours"), "duplicate_pct")
    age = F.col("age_hours")
    score = (dbl(100) - F.least(F.col("missing_pct_sum") * dbl(2), dbl(50))
             - F.when(age > 24, F.least((age - dbl(24)) / dbl(24) * dbl(10), dbl(30))).otherwise(dbl(0))
             - F.least(F.coalesce(F.col("duplicate_pct"), dbl(0)), dbl(20)))
    return (parts.withColumn("quality_score", F.greatest(score, dbl(0)))
            .withColumn("band", F.when(F.col("quality_score") >= 90, "excellent")
                        .when(F.col("quality_score") >= 70, "good").otherwise("needs attention")))


def _number(c: str):
    """The column as a double, NaN as missing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _value_counts(df: DataFrame, cols, value) -> DataFrame:
    """(field, x, n): how often each value stands in each column; one pass,
    counted map-side before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), value(c).alias("x")) for c in cols])
    return (df.select(F.inline(pairs)).where(F.col("x").isNotNull())
            .groupBy("field", "x").agg(F.count(F.lit(1)).alias("n")))


def field_quantiles(df: DataFrame, cols, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact linear-interpolated quantiles ``q0, q1, ...`` of all columns in
    one job, one row per column that has values.

    The counts per value are range-partitioned and summed up along their
    order; no task holds the values of a whole column.  They are
    checkpointed, as range bounds are sampled anew on each execution."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = (_value_counts(df, cols, _number).repartitionByRange(parts, "field", "x")
              .withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True))
    per_part = counts.groupBy("field", "__pid").agg(F.sum("n").alias("__sum"))
    field = Window.partitionBy("field")  # one row per partition and column
    offsets = per_part.select("field", "__pid", (F.sum("__sum").over(field.orderBy("__pid")) - F.col("__sum")).alias("__off"),
                              F.sum("__sum").over(field).alias("__all"))
    here = F.sum("n").over(Window.partitionBy("__pid", "field").orderBy("x"))
    ranked = counts.withColumn("__here", here).join(offsets, ["field", "__pid"])
    end = F.col("__off") + F.col("__here")
    aggs, out = [], []
    for i, p in enumerate(probs):
        pos = dbl(p) * (F.col("__all") - 1)
        low = F.floor(pos)
        for name, rank in (("lo", low), ("hi", F.least(low + 1, F.col("__all") - 1))):
            aggs.append(F.max(F.when((end - F.col("n") <= rank) & (rank < end), F.col("x"))).alias(f"{name}{i}"))
        aggs.append(F.max(pos - low).alias(f"part{i}"))
        out.append((F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"part{i}")).alias(f"q{i}"))
    return ranked.groupBy("field").agg(*aggs).select("field", *out)


def field_modes(df: DataFrame, cols) -> DataFrame:
    """(field, mode): the most frequent value of each column as text, of
    equally frequent ones the smallest."""
    counts = _value_counts(df, cols, lambda c: F.col(c).cast("string"))
    return counts.groupBy("field").agg(F.min_by("x", F.struct(-F.col("n"), F.col("x"))).alias("mode"))


def describe_numeric(df: DataFrame, cols=None) -> DataFrame:
    """Pandas ``describe()`` of the numeric columns: count, mean,
    sample std, min, exact linear-interpolated quartiles, max.  One path for
    every size (``field_quantiles``)."""
    cols = list(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)])
    aggs = [F.struct(F.lit(c).alias("field"), F.count(_number(c)).alias("count"), F.avg(_number(c)).alias("mean"),
                     F.stddev_samp(_number(c)).alias("std"), F.min(_number(c)).alias("min"),
                     F.max(_number(c)).alias("max")).alias(c) for c in cols]
    long = df.agg(*aggs).select(F.inline(F.array(*[F.col(c) for c in cols])))
    return (long.join(field_quantiles(df, cols), "field", "left")
            .select("field", "count", "mean", "std", "min", F.col("q0").alias("p25"),
                    F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max"))


def schema_table(df: DataFrame) -> DataFrame:
    """Field -> type of a table, one row per field, with the rows and the
    non-missing values found (one aggregate over the table)."""
    fields = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("field"),
                       F.lit(f.dataType.simpleString()).alias("type"), F.count(F.lit(1)).alias("rows"),
                       F.count(f.name).alias("non_null")).alias(f"f{i}") for i, f in enumerate(df.schema.fields)]
    row = df.agg(*fields)
    return row.select(F.inline(F.array(*row.columns)))


def json_schema(df: DataFrame, col: str) -> DataFrame:
    """S7 for JSON text: the type of every top-level key merged over **all**
    rows (one distributed aggregate, no sampling): ``bigint`` when every
    value is an integer, ``double`` when every value is numeric,
    ``boolean``, ``struct``/``array`` for nested values, else ``string``."""
    kv = (df.select(F.col(col).alias("_j")).where(F.col("_j").isNotNull())
          .select("_j", F.explode(F.json_object_keys("_j")).alias("field"))
          .select("field", F.expr("get_json_object(_j, concat('$.', field))").alias("v")))
    v = F.col("v")
    present = v.isNotNull()
    agg = kv.groupBy("field").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(present).alias("non_null"),
        F.count_if(present & v.try_cast("bigint").isNull()).alias("_not_int"),
        F.count_if(present & v.try_cast("double").isNull()).alias("_not_num"),
        F.count_if(present & ~F.lower(v).isin("true", "false")).alias("_not_bool"),
        F.count_if(present & ~v.startswith("{")).alias("_not_obj"),
        F.count_if(present & ~v.startswith("[")).alias("_not_arr"),
    )
    t = (F.when(F.col("non_null") == 0, "null").when(F.col("_not_int") == 0, "bigint")
         .when(F.col("_not_num") == 0, "double").when(F.col("_not_bool") == 0, "boolean")
         .when(F.col("_not_obj") == 0, "struct").when(F.col("_not_arr") == 0, "array").otherwise("string"))
    return agg.select("field", t.alias("type"), "rows", "non_null")


def exact_quantiles(df: DataFrame, col: str, probs=(0.25, 0.5, 0.75), partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles of a column of any size.

    ``percentile`` keeps a value -> count map in one final task, which does
    not scale for a continuous column at 100 TB.  Here the values are
    numbered globally in sorted order (range partitioning, no single task;
    a row-id tiebreaker lets the range bounds split a value that holds a
    large share of the rows), and only the <= 2 * len(probs) ranks that
    bracket each quantile are read back."""
    from contrail.operators.rolling import global_row_number
    x = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    vals = (df.select(x.alias("x")).where(F.col("x").isNotNull())
            .withColumn("__tie", F.monotonically_increasing_id()))
    numbered = global_row_number(vals, ["x", "__tie"], partitions)
    n = numbered.count()
    spark = df.sparkSession
    if n == 0:
        return spark.createDataFrame([(float(p), None) for p in probs], "p double, value double")
    want = {}
    for p in probs:
        pos = p * (n - 1)
        lo = int(pos // 1)
        want[p] = (lo, min(lo + 1, n - 1), pos - lo)
    ranks = sorted({r for lo, hi, _ in want.values() for r in (lo, hi)})
    got = {r["__rn"]: r["x"] for r in numbered.where(F.col("__rn").isin(ranks)).select("__rn", "x").collect()}
    rows = [(float(p), got[lo] + (got[hi] - got[lo]) * frac) for p, (lo, hi, frac) in want.items()]
    return spark.createDataFrame(rows, "p double, value double")
