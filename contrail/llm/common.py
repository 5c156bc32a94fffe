"""Helpers shared by the operators: shared-folder tables, keyed blocks of
documents, connected components, and vectorised word handling over Arrow
buffers.

Every operator selects the columns it needs before anything else, so extra
input columns (also ones named like an output column) never matter.
"""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import checkpoint_dir

#: An id that is null sorts behind all others.
NULL_ID = (1 << 63) - 1

#: Odd multipliers of the integer hashes (fixed values).
M1 = np.uint64(0x9E3779B97F4A7C15)
M2 = np.uint64(0xBF58476D1CE4E5B9)
M3 = np.uint64(0x94D049BB133111EB)

#: Word separators of the contracts: space and tab to carriage return.
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: One random 64-bit value for each byte.
BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it
    back: lineage is cut, and a lost executor costs nothing that was
    finished."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the context cleaner drop the shuffle files of finished steps before
    the next large one writes its own.  The first collection frees the
    Python side's handles, the second what they held."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def documents_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (long), ``data`` (the UTF-8 bytes of the text; null: empty)."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))


def text_key(data: Column) -> Column:
    """A number for a text: rows of one id and one text fare alike, so (id,
    text) joins what an operator says about them, null ids included."""
    return F.xxhash64(F.coalesce(data.cast("string"), F.lit("")).cast("binary"))


def total_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("data"))).first()[0] or 0


def with_block(docs: DataFrame, n_blocks: int) -> DataFrame:
    """Spread documents over ``n_blocks`` blocks of about equal bytes.  The
    block depends on id and text alone, so every later step finds a document
    in the same block again."""
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "data"), F.lit(n_blocks)).cast("int"))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    y = x >> np.uint64(30)
    y ^= x
    y *= M2
    z = y >> np.uint64(27)
    z ^= y
    z *= M3
    np.right_shift(z, np.uint64(31), out=y)
    y ^= z
    return y


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary or string Arrow column in one array, and its
    n + 1 offsets into it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def ids_of(column) -> np.ndarray:
    """Ids as int64; null: NULL_ID."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.int64())
    return np.asarray(column.fill_null(NULL_ID).to_numpy(zero_copy_only=False), dtype=np.int64)


class Words:
    """The words of a run of documents: byte range, hash and document of each.

    A word is a maximal run of bytes other than the separators; it never
    crosses a document."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, lower: bool = False):
        if lower:
            table = np.arange(256, dtype=np.uint8)
            table[65:91] += 32
            buf = table[buf]
        self.buf, self.offsets = buf, offsets
        self.n_docs = len(offsets) - 1
        inside = np.zeros(len(buf) + 1, dtype=bool)
        inside[:-1] = ~SEPARATORS[buf]
        first = np.zeros(len(buf) + 1, dtype=bool)
        first[0] = True
        first[1:] = ~inside[:-1]
        first[offsets[:-1][offsets[:-1] < len(buf)]] = True
        starts = np.flatnonzero(inside & first)
        last = np.zeros(len(buf), dtype=bool)
        if len(buf):
            last[:] = ~inside[1:]
            ends = offsets[1:]
            last[ends[ends > 0] - 1] = True
        self.starts = starts
        self.ends = np.flatnonzero(inside[:-1] & last) + 1
        self.bounds = np.searchsorted(starts, offsets)  # words of document i: bounds[i] to bounds[i + 1]
        self.bounds[-1] = len(starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self, chunk: int = 1 << 15) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        out = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(self.starts):
            to = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + chunk)))
            lo, hi = int(self.starts[at]), int(self.ends[to - 1])
            if to == at + 1 and hi - lo > chunk:
                out[at] = _long_word(self.buf[lo:hi], chunk)
            else:
                if hi - lo > 2 * chunk and to > at + 1:  # a long word ends this run: leave it to the next
                    to -= 1
                    hi = int(self.ends[to - 1])
                out[at:to] = _run_hashes(self.buf[lo:hi], self.starts[at:to] - lo, self.ends[at:to] - lo)
            at = to
        return out


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int) -> np.ndarray:
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _POWERS:
        p = np.full(size, M1, np.uint64)
        p[0] = 1
        _POWERS[size] = np.cumprod(p)
    return _POWERS[size]


#: Inverse of M1 modulo 2**64.
_INVERSE = np.uint64(pow(int(M1), -1, 1 << 64))
_INVERSES: dict[int, np.ndarray] = {}


def _inverses(n: int) -> np.ndarray:
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _INVERSES:
        p = np.full(size, _INVERSE, np.uint64)
        p[0] = 1
        _INVERSES[size] = np.cumprod(p)
    return _INVERSES[size]


def _run_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each byte range, made independent of its place."""
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[buf] * _powers(len(buf))[:len(buf)], out=sums[1:])
    x = (sums[ends] - sums[starts]) * _inverses(len(buf) + 1)[starts]
    return mix(x + (ends - starts).astype(np.uint64) * M3)


def _long_word(buf: np.ndarray, chunk: int) -> np.uint64:
    """The same hash for one word longer than a chunk, piece by piece."""
    with np.errstate(over="ignore"):
        total, power = np.uint64(0), np.uint64(1)
        for at in range(0, len(buf), chunk):
            piece = buf[at:at + chunk]
            p = _powers(chunk)[:len(piece)]
            total = total + power * np.add.reduce(BYTE_VALUES[piece] * p)
            power = power * np.uint64(pow(int(M1), len(piece), 1 << 64))
        return mix(np.array([total + np.uint64(len(buf)) * M3], np.uint64))[0]


def batches(it: Iterator[pa.RecordBatch], column: str, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each has at most about ``most`` bytes of a
    binary column (a longer document stands alone)."""
    for b in it:
        off = buffers(b.column(column))[1]
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
            yield b.slice(at, to - at)
            at = to


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (id, component): the smallest id reachable.

    Minimum labels travel over the edges and every round also jumps to the
    label's own label, so the rounds grow with the logarithm of a path's
    length.  Each round is a written table; nothing is collected."""
    both = materialise(edges.select("a", "b").where("a != b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a != b")).distinct())
    labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")))
    while True:
        seen = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        near = labels.join(seen, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("up"))
        step = materialise(near.join(jump, "component", "left").select("id", "old", F.least("component", F.coalesce("up", "component")).alias("component")))
        changed = step.where("old != component").limit(1).count()
        labels = step.select("id", "component")
        if not changed:
            return labels


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
