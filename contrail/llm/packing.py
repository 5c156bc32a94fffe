"""Operator 2, packing by non-negative least squares over a length histogram.

Every document becomes its token ids and an end id.  It is cut into full
windows and a rest; of the rest, a head that is a multiple of ``UNIT`` tokens
and a tail of ``UNIT`` to 2 ``UNIT`` - 1 tokens (a rest below 2 ``UNIT`` stays
whole).  Cuts depend on the document alone, so pieces and their checksums are
made where the text is read and no ids are ever shuffled.

The heads' lengths make a histogram of window / UNIT bins.  All combinations
of at most ``DEPTH`` heads that fill a window exactly are enumerated; the
repeat counts come from a non-negative least squares fit to the histogram,
rounded down.  What is left, and the tails, are packed greedily, pattern by
pattern: the longest piece that fits, again and again, repeated for as
long as the counts last.  All this works on counts per length, so its cost does
not depend on the number of documents.  A piece then finds its sequence from
its length and its number among the pieces of that length, which is a
prefix sum over the tasks that wrote them.

Defined cases: null or empty text is the end id alone; a null id stays null;
repeated rows are packed as rows; an empty table gives no pieces; other columns
are ignored.  A sequence is padded to the window unless its length is a power
of two.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import batches, materialise

UNIT = 32
DEPTH = 5
END_ID = 1


class Encoder:
    """Token ids of a text under the byte-level vocabulary file; both files
    of the vocabulary name the same ids (see the tests)."""

    _made: dict[str, "Encoder"] = {}
    _blank = re.compile(r"\s{20000}")
    _cut = re.compile("(?<=[A-Za-z0-9])(?= [A-Za-z])")

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import tiktoken

        self.path = path
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, name: str) -> "Encoder":
        import public_tokenizers

        if name not in cls._made:
            cls._made[name] = cls(public_tokenizers.path(name))
        return cls._made[name]

    def ids(self, text: str) -> np.ndarray:
        if len(text) <= 1 << 17:
            return self._short(text)
        # a word boundary that the pre-tokenizer never joins: long texts go piece by piece
        parts, at = [], 0
        while at < len(text):
            cut = self._cut.search(text, at + (1 << 16))
            to = cut.start() if cut else len(text)
            parts.append(self._short(text[at:to]))
            at = to
        return np.concatenate(parts)

    def _short(self, text: str) -> np.ndarray:
        if len(text) > 20000 and self._blank.search(text):  # beyond the backtracking of the ranks' pattern
            from tokenizers import Tokenizer

            exact = Tokenizer.from_file(self.path)
            exact.encode_special_tokens = True
            return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.encoding.encode_ordinary(text), "<u4")


def cuts(n: int, window: int) -> list[int]:
    """Lengths of the pieces of a document of n tokens."""
    out = [window] * (n // window)
    rest = n % window
    if rest >= 2 * UNIT and rest % UNIT:
        tail = rest % UNIT + UNIT
        out += [rest - tail, tail]
    elif rest:
        out.append(rest)
    return out


def _pieces(it: Iterator[pa.RecordBatch], vocabulary: str, window: int) -> Iterator[pa.RecordBatch]:
    encoder, part, seen = Encoder.of(vocabulary), TaskContext.get().partitionId(), {}
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "number"]
    for b in batches(it, "data", 1 << 22):
        rows = []
        for doc, text in zip(b.column("doc_id").to_pylist(), b.column("data").cast(pa.large_binary()).to_pylist()):
            raw = np.append(encoder.ids(text.decode("utf-8", "replace")), np.array([END_ID], "<u4")).tobytes()
            at, n = 0, len(raw) // 4
            for size in cuts(n, window):
                number = seen.get(size, 0)
                seen[size] = number + 1
                rows.append((doc, at, size, crc32(memoryview(raw)[4 * at:4 * (at + size)]), n, part, number))
                at += size
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)


def combinations(total: int, sizes: list[int], depth: int) -> list[tuple[int, ...]]:
    """Non-increasing tuples of at most ``depth`` sizes with the sum."""
    out: list[tuple[int, ...]] = []
    sizes = sorted(set(sizes), reverse=True)
    usable = set(sizes)

    def add(head: tuple[int, ...], left: int, at: int) -> None:
        room = depth - len(head)
        if left == 0:
            out.append(head)
        elif room == 1:
            if left in usable and left <= (head[-1] if head else left):
                out.append((*head, left))
        elif room > 1:
            for i in range(at, len(sizes)):
                if sizes[i] * room < left:
                    break
                if sizes[i] <= left:
                    add((*head, sizes[i]), left - sizes[i], i)

    add((), total, 0)
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Least squares with x >= 0 by active sets: the column with the
    steepest descent enters, and columns leave where the solution on the
    active set would turn negative."""
    x, active = np.zeros(a.shape[1]), []
    tolerance = 1e-9 * max(1.0, float(np.abs(b).max(initial=0))) * a.shape[0]
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        j = int(np.argmax(slope)) if len(slope) else -1
        if j < 0 or slope[j] <= tolerance:
            break
        active.append(j)
        while active:
            z = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            if z.min() > 0:
                x[:] = 0
                x[active] = z
                break
            old = x[active]
            low = z <= 0
            t = np.min(old[low] / np.maximum(old[low] - z[low], 1e-300)) if low.any() else 1.0
            new = old + t * (z - old)
            x[:] = 0
            x[active] = new
            left = [k for k, v in zip(active, new) if v > 1e-12]
            active = left if len(left) < len(active) else [k for k, v in zip(active, z) if v > 0]
    return x


def plan(histogram: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> how many) with their repeat counts; together
    they hold every piece once."""
    left = {k: v for k, v in histogram.items() if v}
    out: list[tuple[dict[int, int], int]] = []

    def use(pattern: dict[int, int], times: int) -> None:
        if times > 0:
            out.append((pattern, times))
            for k, m in pattern.items():
                left[k] -= m * times
                if not left[k]:
                    del left[k]

    if window in left:
        use({window: 1}, left[window])
    heads = [k for k in left if k % UNIT == 0 and k < window]
    found = combinations(window, heads, DEPTH) if window % UNIT == 0 else []
    if found:
        row = {k: i for i, k in enumerate(heads)}
        a = np.zeros((len(heads), len(found)))
        for j, c in enumerate(found):
            for k in c:
                a[row[k], j] += 1
        x = nnls(a, np.array([left[k] for k in heads], float))
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 1:
                break
            pattern = {k: found[j].count(k) for k in found[j]}
            use(pattern, min([int(x[j]), *(left.get(k, 0) // m for k, m in pattern.items())]))
    while left:  # greedy residuals; each round uses up a length
        room, pattern = window, {}
        for k in sorted(left, reverse=True):
            m = min(room // k, left[k])
            if m:
                pattern[k] = m
                room -= m * k
        use(pattern, min(left[k] // m for k, m in pattern.items()))
    return out


def _slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first number of each slot, its first sequence,
    offset and how many pieces a sequence takes there."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for pattern, times in patterns:
        offset = 0
        for k, m in pattern.items():
            rows.setdefault(k, []).append((used.get(k, 0), base, offset, m))
            used[k] = used.get(k, 0) + m * times
            offset += k * m
        base += times
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in rows.items()}


def _placed(it: Iterator[pa.RecordBatch], slots: dict[int, tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    for b in it:
        length, number = (np.asarray(b.column(c)) for c in ("length", "number"))
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for k in np.unique(length):
            at = np.flatnonzero(length == k)
            first, base, shift, per = slots[int(k)]
            s = np.searchsorted(first, number[at], side="right") - 1
            n = number[at] - first[s]
            sequence[at] = base[s] + n // per[s]
            offset[at] = shift[s] + n % per[s] * k
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), pa.array(sequence), pa.array(offset)],
                                         names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def pack(docs: DataFrame, window: int = 2048, vocabulary: str = "byte_bpe_50k.json", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))
    pieces = materialise(src.mapInArrow(lambda it: _pieces(it, vocabulary, window),
                                        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, number long"))
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most window rows
    slots = _slots(plan(histogram, window))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task and length
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = pieces.join(base, ["part", "length"]).withColumn("number", F.col("number") + F.col("base"))
    return numbered.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "number").mapInArrow(
        lambda it: _placed(it, slots), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
