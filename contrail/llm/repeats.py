"""Windows that also occur in a document with a smaller id, over any symbol
sequence.  ``suffix_dedup`` (bytes) and ``substring_dedup`` (words) build on it.

The length of a window is fixed, so every window is looked up at its anchor:
the gram of ``gram`` symbols with the least hash in it.  Equal windows have
equal anchors at equal places.  The windows that share one anchor occurrence
are neighbours; together they are its *context*.  Work is done per block of
documents (a keyed group of a few MB), and every exchange holds, for each
block, one entry for each distinct name with the smallest document id there
(pre-aggregation: a passage in a third of all documents costs one entry per
block).

Round 1 (anchors): groups of one anchor name that occur in one document
drop out.  Round 2 (contexts): equal contexts are equal over all their windows,
so all but those of the smallest document are settled.  Round 3 (windows):
only where one anchor has different contexts, their windows are compared,
each named by the pair of names of its two overlapping halves.

Names are 64-bit fingerprints (contexts and windows) or 40 bits within a
bucket (anchors, which only select work and decide nothing).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import M1, M2, M3, buffers, documents_of, ids_of, materialise, mix, release, total_bytes, with_block

BLOCK_BYTES = 4 << 20
BUCKET_ENTRIES = 1 << 19
_STEP = 1 << 15
_PLACES = np.arange(1 << 20, dtype=np.uint64)


@dataclass(frozen=True)
class Shape:
    """Symbols per window and per anchor gram."""

    window: int
    gram: int

    @property
    def reach(self) -> int:
        return self.window - self.gram + 1


def doubled(x: np.ndarray, width: int, known: int = 1) -> np.ndarray:
    """Names of all runs of ``width`` symbols, from the names of all runs of
    ``known`` symbols: the name of a run is a function of the pair of names of
    its two halves at the next offset, which doubles; the last pair may
    overlap."""
    h = known
    while h < width:
        gap = min(h, width - h)
        c = (int(M1) * (2 * h + 2 * gap + 1) ^ (h << 40)) & ((1 << 64) - 1) | 1
        pair = x[:len(x) - gap] * np.uint64(c)
        pair += x[gap:]
        x, h = pair, h + gap
    return x


@dataclass
class Contexts:
    """Runs of neighbouring windows that share an anchor occurrence."""

    first: np.ndarray  # start of the first window, as a symbol index
    last: np.ndarray  # start of the last window
    name: np.ndarray
    key: np.ndarray  # name of the anchor gram
    doc: np.ndarray  # index of the document


def contexts(symbols: Callable[[int, int], np.ndarray], offsets: np.ndarray, shape: Shape) -> Contexts:
    """``symbols(lo, hi)``: names of the symbols of that range; ``offsets``:
    first symbol of each document and the end."""
    n, w, parts = int(offsets[-1]), shape.window, []
    for lo in range(0, max(0, n - w + 1), _STEP):
        hi = min(lo + _STEP, n - w + 1)
        one = symbols(lo, hi + w - 1)
        short = doubled(one, shape.gram)
        grams = mix(short)
        packed = grams & ~np.uint64((1 << 20) - 1)
        packed |= _PLACES[:len(grams)]
        least, h = packed, 1
        while h < shape.reach:  # minimum over the grams of each window
            gap = min(h, shape.reach - h)
            least = np.minimum(least[:len(least) - gap], least[gap:])
            h += gap
        own = (least & np.uint64((1 << 20) - 1)).view(np.int64)[:hi - lo]
        names = doubled(short, w, shape.gram)[:hi - lo]
        a, b, doc = _spans(own, offsets, lo, hi, w)
        if not len(a):
            continue
        shift = ((b - a) * 4096 + (own[a] - a)).astype(np.uint64)
        name = mix(names[a] * M1 + mix(names[b] + shift * M2))
        parts.append((a + lo, b + lo, name, mix(grams[own[a]] + M3), doc))
    if not parts:
        parts = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),)]
    return Contexts(*(np.concatenate(x) for x in zip(*parts)))


def _spans(own: np.ndarray, offsets: np.ndarray, lo: int, hi: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window (from ``lo``) of each run of windows with one
    anchor inside one document, and the document."""
    first, last = int(np.searchsorted(offsets, lo, side="right")) - 1, int(np.searchsorted(offsets, hi, side="left"))
    docs = np.arange(first, max(first + 1, last))
    start = np.maximum(offsets[docs], lo) - lo
    end = np.minimum(offsets[docs + 1] - w + 1, hi) - lo  # windows of a document: start to end
    docs, start, end = (x[end > start] for x in (docs, start, end))
    if not len(docs):
        return (np.zeros(0, np.int64),) * 3
    cut = np.zeros(hi - lo + 1, bool)
    cut[1:-1] = own[1:] != own[:-1]
    cut[start] = cut[end] = True
    at = np.flatnonzero(cut)
    of = np.searchsorted(start, at, side="right") - 1
    inside = (of >= 0) & (at < end[np.maximum(of, 0)])
    k = np.flatnonzero(inside)
    return at[k], at[k + 1] - 1, docs[of[k]]


def window_names(symbols: Callable[[int, int], np.ndarray], starts: np.ndarray, shape: Shape) -> np.ndarray:
    """Final names of the windows that start at ``starts`` (ascending)."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        lo = int(starts[at])
        to = int(np.searchsorted(starts, lo + _STEP))
        names = doubled(symbols(lo, int(starts[to - 1]) + shape.window), shape.window)
        out[at:to] = mix(names[starts[at:to] - lo] + M2)
        at = to
    return out


def least_ids(names: np.ndarray, ids: np.ndarray, *also: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each distinct name once with its smallest id (and what goes with it)."""
    order = np.lexsort((ids, names))
    names, ids = names[order], ids[order]
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    return (names[new], ids[new], *(x[order][new] for x in also))


def _bytes(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unbytes(data, width: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view(np.uint64).reshape(-1)


_SEND = "bucket int, block int, ids binary, counts binary, keys binary, names binary"


def _send(block: int, bucket: np.ndarray, ids: np.ndarray, keys: np.ndarray | None, names: np.ndarray) -> pa.RecordBatch:
    """One row per bucket; ids as runs, keys in 5 bytes, names in 8."""
    order = np.lexsort((ids, bucket))
    bucket, ids, names = bucket[order], ids[order], names[order]
    keys = None if keys is None else keys[order]
    cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        runs = np.append(np.flatnonzero(np.diff(ids[a:b], prepend=ids[a] - 1 if ids[a] > -(1 << 62) else 0)), b - a) if b > a else np.zeros(1, int)
        runs = runs if runs[0] == 0 else np.append(0, runs)
        rows.append((int(bucket[a]), block, ids[a:b][runs[:-1]].tobytes(), np.diff(runs).astype(np.uint32).tobytes(),
                     b"" if keys is None else _bytes(keys[a:b], 5), _bytes(names[a:b], 8)))
    kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows) if rows else [[]] * 6, kinds)],
                                      names=["bucket", "block", "ids", "counts", "keys", "names"])


def _received(table: pa.Table) -> tuple[np.ndarray, ...]:
    """(block, id, key, name) of all entries of a bucket."""
    cols = {c: table.column(c).to_pylist() for c in ("block", "ids", "counts", "keys", "names")}
    names = _unbytes(b"".join(cols["names"]), 8)
    keys = _unbytes(b"".join(cols["keys"]), 5)
    ids = np.repeat(np.frombuffer(b"".join(cols["ids"]), np.int64), np.frombuffer(b"".join(cols["counts"]), np.uint32))
    block = np.repeat(np.array(cols["block"], np.int32), [len(x) // 8 for x in cols["names"]])
    return block, ids, keys, names


_REPLY = "block int, kind int, names binary"


def _replies(block: np.ndarray, kind: int, names: np.ndarray) -> list[tuple]:
    order = np.argsort(block, kind="stable")
    block, names = block[order], names[order]
    cuts = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(block))
    return [(int(block[a]), kind, np.unique(names[a:b]).tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]


def _table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[], [], []]
    return pa.table({"block": pa.array(cols[0], pa.int32()), "kind": pa.array(cols[1], pa.int32()), "names": pa.array(cols[2], pa.binary())})


SETTLED, OPEN, EARLIER = 0, 1, 2


def _judge_contexts(table: pa.Table) -> pa.Table:
    """Rounds 1 and 2 for one bucket of anchors."""
    block, ids, keys, names = _received(table)
    order = np.lexsort((ids, names, keys))
    block, ids, keys, names = block[order], ids[order], keys[order], names[order]
    new_key = np.append(True, keys[1:] != keys[:-1])
    new_name = new_key | np.append(True, names[1:] != names[:-1])
    name_at, key_at = np.flatnonzero(new_name), np.flatnonzero(new_key)
    of_name = np.cumsum(new_name) - 1
    least = ids[name_at][of_name]  # the smallest document with this context
    settled = ids > least
    of_key = np.cumsum(new_key) - 1
    low, high = np.minimum.reduceat(least, key_at), np.maximum.reduceat(least, key_at)
    still = ~settled & (low < high)[of_key]  # one anchor, several contexts, several documents
    return _table(_replies(block[settled], SETTLED, names[settled]) + _replies(block[still], OPEN, names[still]))


def _judge_windows(table: pa.Table) -> pa.Table:
    """Round 3 for one bucket of windows."""
    block, ids, _, names = _received(table)
    order = np.lexsort((ids, names))
    block, ids, names = block[order], ids[order], names[order]
    new = np.append(True, names[1:] != names[:-1])
    earlier = ids > ids[new][np.cumsum(new) - 1]
    return _table(_replies(block[earlier], EARLIER, names[earlier]))


class Block:
    """The documents of one block and their contexts."""

    def __init__(self, table: pa.Table, shape: Shape, sequence: Callable):
        self.shape = shape
        self.ids = ids_of(table.column("doc_id"))
        self.no_id = np.asarray(table.column("doc_id").is_null())  # the largest long is an id too
        self.buf, self.offsets = buffers(table.column("data"))
        self.sequence = sequence(self.buf, self.offsets)
        self.contexts = contexts(self.sequence.symbols, self.sequence.offsets, shape)

    def least(self) -> tuple[np.ndarray, ...]:
        """Distinct contexts: name, smallest id here, anchor."""
        c = self.contexts
        return least_ids(c.name, self.ids[c.doc], c.key)

    def open(self, names: np.ndarray, ids: np.ndarray, still: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the open contexts in their smallest document: first and last
        window, id."""
        c = self.contexts
        at = np.searchsorted(names, c.name)
        take = np.isin(c.name, still) & (self.ids[c.doc] == ids[np.minimum(at, max(0, len(ids) - 1))] if len(ids) else False)
        return c.first[take], c.last[take], self.ids[c.doc][take]

    def windows(self, still: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, name and document id of each open window."""
        names, ids, _ = self.least()
        first, last, doc = self.open(names, ids, still)
        n = last - first + 1
        starts = np.repeat(first - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(int(n.sum()))
        return starts, window_names(self.sequence.symbols, starts, self.shape), np.repeat(doc, n)

    def covered(self, settled: np.ndarray, still: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First window and end (exclusive, in symbols) of all that is
        covered, ascending by start."""
        c, w = self.contexts, self.shape.window
        names, ids, _ = self.least()
        here = ids[np.searchsorted(names, c.name)] if len(names) else np.zeros(0, np.int64)
        whole = (self.ids[c.doc] > here) | np.isin(c.name, settled)
        starts, win, doc = self.windows(still)
        if len(win):
            known, least = least_ids(win, doc)
            hit = (doc > least[np.searchsorted(known, win)]) | np.isin(win, earlier)
            starts = starts[hit]
        lo = np.concatenate([c.first[whole], starts])
        hi = np.concatenate([c.last[whole] + w, starts + w])
        order = np.argsort(lo, kind="stable")
        return lo[order], hi[order]


def runs(lo: np.ndarray, hi: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge overlapping or touching ranges of one document (ascending by
    ``lo``)."""
    if not len(lo):
        return lo, hi
    high = np.maximum.accumulate(hi)
    doc = np.searchsorted(offsets, lo, side="right")
    new = np.append(True, (lo[1:] > high[:-1]) | (doc[1:] != doc[:-1]))
    at = np.flatnonzero(new)
    return lo[at], high[np.append(at[1:], len(lo)) - 1]


def _names_of(table: pa.Table, kind: int) -> np.ndarray:
    if table is None or not table.num_rows:
        return np.zeros(0, np.uint64)
    parts = [x for k, x in zip(table.column("kind").to_pylist(), table.column("names").to_pylist()) if k == kind]
    return np.unique(np.frombuffer(b"".join(parts), np.uint64))


def remove_repeats(docs: DataFrame, shape: Shape, sequence: Callable, finish: Callable, schema: str,
                   id_col: str = "doc_id", text_col: str = "text", per_symbol_bytes: int = 1,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``finish(block, lo, hi)`` makes the result table of a block from the
    merged covered ranges (in symbols)."""
    src = documents_of(docs, id_col, text_col)
    size = total_bytes(src)
    n_blocks = max(1, -(-size // block_bytes))
    n_buckets = max(1, size * 2 // (per_symbol_bytes * (shape.reach + 1) * BUCKET_ENTRIES))
    blocks = with_block(src, n_blocks)

    def anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        b = Block(table, shape, sequence)
        names, ids, keys = b.least()
        bucket = ((keys >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.int64)
        return pa.Table.from_batches([_send(key[0].as_py(), bucket, ids, keys, names)])

    def windows(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        still = _names_of(replies, OPEN)
        if not table.num_rows or not len(still):
            return pa.Table.from_batches([_send(0, *[np.zeros(0, np.int64)] * 2, None, np.zeros(0, np.uint64))])
        _, win, doc = Block(table, shape, sequence).windows(still)
        names, ids = least_ids(win, doc)
        bucket = ((names >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.int64)
        return pa.Table.from_batches([_send(key[0].as_py(), bucket, ids, None, names)])

    def result(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return finish(None, None, None)
        b = Block(table, shape, sequence)
        lo, hi = b.covered(*(_names_of(replies, k) for k in (SETTLED, OPEN, EARLIER)))
        return finish(b, *runs(lo, hi, b.sequence.offsets))

    sent = blocks.groupBy("block").applyInArrow(anchors, _SEND)
    judged = materialise(sent.groupBy("bucket").applyInArrow(_judge_contexts, _REPLY))
    del sent
    release(docs.sparkSession)
    still = judged.where(F.col("kind") == OPEN)
    sent = blocks.groupBy("block").cogroup(still.groupBy("block")).applyInArrow(windows, _SEND)
    earlier = materialise(sent.groupBy("bucket").applyInArrow(_judge_windows, _REPLY))
    del sent
    release(docs.sparkSession)
    return blocks.groupBy("block").cogroup(judged.union(earlier).groupBy("block")).applyInArrow(result, schema)


def each_document(b: Block, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Index of each document and the slice of covered ranges in it."""
    off = b.sequence.offsets
    a = np.searchsorted(lo, off[:-1], side="left")
    z = np.searchsorted(lo, off[1:], side="left")
    for i in range(len(off) - 1):
        yield i, slice(int(a[i]), int(z[i]))
