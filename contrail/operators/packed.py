"""Rows packed for ``boosting``: bins of several features in one code, in blocks, and
the work of one pass over them.  Kept apart from the fit so that a worker
imports no more than numpy and Arrow for it."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_ROWS = 1 << 17
#: Cells of one code at most, so that the counts of 16 nodes stay in the cache.
CODE_CELLS = 1 << 13
#: A row's way through a tree is one word: a bit for each of its 31 splits.
MAX_DEPTH = 5


@dataclass(frozen=True)
class Layout:
    """Where the features of a row are: for each feature its thresholds (a value
    up to the i-th lies in bin i), and for each code its features and their steps."""
    thresholds: tuple[np.ndarray, ...]
    codes: tuple[tuple[tuple[int, int], ...], ...]

    @classmethod
    def of(cls, thresholds) -> Layout:
        bins = [len(t) + 1 for t in thresholds]
        codes: list[list[int]] = []
        for f in sorted((f for f, n in enumerate(bins) if n > 1), key=lambda f: -bins[f]):
            fits = [c for c in codes if math.prod(bins[g] for g in c) * bins[f] <= CODE_CELLS]
            fits[0].append(f) if fits else codes.append([f])
        return cls(tuple(thresholds), tuple(tuple((f, math.prod(bins[g] for g in c[:i])) for i, f in enumerate(c)) for c in codes))

    def bins(self, f: int) -> int:
        return len(self.thresholds[f]) + 1

    def cells(self, code) -> int:
        return math.prod(self.bins(f) for f, _ in code)

    def starts(self) -> np.ndarray:
        """The first place of each feature in a row of histograms."""
        return np.concatenate([[0], np.cumsum([len(t) + 1 for t in self.thresholds])])


def packed(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[pa.RecordBatch]:
    def block(parts):
        x, y = (np.concatenate(p) for p in zip(*parts))
        codes = np.zeros((len(layout.codes), len(y)), np.uint16)
        for into, code in zip(codes, layout.codes):
            for f, step in code:
                into += (np.searchsorted(layout.thresholds[f], x[:, f]) * step).astype(np.uint16)
        return pa.RecordBatch.from_pydict({"codes": pa.array([codes.tobytes()], pa.binary()), "rest": pa.array([y.tobytes()], pa.binary())})

    parts, n = [], 0
    for b in batches:
        y = b.column(1).to_numpy(zero_copy_only=False)
        parts.append((b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1), y))
        n += len(y)
        if n >= BLOCK_ROWS:
            yield block(parts)
            parts, n = [], 0
    if n:
        yield block(parts)


def _arrays(blocks, layout: Layout):
    for codes, rest in blocks:
        rest = np.frombuffer(rest, np.float64)
        yield codes, np.frombuffer(codes, np.uint16).reshape(len(layout.codes), len(rest)), rest


def _nodes_at(depth: int, layout: Layout, splits: dict[int, tuple[int, int]]):
    """A function from the codes of a block to the place of each row in level
    ``depth``.  Splits are by heap number (feature, bin: up to it left); where there
    is none, rows go left."""
    tables = []
    for code in layout.codes:
        table = np.zeros(layout.cells(code), np.int64)
        at = np.arange(len(table))
        for f, step in code:
            bin_of = at // step % layout.bins(f)
            for s, (feature, last_left) in splits.items():
                if feature == f:
                    table |= (bin_of > last_left).astype(np.int64) << s
        tables.append(table)
    looked_up = min(depth, MAX_DEPTH - 1)
    above = (1 << looked_up) - 1  # splits above that level
    ways = np.arange(1 << above)
    place = np.zeros_like(ways)
    for _ in range(looked_up):
        place = 2 * place + 1 + (ways >> place & 1)
    place -= above

    def looked(table, at):  # the fastest form of a look-up: no index lies outside
        return table.take(at.astype(np.intp), mode="clip")

    def nodes(codes: np.ndarray) -> np.ndarray:
        if not depth:
            return np.zeros(codes.shape[1], np.int64)
        bits = looked(tables[0], codes[0])
        for table, code in zip(tables[1:], codes[1:]):
            bits |= looked(table, code)
        if depth == looked_up:
            return looked(place, bits)
        node = looked(place, bits & ((1 << above) - 1))
        return 2 * node + (bits >> (node + above) & 1)
    return nodes


def histograms(blocks, layout: Layout, splits, depth: int, last: bool):
    """Of the level ``depth``: rows, sums (and in the last one, sums of squares) by
    node, feature and bin; and sums of squares by node."""
    n = 1 << depth
    nodes = _nodes_at(depth, layout, splits)
    stats = 3 if last else 2
    totals = [np.zeros((stats, n * layout.cells(c))) for c in layout.codes]
    squares = np.zeros(n)
    for _, codes, rest in _arrays(blocks, layout):
        node, square = nodes(codes), rest * rest
        squares += np.bincount(node, square, n)
        for code, at, total in zip(layout.codes, codes, totals):
            place = node * layout.cells(code)
            place += at
            total[0] += np.bincount(place, minlength=total.shape[1])
            total[1] += np.bincount(place, rest, total.shape[1])
            if last:
                total[2] += np.bincount(place, square, total.shape[1])
    starts = layout.starts()
    out = np.zeros((stats, n, starts[-1]))
    for code, total in zip(layout.codes, totals):
        for f, step in code:
            out[:, :, starts[f]:starts[f + 1]] = total.reshape(stats, n, -1, layout.bins(f), step).sum(axis=(2, 4))
    yield out, squares


def learnt(blocks, layout: Layout, splits, depth: int, values: np.ndarray, weight: float, factor: float):
    """The blocks with what ``values`` (by place in level ``depth``) leave to learn."""
    nodes = _nodes_at(depth, layout, splits)
    for raw, codes, rest in _arrays(blocks, layout):
        yield raw, (factor * (rest - weight * values.take(nodes(codes), mode="clip"))).tobytes()


def added(a, b):
    return a[0] + b[0], a[1] + b[1]
