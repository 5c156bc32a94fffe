"""Operator 4, benchmark decontamination by template canonicalisation.

Texts become template tokens: runs of letters and digits, lower-cased, where a
number, a unit of measure or a name (a capitalised word that does not begin a
sentence) is a typed placeholder and equal neighbours of a placeholder are one.
Windows of ``WINDOW`` template tokens are joined by hash: a question whose
numbers, names or units were changed keeps its template.  Matches of an item
and a document are aligned; the slots inside must be consistent, that is, each
value of the item must stand for one value of the document throughout.  Each
alignment (a diagonal, or a chain of neighbouring ones) is judged alone, so that
a second copy, a passage that repeats itself or a stray match takes nothing away.

The benchmark's windows are the small side; they go to the tasks in slices of
at most ``SLICE`` windows, each a hash table of bounded size, and a larger
benchmark takes several passes over the documents.

A window of fewer than ``LEAST_LITERALS`` literal tokens is no template.  Items
with tokens outside all template windows are looked up by their plain tokens too
(windows of ``WINDOW``, values and all, under the same run and share).  Each
character of a script without spaces is a token.

Defined cases: null or empty text matches nothing; an item of fewer than
``WINDOW`` tokens is looked up whole; equal items are reported each; repeated rows are reported as rows;
empty tables give an empty result; null ids stay null; other columns are
ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import BYTE_VALUES, M1, M2, M3, _run_hashes, batches, buffers, documents_of, mix, text_key

WINDOW = 8
LEAST_LITERALS = 4
RUN = 13
SHARE = 0.5
SLICE = 1 << 20
LITERAL, NUMBER, UNIT, NAME = 0, 1, 2, 3
#: Units of measure (fixed values).
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons tonnes ml l liter liters litre litres gallon gallons "
         "s second seconds minute minutes hour hours day days week weeks month months year years percent degree degrees dollar dollars euro euros cent cents usd eur kmh mph").split()

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TOKEN = np.zeros(256, bool)
_TOKEN[48:58] = _TOKEN[65:91] = _TOKEN[97:123] = True
_TOKEN[128:] = True


def _characters(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the characters of scripts without spaces (UTF-8): Thai, Lao, Myanmar, Khmer, kana and Han."""
    a, b = buf, np.append(buf[1:], np.uint8(0))
    three = ((a >= 0xE3) & (a <= 0xE9)) | ((a == 0xE0) & (b >= 0xB8) & (b <= 0xBB)) | ((a == 0xE1) & ((b >= 0x80) & (b <= 0x82) | (b >= 0x9E) & (b <= 0x9F)))
    three |= (a == 0xEF) & ((b >= 0xA4) & (b <= 0xAB) | (b >= 0xBC) & (b <= 0xBD))
    four = (a == 0xF0) & (b >= 0xA0) & (b <= 0xAF)
    start = np.flatnonzero(three | four)
    return start, np.minimum(start + 3 + four[start], len(buf))


def _unit_hashes() -> np.ndarray:
    off = np.cumsum([0] + [len(u) for u in UNITS])
    return np.unique(_run_hashes(np.frombuffer("".join(UNITS).encode(), np.uint8), off[:-1], off[1:]))


_UNIT_HASHES = _unit_hashes()
_STOP = np.zeros(256, bool)
_STOP[[0x21, 0x2E, 0x3F, 0x0A, 0x3A, 0x22]] = True  # a sentence may begin behind these


class Template:
    """Template tokens of a run of documents: kind, name, value, document."""

    least = LEAST_LITERALS

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        n = len(buf)
        low = _LOWER[buf]
        if n > 1:  # capital letters of the Latin-1 block in UTF-8
            two = (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97) & (buf[:-1] == 0xC3)
            low[1:][two] += 0x20
        inside = np.append(_TOKEN[buf], False)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        for at in _characters(buf):
            edge[at] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:]
        start = np.flatnonzero(first)
        end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge[1:])) + 1
        bounds = np.searchsorted(start, offsets)
        hashes = np.empty(len(start), np.uint64)
        at = 0
        while at < len(start):
            to = max(at + 1, int(np.searchsorted(start, start[at] + (1 << 15))))
            lo, hi = int(start[at]), int(end[to - 1])
            hashes[at:to] = _run_hashes(low[lo:hi], start[at:to] - lo, end[at:to] - lo)
            at = to
        capital = ((buf[start] >= 65) & (buf[start] <= 90)) | (low[np.minimum(start + 1, n - 1)] != buf[np.minimum(start + 1, n - 1)]) & (buf[start] == 0xC3) if n else np.zeros(0, bool)
        stops = np.append(0, np.cumsum(_STOP[buf]))
        begins = np.ones(len(start), bool)
        begins[1:] = stops[start[1:]] > stops[end[:-1]]
        begins[bounds[:-1][bounds[:-1] < len(start)]] = True
        whole = np.append(0, np.cumsum((buf >= 97) & (buf <= 122)))
        shout = capital & (end - start > 1) & (whole[end] == whole[start])  # all capitals: no name
        kind = np.zeros(len(start), np.int8)
        kind[capital & ~begins & ~shout] = NAME
        kind[np.isin(hashes, _UNIT_HASHES)] = UNIT
        kind[(buf[start] >= 48) & (buf[start] <= 57)] = NUMBER
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        self.raw = (hashes, doc, bounds)
        # a unit needs its number in front
        unit = np.flatnonzero(kind == UNIT)
        alone = (unit == 0) | (kind[unit - 1] != NUMBER) | (doc[unit - 1] != doc[unit])
        kind[unit[alone]] = LITERAL
        head = np.ones(len(start), bool)
        head[1:] = (kind[1:] == LITERAL) | (kind[1:] != kind[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(head)
        place = np.arange(len(start)) - np.repeat(at, np.diff(np.append(at, len(start)))) if len(at) else np.zeros(0, int)
        value = np.add.reduceat(hashes * (M1 + (place.astype(np.uint64) << np.uint64(1))), at) if len(at) else hashes
        self.kind, self.doc = kind[at], doc[at]
        self.value = mix(value)
        self.name = np.where(self.kind == LITERAL, self.value, mix(self.kind.astype(np.uint64) * M3))
        self.bounds = np.searchsorted(self.doc, np.arange(len(offsets)))

    def exact(self) -> Template:
        """The same documents without placeholders: every token is a literal, every window says enough."""
        out = object.__new__(Template)
        out.name, out.doc, out.bounds = self.raw
        out.value, out.kind, out.least = out.name, np.zeros(len(out.name), np.int8), 0
        return out

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of each window that lies in one document and has
        enough literal tokens."""
        n = len(self.name) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.full(n, width, np.uint64)
        for k in range(width):
            h = h * M2 + self.name[k:k + n]
        literal = np.append(0, np.cumsum(self.kind == LITERAL))
        ok = (self.doc[:n] == self.doc[width - 1:]) & (literal[width:] - literal[:n] >= self.least)
        at = np.flatnonzero(ok)
        return at, mix(h[at])


class Index:
    """Windows of benchmark items: hash -> (item, place); ``below``: items with
    tokens in no window that has enough literals."""

    def __init__(self, template: Template, only: np.ndarray | None = None):
        self.template = t = template
        size = np.diff(t.bounds)
        self.tables = {}
        covered = np.zeros(len(t.name) + 1, np.int64)
        for w in sorted({int(w) for w in np.unique(np.minimum(size if only is None else size[only], WINDOW)) if w >= max(1, t.least)}):
            at, h = t.windows(w)
            own = (size[t.doc[at]] == w) if w < WINDOW else np.ones(len(at), bool)
            if only is not None:
                own &= only[t.doc[at]]
            np.add.at(covered, at[own], 1)
            np.add.at(covered, at[own] + w, -1)
            order = np.argsort(h[own], kind="stable")
            names, first = np.unique(h[own][order], return_index=True)
            bits = np.zeros(1 << 20, bool)
            bits[(names >> np.uint64(44)).astype(np.int64)] = True
            self.tables[w] = (names, np.append(first, own.sum()), at[own][order], bits)
        self.below = np.bincount(t.doc[np.cumsum(covered)[:-1] == 0], minlength=len(size)) > 0


class Benchmark:
    """Items by their templates, and those below the floor by their plain tokens too."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        raw = [(t or "").encode("utf-8", "replace") for _, t in items]
        self.ids = [i for i, _ in items]
        template = Template(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw]))
        self.template = Index(template)
        self.exact = Index(template.exact(), self.template.below)


class Alignment(NamedTuple):
    """Matches of an item and a document on one diagonal, or on several that
    are read as one: ``covered`` has a bit for each token of the item, ``pairs``
    the document's value of each slot (None: two values on one diagonal)."""

    start: int
    item_start: int
    end: int
    n_windows: int
    longest: int
    covered: int
    pairs: dict[tuple[int, int], int] | None

    def joined(self, other: Alignment) -> Alignment | None:
        """Both as one; None if a slot would have two values."""
        if self.pairs is None or other.pairs is None or any(self.pairs.get(k, v) != v for k, v in other.pairs.items()):
            return None
        return Alignment(min(self.start, other.start), min(self.item_start, other.item_start), max(self.end, other.end), self.n_windows + other.n_windows,
                         max(self.longest, other.longest), self.covered | other.covered, self.pairs | other.pairs)


def _alignment(t: Template, b_t: Template, doc_lo: int, item_lo: int, diagonal: int, hits: list[tuple[int, int]]) -> Alignment:
    """The matches (place, width) of one diagonal."""
    hits = sorted(set(hits))
    covered, longest, run_from, run_to = 0, 0, hits[0][0], hits[0][0]
    pairs: dict[tuple[int, int], int] | None = {}
    shift = doc_lo + diagonal - item_lo
    for p, w in hits:
        if p > run_to:
            run_from = p
        run_to = max(run_to, p + w)
        longest = max(longest, run_to - run_from)
        covered |= ((1 << w) - 1) << (p - doc_lo - diagonal)
        for k in range(p, p + w):
            kind = int(b_t.kind[k - shift])
            if kind != LITERAL and pairs is not None and pairs.setdefault((kind, int(b_t.value[k - shift])), int(t.value[k])) != int(t.value[k]):
                pairs = None
    return Alignment(hits[0][0], hits[0][0] - doc_lo - diagonal, run_to, len(hits), longest, covered, pairs)


def _together(parts: list[Alignment]) -> Alignment | None:
    """All diagonals as one, if every slot has one value in all of them."""
    out: Alignment | None = parts[0] if parts[0].pairs is not None else None
    for part in parts[1:]:
        out = out and out.joined(part)
    return out


def _best_chain(parts: list[Alignment], n: int) -> Alignment | None:
    """Of the consistent diagonals, alone or chained (later in the item and in
    the document, with at most the item's length of other text between two),
    the one that is a leak, or else covers most of the item."""
    parts = sorted((x for x in parts if x.pairs is not None), key=lambda x: (x.start, x.item_start))
    chains: list[Alignment] = []
    for i, part in enumerate(parts):
        best = part
        for j in range(i - 1, -1, -1):
            if part.start - parts[j].start > 2 * n:
                break
            if (parts[j].item_start < part.item_start and part.start - parts[j].end <= n
                    and (chains[j].covered | part.covered).bit_count() > best.covered.bit_count()):
                best = part.joined(chains[j]) or best
        chains.append(best)
    # a chain may be less than one of its ends: compare the diagonals too
    return max(chains + parts, key=lambda x: (_is_leak(x, n), x.covered.bit_count(), x.longest), default=None)


def _is_leak(x: Alignment, n: int) -> bool:
    return x.longest >= RUN or x.covered.bit_count() / n >= SHARE


def _best(t: Template, index: Index) -> dict[tuple[int, int], tuple[Alignment, int]]:
    """For each document and item that meet: the alignment that counts, and the item's tokens."""
    b_t = index.template
    found: dict[tuple[int, int], dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for w, (known, first, places, bits) in index.tables.items():
        at, h = t.windows(w)
        hit = np.flatnonzero(bits[(h >> np.uint64(44)).astype(np.int64)])
        at, h = at[hit], h[hit]
        k = np.searchsorted(known, h)
        hit = np.flatnonzero((k < len(known)) & (known[np.minimum(k, max(0, len(known) - 1))] == h)) if len(known) else np.zeros(0, int)
        for p, j in zip(at[hit].tolist(), k[hit].tolist()):
            doc = int(t.doc[p])
            for q in places[first[j]:first[j + 1]].tolist():
                item = int(b_t.doc[q])
                found[doc, item][(p - int(t.bounds[doc])) - (q - int(b_t.bounds[item]))].append((p, w))
    out = {}
    for (doc, item), diagonals in found.items():
        parts = [_alignment(t, b_t, int(t.bounds[doc]), int(b_t.bounds[item]), d, hits) for d, hits in diagonals.items()]
        n = int(b_t.bounds[item + 1] - b_t.bounds[item])
        best = _together(parts) or _best_chain(parts, n)
        if best is not None:
            out[doc, item] = best, n
    return out


def _matches(it: Iterator[pa.RecordBatch], index: Benchmark) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "item_id", "n_windows", "longest_run", "share", "n_slots", "n_changed", "consistent", "text_key"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
    for b in batches(it, "data", 1 << 21):
        t = Template(*buffers(b.column("data")))
        found = _best(t, index.template)
        if index.exact.tables:
            for pair, x in _best(t.exact(), index.exact).items():
                if pair not in found or not _is_leak(*found[pair]):
                    found[pair] = x
        rows, ids, keys = [], b.column("doc_id").to_pylist(), b.column("text_key").to_pylist() if "text_key" in b.schema.names else [None] * b.num_rows
        for (doc, item), (x, n) in sorted(found.items(), key=lambda f: f[0]):
            changed = sum(v != y for (_, y), v in x.pairs.items())
            rows.append((ids[doc], index.ids[item], x.n_windows, x.longest, x.covered.bit_count() / n, len(x.pairs), changed, True, keys[doc]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               with_key: bool = False) -> DataFrame:
    """One row per document and benchmark item in it: doc_id, item_id,
    n_windows, longest_run (template tokens), share (of the item's
    tokens; both of plain tokens, and no slots, where only those show it), n_slots, n_changed (slots with another value), consistent; all
    of the item's matches if they are consistent, else of its best alignment.  A
    leak has consistent slots and a run of ``RUN`` tokens or ``SHARE`` of the
    item.  ``with_key`` adds text_key, which with the id names the text that leaks."""
    src = documents_of(docs, id_col, text_col).withColumn("text_key", text_key(F.col("data")))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # a token and its separator are two bytes at least
    n = max(1, -(-size // (2 * SLICE)))
    schema = "doc_id long, item_id long, n_windows long, longest_run long, share double, n_slots long, n_changed long, consistent boolean, text_key long"
    out = None
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        index = docs.sparkSession.sparkContext.broadcast(Benchmark([tuple(r) for r in part.collect()]))  # a slice of bounded size
        found = src.mapInArrow(lambda it, index=index: _matches(it, index.value), schema)
        out = found if out is None else out.union(found)
    out = out.where(F.col("consistent") & ((F.col("longest_run") >= RUN) | (F.col("share") >= SHARE)))
    return out if with_key else out.drop("text_key")
