"""Operator 9, MinHash near-dedup by a multi-index Hamming join.

Signature: ``n_symbols`` MinHash values of the word shingles, each cut to
``BITS`` bits.  Two texts of similarity s differ in a symbol with probability
1 - s, so ``max_errors`` symbols (4.5 standard deviations above the mean at the
threshold) is the signature distance within which every pair is found.

Multi-index: the signature is split into chunks, more than half as many as
``max_errors``.  By the pigeonhole principle one chunk of a pair within the
distance has at most one error, and that error is enumerated: each chunk
gives one key for each of its symbols left out.  So every pair within the
distance meets under some key.

Meeting documents are not expanded into pairs.  Texts of equal shingle sets are
one class from the start.  Every class is first tried with the smallest and
the largest class under its keys.  Keys whose classes are then still several
components are compared in cells of bounded size, inside the task: every class
outside the key's first component with all classes of other components within
the distance, each pair under its first key only; what leaves a task is at most
a link per class and component.  A link counts only if the full shingle sets say
so; components come from those links.

Defined cases: null, empty or blank text has no shingles and links with
nothing; fewer words than a shingle count as one shorter shingle; a null id
sorts last, and rows with a null id come back with a null id; repeated rows
come back as rows; rows of one id, or of none, with different texts are judged
each by its own text; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import M1, M2, M3, NULL_ID, Words, batches, buffers, connected_components, documents_of, ids_of, materialise, mix, release, text_key

BITS = 16
#: Rows of one key that a task compares at a time with the rest of the key.
CELL = 4000
_SEEDS = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def error_bound(threshold: float, n_symbols: int, deviations: float = 4.5) -> int:
    e = 1 - threshold
    return min(n_symbols - 1, ceil(n_symbols * e + deviations * sqrt(n_symbols * e * (1 - e))))


def chunk_sizes(n_symbols: int, max_errors: int) -> list[int]:
    """Chunks so many that one of them has at most one error."""
    n = max_errors // 2 + 1
    return [n_symbols // n + (i < n_symbols % n) for i in range(n)]


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each document, and the offset of
    each document's first."""
    h, n = words.hashes(), words.counts
    at, lo = np.arange(len(h)), words.bounds[:-1]
    doc = np.repeat(np.arange(words.n_docs), n)
    x = np.zeros(len(h), np.uint64)
    for k in range(min(width, len(h))):
        x[:len(h) - k] = x[:len(h) - k] * M1 + h[k:]
    x = mix(x)
    full = at + width <= words.bounds[1:][doc]
    for i in np.flatnonzero((n > 0) & (n < width)):  # a short text is one shingle
        y = np.full(1, 1 + n[i], np.uint64)
        for k in range(lo[i], lo[i] + n[i]):
            y = mix(y * M2 + h[k:k + 1])
        x[lo[i]], full[lo[i]] = y[0], True
    x, doc = x[full], doc[full]
    order = np.lexsort((x, doc))
    x, doc = x[order], doc[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])
    x, doc = x[new], doc[new]
    return x, np.searchsorted(doc, np.arange(words.n_docs + 1))


def signatures(x: np.ndarray, offsets: np.ndarray, n_symbols: int, chunk: int = 1 << 16) -> np.ndarray:
    """One row of ``n_symbols`` 16-bit symbols for each document (0 without
    shingles)."""
    full = np.flatnonzero(np.diff(offsets))
    out = np.zeros((len(offsets) - 1, n_symbols), np.uint16)
    at = 0
    while at < len(full):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[full[at]] + chunk)) - 1)
        rows = full[(full >= full[at]) & (full < max(to, full[at] + 1))] if to > full[at] else full[at:at + 1]
        lo, hi = int(offsets[rows[0]]), int(offsets[rows[-1] + 1])
        starts = offsets[rows] - lo
        for k in range(n_symbols):
            v = (x[lo:hi] ^ _SEEDS[k]) * _SEEDS[128 + k]
            out[rows, k] = (mix(np.minimum.reduceat(v, starts)) & np.uint64(0xFFFF)).astype(np.uint16)
        at += len(rows)
    return out


def _sketch(sig: np.ndarray) -> np.ndarray:
    """The lowest bit of each symbol, as bytes: never more bits differ than
    symbols, so the signature's bound holds for it too."""
    return np.packbits((sig & 1).astype(np.uint8), axis=1)


def _signed(table: Iterator[pa.RecordBatch], width: int, n_symbols: int) -> Iterator[pa.RecordBatch]:
    for b in batches(table, "data"):
        x, off = shingles(Words(*buffers(b.column("data")), lower=True), width)
        sig = signatures(x, off, n_symbols)
        sums = np.zeros((2, len(off) - 1), np.uint64)
        full = np.flatnonzero(np.diff(off))
        if len(full):
            sums[0, full] = mix(np.add.reduceat(x, off[full]) + np.diff(off)[full].astype(np.uint64))
            sums[1, full] = mix(np.bitwise_xor.reduceat(mix(x + M3), off[full]))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array(np.diff(off), pa.int64()), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                                          pa.array([r.tobytes() for r in sig], pa.binary())], names=["doc_id", "text_key", "n_shingles", "set_a", "set_b", "sig"])


def _keys(it: Iterator[pa.RecordBatch], sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """For each row and each symbol left out of each chunk one key; ``place``
    numbers them."""
    for b in it:
        sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint16).reshape(b.num_rows, -1)
        packed = np.zeros((b.num_rows, 8), np.uint8)
        bits = _sketch(sig[:, :64])
        packed[:, :bits.shape[1]] = bits
        sketch = pa.array(packed.view(np.int64)[:, 0])
        at = place = 0
        for size in sizes:
            part = sig[:, at:at + size].astype(np.uint64)
            for out in range(size) if size > 1 else [-1]:
                key = np.full(b.num_rows, place + 1, np.uint64)
                for k in range(size):
                    if k != out:
                        key = mix(key * M1 + part[:, k])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(b.num_rows, place, np.int32)), b.column("rep"), b.column("component"), sketch],
                                                 names=["key", "place", "rep", "component", "sketch"])
                place += 1
            at += size


def _sets(it: Iterator[pa.RecordBatch], width: int, short: bool = False) -> Iterator[pa.RecordBatch]:
    for b in batches(it, "data", 1 << 21):
        x, off = shingles(Words(*buffers(b.column("data")), lower=True), width)
        items = [x[i:j].tobytes() if not short else np.unique((x[i:j] >> np.uint64(32)).astype(np.uint32)).tobytes() for i, j in zip(off[:-1], off[1:])]
        yield pa.RecordBatch.from_arrays([b.column("rep"), pa.array(items, pa.binary())], names=["rep", "items"])


def _confirmed(it: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for b in it:
        keep = []
        for x, y in zip(b.column("items_a"), b.column("items_b")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                keep.append(False)
                continue
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= percent * (len(both) - common))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _cell(table: pa.Table) -> tuple[np.ndarray, ...]:
    """A cell of one key: ids, components, signatures, which rows are
    queries, and the place of the key."""
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(table.num_rows, -1)
    return ids_of(table.column("rep")), ids_of(table.column("component")), sig, np.asarray(table.column("query").to_numpy(zero_copy_only=False), bool), int(table.column("place")[0].as_py())


def _meet_first(sig: np.ndarray, one: np.ndarray, sizes: list[int], place: int) -> np.ndarray:
    """Is ``place`` the first key under which the rows meet the signature?
    So that a pair is tried under one of its keys only."""
    differ = sig != one
    first = np.full(len(sig), 1 << 30)
    at, number = 0, 0
    for size in sizes:
        part = differ[:, at:at + size]
        errors = part.sum(axis=1)
        step = size if size > 1 else 1
        meets = np.where(errors == 0, number, np.where((errors == 1) & (size > 1), number + part.argmax(axis=1), 1 << 30))
        first = np.minimum(first, meets)
        at, number = at + size, number + step
    return first == place


def _candidates(table: pa.Table, sizes: list[int], bound: int):
    """Yields each query row with the rows of other components within the
    distance that it meets here first."""
    rep, comp, sig, query, place = _cell(table)
    packed = np.zeros((len(rep), 8), np.uint8)
    bits = _sketch(sig[:, :64])
    packed[:, :bits.shape[1]] = bits
    sketch = packed.view(np.uint64)[:, 0]
    base = np.flatnonzero(~query)
    for q in np.flatnonzero(query):
        near = base[(np.bitwise_count(sketch[base] ^ sketch[q]) <= bound) & (comp[base] != comp[q])]
        near = near[np.count_nonzero(sig[near] != sig[q], axis=1) <= bound]
        if len(near):
            near = near[_meet_first(sig[near], sig[q], sizes, place)]
            if len(near):
                yield q, near, rep, comp


def _participants(sizes: list[int], bound: int):
    """The rows of a cell that have a candidate there: at most its rows."""

    def cell(table: pa.Table) -> pa.Table:
        hit = np.zeros(table.num_rows, bool)
        for q, near, _, _ in _candidates(table, sizes, bound):
            hit[q] = True
            hit[near] = True
        return table.filter(pa.array(hit))

    return cell


def _links(sizes: list[int], bound: int, percent: int):
    """Confirmed candidates of a cell, one per query row and other
    component.  Sets come as 32-bit items; the caller confirms on full ones,
    so a unit of percent is left for equal items by chance."""

    def cell(table: pa.Table) -> pa.Table:
        raw = [np.frombuffer(x, np.uint32) for x in table.column("items").to_pylist()]
        size = np.array([len(x) for x in raw])
        known, dense = np.unique(np.concatenate(raw), return_inverse=True)
        first = np.append(0, np.cumsum(size))
        mark, found = np.zeros(len(known), np.int32), []
        for q, near, rep, comp in _candidates(table, sizes, bound):
            own = dense[first[q]:first[q + 1]]
            mark[own] = 1
            at = np.concatenate([dense[first[i]:first[i + 1]] for i in near])
            common = np.add.reduceat(mark[at], np.append(0, np.cumsum(size[near])[:-1]))
            mark[own] = 0
            share = common / np.maximum(1, size[near] + size[q] - common)
            sure: set[int] = set()
            for k in np.argsort(-share, kind="stable"):  # surely a link: one per component; at the edge: all
                if 100 * share[k] < percent - 1:
                    break
                i = near[k]
                if int(comp[i]) not in sure:
                    found.append((min(int(rep[q]), int(rep[i])), max(int(rep[q]), int(rep[i]))))
                    if 100 * share[k] >= percent + 1:
                        sure.add(int(comp[i]))
        keep = sorted(set(found))
        cols = list(zip(*keep)) if keep else [[], []]
        return pa.table({"a": pa.array(cols[0], pa.int64()), "b": pa.array(cols[1], pa.int64())})

    return cell


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, n_symbols: int = 64,
                    id_col: str = "doc_id", text_col: str = "text", with_key: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id
    reachable over links of at least ``percent`` similarity), kept (doc_id =
    component_id; of rows that repeat an id, each); ``with_key`` adds text_key
    (as ``text_key`` gives it), to join rows of one id and different texts."""
    src = documents_of(docs, id_col, text_col).withColumn("text_key", text_key(F.col("data")))
    bound = error_bound(percent / 100, n_symbols)
    sizes = chunk_sizes(n_symbols, bound)
    signed = materialise(src.mapInArrow(lambda it: _signed(it, shingle_words, n_symbols),
                                        "doc_id long, text_key long, n_shingles long, set_a long, set_b long, sig binary"))
    release(docs.sparkSession)
    # classes of equal sets, named by the set's digest; the smallest row (id, then text) gives the class its text
    classes = materialise(signed.where("n_shingles > 0").groupBy("set_a", "set_b")
                          .agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), "text_key")).alias("row"), F.first("sig").alias("sig"))
                          .select("set_a", "set_b", F.col("set_a").alias("rep"), "row.id", "row.text_key", "sig"))
    one = classes.select("rep", "sig")
    release(docs.sparkSession)
    key_schema = "key long, place int, rep long, component long, sketch long"
    keys = one.withColumn("component", F.col("rep")).mapInArrow(lambda it: _keys(it, sizes), key_schema).select("key", "rep", "sketch")
    # 1: the smallest and the largest class under each key are hubs
    hub = keys.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    met = keys.join(hub, "key")
    met = met.where("rep != lo").select("rep", "sketch", F.col("lo").alias("hub")).union(met.where("rep != hi").select("rep", "sketch", F.col("hi").alias("hub"))).distinct()
    sketches = one.withColumn("component", F.col("rep")).mapInArrow(lambda it: _keys(it, [n_symbols]), key_schema).where("place = 0").select(F.col("rep").alias("hub"), F.col("sketch").alias("hub_sketch"))
    errors = F.expr("bit_count(sketch ^ hub_sketch)")
    star = materialise(met.join(sketches, "hub").where(errors <= bound).groupBy(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).agg(F.min(errors).alias("errors")))
    release(docs.sparkSession)
    texts = src.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), "text_key", "data")

    def sets_of(ids: DataFrame, short: bool = False) -> DataFrame:
        # the ids grow with the documents: never broadcast them, whatever their size is today
        rows = classes.select("rep", "id", "text_key").join(ids.hint("merge"), "rep", "left_semi")
        # one text of a class, also where its row is repeated; the join has brought equal rows together
        one_text = texts.join(rows.hint("merge"), ["id", "text_key"]).groupBy("id", "text_key").agg(F.first("rep").alias("rep"), F.first("data").alias("data"))
        return materialise(one_text.mapInArrow(lambda it: _sets(it, shingle_words, short), "rep long, items binary"))

    def confirm(pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets reach the threshold."""
        sets = sets_of(pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))).distinct())
        both = (pairs.join(sets.select(F.col("rep").alias("b"), F.col("items").alias("items_b")), "b")
                .join(sets.select(F.col("rep").alias("a"), F.col("items").alias("items_a")), "a"))
        out = materialise(both.select("a", "b", "items_a", "items_b").mapInArrow(lambda it: _confirmed(it, percent), "a long, b long").distinct())
        release(docs.sparkSession)
        return out

    def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        la, lb = labels.toDF("a", "ca"), labels.toDF("b", "cb")
        return pairs.join(la, "a", "left").join(lb, "b", "left").where("coalesce(ca, a) != coalesce(cb, b)").select("a", "b")

    def joined(links: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        if not pairs.limit(1).count():
            return links, None
        more = confirm(pairs)
        return (links.union(more), connected_components(links.union(more))) if more.limit(1).count() else (links, None)

    # each class with its nearest hub, then with the hubs it is still apart from
    tried = materialise(star.groupBy("b").agg(F.min(F.struct("errors", "a")).alias("m")).select(F.col("m.a").alias("a"), "b"))
    links = confirm(tried)
    labels = connected_components(links)
    links, new = joined(links, materialise(apart(star.join(tried, ["a", "b"], "left_anti"), labels)))
    labels = new if new is not None else labels
    # 2: keys whose classes are still several components.  All rows are base, in cells of CELL rows; the rows outside the
    # key's first component are queries against each cell
    labelled = one.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("rep", F.coalesce("component", "rep").alias("component"), "sig")
    keyed = labelled.mapInArrow(lambda it: _keys(it, sizes), key_schema).select("key", "place", "rep", "component")
    mixed = keyed.groupBy("key").agg(F.min("component").alias("first"), F.max("component").alias("last"), F.count("*").alias("n")).where("first < last")
    rows = keyed.join(mixed, "key").withColumn("cells", F.ceil(F.col("n") / CELL).cast("int")).join(one, "rep")
    cols = ["key", "cell", "place", "rep", "component", "sig", "query"]
    base = rows.withColumn("cell", F.pmod(F.xxhash64("rep"), F.col("cells")).cast("int")).withColumn("query", F.lit(False)).select(*cols)
    query = rows.where("component != first").withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).withColumn("query", F.lit(True)).select(*cols)
    cell_schema = "key long, cell int, place int, rep long, component long, sig binary, query boolean"
    part = materialise(base.union(query).groupBy("key", "cell").applyInArrow(_participants(sizes, bound), cell_schema))
    release(docs.sparkSession)
    if part.limit(1).count():
        with_sets = part.join(sets_of(part.select("rep").distinct(), short=True), "rep").select(*cols, "items")
        found = materialise(with_sets.groupBy("key", "cell").applyInArrow(_links(sizes, bound, percent), "a long, b long").distinct())
        release(docs.sparkSession)
        links, new = joined(links, found)
        labels = new if new is not None else labels
    # ids only name components: the smallest one of all rows in it
    named = classes.select("set_a", "set_b", "rep", "id").join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("set_a", "set_b", "id", F.col("component"))
    names = named.where("component is not null").groupBy("component").agg(F.min("id").alias("name"))
    class_of = named.join(names, "component", "left").select("set_a", "set_b", F.coalesce("name", "id").alias("c"))
    out = signed.join(class_of, ["set_a", "set_b"], "left")
    c = F.when(F.col("n_shingles") > 0, F.col("c")).otherwise(F.coalesce("doc_id", F.lit(NULL_ID)))
    c = F.when(c == NULL_ID, F.lit(None)).otherwise(c).cast("long")
    kept = F.coalesce("doc_id", F.lit(NULL_ID)).eqNullSafe(F.coalesce(c, F.lit(NULL_ID)))
    return out.select("doc_id", "n_shingles", c.alias("component_id"), kept.alias("kept"), *["text_key"] * with_key)
