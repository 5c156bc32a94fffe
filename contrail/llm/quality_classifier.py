"""Operator 10, quality classifier: supervised subword embeddings.

A document's features are its hashed words, word pairs and character n-grams
(within words, a boundary on each side).  Each feature has a learned vector;
a document is the mean of its features' vectors, and a softmax layer turns it
into two class probabilities.  Vectors and layer are trained together by plain
mini-batch stochastic gradient descent in numpy.

Training takes at most ``max_train_rows`` labelled rows (those with the
least hash of the id), whose features are counted by Spark and go to one
bounded task.  Scoring reads every document whole: as the layer is linear in the
mean, each feature carries one number, its vector times the layer, and the
model that tasks receive is one float per bucket.

Defined cases: null or empty text has no features and gets the prior of the
layer; labels that are null are ignored, of several labels of an id the largest
holds; without usable labels every score is 0.5; repeated rows are scored as
rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import BYTE_VALUES, M1, M2, M3, SEPARATORS, Words, batches, buffers, documents_of, mix


@dataclass(frozen=True)
class Settings:
    bucket_bits: int = 16
    size: int = 16
    grams: tuple[int, ...] = (3, 4)
    steps: int = 700
    rate: float = 20.0
    batch: int = 16
    seed: int = 5
    max_train_rows: int = 2000


def padded(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every separator as a space, and two spaces behind each document, so
    that no gram with letters on both sides crosses documents."""
    n = len(offsets) - 1
    out = np.full(len(buf) + 2 * n, 32, np.uint8)
    text = buf.copy()
    text[SEPARATORS[text]] = 32
    out[np.arange(len(buf)) + 2 * np.repeat(np.arange(n), np.diff(offsets))] = text
    return out, offsets + 2 * np.arange(n + 1)


def features(buf: np.ndarray, offsets: np.ndarray, s: Settings, chunk: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of (bucket of each feature, first feature of each document and
    the end)."""
    shift = np.uint64(64 - s.bucket_bits)
    words = Words(buf, offsets)
    h = words.hashes()
    yield (h * M1 >> shift).astype(np.int64), words.bounds
    pair = np.zeros(len(h), np.uint64)
    pair[:-1] = mix(h[:-1] * M2 + h[1:])
    pair[:-1][h[:-1] == h[1:]] = M3  # a word said twice is one feature, whichever word
    inside = np.ones(len(h), bool)
    last = words.bounds[1:][words.counts > 0] - 1
    inside[last] = False
    yield (pair[inside] * M1 >> shift).astype(np.int64), np.append(0, np.cumsum(np.maximum(words.counts - 1, 0)))
    text, ends = padded(buf, offsets)
    widest = max(s.grams)
    for lo in range(0, len(text), chunk):
        part = text[lo:lo + chunk + widest - 1]
        x, space = BYTE_VALUES[part], part == 32
        g, clear = x, np.ones(len(x), bool)
        for n in range(2, widest + 1):
            g = g[:-1] * M2 + x[n - 1:]
            clear = clear[:-1] & ~space[n - 2:-1] if n > 2 else clear[:-1]
            if n in s.grams:
                m = min(chunk, len(g))
                keep = np.flatnonzero(clear[:m])
                yield ((g[keep] + np.uint64(n)) * M3 >> shift).astype(np.int64), np.searchsorted(keep, np.clip(ends - lo, 0, m))


def counted(it: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Each training row as its distinct buckets and their shares."""
    for b in batches(it, "data", 1 << 20):
        found = list(features(*buffers(b.column("data")), s))
        both = [np.concatenate([np.repeat(np.arange(b.num_rows), np.diff(cut)) for _, cut in found]), np.concatenate([x for x, _ in found])]
        code, n = np.unique(both[0] << s.bucket_bits | both[1], return_counts=True)
        doc, bucket = code >> s.bucket_bits, (code & ((1 << s.bucket_bits) - 1)).astype(np.int32)
        cut = np.searchsorted(doc, np.arange(b.num_rows + 1))
        yield pa.RecordBatch.from_arrays([b.column("rank"), b.column("label"), pa.array([bucket[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary()),
                                          pa.array([(n[i:j] / max(1, n[i:j].sum())).astype(np.float32).tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary())],
                                         names=["rank", "label", "buckets", "shares"])


def train(labels: np.ndarray, buckets: list[np.ndarray], shares: list[np.ndarray], s: Settings) -> tuple[np.ndarray, float]:
    """The weight of each bucket and the bias, for the log odds of label 1."""
    rng = np.random.Generator(np.random.PCG64(s.seed))
    vectors = rng.uniform(-1 / s.size, 1 / s.size, (1 << s.bucket_bits, s.size)).astype(np.float32)
    layer, bias = np.zeros((s.size, 2), np.float32), np.zeros(2, np.float32)
    target = np.eye(2, dtype=np.float32)[labels]
    done = 0
    while done < s.steps:
        order = rng.permutation(len(labels))
        for at in range(0, len(order), s.batch):
            if done == s.steps:
                break
            rows = order[at:at + s.batch]
            sizes = np.array([len(buckets[i]) for i in rows])
            idx = np.concatenate([buckets[i] for i in rows])
            share = np.concatenate([shares[i] for i in rows])
            of = np.repeat(np.arange(len(rows)), sizes)
            mean = np.zeros((len(rows), s.size), np.float32)
            full = sizes > 0
            if len(idx):
                mean[full] = np.add.reduceat(vectors[idx] * share[:, None], np.append(0, np.cumsum(sizes[full])[:-1]))
            z = mean @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = (p - target[rows]) / len(rows)
            rate = s.rate * (1 - done / s.steps)
            back = error @ layer.T
            layer -= rate * mean.T @ error
            bias -= rate * error.sum(axis=0)
            np.subtract.at(vectors, idx, rate * share[:, None] * back[of])
            done += 1
    weights = vectors @ (layer[:, 1] - layer[:, 0])
    return weights.astype(np.float32), float(bias[1] - bias[0])


def _trained(it: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    rows = sorted((r for b in it for r in zip(*(b.column(c).to_pylist() for c in ("rank", "label", "buckets", "shares")))), key=lambda r: r[:3])
    if rows:
        w, b = train(np.array([r[1] for r in rows], np.int64), [np.frombuffer(r[2], np.int32) for r in rows], [np.frombuffer(r[3], np.float32) for r in rows], s)
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()), pa.array([b], pa.float64())], names=["weights", "bias"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", settings: Settings = Settings(),
        id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float]:
    """Train on the labelled documents given (callers leave held-out rows
    out)."""
    ids = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
           .groupBy("doc_id").agg(F.max("label").alias("label")))
    ids = ids.select("doc_id", "label", F.xxhash64("doc_id").alias("rank"))
    chosen = ids.orderBy("rank", "doc_id").limit(settings.max_train_rows)
    rows = documents_of(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("rank", "label", "data")  # broadcast: at most max_train_rows ids
    # ids that documents repeat must not pass the bound
    counts = rows.mapInArrow(lambda it: counted(it, settings), "rank long, label int, buckets binary, shares binary").orderBy("rank", "label", "buckets").limit(settings.max_train_rows)
    model = counts.coalesce(1).mapInArrow(lambda it: _trained(it, settings), "weights binary, bias double").collect()
    if not model:
        return np.zeros(1 << settings.bucket_bits, np.float32), 0.0
    return np.frombuffer(model[0]["weights"], np.float32), model[0]["bias"]


def log_odds(buf: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bias: float, s: Settings) -> np.ndarray:
    n_docs = len(offsets) - 1
    weights = weights.astype(np.float64)
    total, n = np.zeros(n_docs), np.zeros(n_docs)
    for bucket, cut in features(buf, offsets, s):
        size = np.diff(cut)
        full = np.flatnonzero(size)
        if len(full):
            total[full] += np.add.reduceat(weights[bucket], cut[full])
            n[full] += size[full]
    return total / np.maximum(n, 1) + bias


def quality_scores(docs: DataFrame, model: tuple[np.ndarray, float], settings: Settings = Settings(), cut: float = 0.3,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out (crc32 of the id as text is a
    multiple of 5), score (probability of label 1), predicted."""
    weights, bias = model

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, "data", 1 << 21):
            p = 1 / (1 + np.exp(-log_odds(*buffers(b.column("data")), weights, bias, settings)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p), pa.array((p >= cut).astype(np.int32))], names=["doc_id", "score", "predicted"])

    out = documents_of(docs, id_col, text_col).mapInArrow(score, "doc_id long, score double, predicted int")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")


def predict_kept(docs: DataFrame, model: tuple[np.ndarray, float], settings: Settings = Settings(), cut: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose score reaches ``cut``."""
    weights, bias = model

    def keep(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, text_col, 1 << 21):
            p = 1 / (1 + np.exp(-log_odds(*buffers(b.column(text_col)), weights, bias, settings)))
            yield b.filter(pa.array(p >= cut))

    return docs.mapInArrow(keep, docs.schema)


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
