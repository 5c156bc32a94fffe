"""Operator 8, substring dedup by seed and extend: words covered by a run of
``min_words`` consecutive words that also starts in a document with a smaller
id.

Method: seeds are winnowed anchors (the least hash of ``SEED_WORDS`` words in
each window).  Documents meet on equal seeds; a seed is extended both ways over
all windows that it anchors.  Where the surroundings of a seed are equal, the
extension is settled at once for the whole run; where they differ, it is
extended window by window to the exact place where the match ends.  Matches of
neighbouring seeds join to maximal repeats; shorter ones never arise, as a
window has ``min_words`` words.  Nothing is expanded into pairs: every entry
is compared with the smallest document of its group.

Defined cases: null text has no words; a text of fewer words than
``min_words`` loses nothing; documents of equal id never cost each other
anything; a null id sorts last, beside the largest long, and stays null;
repeated rows are kept as rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from contrail.llm.common import Words
from contrail.llm.repeats import Shape, each_document, remove_repeats

SEED_WORDS = 5


class WordSequence:
    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.words = Words(buf, offsets)
        self.offsets = self.words.bounds
        self.names = self.words.hashes()

    def symbols(self, lo: int, hi: int) -> np.ndarray:
        return self.names[lo:hi]


def substring_dedup(docs: DataFrame, min_words: int = 13, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (kept
    words joined by one space), repeats (first word and end of each maximal
    repeat); ``with_text`` adds kept (those words as text) and text_sha256 (of
    the whole text)."""
    shape = Shape(min_words, min(SEED_WORDS, min_words))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                        ("repeats", pa.list_(pa.list_(pa.int64())))] + [("kept", pa.string()), ("text_sha256", pa.string())] * with_text)

    def finish(b, lo, hi):
        rows = []
        if b is not None:
            w = b.sequence.words
            gone = np.zeros(len(w.starts) + 1, np.int32)
            np.add.at(gone, lo, 1)
            np.add.at(gone, hi, -1)
            kept = np.cumsum(gone[:-1]) == 0
            mask = np.zeros(len(b.buf) + 1, bool)  # the bytes of kept words and one separator behind each
            edge = np.zeros(len(b.buf) + 2, np.int32)
            edge[w.starts[kept]] += 1
            edge[w.ends[kept]] -= 1
            mask[:] = np.cumsum(edge[:-1]) > 0
            out = np.append(b.buf, np.uint8(32))
            behind = w.ends[kept]
            spaced = np.append(w.starts, len(b.buf) + 1)
            ok = np.flatnonzero(kept)
            free = spaced[ok + 1] > behind  # a word may touch the next document's first
            mask[behind[free]] = True
            out[behind[free]] = 32
            at = np.cumsum(mask)
            at = np.append(0, at)
            text = out[mask].tobytes()
            for i, s in each_document(b, lo, hi):
                a, z = int(w.bounds[i]), int(w.bounds[i + 1])
                n_kept = int(kept[a:z].sum())
                if n_kept:
                    k = np.flatnonzero(kept[a:z])
                    piece = text[at[w.starts[a + k[0]]]:at[w.ends[a + k[-1]]]]
                else:
                    piece = b""
                doc = int(b.ids[i])
                spans = [[x - a, y - a] for x, y in zip(lo[s].tolist(), hi[s].tolist())]
                rows.append((None if b.no_id[i] else doc, z - a, z - a - n_kept, hashlib.sha256(piece).hexdigest(), spans) + ((piece.decode("utf-8", "replace"), hashlib.sha256(b.buf[b.offsets[i]:b.offsets[i + 1]].tobytes()).hexdigest()) if with_text else ()))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)

    return remove_repeats(docs, shape, WordSequence, finish,
                          "doc_id long, n_words long, n_removed long, kept_sha256 string, repeats array<array<long>>" + ", kept string, text_sha256 string" * with_text, id_col, text_col, per_symbol_bytes=5)
