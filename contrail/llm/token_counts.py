"""Operator 6, token counts by a count-only Viterbi search.

The vocabulary is a list of pieces with scores; a text is split at spaces, each
segment starting with the space mark.  An Aho-Corasick automaton enumerates all
vocabulary matches in a segment; dynamic programming keeps, for each position,
the best score and the number of pieces of the best way there, and no way back.
Ties go as in the tokenizer library: at equal score the way whose last piece
starts first.  A character without a piece of its own length may be an unknown
(smallest score less 10), which byte fallback counts as its UTF-8 bytes.
Segments repeat, so a task remembers counts (a bounded memo).

Defined cases: null or empty text has 0 tokens; repeated rows are counted as
rows; a null id stays null; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
MEMO = 1 << 20


@lru_cache(maxsize=4)
def vocabulary(path: str) -> tuple[tuple[str, float], ...]:
    """Pieces and scores of a vocabulary file (by name among the public
    tokenizers, or a path)."""
    import public_tokenizers
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path if "/" in path else public_tokenizers.path(path))
    return tuple((p.id_to_piece(i), p.get_score(i)) for i in range(p.get_piece_size()))


class Counter:
    def __init__(self, pieces: tuple[tuple[str, float], ...]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(pieces).items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.singles = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.memo: dict[str, int] = {}

    def segment(self, text: str) -> int:
        n = len(text)
        if self.singles.issuperset(text):  # no unknowns: matches come by end, the longest first, so a tie keeps the first
            best, count = [0.0] + [float("-inf")] * n, [0] * (n + 1)
            for end, (size, score) in self.automaton.iter(text):
                at = end + 1 - size
                s = best[at] + score
                if s > best[end + 1]:
                    best[end + 1], count[end + 1] = s, count[at] + 1
            return count[n]
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        ways: dict[int, list[tuple[int, float]]] = {}
        for end, piece in self.automaton.iter(text):
            ways.setdefault(end + 1, []).append(piece)
        for end in range(1, n + 1):
            top, pieces, chosen = None, 0, n
            for size, score in ways.get(end, ()):
                at = end - size
                s = best[at] + score
                if top is None or s > top or (s == top and at < chosen):
                    top, pieces, chosen = s, count[at] + 1, at
            c = text[end - 1]
            if c not in self.singles:
                s = best[end - 1] + self.unknown
                if top is None or s > top:
                    top, pieces = s, count[end - 1] + len(c.encode("utf-8", "replace"))
            best[end], count[end] = top, pieces
        return count[n]

    def count(self, text: str) -> int:
        text = text.replace(MARK, " ")
        segments = text.split(" ")
        if text.startswith(" "):
            del segments[0]
        if not text:
            return 0
        memo, total = self.memo, 0
        for s in segments:
            k = memo.get(s)
            if k is None:
                k = self.segment(MARK + s)
                if len(memo) >= MEMO:
                    memo.clear()
                if len(s) <= 64:
                    memo[s] = k
            total += k
        return total


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, path: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, n_tokens."""

    def counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(vocabulary(path))
        counter = _COUNTERS[path]
        for b in it:
            texts = b.column("t").to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([counter.count(t) for t in texts], pa.int64())],
                                             names=["doc_id", "n_chars", "n_tokens"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    return src.mapInArrow(counts, "doc_id long, n_chars long, n_tokens long")
