"""Operator 13, chat formatting into a prefix tree of token ids.

A turn is formatted by a ``Template``: control strings around the text, which is
escaped so that no control string can stand in it.  Conversations that share their
first turns share the nodes of those turns: a node is a turn behind a given
history, named by a digest chained along the conversation.  Every node's ids are
emitted once, in depth-first order over all trees; with

* ``start`` and ``until``: the node's ids lie from ``start`` on; ids of a node are
  seen by the positions from ``start`` to ``until`` (its subtree) and by no others,
  so an id at position p attends to the ancestors, whose intervals hold p;
* ``position``: the position id of its first id, counted along the conversation;
* ``loss_from`` and ``loss_to``: its ids under the loss mask (an assistant's text).

How it runs.  Rows are repartitioned by conversation and sorted; a stream carries
the chained digest, so a conversation of any length needs one batch.  Depth-first
order is one range sort of the nodes by the digests at the forks of their way
(histories with several continuations), then by depth: no rounds over depths, and
a tree that holds a third of all conversations is spread over many tasks.  Offsets
and subtree ends cross tasks through one number per task and fork level.  Joins on
nodes are salted by ``GROUPS`` groups of conversations: a node is copied only to
the groups that use it, so one common first turn never is one task's work.

Defined cases: null role or text is empty; rows of one turn (null turns first) are
ordered by role, then text; repeated rows are turns as well; a null id is one
conversation; an empty table gives empty tables; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import buffers, materialise
from contrail.llm.packing import Encoder

GROUPS = 64
_KEY = 16
_MEMO = 1 << 14


@dataclass(frozen=True)
class Template:
    """What stands before and after each role's text; other roles are spelled out."""
    begin: str = "<s>"
    turns: tuple[tuple[str, str, str], ...] = (("user", "[INST] ", " [/INST]"), ("assistant", " ", " </s>"), ("system", "<<SYS>>\n", "\n<</SYS>>\n\n"))
    other: tuple[str, str, str] = ("[ROLE] ", "\n", "[/ROLE]")
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
    learned: tuple[str, ...] = ("assistant",)

    def escape(self, text: str) -> str:
        """No control string is left: each gets a backslash behind its first
        character, backslashes are doubled."""
        out = text.replace("\\", "\\\\")
        for c in self.controls:
            out = out.replace(c, c[0] + "\\" + c[1:])
        return out

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\|n)?", lambda m: {None: "", "n": "\n"}.get(m[1], "\\"), text)

    def pieces(self, role: str, text: str, first: bool) -> tuple[str, str, str]:
        """What stands before the text, the escaped text, what follows it."""
        begin = self.begin if first else ""
        for name, before, after in self.turns:
            if name == role:
                return begin + before, self.escape(text), after
        return begin + self.other[0] + self.escape(role).replace("\n", "\\n") + self.other[1], self.escape(text), self.other[2]

    def parse(self, turn: str) -> tuple[str, str]:
        """Role and text of one formatted turn."""
        body = turn[len(self.begin):] if turn.startswith(self.begin) else turn
        if body.startswith(self.other[0]):
            role, _, rest = body[len(self.other[0]):].partition(self.other[1])
            return self.unescape(role), self.unescape(rest[:len(rest) - len(self.other[2])])
        for name, before, after in sorted(self.turns, key=lambda t: -len(t[1])):
            if body.startswith(before) and body.endswith(after):
                return name, self.unescape(body[len(before):len(body) - len(after)])
        raise ValueError("not a formatted turn")


LLAMA = Template()


@dataclass(frozen=True)
class Formatted:
    """``stored``: tree, node, parent, depth, conversations, start, until, position,
    n_tokens, loss_from, loss_to, tokens (ids as little-endian numbers of ``bytes_of``
    the vocabulary), groups (of conversations that use the node); ``nodes`` has
    ``token_ids`` in place of ``tokens``; ``paths``: named, conv_id, idx, node of every turn."""
    stored: DataFrame
    paths: DataFrame
    tokenizer: str

    @property
    def nodes(self) -> DataFrame:
        columns = ["token_ids" if c == "tokens" else c for c in self.stored.columns]
        types = dict(self.stored.dtypes) | {"token_ids": "array<int>"}
        tokenizer = self.tokenizer
        return self.stored.mapInArrow(lambda it: _ids(it, bytes_of(tokenizer)), ", ".join(f"{c} {types[c]}" for c in columns))


def bytes_of(tokenizer: str) -> str:
    """The number type that holds every id of a vocabulary."""
    return "<u2" if Encoder.of(tokenizer).encoding.n_vocab <= 1 << 16 else "<u4"


def _group() -> Column:
    return F.pmod(F.xxhash64("named", "conv_id"), F.lit(GROUPS)).cast("int")


_TURNS = "named boolean, conv_id long, idx int, node binary, parent binary, position long, n_tokens int, loss_from int, loss_to int, tokens binary"


def _chained(template: Template, tokenizer: str):
    """Sorted turns -> their nodes; a conversation's digest and position go from
    batch to batch."""
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, kind, memo = Encoder.of(tokenizer), bytes_of(tokenizer), {}
        width = int(kind[-1])

        def encoded(role: str, text: str, first: bool) -> tuple[bytes, int, int]:
            key = (role, text, first)
            if key not in memo:
                parts = [np.asarray(encoder.ids(p)).astype(kind) for p in template.pieces(role, text, first)]
                at = len(parts[0])
                to = at + len(parts[1]) if role in template.learned else at
                if len(memo) >= _MEMO:
                    memo.clear()
                if len(text) > 4096:
                    return np.concatenate(parts).tobytes(), at, to
                memo[key] = np.concatenate(parts).tobytes(), at, to
            return memo[key]

        now, idx, node, position = None, 0, b"", 0
        for b in it:
            out: list[tuple] = []
            size = 0
            for named, conv, role, text in zip(*(b.column(c).to_pylist() for c in ("named", "conv_id", "role", "text"))):
                if now != (named, conv):
                    now, idx, node, position = (named, conv), 0, b"", 0
                data, at, to = encoded(role, text, idx == 0)
                parent = node
                raw = role.encode()
                node = hashlib.blake2b(parent + len(raw).to_bytes(8, "little") + raw + text.encode(), digest_size=_KEY).digest()
                n = len(data) // width
                out.append((named, conv, idx, node, parent, position, n, at, to, data))
                idx, position, size = idx + 1, position + n, size + len(data) + 100
                if size > 1 << 23:
                    yield _batch(out)
                    out, size = [], 0
            if out:
                yield _batch(out)

    return task


_TURN_TYPES = [pa.bool_(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
_TURN_NAMES = [c.split()[0] for c in _TURNS.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TURN_TYPES)], _TURN_NAMES)


def _ways(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns with ``fork`` -> each node's way: the digests at its forks."""
    now, way = None, b""
    for b in it:
        ways = []
        for named, conv, node, fork in zip(*(b.column(c).to_pylist() for c in ("named", "conv_id", "node", "fork"))):
            if now != (named, conv):
                now, way = (named, conv), b""
            way = way + node if fork else way
            ways.append(way)
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(ways, pa.binary()), b.column("idx"), b.column("n_tokens")], ["node", "way", "depth", "n_tokens"])


def _numbered(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a sorted task: its number and the ids before each node in it."""
    from pyspark import TaskContext

    part, before = TaskContext.get().partitionId(), 0
    for b in it:
        n = np.asarray(b.column("n_tokens"), np.int64)
        ends = before + np.cumsum(n)
        before = int(ends[-1]) if len(ends) else before
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(n), part, np.int32)), pa.array(ends - n)], [*b.schema.names, "part", "at"])


def _layout(turns: DataFrame) -> DataFrame:
    """node -> tree, start, until, part: depth-first places."""
    forks = (turns.where("idx > 0").groupBy("parent").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.collect_set(_group()).alias("groups"))
             .where("a != b").select(F.col("parent").alias("k"), F.explode("groups").alias("g"), F.lit(True).alias("forked")))
    keys = turns.select("named", "conv_id", "idx", "node", "n_tokens", F.when(F.col("idx") == 0, F.col("node")).otherwise(F.col("parent")).alias("k"), _group().alias("g"))
    keys = keys.join(forks, ["k", "g"], "left").withColumn("fork", (F.col("idx") == 0) | F.coalesce("forked", F.lit(False)))
    ways = (keys.select("named", "conv_id", "idx", "node", "n_tokens", "fork").repartition("named", "conv_id").sortWithinPartitions("named", "conv_id", "idx")
            .mapInArrow(_ways, "node binary, way binary, depth int, n_tokens int"))
    nodes = ways.groupBy("node").agg(F.first("way").alias("way"), F.first("depth").alias("depth"), F.first("n_tokens").alias("n_tokens"))
    laid = materialise(nodes.repartitionByRange("way", "depth").sortWithinPartitions("way", "depth")
                       .mapInArrow(_numbered, "node binary, way binary, depth int, n_tokens int, part int, at long"))
    # one row per task, and one per task and level of forks
    base, total = {}, 0
    for r in sorted(laid.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()):
        base[r["part"]] = total
        total += r["n"]
    laid = laid.withColumn("level", (F.length("way") / _KEY).cast("int")).withColumn("head", F.expr(f"substring(way, length(way) - {_KEY - 1}, {_KEY}) = node"))
    heads: dict[int, list] = {}
    for r in laid.where("head").groupBy("part", "level").agg(F.min("at").alias("at")).collect():
        heads.setdefault(r["part"], []).append((base[r["part"]] + r["at"], r["level"]))
    open_after, stack = {}, []  # heads behind a task: the nearest last, each of a higher level than the one below it
    for part in sorted(base, reverse=True):
        open_after[part] = list(stack)
        for at, depth in sorted(heads.get(part, []), reverse=True):
            while stack and stack[-1][1] >= depth:
                stack.pop()
            stack.append((at, depth))

    def ends(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nodes of a task from the last to the first."""
        now, waiting = None, []
        for b in it:
            starts, untils = [], []
            for part, at, depth, is_head in zip(*(b.column(c).to_pylist() for c in ("part", "at", "level", "head"))):
                if part != now:
                    now, waiting = part, list(open_after[part])
                while waiting and waiting[-1][1] > depth:
                    waiting.pop()
                start = base[part] + at
                starts.append(start)
                untils.append(waiting[-1][0] if waiting else total)
                if is_head:
                    if waiting and waiting[-1][1] == depth:
                        waiting.pop()
                    waiting.append((start, depth))
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("tree"), b.column("part"), pa.array(starts, pa.int64()), pa.array(untils, pa.int64())],
                                             ["node", "tree", "part", "start", "until"])

    out = laid.select("node", F.substring("way", 1, _KEY).alias("tree"), "part", "at", "level", "head").repartition("part").sortWithinPartitions("part", F.desc("at"))
    return out.mapInArrow(ends, "node binary, tree binary, part int, start long, until long")


def _ids(it: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Binary ids as arrays of numbers."""
    for b in it:
        data, offsets = buffers(b.column("tokens"))
        ids = pa.ListArray.from_arrays(pa.array((offsets // int(kind[-1])).astype(np.int32)), pa.array(data.view(kind).astype(np.int32)))
        at = b.schema.names.index("tokens")
        yield pa.RecordBatch.from_arrays([ids if i == at else c for i, c in enumerate(b.columns)], ["token_ids" if i == at else n for i, n in enumerate(b.schema.names)])


def format_chats(convs: DataFrame, template: Template = LLAMA, tokenizer: str = "byte_bpe_50k.json") -> Formatted:
    """``conv_id, turn, role, text`` -> the prefix trees and each turn's node."""
    rows = convs.select(F.col("conv_id").isNotNull().alias("named"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0).cast("long")).alias("conv_id"),
                        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartition("named", "conv_id").sortWithinPartitions("named", "conv_id", F.asc_nulls_first("turn"), "role", "text")
    turns = materialise(rows.select("named", "conv_id", "role", "text").mapInArrow(_chained(template, tokenizer), _TURNS))
    fields = ["parent", "idx", "position", "n_tokens", "loss_from", "loss_to", "tokens"]
    nodes = turns.groupBy("node").agg(F.first(F.struct(*fields)).alias("v"), F.count("*").alias("conversations"), F.collect_set(_group()).alias("groups"))
    nodes = nodes.select("node", "v.*", "conversations", "groups").join(_layout(turns), "node")
    nodes = nodes.select("tree", "node", "parent", F.col("idx").alias("depth"), "conversations", "start", "until", "position", "n_tokens", "loss_from", "loss_to", "tokens", "groups", "part")
    laid = materialise(nodes.repartition("part").sortWithinPartitions("start").drop("part"))
    return Formatted(laid, turns.select("named", "conv_id", "idx", "node"), tokenizer)


def read_back(formatted: Formatted, template: Template = LLAMA) -> DataFrame:
    """The turns again, from the ids alone: named, conv_id, idx, role, text, loss (the
    text under the mask where it isn't the turn's), masked, n_chars."""
    tokenizer = formatted.tokenizer

    def decode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, kind = Encoder.of(tokenizer).encoding, bytes_of(tokenizer)
        for b in it:
            out = []
            for node, groups, data, at, to in zip(*(b.column(c).to_pylist() for c in ("node", "groups", "tokens", "loss_from", "loss_to"))):
                ids = np.frombuffer(data, kind).tolist()
                whole = encoding.decode_bytes(ids).decode()
                role, text = template.parse(whole)
                loss = template.unescape(encoding.decode_bytes(ids[at:to]).decode()) if to > at else ""
                out.append((node, groups, role, text, None if loss == text or not loss else loss, bool(loss), len(whole)))
            types = [pa.binary(), pa.list_(pa.int32()), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int32()]
            columns = list(zip(*out)) if out else [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["node", "groups", "role", "text", "loss", "masked", "n_chars"])

    texts = (formatted.stored.select("node", "groups", "tokens", "loss_from", "loss_to")
             .mapInArrow(decode, "node binary, groups array<int>, role string, text string, loss string, masked boolean, n_chars int"))
    texts = texts.withColumn("g", F.explode("groups")).drop("groups")
    return formatted.paths.withColumn("g", _group()).join(texts, ["node", "g"]).drop("node", "g")


_DIGESTS = "named boolean, conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(turns: DataFrame) -> DataFrame:
    """The turns of ``read_back`` -> one row per conversation: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars.  Digests are carried
    from batch to batch."""
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [c.split()[0] for c in _DIGESTS.split(", ")]
        make = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        now, whole, learned, counts = None, None, None, [0, 0, 0]
        for b in it:
            out = []
            for named, conv, role, text, loss, masked, n in zip(*(b.column(c).to_pylist() for c in ("named", "conv_id", "role", "text", "loss", "masked", "n_chars"))):
                if now != (named, conv):
                    if now:
                        out.append((*now, counts[0], whole.hexdigest(), counts[1], learned.hexdigest(), counts[2]))
                    now, whole, learned, counts = (named, conv), hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                whole.update(f"{role}\n{text}\n".encode())
                counts[0] += 1
                counts[2] += n
                if masked:
                    loss = text if loss is None else loss
                    learned.update(loss.encode())
                    counts[1] += len(loss)
            if out:
                yield make(out)
        if now:
            yield make([(*now, counts[0], whole.hexdigest(), counts[1], learned.hexdigest(), counts[2])])

    rows = turns.repartition("named", "conv_id").sortWithinPartitions("named", "conv_id", "idx").mapInArrow(task, _DIGESTS)
    return rows.select(F.when(F.col("named"), F.col("conv_id")).alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
