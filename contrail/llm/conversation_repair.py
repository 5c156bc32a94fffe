"""Operator 12, repair of conversation structure by a streamed search over edits.

A legal conversation has role initials ``(s?(ua)+)?``.  Rows are repartitioned by
conversation and sorted by turn; ``mapInPandas`` walks them once, over Arrow
batches, and carries the state of a dynamic program: for each of the four states
of that pattern the least cost of the edits so far and the rank of their letters
among the states' letters, so that ties go to the ASCII-least string without a
string being kept.  Two such strings of the same rows, each up to a row's own
letter, are never prefixes of one another, so ranks decide.  States more than
``HOPELESS`` above the cheapest are dropped (any of them can be reached or imitated
for less), which leaves few different steps: they are computed once and looked up.

Each row leaves one byte per state (where the best way came from).  A conversation
of at most ``Limits`` is traced back at its end.  A longer one spills its rows and
pointers in chunks to a table in the shared folder; a second stream reads the chunks
from the last to the first, carrying one state, and writes the edits.  A task thus
holds one chunk, however long a conversation is; one conversation is one stream, as
its digest is one stream of bytes.  Texts seen earlier are found beforehand by a
grouping on (conversation, role, digest of the text), combined before the shuffle.

Defined cases: null role or text is one space; rows of one turn are ordered by role,
then text (null turns first); a null id is a conversation of its own; a role without a
letter is never kept; repeated rows are duplicates; an empty table gives no rows;
other columns are ignored.  ``gaps`` stops at the largest 64-bit number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import materialise

SPACE = " \t\n\x0b\x0c\r"
#: Costs of the edits (fixed values of the contract).
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
HOPELESS = 12
#: States: nothing yet, after system, after user, after assistant.
_NEXT = (2, 2, 3, 2)  # by the one role of user and assistant that may follow
_ROLE = {2: "user", 3: "assistant"}
_KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
_ENDS = (0, 3)
_FAR = 1 << 62
START = ((0, _FAR, _FAR, _FAR), (0, 0, 0, 0))


@dataclass(frozen=True)
class Limits:
    """The most that a task keeps of one conversation before it spills."""
    rows: int = 8192
    chars: int = 1 << 22


def _after(state: int, inserts: int) -> int:
    for _ in range(inserts):
        state = _NEXT[state]
    return state


_steps: dict = {}


def step(state: tuple, must_go: bool, cut: bool, initial: str) -> tuple[tuple, int, bytes]:
    """The state after a row, what was taken off its costs, and for each state
    a byte: state before, inserts, edit."""
    key = (state, must_go, cut, initial)
    if key not in _steps:
        costs, ranks = state
        best: list = [None] * 4
        for q in range(4):
            if costs[q] >= _FAR:
                continue
            for k in range(3):
                p = _after(q, k)
                base = costs[q] + INSERT * k
                ways = [(p, DELETE, "D")]
                if not must_go:
                    more = TRUNCATED if cut else 0
                    ways.append((_NEXT[p], REROLE + more, "R"))
                    if (initial, p) in _KEEP:
                        ways.append((_KEEP[initial, p], more, "K"))
                for t, cost, letter in ways:
                    way = (base + cost, ranks[q], "I" * k + letter, q, k)
                    if best[t] is None or way < best[t]:
                        best[t] = way
        least = min(w[0] for w in best if w)
        best = [w if w and w[0] <= least + HOPELESS else None for w in best]
        order = sorted({w[1:3] for w in best if w})
        new = (tuple(w[0] - least if w else _FAR for w in best), tuple(order.index(w[1:3]) if w else 0 for w in best))
        _steps[key] = (new, least, bytes((w[3] | w[4] << 2 | "DKR".index(w[2][-1]) << 4) if w else 255 for w in best))
    return _steps[key]


def ending(state: tuple) -> tuple[int, int, int]:
    """Cost above the state's least, last state and inserts of the best way to a
    legal end."""
    costs, ranks = state
    ways = [(costs[q] + INSERT * k, ranks[q], k, q) for q in range(4) for k in range(3) if costs[q] < _FAR and _after(q, k) in _ENDS]
    cost, _, inserts, last = min(ways)
    return cost, last, inserts


def trace(pointers: bytes, roles: list[str], texts: list[str], state: int, inserts: int) -> tuple[list[dict], int, int]:
    """Edits of a run of rows, read backwards from ``state`` with ``inserts``
    behind it; with the state and inserts before the run."""
    out: list[dict] = []
    for i in range(len(roles) - 1, -1, -1):
        out += _inserted(state, inserts)
        code = pointers[4 * i + state]
        before, k, edit = code & 3, code >> 2 & 3, "DKR"[code >> 4]
        out.append({"edit": edit, "role": _ROLE[state] if edit == "R" else roles[i], "text": texts[i]})
        state, inserts = before, k
    return out, state, inserts


def _inserted(state: int, inserts: int) -> list[dict]:
    """Inserted rows behind ``state``, the last first."""
    return [{"edit": "I", "role": _ROLE[_after(state, j)], "text": ""} for j in range(inserts, 0, -1)]


@dataclass
class _Walk:
    """One conversation on its way through a task."""
    named: bool
    conv: int
    state: tuple = START
    cost: int = 0
    n: int = 0
    counts: dict = field(default_factory=lambda: {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0})
    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0
    last: tuple | None = None
    pointers: bytearray = field(default_factory=bytearray)
    roles: list = field(default_factory=list)
    texts: list = field(default_factory=list)
    chars: int = 0
    chunk: int = 0

    def row(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        body = text.rstrip(SPACE)
        initial = role[:1]
        again = again or self.last == (turn, role, text)
        cut = False
        if not body:
            self.counts["blank"] += 1
        elif again:
            self.counts["duplicate"] += 1
        elif body[-1] not in ".!?":
            cut = True
            self.counts["truncated"] += 1
        if self.last is not None and self.last[1][:1] + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.last = (turn, role, text)
        self.state, less, pointers = step(self.state, not body or again, cut, initial)
        self.cost += less
        self.n += 1
        self.pointers += pointers
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def full(self, limits: Limits) -> bool:
        return len(self.roles) >= limits.rows or self.chars >= limits.chars

    def spill(self) -> dict:
        """A chunk of rows whose edits are not known yet."""
        row = {"named": self.named, "conv_id": self.conv, "chunk": self.chunk, "pointers": bytes(self.pointers),
               "edits": [{"edit": None, "role": r, "text": t} for r, t in zip(self.roles, self.texts)]}
        self.chunk, self.chars = self.chunk + 1, 0
        self.pointers, self.roles, self.texts = bytearray(), [], []
        return row

    def end(self) -> list[dict]:
        extra, state, inserts = ending(self.state)
        gaps = 0 if self.first_turn is None else min(self.last_turn - self.first_turn + 1 - self.turns, (1 << 63) - 1)
        report = {"named": self.named, "conv_id": self.conv, "gaps": gaps, **self.counts, "cost": self.cost + extra}
        if not self.chunk:
            edits, state, inserts = trace(bytes(self.pointers), self.roles, self.texts, state, inserts)
            edits += _inserted(state, inserts)
            return [report | {"chunk": 0, "chunks": 1, "edits": edits[::-1]}]
        rows = [self.spill()] if self.roles else []
        return rows + [report | {"chunk": self.chunk, "state": state, "inserts": inserts, "edits": []}]


_EDITS = "edits array<struct<edit: string, role: string, text: string>>"
_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
#: ``chunks`` is 0 until the edits are known; the last row of a long conversation has no pointers.
_WALKED = f"named boolean, conv_id long, chunk int, chunks int, pointers binary, state int, inserts int, {_REPORT}, {_EDITS}"
_REPAIRED = f"named boolean, conv_id long, chunk int, chunks int, {_REPORT}, {_EDITS}"
_FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_NUMBERS = ["chunks", "state", "inserts", *_FIGURES]


def _frames(rows: Iterator[dict], columns: list[str], most: int = 1 << 23) -> Iterator[pd.DataFrame]:
    """Rows gathered into frames of bounded text."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 64 + sum(len(e["text"]) + 32 for e in r["edits"])
        if size >= most or len(held) >= 4096:
            yield _frame(held, columns)
            held, size = [], 0
    if held:
        yield _frame(held, columns)


def _frame(held: list[dict], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame({c: [r.get(c, 0) for r in held] if c in _NUMBERS else pd.Series([r.get(c) for r in held], dtype="object") for c in columns})


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ") if ":" not in part] + ["edits"]


def _walk(limits: Limits):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
        walk = None
        for b in batches:
            for named, conv, timed, turn, role, text, copies, again in zip(b["named"], b["conv"], b["timed"], b["turn"], b["role"], b["text"], b["copies"], b["again"]):
                if walk is None or (walk.named, walk.conv) != (named, conv):
                    if walk:
                        yield from walk.end()
                    walk = _Walk(bool(named), int(conv))
                for _ in range(copies):
                    walk.row(int(turn) if timed else None, role, text, bool(again))
                    if walk.full(limits):
                        yield walk.spill()
        if walk:
            yield from walk.end()

    return lambda batches: _frames(rows(batches), _names(_WALKED))


def _traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of long conversations, the last first -> their edits."""
    def rows() -> Iterator[dict]:
        report, state, inserts = {}, 0, 0
        for b in batches:
            for r in b.to_dict("records"):
                if r["pointers"] is None:
                    report = {k: r[k] for k in ("named", "conv_id", *_FIGURES)} | {"chunks": r["chunk"]}
                    state, inserts = int(r["state"]), int(r["inserts"])
                    continue
                held = list(r["edits"])
                edits, state, inserts = trace(bytes(r["pointers"]), [e["role"] for e in held], [e["text"] for e in held], state, inserts)
                if r["chunk"] == 0:
                    edits += _inserted(state, inserts)
                yield report | {"chunk": r["chunk"], "edits": edits[::-1]}

    return _frames(rows(), _names(_REPAIRED))


def repair(rows: DataFrame, limits: Limits = Limits(), copies: str | None = None) -> DataFrame:
    """``conv_id, turn, role, text`` -> one row for each conversation (one for each
    chunk of a long one): conv_id, chunk, chunks, gaps, blank, duplicate, truncated, illegal,
    cost, and ``edits`` in order (edit, role, text; a deleted row with its own
    role and text).  ``copies`` names a column with how often a row stands there;
    0 only makes its conversation known."""
    src = rows.select(F.col("conv_id").isNotNull().alias("named"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0).cast("long")).alias("conv"),
                      F.col("turn").isNotNull().alias("timed"), F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn"),
                      F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
                      (F.col(copies).cast("int") if copies else F.lit(1)).alias("copies"))
    src = src.withColumn("digest", F.sha2("text", 256))
    seen = (src.where("copies > 0").groupBy("named", "conv", "role", "digest")
            .agg(F.min(F.struct("timed", "turn")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    src = src.join(seen, ["named", "conv", "role", "digest"], "left").withColumn("again", F.coalesce(F.col("first") < F.struct("timed", "turn"), F.lit(False)))
    src = src.select("named", "conv", "timed", "turn", "role", "text", "copies", "again")
    walked = materialise(src.repartition("named", "conv").sortWithinPartitions("named", "conv", "timed", "turn", "role", "text").mapInPandas(_walk(limits), _WALKED))
    keep = _names(_REPAIRED)
    long = walked.where("chunks = 0").repartition("named", "conv_id").sortWithinPartitions("named", "conv_id", F.desc("chunk")).mapInPandas(_traced, _REPAIRED)
    both = walked.where("chunks = 1").select(*keep).union(long)
    return both.select(F.when(F.col("named"), F.col("conv_id")).alias("conv_id"), *keep[2:])


def repaired_rows(repaired: DataFrame) -> DataFrame:
    """conv_id, chunk, position, role, text of the legal conversations."""
    return (repaired.select("conv_id", "chunk", F.posexplode(F.filter("edits", lambda e: e.edit != "D")).alias("position", "e"))
            .select("conv_id", "chunk", "position", "e.role", "e.text"))


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, the report, ``audit`` (the edits' letters) and ``repaired_sha256``
    (``role:text`` of the rows that stay, joined by newlines).  Conversations of one
    chunk are hashed in place; the chunks of a longer one are streamed in order."""
    stays = F.filter("edits", lambda e: e.edit != "D")
    rows = repaired.select(F.col("conv_id").isNotNull().alias("named"), F.coalesce("conv_id", F.lit(0).cast("long")).alias("conv_id"), "chunk", "chunks", *_FIGURES,
                           F.array_join(F.transform("edits", lambda e: e.edit), "").alias("audit"),
                           F.size(stays).alias("n"), F.array_join(F.transform(stays, lambda e: F.concat(e.role, F.lit(":"), e.text)), "\n").alias("body"))
    key = [F.when(F.col("named"), F.col("conv_id")).alias("conv_id"), *_FIGURES]
    alone = rows.where("chunks = 1").select(*key, "audit", F.sha2("body", 256).alias("repaired_sha256"))
    schema = f"named boolean, conv_id long, {_REPORT}, audit string, repaired_sha256 string"

    def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sha, audit, any_row = None, None, [], False
        for b in batches:
            for r in b.to_dict("records"):
                if r["chunk"] == 0:
                    if now:
                        yield pd.DataFrame([now | {"audit": "".join(audit), "repaired_sha256": sha.hexdigest()}])
                    now, sha, audit, any_row = {k: r[k] for k in ("named", "conv_id", *_FIGURES)}, hashlib.sha256(), [], False
                audit.append(r["audit"])
                if r["n"]:
                    sha.update((("\n" if any_row else "") + r["body"]).encode())
                    any_row = True
        if now:
            yield pd.DataFrame([now | {"audit": "".join(audit), "repaired_sha256": sha.hexdigest()}])

    long = rows.where("chunks > 1").repartition("named", "conv_id").sortWithinPartitions("named", "conv_id", "chunk").mapInPandas(streamed, schema)
    return alone.union(long.select(*key, "audit", "repaired_sha256"))


def damage(convs: DataFrame) -> DataFrame:
    """The contract's damage by crc32(``conv_id:turn``) % 20, with the column
    ``copies`` for ``repair`` (a dropped row has 0)."""
    name: Column = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text, role = F.coalesce(F.col("text").cast("string"), F.lit(" ")), F.coalesce(F.col("role").cast("string"), F.lit(" "))
    src = convs.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    code = F.crc32(name.cast("binary")) % 20
    src = src.withColumn("code", code)
    gone = F.col("code") == 0
    return src.select("conv_id", "turn",
                      F.when(gone, F.lit(None).cast("string")).when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                      F.when(gone, F.lit(None).cast("string")).when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                      F.when(gone, 0).when(F.col("code") == 3, 2).otherwise(1).alias("copies"))
