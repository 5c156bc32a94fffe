"""Operator 12 against a search over all edits, and against a plain search that
keeps whole strings."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from contrail.llm import conversation_repair as C
from contrail.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string, audit string, chunk int, state string"
LEGAL = re.compile("(s?(ua)+)?")
BLANK = re.compile("[^\x20\x09-\x0D]")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, "y") for r in rows], SCHEMA).repartition(3)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        visible = BLANK.findall(text)
        out.append("blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def best_edits(rows, kinds, most_inserts=2):
    """Least (cost, audit, repaired rows) over all edits, state by state of the
    pattern, with whole strings."""
    def moves(way):
        cost, audit, kept = way
        yield way
        for a in ("user", "assistant"):
            yield cost + 5, audit + "I", kept + ((a, ""),)

    def spread(ways):
        for _ in range(most_inserts):
            ways = {m for w in ways for m in moves(w)}
        return {w for w in ways if any(LEGAL.fullmatch("".join(r[:1] for r, _ in w[2]) + tail) for tail in ("", "a", "ua"))}

    ways = {(0, "", ())}
    for (_, _, role, text), kind in zip(rows, kinds):
        nxt = set()
        for cost, audit, kept in spread(ways):
            nxt.add((cost + 2, audit + "D", kept))
            if kind not in ("blank", "duplicate"):
                more = 5 if kind == "truncated" else 0
                nxt.add((cost + more, audit + "K", kept + ((role, text),)))
                for r in ("user", "assistant"):
                    nxt.add((cost + more + 1, audit + "R", kept + ((r, text),)))
        legal = [w for w in nxt if all(r for r, _ in w[2]) and any(LEGAL.fullmatch("".join(r[:1] for r, _ in w[2]) + tail) for tail in ("", "a", "ua"))]
        best = {}
        for w in legal:  # per state: the initials' last letter and whether a system row stands alone
            state = (w[2][-1][0][:1] if w[2] else "")
            best[state] = min(best.get(state, w), w)
        ways = set(best.values()) if len(rows) > 4 else set(legal)
    return min(w for w in spread(ways) if LEGAL.fullmatch("".join(r[:1] for r, _ in w[2])))


def brute(rows, hurt=True):
    convs = sorted({r[0] for r in rows}, key=lambda c: (c is not None, c or 0))
    rows = damaged(rows) if hurt else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    out = []
    for conv in convs:
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        kinds = faults(own)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, kept = best_edits(own, kinds)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((conv, gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit, sha))
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def some_conversations(rng, n, most, roles=("user", "assistant", "system", "tool", "", None)):
    texts = ["Yes.", "No!", "why", "", " \t\n", None, "é日本。", "ok?", "Yes.", "a longer text. with more", "\x0b.\x0c"]
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, most + 1)):
            turn = None if rng.random() < 0.05 else rng.randrange(most * 2) if rng.random() < 0.2 else t
            rows.append((c, turn, rng.choice(roles[:3] if rng.random() < 0.8 else roles), rng.choice(texts) if rng.random() < 0.7 else f"text {rng.randrange(99)}."))
    return rows


def test_steps_against_all_edits():
    """Every conversation of up to 4 rows of the row kinds, by the walk alone."""
    rng = random.Random(1)
    for _ in range(400):
        rows = [(0, i, rng.choice(["user", "assistant", "system", "x", ""]), rng.choice(["a.", "b.", "c", "d", ""])) for i in range(rng.randrange(5))]
        walk = C._Walk(True, 0)
        seen = set()
        for _, t, r, x in rows:
            walk.row(t, r, x, (r, x) in seen)
            seen.add((r, x))
        got = walk.end()[0]
        cost, audit, kept = best_edits(rows, faults(rows))
        assert (got["cost"], "".join(e["edit"] for e in got["edits"])) == (cost, audit), rows
        assert tuple((e["role"], e["text"]) for e in got["edits"] if e["edit"] != "D") == kept


def test_against_brute_force(spark):
    rng = random.Random(2)
    rows = some_conversations(rng, 60, 9) + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (None, None, None, None), (99, None, "user", None)]
    rows += rows[:5]  # rows that occur twice
    got = rows_of(C.digests(C.repair(C.damage(frame(spark, rows)), copies="copies")))
    assert got == brute(rows)
    got = rows_of(C.digests(C.repair(frame(spark, rows))))
    assert got == brute(rows, hurt=False)


def test_long_conversations_are_spilled_in_chunks(spark):
    rng = random.Random(3)
    rows = []
    for c, n in ((1, 500), (2, 7), (3, 128), (4, 64), (5, 65)):
        rows += [(c, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"t {t}.", f"t {t}", "same.", ""])) for t in range(n)]
    small = C.repair(frame(spark, rows), C.Limits(64, 1 << 20))
    got = rows_of(C.digests(small))
    assert got == brute(rows, hurt=False)
    counts = {r.conv_id: r.n for r in small.groupBy("conv_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {1: 8, 2: 1, 3: 2, 4: 1, 5: 2}
    assert got == rows_of(C.digests(C.repair(frame(spark, rows), C.Limits(8192, 40)))) == rows_of(C.digests(C.repair(frame(spark, rows))))
    kept = C.repaired_rows(small).orderBy("conv_id", "chunk", "position").collect()
    roles = {c: "".join(r.role[0] for r in kept if r.conv_id == c) for c in (1, 3, 5)}
    assert all(LEGAL.fullmatch(r) for r in roles.values())


def test_defined_cases(spark):
    assert C.digests(C.repair(frame(spark, []))).collect() == []
    assert C.digests(C.repair(C.damage(frame(spark, [])), copies="copies")).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert rows_of(C.digests(C.repair(C.damage(frame(spark, [(gone, 0, "user", "Hi.")])), copies="copies"))) == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]
    far = [(1, -(1 << 63), "user", "Hi."), (1, (1 << 63) - 1, "assistant", "x" * 300000 + ".")]
    got = rows_of(C.digests(C.repair(frame(spark, far))))[0]
    assert got[1] == (1 << 63) - 1 and got[7] == "KK"


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op12_conversation_repair"](spark, SF_SMALL)) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_walk_is_the_plain_search(seed):
    rng = random.Random(seed + 10)
    for _ in range(40):
        rows = [(0, i, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", f"b{i}.", "c", ""])) for i in range(rng.randrange(5, 25))]
        walk, seen = C._Walk(True, 0), set()
        for _, t, r, x in rows:
            walk.row(t, r, x, (r, x) in seen)
            seen.add((r, x))
        got = walk.end()[0]
        cost, audit, kept = best_edits(rows, faults(rows))
        assert (got["cost"], "".join(e["edit"] for e in got["edits"])) == (cost, audit)
        assert tuple((e["role"], e["text"]) for e in got["edits"] if e["edit"] != "D") == kept
