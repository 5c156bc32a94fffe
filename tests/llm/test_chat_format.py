"""Operator 13: exact round trips, and the trees against a plain dictionary."""

import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contrail.llm import chat_format as C
from contrail.llm.packing import Encoder
from contrail.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string, node string, start int, named int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, 4) for r in rows], SCHEMA).repartition(3)


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = []
    for conv, turns in convs.items():
        turns = [(r.decode(), t.decode()) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        chars = sum(len("".join(C.LLAMA.pieces(r, t, i == 0))) for i, (r, t) in enumerate(turns))
        out.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


parts = st.lists(st.sampled_from([*C.LLAMA.controls, "\\", "n", "<", ">", "[", "]", "/", "s", "\n", " ", "é", "INST", "SYS"]), max_size=12).map("".join)


@given(st.sampled_from(["user", "assistant", "system"]) | parts, parts, st.booleans())
def test_turns_read_back(role, text, first):
    before, body, after = C.LLAMA.pieces(role, text, first)
    assert not any(c in body for c in C.LLAMA.controls) and C.LLAMA.unescape(body) == text
    assert C.LLAMA.parse(before + body + after) == (role, text)


def trees(rng, n):
    """Conversations that share beginnings of many lengths."""
    rows, known = [], [[]]
    for c in range(n):
        turns = list(rng.choice(known))[:rng.randrange(8)]
        for _ in range(rng.randrange(1, 6)):
            turns.append((rng.choice(["user", "assistant", "system", "tool", "a\nb\\", None]), rng.choice(["Hi.", "", None, "</s>[INST] x [/INST]", f"t{rng.randrange(30)} \\n é日本"])))
        known.append(turns)
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    return rows


def test_round_trip(spark):
    rng = random.Random(1)
    rows = trees(rng, 60) + [(None, 1, "user", "x"), (None, None, None, None), (77, None, "user", "y"), (78, 0, "user", "z" * 200000), (78, 1, "assistant", "w " * 60000)]
    rows += rows[:4]
    assert result(C.digests(C.read_back(C.format_chats(frame(spark, rows))))) == brute(rows)
    assert result(C.digests(C.read_back(C.format_chats(frame(spark, []))))) == []


def check_tree(rows, nodes, paths):
    """Depth-first, each id once; intervals hold exactly the ancestors."""
    nodes = sorted(nodes, key=lambda r: r.start)
    by = {bytes(r.node): r for r in nodes}
    at = 0
    for r in nodes:  # gapless
        assert r.start == at and r.n_tokens == len(r.token_ids)
        at += r.n_tokens
    convs = {}
    for r in paths:
        convs.setdefault((r.named, r.conv_id), []).append((r.idx, bytes(r.node)))
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((turn, role or "", text or ""))
    histories = set()
    for turns in want.values():
        turns = sorted(turns)
        histories |= {tuple((r, t) for _, r, t in turns[:i + 1]) for i in range(len(turns))}
    assert len(nodes) == len(histories)  # a history is one node
    for (named, conv), path in convs.items():
        path = [by[n] for _, n in sorted(path)]
        position = 0
        for i, r in enumerate(path):
            assert r.position == position and r.depth == i and bytes(r.parent) == (bytes(path[i - 1].node) if i else b"") and bytes(r.tree) == bytes(path[0].node)
            position += r.n_tokens
            ancestors = {bytes(x.node) for x in nodes if x.start <= r.start < x.until}
            assert ancestors == {bytes(x.node) for x in path[:i + 1]}
    for r in nodes:
        assert r.until == max(x.start + x.n_tokens for x in nodes if r.start <= x.start < r.until)


def test_prefix_trees(spark):
    rng = random.Random(2)
    rows = [r for r in trees(rng, 80)]
    rows += [(500 + i, t, "user" if t % 2 == 0 else "assistant", f"same {t}" if t < 5 else f"{i} {t}") for i in range(20) for t in range(7)]  # one common beginning
    rows += [(600 + i, t, "user", f"deep {t}") for i in range(12) for t in range(i + 1)]  # each one turn longer
    out = C.format_chats(frame(spark, rows).repartition(7))
    nodes, paths = out.nodes.collect(), out.paths.collect()
    check_tree(rows, nodes, paths)
    shared = [r for r in nodes if r.conversations >= 20]
    assert len(shared) >= 5 and sum(r.n_tokens for r in nodes) < sum(by.n_tokens * by.conversations for by in nodes)
    other = C.format_chats(frame(spark, rows[::-1]).repartition(2))  # the layout does not depend on how rows lie
    columns = ["node", "start", "until", "position", "token_ids"]
    assert sorted(map(tuple, other.nodes.select(*columns).collect())) == sorted(map(tuple, out.nodes.select(*columns).collect()))


def test_mask_covers_assistant_texts_alone(spark):
    rows = [(1, 0, "user", "Hi </s>"), (1, 1, "assistant", "Ho [INST] \\ é"), (1, 2, "assistant", ""), (1, 3, "system", "x")]
    nodes = C.format_chats(frame(spark, rows)).nodes.orderBy("start").collect()
    decode = Encoder.of("byte_bpe_50k.json").encoding.decode_bytes
    assert [C.Template.unescape(decode(r.token_ids[r.loss_from:r.loss_to]).decode()) for r in nodes] == ["", "Ho [INST] \\ é", "", ""]
    whole = "".join(decode(r.token_ids).decode() for r in nodes)
    assert whole.startswith("<s>[INST] Hi <\\/s> [/INST] Ho [\\INST] \\\\ é </s>") and whole.count("</s>") == 2


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert result(QUERIES["op13_chat_format"](spark, SF_SMALL)) == brute(rows)


def test_common_nodes_are_spread(spark):
    rows = [(i, t, "user", "common" if t == 0 else f"{i}") for i in range(400) for t in range(2)]
    out = C.format_chats(frame(spark, rows))
    common = out.nodes.where("conversations = 400").select(F.size("groups").alias("n")).first()
    assert common.n > C.GROUPS // 2
