"""The pipeline on a small table, and the registered queries with SQL."""

import random

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from contrail.llm.common import materialise
from scripts.check_oracle import digest, duck
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = materialise(P.STAGES[0][1](spark, docs, SF_SMALL))
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == P.COLUMNS and sum((d in ids) == bool(q) for d, q in quality.items()) >= 0.95 * len(quality)
    near = materialise(P.STAGES[1][1](spark, kept, SF_SMALL))
    parts = brute.components([(d, texts[d]) for d in ids], 5)
    assert {r.doc_id for r in near.collect()} == {d for d in ids if parts[d][1] == d}
    cut = materialise(P.STAGES[2][1](spark, near, SF_SMALL))
    rows = [(r.doc_id, r.text) for r in near.collect()]
    want = {d: (n, gone) for d, n, gone, _ in brute.substring_dedup(rows)}
    got = {r.doc_id: r.text for r in cut.collect()}
    assert set(got) == {d for d, (n, gone) in want.items() if not gone or gone < n}
    assert all(len(brute.WORD.findall(t)) == want[d][0] - want[d][1] and (want[d][1] or t == texts[d]) for d, t in got.items())
    clean = materialise(P.STAGES[3][1](spark, cut, SF_SMALL))
    assert set(got) >= {r.doc_id for r in clean.collect()} and clean.columns == P.COLUMNS
    packed = P.STAGES[4][1](spark, clean, SF_SMALL)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in clean.collect()}


def test_stages_keep_rows_without_an_id_of_their_own(spark):
    rng = random.Random(6)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(4000)}" for _ in range(80)) for _ in range(5))
    rows = [(1, a), (9, a + " x"), (9, b), (None, a + " v"), (None, c)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = P.near_dedup(spark, docs, SF_SMALL).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(1, a), (9, b), (0, c)])
    part = " ".join(a.split()[:30])
    rows = [(1, a), (5, part + " " + d), (5, part + " " + e), (None, part + " " + c), (None, part + " " + c)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs.schema)
    got = P.substrings(spark, docs, SF_SMALL).collect()
    assert sorted((r.doc_id or 0, r.text, r.n_chars) for r in got) == sorted((i, t, len(t)) for i, t in [(1, a), (5, d), (5, e), (0, c), (0, c)])


@pytest.mark.parametrize("name", [n for n in E.oracle_sql() if n.startswith("op") and n[2].isdigit()])
def test_queries_match_sql(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, cur.fetchall())[0]


def test_all_operators_are_registered():
    names = [n for n in E.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


def test_decontamination_drops_the_leaking_text_alone(spark):
    leak = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").first().text
    rng = random.Random(8)
    a, b, c = (" ".join(f"w{rng.randrange(4000)}" for _ in range(60)) for _ in range(3))
    rows = [(None, leak), (7, leak + " " + a), (None, a), (7, b), (9, c)]  # two leaks, three clean rows
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, text_key string")
    got = P.decontaminate(spark, docs, SF_SMALL)
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted([(0, a), (7, b), (9, c)]) and got.columns == P.COLUMNS


def test_stages_on_an_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, k string, t string, rest string, label string, kept boolean, component_id long, text_key string, item_id string"
    empty = spark.createDataFrame([], schema)
    rows = [(1, "one short text of a few words", "en", "s", 30) + ("x",) * 4 + (True, 5, "x", "y"), (None, None, None, None, None) + (None,) * 8, (2, "", "en", "s", 0) + ("x",) * 4 + (False, 1, "x", "y")]
    some = spark.createDataFrame(rows, schema)
    for name, stage in P.STAGES[1:]:
        assert stage(spark, empty, SF_SMALL).count() == 0, name
        got = stage(spark, some, SF_SMALL)
        assert got.count() == 3 and (name == "packing" or got.columns == P.COLUMNS), name
