"""Each operator against its plain form, and the cases every operator defines:
nulls, empty and very long texts, ties and repeated rows, empty tables, extra
columns with clashing names."""

import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contrail.llm.common import Words
from contrail.llm.html_wrapper import Page, by_articles, extract, main_text, match, merged, slots_of
from contrail.llm.license_scan import KNOWN, known_licenses, license_scan
from contrail.llm.minhash_hamming import chunk_sizes, error_bound, near_duplicates, shingles, signatures
from contrail.llm.packing import Encoder, combinations, nnls, pack, plan
from contrail.llm.quality_classifier import fit, held_out, quality_scores
from contrail.llm.quality_rules import POLICIES, ablations, apply_policy, ledger, mask_of, measure
from contrail.llm.substring_dedup import substring_dedup
from contrail.llm.suffix_dedup import suffix_dedup
from contrail.llm.template_decontam import Benchmark, _matches, find_leaks
from contrail.llm.token_counts import token_counts, vocabulary
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, block int, key string"


def words(rng, n, size=4000):
    return " ".join(f"w{rng.randrange(size):x}" for _ in range(n))


def hard_rows():
    rng = random.Random(3)
    base, shared = words(rng, 120), words(rng, 40)
    rows = [(10, base), (11, base), (12, base + " tail"), (13, None), (14, ""), (15, " \n\t "), (16, "one"), (17, "One"), (18, "a b c"),
            (19, words(rng, 60) + " " + shared + " " + words(rng, 60)), (5, words(rng, 30) + "\n" + shared + "\n" + words(rng, 5)),
            (20, "é日本 " * 80), (21, "é日本 " * 80), (22, "x" * 300), (23, "y" + "x" * 200), (24, words(rng, 60000)), (None, base), (None, None),
            (25, words(rng, 10) + " " + shared[:60]), (26, "a\x0bb\x0cc d e #*\n\na\n a\na"), (27, "x y z q r " * 40), (4, shared)]
    for i in range(30):  # near copies of one text, each with its own words
        w = base.split()
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"n{i}{rng.randrange(99)}"
        rows.append((100 + i, " ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, "en", "s", 1, 7, 8, "k") for d, t in hard_rows()], SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_suffix_dedup(docs, none):
    got = [tuple(r)[:5] for r in suffix_dedup(docs).collect()]
    assert Counter(got) == Counter(brute.suffix_dedup(hard_rows()))
    assert suffix_dedup(none).count() == 0
    again = suffix_dedup(docs.union(docs), with_text=True)  # equal ids cost each other nothing
    assert Counter(tuple(r)[:5] for r in again.collect()) == Counter(got + got)


def test_repeats_keep_the_largest_id(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(2**63 - 1, text), (None, "another " + text), (-2**63, "other"), (3, text)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r)[:5] for r in suffix_dedup(table).collect()) == Counter(brute.suffix_dedup(rows))
    assert Counter(tuple(r)[:4] for r in substring_dedup(table).collect()) == Counter(brute.substring_dedup(rows))


def test_substring_dedup(docs, none):
    got = [tuple(r)[:4] for r in substring_dedup(docs).collect()]
    assert Counter(got) == Counter(brute.substring_dedup(hard_rows()))
    assert substring_dedup(none).count() == 0
    kept = {r.doc_id: r for r in substring_dedup(docs, with_text=True).collect()}
    assert kept[11].kept == "" and kept[12].kept.endswith("tail") and kept[11].repeats == [[0, 120]]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, none, width):
    rows = [(d, t) for d, t in hard_rows() if d is not None]
    got = near_duplicates(docs.where("doc_id is not null"), shingle_words=width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(rows, width)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near_duplicates(none).count() == 0
    with_null = {r.doc_id: r for r in near_duplicates(docs, shingle_words=width).collect()}
    assert with_null[13].kept and with_null[13].n_shingles == 0


def test_near_duplicates_of_one_short_document(spark):
    for n in range(1, 5):
        text = np.frombuffer(" ".join("abcd"[:n]).encode(), np.uint8)
        for width in (2, 5):
            x, off = shingles(Words(text, np.array([0, len(text)])), width)
            assert len(x) == max(1, n - width + 1) and off.tolist() == [0, len(x)]
    table = spark.createDataFrame([(7, "a b c")], "doc_id long, text string")
    assert [tuple(r) for r in near_duplicates(table).collect()] == [(7, 1, 7, True)]


def test_near_duplicates_of_rows_without_an_id_of_their_own(spark):
    rng = random.Random(8)
    a, b, c, d, e = (words(rng, 80) for _ in range(5))
    rows = [(1, a), (2, b), (9, a + " x"), (9, b + " y"), (9, c), (12, c + " z"), (None, a + " v"), (None, d), (None, e), (None, e), (30, d + " u")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), shingle_words=2).collect()
    want = [(1, 1, True), (2, 2, True), (9, 1, False), (9, 2, False), (9, 9, True), (12, 9, False), (None, 1, False), (None, 30, False), (None, None, True), (None, None, True), (30, 30, True)]
    assert Counter((r.doc_id, r.component_id, r.kept) for r in got) == Counter(want)


def test_pairs_within_the_signature_distance_are_found(spark):
    # pairs at just 80 percent (80 of 100 words) whose signatures' low bits differ in more than half of the most symbols that may
    rng, bound, rows = random.Random(5), error_bound(0.8, 64), []

    def signed(texts):
        raw = [t.encode() for t in texts]
        return signatures(*shingles(Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw])), 1), 64)

    while len(rows) < 6:
        texts = [[f"{rng.getrandbits(40):x}" for _ in range(100)] for _ in range(4000)]
        left, right = [" ".join(w[:90]) for w in texts], [" ".join(w[:80] + w[90:]) for w in texts]
        a, b = signed(left), signed(right)
        for i in np.flatnonzero((((a ^ b) & 1).sum(axis=1) > 16) & ((a != b).sum(axis=1) <= bound)):
            rows += [(len(rows), left[i]), (len(rows) + 1, right[i])]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=1).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(rows, 1) == {d: (90, d - d % 2) for d, _ in rows}


def test_signature_guarantee():
    bound = error_bound(0.8, 64)
    sizes = chunk_sizes(64, bound)
    assert sum(sizes) == 64 and 2 * len(sizes) > bound  # so one chunk has at most one error


def test_quality_rules_can_be_filtered(docs):
    """Filters on the measures and the verdict, without a table in between."""
    whole = ledger(measure(docs))
    all_rows = sorted(map(tuple, apply_policy(whole, "web-1").collect()), key=str)
    names = apply_policy(whole, "web-1").columns
    for condition, keep in [("kept", lambda r: r["kept"]), ("not kept", lambda r: not r["kept"])] + [(f"{m} > 3", lambda r, m=m: r[m] > 3) for m in names if m.startswith("n_") or m == "word_chars"]:
        want = [r for r in all_rows if keep(dict(zip(names, r)))]
        assert sorted(map(tuple, apply_policy(whole, "web-1").where(condition).collect()), key=str) == want
    counts = {r.rule: r.n_failed for r in ablations(whole, "web-1").collect()}
    assert counts["few_words"] == sum(r[names.index("n_words")] < 10 for r in all_rows)


def test_quality_rules(docs, none):
    rows = hard_rows()
    got = ledger(measure(docs)).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter((d, *brute.rules(t)) for d, t in rows)
    stored = ledger(measure(docs)).cache()
    for policy in POLICIES:
        judged = apply_policy(stored, policy).collect()
        assert all(r.kept == (r.failed & mask_of(policy) == 0) for r in judged)
        rejected = sum(not r.kept for r in judged)
        for a in ablations(stored, policy).collect():
            assert a.n_rejected == rejected and a.n_only <= a.n_failed <= rejected
    assert ledger(measure(none)).count() == 0


def test_packing(docs, none):
    rows = pack(docs).collect()
    encoder = Encoder.of("byte_bpe_50k.json")
    ids = [(d, np.append(encoder.ids(t or ""), np.array([1], "<u4")).astype("<u4")) for d, t in hard_rows()]
    assert sum(r.length for r in rows) == sum(len(x) for _, x in ids)
    known = {(d, len(x)): x for d, x in ids}
    for r in rows:
        x = known[r.doc_id, r.doc_tokens]
        if r.doc_id is not None:
            assert r.ids_crc32 == zlib.crc32(x[r.start:r.start + r.length].tobytes())
    by = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by.get(r.sequence_id, 0)
        by[r.sequence_id] = r.offset + r.length
    assert max(by.values()) <= 2048 and set(by) == set(range(len(by)))
    assert sum(2048 - n for n in by.values() if n & (n - 1)) <= 2048
    assert pack(none).count() == 0


def test_packing_plan():
    rng = random.Random(1)
    for _ in range(20):
        histogram = {k: rng.randrange(1, 300) for k in rng.sample(range(1, 64), 20)} | {32 * k: rng.randrange(1, 300) for k in rng.sample(range(2, 65), 20)}
        used = Counter()
        for pattern, times in plan(histogram, 2048):
            assert times > 0 and sum(k * m for k, m in pattern.items()) <= 2048
            for k, m in pattern.items():
                used[k] += m * times
        assert dict(used) == histogram
    assert combinations(4, [1, 2, 3, 4], 3) == [(4,), (3, 1), (2, 2), (2, 1, 1)]
    x = nnls(np.array([[1.0, 0, 1], [0, 1, 1]]), np.array([3.0, 5.0]))
    assert x.min() >= 0 and np.allclose([x[0] + x[2], x[1] + x[2]], [3, 5])


def test_encoder_names_the_ids_of_the_tokenizer_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rng = random.Random(2)
    for text in ["", " ", "a\n\n b", "<|endoftext|> x", "日本 é 😀", words(rng, 40000), "ab" + " " * 30000 + "c", *(x or "" for _, x in hard_rows())]:
        assert Encoder.of("byte_bpe_50k.json").ids(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_token_counts(docs, none):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.Unigram(list(vocabulary("piece_bpe_32k.model")), unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    want = Counter((d, len(x or ""), len(t.encode(x or "", add_special_tokens=False).ids)) for d, x in hard_rows())
    assert Counter(tuple(r) for r in token_counts(docs).collect()) == want
    assert token_counts(none).count() == 0


def test_decontamination(spark, none):
    item = "On a cold day Peter walked 12 km to the market and bought 30 apples for 5 dollars because he wanted to bake 2 pies"
    other = item.replace("12", "17").replace("30", "44").replace("Peter", "Maria")
    mixed = "start 1 of the story then 7 more of the story then 7 less and so on until the very end of it"
    bench = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, "too short", "x"), (4, "five small plain words here", "x"), (5, mixed, "x")], "item_id long, text string, doc_id string")
    rows = [(1, "before. " + item + " after", 0), (2, "before. " + other.upper().lower().replace("maria", "Maria") + ". end", 0), (3, None, 0), (4, "", 0), (5, "nothing of it at all in these few words", 0),
            (6, "we saw five small plain words here today", 0), (7, mixed.replace("then 7 less", "then 8 less"), 0), (None, item, 0), (1, item, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    got = find_leaks(docs, bench).collect()
    assert sorted(((r.doc_id or -1, r.item_id) for r in got)) == [(-1, 1), (1, 1), (1, 1), (2, 1), (6, 4)]
    assert next(r for r in got if r.doc_id == 2).n_changed >= 2
    assert find_leaks(none, bench).count() == 0 and find_leaks(docs, bench.where("item_id is null")).count() == 0


def test_decontamination_judges_each_alignment(spark):
    item = "On a cold day Peter walked 12 km to the market and bought 30 apples for 5 dollars because he wanted to bake 2 pies"
    other = item.replace("12", "17").replace("30", "44")
    third = item.replace("12", "19").replace("30", "48")
    train = "the train arrives at 5 pm on Monday from the north and the train arrives at 7 pm on Monday from the south"
    filler = " and then a good many other words stood in this long document before anything else was said about it. " * 3
    stray = "he walked 99 km to the market and bought 31 apples"
    halves = item.replace("bought", "then he quickly bought")
    bench = spark.createDataFrame([(1, item), (2, train)], "item_id long, text string")
    rows = [(1, item + filler + other), (2, other + ". " + third), (3, "x " + train + " y"), (4, item + filler + stray), (5, stray + filler + halves), (6, stray + filler + "nothing else")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs, bench).collect()}
    assert got >= {(1, 1), (2, 1), (3, 2), (4, 1), (5, 1)} and not got & {(3, 1), (6, 2)}


def test_decontamination_below_the_floor_of_literals():
    items = ["Compute 12 + 7 * 3 - 4", "Ask Anna Berta Carla Dora Emil Frida and Gustav", "Why so blue?", "水在多少度时会沸腾呢", "น้ำเดือดที่กี่องศา", "", None, "Sum 1 2 a 3 4 b 5 6 c 7 8 d 9 10 e 11 12 f"]
    docs = ["he said: compute 12 + 7 * 3 - 4 = 29, 5 times", "please ask Anna Berta Carla Dora Emil Frida and Gustav, Hanna too", "and why so blue? he asked", "请问水在多少度时会沸腾呢谢谢", "ถามน้ำเดือดที่กี่องศาครับ",
            "sum 1 2 a 3 4 b 5 6 c 7 8 d 9 10 e 11 12 f 13", "compute 12 + 8 * 3 - 4", "why so very blue 水会沸腾", ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(docs)), pa.int64()), pa.array([x.encode() for x in docs], pa.binary())], names=["doc_id", "data"])
    rows = [r for b in _matches(iter([batch]), Benchmark(list(enumerate(items)))) for r in b.to_pylist()]
    got = {(r["doc_id"], r["item_id"]) for r in rows if r["consistent"] and (r["longest_run"] >= 13 or r["share"] >= 0.5)}
    assert got == {(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 7)}


def test_license_scan(spark, none):
    mit = KNOWN["MIT"]
    rows = [(1, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(" ", "  "), 0), (2, "text\nreleased under the MIT Licence!\nmore", 0), (3, None, 0), (4, "Copyright 1999 x", 0), (5, mit + " more", 0), (None, mit, 0), (1, mit, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int")
    got = Counter((r.doc_id, r.license, tuple(r.notices)) for r in license_scan(docs).collect())
    assert got == Counter({(1, "MIT", ()): 2, (2, None, ("MIT-notice",)): 1, (3, None, ()): 1, (4, None, ()): 1, (5, None, ()): 1, (None, "MIT", ()): 1})
    assert license_scan(none).count() == 0


def test_whole_licences_are_found(spark):
    """Rewrapped, indented, behind comment signs, with notices of their own."""
    def variants(text):
        yield text
        yield "\n".join("# " + line for line in ["Copyright (c) 2021 A. Body", *text.split("\n")])
        yield "/*\n * Copyright 2001-2019, B. Body\n" + "\n".join(" * " + line for line in text.split("\n")) + "\n */"
        yield " ".join(text.split()).upper() if not re.search("(?im)^[ ]*(copyright [(0-9\\[]|all rights)", text) else text

    texts = {name: KNOWN[name] for name in ("MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause")}
    files = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    for name, file in files.items():  # as this machine's system has them
        if os.path.exists(f"/usr/share/common-licenses/{file}"):
            texts[name] = open(f"/usr/share/common-licenses/{file}", encoding="utf-8").read()
    rows = [(i, name, v) for i, (name, v) in enumerate((name, v) for name, t in texts.items() for v in variants(t))]
    docs = spark.createDataFrame([(i, v) for i, _, v in rows], "doc_id long, text string")
    assert {r.doc_id: r.license for r in license_scan(docs).collect()} == {i: name for i, name, _ in rows}
    own = known_licenses(spark, {"House": "All rights go to nobody.\nEver.", "Line": "Take it!"})  # a caller's table, without any of the usual words
    docs = spark.createDataFrame([(1, "all rights  go to\nnobody ever"), (2, "x\n  TAKE it\ny"), (3, "take it not")], "doc_id long, text string")
    assert {(r.doc_id, r.license, tuple(r.notices)) for r in license_scan(docs, own).collect()} == {(1, "House", ()), (2, None, ("Line",)), (3, None, ())}


PAGE = """<html><head><title>t</title><style>p{{}}</style></head><body><div class="top">Site of all pages</div><nav><a>x{0}</a></nav>
<div id="main-col"><h1>Head {0}</h1><p>First &amp; {0}<p>second&nbsp;<b>bold {0}</p><ul><li>one {0}<li>two</ul></div><div class="comments"><p>c {0}</div><footer>f</footer></body></html>"""


def test_html_wrapper(spark):
    article = "<body><header>h</header><article><h1>A</h1><p>x  y<br>z</p><script>var t='</p>'</script><p>&eacute;</article><aside>s</aside>"
    rows = [(i, f"http://h.example/{i}", PAGE.format(i), 0) for i in range(4)] + [(10, None, None, 0), (11, "http://h.example/z", "", 0), (12, None, article, 0), (13, "http://a/", "<p>a<" + "div>" * 3000, 0), (12, None, article, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = Counter((r.page_id, r.text, r.n_chars) for r in main_text(pages).collect())
    want = {i: f"Head {i}\nFirst & {i}\nsecond bold {i}\none {i}\ntwo" for i in range(4)} | {10: "", 11: ""}
    for i, text in want.items():
        assert got[i, text, len(text)] == 1, (i, sorted(map(str, got)))
    assert got[12, "A\nx y z\né", 9] == 2
    assert main_text(pages.where("page_id < 0")).count() == 0
    a, b = Page("<div><p>x</p><ul><li>1</ul></div>").tree(), Page("<div><ul><li>1<li>2</ul></div>").tree()
    assert match(a, b, {}) == 4  # root, div, ul, li


def texts_of(sources):
    """Pages of one host, without Spark."""
    pages = [Page(x) for x in sources]
    wrapper = merged([p.tree() for p in pages])
    return [extract(p, slots_of(p, wrapper), by_articles(wrapper)) for p in pages]


def test_html_wrapper_constant_siblings():
    divs = "<body><div id=top>site words</div><div id=page>text {0}</div><div id=bottom>footer words</div></body>"
    paragraphs = "<body><p>All rights reserved</p><p>first {0}</p><p>second <b>bold {0}</b></p><p>About us</p></body>"
    assert texts_of([divs.format(i) for i in range(4)]) == [f"text {i}" for i in range(4)]
    assert texts_of([paragraphs.format(i) for i in range(4)]) == [f"first {i}\nsecond bold {i}" for i in range(4)]
    assert texts_of([divs.format(i) for i in range(2)])[1] == "site words\ntext 1\nfooter words"  # two pages show nothing


def test_html_wrapper_keeps_articles():
    text = "the long text of page {0} with all its words"
    classes = f"<body class='has-sidebar'><main class='page menu'><article class='post comments-open'><h1 class='article-header'>Head {{0}}</h1><div class='content with-sidebar'><p>{text}</div></article></main><div class='comments'>c {{0}}</div></body>"
    teaser = f"<body><div id=content><p>{text}</p></div><aside><article>teaser {{0}}</article></aside></body>"
    card = f"<body><div id=content><p>{text}</p></div><article>card {{0}}</article></body>"
    for n in (1, 4):
        assert texts_of([classes.format(i) for i in range(n)]) == [f"Head {i}\n" + text.format(i) for i in range(n)]
        assert texts_of([teaser.format(i) for i in range(n)]) == [text.format(i) for i in range(n)]
        assert texts_of([card.format(i) for i in range(n)]) == [text.format(i) + f"\ncard {i}" for i in range(n)]


def test_quality_classifier(spark, docs, none):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        good = i % 3 > 0
        rows.append((i, words(rng, 60, 300) if good else words(rng, 60, 300).upper().replace(" ", "!! "), int(good)))
    table = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, q) for d, _, q in rows] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = fit(table, labels.where(~held_out(F.col("doc_id"))))
    got = quality_scores(table, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    truth = {d: q for d, _, q in rows}
    assert len(held) > 40 and np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.95
    out = quality_scores(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert quality_scores(none, model).count() == 0
    weights, bias = fit(table, labels.where("doc_id < 0"))
    assert not weights.any() and bias == 0.0
